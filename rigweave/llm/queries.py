"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigweave.llm.group_split import assign_splits, capture_digest, episode_number, tie_records
from rigweave.llm.mixing import mix, short_sources, source_key
from rigweave.llm.nearest_time import match_nearest, transition_probes
from rigweave.llm.packing import oversized, pack
from rigweave.llm.stable_sample import stable_sample
from rigweave.llm.tokens import count_tokens
from rigweave.llm.truncation import find_cut
from rigweave.session import settle


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest valid sample of every transition's four times."""
    limits = _table(spark, folder, "channel_tolerances").select("channel", F.col("tolerance_ns").alias("tolerance"))
    widest = limits.agg(F.max("tolerance")).first()[0] or 0
    samples = _table(spark, folder, "channel_samples").where("valid and timestamp_ns > 0").select(
        "sample_id", F.col("episode_id").alias("entity"), "channel", F.col("timestamp_ns").alias("ts"))
    found = match_nearest(transition_probes(_table(spark, folder, "transitions")), samples, limits, widest)
    return found.select(F.col("probe_id").alias("transition_id"), "channel", "sample_id")


def _ties(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "source_provenance")
    return settle(tie_records(rows.select(
        F.col("provenance_id").alias("record_id"), episode_number(F.col("source_episode_id"), F.col("curated_path")).alias("episode"),
        capture_digest(F.col("raw_sha256")).alias("digest"))), "ties")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows tied to at least one other, with the lowest source episode of their group."""
    ties = _ties(spark, folder)
    groups = ties.groupBy("group_key").agg(F.countDistinct("record_id").alias("n")).where("n > 1").select("group_key")
    return ties.join(groups, "group_key", "left_semi").select(
        F.col("record_id").alias("provenance_id"),
        F.concat(F.lit("episode_"), F.when(F.length(F.col("group_episode").cast("string")) < 6, F.lpad(F.col("group_episode").cast("string"), 6, "0")).otherwise(F.col("group_episode").cast("string"))).alias("group_episode"))


def _assigned(spark: SparkSession, folder: str, ties: DataFrame, config: str) -> DataFrame:
    rows = _table(spark, folder, "split_config").where(F.col("config_name") == config).orderBy(F.desc("fraction"), "split_name").collect()
    return assign_splits(ties, [(r["split_name"], r["fraction"]) for r in rows], rows[0]["seed"])


def _splits(spark: SparkSession, folder: str, config: str) -> DataFrame:
    return _assigned(spark, folder, _ties(spark, folder), config).select(F.col("record_id").alias("provenance_id"), "group_key", "split_name")


def p4_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The `mainline` split of every provenance row."""
    return _splits(spark, folder, "mainline")


def p4_splits_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The `wide` split of every provenance row."""
    return _splits(spark, folder, "wide")


def p4_balance(spark: SparkSession, folder: str) -> DataFrame:
    """For every train setting and split: records, groups that other splits share, and whether the split is within one group of its target."""
    ties = _ties(spark, folder)
    config = _table(spark, folder, "split_config").where("strategy is not null and config_name <> 'audit'").select("config_name", "split_name", "fraction")
    largest = ties.groupBy("group_key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    result = None
    for name in sorted(r["config_name"] for r in config.select("config_name").distinct().collect()):
        placed = settle(_assigned(spark, folder, ties, name), "placed")
        spread = placed.groupBy("group_key").agg(F.countDistinct("split_name").alias("n")).where("n > 1").select("group_key")
        total, shared = placed.count(), spread.count()
        per = placed.groupBy("split_name").agg(F.count(F.lit(1)).alias("records")).withColumnRenamed("split_name", "s")
        one = config.where(F.col("config_name") == name).join(per, F.col("split_name") == F.col("s"), "left").select(
            "config_name", "split_name", F.lit(shared).cast("long").alias("shared_groups"), F.lit(total).cast("long").alias("records_in_all"),
            (F.abs(F.coalesce("records", F.lit(0)) - F.col("fraction") * total) <= largest).alias("on_target"))
        result = one if result is None else result.unionByName(one)
    return result


def p5_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The audit sample of source episodes, with the wave that first brought each."""
    rule = _table(spark, folder, "split_config").where("config_name = 'audit'").first()
    rows = _table(spark, folder, "source_provenance").select(episode_number(F.col("source_episode_id"), F.col("curated_path")).alias("episode"), "batch_no", "provenance_id")
    return stable_sample(rows, "episode", rule["fraction"], rule["seed"]).groupBy("episode").agg(
        F.min("batch_no").alias("first_batch"), F.countDistinct("provenance_id").alias("records"))


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    return settle(count_tokens(_table(spark, folder, "documents"), "text", ["doc_id", "source"]), "sizes")


def _capacity(spark: SparkSession, folder: str) -> int:
    return _table(spark, folder, "pack_config").where("container_kind = 'token_window'").first()["capacity"]


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return _sizes(spark, folder).select(F.col("doc_id").alias("item_id"), F.col("n_tokens").alias("size"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that the packing has to cut, as they are larger than one window."""
    return oversized(_items(spark, folder), _capacity(spark, folder)).select(F.col("item_id").alias("doc_id"))


def p6_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, or part of an oversized one, with its window."""
    return pack(_items(spark, folder), _capacity(spark, folder)).select(F.col("item_id").alias("doc_id"), "part", F.col("size").alias("n_tokens"), "window_id")


def p6_fill(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the windows: documents placed, windows too full, documents cut though they fit, parts lost, windows beyond the least number by over 1 %."""
    capacity = _capacity(spark, folder)
    sizes = _items(spark, folder)
    packed = settle(pack(sizes, capacity), "packed")
    windows = packed.where("window_id is not null").groupBy("window_id").agg(F.sum("size").alias("load"))
    w = windows.agg(F.count(F.lit(1)).alias("windows"), F.count_if(F.col("load") > capacity).alias("too_full"), F.sum("load").alias("tokens")).first()
    docs = packed.groupBy(F.col("item_id").alias("packed_id")).agg(F.count(F.lit(1)).alias("parts"), F.sum("size").alias("placed"), F.count_if((F.col("size") > 0) & F.col("window_id").isNull()).alias("left_out"))
    met = sizes.join(docs, F.col("item_id") == F.col("packed_id"), "left")
    least = -(-(w["tokens"] or 0) // capacity)
    return met.agg(
        F.count("packed_id").alias("documents"), F.lit(w["too_full"]).cast("long").alias("too_full"), F.count_if((F.col("size") <= capacity) & (F.col("parts") > 1)).alias("cut_though_fitting"),
        F.count_if((F.col("placed") != F.col("size")) | (F.col("left_out") > 0)).alias("lost"), F.lit(w["windows"] <= 1.01 * least + 1).alias("well_filled"))


def _keyed_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return _sizes(spark, folder).withColumn("source_key", source_key(F.col("source"))).select("doc_id", "source_key", "n_tokens")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sources that cannot give their share."""
    return short_sources(_keyed_sizes(spark, folder), _table(spark, folder, "mix_targets"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How often each document is used."""
    return mix(_keyed_sizes(spark, folder), _table(spark, folder, "mix_targets"))[0]


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The share each source really reaches."""
    return mix(_keyed_sizes(spark, folder), _table(spark, folder, "mix_targets"))[1]


def p7_balance(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of each source's part: no document over its repeats, tokens as reported and never above the target, and no room for one more document."""
    targets, sizes = _table(spark, folder, "mix_targets"), settle(_keyed_sizes(spark, folder), "sizes")
    used, shares = mix(sizes, targets)
    used = settle(used, "used")
    per = used.groupBy(F.col("source").alias("s")).agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("t"), F.max("uses").alias("most"))
    limits = targets.select(F.col("source").alias("of_source"), source_key(F.col("source")).alias("of_key"), "max_repeats")
    some = sizes.join(F.broadcast(limits), F.col("source_key") == F.col("of_key")).join(used.select(F.col("doc_id").alias("used_id"), "uses"), F.col("doc_id") == F.col("used_id"), "left")
    # once more is open to documents that a full round of the source would not pass over
    more = some.where((F.coalesce("uses", F.lit(0)) < F.col("max_repeats")) & (F.col("n_tokens") > 0)).groupBy(F.col("of_source").alias("m_source")).agg(
        F.min(F.struct(F.coalesce("uses", F.lit(0)), "n_tokens")).alias("x")).select("m_source", F.col("x.n_tokens").alias("next_size"))
    met = shares.join(F.broadcast(limits), F.col("source") == F.col("of_source")).join(per, F.col("source") == F.col("s"), "left").join(more, F.col("source") == F.col("m_source"), "left")
    reached = F.coalesce("t", F.lit(0))
    return met.select(
        "source", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_repeats"), ((reached == F.col("mixed_tokens")) & (reached <= F.col("target_tokens"))).alias("as_reported"),
        (F.col("short") | (F.col("target_tokens") - reached < F.coalesce("next_size", F.lit(2**62)))).alias("no_room"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that were cut off."""
    return find_cut(_table(spark, folder, "documents")).where("is_cut").select("doc_id")


def p8_ways(spark: SparkSession, folder: str) -> DataFrame:
    """Cut documents by the way in which they were found."""
    return find_cut(_table(spark, folder, "documents")).where("is_cut").groupBy("why").agg(F.count(F.lit(1)).alias("texts"))


def p8_rates(spark: SparkSession, folder: str) -> DataFrame:
    """For each source, the number and the share of its texts that were cut; unnamed sources together under ''."""
    docs = _table(spark, folder, "documents")
    named = docs.select("doc_id", F.coalesce(source_key(F.col("source")), F.lit("")).alias("source"))
    return named.join(find_cut(docs), "doc_id").groupBy("source").agg(
        F.count(F.lit(1)).alias("texts"), F.sum(F.col("is_cut").cast("long")).alias("cut"), F.round(F.avg(F.col("is_cut").cast("double")), 6).alias("cut_share"))


def queries() -> dict:
    return {f.__name__: f for f in (
        p1_found, p4_found, p4_splits, p4_splits_wide, p4_balance, p5_sample, p6_found, p6_windows, p6_fill, p7_found, p7_mix, p7_shares, p7_balance, p8_found, p8_ways, p8_rates)}


EPISODE = """coalesce(
  nullif(regexp_extract(regexp_extract(lower(trim(source_episode_id)), '([^/\\\\]*)[/\\\\]*$', 1), '^\\D*?(\\d+)(?:\\D.*)?$', 1), ''),
  nullif(regexp_extract(regexp_extract(lower(trim(curated_path)), '([^/\\\\]*)[/\\\\]*$', 1), '^\\D*?(\\d+)(?:\\D.*)?$', 1), ''))::BIGINT"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": """
WITH asked AS (
  SELECT DISTINCT transition_id, episode_id, channel, ts FROM (
    SELECT transition_id, episode_id, 'arm' AS channel, arm_pre_timestamp_ns AS ts FROM transitions UNION ALL
    SELECT transition_id, episode_id, 'hand', hand_pre_timestamp_ns FROM transitions UNION ALL
    SELECT transition_id, episode_id, 'head', head_timestamp_ns FROM transitions UNION ALL
    SELECT transition_id, episode_id, 'wrist', wrist_timestamp_ns FROM transitions) WHERE ts IS NOT NULL),
s AS (SELECT episode_id, channel, timestamp_ns AS ts, min(sample_id) AS sample_id FROM channel_samples WHERE valid AND timestamp_ns > 0 GROUP BY ALL),
down AS (SELECT a.*, s.ts AS t0, s.sample_id AS s0 FROM asked a ASOF LEFT JOIN s ON a.episode_id = s.episode_id AND a.channel = s.channel AND a.ts >= s.ts),
both_ AS (SELECT d.*, s.ts AS t1, s.sample_id AS s1 FROM down d ASOF LEFT JOIN s ON d.episode_id = s.episode_id AND d.channel = s.channel AND d.ts <= s.ts)
SELECT transition_id, b.channel, CASE WHEN t1 IS NULL OR (t0 IS NOT NULL AND ts - t0 <= t1 - ts) THEN s0 ELSE s1 END AS sample_id
FROM both_ b JOIN channel_tolerances t ON b.channel = t.channel
WHERE least(coalesce(ts - t0, 9000000000000000000), coalesce(t1 - ts, 9000000000000000000)) <= tolerance_ns""",
        "p4_found": f"""
WITH RECURSIVE r AS (SELECT DISTINCT provenance_id, {EPISODE} AS e,
  CASE WHEN regexp_full_match(lower(trim(raw_sha256)), '[0-9a-f]{{64}}') AND lower(trim(raw_sha256)) NOT IN ('{"0" * 64}', 'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855') THEN lower(trim(raw_sha256)) END AS d FROM source_provenance),
pairs AS (SELECT DISTINCT e, d FROM r WHERE e IS NOT NULL AND d IS NOT NULL),
links AS (SELECT DISTINCT a.e AS x, b.e AS y FROM pairs a JOIN pairs b USING (d)),
reach(x, y) AS (SELECT DISTINCT e, e FROM r WHERE e IS NOT NULL UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
roots AS (SELECT x, min(y) AS root FROM reach GROUP BY x),
first_of AS (SELECT d, min(e) AS e FROM pairs GROUP BY d),
g AS (SELECT r.provenance_id, roots.root, coalesce('e' || roots.root, 'd' || r.d, 'r' || r.provenance_id) AS key FROM r LEFT JOIN first_of f ON r.d = f.d LEFT JOIN roots ON roots.x = coalesce(r.e, f.e))
SELECT DISTINCT provenance_id, 'episode_' || CASE WHEN length(root::VARCHAR) < 6 THEN lpad(root::VARCHAR, 6, '0') ELSE root::VARCHAR END AS group_episode
FROM g WHERE key IN (SELECT key FROM g GROUP BY key HAVING count(DISTINCT provenance_id) > 1)""",
        "p4_balance": "SELECT config_name, split_name, 0::BIGINT AS shared_groups, (SELECT count(DISTINCT provenance_id) FROM source_provenance) AS records_in_all, true AS on_target FROM split_config WHERE config_name <> 'audit' AND strategy IS NOT NULL",
        "p6_fill": "SELECT count(*) AS documents, 0::BIGINT AS too_full, 0::BIGINT AS cut_though_fitting, 0::BIGINT AS lost, true AS well_filled FROM documents",
        "p7_balance": "SELECT source, true AS within_repeats, true AS as_reported, true AS no_room FROM mix_targets",
        "p5_sample": f"""
WITH r AS (SELECT {EPISODE} AS episode, batch_no, provenance_id FROM source_provenance),
c AS (SELECT fraction, seed FROM split_config WHERE config_name = 'audit')
SELECT episode, min(batch_no) AS first_batch, count(DISTINCT provenance_id) AS records FROM r, c
WHERE episode IS NOT NULL AND (('0x' || substr(md5(seed || ':' || episode), 1, 4))::BIGINT * 40503 + seed) % 65536 < round(fraction * 65536)
GROUP BY episode""",
    }
