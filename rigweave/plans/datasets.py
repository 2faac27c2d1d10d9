"""Splits, samples, merges, manifests and set operations over tables of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigweave.functions.text import actuator_words, episode_name, episode_number, frame_path, intents, normalize_instruction, redact, violations
from rigweave.operators.hashrank import below_fraction
from rigweave.operators.merging import append_new, compare_manifests, dense_ids, fingerprint
from rigweave.operators.sequence import neighbour
from rigweave.operators.stats import close_enough, quantiles, zero_filled
from rigweave.plans.base import MEDIA, MOVES, SAMPLES, TICKS, media, moves, samples, table, ticks



def _episodes(spark: SparkSession, folder: str) -> DataFrame:
    return moves(spark, folder).where("episode_id is not null").groupBy("episode_id").agg(F.count(F.lit(1)).alias("rows"))


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes ranked by a seeded hash; the first tenth, rounded down, goes to val."""
    return below_fraction(_episodes(spark, folder).select("episode_id"), "episode_id", 0.1, 19, "val", "train")


def audit_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The hash-ranked twentieth of all documents."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("id"))
    return below_fraction(docs, "id", 0.05, 23, "audit", "rest").where("split = 'audit'").select("id")


def review_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Rows below a confidence, then flagged ones, then a hash-ranked tenth of the rest."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("id"), ((F.col("doc_id") * 37) % 100 / 100.0).alias("confidence"), F.col("lang").isNull().alias("flagged"))
    low = docs.where("confidence < 0.3").select("id", F.lit("LOW_CONFIDENCE").alias("why"))
    flagged = docs.where("confidence >= 0.3 and flagged").select("id", F.lit("QUALITY_WARNING").alias("why"))
    rest = docs.where("confidence >= 0.3 and not flagged").select("id")
    return low.unionByName(flagged).unionByName(below_fraction(rest, "id", 0.1, 7, "s", "r").where("split = 's'").select("id", F.lit("RANDOM").alias("why")))


def confidence_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(((F.col("doc_id") * 37) % 1000 / 1000.0).alias("c"))
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]
    p = quantiles(docs, [], F.col("c"), tuple(points), keep=False).select(F.col("q").alias("p"), (F.col("total") / F.col("n")).alias("mean"))
    return p.select(F.posexplode("p").alias("i", "value"), "mean").select(F.array(*[F.lit(int(100 * x)) for x in points])[F.col("i")].alias("percentile"), F.round("value", 6).alias("value"), F.round("mean", 6).alias("mean"))


def review_workload(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows each threshold would send to review."""
    docs = table(spark, folder, "documents").select(((F.col("doc_id") * 37) % 1000 / 1000.0).alias("c"))
    marks = (0.7, 0.8, 0.9, 0.95)
    counts = docs.agg(*[F.count_if(F.col("c") < m).alias(str(i)) for i, m in enumerate(marks)])
    return counts.unpivot([], [str(i) for i in range(len(marks))], "i", "n").select(F.array(*[F.lit(m) for m in marks])[F.col("i").cast("int")].alias("threshold"), "n")


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Baseline runs (batches 1 and 2) and incoming ones (all), one per identity."""
    rows = table(spark, folder, "source_provenance").select(
        fingerprint(["raw_sha256", "source_episode_id", "source_start_index", "source_end_index", "task_instruction_sha256"]).alias("run_key"), "provenance_id", "batch_no", F.col("task_instruction").alias("task"), "transition_count")
    one = F.min(F.struct("provenance_id", "task", "transition_count")).alias("r")
    side = lambda cond: rows.where(cond).groupBy("run_key").agg(one).select("run_key", "r.*")
    return side("batch_no <= 2"), side("batch_no >= 2")


def merge_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming runs that the baseline has, and those to append."""
    base, incoming = _sides(spark, folder)
    return append_new(base, incoming, "run_key").groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.sum("transition_count").alias("transitions"))


def append_reindex(spark: SparkSession, folder: str) -> DataFrame:
    """The merged dataset: baseline first, then the appended runs, with dense indices and running offsets."""
    base, incoming = _sides(spark, folder)
    new = append_new(base, incoming, "run_key").where("action = 'APPEND'").drop("action")
    rows = base.withColumn("part", F.lit(0)).unionByName(new.withColumn("part", F.lit(1)))
    return dense_ids(rows, ["part", "provenance_id"], "episode_index", "transition_count", "from_index").select("run_key", "part", "episode_index", "from_index")


def task_table(spark: SparkSession, folder: str) -> DataFrame:
    """Dense ids of task texts: the baseline's first, new ones after them, each in order of text."""
    base, incoming = _sides(spark, folder)
    rows = base.select("task", F.lit(0).alias("part")).unionByName(incoming.select("task", F.lit(1).alias("part"))).where("task is not null").groupBy("task").agg(F.min("part").alias("part"))
    return dense_ids(rows, ["part", "task"], "task_index").select("task", "task_index")


def manifest_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Two listings of files compared: what is missing, extra or different."""
    rows = table(spark, folder, "media_files").groupBy("file_id").agg(F.max("n_bytes").alias("size"), F.max("content_digest").alias("digest"))
    local = rows.where("file_id % 7 <> 0").select(F.col("file_id").alias("path"), "size", "digest")
    remote = rows.where("file_id % 11 <> 0").select(F.col("file_id").alias("path"), F.when(F.col("file_id") % 13 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"), "digest")
    return compare_manifests(local, remote).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def manifest_totals(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "media_files").groupBy("file_id").agg(F.max("n_bytes").alias("size"))
    return rows.agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.count_if(F.col("size").isNull()).alias("unknown"))


def media_integrity(spark: SparkSession, folder: str) -> DataFrame:
    """Head frames that are referenced but not stored, stored but not referenced, or both."""
    ref = moves(spark, folder).select("episode_id", F.col("head_rgb_frame_index").alias("frame_index")).where("episode_id is not null and frame_index >= 0").distinct().withColumn("referenced", F.lit(True))
    have = media(spark, folder).where("role = 'head'").select("episode_id", "frame_index").withColumn("stored", F.lit(True))
    both = ref.join(have, ["episode_id", "frame_index"], "full")
    status = F.when(F.col("stored").isNull(), "MISSING").when(F.col("referenced").isNull(), "UNREFERENCED").otherwise("OK")
    return both.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def mask_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    """Transitions per episode whose head frame is not among the invalid ones."""
    invalid = samples(spark, folder).where("channel = 'head' and not eligible and frame_index is not null").select("episode_id", F.col("frame_index").alias("head_rgb_frame_index")).distinct()
    rows = moves(spark, folder).where("episode_id is not null")
    return rows.join(invalid, ["episode_id", "head_rgb_frame_index"], "left_anti").groupBy("episode_id").agg(F.count(F.lit(1)).alias("kept"))


def _exports(spark: SparkSession, folder: str) -> DataFrame:
    """Exported runs once each, with the six-digit number of their episode by any spelling of its id, or by the path."""
    e = episode_number(F.col("source_episode_id"), F.col("curated_path")).cast("string")
    rows = table(spark, folder, "source_provenance").select("provenance_id", F.when(F.length(e) < 6, F.lpad(e, 6, "0")).otherwise(e).alias("n"), "batch_no", "transition_count")
    return rows.where("n is not null").distinct()


def run_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks, transitions and exported runs of every episode known to any of the three."""
    a = ticks(spark, folder).where("episode_id is not null").groupBy("episode_id").agg(F.count(F.lit(1)).alias("ticks"))
    b = _episodes(spark, folder)
    c = _exports(spark, folder).select("provenance_id", "n").distinct().groupBy(F.concat(F.lit("episode_"), "n").alias("episode_id")).agg(F.count(F.lit(1)).alias("exports"))
    joined = a.join(b, "episode_id", "full").join(c, "episode_id", "full")
    return joined.select("episode_id", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("ticks", "rows", "exports")])


def baseline_compare(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per episode of each wave and the one after it (`batch_no`), and whether the number fell or grew beyond bounds."""
    rows = _exports(spark, folder).where("batch_no is not null")
    sums = rows.groupBy("n", "batch_no").agg(F.sum("transition_count").alias("rows"))
    # the waves that there are, each with the next: a short fixed list, whatever the number of rows
    waves = [r["batch_no"] for r in table(spark, folder, "source_provenance").select("batch_no").where("batch_no is not null").distinct().orderBy("batch_no").collect()]
    following = spark.createDataFrame(list(zip(waves, waves[1:])), "batch_no int, next_no int")
    before = sums.join(F.broadcast(following), "batch_no").select("n", F.col("next_no").alias("batch_no"), F.col("rows").alias("before"))
    after = sums.join(F.broadcast(following.select(F.col("next_no").alias("batch_no"))), "batch_no").select("n", "batch_no", F.col("rows").alias("after"))
    both = before.join(after, ["n", "batch_no"], "full")
    status = F.when(F.col("before").isNull(), "NEW").when(F.col("after").isNull(), "GONE").when(F.col("after") < 0.8 * F.col("before"), "LOWER").when(F.col("after") > F.greatest(2 * F.col("before"), F.col("before") + 100), "HIGHER").otherwise("SAME")
    return both.select("n", "batch_no", "before", "after", status.alias("status"))


def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per dataset status, unknown ones together, for a fixed list with zeros."""
    names = ["RAW_CAPTURE", "RAW_CAPTURE_QUARANTINED", "SYNTHETIC_SMOKE", "NEVER_SEEN", "MISSING_OR_INVALID"]
    rows = table(spark, folder, "source_provenance").select("provenance_id", "source_dataset_status").distinct()
    known = F.when(F.col("source_dataset_status").isin(names[:4]), F.col("source_dataset_status")).otherwise("MISSING_OR_INVALID")
    return zero_filled(rows.groupBy(known.alias("status")).agg(F.count(F.lit(1)).alias("n")), "status", "n", names)


def set_ops(spark: SparkSession, folder: str) -> DataFrame:
    """Union, difference, intersection and partition check of episode ids of three tables."""
    a, b, c = (x.select("episode_id").where("episode_id is not null").distinct() for x in (moves(spark, folder), table(spark, folder, "documents"), samples(spark, folder)))
    parts = {"union": a.union(b).union(c).distinct(), "only_first": a.exceptAll(b), "both": a.intersect(b), "only_second": b.exceptAll(a), "outside_third": a.union(b).distinct().exceptAll(c)}
    result = None
    for name, rows in parts.items():
        line = rows.agg(F.lit(name).alias("op"), F.count(F.lit(1)).alias("n"))
        result = line if result is None else result.unionByName(line)
    return result


def dual_view(spark: SparkSession, folder: str) -> DataFrame:
    """Frames that both cameras have, by episode; points with one view only are counted apart."""
    p = media(spark, folder).where(F.col("role").isin("head", "wrist")).groupBy("episode_id", "frame_index").pivot("role", ["head", "wrist"]).agg(F.count(F.lit(1)))
    return p.groupBy("episode_id").agg(F.count_if((F.col("head") > 0) & (F.col("wrist") > 0)).alias("paired"), F.count_if(F.col("head").isNull() | F.col("wrist").isNull()).alias("single"))


def replay_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Requests answered from an exact earlier one: equal text and source, the lowest id replays."""
    docs = table(spark, folder, "documents").select("doc_id", "source", fingerprint(["text", "source"]).alias("request"))
    first = docs.groupBy("request").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("request", "r")
    return docs.join(first, F.col("request") == F.col("r")).where("doc_id <> first_id").select("doc_id", "first_id")


def frame_json(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON line a tick: time, frames of both views and whether it is the episode's last."""
    rows = ticks(spark, folder).where("episode_id is not null").select("tick_id", "episode_id", "tick", "ts_ns", "head_frame", "wrist_frame")
    n = neighbour(rows, "episode_id", "tick", {"nxt": "tick"}, after=True)
    return n.select("tick_id", F.to_json(F.struct(F.col("ts_ns").alias("t"), F.col("head_frame").alias("image_top"), F.col("wrist_frame").alias("image_hand"), F.col("nxt").isNull().cast("int").alias("success"))).alias("line"))


def instruction_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by class of task language that they violate."""
    return table(spark, folder, "documents").select(F.explode(violations(F.col("text"))).alias("violation")).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


def instruction_intents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_provenance").select("provenance_id", intents(F.col("task_instruction")).alias("intents")).distinct()


def normalized_instructions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_provenance").select("provenance_id", normalize_instruction(F.col("task_instruction")).alias("task"), F.sha2("task_instruction", 256).alias("sha"), (F.sha2("task_instruction", 256) == F.col("task_instruction_sha256")).alias("sha_ok")).distinct()


def redacted(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines with planted secrets, redacted."""
    docs = table(spark, folder, "documents").select("doc_id", F.concat(F.lit("run "), F.col("doc_id").cast("string"), F.lit(" MY_TOKEN=abc"), F.col("doc_id").cast("string"), F.lit(" Authorization: Basic x hf_0123456789abc Bearer q.w.e end")).alias("line"))
    return docs.select("doc_id", redact(F.col("line")).alias("line"))


def actuator_terms(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(F.explode(actuator_words(F.col("text"))).alias("word"))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def names(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical episode names and where their frame tables lie."""
    n = table(spark, folder, "documents").select("doc_id")
    return n.select("doc_id", episode_name(F.col("doc_id")).alias("episode"), frame_path(1000, F.col("doc_id")).alias("path"))


def stats_match(spark: SparkSession, folder: str) -> DataFrame:
    """Whether statistics taken in two ways agree within tolerance, per order priority."""
    o = table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("a"), (F.sum("o_totalprice") / F.count(F.lit(1))).alias("b"), F.count(F.lit(1)).alias("n"))
    return o.select("o_orderpriority", "n", close_enough(F.col("a"), F.col("b")).alias("agree"))


def last_events(spark: SparkSession, folder: str) -> DataFrame:
    """The hundred latest events: a report of limited length."""
    return table(spark, folder, "events").select("event_id", "user_id", "event_type").orderBy(F.desc("event_id")).limit(100)


def pricing_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Line items by flag and status over the nation of their customer's region."""
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_returnflag")
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, folder, "region")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def queries() -> dict:
    return {f.__name__: f for f in (
        hash_split, audit_sample, review_sample, confidence_percentiles, review_workload, merge_plan, append_reindex, task_table, manifest_diff, manifest_totals, media_integrity, mask_exclusion, run_snapshot, baseline_compare,
        status_counts, set_ops, dual_view, replay_lookup, frame_json, instruction_violations, instruction_intents, normalized_instructions, redacted, actuator_terms, names, stats_match, last_events, pricing_summary)}


_KEY = "sha256(concat_ws(chr(1), coalesce(raw_sha256::VARCHAR, chr(2)), coalesce(source_episode_id::VARCHAR, chr(2)), coalesce(source_start_index::VARCHAR, chr(2)), coalesce(source_end_index::VARCHAR, chr(2)), coalesce(task_instruction_sha256::VARCHAR, chr(2))))"
_SIDES = f"""p AS (SELECT {_KEY} AS run_key, provenance_id, batch_no, task_instruction AS task, transition_count FROM source_provenance),
base AS (SELECT run_key, min(provenance_id) AS provenance_id, arg_min(task, provenance_id) AS task, arg_min(transition_count, provenance_id) AS transition_count FROM p WHERE batch_no <= 2 GROUP BY 1),
inc AS (SELECT run_key, min(provenance_id) AS provenance_id, arg_min(task, provenance_id) AS task, arg_min(transition_count, provenance_id) AS transition_count FROM p WHERE batch_no >= 2 GROUP BY 1)"""


def _split_sql(source: str, key: str, fraction: float, seed: int) -> str:
    return f"SELECT {key}, CASE WHEN row_number() OVER (ORDER BY sha256('{seed}:' || {key}), {key}) <= floor(count(*) OVER () * {fraction}) THEN 1 ELSE 0 END AS inside FROM {source}"


def oracle_sql() -> dict[str, str]:
    from rigweave.functions import text as T

    q = lambda p: p.replace("'", "''")
    clean = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
    classes = ", ".join(f"CASE WHEN regexp_matches(lower(c), '{q(p)}') THEN '{n}' END" for n, p in T.VIOLATION_PATTERNS)
    intent = ", ".join(f"CASE WHEN regexp_matches(lower(task_instruction), '{q(T._any(p))}') THEN '{n}' END" for n, p in sorted(T.INTENT_PATTERNS.items()))
    latin = ", ".join(f"'{w}'" for w in T.ACTUATOR_WORDS if w.isascii())
    han = ", ".join(f"CASE WHEN contains(text, '{w}') THEN '{w}' END" for w in T.ACTUATOR_WORDS if not w.isascii())
    return {
        "hash_split": f"WITH {MOVES}, e AS (SELECT DISTINCT episode_id FROM moves WHERE episode_id IS NOT NULL), s AS ({_split_sql('e', 'episode_id', 0.1, 19)}) SELECT episode_id, CASE WHEN inside = 1 THEN 'val' ELSE 'train' END AS split FROM s",
        "audit_sample": f"WITH d AS (SELECT doc_id::VARCHAR AS id FROM documents), s AS ({_split_sql('d', 'id', 0.05, 23)}) SELECT id FROM s WHERE inside = 1",
        "review_sample": f"""WITH d AS (SELECT doc_id::VARCHAR AS id, (doc_id * 37) % 100 / 100.0 AS c, lang IS NULL AS f FROM documents), r AS (SELECT id FROM d WHERE c >= 0.3 AND NOT f), s AS ({_split_sql('r', 'id', 0.1, 7)})
SELECT id, 'LOW_CONFIDENCE' AS why FROM d WHERE c < 0.3 UNION ALL SELECT id, 'QUALITY_WARNING' FROM d WHERE c >= 0.3 AND f UNION ALL SELECT id, 'RANDOM' FROM s WHERE inside = 1""",
        "confidence_percentiles": "WITH d AS (SELECT (doc_id * 37) % 1000 / 1000.0 AS c FROM documents), q AS (SELECT unnest([0, 10, 25, 50, 75, 90, 95, 100]) AS percentile) SELECT percentile, round((SELECT quantile_cont(c, [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]) FROM d)[list_position([0, 10, 25, 50, 75, 90, 95, 100], percentile)], 6) AS value, round((SELECT avg(c) FROM d), 6) AS mean FROM q",
        "review_workload": "WITH d AS (SELECT (doc_id * 37) % 1000 / 1000.0 AS c FROM documents) SELECT t AS threshold, count(*) FILTER (c < t) AS n FROM d, (VALUES (0.7::DOUBLE), (0.8::DOUBLE), (0.9::DOUBLE), (0.95::DOUBLE)) v(t) GROUP BY 1",
        "merge_plan": f"WITH {_SIDES} SELECT CASE WHEN b.run_key IS NULL THEN 'APPEND' ELSE 'DUPLICATE' END AS action, count(*) AS n, sum(i.transition_count)::BIGINT AS transitions FROM inc i LEFT JOIN base b USING (run_key) GROUP BY 1",
        "append_reindex": f"""WITH {_SIDES}, u AS (SELECT run_key, provenance_id, transition_count, 0 AS part FROM base UNION ALL SELECT run_key, provenance_id, transition_count, 1 FROM inc WHERE run_key NOT IN (SELECT run_key FROM base))
SELECT run_key, part, row_number() OVER w - 1 AS episode_index, coalesce(sum(transition_count) OVER (ORDER BY part, provenance_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS from_index FROM u WINDOW w AS (ORDER BY part, provenance_id)""",
        "task_table": f"WITH {_SIDES}, t AS (SELECT task, min(part) AS part FROM (SELECT task, 0 AS part FROM base UNION ALL SELECT task, 1 FROM inc) WHERE task IS NOT NULL GROUP BY 1) SELECT task, row_number() OVER (ORDER BY part, task) - 1 AS task_index FROM t",
        "manifest_diff": """WITH r AS (SELECT file_id AS path, max(n_bytes) AS size, max(content_digest) AS digest FROM media_files GROUP BY 1), l AS (SELECT * FROM r WHERE path % 7 <> 0), o AS (SELECT path, CASE WHEN path % 13 = 0 THEN size + 1 ELSE size END AS size, digest FROM r WHERE path % 11 <> 0)
SELECT CASE WHEN o.path IS NULL THEN 'MISSING' WHEN l.path IS NULL THEN 'EXTRA' WHEN l.size IS DISTINCT FROM o.size OR l.digest IS DISTINCT FROM o.digest THEN 'DIFFERENT' ELSE 'SAME' END AS status, count(*) AS n FROM l FULL JOIN o ON l.path = o.path GROUP BY 1""",
        "manifest_totals": "WITH r AS (SELECT file_id, max(n_bytes) AS size FROM media_files GROUP BY 1) SELECT count(*) AS files, sum(size)::BIGINT AS bytes, count(*) FILTER (size IS NULL) AS unknown FROM r",
        "media_integrity": f"""WITH {MOVES}, {MEDIA}, r AS (SELECT DISTINCT episode_id, head_rgb_frame_index AS f FROM moves WHERE episode_id IS NOT NULL AND head_rgb_frame_index >= 0), h AS (SELECT episode_id, frame_index AS f FROM media WHERE role = 'head')
SELECT CASE WHEN h.f IS NULL THEN 'MISSING' WHEN r.f IS NULL THEN 'UNREFERENCED' ELSE 'OK' END AS status, count(*) AS n FROM r FULL JOIN h ON r.episode_id = h.episode_id AND r.f = h.f GROUP BY 1""",
        "mask_exclusion": f"""WITH {MOVES}, {SAMPLES}, i AS (SELECT DISTINCT episode_id, frame_index FROM samples WHERE channel = 'head' AND NOT eligible AND frame_index IS NOT NULL)
SELECT episode_id, count(*) AS kept FROM moves m WHERE episode_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM i WHERE i.episode_id = m.episode_id AND i.frame_index = m.head_rgb_frame_index) GROUP BY 1""",
        "run_snapshot": f"""WITH {TICKS}, {MOVES}, a AS (SELECT episode_id, count(*) AS ticks FROM ticks WHERE episode_id IS NOT NULL GROUP BY 1), b AS (SELECT episode_id, count(*) AS rows FROM moves WHERE episode_id IS NOT NULL GROUP BY 1),
c AS (SELECT 'episode_' || n AS episode_id, count(*) AS exports FROM (SELECT DISTINCT provenance_id, regexp_extract(lower(source_episode_id), 'episode_(\\d{{6}})', 1) AS n FROM source_provenance) WHERE n <> '' GROUP BY 1)
SELECT episode_id, coalesce(ticks, 0) AS ticks, coalesce(rows, 0) AS rows, coalesce(exports, 0) AS exports FROM a FULL JOIN b USING (episode_id) FULL JOIN c USING (episode_id)""",
        "baseline_compare": """WITH p AS (SELECT DISTINCT provenance_id, regexp_extract(lower(source_episode_id), 'episode_(\\d{6})', 1) AS n, batch_no, transition_count FROM source_provenance), x AS (SELECT * FROM p WHERE n <> ''),
a AS (SELECT n, sum(transition_count)::BIGINT AS before FROM x WHERE batch_no = 1 GROUP BY 1), b AS (SELECT n, sum(transition_count)::BIGINT AS after FROM x WHERE batch_no = 2 GROUP BY 1)
SELECT n, before, after, CASE WHEN before IS NULL THEN 'NEW' WHEN after IS NULL THEN 'GONE' WHEN after < 0.8 * before THEN 'LOWER' WHEN after > greatest(2 * before, before + 100) THEN 'HIGHER' ELSE 'SAME' END AS status FROM a FULL JOIN b USING (n)""",
        "status_counts": """WITH r AS (SELECT DISTINCT provenance_id, source_dataset_status AS s FROM source_provenance), k AS (SELECT CASE WHEN s IN ('RAW_CAPTURE', 'RAW_CAPTURE_QUARANTINED', 'SYNTHETIC_SMOKE', 'NEVER_SEEN') THEN s ELSE 'MISSING_OR_INVALID' END AS s FROM r)
SELECT v.s AS status, count(k.s) AS n FROM (VALUES ('RAW_CAPTURE'), ('RAW_CAPTURE_QUARANTINED'), ('SYNTHETIC_SMOKE'), ('NEVER_SEEN'), ('MISSING_OR_INVALID')) v(s) LEFT JOIN k USING (s) GROUP BY 1""",
        "set_ops": """WITH a AS (SELECT DISTINCT episode_id FROM transitions WHERE episode_id IS NOT NULL), b AS (SELECT DISTINCT episode_id FROM documents WHERE episode_id IS NOT NULL), c AS (SELECT DISTINCT episode_id FROM channel_samples WHERE episode_id IS NOT NULL)
SELECT 'union' AS op, count(*) AS n FROM (SELECT * FROM a UNION SELECT * FROM b UNION SELECT * FROM c) UNION ALL SELECT 'only_first', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'both', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
UNION ALL SELECT 'only_second', count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT 'outside_third', count(*) FROM ((SELECT * FROM a UNION SELECT * FROM b) EXCEPT SELECT * FROM c)""",
        "dual_view": f"WITH {MEDIA}, p AS (SELECT episode_id, frame_index, max(role = 'head') AS h, max(role = 'wrist') AS w FROM media WHERE role IN ('head', 'wrist') GROUP BY ALL) SELECT episode_id, count(*) FILTER (h AND w) AS paired, count(*) FILTER (NOT (h AND w)) AS single FROM p GROUP BY 1",
        "replay_lookup": "WITH f AS (SELECT *, min(doc_id) OVER (PARTITION BY text, source) AS first_id FROM documents) SELECT doc_id, first_id FROM f WHERE doc_id <> first_id",
        "frame_json": f"""WITH {TICKS}, l AS (SELECT *, (lead(tick) OVER (PARTITION BY episode_id ORDER BY tick) IS NULL)::INT AS s FROM ticks WHERE episode_id IS NOT NULL)
SELECT tick_id, '{{"t":' || ts_ns || ',"image_top":' || head_frame || ',"image_hand":' || wrist_frame || ',"success":' || s || '}}' AS line FROM l""",
        "instruction_violations": f"""WITH d AS (SELECT {clean} AS c FROM documents), v AS (SELECT CASE WHEN c IS NULL OR c = '' THEN ['EMPTY_INSTRUCTION'] ELSE list_filter([{classes}, CASE WHEN length(c) > 160 OR length(c) < 4 THEN 'INSTRUCTION_LENGTH' END], lambda x: x IS NOT NULL) END AS v FROM d)
SELECT violation, count(*) AS n FROM (SELECT unnest(v) AS violation FROM v) GROUP BY 1""",
        "instruction_intents": f"SELECT DISTINCT provenance_id, list_filter([{intent}], lambda x: x IS NOT NULL) AS intents FROM source_provenance",
        "normalized_instructions": r"""SELECT DISTINCT provenance_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(task_instruction, '^\s+|\s+$', '', 'g'), '\.+$', ''), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS task, sha256(task_instruction) AS sha, sha256(task_instruction) = task_instruction_sha256 AS sha_ok FROM source_provenance""",
        "redacted": "SELECT doc_id, 'run ' || doc_id || ' MY_TOKEN=[REDACTED] Authorization: [REDACTED] x [REDACTED] Bearer [REDACTED] end' AS line FROM documents",
        "actuator_terms": f"""WITH w AS (SELECT doc_id, text, list_transform(regexp_split_to_array(lower(text), '\\s+'), lambda x: regexp_replace(x, '^[.,:;!?()\\[\\]{{}}"]+|[.,:;!?()\\[\\]{{}}"]+$', '', 'g')) AS ws FROM documents),
t AS (SELECT doc_id, unnest(list_distinct(list_concat(list_filter(ws, lambda x: x IN ({latin})), list_filter([{han}], lambda x: x IS NOT NULL)))) AS word FROM w) SELECT word, count(*) AS n FROM t GROUP BY 1""",
        "names": "SELECT doc_id, 'episode_' || lpad(doc_id::VARCHAR, 6, '0') AS episode, 'data/chunk-' || lpad((doc_id // 1000)::VARCHAR, 3, '0') || '/episode_' || lpad(doc_id::VARCHAR, 6, '0') || '.parquet' AS path FROM documents",
        "stats_match": "SELECT o_orderpriority, count(*) AS n, abs(avg(o_totalprice) - sum(o_totalprice) / count(*)) <= greatest(1e-9 * greatest(abs(avg(o_totalprice)), abs(sum(o_totalprice) / count(*))), 1e-6) AS agree FROM orders GROUP BY 1",
        "last_events": "SELECT event_id, user_id, event_type FROM events ORDER BY event_id DESC LIMIT 100",
        "pricing_summary": "SELECT r_name, l_returnflag, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
    }
