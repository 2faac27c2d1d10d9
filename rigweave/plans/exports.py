"""Exports: the plan of runs and splits, frames written and checked against it, frame lines, provenance rules, canonical identities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigweave.functions.arrays import all_finite, float32_error, to_float32
from rigweave.functions.text import canonical_object, redact
from rigweave.operators.contract import provenance_rules
from rigweave.operators.hashrank import below_fraction
from rigweave.operators.merging import compare_manifests, dense_ids
from rigweave.operators.sequence import islands, neighbour, row_index
from rigweave.plans.base import TICKS, table, ticks
from rigweave.plans.motion import _RUNS, contiguous_runs
from rigweave.sources.tables import file_listing, publish, read_frames, read_jsonl, write_frames
from rigweave.session import scratch_path, settle

FRACTION, SEED, CHUNK = 0.2, 11, 100


def _plan(spark: SparkSession, folder: str) -> DataFrame:
    runs = contiguous_runs(spark, folder).select("episode_id", "segment", "run", "run_id", "start_row", "end_row")
    runs = settle(runs.withColumn("frames", F.col("end_row") - F.col("start_row")), "runs")
    split = below_fraction(runs.select("episode_id").distinct(), "episode_id", FRACTION, SEED, "val", "train").withColumnRenamed("episode_id", "s_episode")
    return settle(runs.join(split, F.col("episode_id") == F.col("s_episode")).drop("s_episode"), "plan")


def export_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Every clean run with the split of its source episode and its dense index and first frame among the split's runs."""
    plan = _plan(spark, folder)
    result = None
    for name in ("train", "val"):
        part = dense_ids(plan.where(F.col("split") == name), ["episode_id", "start_row"], "episode_index", "frames", "first_frame")
        result = part if result is None else result.unionByName(part)
    return result.select("run_id", "episode_id", "split", "episode_index", "first_frame", "frames")


def export_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Source episodes, runs and frames of each split."""
    return _plan(spark, folder).groupBy("split", "episode_id").agg(F.count(F.lit(1)).alias("runs"), F.sum("frames").alias("frames")).groupBy("split").agg(F.count(F.lit(1)).alias("episodes"), F.sum("runs").alias("runs"), F.sum("frames").alias("frames"))


def export_check(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of the export written as chunked tables, read back and met with the plan: runs by what became of them.

    MISSING and EXTRA runs, COUNT (another number of frames), ORDER (frame numbers that are not 0, 1, 2, ...), else OK.
    """
    plan = export_plan(spark, folder)
    indexed = settle(dense_ids(plan, ["split", "episode_index"], "index"), "indexed")
    frames = indexed.select(F.col("index").alias("episode_index"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("frames") - 1)).alias("frame_index"))
    path = scratch_path(spark, "export")
    write_frames(frames, path, CHUNK)
    back = read_frames(spark, path).groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"), F.min("frame_index").alias("lo"), F.max("frame_index").alias("hi"))
    met = indexed.select("index", "frames").join(back, F.col("index") == F.col("episode_index"), "full")
    status = F.when(F.col("n").isNull(), "MISSING").when(F.col("index").isNull(), "EXTRA").when(F.col("n") != F.col("frames"), "COUNT").when((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1), "ORDER").otherwise("OK")
    return met.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("runs"), F.sum("n").alias("frames"))


def frame_storage(spark: SparkSession, folder: str) -> DataFrame:
    """Every action vector stored as 32-bit floats in chunked frame tables and read back: frames, elements and largest error by episode.

    Vectors that 32 bits cannot hold are refused and counted.
    """
    rows = table(spark, folder, "transitions").where("episode_id is not null").select(
        "transition_id", F.regexp_extract("episode_id", r"(\d+)$", 1).cast("long").alias("episode_index"), F.col("source_tick_index").alias("frame_index"), F.filter("action17", lambda x: x.isNotNull()).alias("v")).dropDuplicates(["transition_id"])
    rows = rows.withColumn("fits", F.col("v").isNotNull() & float32_error(F.col("v")).isNotNull())
    rows = settle(rows, "vectors")
    path = scratch_path(spark, "frames")
    write_frames(rows.where("fits").select("transition_id", "episode_index", "frame_index", to_float32(F.col("v")).alias("action")), path, CHUNK)
    back = read_frames(spark, path).select(F.col("transition_id").alias("t"), "action")
    met = rows.join(back, F.col("transition_id") == F.col("t"), "left")
    far = F.array_max(F.zip_with("v", "action", lambda a, b: F.abs(a - b.cast("double")) / F.greatest(F.abs(a), F.lit(1.0))))
    return met.groupBy("episode_index").agg(F.count("t").alias("stored"), F.count_if(~F.col("fits")).alias("refused"), F.sum(F.when(F.col("fits"), F.size("v")).otherwise(0)).alias("elements"), (F.coalesce(F.max(far), F.lit(0.0)) < 1e-7).alias("faithful"))


LINE = "t double, image_top string, image_hand string, depth_top string, depth_hand string, joint_pos array<double>, action array<double>, success int, episode_id string, frame long"


def frame_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Frames as JSON lines of eight fields, published and read back: per episode the lines, their last time, images, vectors and success.

    A line needs finite vectors of 17 elements; other transitions are refused and counted.
    """
    rows = table(spark, folder, "transitions").where("episode_id is not null").select("transition_id", "episode_id", F.col("source_tick_index").alias("tick"), F.col("state17").alias("state"), F.col("action17").alias("action"), "head_rgb_frame_index", "wrist_rgb_frame_index").dropDuplicates(["transition_id"])
    sound = F.coalesce(all_finite(F.col("state")) & all_finite(F.col("action")) & (F.size("state") == 17) & (F.size("action") == 17), F.lit(False))
    rows = settle(rows.withColumn("sound", sound), "rows")
    # an export's episodes have no gaps: frames count the sound rows
    numbered = neighbour(settle(row_index(rows.where("sound"), "episode_id", "tick", "frame"), "frames"), "episode_id", "tick", {"later": "tick"}, after=True)
    image = lambda name, frame: F.when(F.col(frame) >= 0, F.format_string(f"{name}/%06d.png", F.col(frame)))
    lines = numbered.select(
        (F.col("frame") / F.lit(30.0)).alias("t"), image("image_top", "head_rgb_frame_index").alias("image_top"), image("image_hand", "wrist_rgb_frame_index").alias("image_hand"), F.lit(None).cast("string").alias("depth_top"),
        F.lit(None).cast("string").alias("depth_hand"), F.col("state").alias("joint_pos"), "action", F.col("later").isNull().cast("int").alias("success"), "episode_id", "frame")
    path = scratch_path(spark, "lines")
    publish(lines, path, fmt="json", options={"ignoreNullFields": "false"})
    back = read_jsonl(spark, path, LINE)
    per = back.groupBy(F.col("episode_id").alias("b_episode")).agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.max("t"), 6).alias("last_t"), F.count("image_top").alias("top_images"), F.count("image_hand").alias("hand_images"), F.count("depth_top").alias("depths"),
        F.count_if((F.size("joint_pos") == 17) & (F.size("action") == 17)).alias("vectors"), F.sum("success").alias("successes"), F.max_by("success", "frame").alias("last_success"))
    refused = rows.groupBy("episode_id").agg(F.count_if(~F.col("sound")).alias("refused"))
    met = refused.join(per, F.col("episode_id") == F.col("b_episode"), "left")
    return met.select("episode_id", "refused", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lines", "top_images", "hand_images", "depths", "vectors", "successes")], "last_t", "last_success")


def provenance_report(spark: SparkSession, folder: str) -> DataFrame:
    """Exported runs whose provenance breaks each rule, 0 where none does."""
    rows = table(spark, folder, "source_provenance").select("provenance_id", "source_episode_id", "source_start_index", "source_end_index", "transition_count", "task_instruction", "task_instruction_sha256").distinct()
    rules = provenance_rules()
    return rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]).unpivot([], list(rules), "rule", "runs")


def run_identities(spark: SparkSession, folder: str) -> DataFrame:
    """The sha256 of each run's canonical JSON identity, and how many runs share it."""
    rows = table(spark, folder, "source_provenance").select("provenance_id", "raw_sha256", "source_episode_id", "source_start_index", "source_end_index", "task_instruction_sha256").distinct()
    fields = {"raw_sha256": "raw_sha256", "episode_id": "source_episode_id", "start": "source_start_index", "end": "source_end_index", "task_sha256": "task_instruction_sha256"}
    keyed = settle(rows.select("provenance_id", F.sha2(canonical_object({k: F.col(c) for k, c in fields.items()}, rows.select(*[F.col(c).alias(k) for k, c in fields.items()]).schema), 256).alias("identity")), "identities")
    shared = keyed.groupBy(F.col("identity").alias("i")).agg(F.count(F.lit(1)).alias("runs"))
    return keyed.join(shared, F.col("identity") == F.col("i")).select("provenance_id", "identity", "runs")


def mismatch_examples(spark: SparkSession, folder: str) -> DataFrame:
    """Paths whose listings by the smallest and by the largest size and digest ever delivered differ: the first five of each kind (a short report)."""
    files = table(spark, folder, "media_files").where("rgb_path is not null")
    both = settle(files.groupBy(F.col("rgb_path").alias("path")).agg(*[f(c).alias(f"{n}_{c}") for n, f in (("lo", F.min), ("hi", F.max)) for c in ("n_bytes", "content_digest")]), "paths")
    side = lambda n: both.select("path", F.col(f"{n}_n_bytes").alias("size"), F.col(f"{n}_content_digest").alias("digest"))
    differing = settle(compare_manifests(side("lo"), side("hi")).where("status <> 'SAME'"), "differing")
    parts = [differing.where(F.col("status") == status).orderBy("path").limit(5) for status in ("DIFFERENT", "MISSING", "EXTRA")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("status", "path")


def redacted_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with three planted secrets behind them, redacted: marks set, and the digest of what is left."""
    planted = F.concat(F.coalesce("text", F.lit("")), F.lit("\nexport API_KEY=s3cret Bearer abc.def hf_0123456789abcdef"))
    clean = table(spark, folder, "documents").select("doc_id", redact(planted).alias("clean"))
    return clean.select("doc_id", F.expr("(length(clean) - length(replace(clean, '[REDACTED]', ''))) / 10").cast("long").alias("marks"), F.md5("clean").alias("digest"))


def published_files(spark: SparkSession, folder: str) -> DataFrame:
    """The line items published in many files and listed: rows by content and by listing, names met once, digests of full length."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    path = scratch_path(spark, "items")
    publish(rows.repartition(16, "l_orderkey"), path)
    listed = settle(file_listing(spark, path, "*.parquet"), "listing")
    files = listed.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.length("sha256") == 64).alias("hashed"), F.count_if(F.col("size") > 0).alias("filled")).first()
    names = listed.select("relative_path").distinct().count()
    stored = spark.read.parquet(path)
    return stored.agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double"), 2).alias("total"), F.lit(names == files["files"]).alias("names_differ"),
        F.lit(files["hashed"] == files["files"]).alias("all_hashed"), F.lit(files["filled"] == files["files"]).alias("all_filled"))


def frozen_tail(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: the rows since its head camera's time last changed, and whether it still stood still at the end."""
    rows = ticks(spark, folder).where("episode_id is not null").select("episode_id", "tick", "head_ts")
    runs = islands(rows, "episode_id", "tick", ~F.col("head_ts").eqNullSafe(F.col("_h")), "run", {"_h": "head_ts"}).groupBy("episode_id", "run").agg(F.count(F.lit(1)).alias("n"))
    return runs.groupBy("episode_id").agg(F.max_by("n", "run").alias("tail")).withColumn("still", F.col("tail") > 1)


def queries() -> dict:
    return {f.__name__: f for f in (export_plan, export_summary, export_check, frame_storage, frame_lines, provenance_report, run_identities, mismatch_examples, redacted_texts, published_files, frozen_tail)}


_SPLIT = f"""{_RUNS}, eps AS (SELECT DISTINCT episode_id FROM named), sp AS (SELECT episode_id, CASE WHEN row_number() OVER (ORDER BY sha256('{SEED}:' || episode_id), episode_id) <= floor(count(*) OVER () * {FRACTION}) THEN 'val' ELSE 'train' END AS split FROM eps),
pl AS (SELECT n.*, split, end_row - start_row AS frames FROM named n JOIN sp USING (episode_id))"""


def oracle_sql() -> dict[str, str]:
    text = r"coalesce(text, '') || chr(10) || 'export API_KEY=s3cret Bearer abc.def hf_0123456789abcdef'"
    steps = (
        ("hf_[A-Za-z0-9]{10,}", "[REDACTED]"), (r"(?i)Bearer\s+[^\s\"'']+", "Bearer [REDACTED]"), (r"(?i)(Authorization\s*[:=]\s*)[^\s\"'']+", r"\1[REDACTED]"), (r"(?i)\b([A-Z0-9_]*(?:TOKEN|SECRET|PASSWORD|API_KEY))\s*=\s*[^\s]+", r"\1=[REDACTED]"))
    for pattern, by in steps:
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    json = lambda c: f"coalesce(to_json({c})::VARCHAR, 'null')"
    vec = "transition_id, episode_id, source_tick_index AS tick, state17 AS state, action17 AS action, head_rgb_frame_index AS hf, wrist_rgb_frame_index AS wf"
    ok = lambda v: f"{v} IS NOT NULL AND len({v}) = 17 AND len(list_filter({v}, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    return {
        "export_plan": f"WITH {_SPLIT} SELECT run_id, episode_id, split, row_number() OVER w - 1 AS episode_index, coalesce(sum(frames) OVER (PARTITION BY split ORDER BY episode_id, start_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_frame, frames FROM pl WINDOW w AS (PARTITION BY split ORDER BY episode_id, start_row)",
        "export_summary": f"WITH {_SPLIT} SELECT split, count(DISTINCT episode_id) AS episodes, count(*) AS runs, sum(frames)::BIGINT AS frames FROM pl GROUP BY 1",
        "export_check": f"WITH {_SPLIT} SELECT 'OK' AS status, count(*) AS runs, sum(frames)::BIGINT AS frames FROM pl HAVING count(*) > 0",
        "frame_storage": """WITH t AS (SELECT DISTINCT transition_id, regexp_extract(episode_id, '(\\d+)$', 1)::BIGINT AS e, list_filter(action17, lambda x: x IS NOT NULL) AS v FROM transitions WHERE episode_id IS NOT NULL),
f AS (SELECT *, v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: NOT isfinite(x) OR abs(x) > 3.4028235e38)) = 0 AS fits FROM t)
SELECT e AS episode_index, count(*) FILTER (fits) AS stored, count(*) FILTER (NOT fits) AS refused, coalesce(sum(len(v)) FILTER (fits), 0)::BIGINT AS elements, true AS faithful FROM f GROUP BY 1""",
        "frame_lines": f"""WITH t AS (SELECT DISTINCT {vec} FROM transitions WHERE episode_id IS NOT NULL), s AS (SELECT *, {ok('state')} AND {ok('action')} AS sound FROM t),
n AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY tick) - 1 AS frame FROM s WHERE sound), a AS (SELECT episode_id, count(*) FILTER (NOT sound) AS refused FROM s GROUP BY 1),
b AS (SELECT episode_id, count(*) AS lines, count(*) FILTER (hf >= 0) AS top_images, count(*) FILTER (wf >= 0) AS hand_images, count(*) AS vectors, round(max(frame) / 30.0, 6) AS last_t FROM n GROUP BY 1)
SELECT episode_id, refused, coalesce(lines, 0) AS lines, coalesce(top_images, 0) AS top_images, coalesce(hand_images, 0) AS hand_images, 0::BIGINT AS depths, coalesce(vectors, 0) AS vectors, CASE WHEN lines > 0 THEN 1 ELSE 0 END::BIGINT AS successes, last_t, CASE WHEN lines > 0 THEN 1 END::INT AS last_success
FROM a LEFT JOIN b USING (episode_id)""",
        "provenance_report": """WITH r AS (SELECT DISTINCT provenance_id, source_episode_id AS e, source_start_index AS a, source_end_index AS b, transition_count AS n, task_instruction AS t, task_instruction_sha256 AS h FROM source_provenance)
SELECT 'EPISODE_MISSING' AS rule, count(*) FILTER (e IS NULL) AS runs FROM r UNION ALL SELECT 'TASK_EMPTY', count(*) FILTER (coalesce(trim(t), '') = '') FROM r UNION ALL SELECT 'TASK_HASH_MISMATCH', count(*) FILTER (h IS DISTINCT FROM sha256(t)) FROM r
UNION ALL SELECT 'START_NEGATIVE', count(*) FILTER (a < 0) FROM r UNION ALL SELECT 'END_NOT_AFTER_START', count(*) FILTER (b <= a) FROM r UNION ALL SELECT 'COUNT_MISMATCH', count(*) FILTER (b - a <> n) FROM r""",
        "run_identities": f"""WITH r AS (SELECT DISTINCT provenance_id, raw_sha256, source_episode_id, source_start_index, source_end_index, task_instruction_sha256 FROM source_provenance),
k AS (SELECT provenance_id, sha256('{{"end": ' || {json('source_end_index')} || ', "episode_id": ' || {json('source_episode_id')} || ', "raw_sha256": ' || {json('raw_sha256')} || ', "start": ' || {json('source_start_index')} || ', "task_sha256": ' || {json('task_instruction_sha256')} || '}}') AS identity FROM r)
SELECT provenance_id, identity, count(*) OVER (PARTITION BY identity) AS runs FROM k""",
        "mismatch_examples": "WITH p AS (SELECT rgb_path AS path FROM media_files WHERE rgb_path IS NOT NULL GROUP BY 1 HAVING min(n_bytes) <> max(n_bytes) OR min(content_digest) <> max(content_digest)) SELECT 'DIFFERENT' AS status, path FROM p ORDER BY path LIMIT 5",
        "redacted_texts": f"WITH c AS (SELECT doc_id, {text} AS c FROM documents) SELECT doc_id, (length(c) - length(replace(c, '[REDACTED]', ''))) // 10 AS marks, md5(c) AS digest FROM c",
        "published_files": "SELECT count(*) AS rows, round(sum(l_extendedprice::DECIMAL(18,2))::DOUBLE, 2) AS total, true AS names_differ, true AS all_hashed, true AS all_filled FROM lineitem",
        "frozen_tail": f"""WITH {TICKS}, o AS (SELECT episode_id, tick, head_ts, CASE WHEN row_number() OVER w = 1 OR head_ts IS DISTINCT FROM lag(head_ts) OVER w THEN 1 ELSE 0 END AS b FROM ticks WHERE episode_id IS NOT NULL WINDOW w AS (PARTITION BY episode_id ORDER BY tick)),
r AS (SELECT episode_id, sum(b) OVER (PARTITION BY episode_id ORDER BY tick) AS run FROM o), c AS (SELECT episode_id, run, count(*) AS n FROM r GROUP BY ALL)
SELECT episode_id, arg_max(n, run) AS tail, arg_max(n, run) > 1 AS still FROM c GROUP BY 1""",
    }
