"""Roll-ups of reports: bit flags, covered frames, merged summaries, translated reasons, resume decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rigweave.functions.flags import from_bits, to_bits
from rigweave.operators.merging import fingerprint
from rigweave.plans.base import MOVES, TICKS, moves, table, ticks

CODES = ["HEAD_TIME_MISSING", "WRIST_TIME_MISSING", "RIG_UNKNOWN", "ARM_TIME_MISSING"]
#: Reason families and what an operator is told of them.
SUMMARIES = (
    (r"^(HEAD|WRIST)_TIME_MISSING$", "a camera gave no time"),
    (r"^ARM_TIME_MISSING$", "the arm gave no time"),
)


def _reasons() -> Column:
    conditions = ("head_timestamp_ns", "wrist_timestamp_ns", "rig_id", "arm_pre_timestamp_ns")
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(code)) for c, code in zip(conditions, CODES)]))


def reason_bits(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: every flag that occurs, as bits, and the number of rows with any."""
    rows = moves(spark, folder).select("episode_id", to_bits(_reasons(), CODES).alias("bits"))
    return rows.groupBy("episode_id").agg(F.bit_or("bits").alias("bits"), F.count_if(F.col("bits") != 0).alias("flagged")).select("episode_id", "bits", "flagged", from_bits(F.col("bits"), CODES).alias("reasons"))


def reason_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by what an operator is told: the first family that fits the code, else unknown."""
    rows = moves(spark, folder).select(F.explode(_reasons()).alias("code"))
    told = F.lit("unknown")
    for pattern, text in reversed(SUMMARIES):
        told = F.when(F.col("code").rlike(pattern), text).otherwise(told)
    return rows.groupBy(told.alias("summary")).agg(F.count(F.lit(1)).alias("n"))


def covered_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Source frames covered by exported runs, by status; equal exports count once."""
    rows = table(spark, folder, "source_provenance").select("provenance_id", "expert_training_status", "source_start_index", "source_end_index").distinct()
    return rows.groupBy(F.coalesce("expert_training_status", F.lit("UNKNOWN")).alias("status")).agg(F.sum(F.col("source_end_index") - F.col("source_start_index")).alias("frames"), F.count(F.lit(1)).alias("runs"))


def merged_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries of single waves merged: counters add up, the mean is weighted and rounded to four places."""
    waves = table(spark, folder, "source_provenance").select("provenance_id", "batch_no", "transition_count").distinct().groupBy("batch_no").agg(F.count(F.lit(1)).alias("runs"), F.sum("transition_count").alias("transitions"))
    return waves.agg(F.count(F.lit(1)).alias("waves"), F.sum("runs").alias("runs"), F.sum("transitions").alias("transitions"), F.round(F.sum("transitions") / F.sum("runs"), 4).alias("mean"))


def dataset_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw preview: episodes, ticks, frames of each camera and their shares, per rig."""
    rows = ticks(spark, folder)
    return rows.groupBy(F.coalesce("rig_id", F.lit("UNKNOWN")).alias("rig")).agg(
        F.count_distinct("episode_id").alias("episodes"), F.count(F.lit(1)).alias("ticks"), F.count_if(F.col("head_frame") >= 0).alias("head"), F.count_if(F.col("wrist_frame") >= 0).alias("wrist"),
        F.round(F.avg((F.col("head_frame") >= 0).cast("double")), 6).alias("head_share"))


def resume(spark: SparkSession, folder: str) -> DataFrame:
    """What a second run would do with each export: skip it where its inputs are unchanged, else process it again."""
    rows = table(spark, folder, "source_provenance").select("provenance_id", "raw_sha256", "transition_count").distinct()
    now = rows.select("provenance_id", fingerprint(["raw_sha256", "transition_count"]).alias("now"))
    before = rows.where("provenance_id % 5 <> 0").select(
        F.col("provenance_id").alias("id"), F.when(F.col("provenance_id") % 7 == 0, F.lit("old")).otherwise(fingerprint(["raw_sha256", "transition_count"])).alias("before"))
    action = F.when(F.col("before").isNull(), "PROCESS").when(F.col("before") == F.col("now"), "SKIP").otherwise("REPROCESS")
    return now.join(before, F.col("provenance_id") == F.col("id"), "left").groupBy(action.alias("action")).agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict:
    return {f.__name__: f for f in (reason_bits, reason_summaries, covered_frames, merged_summary, dataset_counts, resume)}


_R = "list_filter([CASE WHEN head_timestamp_ns IS NULL THEN 'HEAD_TIME_MISSING' END, CASE WHEN wrist_timestamp_ns IS NULL THEN 'WRIST_TIME_MISSING' END, CASE WHEN rig_id IS NULL THEN 'RIG_UNKNOWN' END, CASE WHEN arm_pre_timestamp_ns IS NULL THEN 'ARM_TIME_MISSING' END], lambda x: x IS NOT NULL)"


def oracle_sql() -> dict[str, str]:
    return {
        "reason_bits": f"""WITH {MOVES}, b AS (SELECT episode_id, (head_timestamp_ns IS NULL)::BIGINT + 2 * (wrist_timestamp_ns IS NULL)::BIGINT + 4 * (rig_id IS NULL)::BIGINT + 8 * (arm_pre_timestamp_ns IS NULL)::BIGINT AS bits FROM moves),
o AS (SELECT episode_id, bit_or(bits) AS bits, count(*) FILTER (bits <> 0) AS flagged FROM b GROUP BY 1)
SELECT *, list_filter([CASE WHEN bits & 1 <> 0 THEN 'HEAD_TIME_MISSING' END, CASE WHEN bits & 2 <> 0 THEN 'WRIST_TIME_MISSING' END, CASE WHEN bits & 4 <> 0 THEN 'RIG_UNKNOWN' END, CASE WHEN bits & 8 <> 0 THEN 'ARM_TIME_MISSING' END], lambda x: x IS NOT NULL) AS reasons FROM o""",
        "reason_summaries": f"""WITH {MOVES}, c AS (SELECT unnest({_R}) AS code FROM moves) SELECT CASE WHEN code IN ('HEAD_TIME_MISSING', 'WRIST_TIME_MISSING') THEN 'a camera gave no time' WHEN code = 'ARM_TIME_MISSING' THEN 'the arm gave no time' ELSE 'unknown' END AS summary, count(*) AS n FROM c GROUP BY 1""",
        "covered_frames": "WITH r AS (SELECT DISTINCT provenance_id, expert_training_status AS s, source_start_index AS a, source_end_index AS b FROM source_provenance) SELECT coalesce(s, 'UNKNOWN') AS status, sum(b - a)::BIGINT AS frames, count(*) AS runs FROM r GROUP BY 1",
        "merged_summary": "WITH r AS (SELECT DISTINCT provenance_id, batch_no, transition_count AS t FROM source_provenance) SELECT count(DISTINCT batch_no) AS waves, count(*) AS runs, sum(t)::BIGINT AS transitions, round(sum(t) / count(*), 4) AS mean FROM r",
        "dataset_counts": f"WITH {TICKS} SELECT coalesce(rig_id, 'UNKNOWN') AS rig, count(DISTINCT episode_id) AS episodes, count(*) AS ticks, count(*) FILTER (head_frame >= 0) AS head, count(*) FILTER (wrist_frame >= 0) AS wrist, round(avg((head_frame >= 0)::INT), 6) AS head_share FROM ticks GROUP BY 1",
        "resume": "WITH r AS (SELECT DISTINCT provenance_id, raw_sha256, transition_count FROM source_provenance) SELECT CASE WHEN provenance_id % 5 = 0 THEN 'PROCESS' WHEN provenance_id % 7 = 0 THEN 'REPROCESS' ELSE 'SKIP' END AS action, count(*) AS n FROM r GROUP BY 1",
    }
