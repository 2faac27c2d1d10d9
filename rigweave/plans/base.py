"""The test tables as the operators read them: redelivered rows once, columns pruned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Sampler rows: one per tick, redelivery removed."""
    return table(spark, folder, "raw_ticks").select(
        "tick_id", "episode_id", "rig_id", F.col("tick_index").alias("tick"), F.col("timestamp_ns").alias("ts_ns"),
        F.col("head_camera_host_timestamp_ns").alias("head_ts"), F.col("head_camera_valid").alias("head_valid"), F.col("head_rgb_frame_index").alias("head_frame"),
        F.col("wrist_camera_host_timestamp_ns").alias("wrist_ts"), F.col("wrist_camera_valid").alias("wrist_valid"), F.col("wrist_rgb_frame_index").alias("wrist_frame")).distinct()


TICKS = """ticks AS (SELECT DISTINCT tick_id, episode_id, rig_id, tick_index AS tick, timestamp_ns AS ts_ns, head_camera_host_timestamp_ns AS head_ts, head_camera_valid AS head_valid,
  head_rgb_frame_index AS head_frame, wrist_camera_host_timestamp_ns AS wrist_ts, wrist_camera_valid AS wrist_valid, wrist_rgb_frame_index AS wrist_frame FROM raw_ticks)"""


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Channel samples with their eligibility: valid, a positive time, and for cameras a frame."""
    camera = F.col("channel").isin("head", "wrist")
    ok = F.coalesce(F.col("valid") & (F.col("timestamp_ns") > 0) & (~camera | (F.col("frame_index") >= 0)), F.lit(False))
    return table(spark, folder, "channel_samples").select("sample_id", "episode_id", "channel", F.col("timestamp_ns").alias("ts"), "frame_index", ok.alias("eligible")).distinct()


SAMPLES = """samples AS (SELECT DISTINCT sample_id, episode_id, channel, timestamp_ns AS ts, frame_index,
  coalesce(valid AND timestamp_ns > 0 AND (channel NOT IN ('head', 'wrist') OR frame_index >= 0), false) AS eligible FROM channel_samples)"""

TIMES = ("arm_pre_timestamp_ns", "hand_pre_timestamp_ns", "arm_action_timestamp_ns", "hand_action_timestamp_ns", "head_timestamp_ns", "wrist_timestamp_ns")


def moves(spark: SparkSession, folder: str) -> DataFrame:
    """Transitions without their vectors."""
    return table(spark, folder, "transitions").select(
        "transition_id", "episode_id", "rig_id", F.col("source_tick_index").alias("tick"), F.col("next_state_tick_index").alias("next_tick"), *TIMES, "head_rgb_frame_index", "wrist_rgb_frame_index").distinct()


MOVES = """moves AS (SELECT DISTINCT transition_id, episode_id, rig_id, source_tick_index AS tick, next_state_tick_index AS next_tick, arm_pre_timestamp_ns, hand_pre_timestamp_ns,
  arm_action_timestamp_ns, hand_action_timestamp_ns, head_timestamp_ns, wrist_timestamp_ns, head_rgb_frame_index, wrist_rgb_frame_index FROM transitions)"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Transitions with both vectors; of redelivered rows any one, as they are equal."""
    return table(spark, folder, "transitions").select(
        "transition_id", "episode_id", F.col("source_tick_index").alias("tick"), F.col("next_state_tick_index").alias("next_tick"), "arm_pre_timestamp_ns", "hand_pre_timestamp_ns",
        F.col("state17").alias("state"), F.col("action17").alias("action")).dropDuplicates(["transition_id"])


VECTORS = """vectors AS (SELECT DISTINCT transition_id, episode_id, source_tick_index AS tick, next_state_tick_index AS next_tick, arm_pre_timestamp_ns, hand_pre_timestamp_ns,
  state17 AS state, action17 AS action FROM transitions)"""


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Channel samples for as-of joins, where a sample that arrived again changes nothing and need not be removed."""
    camera = F.col("channel").isin("head", "wrist")
    ok = F.coalesce(F.col("valid") & (F.col("timestamp_ns") > 0) & (~camera | (F.col("frame_index") >= 0)), F.lit(False))
    return table(spark, folder, "channel_samples").select("sample_id", "episode_id", "channel", F.col("timestamp_ns").alias("ts"), "frame_index", ok.alias("eligible"))


def interventions(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame:
    """Stretches of at least two ticks whose head camera flag is false, as closed intervals of tick times."""
    from rigweave.operators.sequence import islands

    bad = (ticks(spark, folder) if known is None else known).select("episode_id", "tick", "ts_ns", (~F.coalesce("head_valid", F.lit(True))).alias("bad"))
    runs = islands(bad, "episode_id", "tick", F.col("bad") != F.col("_bad"), "run", {"_bad": "bad"})
    return runs.where("bad").groupBy("episode_id", "run").agg(F.min("ts_ns").alias("start_ns"), F.max("ts_ns").alias("end_ns"), F.count(F.lit(1)).alias("n")).where("n >= 2 and start_ns < end_ns").select("episode_id", "start_ns", "end_ns")


INTERVENTIONS = """marked AS (SELECT episode_id, tick, ts_ns, NOT coalesce(head_valid, true) AS bad, row_number() OVER (PARTITION BY episode_id ORDER BY tick) - row_number() OVER (PARTITION BY episode_id, NOT coalesce(head_valid, true) ORDER BY tick) AS grp FROM ticks),
interventions AS (SELECT episode_id, min(ts_ns) AS start_ns, max(ts_ns) AS end_ns FROM marked WHERE bad GROUP BY episode_id, grp HAVING count(*) >= 2 AND min(ts_ns) < max(ts_ns))"""


def media(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct stored frames: episode_id, role (head, wrist) and frame_index, by any spelling of the path."""
    from rigweave.operators.hilbert import with_record

    named = with_record(table(spark, folder, "media_files").select("rgb_path"), "rgb_path")
    rows = named.select(F.col("episode").alias("e"), F.col("camera").alias("role"), F.col("frame").alias("frame_index")).where("e is not null and role is not null and frame_index is not null")
    return rows.select(F.concat(F.lit("episode_"), F.lpad(F.col("e").cast("string"), 6, "0")).alias("episode_id"), "role", "frame_index").distinct()


MEDIA = r"""media AS (SELECT DISTINCT 'episode_' || lpad(e, 6, '0') AS episode_id, role, frame_index FROM (
  SELECT nullif(regexp_extract(p, 'episode[_\- ]?(\d+)(?:_media)?/', 1), '')::BIGINT::VARCHAR AS e,
    CASE WHEN regexp_extract(p, '/([^/]+)/rgb/[^/]*$', 1) IN ('right_wrist', 'wrist') THEN 'wrist' ELSE nullif(regexp_extract(p, '/([^/]+)/rgb/[^/]*$', 1), '') END AS role,
    nullif(regexp_extract(p, '/(\d+)(?: ?\(\d+\))?\.jpe?g$', 1), '')::BIGINT AS frame_index
  FROM (SELECT replace(regexp_replace(regexp_replace(lower(trim(replace(rgb_path, '\', '/'))), '/(\./)+', '/', 'g'), '/{2,}', '/', 'g'), 'rgb/../', '') AS p FROM media_files))
  WHERE e IS NOT NULL AND role IS NOT NULL AND frame_index IS NOT NULL)"""
