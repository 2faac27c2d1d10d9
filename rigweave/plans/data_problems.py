"""Queries for the general data problems: implausible readings (2) and small files (3)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigweave.operators.hilbert import cluster, same_record_pairs, write_shards
from rigweave.operators.spikes import Series, SpikeRules, find_implausible, pack_rows, profile
from rigweave.session import scratch_path, settle

JOINTS = 17
#: A camera time more than an hour behind its tick is no time of that tick.
LONGEST_LAG_NS = 3_600_000_000_000
CAMERA_RULES = SpikeRules(fence=1.0, high=0.95)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vector_series(spark: SparkSession, folder: str) -> Series:
    """state17 and action17 with the limits of joint_limits; a joint without limits has none."""
    known = {r["joint"]: (r["lower_rad"], r["upper_rad"]) for r in _table(spark, folder, "joint_limits").collect()}
    lower = [known.get(j, (-math.inf, math.inf))[0] for j in range(JOINTS)]
    upper = [known.get(j, (-math.inf, math.inf))[1] for j in range(JOINTS)]
    return Series(("state17",) * JOINTS + ("action17",) * JOINTS, tuple(range(JOINTS)) * 2, tuple(lower * 2), tuple(upper * 2))


def vector_rows(spark: SparkSession, folder: str) -> DataFrame:
    t = _table(spark, folder, "transitions")
    at = F.coalesce("arm_action_timestamp_ns", "hand_action_timestamp_ns", "arm_pre_timestamp_ns", "head_timestamp_ns")
    return t.select(
        F.col("transition_id").alias("ident"), F.col("episode_id").alias("owner"), F.col("source_tick_index").alias("seq"), F.col("rig_id").alias("source"),
        (F.floor(at / F.lit(3_600_000_000_000)) % 24).cast("int").alias("hour"), F.lit(0).cast("long").alias("raw"), F.col("state17").alias("v_state"), F.col("action17").alias("v_action"))


def camera_rows(spark: SparkSession, folder: str) -> DataFrame:
    t = _table(spark, folder, "raw_ticks")
    camera = F.when(F.col("head_camera_host_timestamp_ns") != 0, F.col("head_camera_host_timestamp_ns"))
    return t.select(
        F.col("tick_id").alias("ident"), F.col("episode_id").alias("owner"), F.col("tick_index").alias("seq"), F.col("rig_id").alias("source"),
        (F.floor(F.col("timestamp_ns") / F.lit(3_600_000_000_000)) % 24).cast("int").alias("hour"), camera.alias("raw"), (F.col("timestamp_ns") - camera).cast("double").alias("v_lag"))


def camera_series() -> Series:
    return Series(("head_camera_host_timestamp_ns",), (-1,), (0.0,), (float(LONGEST_LAG_NS),), lag=True)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every implausible reading of both vectors and of the head camera's time."""
    vectors = find_implausible(vector_rows(spark, folder), vector_series(spark, folder))
    return vectors.unionByName(find_implausible(camera_rows(spark, folder), camera_series(), CAMERA_RULES))


def p2_profile(spark: SparkSession, folder: str) -> DataFrame:
    """What is normal for each rig: largest step and longest run of each series."""
    series, rules = vector_series(spark, folder), SpikeRules()
    packed = pack_rows(vector_rows(spark, folder).where("owner is not null and seq is not null"), series, rules)
    names = F.array(*[F.lit(n) for n in series.names])
    table = profile(packed, series, rules).select("source", F.posexplode(F.arrays_zip("normal_step", "normal_run")).alias("s", "n"))
    return table.select(F.col("source").alias("rig_id"), names[F.col("s")].alias("field_name"), (F.col("s") % JOINTS).alias("joint"), "n.normal_step", "n.normal_run")


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    capacity = _table(spark, folder, "pack_config").where("container_kind = 'media_shard'").first()["capacity"]
    files = _table(spark, folder, "media_files").select("file_id", F.col("rgb_path").alias("path"), "n_bytes", F.col("content_digest").alias("digest"))
    return cluster(files, capacity)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of files that hold the same record."""
    return same_record_pairs(_shards(spark, folder))


def p3_members(spark: SparkSession, folder: str) -> DataFrame:
    """Each file once, with the file that stands for its record and the number of files that hold it."""
    return _shards(spark, folder).select("file_id", "keeper_id", "copies")


def p3_balance(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the shards: files, records kept, shards beyond the least number, shards that exceed the size by a whole record."""
    capacity = _table(spark, folder, "pack_config").where("container_kind = 'media_shard'").first()["capacity"]
    rows = settle(_shards(spark, folder), "sharded")
    per = rows.where("keeper").groupBy("shard_id").agg(F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"))
    totals = per.agg(F.sum("records").alias("records"), (F.count(F.lit(1)) - F.ceil(F.sum("bytes") / F.lit(capacity))).alias("surplus"), F.count_if(F.col("bytes") > capacity + F.col("largest")).alias("too_large"))
    return totals.select(F.lit(rows.count()).cast("long").alias("files"), "records", "surplus", "too_large")


def p3_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Each shard's number of records, bytes and stretch of the curve."""
    return _shards(spark, folder).where("keeper").groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"), F.min("code").alias("first_code"), F.max("code").alias("last_code"))


def p3_written(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of the shards as written, after comparison with their source."""
    return write_shards(_shards(spark, folder), scratch_path(spark, "shards"), ["file_id", "episode", "camera", "frame", "digest", "bytes"])


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_profile, p3_found, p3_members, p3_balance, p3_shards, p3_written)}


#: The record's parts are read from the path as it is: the directory before the frame's 'rgb', resolved by what follows it.
RECORD = r"""
  SELECT DISTINCT file_id, content_digest,
    nullif(regexp_extract(p, 'episode[_\- ]?(\d+)(?:_media)?/', 1), '') AS episode,
    CASE WHEN regexp_extract(p, '/([^/]+)/rgb/[^/]*$', 1) IN ('right_wrist', 'wrist') THEN 'wrist' ELSE nullif(regexp_extract(p, '/([^/]+)/rgb/[^/]*$', 1), '') END AS camera,
    nullif(regexp_extract(p, '/(\d+)(?: ?\(\d+\))?\.jpe?g$', 1), '')::BIGINT AS frame
  FROM (SELECT file_id, content_digest, replace(regexp_replace(regexp_replace(lower(trim(replace(rgb_path, '\', '/'))), '/(\./)+', '/', 'g'), '/{2,}', '/', 'g'), 'rgb/../', '') AS p FROM media_files)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"""
WITH r AS ({RECORD}),
k AS (SELECT file_id, content_digest, episode::BIGINT AS episode, camera, frame FROM r WHERE episode IS NOT NULL AND camera IS NOT NULL AND frame IS NOT NULL AND content_digest IS NOT NULL)
SELECT DISTINCT a.file_id, b.file_id AS other_file_id FROM k a JOIN k b USING (episode, camera, frame, content_digest) WHERE a.file_id < b.file_id""",
        "p3_members": f"""
WITH r AS ({RECORD}),
k AS (SELECT file_id, CASE WHEN episode IS NULL OR camera IS NULL OR frame IS NULL OR content_digest IS NULL THEN '#' || file_id ELSE concat_ws('|', episode::BIGINT, camera, frame, content_digest) END AS record FROM r)
SELECT file_id, min(file_id) OVER (PARTITION BY record) AS keeper_id, count(*) OVER (PARTITION BY record) AS copies FROM k""",
        "p3_balance": f"""
WITH r AS ({RECORD}),
k AS (SELECT file_id, CASE WHEN episode IS NULL OR camera IS NULL OR frame IS NULL OR content_digest IS NULL THEN '#' || file_id ELSE concat_ws('|', episode::BIGINT, camera, frame, content_digest) END AS record FROM r)
SELECT count(DISTINCT file_id) AS files, count(DISTINCT record)::BIGINT AS records, 0::BIGINT AS surplus, 0::BIGINT AS too_large FROM k""",
    }
