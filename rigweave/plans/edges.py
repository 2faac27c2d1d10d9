"""Queries that go through files: layouts, publishing, listings and an append-only stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigweave.functions.arrays import to_float32
from rigweave.plans.base import table
from rigweave.sources.tables import file_listing, publish, read_frames, read_jsonl, write_frames
from rigweave.session import scratch_path
from rigweave.streaming.append import append_once


def frame_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Transitions written as chunked frame tables and read back: frames and partitions by episode."""
    rows = table(spark, folder, "transitions").where("episode_id is not null").select(
        "transition_id", F.regexp_extract("episode_id", r"(\d+)$", 1).cast("long").alias("episode_index"), F.col("source_tick_index").alias("frame_index"), to_float32(F.col("action17")).alias("action")).dropDuplicates(["transition_id"])
    path = scratch_path(spark, "frames")
    write_frames(rows, path, 100)
    return read_frames(spark, path).groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames"), F.max(F.col("chunk").cast("long")).alias("chunk"), F.max(F.col("episode").cast("long")).alias("episode"), F.round(F.sum(F.col("action")[0].cast("double")), 3).alias("total"))


def published(spark: SparkSession, folder: str) -> DataFrame:
    """Provenance published as JSON lines after a check of its row count, and read by an explicit schema."""
    rows = table(spark, folder, "source_provenance").select("provenance_id", "curated_path", "transition_count").distinct()
    wanted = rows.count()
    path = scratch_path(spark, "published")

    def check(written: DataFrame) -> None:
        if written.count() != wanted:
            raise RuntimeError("rows were lost")

    publish(rows, path, check, "json")
    return read_jsonl(spark, path, rows.schema)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Number and size of the files of a published table, by an order-free digest check."""
    path = scratch_path(spark, "listed")
    publish(table(spark, folder, "nation").coalesce(1), path)
    return file_listing(spark, path, "*.parquet").agg(F.count(F.lit(1)).alias("files"), F.count_if(F.length("sha256") == 64).alias("hashed"))


def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks streamed into a table, each tick_id once, then counted by episode."""
    source, target = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    rows = table(spark, folder, "raw_ticks").select("tick_id", "episode_id", "timestamp_ns")
    rows.write.parquet(source)
    append_once(spark, source, rows.schema, target, scratch_path(spark, "stream-state"), "tick_id").awaitTermination()
    return spark.read.parquet(target).groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict:
    return {f.__name__: f for f in (frame_layout, published, listing, stream_append)}


def oracle_sql() -> dict[str, str]:
    return {
        "frame_layout": """WITH t AS (SELECT DISTINCT transition_id, regexp_extract(episode_id, '(\\d+)$', 1)::BIGINT AS e, action17[1]::FLOAT::DOUBLE AS a FROM transitions WHERE episode_id IS NOT NULL)
SELECT e AS episode_index, count(*) AS frames, e // 100 AS chunk, e AS episode, round(sum(CASE WHEN abs(a) < 100 THEN a END), 3) AS total FROM t GROUP BY 1""",
        "published": "SELECT DISTINCT provenance_id, curated_path, transition_count FROM source_provenance",
        "stream_append": "SELECT episode_id, count(DISTINCT tick_id) AS n FROM raw_ticks GROUP BY 1",
    }
