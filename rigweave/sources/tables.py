"""Exported tables: chunked frame layout, JSON lines, listings, and publishing that never shows half a result."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A file of frames holds a multiple of 2**BLOCK_BITS frames of an episode at most.
BLOCK_BITS = 16


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines by an explicit schema; blank lines are skipped, a malformed one fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_frames(frames: DataFrame, path: str, chunk_size: int = 1000) -> None:
    """Frame tables under chunk=NNN/episode=NNNNNN; `frames` has episode_index. Nothing is overwritten.

    A long episode is written in blocks of frames, each by a task and to a file of its own.
    """
    rows = frames.withColumn("chunk", F.format_string("%03d", F.floor(F.col("episode_index") / chunk_size).cast("long"))).withColumn("episode", F.format_string("%06d", "episode_index"))
    rows = rows.repartition("chunk", "episode", F.shiftright(F.col("frame_index").cast("long"), BLOCK_BITS)).sortWithinPartitions("chunk", "episode", "frame_index")
    rows.write.mode("errorifexists").partitionBy("chunk", "episode").parquet(path)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frame tables with their chunk and episode as partition columns, so that both prune."""
    return spark.read.option("basePath", path).parquet(path)


def file_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """relative_path, size, sha256 of every file. Files are read whole by a task each: meant for metadata and shards."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    relative = F.regexp_replace("path", "^.*" + path.rstrip("/").rsplit("/", 1)[-1] + "/", "")
    return files.select(relative.alias("relative_path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def assert_separate(inputs: list[str], output: str) -> None:
    """Refuse an output that lies inside an input or holds one."""
    plain = lambda p: re.sub(r"^file:/*", "/", p).rstrip("/") + "/"
    for given in inputs:
        if plain(output).startswith(plain(given)) or plain(given).startswith(plain(output)):
            raise ValueError(f"{output} and {given} overlap")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A JSON report by its schema; one that is absent or broken is empty."""
    fs, target, _ = _fs(spark, path)
    if not fs.exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def content_mark(df: DataFrame) -> tuple:
    """Row count and order-free digest of a table: the same before and after a job if its input did not change."""
    h = F.xxhash64(*df.columns)
    return tuple(df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def publish(df: DataFrame, path: str, check=None, fmt: str = "parquet", replace: bool = False, options: dict[str, str] | None = None, inputs: list[Callable[[], DataFrame]] | None = None) -> None:
    """Write to a staging folder, check what was written, then rename; an existing result is kept unless `replace`.

    `check(df_as_written)` raises to refuse. `inputs`, each read afresh by its call, are marked before the write and
    again before the rename: a change refuses the result. With `replace`, the old result is moved aside and comes back if the rename fails.
    """
    spark = df.sparkSession
    marks = [content_mark(read()) for read in inputs or []]
    fs, target, Path = _fs(spark, path)
    if fs.exists(target) and not replace:
        raise FileExistsError(path)
    stage, old = Path(path + ".staging"), Path(path + ".previous")
    fs.delete(stage, True)
    df.write.format(fmt).options(**(options or {})).save(path + ".staging")
    try:
        if check is not None:
            check(spark.read.format(fmt).schema(df.schema).load(path + ".staging"))
        if [content_mark(read()) for read in inputs or []] != marks:
            raise RuntimeError("an input changed while its result was made")
        if fs.exists(target):
            fs.delete(old, True)
            if not fs.rename(target, old):
                raise OSError(f"cannot move {path} aside")
        if not fs.rename(stage, target):
            if fs.exists(old):
                fs.rename(old, target)
            raise OSError(f"cannot publish {path}")
        fs.delete(old, True)
    except BaseException:
        fs.delete(stage, True)
        raise


def write_report(df: DataFrame, path: str) -> None:
    """A small report as one CSV with a header."""
    df.coalesce(1).write.mode("errorifexists").option("header", "true").csv(path)
