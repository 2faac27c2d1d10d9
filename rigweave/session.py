"""Session defaults and the shared places a job may write to."""

from __future__ import annotations

import atexit
import contextlib
import math
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of data that one task of a shuffle is meant to read.
TASK_BYTES = 64 * 2**20
_written: list[str] = []


def build_session(app: str = "rigweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE and Arrow on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where the session names none, a temporary one serves a local master only.

    On a cluster a machine-local folder would keep each executor's part on its own disk, so that is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        current = context._jsc.sc().getCheckpointDir()
        folder = current.get() if current.isDefined() else None
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="rigweave-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    elif context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for a table that outlives executors; clear_scratch removes it."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that no later step reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    with contextlib.suppress(ValueError):
        _written.remove(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every scratch table of this process: call it when the results of its queries have been used."""
    for path in list(_written):
        discard(spark, path)


@atexit.register
def _clear_at_exit() -> None:
    """What a finished driver left in a folder of a mounted file system goes; other file systems need clear_scratch."""
    for path in _written:
        if "://" not in path or path.startswith("file:"):
            shutil.rmtree(re.sub(r"^file:/*", "/", path), ignore_errors=True)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: lineage is cut and a lost executor costs nothing.

    Written as Parquet rather than by checkpoint(), so that later stages keep column pruning and size statistics.
    """
    return settle_at(df, label)[0]


def settle_at(df: DataFrame, label: str = "settled") -> tuple[DataFrame, str]:
    """settle, with the path for discard."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def tasks_for(df: DataFrame, growth: float = 1.0) -> int:
    """How many tasks a shuffle of `df` needs so that each reads about TASK_BYTES, by the plan's size estimate.

    growth: bytes shuffled for a byte of the estimate. Never fewer than spark.sql.shuffle.partitions.
    """
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # an estimate beyond any data means that the plan does not know
    wanted = math.ceil(size * growth / TASK_BYTES) if size < 2**58 else 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(100_000, wanted))
