"""Content identity, append-only merges, dense ids and comparison of file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigweave.session import settle




def fingerprint(columns: list[str]) -> Column:
    """sha256 over the values in order; null differs from every text."""
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in columns]), 256)


def append_new(base: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """incoming with action DUPLICATE where the baseline holds its key, else APPEND. Keys are distinct inside each side."""
    known = base.select(F.col(key).alias("__base_key")).distinct()
    met = incoming.join(known, F.col(key) == F.col("__base_key"), "left")
    return met.select(*incoming.columns, F.when(F.col("__base_key").isNull(), "APPEND").otherwise("DUPLICATE").alias("action"))


def dense_ids(rows: DataFrame, order: list[str], name: str, weight: str | None = None, offset: str | None = None) -> DataFrame:
    """Number rows from 0 in a global order, optionally with the running sum of `weight` before each.

    Rows are range-partitioned by the order and written; the parts' counts give each part its base, so that no task sees
    more than its range. The order must tell all rows apart.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = settle(rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    value = F.coalesce(F.col(weight), F.lit(0)) if weight else F.lit(0)
    sums = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__w"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__i0"), F.coalesce(F.sum("__w").over(before), F.lit(0)).alias("__w0"))
    inside = Window.partitionBy("__part").orderBy(*order)
    placed = ranged.withColumn("__i", F.row_number().over(inside) - 1).withColumn("__s", F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = placed.join(base, F.col("__part") == F.col("__p")).withColumn(name, F.col("__i0") + F.col("__i"))
    if offset:
        out = out.withColumn(offset, F.col("__w0") + F.col("__s"))
    return out.select(*rows.columns, name, *([offset] if offset else []))


def compare_manifests(local: DataFrame, remote: DataFrame) -> DataFrame:
    """path and status (SAME, DIFFERENT, MISSING, EXTRA) of listings(path, size, digest)."""
    far = remote.select(F.col("path").alias("__path"), F.col("size").alias("__size"), F.col("digest").alias("__digest"))
    both = local.join(far, F.col("path") == F.col("__path"), "full")
    same = F.col("size").eqNullSafe(F.col("__size")) & F.col("digest").eqNullSafe(F.col("__digest"))
    status = F.when(F.col("__path").isNull(), "MISSING").when(F.col("path").isNull(), "EXTRA").when(same, "SAME").otherwise("DIFFERENT")
    return both.select(F.coalesce("path", "__path").alias("path"), status.alias("status"))
