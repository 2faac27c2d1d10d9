"""Exact ranks inside groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a group: so many rows each, within bounds.
PART_ROWS, FEWEST_BITS, MOST_BITS = 250_000, 8, 20


def seeded_hash(seed: int, *columns: str | Column) -> Column:
    """A 63-bit non-negative hash that depends only on the seed and the values."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def spread_rank(df: DataFrame, keys: list[str], order: str, tie: list[str], rank: str = "rank", rows: int | None = None) -> DataFrame:
    """Add the 0-based rank of each row inside its group, by `order` (a 63-bit hash) and then `tie`.

    The hash's leading bits cut every group into parts, 256 or, where `rows` tells that there are many, as many as keep a part
    near PART_ROWS even if one group holds all; the parts' counts, pre-aggregated before the shuffle, give each part's
    offset, and only rows of one part meet in one task, so a hot group is ranked by many tasks.
    Null keys form a group; repeated (order, tie) get distinct ranks in no fixed order. Columns
    named __rk_* are the helper's own.
    """
    bits = min(MOST_BITS, max(FEWEST_BITS, ((rows or 0) // PART_ROWS).bit_length()))
    cut = df.withColumn("__rk_sub", F.shiftright(F.col(order), 63 - bits).cast("int"))
    # keys without nulls, so that the window and the join ask for one and the same partitioning
    plain = {f"__rk_n{i}": F.col(k).isNull() for i, k in enumerate(keys)} | {f"__rk_c{i}": F.coalesce(F.col(k).cast("string"), F.lit("")) for i, k in enumerate(keys)}
    cut = cut.withColumns(plain) if plain else cut
    part = [*plain, "__rk_sub"]
    counts = cut.groupBy(*part).agg(F.count(F.lit(1)).alias("__rk_n"))
    before = Window.partitionBy(*plain).orderBy("__rk_sub").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*[F.col(c).alias(f"{c}_b") for c in part], F.coalesce(F.sum("__rk_n").over(before), F.lit(0)).alias("__rk_base"))
    same = F.lit(True)
    for c in part:
        same = same & (F.col(c) == F.col(f"{c}_b"))
    inside = Window.partitionBy(*part).orderBy(order, *tie)
    return cut.withColumn("__rk_r", F.row_number().over(inside) - 1).join(base, same).withColumn(rank, F.col("__rk_base") + F.col("__rk_r")).select(*df.columns, rank)
