"""Reason codes as arrays: all that apply at once, counted once per row and group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(*pairs: tuple[str, Column]) -> Column:
    """Sorted array of the codes whose condition holds; a null condition does not."""
    return F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(condition, F.lit(False)), F.lit(code)) for code, condition in pairs])))


def reason_counts(rejected: DataFrame, column: str = "reasons") -> DataFrame:
    """reason, n: rows with each code."""
    return rejected.select(F.explode(F.array_distinct(column)).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def group_counts(rejected: DataFrame, column: str = "reasons") -> DataFrame:
    """reason_group, n: rows with a code of each group, the part before the first underscore; a row counts once per group."""
    groups = F.array_distinct(F.transform(F.col(column), lambda r: F.substring_index(r, "_", 1)))
    return rejected.select(F.explode(groups).alias("reason_group")).groupBy("reason_group").agg(F.count(F.lit(1)).alias("n"))


def component_mismatch(arm: Column, hand: Column, whole: Column) -> Column:
    """Whether finite parts differ from the finite whole; vectors that are not finite are not compared."""
    ok = lambda a: F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return ok(arm) & ok(hand) & ok(whole) & (F.concat(arm, hand) != whole)
