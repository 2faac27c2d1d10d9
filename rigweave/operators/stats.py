"""Distribution summaries over finite values, zero-filled counts and ties broken by rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigweave.session import settle

#: Values of one cell of a histogram that are ranked in one task; a fuller cell is cut into so many parts first.
CELL_ROWS, CELL_PARTS = 1_000_000, 4096


def finite(value: Column) -> Column:
    """The value where it is a finite number, else null."""
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def _cell(v: Column) -> Column:
    """A whole number that never falls as v rises: sixteen cells for each power of two, on either side of zero."""
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * (F.floor(F.log2(F.abs(v)) * 16) + 17_200)).cast("long")


def quantiles(df: DataFrame, keys: list[str], value: Column, points: tuple[float, ...], keep: bool = True, cell_rows: int = CELL_ROWS) -> DataFrame:
    """keys, n, total, least, most and q, the exact quantiles (linear between ranks) of each group's finite values.

    A histogram by leading bits, summed before the shuffle, tells the cells in which the ranks lie; only those cells' values
    are looked at again, and a cell with more than cell_rows of them is cut further. So no task holds a group's values,
    whatever its share of the rows. Groups without finite values have n 0 and nulls; without keys there is one group.
    keep: write the values first, as the rows behind them are costly to make twice.
    """
    keys = keys or ["__all"]
    source = df.withColumn("__all", F.lit(0)) if keys == ["__all"] else df
    v = finite(value.cast("double"))
    # + 0.0 makes one value of both zeros
    rows = source.select(*keys, (v + F.lit(0.0)).alias("__v")).withColumn("__cell", _cell(F.col("__v")))
    rows = settle(rows, "values") if keep else rows
    parts = [F.count("__v").alias("__n"), F.sum("__v").alias("__s"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")]
    cells = settle(rows.groupBy(*keys, "__cell").agg(*parts), "cells")
    every = cells.groupBy(*keys).agg(F.sum("__n").alias("n"), F.sum("__s").alias("total"), F.min("__lo").alias("least"), F.max("__hi").alias("most"))

    whole = Window.partitionBy(*keys)
    size = F.sum("__n").over(whole)
    at = [F.lit(float(p)) * (F.col("__size") - 1) for p in points]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in at])))
    before = F.coalesce(F.sum("__n").over(whole.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = cells.where("__n > 0").withColumns({"__size": size, "__before": before}).withColumn("__ranks", ranks)
    inside = lambda first, count: F.filter("__ranks", lambda r: (r >= first) & (r < first + count))
    columns = [*keys, "__cell", "__before", "__n", "__lo", "__hi", "__ranks"]
    hits = settle(placed.withColumn("__ranks", inside(F.col("__before"), F.col("__n"))).where(F.size("__ranks") > 0).select(*columns), "hits")

    def refine(rows: DataFrame, hits: DataFrame) -> DataFrame:
        """The rows of the cells in question, with what is known of the cell."""
        far = hits.where("__lo < __hi").select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__cell").alias("__c"), "__before", "__n", "__lo", "__hi", "__ranks")
        same = F.col("__cell") == F.col("__c")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        return rows.join(far, same).select(*columns, "__v")

    def settled(hits: DataFrame) -> DataFrame:
        return hits.where("__lo = __hi").select(*keys, F.explode("__ranks").alias("__r"), F.col("__lo").alias("__x"))

    known = settled(hits)
    while (hits.where("__lo < __hi").agg(F.max("__n")).first()[0] or 0) > cell_rows:
        part = F.least(F.floor((F.col("__v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * CELL_PARTS), F.lit(CELL_PARTS - 1))
        # the cell's number grows by its part: still in order inside a group
        rows = settle(refine(rows, hits).withColumn("__part", part), "cell")
        head = [*keys, "__cell", "__part", "__before", "__ranks"]
        fine = rows.groupBy(*head).agg(*parts)
        inner = Window.partitionBy(*keys, "__cell").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        fine = fine.withColumn("__before", F.col("__before") + F.coalesce(F.sum("__n").over(inner), F.lit(0)))
        fine = fine.withColumn("__ranks", inside(F.col("__before"), F.col("__n"))).where(F.size("__ranks") > 0)
        fine = fine.withColumn("__cell", F.xxhash64("__cell", "__part"))
        hits = settle(fine.select(*columns), "hits")
        known = known.unionByName(settled(hits))
        rows = rows.select(*keys, F.xxhash64("__cell", "__part").alias("__cell"), "__v")
    values = refine(rows, hits).groupBy(*keys, "__cell", "__before", "__ranks", "__v").agg(F.count(F.lit(1)).alias("__n"))
    inner = Window.partitionBy(*keys, "__cell").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("__before") + F.coalesce(F.sum("__n").over(inner), F.lit(0))
    ranked = values.withColumn("__first", first).select(*keys, F.explode(inside(F.col("__first"), F.col("__n"))).alias("__r"), F.col("__v").alias("__x"))
    # two ranks at most for each point
    found = known.unionByName(ranked).groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(F.map_from_entries(F.collect_list(F.struct(F.col("__r").cast("long"), "__x"))).alias("__at"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    met = every.join(found, same, "left")

    def point(p: float) -> Column:
        x = F.lit(float(p)) * (F.col("n") - 1)
        low, high = (F.try_element_at("__at", f(x).cast("long")) for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high)

    return met.select(*[k for k in keys if k != "__all"], "n", "total", "least", "most", F.array(*[point(p) for p in points]).alias("q"))


def exact_summary(df: DataFrame, keys: list[str], value: Column, digits: int = 6, keep: bool = True) -> DataFrame:
    """keys and count, mean, median, p95, p99 and max of each group's finite values; all but the count are null when there are none."""
    r = lambda c: F.round(c, digits)
    q = quantiles(df, keys, value, (0.5, 0.95, 0.99), keep)
    return q.select(
        *keys, "n", r(F.when(F.col("n") > 0, F.col("total") / F.col("n"))).alias("mean"), r(F.col("q")[0]).alias("median"), r(F.col("q")[1]).alias("p95"), r(F.col("q")[2]).alias("p99"), r(F.col("most")).alias("max"))


def summary(value: Column, digits: int = 6) -> list[Column]:
    """exact_summary as aggregates, for groups that are small by their nature: each group's distinct values meet in one task."""
    v = finite(value.cast("double"))
    r = lambda c: F.round(c, digits)
    return [F.count(v).alias("n"), r(F.avg(v)).alias("mean"), r(F.percentile(v, F.lit(0.5))).alias("median"), r(F.percentile(v, F.lit(0.95))).alias("p95"), r(F.percentile(v, F.lit(0.99))).alias("p99"), r(F.max(v)).alias("max")]


def zero_filled(counts: DataFrame, key: str, count: str, names: list[str]) -> DataFrame:
    """One row for each of the fixed `names`, 0 where `counts` has none."""
    spark = counts.sparkSession
    table = spark.createDataFrame([(n,) for n in names], f"{key} string")
    return table.join(counts, key, "left").select(key, F.coalesce(count, F.lit(0)).cast("long").alias(count))


def most_frequent(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The most frequent combination of `values` in each group; ties go to the smallest. Counts are pre-aggregated."""
    counts = df.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*keys).agg(F.max(F.struct("n", *[(-F.col(v)).alias(v) for v in values])).alias("b"))
    return best.select(*keys, *[(-F.col(f"b.{v}")).alias(v) for v in values], F.col("b.n").alias("n"))


def bookkeeping(value: Column, digits: int = 6) -> list[Column]:
    """count, min, max, mean and population standard deviation."""
    v = value.cast("double")
    return [F.count(v).alias("n"), F.round(F.min(v), digits).alias("min"), F.round(F.max(v), digits).alias("max"), F.round(F.avg(v), digits).alias("mean"), F.round(F.stddev_pop(v), digits).alias("std")]


def close_enough(a: Column, b: Column, relative: float = 1e-9, absolute: float = 1e-6) -> Column:
    """Whether two statistics agree: within the larger of the relative and the absolute tolerance."""
    return F.abs(a - b) <= F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))
