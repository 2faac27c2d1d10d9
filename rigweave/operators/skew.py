"""Joins to a table that holds each key once, where a single key may hold a large share of the other side's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigweave.session import settle

#: A key with so many rows is hot; so many of the hottest are joined by broadcast.
HOT_ROWS, HOT_KEYS = 1_000_000, 10_000


def join_unique(left: DataFrame, key: str, right: DataFrame, right_key: str, how: str = "inner", rows: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """left joined ("inner" or "left") to `right`, which has no key twice; the columns of both sides must differ in name.

    The hottest keys meet their one row of `right` by a broadcast of at most HOT_KEYS rows, so their rows stay where they are;
    all others meet by a shuffle in which no key has more than hot_rows rows or a HOT_KEYS-th of them. Null keys match
    nothing and are not shuffled. `left` is read several times and should be a settled table; `rows`, an upper bound of its
    rows, saves counting them. Tables without rows give none.
    """
    met = F.col(key) == F.col(right_key)
    if (left.count() if rows is None else rows) < hot_rows:
        return left.join(right, met, how)
    counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= hot_rows)
    hot = settle(counts.orderBy(F.desc("__n"), key).limit(HOT_KEYS).select(F.col(key).alias("__hot")), "hot")
    few = F.broadcast(hot)
    parts = [
        left.join(few, F.col(key) == F.col("__hot"), "left_semi").join(F.broadcast(right.join(few, F.col(right_key) == F.col("__hot"), "left_semi")), met, how),
        left.where(F.col(key).isNotNull()).join(few, F.col(key) == F.col("__hot"), "left_anti").join(right, met, how),
    ]
    if how == "left":
        parts.append(left.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
