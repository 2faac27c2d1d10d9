"""Ordered operators over long sequences without one task per sequence.

A sequence (say an episode) is cut into chunks of its integer order. Windows run inside chunks; what has to cross a
chunk's edge travels through a table with one row per chunk. (Columns named __seq_* are the helpers' own.) So an episode that holds a large share of all rows is the
work of many tasks, and the wide rows are shuffled once, by (key, chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 14
#: The chunk of rows without a place, below any that a 64-bit place can give.
NOWHERE = -(2**62)
#: A row's key and chunk without nulls: windows and joins over them ask for one and the same partitioning, so that the wide
#: rows are shuffled once.
KEY, PART = ("__seq_kn", "__seq_kc"), ("__seq_kn", "__seq_kc", "__seq_chunk")


def _chunked(df: DataFrame, key: str, seq: str, bits: int) -> DataFrame:
    chunk = F.coalesce(F.shiftright(F.col(seq).cast("long"), bits), F.lit(NOWHERE))
    return df.withColumns({"__seq_kn": F.col(key).isNull(), "__seq_kc": F.coalesce(F.col(key).cast("string"), F.lit("")), "__seq_chunk": chunk})


def _met(rows: DataFrame, per_chunk: DataFrame, value: Column, name: str) -> DataFrame:
    """rows with a value of their chunk."""
    side = per_chunk.select(*[F.col(c).alias(f"{c}_e") for c in PART], value.alias(name))
    same = F.lit(True)
    for c in PART:
        same = same & (F.col(c) == F.col(f"{c}_e"))
    return rows.join(side, same)


def neighbour(df: DataFrame, key: str, seq: str, columns: dict[str, str], tie: list[str] | None = None, after: bool = False, bits: int = CHUNK_BITS) -> DataFrame:
    """Add for each `new: old` the value of `old` in the previous (or, with `after`, next) row of the key; null at the end.

    Rows order by (seq, tie). A null key or seq forms its own sequence part; empty input stays empty.
    """
    order = [seq, *(tie or [])]
    packed = F.struct(*[F.col(old).alias(new) for new, old in columns.items()])
    rows = _chunked(df, key, seq, bits)
    edge = rows.groupBy(*PART).agg((F.min_by if after else F.max_by)(packed, F.struct(*order)).alias("__seq_e"))
    step = F.lead if after else F.lag
    far = step("__seq_e").over(Window.partitionBy(*KEY).orderBy("__seq_chunk"))
    rows = rows.withColumn("__seq_near", step(packed).over(Window.partitionBy(*PART).orderBy(*order)))
    joined = _met(rows, edge, far, "__seq_far")
    value = F.coalesce("__seq_near", "__seq_far")
    return joined.select(*df.columns, *[value[new].alias(new) for new in columns])


def running_total(df: DataFrame, key: str, seq: str, value: Column, name: str, tie: list[str] | None = None, bits: int = CHUNK_BITS) -> DataFrame:
    """Add the sum of `value` over the key's rows up to and with this one, in the order of (seq, tie)."""
    rows = _chunked(df.withColumn("__seq_v", value), key, seq, bits)
    inside = Window.partitionBy(*PART).orderBy(seq, *(tie or [])).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*KEY).orderBy("__seq_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*PART).agg(F.sum("__seq_v").alias("__seq_s"))
    joined = _met(rows.withColumn("__seq_in", F.sum("__seq_v").over(inside)), sums, F.coalesce(F.sum("__seq_s").over(before), F.lit(0)), "__seq_base")
    return joined.select(*df.columns, (F.col("__seq_base") + F.col("__seq_in")).alias(name))


def row_index(df: DataFrame, key: str, seq: str, name: str, tie: list[str] | None = None, bits: int = CHUNK_BITS) -> DataFrame:
    """Add the 0-based position of each row in its key's sequence."""
    return running_total(df, key, seq, F.lit(1), name, tie, bits).withColumn(name, F.col(name) - 1)


def islands(df: DataFrame, key: str, seq: str, begins: Column, name: str, needs: dict[str, str], tie: list[str] | None = None) -> DataFrame:
    """Number the islands of each key from 0: a row begins one where `begins` holds, or is the key's first.

    `begins` may use the columns of `needs` (new: old), the previous row's values; they are null in the first row.
    """
    seen = neighbour(df, key, seq, {"__seq_first": seq, **needs}, tie)
    start = F.when(F.col("__seq_first").isNull() | F.coalesce(begins, F.lit(True)), 1).otherwise(0)
    numbered = running_total(seen, key, seq, start, name, tie)
    return numbered.withColumn(name, F.col(name) - 1).select(*df.columns, name)
