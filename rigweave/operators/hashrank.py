"""Splits and samples by hash rank: sort by a seeded digest, take an exact fraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def below_fraction(ids: DataFrame, key: str, fraction: float, seed: int, inside: str, outside: str) -> DataFrame:
    """key and split: the first floor(n * fraction) keys by sha256 of "seed:key", then key, are `inside`.

    Only the boundary digest is found: counts by the digest's first 16 bits narrow it to one cell, and one cell is
    ranked. No global sort. Keys must be distinct; null keys are left out.
    """
    rows = ids.where(F.col(key).isNotNull()).withColumn("__digest", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)).withColumn("__cell", F.substring("__digest", 1, 4))
    cells = rows.groupBy("__cell").agg(F.count(F.lit(1)).alias("__n"))
    # at most 65,536 cells, whatever the number of keys
    order = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    place = cells.select(F.col("__cell").alias("__c"), F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__before"), F.floor(F.sum("__n").over(whole) * F.lit(fraction)).alias("__take"), "__n")
    met = rows.join(place, F.col("__cell") == F.col("__c"))
    ranked = met.withColumn("__r", F.when(F.col("__before") >= F.col("__take"), F.lit(None)).when(F.col("__before") + F.col("__n") <= F.col("__take"), F.lit(0)).otherwise(F.col("__before") + F.row_number().over(Window.partitionBy("__cell").orderBy("__digest", key))))
    chosen = F.coalesce(F.col("__r") <= F.col("__take"), F.lit(False))
    return ranked.select(key, F.when(chosen, inside).otherwise(outside).alias("split"))
