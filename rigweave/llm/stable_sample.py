"""A sample that stays as data grows (problem 5): nested hash buckets.

A key's bucket is fixed for good by a hash of the seed and the key. The buckets stand in a fixed permutation, and a
sample of fraction f takes the list's first round(f * BUCKETS) buckets: a larger fraction only appends to the list, and
new keys never move an old one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 65536
#: The permutation position = (MULTIPLIER * bucket + seed) mod BUCKETS; an odd multiplier makes it one to one.
MULTIPLIER = 40503


def bucket_of(seed: int, key: Column) -> Column:
    """The key's bucket, 0 to BUCKETS - 1; null for a null key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 4), 16, 10).cast("long")


def position_of(seed: int, bucket: Column) -> Column:
    """The bucket's place in the append-only list."""
    return F.pmod(bucket * F.lit(MULTIPLIER) + F.lit(seed), F.lit(BUCKETS))


def stable_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """The rows whose key lies in the sample of `fraction`; no shuffle, no state.

    Null keys are never sampled; all rows of a key share its fate; fraction <= 0 gives none, >= 1 all with a key.
    """
    chosen = round(max(0.0, min(1.0, fraction)) * BUCKETS)
    return df.where(F.col(key).isNotNull() & (position_of(seed, bucket_of(seed, F.col(key))) < chosen))
