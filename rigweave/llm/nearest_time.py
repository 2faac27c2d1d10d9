"""Nearest record in time for the same entity, by an x-fast trie (problem 1).

Timestamps of one entity are cut into wide time buckets, so that an entity that holds a large share of all rows is
spread over many tasks; samples within the tolerance of a bucket's edge are copied to the neighbouring bucket, so one
bucket answers its own probes completely. Inside a bucket the low bits of the sample times form an x-fast trie: for every
prefix length a hash table holds the prefixes in use, with the first and last leaf below each. A probe finds its longest
stored prefix by binary search over the prefix lengths, which gives one neighbour at once and the other through the
linked leaf order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigweave.operators.grouped_arrow import boundaries, grouped
from rigweave.session import tasks_for

BUCKET_BITS = 36
CHUNK_ROWS = 262144
#: Bytes shuffled for a byte of the estimate of what is read.
GROWTH = 4.0


class XFastTrie:
    """Hash tables of bit prefixes over sorted, distinct (group, key) leaves; many small tries share the tables."""

    def __init__(self, group: np.ndarray, key: np.ndarray, bits: int):
        self.bits, self.group, self.key = bits, group, key
        self.n = len(key)
        self.tables: list[tuple[pd.Index, np.ndarray, np.ndarray] | None] = [None] * (bits + 1)

    def _code(self, group: np.ndarray, key: np.ndarray, length: int) -> np.ndarray:
        return (group << np.int64(length)) | (key >> np.int64(self.bits - length))

    def level(self, length: int) -> tuple[pd.Index, np.ndarray, np.ndarray]:
        """The table of prefixes of `length` bits: hash index, first leaf and last leaf of each."""
        if self.tables[length] is None:
            code = self._code(self.group, self.key, length)
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if self.n else np.zeros(0, dtype=np.int64)
            last = np.r_[first[1:] - 1, self.n - 1] if self.n else first
            self.tables[length] = pd.Index(code[first]), first, last
        return self.tables[length]

    def find(self, group: np.ndarray, key: np.ndarray, length: int) -> np.ndarray:
        """Position in the table of `length` of each probe's prefix, -1 where it is not stored."""
        return self.level(length)[0].get_indexer(self._code(group, key, length))

    def neighbours(self, group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf positions of the last key <= probe and the first key >= probe in the probe's group, -1 for none."""
        m = len(key)
        below, above = np.full(m, -1, dtype=np.int64), np.full(m, -1, dtype=np.int64)
        if not self.n or not m:
            return below, above
        low, high = np.where(self.find(group, key, 0) >= 0, 0, -1), np.full(m, self.bits)
        while True:
            open_ = np.flatnonzero((low >= 0) & (low < high))
            if not len(open_):
                break
            middle = (low[open_] + high[open_] + 1) // 2
            for length in np.unique(middle):
                rows = open_[middle == length]
                hit = self.find(group[rows], key[rows], int(length)) >= 0
                low[rows[hit]] = length
                high[rows[~hit]] = length - 1
        for length in np.unique(low[low >= 0]):
            rows = np.flatnonzero(low == length)
            at = self.find(group[rows], key[rows], int(length))
            _, first, last = self.level(int(length))
            if length == self.bits:
                below[rows] = above[rows] = first[at]
                continue
            right = (key[rows] >> np.int64(self.bits - int(length) - 1)) & 1 == 1
            # the other child is absent: every leaf below the prefix lies on one side of the probe
            pred = np.where(right, last[at], first[at] - 1)
            succ = np.where(right, last[at] + 1, first[at])
            ok = (pred >= 0) & (self.group[np.maximum(pred, 0)] == group[rows])
            below[rows] = np.where(ok, pred, -1)
            ok = (succ < self.n) & (self.group[np.minimum(succ, self.n - 1)] == group[rows])
            above[rows] = np.where(ok, succ, -1)
        return below, above


def _match(table: pa.Table, bits: int, bucket_bits: int) -> Iterator[pa.RecordBatch]:
    table = table.combine_chunks()
    column = {name: table.column(name) for name in table.column_names}
    kind = column["kind"].to_numpy()
    start = boundaries(table, ["entity", "bucket"])
    group = np.cumsum(start) - 1
    # a trie's universe runs from one bucket before its own to one after it
    base = (column["bucket"].to_numpy() - 1) << np.int64(bucket_bits)
    ts, ident = column["ts"].to_numpy(), column["ident"].to_numpy()
    key = ts - base
    leaf = kind == 0
    lg, lk, lid = group[leaf], key[leaf], ident[leaf]
    keep = np.r_[True, (lg[1:] != lg[:-1]) | (lk[1:] != lk[:-1])] if len(lg) else np.zeros(0, dtype=bool)
    lg, lk, lid = lg[keep], lk[keep], lid[keep]
    probe = np.flatnonzero(kind == 1)
    if not len(probe) or not len(lg):
        return
    pg, pk, tol = group[probe], key[probe], column["tolerance"].to_numpy()[probe]
    below, above = XFastTrie(lg, lk, bits).neighbours(pg, pk)
    far = np.int64(2**62)
    down = np.where(below >= 0, pk - lk[np.maximum(below, 0)], far)
    up = np.where(above >= 0, lk[np.maximum(above, 0)] - pk, far)
    pick = np.where(down <= up, below, above)
    hit = np.minimum(down, up) <= tol
    rows = probe[hit]
    channel = table.select(["channel"]).take(pa.array(rows)).column(0).combine_chunks()
    yield pa.RecordBatch.from_arrays([pa.array(ident[rows]), channel, pa.array(lid[pick[hit]])], names=["probe_id", "channel", "sample_id"])


def match_nearest(
    probes: DataFrame,
    samples: DataFrame,
    tolerances: DataFrame,
    max_tolerance: int,
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Pair every probe with the nearest sample of its entity and channel within the channel's tolerance.

    probes(probe_id long, entity string, channel string, ts long); samples(sample_id long, entity, channel, ts);
    tolerances(channel, tolerance long), one row per channel; other columns are ignored. `max_tolerance` bounds the
    tolerances and must lie below 2**bucket_bits, else the buckets are widened.
    Result: probe_id, channel, sample_id, one row per distinct probe that has a partner. Rules: a distance equal to the
    tolerance counts; of two equally near the earlier wins; of samples at one time the smallest id. Null id, entity,
    channel or time never matches; repeated probes and samples count once; a channel without a tolerance has no partners; empty
    tables give no rows.
    """
    bucket_bits = max(bucket_bits, int(max_tolerance).bit_length() + 1)
    width = F.lit(bucket_bits)
    known = [F.col(c).isNotNull() for c in ("entity", "channel", "ts")]
    ok = known[0] & known[1] & known[2]
    samples, probes = samples.where("sample_id is not null"), probes.where("probe_id is not null")
    limits = F.broadcast(tolerances.groupBy("channel").agg(F.max("tolerance").cast("long").alias("tolerance")).where("tolerance >= 0"))

    def bucket(ts: Column) -> Column:
        return F.shiftright(ts, bucket_bits)

    # pre-aggregated before the bucket shuffle: any number of samples of one time becomes one leaf
    leaves = samples.where(ok).groupBy("entity", "channel", "ts").agg(F.min("sample_id").alias("ident"))
    leaves = leaves.join(limits, "channel").select(
        "entity", "channel", "ts", "ident", F.lit(0).alias("kind"), "tolerance",
        F.explode(F.array_distinct(F.array(bucket(F.col("ts") - F.col("tolerance")), bucket(F.col("ts")), bucket(F.col("ts") + F.col("tolerance"))))).alias("bucket"),
    )
    asked = probes.where(ok).select("probe_id", "entity", "channel", "ts").distinct().join(limits, "channel").select(
        "entity", "channel", "ts", F.col("probe_id").alias("ident"), F.lit(1).alias("kind"), "tolerance", bucket(F.col("ts")).alias("bucket"),
    )
    both = leaves.unionByName(asked).select(
        F.concat_ws("\u0001", "entity", "channel").alias("entity"), "channel", "bucket", "kind", "ts", "ident", "tolerance"
    )
    # a sample or probe becomes a wider row than the compressed columns it is read from
    tasks = max(tasks_for(samples, GROWTH), tasks_for(probes, GROWTH))
    ordered = both.repartition(tasks, "entity", "bucket").sortWithinPartitions("entity", "bucket", "kind", "ts", "ident")
    bits = bucket_bits + 2

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from _match(table, bits, bucket_bits)

    return ordered.mapInArrow(grouped(["entity", "bucket"], work, CHUNK_ROWS), "probe_id long, channel string, sample_id long")


def transition_probes(transitions: DataFrame) -> DataFrame:
    """The four non-null times of every transition as probes; a redelivered transition counts once."""
    times = {"arm": "arm_pre_timestamp_ns", "hand": "hand_pre_timestamp_ns", "head": "head_timestamp_ns", "wrist": "wrist_timestamp_ns"}
    narrow = transitions.select("transition_id", "episode_id", *times.values()).distinct()
    return narrow.select(
        F.col("transition_id").alias("probe_id"), F.col("episode_id").alias("entity"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(t).alias("ts")) for c, t in times.items()])).alias("t"),
    ).select("probe_id", "entity", "t.channel", "t.ts").where("ts is not null")
