"""Filling fixed-capacity windows with whole texts (problem 6): linear grouping.

Only the histogram of sizes (at most `capacity` entries) reaches the driver. Large sizes are cut into groups of equal
cardinality and rounded up to their group's largest; over these few sizes configurations that fill a window best are
chosen by bounded-knapsack dynamic programming and repeated while stock lasts. Actual texts then take the slots by exact
rank, which leaves the windows at least as much room as planned; small texts go best-fit into the true remaining room,
again as a plan over (size, remaining room) counts that ranked rows look up. No row is tied to one task.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigweave.operators.ranking import seeded_hash, spread_rank
from rigweave.session import settle

GROUPS = 48
SMALL_SHARE = 8
NEW = -1


def best_configuration(sizes: np.ndarray, stock: np.ndarray, capacity: int) -> list[int]:
    """How many of each size to take, within stock, to fill the capacity as far as possible (bounded knapsack)."""
    reach = np.zeros(capacity + 1, dtype=bool)
    reach[0] = True
    came = np.full((len(sizes), capacity + 1), -1, dtype=np.int16)
    for i, size in enumerate(sizes):
        used = np.where(reach, 0, 32000).astype(np.int16)
        limit = int(min(stock[i], capacity // size))
        step = used.copy()
        # sums reached with one more of this size than the sum `size` below
        for _ in range(limit):
            more = np.full(capacity + 1, 32000, dtype=np.int16)
            more[size:] = step[:-size]
            better = (more < limit) & ~reach
            if not better.any():
                break
            used[better] = more[better] + 1
            reach = reach | better
            step = np.where(better, used, np.int16(32000))
        came[i] = np.where(used < 32000, used, -1)
        if reach[capacity]:
            break
    last = i
    room = int(np.flatnonzero(reach)[-1])
    taken = [0] * len(sizes)
    for j in range(last, -1, -1):
        k = int(came[j, room])
        if k > 0:
            taken[j] = k
            room -= k * int(sizes[j])
    return taken


def plan_large(histogram: dict[int, int], capacity: int, groups: int = GROUPS) -> tuple[list[tuple[int, int, int, int]], int]:
    """Slots for large items ranked from the largest down: rows (from rank, to rank, first window, items a window), number of windows."""
    sizes = np.array(sorted(histogram, reverse=True), dtype=np.int64)
    counts = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    total = int(counts.sum())
    if not total:
        return [], 0
    edges = np.unique(np.linspace(0, total, min(groups, total) + 1).astype(np.int64))
    first = np.searchsorted(np.cumsum(counts), edges[:-1], side="right")
    rounded = sizes[first]
    stock, cursor = np.diff(edges), edges[:-1].copy()
    rows, window = [], 0
    while stock.sum():
        live = np.flatnonzero(stock)
        # the largest size left is always served, so that awkward ones don't pile up
        head = live[0]
        rest = stock[live].copy()
        rest[0] -= 1
        taken = best_configuration(rounded[live], rest, capacity - int(rounded[head]))
        taken[0] += 1
        times = min(int(stock[g]) // t for g, t in zip(live, taken) if t)
        for g, t in zip(live, taken):
            if t:
                rows.append((int(cursor[g]), int(cursor[g]) + t * times, window, t))
                cursor[g] += t * times
                stock[g] -= t * times
        window += times
    return rows, window


def plan_small(histogram: dict[int, int], room: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best fit by counts: rows (size, from rank, to rank, starting room, first rank among windows of that room), new windows.

    Items of one size with ranks [a, b) go one each to the windows ranked r, r + 1, ... of a starting room; starting room
    NEW stands for windows opened here.
    """
    pools: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room now -> (starting room, from rank, to rank)
    rooms: list[int] = []
    for r in sorted(room):
        if r > 0 and room[r]:
            pools[r].append((r, 0, room[r]))
            rooms.append(r)
    rows, opened = [], 0
    for size in sorted((s for s in histogram if s > 0), reverse=True):
        at, left = 0, histogram[size]
        while left:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                fresh = -(-left // (capacity // size))
                pools[capacity].append((NEW, opened, opened + fresh))
                insort(rooms, capacity)
                opened += fresh
                continue
            now = rooms[i]
            origin, a, b = pools[now].pop()
            if not pools[now]:
                rooms.pop(i)
            take = min(left, b - a)
            rows.append((size, at, at + take, origin, a))
            at += take
            left -= take
            if take < b - a:
                if not pools[now]:
                    insort(rooms, now)
                pools[now].append((origin, a + take, b))
            if now - size > 0:
                if not pools[now - size]:
                    insort(rooms, now - size)
                pools[now - size].append((origin, a, a + take))
    return rows, opened


def _pieces(sizes: DataFrame, capacity: int) -> DataFrame:
    """Texts larger than a window cut into full windows and a remainder; all others whole."""
    parts = F.ceil(F.col("size") / F.lit(capacity)).cast("long")
    cut = sizes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(parts, F.lit(1)) - 1)))
    return cut.withColumn("size", F.least(F.col("size") - F.col("part") * capacity, F.lit(capacity)))


def pack(items: DataFrame, capacity: int, seed: int = 0, groups: int = GROUPS) -> DataFrame:
    """Windows for items(item_id long, size long): item_id, part, size, window_id.

    An item is never cut unless it exceeds the capacity; then its parts but the last fill windows of their own. Windows
    never hold more than the capacity. Items of size 0 or null take no room and have window_id null; item_id names a row.
    """
    spark = items.sparkSession
    whole = items.select("item_id", F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    pieces = settle(_pieces(whole, capacity).withColumn("h", seeded_hash(seed, "item_id", "part")), "pieces")
    histogram = {r["size"]: r["n"] for r in pieces.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = max(1, capacity // SMALL_SHARE)
    large = {s: n for s, n in histogram.items() if s >= least}
    slots, windows = plan_large(large, capacity, groups)
    above, run = {}, 0
    for size in sorted(large, reverse=True):
        above[size], run = run, run + large[size]

    # ranks from the largest down: the histogram gives each size's first rank
    schema = T.StructType([T.StructField("of_size", T.LongType()), T.StructField("above", T.LongType())])
    starts = spark.createDataFrame(list(above.items()), schema)
    slots.sort()
    lo = np.array([r[0] for r in slots], dtype=np.int64)
    base = np.array([r[2] for r in slots], dtype=np.int64)
    each = np.array([r[3] for r in slots], dtype=np.int64)

    @F.pandas_udf("long")
    def slot(rank: pd.Series) -> pd.Series:
        at = np.searchsorted(lo, rank.to_numpy(), side="right") - 1
        return pd.Series(base[at] + (rank.to_numpy() - lo[at]) // each[at])

    ranked = spread_rank(pieces.where(F.col("size") >= least), ["size"], "h", ["item_id", "part"], rows=run)
    big = ranked.join(starts, ranked.size == starts.of_size).select("item_id", "part", "size", slot(F.col("above") + F.col("rank")).alias("window_id"))
    big = settle(big, "large")

    load = big.groupBy("window_id").agg((F.lit(capacity) - F.sum("size")).alias("room")).withColumn("h", seeded_hash(seed, "window_id"))
    load = settle(load, "room")
    room = {r["room"]: r["n"] for r in load.groupBy("room").agg(F.count(F.lit(1)).alias("n")).collect()}
    small = {s: n for s, n in histogram.items() if 0 < s < least}
    fills, _ = plan_small(small, room, capacity)
    fills.sort()
    key = np.array([r[0] for r in fills], dtype=np.int64)
    begin = np.array([r[1] for r in fills], dtype=np.int64)
    origin = np.array([r[3] for r in fills], dtype=np.int64)
    start = np.array([r[4] for r in fills], dtype=np.int64)
    first = {s: int(i) for s, i in zip(*np.unique(key, return_index=True))}
    until = {s: int(i + n) for s, i, n in zip(*np.unique(key, return_index=True, return_counts=True))}

    @F.pandas_udf("origin long, place long")
    def fill(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(size), 2), dtype=np.int64)
        s, r = size.to_numpy(), rank.to_numpy()
        for value in np.unique(s):
            rows = s == value
            a, b = first[int(value)], until[int(value)]
            at = a + np.searchsorted(begin[a:b], r[rows], side="right") - 1
            out[rows, 0] = origin[at]
            out[rows, 1] = start[at] + r[rows] - begin[at]
        return pd.DataFrame({"origin": out[:, 0], "place": out[:, 1]})

    little = spread_rank(pieces.where((F.col("size") > 0) & (F.col("size") < least)), ["size"], "h", ["item_id", "part"], rows=sum(small.values()))
    little = little.withColumn("f", fill("size", "rank")).select("item_id", "part", "size", "f.origin", "f.place")
    target = spread_rank(load, ["room"], "h", ["window_id"], rows=windows).select(F.col("room").alias("w_room"), F.col("rank").alias("w_rank"), "window_id")
    put = little.join(target, (F.col("origin") == F.col("w_room")) & (F.col("place") == F.col("w_rank")), "left").select(
        "item_id", "part", "size",
        F.when(F.col("origin") == NEW, F.col("place") + windows).otherwise(F.col("window_id")).alias("window_id"),
    )
    none = pieces.where("size <= 0").select("item_id", "part", "size", F.lit(None).cast("long").alias("window_id"))
    return big.unionByName(put).unionByName(none)


def oversized(items: DataFrame, capacity: int, seed: int = 0) -> DataFrame:
    """item_id of the items that `pack` has to cut: those of which some part but the first lies in a window."""
    return pack(items, capacity, seed).where("part >= 1 and window_id is not null").select("item_id").distinct()
