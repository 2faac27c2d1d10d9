"""Splits that keep related records together (problem 4).

Records tie to a source episode and to a raw capture; whatever is tied, directly or through other records, is one group.
Groups are found by distributed union-find: local forests over chunks of links, merged hierarchically, level by level, as
long as that shrinks them and until one chunk holds what is left; a forest too large for that is finished by rounds of
large-star and small-star steps until nothing moves. Groups then go, largest first, to the split furthest below its target; as groups of
one size are interchangeable, the greedy runs over the histogram of group sizes (at most sqrt(2 * rows) entries).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigweave.functions.text import episode_number  # noqa: F401
from rigweave.operators.ranking import seeded_hash, spread_rank
from rigweave.operators.skew import HOT_ROWS, join_unique
from rigweave.session import discard, settle, settle_at

#: Digests that stand for no capture (all zeros; the digest of empty input).
EMPTY_DIGESTS = (
    "0" * 64,
    "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
)
CHUNK_EDGES = 500_000


def capture_digest(digest: Column) -> Column:
    """The digest in lower case, or null where it stands for no capture."""
    clean = F.lower(F.trim(digest))
    return F.when(clean.rlike("^[0-9a-f]{64}$") & ~clean.isin(*EMPTY_DIGESTS), clean)


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, lowest node of its tree) of a chunk's links, by union-find with path halving."""
    nodes, index = np.unique(np.r_[left, right], return_inverse=True)
    parent = np.arange(len(nodes))
    a, b = index[: len(left)], index[len(left) :]
    while True:
        # hook each root to the lowest root it touches, then halve all paths
        ra, rb = parent[a], parent[b]
        live = ra != rb
        if not live.any():
            break
        low, high = np.minimum(ra, rb)[live], np.maximum(ra, rb)[live]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    moved = parent != np.arange(len(nodes))
    return nodes[moved], nodes[parent[moved]]


def local_forests(edges: DataFrame, chunk: int = CHUNK_EDGES) -> DataFrame:
    """Replace each task's links (u, v) by the forest they span; memory is bounded by the chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush() -> pd.DataFrame:
            u, v = _forest(np.concatenate([x.u.to_numpy() for x in held]), np.concatenate([x.v.to_numpy() for x in held]))
            return pd.DataFrame({"u": u, "v": v})

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= chunk:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return edges.select("u", "v").mapInPandas(run, "u long, v long")


def connected(edges: DataFrame, most_rounds: int = 60, chunk: int = CHUNK_EDGES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(node, root): the lowest node of each node's component, for every node that has a link and is not itself the root.

    edges(u long, v long); nulls and self-links are ignored, direction and repetition do not matter. Each level or round ends
    in a table in the shared folder, which the next one's end removes. A node that a large share of all links touches stays
    spread over many tasks. Empty input gives no rows.
    """
    spark = edges.sparkSession
    links = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    star, path = settle_at(local_forests(links, chunk).distinct(), "forest")
    size, before = star.count(), None
    # level by level: forests of `chunk` links at most meet in one task each, by where their lower ends lie
    while before is None or size < 0.8 * before:
        parts = -(-size // chunk)
        if parts <= 1:
            whole = settle(local_forests(star.coalesce(1), chunk), "forest")
            discard(spark, path)
            return whole.select(F.col("u").alias("node"), F.col("v").alias("root"))
        merged, merged_path = settle_at(local_forests(star.repartitionByRange(parts, "v"), chunk).distinct(), "forest")
        discard(spark, path)
        star, path, before, size = merged, merged_path, size, merged.count()
    mark = None
    for _ in range(most_rounds):
        # large-star: every link (u, v) moves to the lowest node that its lower end v touches
        least = star.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        large = join_unique(star, "v", least, "w", "left", size, hot_rows).select("u", F.coalesce("m", "v").alias("v"))
        large, large_path = settle_at(local_forests(large.distinct(), chunk), "large")
        # small-star: u and its smaller neighbours all move to the lowest of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        moved = join_unique(large, "u", low, "w", "inner", size, hot_rows)
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v")))
        fresh, fresh_path = settle_at(small.where("u <> v").distinct(), "forest")
        discard(spark, path)
        discard(spark, large_path)
        star, path = fresh, fresh_path
        now = star.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == mark:
            return star.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark, size = tuple(now), now[0]
    raise RuntimeError("components did not settle")


def tie_records(records: DataFrame) -> DataFrame:
    """Give every record its group.

    records(record_id long, episode long or null, digest string or null); a record_id that arrives again is one record.
    Result: record_id, group_key string, group_episode long (lowest episode of the group, null if no record of it names
    one). A record with neither key is a group of its own (those without an id together are one); a digest without any episode
    is a group by itself. Other columns are ignored; no records give no rows.
    """
    rows = settle(records.select("record_id", "episode", "digest").distinct(), "records")
    size = rows.count()
    pairs = rows.where("episode is not null and digest is not null").select("episode", "digest").distinct()
    lowest = settle(pairs.groupBy("digest").agg(F.min("episode").alias("first_episode")).withColumnRenamed("digest", "of_digest"), "lowest")
    edges = join_unique(pairs, "digest", lowest, "of_digest", rows=size).select(F.col("episode").alias("u"), F.col("first_episode").alias("v"))
    roots = connected(edges)
    # only a record that names no episode asks its digest for one
    none = F.lit(None).cast("long")
    asks = F.col("episode").isNull() & F.col("digest").isNotNull()
    lost = join_unique(rows.where(asks), "digest", lowest, "of_digest", "left", size).select("record_id", "digest", F.col("first_episode").alias("anchor"))
    anchored = lost.unionByName(rows.where(~asks).select("record_id", "digest", F.col("episode").alias("anchor")))
    placed = join_unique(anchored, "anchor", roots, "node", "left", size).withColumn("group_episode", F.coalesce("root", "anchor", none))
    key = F.coalesce(
        F.concat(F.lit("e:"), F.col("group_episode").cast("string")),
        F.concat(F.lit("d:"), F.col("digest")),
        F.concat(F.lit("r:"), F.coalesce(F.col("record_id").cast("string"), F.lit("null"))),
    )
    # a record that was written twice with different keys would tie both; ids repeat only in equal rows
    return placed.select("record_id", key.alias("group_key"), "group_episode").distinct()


def plan_splits(sizes: dict[int, int], fractions: list[tuple[str, float]]) -> list[tuple[int, int, int, str]]:
    """Largest-first greedy over the histogram {group size: number of groups}: rows (size, from rank, to rank, split).

    Each group goes to the split furthest below its target number of records; ties go to the split named first. Runs of
    equal groups are placed at once, with the same outcome as one by one up to the order of names inside a run.
    """
    total = sum(s * n for s, n in sizes.items())
    lack = [f * total for _, f in fractions]
    rows = []
    for size in sorted(sizes, reverse=True):
        at, left = 0, sizes[size]
        while left:
            order = sorted(range(len(lack)), key=lambda i: (-lack[i], i))
            best = order[0]
            gap = lack[best] - lack[order[1]] if len(order) > 1 else float("inf")
            take = left if gap == float("inf") else min(left, max(1, int(gap // size)))
            if take == 1 and left > 4 * len(lack) and lack[order[0]] - lack[order[-1]] <= size:
                # all level: whole rounds go evenly
                each = left // len(lack)
                for i in range(len(lack)):
                    rows.append((size, at, at + each, fractions[i][0]))
                    lack[i] -= each * size
                    at += each
                left -= each * len(lack)
                continue
            rows.append((size, at, at + take, fractions[best][0]))
            lack[best] -= take * size
            at += take
            left -= take
    return rows


def assign_splits(tied: DataFrame, fractions: list[tuple[str, float]], seed: int) -> DataFrame:
    """Give every record of tie_records' result a split in the given fractions, whole groups at a time.

    Result: record_id, group_key, split_name. Fractions that do not sum to 1 are scaled. No records: no rows.
    """
    scale = sum(f for _, f in fractions)
    groups = settle(tied.groupBy("group_key").agg(F.count(F.lit(1)).alias("size")), "groups")
    histogram = {r["size"]: r["n"] for r in groups.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_splits(histogram, [(n, f / scale) for n, f in fractions])
    schema = T.StructType([T.StructField("of_size", T.LongType()), T.StructField("from_rank", T.LongType()), T.StructField("to_rank", T.LongType()), T.StructField("split_name", T.StringType())])
    table = tied.sparkSession.createDataFrame(plan, schema)
    ranked = spread_rank(groups.withColumn("h", seeded_hash(seed, "group_key")), ["size"], "h", ["group_key"], rows=sum(histogram.values()))
    split = ranked.join(table, (F.col("size") == F.col("of_size")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
    split = settle(split.select(F.col("group_key").alias("of_group"), "split_name"), "splits")
    return join_unique(tied, "group_key", split, "of_group").select("record_id", "group_key", "split_name")
