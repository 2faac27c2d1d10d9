import random

import pandas as pd
from pyspark.sql import functions as F

from rigweave.operators.asof import strict_asof
from rigweave.operators.hashrank import below_fraction
from rigweave.operators.intervals import classify_points, contained, merge_overlaps
from rigweave.operators.merging import append_new, compare_manifests, dense_ids
from rigweave.operators.ranking import seeded_hash, spread_rank
from rigweave.operators.sequence import islands, neighbour, row_index, running_total


def frame(seed=1, n=400):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i * 3, rng.choice([1, 2, None])) for i in range(n)]
    return rows


def test_neighbour_and_totals_match_pandas(spark):
    rows = frame()
    df = spark.createDataFrame(rows, "k string, s long, v int")
    got = running_total(neighbour(df, "k", "s", {"before": "v", "at": "s"}, bits=4), "k", "s", F.coalesce("v", F.lit(0)), "t", bits=4).toPandas().sort_values("s")
    p = pd.DataFrame(rows, columns=["k", "s", "v"]).fillna({"k": "-"}).sort_values("s")
    p["at"] = p.groupby("k").s.shift()
    p["t"] = p.v.fillna(0).groupby(p.k).cumsum()
    assert got["at"].fillna(-1).tolist() == p["at"].fillna(-1).tolist()
    assert got["t"].tolist() == p["t"].tolist()
    after = neighbour(df, "k", "s", {"nxt": "s"}, after=True, bits=4).toPandas().sort_values("s")
    assert after["nxt"].fillna(-1).tolist() == p.groupby("k").s.shift(-1).fillna(-1).tolist()


def test_sequence_takes_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, 5, 6, 7), ("a", 2, 5, 6, 8)], "k string, s long, _chunk int, _k int, rank int")
    assert [r["i"] for r in row_index(df, "k", "s", "i").orderBy("s").collect()] == [0, 1]
    assert islands(df.limit(0), "k", "s", F.col("s") != F.col("x") + 1, "g", {"x": "s"}).count() == 0


def test_islands_by_hand(spark):
    df = spark.createDataFrame([("a", t) for t in (1, 2, 3, 7, 8, 20)] + [("b", 5)], "k string, s long")
    got = {(r["k"], r["s"]): r["g"] for r in islands(df, "k", "s", F.col("s") != F.col("p") + 1, "g", {"p": "s"}).collect()}
    assert got == {("a", 1): 0, ("a", 2): 0, ("a", 3): 0, ("a", 7): 1, ("a", 8): 1, ("a", 20): 2, ("b", 5): 0}


def brute(boundary, samples, after):
    side = [s for s in samples if (s[1] > boundary if after else s[1] < boundary)]
    positive = any(s[1] > 0 for s in side)
    good = [s for s in side if s[3]]
    if not good:
        return None, positive
    return (min(good, key=lambda s: (s[1], s[2])) if after else max(good, key=lambda s: (s[1], s[2])))[2], positive


def test_strict_asof_against_full_scan(spark):
    rng = random.Random(7)
    samples, bounds = [], []
    for e in range(12):
        times = [rng.randrange(-100, 3000) for _ in range(rng.randrange(1, 60))]
        times += [t for t in times if rng.random() < 0.5]
        samples += [(f"e{e}", t, i, rng.random() < 0.65) for i, t in enumerate(times)]
        bounds += [(e * 1000 + i, f"e{e}", rng.choice([*times, rng.randrange(-150, 3050)])) for i in range(40)]
    s = spark.createDataFrame([(*x, x[2]) for x in samples], "entity string, ts long, row long, eligible boolean, payload long")
    b = spark.createDataFrame([*bounds, (-1, None, 5), (-2, "e0", None), (-3, "nobody", 7)], "boundary_id long, entity string, ts long")
    for after in (False, True):
        got = {r["boundary_id"]: (r["pick_row"], r["any_positive"]) for r in strict_asof(b, s, after, bucket_bits=6).collect()}
        want = {i: brute(t, [x for x in samples if x[0] == e], after) for i, e, t in bounds} | {-3: (None, False)}
        assert got == want


def test_points_and_intervals(spark):
    holes = spark.createDataFrame([("a", 10, 20), ("a", 30, None), ("b", 5, 5)], "e string, start_ns long, end_ns long")
    points = spark.createDataFrame([("a", t) for t in (9, 10, 20, 21, 30, 99)] + [("b", 5), ("b", 6), ("c", 1), (None, 3), ("a", None)], "e string, t long")
    got = {(r["e"], r["t"]): r["domain"] for r in classify_points(points, holes, "e", "t").collect()}
    assert got == {("a", 9): 0, ("a", 10): None, ("a", 20): None, ("a", 21): 1, ("a", 30): None, ("a", 99): None, ("b", 5): None, ("b", 6): 1, ("c", 1): 0, (None, 3): None, ("a", None): None}
    merged = merge_overlaps(spark.createDataFrame([("a", 1, 5), ("a", 4, 9), ("a", 9, 11), ("a", 20, None), ("b", 1, 2)], "e string, start_ns long, end_ns long"), "e")
    assert sorted((r["e"], r["start_ns"], r["end_ns"] or -1) for r in merged.collect()) == [("a", 1, 11), ("a", 20, -1), ("b", 1, 2)]
    inner = spark.createDataFrame([("a", 1, 3), ("a", 2, 12), ("a", 15, 16)], "k string, start_idx long, end_idx long")
    outer = spark.createDataFrame([("a", 0, 10), ("a", 10, 14)], "k string, start_idx long, end_idx long")
    assert sorted(r["n_containers"] for r in contained(inner, outer, "k").collect()) == [0, 0, 1]


def test_spread_rank_is_exact(spark):
    rows = [(i % 3 if i % 7 else None, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, rank_me long").withColumn("h", seeded_hash(1, "rank_me"))
    got = spread_rank(df, ["k"], "h", ["rank_me"]).toPandas()
    for _, g in got.groupby("k", dropna=False):
        assert sorted(g["rank"]) == list(range(len(g)))
        assert g.sort_values("rank")["h"].is_monotonic_increasing


def test_hash_split_takes_the_exact_share(spark):
    import hashlib

    ids = [str(i) for i in range(137)]
    got = {r["id"] for r in below_fraction(spark.createDataFrame([(i,) for i in ids], "id string"), "id", 0.3, 5, "v", "t").where("split = 'v'").collect()}
    want = sorted(ids, key=lambda i: (hashlib.sha256(f"5:{i}".encode()).hexdigest(), i))[: int(137 * 0.3)]
    assert got == set(want)


def test_merging(spark):
    base = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n long")
    new = spark.createDataFrame([("y", 3), ("z", 4), (None, 5)], "k string, n long")
    assert {(r["k"], r["action"]) for r in append_new(base, new, "k").collect()} == {("y", "DUPLICATE"), ("z", "APPEND"), (None, "APPEND")}
    ids = dense_ids(base.unionByName(new), ["n"], "i", "n", "o").orderBy("n").collect()
    assert [r["i"] for r in ids] == [0, 1, 2, 3, 4] and [r["o"] for r in ids] == [0, 1, 3, 6, 10]
    a = spark.createDataFrame([("p", 1, "d"), ("q", None, "d")], "path string, size long, digest string")
    b = spark.createDataFrame([("q", None, "d"), ("r", 1, "d")], "path string, size long, digest string")
    assert {r["path"]: r["status"] for r in compare_manifests(a, b).collect()} == {"p": "MISSING", "q": "SAME", "r": "EXTRA"}


def test_hot_keys_are_joined_like_all_others(spark):
    from rigweave.operators.skew import join_unique

    rows = [(7 if i % 3 else i % 40 if i % 5 else None, i) for i in range(600)]
    left = spark.createDataFrame(rows, "k long, i long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40, 2)] + [(7, "v7"), (None, "none")], "r long, v string")
    table = {k: f"v{k}" for k in [*range(0, 40, 2), 7]}
    for hot in (10, 10_000):
        assert {(r["i"], r["v"]) for r in join_unique(left, "k", right, "r", "left", hot_rows=hot).collect()} == {(i, table.get(k)) for k, i in rows}
        assert {(r["i"], r["v"]) for r in join_unique(left, "k", right, "r", hot_rows=hot).collect()} == {(i, table[k]) for k, i in rows if k in table}
    assert join_unique(left.limit(0), "k", right, "r", hot_rows=0).count() == 0
