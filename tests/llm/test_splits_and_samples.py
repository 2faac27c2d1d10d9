import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rigweave.llm.group_split import assign_splits, capture_digest, connected, episode_number, plan_splits, tie_records
from rigweave.llm.stable_sample import stable_sample


class Forest:
    def __init__(self):
        self.p = {}

    def find(self, x):
        self.p.setdefault(x, x)
        while self.p[x] != x:
            self.p[x] = self.p[self.p[x]]
            x = self.p[x]
        return x

    def join(self, a, b):
        self.p[self.find(a)] = self.find(b)


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {"random": [(rng.randrange(400), rng.randrange(400)) for _ in range(300)], "chain": [(i, i + 1) for i in range(500)], "star": [(9999, i) for i in range(500)], "none": []}[shape]
    f = Forest()
    for a, b in edges:
        f.join(a, b)
    groups = defaultdict(set)
    for x in list(f.p):
        groups[f.find(x)].add(x)
    want = {(x, min(g)) for g in groups.values() for x in g if x != min(g)}
    df = spark.createDataFrame(edges + [(None, 1), (3, 3)], "u long, v long").repartition(7)
    assert {(r["node"], r["root"]) for r in connected(df).collect()} == want


def test_ties_and_odd_keys(spark):
    rows = [(1, 5, "a"), (2, 9, "a"), (3, 9, None), (4, None, "a"), (5, 7, None), (6, None, "z"), (7, None, "z"), (8, None, None), (9, None, None), (1, 5, "a"), (None, None, None)]
    got = {r["record_id"]: (r["group_key"], r["group_episode"]) for r in tie_records(spark.createDataFrame(rows, "record_id long, episode long, digest string").withColumn("node", F.lit(1))).collect()}
    assert {got[i][0] for i in (1, 2, 3, 4)} == {"e:5"} and got[4][1] == 5
    assert got[5][0] == "e:7" and got[6] == got[7] and got[6][1] is None and got[8][0] != got[9][0]
    assert tie_records(spark.createDataFrame([], "record_id long, episode long, digest string")).count() == 0


@pytest.mark.parametrize("ident,path,want", [
    ("episode_000012", None, 12), ("/captures/x/episode_000012.npz", None, 12), ("EPISODE-12 ", None, 12), ("episode_000012_media", None, 12), ("000012", "y", 12), (None, "/data/c1_wk07/episode_000003", 3), ("", "/data/c1/episode_000003/", 3), (None, None, None), ("none", "none", None)])
def test_episode_spellings(spark, ident, path, want):
    assert spark.range(1).select(episode_number(F.lit(ident).cast("string"), F.lit(path).cast("string")).alias("e")).first()["e"] == want


def test_digests_for_no_capture(spark):
    for bad in ("", None, "0" * 64, "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855", "none"):
        assert spark.range(1).select(capture_digest(F.lit(bad).cast("string")).alias("d")).first()["d"] is None


def one_by_one(sizes, fractions):
    total = sum(sizes)
    lack = [f * total for _, f in fractions]
    for s in sorted(sizes, reverse=True):
        i = min(range(len(lack)), key=lambda j: (-lack[j], j))
        lack[i] -= s
    return lack


def test_bulk_greedy_ends_like_one_by_one():
    rng = random.Random(2)
    for _ in range(60):
        sizes = [rng.choice([1, 1, 1, 2, 3, 5, 40]) for _ in range(rng.randrange(1, 300))]
        fractions = [("a", 0.8), ("b", 0.1), ("c", 0.1)]
        hist = defaultdict(int)
        for s in sizes:
            hist[s] += 1
        plan = plan_splits(dict(hist), fractions)
        got = {n: f * sum(sizes) for n, f in fractions}
        covered = defaultdict(int)
        for size, a, b, name in plan:
            got[name] -= size * (b - a)
            covered[size] += b - a
        assert covered == hist
        for x, y in zip(got.values(), one_by_one(sizes, fractions)):
            assert abs(x - y) <= max(1, max(sizes[-1:] + [1]) * 2) or abs(x) <= max(sizes)


def test_splits_keep_groups_together_and_meet_fractions(spark):
    rng = random.Random(8)
    rows = [(i, rng.randrange(300) if i % 3 else 0, None) for i in range(3000)]
    tied = tie_records(spark.createDataFrame(rows, "record_id long, episode long, digest string"))
    got = assign_splits(tied, [("train", 0.8), ("val", 0.1), ("test", 0.1)], 3).toPandas()
    assert len(got) == 3000 and (got.groupby("group_key").split_name.nunique() == 1).all()
    share = got.split_name.value_counts(normalize=True)
    assert abs(share["train"] - 0.8) < 0.01 and abs(share["val"] - 0.1) < 0.01
    again = assign_splits(tied.repartition(13), [("train", 0.8), ("val", 0.1), ("test", 0.1)], 3).toPandas()
    assert dict(zip(got.record_id, got.split_name)) == dict(zip(again.record_id, again.split_name))


def test_sample_stays_as_data_grows(spark):
    df = spark.range(20000).select(F.col("id").alias("k"), F.lit(None).alias("bucket"))
    small = {r["k"] for r in stable_sample(df.where("k < 8000"), "k", 0.05, 23).collect()}
    whole = {r["k"] for r in stable_sample(df.repartition(9), "k", 0.05, 23).collect()}
    wide = {r["k"] for r in stable_sample(df, "k", 0.2, 23).collect()}
    assert small == {k for k in whole if k < 8000} and whole <= wide
    assert abs(len(whole) / 20000 - 0.05) < 0.01 and abs(len(wide) / 20000 - 0.2) < 0.02
    assert {r["k"] for r in stable_sample(df, "k", 0.05, 24).collect()} != whole
    odd = spark.createDataFrame([(None,), ("x",), ("x",)], "k string")
    assert stable_sample(odd, "k", 1.0, 1).count() == 2 and stable_sample(odd, "k", 0.0, 1).count() == 0


def _roots(edges):
    f = Forest()
    for a, b in edges:
        f.join(a, b)
    groups = defaultdict(set)
    for x in list(f.p):
        groups[f.find(x)].add(x)
    return {(x, min(g)) for g in groups.values() for x in g if x != min(g)}


@pytest.mark.parametrize("hub", [0, 10**6, None])
def test_one_component_with_most_links_by_star_rounds(spark, hub):
    rng = random.Random(5)
    edges = [(hub, i) if hub is not None else (i, i + 1) for i in range(1, 900)] + [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(100)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long").repartition(6)
    # chunks and hot keys so small that no level of the hierarchy ends in one chunk and the hub counts as hot
    assert {(r["node"], r["root"]) for r in connected(df, chunk=20, hot_rows=30).collect()} == _roots(edges)


def test_no_capture_ties_nothing(spark):
    rows = [(i, i, None) for i in range(500)] + [(1000 + i, None, None) for i in range(50)]
    got = tie_records(spark.createDataFrame(rows, "record_id long, episode long, digest string")).toPandas()
    assert len(got) == 550 and got.group_key.is_unique
