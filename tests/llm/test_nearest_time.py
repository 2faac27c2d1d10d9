import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigweave.llm.nearest_time import XFastTrie, match_nearest


def test_trie_neighbours_match_a_scan():
    rng = np.random.default_rng(1)
    for bits in (1, 5, 12):
        g = np.sort(rng.integers(0, 4, 60))
        k = rng.integers(0, 2**bits, 60)
        leaves = sorted(set(zip(g.tolist(), k.tolist())))
        lg, lk = np.array([x[0] for x in leaves]), np.array([x[1] for x in leaves])
        pg, pk = rng.integers(0, 5, 300), rng.integers(0, 2**bits, 300)
        below, above = XFastTrie(lg, lk, bits).neighbours(pg, pk)
        for a, b, lo, hi in zip(pg, pk, below, above):
            mine = [i for i, (x, _) in enumerate(leaves) if x == a]
            want_lo = max((i for i in mine if leaves[i][1] <= b), default=-1)
            want_hi = min((i for i in mine if leaves[i][1] >= b), default=-1)
            assert (lo, hi) == (want_lo, want_hi)


def brute(probes, samples, limits):
    out = set()
    for pid, e, c, t in set(probes):
        if None in (pid, e, c, t) or c not in limits:
            continue
        near = [(abs(s[3] - t), s[3], s[0]) for s in samples if None not in s and s[1] == e and s[2] == c and abs(s[3] - t) <= limits[c]]
        if near:
            out.add((pid, c, min(near)[2]))
    return out


@pytest.mark.parametrize("bucket_bits", [4, 9, 36])
def test_matches_brute_force(spark, bucket_bits):
    rng = random.Random(bucket_bits)
    entities = ["hot"] * 5 + ["a", "b", None]
    samples = [(i, rng.choice(entities), rng.choice(["x", "y"]), rng.choice([rng.randrange(-200, 3000), rng.randrange(0, 60), None])) for i in range(900)]
    samples += samples[:50] + [(5000 + i, *s[1:]) for i, s in enumerate(samples[:50])] + [(None, "a", "x", 5)]
    probes = [(i, rng.choice(entities), rng.choice(["x", "y", "none"]), rng.choice([rng.randrange(-250, 3100), None])) for i in range(600)]
    probes += probes[:40] + [(None, "a", "x", 5)]
    limits = {"x": 7, "y": 0}
    p = spark.createDataFrame(probes, "probe_id long, entity string, channel string, ts long").withColumn("bucket", F.lit(1)).withColumn("kind", F.lit("z"))
    s = spark.createDataFrame(samples, "sample_id long, entity string, channel string, ts long").withColumn("ident", F.lit("clash"))
    t = spark.createDataFrame(list(limits.items()), "channel string, tolerance long")
    got = [tuple(r) for r in match_nearest(p, s, t, 7, bucket_bits).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(probes, samples, limits)


def test_nanoseconds_and_ties(spark):
    base = 1_514_798_763_000_000_000
    s = spark.createDataFrame([(3, "e", "arm", base + 10), (2, "e", "arm", base + 10), (1, "e", "arm", base + 20)], "sample_id long, entity string, channel string, ts long")
    p = spark.createDataFrame([(1, "e", "arm", base + 15), (2, "e", "arm", base + 32), (3, "e", "arm", base + 33), (4, "e", "arm", base + 10)], "probe_id long, entity string, channel string, ts long")
    t = spark.createDataFrame([("arm", 12)], "channel string, tolerance long")
    assert {(r[0], r[2]) for r in match_nearest(p, s, t, 12).collect()} == {(1, 2), (2, 1), (4, 2)}


def test_empty_tables(spark):
    s = spark.createDataFrame([], "sample_id long, entity string, channel string, ts long")
    p = spark.createDataFrame([(1, "e", "arm", 5)], "probe_id long, entity string, channel string, ts long")
    t = spark.createDataFrame([("arm", 12)], "channel string, tolerance long")
    assert match_nearest(p, s, t, 12).count() == 0
    assert match_nearest(p.limit(0), s.union(s), t, 12).count() == 0
