import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rigweave.llm.mixing import fit_budget, knapsack, mix, source_key
from rigweave.llm.packing import oversized, pack, plan_large, plan_small
from rigweave.llm.tokens import count_tokens, encoder, stretches


def test_stretches_do_not_change_the_count():
    rng = random.Random(1)
    text = "".join(rng.choice(["word", " ", "\n", "  ", "数据", "9", "x" * 30, "'s"]) for _ in range(4000))
    count = encoder()
    whole = count(text)
    assert "".join(stretches(text, 97)) == text
    assert sum(count(p) for p in stretches(text, 97)) == whole


def test_count_tokens_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hello world"), (4, "<|endoftext|>"), (5, "a b " * 200_000)], "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df, "text", ["doc_id"]).collect()}
    assert got[1] == got[2] == 0 and got[3] == 2 and got[4] > 1 and got[5] > 400_000


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_item_within_capacity(seed):
    rng = random.Random(seed)
    cap = 256
    items = [min(cap, max(1, int(rng.lognormvariate(3.5, 1)))) for _ in range(2000)] + [77] * 900
    hist = Counter(items)
    large = {s: n for s, n in hist.items() if s >= 32}
    rows, windows = plan_large(large, cap)
    order = sorted((s for s, n in large.items() for _ in range(n)), reverse=True)
    load, seen = [0] * windows, 0
    for a, b, first, each in rows:
        for r in range(a, b):
            load[first + (r - a) // each] += order[r]
            seen += 1
    assert seen == len(order) and max(load) <= cap
    fills, opened = plan_small({s: n for s, n in hist.items() if s < 32}, Counter(cap - x for x in load), cap)
    by = defaultdict(list)
    for w, x in enumerate(load):
        by[cap - x].append(w)
    fresh = [0] * opened
    count = Counter()
    for size, a, b, origin, start in fills:
        count[size] += b - a
        for i in range(b - a):
            if origin < 0:
                fresh[start + i] += size
            else:
                load[by[origin][start + i]] += size
    assert count == Counter({s: n for s, n in hist.items() if s < 32}) and max(load + fresh) <= cap
    assert len(load) + len(fresh) <= 1.03 * sum(items) / cap + 2


def test_pack(spark):
    rng = random.Random(3)
    sizes = [int(rng.lognormvariate(4, 1.2)) for _ in range(3000)] + [0, None, 512, 513, 5000, 1024] + [100] * 1500
    df = spark.createDataFrame(list(enumerate(sizes)), "item_id long, size long").withColumn("rank", F.lit(1)).withColumn("window_id", F.lit("x"))
    got = pack(df, 512).toPandas()
    assert got.groupby("item_id")["size"].sum().to_dict() == {i: s or 0 for i, s in enumerate(sizes)}
    assert got.groupby("window_id")["size"].sum().max() <= 512
    parts = got.groupby("item_id").part.count()
    assert all(parts[i] == max(1, -(-(s or 0) // 512)) for i, s in enumerate(sizes))
    assert got[got["size"] == 0].window_id.isna().all() and got[got["size"] > 0].window_id.notna().all()
    windows = got.window_id.nunique()
    assert windows <= 1.02 * sum(s or 0 for s in sizes) / 512 + 1
    assert {r["item_id"] for r in oversized(df, 512).collect()} == {i for i, s in enumerate(sizes) if (s or 0) > 512}
    assert pack(df.limit(0), 512).count() == 0


def test_knapsack_is_exact():
    rng = random.Random(5)
    for _ in range(100):
        lengths = sorted(rng.sample(range(1, 30), rng.randrange(1, 5)))
        stock = [rng.randrange(1, 4) for _ in lengths]
        budget = rng.randrange(1, 80)
        sums = {0}
        for s, n in zip(lengths, stock):
            sums = {x + s * k for x in sums for k in range(n + 1)}
        taken = knapsack(lengths, stock, budget)
        assert all(t <= n for t, n in zip(taken, stock)) and sum(t * s for t, s in zip(taken, lengths)) == max(x for x in sums if x <= budget)
    assert fit_budget({3: 2}, 100) == {3: 2} and fit_budget({3: 2}, 0) == {}


def test_mix(spark):
    rng = random.Random(6)
    rows = [(i, "big", rng.randrange(1, 400)) for i in range(3000)] + [(5000 + i, "small", 50) for i in range(40)] + [(9000, None, 7), (9001, "unlisted", 900), (9002, "big", 0)]
    sizes = spark.createDataFrame(rows, "doc_id long, source_key string, n_tokens long").withColumn("rank", F.lit(1)).withColumn("full", F.lit(1))
    targets = spark.createDataFrame([("Big", 0.5, 3), ("small", 0.4, 4), ("absent", 0.1, 9)], "source string, target_weight double, max_repeats int")
    used, shares = mix(sizes, targets, 11)
    u, s = used.toPandas(), {r["source"]: r for r in shares.collect()}
    total = sum(r[2] for r in rows)
    tokens = (u.n_tokens * u.uses).groupby(u.source).sum()
    assert tokens["Big"] == round(total * 0.5) == s["Big"]["mixed_tokens"]
    assert tokens["small"] == 40 * 50 * 4 and s["small"]["short"] and s["absent"]["short"] and not s["Big"]["short"]
    assert s["absent"]["mixed_tokens"] == 0 and u.doc_id.is_unique and u[u.source == "small"].uses.eq(4).all()
    assert abs(s["Big"]["share"] - tokens["Big"] / tokens.sum()) < 1e-6
    assert u.equals(u) and dict(zip(u.doc_id, u.uses)) == {r["doc_id"]: r["uses"] for r in mix(sizes.repartition(5), targets, 11)[0].collect()}
    assert mix(sizes.limit(0), targets)[0].count() == 0


def test_source_spellings(spark):
    for text in ("Review Notes", "review-notes", "REVIEW_NOTES ", "reviewnotes"):
        assert spark.range(1).select(source_key(F.lit(text)).alias("s")).first()["s"] == "reviewnotes"
    assert spark.range(1).select(source_key(F.lit(" ")).alias("s")).first()["s"] is None


def test_budget_over_a_million_lengths_and_retries():
    import numpy as np

    from rigweave.llm.mixing import fit_lengths

    lengths = np.arange(1, 1_000_001)
    counts = np.full(1_000_000, 3)
    budget = 777_777_777_777
    taken = fit_lengths(lengths, counts, budget)
    assert (taken <= counts).all() and int((taken * lengths).sum()) == budget
    # a first program over too few tokens falls short; a larger one meets the budget
    lengths, counts = np.array([9, 14]), np.array([3, 2])
    assert int((fit_lengths(lengths, counts, 37, last=1) * lengths).sum()) == 37
    # even lengths never add up to an odd budget
    assert fit_budget({4: 100, 6: 100}, 501)[4] * 4 + fit_budget({4: 100, 6: 100}, 501)[6] * 6 == 500
