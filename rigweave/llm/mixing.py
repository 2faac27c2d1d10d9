"""Mixing sources to target weights (problem 7): subset-sum budget fitting.

The size of a mixture is the size of all documents together, so a source's budget is its weight times that. A source is
used in full as often as the budget allows; the rest of the budget is met by choosing how many documents of each exact
length to use once more: first the same share of every length, then, for the last tokens, a bounded-knapsack dynamic
program over the stock that is left. Which documents of a length are used follows a seeded rank. The counts by exact
length stay in Spark: a source's (at most sqrt(2 * tokens) lengths) meet in one task, and only one row of sums for each
listed source reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigweave.operators.ranking import seeded_hash, spread_rank
from rigweave.session import settle

#: The dynamic program first runs over about so many tokens (what lies above is taken largest first). While the budget is not
#: met to the token, it runs over twice as many and part of the equal share is given back, at last over the whole budget.
LAST_TOKENS = 65536


def source_key(source: Column) -> Column:
    """Spellings of a source differ in case, spaces, hyphens and underscores only; null and empty give null."""
    return F.nullif(F.regexp_replace(F.lower(source), r"[\s\-_]+", ""), F.lit(""))


def knapsack(lengths: list[int], stock: list[int], budget: int) -> list[int]:
    """How many of each length to take, within stock, so that the sum is as near the budget as possible from below.

    Memory is a few words for each token of the budget: every sum keeps the batch of copies by which it was first reached.
    """
    reach = np.zeros(budget + 1, dtype=bool)
    reach[0] = True
    which, many = np.full(budget + 1, -1, dtype=np.int32), np.zeros(budget + 1, dtype=np.int32)
    for i, (length, n) in enumerate(zip(lengths, stock)):
        n, step = min(n, budget // length), 1
        while n > 0 and not reach[budget]:
            # binary splitting: 1, 2, 4, ... copies at once
            k = min(step, n)
            fresh = np.zeros_like(reach)
            fresh[k * length :] = reach[: budget + 1 - k * length]
            fresh &= ~reach
            which[fresh], many[fresh] = i, k
            reach |= fresh
            n -= k
            step *= 2
        if reach[budget]:
            break
    at = int(np.flatnonzero(reach)[-1])
    taken = [0] * len(lengths)
    while at:
        # the sum before this batch was reached by earlier batches only, so none is used twice
        taken[which[at]] += int(many[at])
        at -= int(many[at]) * lengths[which[at]]
    return taken


def fit_budget(histogram: dict[int, int], budget: int, last: int = LAST_TOKENS) -> dict[int, int]:
    """Documents to take of each length, at most those there are, with a sum as near the budget as possible from below."""
    lengths = np.array([s for s in histogram if s > 0], dtype=np.int64)
    taken = fit_lengths(lengths, np.array([histogram[int(s)] for s in lengths], dtype=np.int64), budget, last)
    return {int(s): int(n) for s, n in zip(lengths, taken)} if budget > 0 else {}


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, last: int = LAST_TOKENS) -> np.ndarray:
    """fit_budget over arrays of distinct, positive lengths and their counts."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0:
        return np.zeros_like(counts)
    # products of counts and budgets can exceed 64 bits
    shared = np.array([int(n) * budget // total for n in counts], dtype=np.int64)
    order = np.argsort(-lengths)
    # sums are multiples of the lengths' common divisor: nearer than that there is nothing
    unit = int(np.gcd.reduce(lengths))
    best, missed, step = shared, budget + 1, 1
    while True:
        taken, left = shared.copy(), budget - int((lengths * shared).sum())
        for i in order:
            if left <= last:
                break
            more = min(int(counts[i] - taken[i]), (left - last) // int(lengths[i]) + 1, left // int(lengths[i]))
            taken[i] += more
            left -= more * int(lengths[i])
        rest = order[::-1][((lengths <= left) & (counts > taken))[order[::-1]]]
        if left and len(rest):
            for i, n in zip(rest, knapsack(lengths[rest].tolist(), (counts - taken)[rest].tolist(), left)):
                taken[i] += n
                left -= n * int(lengths[i])
        if left < missed:
            best, missed = taken, left
        if left < unit or (last >= budget and not shared.any()):
            return best
        last *= 2
        shared = np.maximum(shared - step, 0)
        step *= 2


def _plan(batch: pd.DataFrame) -> pd.DataFrame:
    """full and extra uses of each exact length of one source, by its budget."""
    budget, tokens, repeats = int(batch["budget"].iloc[0]), int(batch["tokens"].iloc[0]), int(batch["repeats"].iloc[0])
    full = min(budget // tokens, repeats) if tokens else repeats
    lengths, counts = batch["n_tokens"].to_numpy(), batch["n"].to_numpy()
    extra, some = np.zeros(len(batch), dtype=np.int64), lengths > 0
    if tokens and full < repeats:
        extra[some] = fit_lengths(lengths[some], counts[some], budget - full * tokens)
    return pd.DataFrame({"of_key": batch["source_key"], "of_tokens": lengths, "n": counts, "full": np.full(len(batch), full), "extra": extra})


def mix(sizes: DataFrame, targets: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The mixture and the shares it reaches.

    sizes(doc_id long, source_key string, n_tokens long); targets(source, target_weight, max_repeats). First result:
    doc_id, source, n_tokens, uses (>= 1, at most max_repeats). Second: source, target_weight, available_tokens,
    target_tokens, mixed_tokens, share (of the mixture), short: the mixture uses every document of the source max_repeats
    times and still stays below the target.
    Documents of unlisted or null sources are counted in the total but never used; a source without documents has share
    0 and is short (unless its weight is 0); texts without tokens are used as often as a source is used in full, which costs nothing.
    Repeated rows are documents of their own; other columns are ignored; without documents there is nothing to mix and
    nothing is short.
    """
    spark = sizes.sparkSession
    sizes = sizes.select("doc_id", "source_key", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))
    counts = settle(sizes.groupBy("source_key", "n_tokens").agg(F.count(F.lit(1)).alias("n")), "lengths")
    total = int(counts.agg(F.sum(F.col("n_tokens") * F.col("n"))).first()[0] or 0)
    wanted = targets.withColumn("source_key", source_key(F.col("source"))).select("source", "source_key", "target_weight", "max_repeats").collect()
    keys = [w["source_key"] for w in wanted]
    have = {r["source_key"]: int(r["t"]) for r in counts.where(F.col("source_key").isin(keys)).groupBy("source_key").agg(F.sum(F.col("n_tokens") * F.col("n")).alias("t")).collect()}
    # decimal weights arrive as doubles: a budget is whole tokens, rounded
    rows = [(w["source_key"], w["source"], float(w["target_weight"]), round(w["target_weight"] * total), have.get(w["source_key"], 0), int(w["max_repeats"] or 0)) for w in wanted]
    goals = spark.createDataFrame(rows, "goal_key string, source string, target_weight double, budget long, tokens long, repeats int")
    asked = counts.join(F.broadcast(goals), F.col("source_key") == F.col("goal_key")).select("source_key", "n_tokens", "n", "budget", "tokens", "repeats")
    plan = settle(asked.groupBy("source_key").applyInPandas(_plan, "of_key string, of_tokens long, n long, full long, extra long"), "uses")
    reached = plan.groupBy("of_key").agg(F.sum(F.col("of_tokens") * (F.col("n") * F.col("full") + F.col("extra"))).alias("m"), F.sum(F.col("n") * F.col("full") + F.col("extra")).alias("u"), F.sum("n").alias("d"))
    got = {r["of_key"]: (int(r["m"]), int(r["u"]), int(r["d"])) for r in reached.collect()}
    whole = sum(m for m, _, _ in got.values())
    report = []
    for key, source, weight, budget, tokens, repeats in rows:
        mixed, uses, docs = got.get(key, (0, 0, 0))
        report.append((source, weight, tokens, budget, mixed, round(mixed / whole, 9) if whole else 0.0, uses == docs * repeats and mixed < weight * total))
    shares = spark.createDataFrame(report, "source string, target_weight double, available_tokens long, target_tokens long, mixed_tokens long, share double, short boolean")
    ranked = spread_rank(sizes.where(F.col("source_key").isin(keys)).withColumn("h", seeded_hash(seed, "doc_id")), ["source_key", "n_tokens"], "h", ["doc_id"], rows=sum(d for _, _, d in got.values()))
    names = F.broadcast(goals.select("goal_key", "source"))
    used = ranked.join(plan.where("full > 0 or extra > 0"), (F.col("source_key") == F.col("of_key")) & (F.col("n_tokens") == F.col("of_tokens"))).join(names, F.col("source_key") == F.col("goal_key"))
    uses = F.col("full") + F.when(F.col("rank") < F.col("extra"), 1).otherwise(0)
    return used.select("doc_id", "source", "n_tokens", uses.alias("uses")).where("uses > 0"), shares


def short_sources(sizes: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """Sources that the mixture uses to the last document max_repeats times and that stay below their target all the same."""
    used, shares = mix(sizes, targets, seed)
    # what the chosen documents really add up to, by source
    reached = used.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("reached")).withColumnRenamed("source", "of_source")
    met = shares.where("short").join(reached, F.col("source") == F.col("of_source"), "left")
    return met.where(F.coalesce("reached", F.lit(0)) == F.col("mixed_tokens")).select("source")
