import math
import random

from rigweave.operators.spikes import Series, SpikeRules, find_implausible, normal_run, step_bin, step_top

import numpy as np
import pytest

SCHEMA = "ident long, owner string, seq long, source string, hour int, raw long, v_x array<double>, extra string"
SERIES = Series(("x", "x"), (0, 1), (-10.0, -10.0), (10.0, 10.0))


def course(n, step, seed):
    rng, x, out = random.Random(seed), 0.0, []
    for _ in range(n):
        x += rng.uniform(-step, step)
        x = max(-5, min(5, x))
        out.append(round(x, 6))
    return out


def make(n=1500, owners=("a", "b"), gap=None):
    rows = []
    for o, owner in enumerate(owners):
        a, b = course(n, 0.01, o), course(n, 0.2, 10 + o)
        for i in range(n):
            seq = i if gap is None or i < n // 2 else i + gap
            rows.append([o * 10000 + i, owner, seq, "rig" if i % 9 else None, 3, 0, [a[i], b[i]], "x"])
    return rows


def found(spark, rows, rules=SpikeRules(), series=SERIES):
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
    return {(r["record_id"], r["joint"]) for r in find_implausible(df, series, rules).collect()}


def planted(rows):
    want = set()
    rows[300][6] = [rows[300][6][0] + 1.0, rows[300][6][1]]
    want.add((rows[300][0], 0))
    for i in (500, 501):
        rows[i][6] = [rows[i][6][0], rows[i][6][1] + 4.0 if rows[i][6][1] < 0 else rows[i][6][1] - 4.0]
        want.add((rows[i][0], 1))
    for i in range(701, 740):
        rows[i][6] = [rows[700][6][0], rows[i][6][1]]
        want.add((rows[i][0], 0))
    rows[900][6] = [99.0, float("nan")]
    rows[901][6] = [None, float("inf")]
    want |= {(rows[900][0], 0), (rows[900][0], 1), (rows[901][0], 1)}
    return want


def test_finds_what_was_planted(spark):
    rows = make()
    want = planted(rows)
    rows += [list(r) for r in rows[::50]]  # sent again
    random.Random(3).shuffle(rows)
    assert found(spark, rows) == want


@pytest.mark.parametrize("block,halo", [(64, 48), (256, 8), (32, 2)])
def test_blocks_do_not_change_the_result(spark, block, halo):
    rows = make()
    want = planted(rows)
    assert found(spark, rows, SpikeRules(block=block, halo=halo)) == want


def test_runs_across_missing_rows_are_settled_exactly(spark):
    rows = make(gap=5000)
    half = 750
    for i in range(half - 20, half + 20):
        rows[i][6] = [rows[half - 20][6][0], rows[i][6][1]]
    want = {(rows[i][0], 0) for i in range(half - 19, half + 20)}
    assert want <= found(spark, rows, SpikeRules(block=512, halo=64))


def test_a_series_that_never_moves_is_no_case(spark):
    rows = make(400)
    for r in rows:
        r[6] = [1.0, r[6][1]]
    assert found(spark, rows) == set()


def test_a_slow_or_coarse_series_keeps_its_cases(spark):
    rows = make(1500, ("a",))
    for i, r in enumerate(rows):
        r[6] = [round(0.002 * (i // 6), 6), r[6][1]]  # five steps of six are zero
    rows[300][6] = [rows[300][6][0] + 1.0, rows[300][6][1]]
    for i in range(601, 660):
        rows[i][6] = [rows[600][6][0], rows[i][6][1]]
    assert found(spark, rows) == {(rows[300][0], 0)} | {(rows[i][0], 0) for i in range(601, 660)}


def test_a_jump_of_a_series_at_rest_is_a_case(spark):
    rows = make(400, ("a",))
    for i, r in enumerate(rows):
        r[6] = [3.0 if i in (100, 101) else 1.0, r[6][1]]
    assert found(spark, rows) == {(rows[100][0], 0), (rows[101][0], 0)}


def test_nulls_and_odd_shapes(spark):
    rows = [[1, None, 5, "rig", 1, 0, [50.0, 0.0], "x"], [2, "a", None, None, None, None, [0.0, -50.0], "x"], [3, "a", 1, "rig", 1, 0, None, None], [4, "a", 2, "rig", 1, 0, [0.0], None], [5, "a", 3, "rig", 1, 0, [0.0, 0.0, 99.0], None], [None, "a", 4, "rig", 1, 0, [99.0, 0.0], None]]
    assert found(spark, rows) == {(1, 0), (2, 1)}
    assert found(spark, []) == set()


def test_lag_series(spark):
    rng = random.Random(5)
    rows, want = [], set()
    for i in range(800):
        tick = 10**15 + i * 33_000_000
        cam = tick - 20_000_000 - rng.randrange(0, 3_000_000)
        if i in (100, 101):
            cam, _ = tick - 5_000_000_000, want.add((i, -1))
        if i == 200:
            cam, _ = tick + 5_000_000, want.add((i, -1))
        if 300 <= i < 340:
            cam = 10**15 + 300 * 33_000_000 - 21_000_000
            if i > 300:
                want.add((i, -1))
        rows.append((i, "e", i, "rig", 0, cam if i != 400 else None, float(tick - cam) if i != 400 else None))
    df = spark.createDataFrame(rows, "ident long, owner string, seq long, source string, hour int, raw long, v_lag double")
    series = Series(("cam",), (-1,), (0.0,), (3.6e12,), lag=True)
    got = {(r["record_id"], r["joint"]) for r in find_implausible(df, series, SpikeRules(fence=1.0, high=0.95)).collect()}
    assert got == want


def test_sketch_bins():
    x = np.array([0.0, 1e-12, 0.5, 3.0, 1e9, math.inf])
    b = step_bin(x)
    assert b[0] == 0 and (np.diff(b) >= 0).all()
    assert 0.5 <= step_top(b[2]) <= 0.5 * 1.2000001
    assert normal_run(np.array([1, 2, 3, 40]), np.array([900, 60, 5, 1]), SpikeRules()) == 3


def test_values_held_for_rows_hide_neither_spike_nor_freeze(spark):
    rng = random.Random(11)
    rows, want, ident = [], set(), 0
    for o in range(3):
        x, left = 0.0, 0
        for i in range(9000):
            if not left:
                x, left = max(-5, min(5, round(x + rng.uniform(0.005, 0.015) * rng.choice((-1, 1)), 6))), rng.randrange(5, 9)
            left -= 1
            value = x
            if o == 0 and i == 2000:
                value = x + 5.0 if x < 0 else x - 5.0
                want.add((ident, 0))
            if o == 1 and 3000 <= i < 7000:
                if i == 3000:
                    frozen, left = x, 8
                value, left = frozen, max(left, 1)
            rows.append([ident, f"o{o}", i, "rig", i // 400 % 24, 0, [value, 0.0], None])
            ident += 1
    first = next(k for k in range(9000 + 3000, 0, -1) if rows[k - 1][6][0] != rows[9000 + 3000][6][0])
    last = next(k for k in range(9000 + 6999, 18000) if rows[k + 1][6][0] != rows[9000 + 3000][6][0])
    want |= {(rows[k][0], 0) for k in range(first + 1, last + 1)}
    assert found(spark, rows) == want


@pytest.mark.parametrize("halo", [4, 128])
def test_a_frozen_stretch_over_many_blocks_is_found_whole(spark, halo):
    rows = make(1500, ("a",))
    for i in range(130, 1300):
        rows[i][6] = [rows[130][6][0], rows[i][6][1]]
        if i % 7 == 0:
            rows[i][6] = [None, rows[i][6][1]]
    want = {(rows[i][0], 0) for i in range(131, 1300) if i % 7}
    assert found(spark, rows, SpikeRules(block=64, halo=halo)) == want
