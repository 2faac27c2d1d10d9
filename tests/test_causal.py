import random

import pytest
from pyspark.sql import functions as F

from rigweave.operators.asof import both_sides, strict_asof
from rigweave.operators.causal import curated, synchronize
from rigweave.operators.contract import verdicts, violations
from rigweave.operators.intervals import clean_gaps
from rigweave.sources.contracts import CURATED

TICKS = "episode_id string, tick long, ts_ns long"
HOLES = "episode_id string, start_ns long, end_ns long"
ACTIONS = "episode_id string, tick long, action_id long, arm_ns long, hand_ns long, arm_ok boolean, hand_ok boolean, whole_ok boolean, finite boolean, mismatch boolean"
SAMPLES = "episode_id string, channel string, ts long, row long, eligible boolean, frame_index long"
FRAMES = "episode_id string, channel string, frame_index long, decodable boolean"


def world(seed, n=40):
    """Random tables of three episodes with ties, repeats, nulls and holes."""
    rng = random.Random(seed)
    ticks, actions, samples, frames, holes = [], [], [], [], []
    for e in ("a", "b", "c"):
        for t in range(n):
            if rng.random() < 0.9:
                at = t * 100
                ticks.append((e, t, at))
                if rng.random() < 0.9:
                    ok = [rng.random() < 0.95 for _ in range(4)]
                    actions.append((e, t, len(actions), rng.choice([at + rng.randrange(1, 60), 0, None]) if rng.random() < 0.1 else at + rng.randrange(1, 60), at + rng.randrange(1, 60), ok[0], ok[1], None if rng.random() < 0.03 else ok[2], ok[3], rng.random() < 0.05))
        for c in ("arm", "hand", "head", "wrist"):
            for k in range(n * 2):
                samples.append((e, c, rng.choice([rng.randrange(-50, n * 100), rng.randrange(0, n) * 100 + 7]), len(samples), rng.choice([True, True, True, False, None]), rng.randrange(30) if c in ("head", "wrist") else None))
        for c in ("head", "wrist"):
            frames += [(e, c, f, rng.choice([True, None, None, False])) for f in range(30) if rng.random() < 0.9]
    holes = [("a", 500, 700), ("a", 1500, 1500), ("b", 2000, None), ("nobody", 1, 2)]
    samples += samples[:20]
    return ticks, holes, actions, samples, frames


def by_hand(ticks, holes, actions, samples, frames):
    def place(e, t):
        if t is None:
            return None
        mine = [(s, x) for h, s, x in holes if h == e]
        if any(s <= t and (x is None or t <= x) for s, x in mine):
            return None
        return sum(x is not None and x < t for _, x in mine)

    out = {}
    acts = {(a[0], a[1]): a for a in actions}
    pictures = {(f[0], f[1], f[2]): f[3] for f in frames}
    for e in sorted({t[0] for t in ticks if t[0]}):
        rows = sorted((t[1], t[2]) for t in ticks if t[0] == e)
        for (k, at), (_, after) in zip(rows, rows[1:]):
            here = place(e, at)
            if here is None or place(e, after) != here:
                out[e, k] = ["INTERVENTION_CONTAMINATED"]
                continue
            a = acts.get((e, k))
            _, _, _, arm, hand, arm_ok, hand_ok, whole_ok, finite, mismatch = a or (None,) * 10
            r = ["ACTION_ARM_COMMAND_FLAG_INVALID"] * (not arm_ok) + ["ACTION_HAND_COMMAND_FLAG_INVALID"] * (not hand_ok) + ["ACTION_ROBOT_COMMAND_FLAG_INVALID"] * (not whole_ok)
            r += ["ACTION_TIMESTAMP_NONPOSITIVE"] * any(x is not None and x <= 0 for x in (arm, hand)) + ["ACTION_NONFINITE"] * (finite is False) + ["ACTION_COMPONENT_MISMATCH"] * (mismatch is True)
            if r:
                out[e, k] = sorted(r)
                continue
            known = [x for x in (arm, hand) if x is not None]
            start, end = min(known), max(known)
            if place(e, start) != here or place(e, end) != here:
                out[e, k] = ["INTERVENTION_CONTAMINATED"]
                continue
            picks = {}
            for part, c, later in (("ARM_PRE", "arm", False), ("HAND_PRE", "hand", False), ("HEAD_CAMERA", "head", False), ("WRIST_CAMERA", "wrist", False), ("ARM_POST", "arm", True), ("HAND_POST", "hand", True)):
                side = [s for s in samples if s[0] == e and s[1] == c and (s[2] > end if later else s[2] < start)]
                good = [s for s in side if s[4]]
                pick = (min(good, key=lambda s: (s[2], s[3])) if later else max(good, key=lambda s: (s[2], s[3]))) if good else None
                picks[part] = pick
                if part.endswith("CAMERA"):
                    r += [f"CAMERA_{part}_UNAVAILABLE"] if pick is None else [f"CAMERA_{part}_MEDIA_MISSING"] if (e, c, pick[5]) not in pictures else [f"CAMERA_{part}_DECODE_INVALID"] * (pictures[e, c, pick[5]] is False)
                else:
                    r += [f"CAUSALITY_{part}_UNAVAILABLE"] if not any(s[2] > 0 for s in side) else [f"FEEDBACK_{part}_INVALID"] * (pick is None)
            if not r and any(place(e, p[2]) != here for p in picks.values()):
                r = ["INTERVENTION_CONTAMINATED"]
            out[e, k] = sorted(r)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_synchronize_against_brute_force(spark, seed):
    w = world(seed)
    df = [spark.createDataFrame(rows, schema) for rows, schema in zip(w, (TICKS, HOLES, ACTIONS, SAMPLES, FRAMES))]
    df[0] = df[0].unionByName(spark.createDataFrame([(None, 1, 5)], TICKS)).withColumn("here", F.lit("clash")).withColumn("lo", F.lit(1))
    got = {(r["episode_id"], r["tick"]): r["reasons"] for r in synchronize(*df).collect()}
    want = by_hand(*w)
    assert got == want and len({x for r in want.values() for x in r}) > 8 and any(not r for r in want.values())


def test_synchronize_of_empty_tables(spark):
    empty = [spark.createDataFrame([], s) for s in (TICKS, HOLES, ACTIONS, SAMPLES, FRAMES)]
    assert synchronize(*empty).count() == 0
    ticks = spark.createDataFrame([("a", 1, 10), ("a", 2, 20)], TICKS)
    done = synchronize(ticks, *empty[1:])
    assert [r["reasons"] for r in done.collect()] == [["ACTION_ARM_COMMAND_FLAG_INVALID", "ACTION_HAND_COMMAND_FLAG_INVALID", "ACTION_ROBOT_COMMAND_FLAG_INVALID"]]
    assert curated(done).count() == 0


def test_both_sides_agree_with_one(spark):
    rng = random.Random(4)
    samples = [(rng.choice(["a", "b"]), "x", rng.randrange(-40, 400), i, rng.random() < 0.6, i) for i in range(150)] + [("a", None, 5, 1, True, 1), (None, "x", 5, 1, True, 1), ("a", "x", None, 1, True, 1)]
    asked = [(i, rng.choice(["a", "b", "z"]), rng.choice([rng.randrange(-60, 420), samples[i][2]])) for i in range(120)]
    s = spark.createDataFrame(samples, "entity string, channel string, ts long, row long, eligible boolean, payload long")
    q = spark.createDataFrame(asked + [(500, None, 3), (501, "a", None)], "id long, entity string, ts long")
    both = q.select("entity", F.lit("x").alias("channel"), "ts", F.explode(F.array(F.lit(False), F.lit(True))).alias("after"), F.struct("id").alias("ask"))
    got = {(r["ask"]["id"], r["after"]): (r["pick_ts"], r["pick_row"], r["payload"], r["any_positive"]) for r in both_sides(both, s, bucket_bits=5).collect()}
    want = {}
    for after in (False, True):
        one = strict_asof(q.select(F.col("id").alias("boundary_id"), "entity", "ts"), s.where("channel = 'x'").drop("channel"), after, bucket_bits=7)
        want |= {(r["boundary_id"], after): (r["pick_ts"], r["pick_row"], r["payload"], r["any_positive"]) for r in one.collect()}
    assert got == want and len(want) == 240


def test_clean_gaps_against_a_scan(spark):
    rng = random.Random(6)
    holes, points = [], []
    for e in "abc":
        at = 0
        for _ in range(12):
            at += rng.randrange(1, 1 << 37)
            end = at + rng.choice([0, 5, 1 << 36])
            holes.append((e, at, end))
            at = end + 1
        points += [(e, rng.choice([h[1] for h in holes if h[0] == e] + [h[2] for h in holes if h[0] == e]) + rng.choice([-1, 0, 1])) for _ in range(60)]
    holes.append(("d", 50, None))
    points += [("d", 49), ("d", 50), ("d", 51), ("e", 3), (None, 3), ("a", None)]
    got = {(r["e"], r["t"]): (r["clean"], r["lo"], r["hi"]) for r in clean_gaps(spark.createDataFrame(points, "e string, t long"), spark.createDataFrame(holes, "e string, start_ns long, end_ns long"), "e", "t").collect()}
    for e, t in set(points):
        if e is None or t is None:
            assert got[e, t] == (False, None, None)
            continue
        mine = [(s, x) for h, s, x in holes if h == e]
        clean = not any(s <= t and (x is None or t <= x) for s, x in mine)
        assert got[e, t] == (clean, max((x for _, x in mine if x is not None and x < t), default=None), min((s for s, _ in mine if s > t), default=None))


def test_contract_rules(spark):
    good = dict(zip(CURATED.names, (0, 1, 20, 40, 50, 10, 20, 30, 40, [0.0] * 17, [0.0] * 17, 3, 4)))
    bad = good | {"source_tick_index": 1, "next_state_tick_index": 3, "state_timestamp_ns": 35, "arm_qcmd_source_timestamp_ns": 0, "robot_qpos_17d_rad": [0.0] * 16, "robot_qcmd_17d_rad": [float("nan")] * 17, "head_rgb_frame_index": 9, "right_wrist_rgb_frame_index": -1}
    same_tick = bad | {"hand_qpos_source_timestamp_ns": None, "robot_qcmd_17d_rad": None}
    rows = [("ok", good), ("bad", bad), ("bad", same_tick)]
    df = spark.createDataFrame([(e, *[r[c] for c in CURATED.names]) for e, r in rows], "episode_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CURATED))
    stored = spark.createDataFrame([("ok", "head", 3), ("ok", "wrist", 4), ("ok", "wrist", 5), ("bad", "head", 8), ("other", "head", 1)], "episode_id string, role string, frame_index long")
    got = {(r["episode_id"], r["rule"]): r["n"] for r in violations(df, stored).collect()}
    assert {k: v for k, v in got.items() if k[0] == "ok"} == {("ok", "MEDIA_UNREFERENCED"): 1}
    assert {r: n for (e, r), n in got.items() if e == "bad"} == {
        "ARM_QCMD_SOURCE_TIMESTAMP_NS_NOT_POSITIVE": 2, "HAND_QPOS_SOURCE_TIMESTAMP_NS_MISSING": 1, "ROBOT_QCMD_17D_RAD_MISSING": 1, "ROBOT_QPOS_17D_RAD_WIDTH": 2, "ROBOT_QCMD_17D_RAD_NOT_FINITE": 1, "NEXT_TICK_NOT_SUCCESSOR": 2,
        "TICK_NOT_INCREASING": 1, "STATE_TIME_NOT_LATEST": 2, "STATE_NOT_BEFORE_ACTION": 2, "WRIST_FRAME_NEGATIVE": 2, "MEDIA_MISSING": 1, "MEDIA_UNREFERENCED": 1}
    judged = {r["episode_id"]: (r["quality"], len(r["errors"])) for r in verdicts(df.select("episode_id").distinct(), violations(df, stored), ("MEDIA_UNREFERENCED",)).collect()}
    assert judged == {"ok": ("WARN", 0), "bad": ("FAIL", 11)}
    assert violations(df.limit(0), stored).count() == 0
