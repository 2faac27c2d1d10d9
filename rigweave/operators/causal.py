"""Causal synchronisation of independently clocked channels: every candidate transition, accepted or with its reasons.

A candidate is a tick and the next one of its episode. Gates run in order and a later one is not asked once an earlier one
rejects: interventions at the two ticks; the action; the action's clean stretch; the samples before and after it and the
cameras' frames; the evidence's clean stretch and strict order. All as-of questions of all candidates, on both sides, are
answered by one pass over the samples, and only for candidates that the first gates let through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigweave.operators.asof import both_sides
from rigweave.operators.intervals import clean_gaps
from rigweave.operators.reasons import reasons
from rigweave.operators.sequence import neighbour
from rigweave.session import settle

CONTAMINATED = "INTERVENTION_CONTAMINATED"
#: Part of the evidence, its channel, and whether it lies after the action.
PARTS = (("ARM_PRE", "arm", False), ("HAND_PRE", "hand", False), ("HEAD_CAMERA", "head", False), ("WRIST_CAMERA", "wrist", False), ("ARM_POST", "arm", True), ("HAND_POST", "hand", True))


def action_reasons(arm_ok: Column, hand_ok: Column, whole_ok: Column, arm_ns: Column, hand_ns: Column, finite: Column, mismatch: Column) -> Column:
    """All reasons for which an action is refused; an unknown condition refuses nothing."""
    return reasons(
        ("ACTION_ARM_COMMAND_FLAG_INVALID", ~arm_ok), ("ACTION_HAND_COMMAND_FLAG_INVALID", ~hand_ok), ("ACTION_ROBOT_COMMAND_FLAG_INVALID", ~whole_ok),
        ("ACTION_TIMESTAMP_NONPOSITIVE", (arm_ns <= 0) | (hand_ns <= 0)), ("ACTION_NONFINITE", ~finite), ("ACTION_COMPONENT_MISMATCH", mismatch))


def synchronize(ticks: DataFrame, holes: DataFrame, actions: DataFrame, samples: DataFrame, frames: DataFrame) -> DataFrame:
    """episode_id, tick, next_tick, action_id, start_ns, end_ns, reasons (empty if accepted) and evidence of every candidate.

    ticks(episode_id, tick, ts_ns); holes(episode_id, start_ns, end_ns), interventions that do not overlap, ends included;
    actions(episode_id, tick, action_id, arm_ns, hand_ns, arm_ok, hand_ok, whole_ok, finite, mismatch), one for a tick;
    samples(episode_id, channel, ts, row, eligible, frame_index); frames(episode_id, channel, frame_index, decodable), one
    for a stored image, decodable null where nobody looked. evidence: map from each of PARTS to struct(row, ts, frame_index),
    null for candidates that the first gates reject. A tick without an action has no flag that holds. Ticks without
    episode are left out; other columns are ignored; without ticks there are no candidates.
    """
    rows = ticks.where("episode_id is not null").select("episode_id", "tick", "ts_ns")
    placed = clean_gaps(rows, holes, "episode_id", "ts_ns")
    pair = neighbour(placed, "episode_id", "tick", {"next_tick": "tick", "next_clean": "clean", "next_lo": "lo"}, after=True).where("next_tick is not null")
    acts = actions.select(F.col("episode_id").alias("a_episode"), F.col("tick").alias("a_tick"), "action_id", "arm_ns", "hand_ns", "arm_ok", "hand_ok", "whole_ok", "finite", "mismatch")
    c = pair.join(acts, (F.col("episode_id") == F.col("a_episode")) & (F.col("tick") == F.col("a_tick")), "left")
    c = c.withColumns({"start_ns": F.least("arm_ns", "hand_ns"), "end_ns": F.greatest("arm_ns", "hand_ns")})
    gate1 = F.when(~(F.col("clean") & F.col("next_clean") & F.col("lo").eqNullSafe(F.col("next_lo"))), F.array(F.lit(CONTAMINATED)))
    gate2 = action_reasons(*[F.coalesce(x, F.lit(False)) for x in ("arm_ok", "hand_ok", "whole_ok")], F.col("arm_ns"), F.col("hand_ns"), F.col("finite"), F.col("mismatch"))
    within = lambda at: (at > F.coalesce("lo", F.lit(-(2**63)))) & (at < F.coalesce("hi", F.lit(2**63 - 1)))
    gate3 = F.when(~(within(F.col("start_ns")) & within(F.col("end_ns"))), F.array(F.lit(CONTAMINATED))).otherwise(F.array().cast("array<string>"))
    c = c.withColumn("first", F.coalesce(gate1, F.when(F.size(gate2) > 0, gate2), gate3))
    # read by the two steps of the as-of pass and by the result: written once
    c = settle(c.select("episode_id", "tick", "next_tick", "action_id", "start_ns", "end_ns", "lo", "hi", "first"), "candidates")
    ready = c.where(F.size("first") == 0).drop("first")

    parts = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(ch).alias("channel"), F.lit(after).alias("after")) for p, ch, after in PARTS])
    asked = ready.select(F.struct(*ready.columns).alias("ask"), F.explode(parts).alias("p")).select(
        F.struct("ask.*", "p.part").alias("ask"), F.col("ask.episode_id").alias("entity"), "p.channel", "p.after", F.when(F.col("p.after"), F.col("ask.end_ns")).otherwise(F.col("ask.start_ns")).alias("ts"))
    have = samples.where("episode_id is not null").select(F.col("episode_id").alias("entity"), "channel", "ts", "row", "eligible", F.col("frame_index").alias("payload"))
    met = both_sides(asked, have).select("ask.*", "channel", "pick_row", "pick_ts", F.col("payload").alias("frame_index"), "any_positive")
    # only picks of a camera can meet an image; the others are spread by their tick, not gathered by a missing frame
    salt = F.when(F.col("part").endswith("_CAMERA") & F.col("pick_row").isNotNull(), F.lit(-1).cast("long")).otherwise(F.abs("tick"))
    stored = frames.select(
        F.col("episode_id").alias("f_episode"), F.col("channel").alias("f_channel"), F.col("frame_index").alias("f_frame"), F.coalesce("decodable", F.lit(True)).alias("fine"), F.lit(-1).cast("long").alias("f_salt"))
    same = (F.col("episode_id") == F.col("f_episode")) & (F.col("channel") == F.col("f_channel")) & (F.col("frame_index") == F.col("f_frame")) & (F.col("salt") == F.col("f_salt"))
    evidence = met.withColumn("salt", salt).join(stored, same, "left")
    name = lambda head, tail: F.concat(F.lit(head), "part", F.lit(tail))
    code = F.when(
        F.col("part").endswith("_CAMERA"),
        F.when(F.col("pick_row").isNull(), name("CAMERA_", "_UNAVAILABLE")).when(F.col("fine").isNull(), name("CAMERA_", "_MEDIA_MISSING")).when(~F.col("fine"), name("CAMERA_", "_DECODE_INVALID")),
    ).when(~F.col("any_positive"), name("CAUSALITY_", "_UNAVAILABLE")).when(F.col("pick_row").isNull(), name("FEEDBACK_", "_INVALID"))
    keys = ["episode_id", "tick", "next_tick", "action_id", "start_ns", "end_ns"]
    # six rows a candidate
    judged = evidence.withColumns({"code": code, "off": ~F.coalesce(within(F.col("pick_ts")), F.lit(False))}).groupBy(*keys).agg(
        F.array_sort(F.collect_list("code")).alias("missing"), F.max("off").alias("off"), F.map_from_entries(F.collect_list(F.struct("part", F.struct(F.col("pick_row").alias("row"), F.col("pick_ts").alias("ts"), "frame_index")))).alias("evidence"))
    ts = lambda part: F.col("evidence")[part]["ts"]
    late = reasons((CONTAMINATED, F.col("off")), ("CAUSALITY_PRE_NOT_STRICT", F.greatest(ts("ARM_PRE"), ts("HAND_PRE")) >= F.col("start_ns")), ("CAUSALITY_POST_NOT_STRICT", F.col("end_ns") >= F.least(ts("ARM_POST"), ts("HAND_POST"))))
    rest = judged.select(*keys, F.when(F.size("missing") > 0, F.col("missing")).otherwise(late).alias("reasons"), "evidence")
    early = c.where(F.size("first") > 0).select(*keys, F.col("first").alias("reasons"), F.lit(None).cast(dict(rest.dtypes)["evidence"]).alias("evidence"))
    return early.unionByName(rest)


def curated(synchronized: DataFrame) -> DataFrame:
    """One row for each accepted candidate with the times, rows and lags of its evidence (13 columns of the contract but for the vectors, then the metrics)."""
    ok = synchronized.where((F.size("reasons") == 0) & F.col("evidence").isNotNull())
    of = lambda part, field: F.col("evidence")[part][field]
    ok = ok.select(
        "episode_id", F.col("tick").alias("source_tick_index"), F.col("next_tick").alias("next_state_tick_index"), "action_id", "start_ns",
        F.greatest(of("ARM_PRE", "ts"), of("HAND_PRE", "ts")).alias("state_timestamp_ns"), F.col("end_ns").alias("action_timestamp_ns"), F.least(of("ARM_POST", "ts"), of("HAND_POST", "ts")).alias("next_state_timestamp_ns"),
        of("ARM_PRE", "ts").alias("arm_qpos_source_timestamp_ns"), of("HAND_PRE", "ts").alias("hand_qpos_source_timestamp_ns"), of("ARM_PRE", "row").alias("arm_row"), of("HAND_PRE", "row").alias("hand_row"),
        of("HEAD_CAMERA", "ts").alias("head_ns"), of("WRIST_CAMERA", "ts").alias("wrist_ns"), of("HEAD_CAMERA", "frame_index").alias("head_rgb_frame_index"), of("WRIST_CAMERA", "frame_index").alias("right_wrist_rgb_frame_index"))
    age = lambda at: F.col("start_ns") - F.col(at)
    return ok.withColumns({
        "state_component_skew_ns": F.abs(F.col("arm_qpos_source_timestamp_ns") - F.col("hand_qpos_source_timestamp_ns")), "action_component_skew_ns": F.col("action_timestamp_ns") - F.col("start_ns"),
        "arm_state_age_at_action_ns": age("arm_qpos_source_timestamp_ns"), "hand_state_age_at_action_ns": age("hand_qpos_source_timestamp_ns"), "head_frame_age_at_action_ns": age("head_ns"),
        "wrist_frame_age_at_action_ns": age("wrist_ns"), "head_wrist_frame_skew_ns": F.abs(F.col("head_ns") - F.col("wrist_ns")), "state_to_next_state_ns": F.col("next_state_timestamp_ns") - F.col("state_timestamp_ns")})
