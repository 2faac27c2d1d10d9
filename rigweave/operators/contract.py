"""The contract of curated transitions and of exported runs as countable rules, and the verdict that follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigweave.functions.arrays import all_finite
from rigweave.operators.sequence import neighbour

STAMPS = ("arm_qpos_source_timestamp_ns", "hand_qpos_source_timestamp_ns", "arm_qcmd_source_timestamp_ns", "hand_qcmd_source_timestamp_ns")
VECTORS, WIDTH = ("robot_qpos_17d_rad", "robot_qcmd_17d_rad"), 17


def _row_rules() -> dict[str, Column]:
    c = F.col
    rules = {f"{name.upper()}_NOT_POSITIVE": c(name) <= 0 for name in STAMPS}
    rules |= {f"{name.upper()}_MISSING": c(name).isNull() for name in (*STAMPS, *VECTORS)}
    rules |= {f"{name.upper()}_WIDTH": F.size(name) != WIDTH for name in VECTORS}
    rules |= {f"{name.upper()}_NOT_FINITE": ~all_finite(c(name)) for name in VECTORS}
    return rules | {
        "TICK_NEGATIVE": c("source_tick_index") < 0,
        "NEXT_TICK_NOT_SUCCESSOR": c("next_state_tick_index") != c("source_tick_index") + 1,
        "TICK_NOT_INCREASING": c("source_tick_index") <= c("__before"),
        "STATE_TIME_NOT_LATEST": c("state_timestamp_ns") != F.greatest(*STAMPS[:2]),
        "ACTION_TIME_NOT_LATEST": c("action_timestamp_ns") != F.greatest(*STAMPS[2:]),
        "STATE_NOT_BEFORE_ACTION": c("state_timestamp_ns") >= F.least(*STAMPS[2:]),
        "ACTION_NOT_BEFORE_NEXT_STATE": c("action_timestamp_ns") >= c("next_state_timestamp_ns"),
        "HEAD_FRAME_NEGATIVE": c("head_rgb_frame_index") < 0,
        "WRIST_FRAME_NEGATIVE": c("right_wrist_rgb_frame_index") < 0,
    }


def violations(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """episode_id, rule, n: rows of each curated episode that break each rule, those broken by none left out.

    rows: the 13 columns of the contract, with episode_id; stored(episode_id, role, frame_index): the images that there are,
    role head or wrist. MEDIA_MISSING and MEDIA_UNREFERENCED count frames, not rows. A condition that is null breaks nothing
    but the rules that ask for a value. Rows without episode are one episode of their own; empty input breaks no rule.
    """
    seen = neighbour(rows, "episode_id", "source_tick_index", {"__before": "source_tick_index"})
    rules = _row_rules()
    counts = seen.groupBy("episode_id").agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]).unpivot(["episode_id"], list(rules), "rule", "n")
    roles = F.array(F.struct(F.lit("head").alias("role"), F.col("head_rgb_frame_index").alias("frame_index")), F.struct(F.lit("wrist").alias("role"), F.col("right_wrist_rgb_frame_index").alias("frame_index")))
    asked = rows.select("episode_id", F.explode(roles).alias("r")).select("episode_id", "r.*").where("frame_index >= 0 and episode_id is not null").distinct().withColumn("asked", F.lit(True))
    known = asked.select(F.col("episode_id").alias("k")).distinct()
    have = stored.join(known, F.col("episode_id") == F.col("k"), "left_semi").select("episode_id", "role", "frame_index").distinct().withColumn("have", F.lit(True))
    both = asked.join(have, ["episode_id", "role", "frame_index"], "full")
    media = both.select("episode_id", F.when(F.col("have").isNull(), "MEDIA_MISSING").when(F.col("asked").isNull(), "MEDIA_UNREFERENCED").alias("rule")).where("rule is not null").groupBy("episode_id", "rule").agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 0").unionByName(media)


def verdicts(episodes: DataFrame, broken: DataFrame, warnings: tuple[str, ...] = ()) -> DataFrame:
    """episode_id, quality (FAIL if a rule is broken, WARN if only rules of `warnings` are, else PASS) and errors, the broken rules in order."""
    hard = ~F.col("rule").isin(*warnings) if warnings else F.lit(True)
    per = broken.groupBy(F.col("episode_id").alias("b_episode")).agg(F.array_sort(F.collect_set(F.when(hard, F.col("rule")))).alias("errors"), F.count_if(~hard).alias("soft"))
    met = episodes.join(per, F.col("episode_id").eqNullSafe(F.col("b_episode")), "left")
    quality = F.when(F.size(F.coalesce("errors", F.array())) > 0, "FAIL").when(F.col("soft") > 0, "WARN").otherwise("PASS")
    return met.select("episode_id", quality.alias("quality"), F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))


def provenance_rules() -> dict[str, Column]:
    """What an exported run's provenance must hold; each condition says that it does not."""
    c = F.col
    return {
        "EPISODE_MISSING": c("source_episode_id").isNull(), "TASK_EMPTY": F.coalesce(F.trim("task_instruction"), F.lit("")) == "",
        "TASK_HASH_MISMATCH": ~c("task_instruction_sha256").eqNullSafe(F.sha2("task_instruction", 256)), "START_NEGATIVE": c("source_start_index") < 0,
        "END_NOT_AFTER_START": c("source_end_index") <= c("source_start_index"), "COUNT_MISMATCH": c("source_end_index") - c("source_start_index") != c("transition_count")}
