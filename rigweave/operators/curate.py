"""From raw recordings to curated transitions as one plan: samples, actions and interventions, synchronisation, rows, segments, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigweave.functions.arrays import all_finite, flip
from rigweave.operators.causal import curated, synchronize
from rigweave.operators.contract import verdicts, violations
from rigweave.operators.reasons import component_mismatch, reason_counts
from rigweave.operators.sequence import islands
from rigweave.operators.stats import exact_summary
from rigweave.session import settle

#: The mode in which a hand joint's feedback means its position, and the hand joints whose sign the maker's units turn.
POSITION_MODE = 7
TURNED = (3, 6, 8)
METRICS = (
    "state_component_skew_ns", "action_component_skew_ns", "arm_state_age_at_action_ns", "hand_state_age_at_action_ns", "head_frame_age_at_action_ns", "wrist_frame_age_at_action_ns", "head_wrist_frame_skew_ns", "state_to_next_state_ns")


def feedback_ok(valid: Column, ts: Column, vector: Column, modes: Column | None = None) -> Column:
    """Whether feedback counts: flagged valid, at a positive time, all finite and, for the hand, every joint in position mode."""
    ok = valid & (ts > 0) & all_finite(vector)
    if modes is not None:
        ok = ok & F.forall(modes, lambda m: m == POSITION_MODE)
    return F.coalesce(ok, F.lit(False))


def recording_samples(raw: DataFrame) -> DataFrame:
    """Raw ticks (sources.contracts.RAW_TICKS) as samples of the four channels; a tick's row is its number."""
    none = F.lit(None).cast("long")
    channels = {
        "arm": (F.col("arm_qpos_source_timestamp_ns"), feedback_ok(F.col("arm_feedback_valid"), F.col("arm_qpos_source_timestamp_ns"), F.col("arm_qpos_rad")), none),
        "hand": (F.col("hand_feedback_source_timestamp_ns"), feedback_ok(F.col("hand_feedback_valid"), F.col("hand_feedback_source_timestamp_ns"), F.col("hand_feedback_sdk_rad"), F.col("hand_feedback_modes")), none)}
    for role in ("head", "wrist"):
        ts, frame = F.col(f"{role}_camera_host_timestamp_ns"), F.col(f"{role}_rgb_frame_index")
        channels[role] = (ts, F.coalesce(F.col(f"{role}_camera_valid") & (ts > 0) & (frame >= 0), F.lit(False)), frame)
    each = F.array(*[F.struct(F.lit(name).alias("channel"), ts.alias("ts"), ok.alias("eligible"), frame.cast("long").alias("frame_index")) for name, (ts, ok, frame) in channels.items()])
    return raw.select("episode_id", F.col("tick").alias("row"), F.explode(each).alias("s")).select("episode_id", "row", "s.*")


def recording_actions(raw: DataFrame, domains: DataFrame) -> DataFrame:
    """Raw ticks as the actions that `synchronize` asks for; domains(episode_id, domain) names the hand's units.

    Commands in the maker's units (sdk_user_rad) are compared after their signs are turned; an episode that names no
    domain uses canonical_rad.
    """
    named = domains.select(F.col("episode_id").alias("d_episode"), "domain")
    rows = raw.join(named, F.col("episode_id") == F.col("d_episode"), "left")
    hand = F.when(F.col("domain") == "sdk_user_rad", flip(F.col("hand_qcmd_effective_canonical_rad"), TURNED)).otherwise(F.col("hand_qcmd_effective_canonical_rad"))
    arm, robot = F.col("arm_qcmd_sent_rad"), F.col("robot_qcmd_17d_rad")
    finite = all_finite(arm) & all_finite(hand) & all_finite(robot)
    return rows.select(
        "episode_id", "tick", F.col("tick").alias("action_id"), F.col("arm_qcmd_source_timestamp_ns").alias("arm_ns"), F.col("hand_qcmd_source_timestamp_ns").alias("hand_ns"), F.col("arm_command_valid").alias("arm_ok"),
        F.col("hand_command_valid").alias("hand_ok"), F.col("robot_qcmd_17d_valid").alias("whole_ok"), finite.alias("finite"), component_mismatch(arm, hand, robot).alias("mismatch"))


@dataclass(frozen=True)
class Interventions:
    """holes(episode_id, start_ns, end_ns) of sound metadata; refused(episode_id, error) of metadata that contradicts itself."""

    holes: DataFrame
    refused: DataFrame


def read_interventions(scalars: DataFrame) -> Interventions:
    """The operator's interventions of sources.recordings.read_scalars(episode_id, name, value as JSON text).

    Without either field an episode is clean. Both fields are needed together; the flag must be a boolean that tells whether
    the list is empty; an interval starts at a whole number of at least 0, ends behind it or is open, and begins behind the
    end of the one before it. Episodes that break any of this are refused as a whole.
    """
    of = lambda name: F.max(F.when(F.col("name") == name, F.col("value")))
    both = scalars.groupBy("episode_id").agg(of("operator_intervention").alias("flag"), of("operator_interventions").alias("list")).where("flag is not null or list is not null")
    item = "array<struct<start_timestamp_ns:bigint,end_timestamp_ns:bigint>>"
    both = both.withColumn("flag", F.lower("flag")).withColumn("raw", F.from_json("list", "array<map<string,string>>")).withColumn("items", F.from_json("list", item))
    whole = r"^\d+$"
    sound = lambda m: F.coalesce(m["start_timestamp_ns"].rlike(whole), F.lit(False)) & (m["end_timestamp_ns"].isNull() | m["end_timestamp_ns"].rlike(whole))
    bounds = F.forall("raw", sound) & F.forall("items", lambda x: x["end_timestamp_ns"].isNull() | (x["end_timestamp_ns"] > x["start_timestamp_ns"]))
    ordered = F.forall(F.sequence(F.lit(1), F.size("items")), lambda i: (i == F.size("items")) | F.coalesce(F.get("items", i)["start_timestamp_ns"] > F.get("items", i - 1)["end_timestamp_ns"], F.lit(False)))
    error = (
        F.when(F.col("flag").isNull() | F.col("list").isNull(), "both operator intervention fields are required")
        .when(~F.col("flag").isin("true", "false") | F.col("raw").isNull(), "operator intervention flag/list has invalid type")
        .when((F.col("flag") == "true") != (F.size("raw") > 0), "operator intervention flag disagrees with intervals")
        .when((F.size("raw") > 0) & ~F.coalesce(bounds, F.lit(False)), "operator intervention interval has invalid bounds")
        .when((F.size("raw") > 0) & ~ordered, "operator intervention intervals overlap or are unordered"))
    judged = both.select("episode_id", "items", error.alias("error"))
    holes = judged.where("error is null").select("episode_id", F.explode("items").alias("x")).select("episode_id", F.col("x.start_timestamp_ns").alias("start_ns"), F.col("x.end_timestamp_ns").alias("end_ns"))
    return Interventions(holes, judged.where("error is not null").select("episode_id", "error"))


def synchronize_recordings(raw: DataFrame, scalars: DataFrame, frames: DataFrame) -> DataFrame:
    """`synchronize` over raw ticks; every candidate of an episode with refused intervention metadata is rejected for that."""
    found = read_interventions(scalars)
    domains = scalars.where("name = 'robot_qcmd_hand_domain'").select("episode_id", F.col("value").alias("domain"))
    refused = found.refused.select(F.col("episode_id").alias("r_episode"), "error")
    rows = raw.select("episode_id", "tick", F.col("timestamp_ns").alias("ts_ns"))
    done = synchronize(rows, found.holes, recording_actions(raw, domains), recording_samples(raw), frames)
    met = done.join(refused, F.col("episode_id") == F.col("r_episode"), "left")
    return met.withColumn("reasons", F.when(F.col("error").isNotNull(), F.array(F.lit("INTERVENTION_METADATA_INVALID"))).otherwise(F.col("reasons"))).select(*done.columns)


@dataclass(frozen=True)
class Curated:
    """rows: the contract's 13 columns and the segment; metrics: their lags; report: counts by reason; lags: summaries; verdicts: the contract's."""

    rows: DataFrame
    metrics: DataFrame
    rejections: DataFrame
    lags: DataFrame
    verdicts: DataFrame


def build_curated(raw: DataFrame, scalars: DataFrame, frames: DataFrame) -> Curated:
    """The curated dataset of raw recordings: accepted transitions with their vectors, segments, lags, rejections and verdicts.

    State joins the arm's and the hand's feedback at their rows before the action; the action is the recorded vector as it
    is. A segment begins where a transition does not start at the tick the one before ended at. Recordings without
    accepted transitions have no rows; empty input gives empty tables.
    """
    sync = settle(synchronize_recordings(raw, scalars, frames), "synchronized")
    ok = curated(sync)
    vector = lambda column, name: raw.select(F.col("episode_id").alias(f"{name}_e"), F.col("tick").alias(f"{name}_t"), F.col(column).alias(name))
    for row, column, name in (("arm_row", "arm_qpos_rad", "arm_state"), ("hand_row", "hand_feedback_sdk_rad", "hand_state"), ("source_tick_index", "robot_qcmd_17d_rad", "robot_qcmd_17d_rad")):
        side = vector(column, name)
        ok = ok.join(side, (F.col("episode_id") == F.col(f"{name}_e")) & (F.col(row) == F.col(f"{name}_t"))).drop(f"{name}_e", f"{name}_t")
    times = raw.select(F.col("episode_id").alias("x_e"), F.col("tick").alias("x_t"), "arm_qcmd_source_timestamp_ns", "hand_qcmd_source_timestamp_ns")
    ok = ok.join(times, (F.col("episode_id") == F.col("x_e")) & (F.col("source_tick_index") == F.col("x_t"))).withColumn("robot_qpos_17d_rad", F.concat("arm_state", "hand_state"))
    ok = settle(islands(ok, "episode_id", "source_tick_index", F.col("source_tick_index") != F.col("__n"), "segment", {"__n": "next_state_tick_index"}), "curated")
    columns = [
        "source_tick_index", "next_state_tick_index", "state_timestamp_ns", "action_timestamp_ns", "next_state_timestamp_ns", "arm_qpos_source_timestamp_ns", "hand_qpos_source_timestamp_ns", "arm_qcmd_source_timestamp_ns",
        "hand_qcmd_source_timestamp_ns", "robot_qpos_17d_rad", "robot_qcmd_17d_rad", "head_rgb_frame_index", "right_wrist_rgb_frame_index"]
    rows, metrics = ok.select("episode_id", *columns, "segment"), ok.select("episode_id", "source_tick_index", *METRICS)
    long = metrics.select("episode_id", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in METRICS])).alias("x")).select("episode_id", "x.*")
    stored = frames.select("episode_id", F.col("channel").alias("role"), "frame_index").join(rows.select(F.col("episode_id").alias("k")).distinct(), F.col("episode_id") == F.col("k"), "left_semi").select("episode_id", "role", "frame_index")
    # only referenced images are copied, so none that is not referred to belongs to the curated episode
    broken = violations(rows.drop("segment"), stored).where("rule <> 'MEDIA_UNREFERENCED'")
    return Curated(
        rows, metrics, reason_counts(sync.where(F.size("reasons") > 0)), exact_summary(long, ["episode_id", "metric"], F.col("v"), keep=False), verdicts(rows.select("episode_id").distinct(), broken))


def referenced_media(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """The stored images that curated rows refer to, each once: what a curated episode keeps of its recording."""
    roles = F.array(F.struct(F.lit("head").alias("r"), F.col("head_rgb_frame_index").alias("f")), F.struct(F.lit("wrist").alias("r"), F.col("right_wrist_rgb_frame_index").alias("f")))
    asked = rows.select(F.col("episode_id").alias("e"), F.explode(roles).alias("x")).select("e", "x.*").where("f >= 0").distinct()
    return frames.join(asked, (F.col("episode_id") == F.col("e")) & (F.col("channel") == F.col("r")) & (F.col("frame_index") == F.col("f")), "left_semi")
