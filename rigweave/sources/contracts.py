"""Fixed column contracts and what a table breaks of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

VECTOR = T.ArrayType(T.DoubleType())
LONGS = T.ArrayType(T.LongType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


L, B, S, D = T.LongType(), T.BooleanType(), T.StringType(), T.DoubleType()

#: One row per sampler tick of a raw recording.
RAW_TICKS = _struct(
    episode_id=S, tick=L, timestamp_ns=L, arm_qpos_rad=VECTOR, arm_qpos_source_timestamp_ns=L, arm_feedback_valid=B, hand_feedback_sdk_rad=VECTOR, hand_feedback_modes=LONGS,
    hand_feedback_source_timestamp_ns=L, hand_feedback_valid=B, arm_qcmd_sent_rad=VECTOR, hand_qcmd_effective_canonical_rad=VECTOR, robot_qcmd_17d_rad=VECTOR, arm_qcmd_source_timestamp_ns=L,
    hand_qcmd_source_timestamp_ns=L, arm_command_valid=B, hand_command_valid=B, robot_qcmd_17d_valid=B, head_camera_host_timestamp_ns=L, head_camera_valid=B, head_rgb_frame_index=L,
    wrist_camera_host_timestamp_ns=L, wrist_camera_valid=B, wrist_rgb_frame_index=L)
#: One row per accepted transition.
CURATED = _struct(
    source_tick_index=L, next_state_tick_index=L, state_timestamp_ns=L, action_timestamp_ns=L, next_state_timestamp_ns=L, arm_qpos_source_timestamp_ns=L, hand_qpos_source_timestamp_ns=L,
    arm_qcmd_source_timestamp_ns=L, hand_qcmd_source_timestamp_ns=L, robot_qpos_17d_rad=VECTOR, robot_qcmd_17d_rad=VECTOR, head_rgb_frame_index=L, right_wrist_rgb_frame_index=L)
#: One row per exported frame.
FRAMES = T.StructType([
    T.StructField("observation.state", T.ArrayType(T.FloatType())), T.StructField("action", T.ArrayType(T.FloatType())), T.StructField("timestamp", T.FloatType()),
    T.StructField("frame_index", L), T.StructField("episode_index", L), T.StructField("index", L), T.StructField("task_index", L)])


def breaks(df: DataFrame, contract: T.StructType, forbidden: set[str] = frozenset()) -> dict[str, list[str]]:
    """Columns that are missing, unknown, forbidden or of another type; empty lists where the table conforms."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in contract}
    return {
        "missing": sorted(want.keys() - have.keys()), "unknown": sorted(have.keys() - want.keys() - forbidden), "forbidden": sorted(have.keys() & forbidden),
        "type": sorted(n for n in have.keys() & want.keys() if have[n].simpleString() != want[n].simpleString())}
