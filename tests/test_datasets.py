import pytest

from rigweave.plans import datasets


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    """Seven runs of episode 12 in waves 1 to 3, its id written in as many ways."""
    folder = str(tmp_path_factory.mktemp("dirty"))
    ids = [("episode_000012", 1), ("episode-000012", 1), ("Episode 000012", 1), ("000012", 2), ("episode_012", 2), (None, 2), (None, 3)]
    rows = [(k, i, "/curated/episode_000012", b, 10) for k, (i, b) in enumerate(ids)] + [(0, "episode_000012", "/curated/episode_000012", 1, 10), (99, None, None, 1, 10)]
    spark.createDataFrame(rows, "provenance_id long, source_episode_id string, curated_path string, batch_no int, transition_count long").write.parquet(f"{folder}/source_provenance.parquet")
    ticks = "tick_id long, episode_id string, rig_id string, tick_index long, timestamp_ns long, head_camera_host_timestamp_ns long, head_camera_valid boolean, head_rgb_frame_index long, wrist_camera_host_timestamp_ns long, wrist_camera_valid boolean, wrist_rgb_frame_index long"
    spark.createDataFrame([(1, "episode_000012", "rig", 0, 1, 1, True, 0, 1, True, 0)], ticks).write.parquet(f"{folder}/raw_ticks.parquet")
    spark.createDataFrame([], "transition_id long, episode_id string, rig_id string, source_tick_index long, next_state_tick_index long, arm_pre_timestamp_ns long, hand_pre_timestamp_ns long, arm_action_timestamp_ns long, hand_action_timestamp_ns long, head_timestamp_ns long, wrist_timestamp_ns long, head_rgb_frame_index long, wrist_rgb_frame_index long").write.parquet(f"{folder}/transitions.parquet")
    return folder


def test_snapshot_counts_exports_under_any_spelling(spark, dirty):
    assert [tuple(r) for r in datasets.run_snapshot(spark, dirty).collect()] == [("episode_000012", 1, 0, 7)]


def test_every_wave_is_compared_with_the_next(spark, dirty):
    got = {(r["n"], r["batch_no"]): (r["before"], r["after"], r["status"]) for r in datasets.baseline_compare(spark, dirty).collect()}
    assert got == {("000012", 2): (30, 30, "SAME"), ("000012", 3): (30, 10, "LOWER")}
