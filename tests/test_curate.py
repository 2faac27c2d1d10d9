import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigweave.functions.media import jpeg_complete
from rigweave.operators.curate import build_curated, read_interventions, recording_samples, referenced_media, synchronize_recordings
from rigweave.sources.recordings import media_frames, read_curated, read_masks, read_npz, read_scalars, require

JPEG = b"\xff\xd8\xff\xe0" + b"picture" + b"\xff\xd9"
STEP = 10_000_000


def recording(folder, number, change=None, side=None, n=12):
    """A sound recording: feedback 2 ms before, command at, cameras 5 ms before each tick; `change(arrays)` spoils it."""
    rng = np.random.default_rng(number)
    t = np.arange(1, n + 1) * STEP
    arm, hand = rng.normal(size=(n, 6)), rng.normal(size=(n, 11))
    a = dict(
        timestamp_ns=t, arm_qpos_rad=arm + 0.5, arm_qpos_source_timestamp_ns=t - 2_000_000, arm_feedback_valid=np.ones(n, bool), hand_feedback_sdk_rad=hand + 0.5, hand_feedback_modes=np.full((n, 11), 7),
        hand_feedback_source_timestamp_ns=t - 1_000_000, hand_feedback_valid=np.ones(n, bool), arm_qcmd_sent_rad=arm, hand_qcmd_effective_canonical_rad=hand.copy(), robot_qcmd_17d_rad=np.c_[arm, hand], arm_qcmd_source_timestamp_ns=t,
        hand_qcmd_source_timestamp_ns=t + 1000, arm_command_valid=np.ones(n, bool), hand_command_valid=np.ones(n, bool), robot_qcmd_17d_valid=np.ones(n, bool), head_camera_host_timestamp_ns=t - 5_000_000,
        head_camera_valid=np.ones(n, bool), head_rgb_frame_index=np.arange(n), wrist_camera_host_timestamp_ns=t - 4_000_000, wrist_camera_valid=np.ones(n, bool), wrist_rgb_frame_index=np.arange(n))
    if change:
        change(a)
    np.savez(folder / f"episode_{number:06d}.npz", **a)
    for role in ("head", "right_wrist"):
        images = folder / f"episode_{number:06d}_media" / role / "rgb"
        images.mkdir(parents=True)
        for k in range(n):
            (images / f"{k:06d}.jpg").write_bytes(JPEG)
    if side is not None:
        (folder / f"episode_{number:06d}.json").write_text(json.dumps(side))
    return folder / f"episode_{number:06d}_media"


def load(spark, folder):
    return read_npz(spark, str(folder)), read_scalars(spark, str(folder)), media_frames(spark, str(folder))


def reasons(spark, folder):
    return {(r["episode_id"], r["tick"]): r["reasons"] for r in synchronize_recordings(*load(spark, folder)).collect()}


def test_sound_recording_is_accepted_but_for_the_first_and_last(spark, tmp_path):
    recording(tmp_path, 1)
    got = reasons(spark, tmp_path)
    assert len(got) == 11
    # nothing lies before the first command but its own samples; every command has feedback after it up to the last pair
    assert all(r == [] for r in got.values())


def test_every_gate(spark, tmp_path):
    def spoil(a):
        a["robot_qcmd_17d_rad"][1, 3] += 1e-9
        a["arm_command_valid"][2] = False
        a["hand_command_valid"][2] = False
        a["robot_qcmd_17d_rad"][3, 0] = np.nan
        a["hand_qcmd_source_timestamp_ns"][4] = 0
        a["hand_feedback_modes"][:, 5] = 3
        a["robot_qcmd_17d_valid"][5] = False

    media = recording(tmp_path, 1, spoil)
    (media / "head" / "rgb" / "000006.jpg").unlink()
    (media / "right_wrist" / "rgb" / "000007.jpg").write_bytes(JPEG[:-2])
    got = {t: r for (_, t), r in reasons(spark, tmp_path).items()}
    assert got[1] == ["ACTION_COMPONENT_MISMATCH"]
    assert got[2] == ["ACTION_ARM_COMMAND_FLAG_INVALID", "ACTION_HAND_COMMAND_FLAG_INVALID"]
    assert got[3] == ["ACTION_NONFINITE"] and got[4] == ["ACTION_TIMESTAMP_NONPOSITIVE"] and got[5] == ["ACTION_ROBOT_COMMAND_FLAG_INVALID"]
    assert got[6] == ["CAMERA_HEAD_CAMERA_MEDIA_MISSING", "FEEDBACK_HAND_POST_INVALID", "FEEDBACK_HAND_PRE_INVALID"]
    assert got[7] == ["CAMERA_WRIST_CAMERA_DECODE_INVALID", "FEEDBACK_HAND_POST_INVALID", "FEEDBACK_HAND_PRE_INVALID"]
    assert got[8] == ["FEEDBACK_HAND_POST_INVALID", "FEEDBACK_HAND_PRE_INVALID"]


def test_units_of_the_maker_are_turned_before_they_are_compared(spark, tmp_path):
    def turn(a):
        a["hand_qcmd_effective_canonical_rad"][:, [3, 6, 8]] *= -1.0

    recording(tmp_path, 1, turn)
    recording(tmp_path, 2, lambda a: (turn(a), a.update(robot_qcmd_hand_domain=np.array("sdk_user_rad"))))
    got = reasons(spark, tmp_path)
    assert all(r == ["ACTION_COMPONENT_MISMATCH"] for (e, _), r in got.items() if e.endswith("1"))
    assert all(r == [] for (e, _), r in got.items() if e.endswith("2"))


def test_interventions_split_and_bad_metadata_rejects_all(spark, tmp_path):
    recording(tmp_path, 1, side={"operator_intervention": True, "operator_interventions": [{"start_timestamp_ns": 5 * STEP, "end_timestamp_ns": 6 * STEP}]})
    recording(tmp_path, 2, side={"operator_intervention": False, "operator_interventions": [{"start_timestamp_ns": 5, "end_timestamp_ns": 9}]})
    recording(tmp_path, 3, side={"operator_intervention": False, "operator_interventions": []})
    got = reasons(spark, tmp_path)
    one = {t: r for (e, t), r in got.items() if e == "episode_000001"}
    # ticks 4 and 5 lie inside; pairs that touch them, and one whose evidence before lies inside, go
    assert [t for t, r in one.items() if r] and all(one[t] == ["INTERVENTION_CONTAMINATED"] for t in (3, 4, 5)) and one[8] == []
    assert all(r == ["INTERVENTION_METADATA_INVALID"] for (e, _), r in got.items() if e == "episode_000002")
    assert all(r == [] for (e, _), r in got.items() if e == "episode_000003")


@pytest.mark.parametrize("flag,items,error", [
    ("true", None, "both operator intervention fields are required"), ("maybe", "[]", "operator intervention flag/list has invalid type"), ("true", "{", "operator intervention flag/list has invalid type"),
    ("true", "[]", "operator intervention flag disagrees with intervals"), ("true", '[{"start_timestamp_ns": -1}]', "operator intervention interval has invalid bounds"),
    ("true", '[{"start_timestamp_ns": 5, "end_timestamp_ns": 5}]', "operator intervention interval has invalid bounds"), ("true", '[{"start_timestamp_ns": 1.5}]', "operator intervention interval has invalid bounds"),
    ("true", '[{"start_timestamp_ns": 1}, {"start_timestamp_ns": 9}]', "operator intervention intervals overlap or are unordered"),
    ("true", '[{"start_timestamp_ns": 1, "end_timestamp_ns": 4}, {"start_timestamp_ns": 4, "end_timestamp_ns": 9}]', "operator intervention intervals overlap or are unordered"),
    ("true", '[{"start_timestamp_ns": 1, "end_timestamp_ns": 4}, {"start_timestamp_ns": 5, "end_timestamp_ns": null}]', None), ("false", "[]", None)])
def test_intervention_metadata(spark, flag, items, error):
    rows = [("e", "operator_intervention", flag)] + ([("e", "operator_interventions", items)] if items is not None else [])
    found = read_interventions(spark.createDataFrame(rows, "episode_id string, name string, value string"))
    assert [r["error"] for r in found.refused.collect()] == ([error] if error else [])
    assert found.holes.count() == (0 if error or items == "[]" else 2)


def test_curated_build(spark, tmp_path):
    def spoil(a):
        a["arm_command_valid"][5] = False

    recording(tmp_path, 1, spoil)
    raw, scalars, frames = load(spark, tmp_path)
    built = build_curated(raw, scalars, frames)
    rows = sorted(built.rows.collect(), key=lambda r: r["source_tick_index"])
    assert [r["source_tick_index"] for r in rows] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10] and [r["segment"] for r in rows] == [0] * 5 + [1] * 5
    with np.load(tmp_path / "episode_000001.npz") as a:
        for r in rows:
            k = r["source_tick_index"]
            assert r["robot_qcmd_17d_rad"] == a["robot_qcmd_17d_rad"][k].tolist() and r["robot_qpos_17d_rad"] == [*a["arm_qpos_rad"][k], *a["hand_feedback_sdk_rad"][k]]
            assert (r["state_timestamp_ns"], r["action_timestamp_ns"], r["next_state_timestamp_ns"]) == ((k + 1) * STEP - 1_000_000, (k + 1) * STEP + 1000, (k + 2) * STEP - 2_000_000)
            assert r["head_rgb_frame_index"] == r["right_wrist_rgb_frame_index"] == k
    assert {(r["reason"], r["n"]) for r in built.rejections.collect()} == {("ACTION_ARM_COMMAND_FLAG_INVALID", 1)}
    assert {r["metric"]: r["median"] for r in built.lags.collect()}["head_frame_age_at_action_ns"] == 5_000_000.0
    assert [(r["quality"], r["errors"]) for r in built.verdicts.collect()] == [("PASS", [])]
    assert referenced_media(built.rows, frames).count() == 20
    built.rows.write.parquet(str(tmp_path / "curated"))
    assert read_curated(spark, str(tmp_path / "curated")).count() == 10
    with pytest.raises(ValueError):
        built.metrics.write.parquet(str(tmp_path / "other"))
        read_curated(spark, str(tmp_path / "other"))


def test_masks_images_and_columns(spark, tmp_path):
    (tmp_path / "episode_000001").mkdir()
    np.save(tmp_path / "episode_000001" / "quality_mask.npy", np.array([True, False]))
    assert [(r["episode_id"], r["row"], r["keep"]) for r in read_masks(spark, str(tmp_path)).orderBy("row").collect()] == [("episode_000001", 0, True), ("episode_000001", 1, False)]
    rows = spark.createDataFrame([(bytearray(JPEG),), (bytearray(JPEG[:-1]),), (bytearray(),), (None,)], "content binary")
    assert [r["ok"] for r in rows.select(jpeg_complete(F.col("content")).alias("ok")).collect()] == [True, False, False, None]
    with pytest.raises(KeyError):
        require(rows, ["content", "absent"])
    assert recording_samples(read_npz(spark, str(tmp_path))).count() == 0
