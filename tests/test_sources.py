import json

import numpy as np
import pytest

from rigweave.sources.contracts import CURATED, breaks
from rigweave.sources.recordings import discover, read_npz, read_scalars, stored_frames
from rigweave.sources.tables import file_listing, publish, read_frames, read_jsonl, write_frames
from rigweave.streaming.append import append_once, windowed_counts


def recording(folder, number=7, n=8):
    np.savez(folder / f"episode_{number:06d}.npz", timestamp_ns=np.arange(1, n + 1), arm_qpos_rad=np.arange(6 * n).reshape(n, 6) / 100, arm_feedback_valid=np.ones(n, dtype=bool), language_instruction=np.array("push"), dataset_hz=np.array(30.0))
    media = folder / f"episode_{number:06d}_media" / "head" / "rgb"
    media.mkdir(parents=True)
    (media / "000002.jpg").write_bytes(b"x")
    (media / "cover.jpg").write_bytes(b"y")
    (folder / f"episode_{number:06d}.json").write_text(json.dumps({"language_instruction": "pull", "operator_intervention": False}))


def test_recordings(spark, tmp_path):
    recording(tmp_path)
    (tmp_path / "episode_12.npz").write_bytes(b"x")
    (tmp_path / "notes.npz").write_bytes(b"x")
    np.savez(tmp_path / "episode_000009.npz", timestamp_ns=np.array([5]))
    issues = {r["path"].rsplit("/", 1)[-1]: r["issue"] for r in discover(spark, str(tmp_path)).collect()}
    assert issues == {"episode_000007.npz": None, "episode_12.npz": "INVALID_EPISODE_NAME", "episode_000009.npz": "MISSING_MEDIA_DIRECTORY"}
    rows = read_npz(spark, str(tmp_path)).orderBy("episode_id", "tick").collect()
    assert [r["episode_id"] for r in rows].count("episode_000007") == 8 and len(rows) == 9
    assert rows[3]["arm_qpos_rad"] == [x / 100 for x in range(18, 24)] and rows[3]["hand_feedback_modes"] is None
    scalars = {(r["episode_id"], r["name"]): r["value"] for r in read_scalars(spark, str(tmp_path)).collect()}
    assert scalars[("episode_000007", "language_instruction")] == "pull" and scalars[("episode_000007", "dataset_hz")] == "30.0"
    frames = {r["frame_index"] for r in stored_frames(spark, str(tmp_path)).collect()}
    assert frames == {2, None}


def test_contract(spark):
    df = spark.createDataFrame([(1, "x", 2)], "source_tick_index long, head_rgb_frame_index string, secret int")
    found = breaks(df, CURATED, {"secret"})
    assert found["forbidden"] == ["secret"] and found["type"] == ["head_rgb_frame_index"] and "action_timestamp_ns" in found["missing"] and found["unknown"] == []


def test_publish_shows_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5)
    publish(df, path)
    with pytest.raises(FileExistsError):
        publish(df, path)

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        publish(spark.range(9), path, refuse, replace=True)
    assert spark.read.parquet(path).count() == 5 and not (tmp_path / "t.staging").exists()
    publish(spark.range(9), path, replace=True)
    assert spark.read.parquet(path).count() == 9
    assert file_listing(spark, path, "*.parquet").where("length(sha256) = 64").count() >= 1


def test_frames_and_lines(spark, tmp_path):
    df = spark.createDataFrame([(e, f) for e in (0, 7, 1500) for f in range(3)], "episode_index long, frame_index long")
    write_frames(df, str(tmp_path / "f"))
    back = read_frames(spark, str(tmp_path / "f"))
    assert {(r["chunk"], r["episode"]) for r in back.select("chunk", "episode").distinct().collect()} in ({("000", "000000"), ("000", "000007"), ("001", "001500")}, {(0, 0), (0, 7), (1, 1500)})
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert read_jsonl(spark, str(tmp_path / "l.jsonl"), "a long").count() == 2


def test_stream_appends_each_key_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id long, v string").write.parquet(source)
    schema = spark.read.parquet(source).schema
    append_once(spark, source, schema, target, state, "id").awaitTermination()
    spark.createDataFrame([(2, "b"), (3, "c"), (None, "d")], "id long, v string").write.mode("append").parquet(source)
    append_once(spark, source, schema, target, state, "id").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_windowed_counts_in_batch(spark):
    df = spark.sql("select timestamp'2026-01-01 00:10:00' as ts, 'a' as k union all select timestamp'2026-01-01 00:50:00', 'a'")
    assert windowed_counts(df, "ts", "k").first()["n"] == 2


def test_publish_refuses_when_an_input_changes_and_places_that_overlap(spark, tmp_path):
    from rigweave.sources.tables import assert_separate, read_or_empty

    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    given = spark.read.parquet(source)

    def meddle(_):
        spark.range(5, 9).write.mode("append").parquet(source)

    with pytest.raises(RuntimeError):
        publish(given.selectExpr("id + 1 as id"), str(tmp_path / "out"), meddle, inputs=[lambda: spark.read.parquet(source)])
    assert not (tmp_path / "out").exists() and not (tmp_path / "out.staging").exists()
    for inner in ("/data/in/out", "/data", "file:///data/in"):
        with pytest.raises(ValueError):
            assert_separate(["/data/in/"], inner)
    assert_separate(["/data/in"], "/data/in2")
    assert read_or_empty(spark, str(tmp_path / "absent.json"), "a long").count() == 0
    (tmp_path / "r.json").write_text('{"a": 3}\n{"a": \n')
    assert [r["a"] for r in read_or_empty(spark, str(tmp_path / "r.json"), "a long").collect()] == [3]


def test_long_episodes_are_written_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(200_000).select(F.lit(3).cast("long").alias("episode_index"), F.col("id").alias("frame_index"))
    # adaptive execution would put so few rows together again
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_frames(df, str(tmp_path / "f"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list((tmp_path / "f").rglob("*.parquet"))) > 1
    assert read_frames(spark, str(tmp_path / "f")).count() == 200_000
