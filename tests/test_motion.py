import pytest

from rigweave.plans import motion

SCHEMA = "transition_id long, episode_id string, source_tick_index long, next_state_tick_index long, arm_pre_timestamp_ns long, hand_pre_timestamp_ns long, state17 array<double>, action17 array<double>"


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """Three transitions with finite readings of a million and more in joint 0."""
    folder = str(tmp_path_factory.mktemp("large"))
    rows = [(i, "episode_000001", i, i + 1, i, i, [v, 0.5], [v, float("nan") if i else 0.25]) for i, v in enumerate((1.0, 1e12, 2e6))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/transitions.parquet")
    return folder


def test_large_finite_readings_count(spark, large):
    got = {r["joint"]: (r["n"], r["max"]) for r in motion.vector_summary(spark, large).collect()}
    assert got == {-1: (6, 1e12), 0: (3, 1e12), 1: (3, 0.5)}
    got = {r["joint"]: (r["n"], r["max"]) for r in motion.step_summary(spark, large).collect()}
    assert got == {0: (2, 1e12 - 1), 1: (2, 0.0)}
    got = {r["joint"]: (r["n"], r["total"]) for r in motion.sign_flip(spark, large).collect()}
    assert got == {0: (3, 1e12 + 2e6 + 1), 1: (1, 0.25)}


def test_large_errors_of_float32_count(spark, large):
    rows = spark.read.parquet(f"{large}/transitions.parquet")
    rows.selectExpr("* except (action17)", "array(16777217d + 2 * transition_id) as action17").write.parquet(f"{large}/exact/transitions.parquet")
    r = motion.float32_cast(spark, f"{large}/exact").first()
    assert (r["worst"], r["unstorable"], r["n"]) == (1.0, 0, 3)
