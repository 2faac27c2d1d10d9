import pytest
from pyspark.sql import functions as F

from rigweave.functions import arrays as A
from rigweave.functions import text as T
from rigweave.operators.reasons import component_mismatch, group_counts, reason_counts, reasons
from rigweave.operators.stats import close_enough, most_frequent, summary, zero_filled


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,want", [
    ("The robot picks it up", ["NARRATIVE_OR_SPECULATIVE_PREFIX"]), ("Pick it up slowly", ["EVALUATIVE_WORDING", "UNNAMED_PRONOUN_OBJECT"]), ("Move the robot arm", ["EMBODIMENT_CENTRIC_LANGUAGE"]),
    ("ok", ["INSTRUCTION_LENGTH"]), ("  ", ["EMPTY_INSTRUCTION"]), (None, ["EMPTY_INSTRUCTION"]), ("Insert the plug", []), ("Rotate joint 3 by 5 degrees", ["ACTUATOR_NARRATION"]), ("# Pick the cup", ["MARKDOWN_OR_STRUCTURE"]),
    ("x" * 200, ["INSTRUCTION_LENGTH"])])
def test_violations(spark, text, want):
    assert one(spark, T.violations(F.lit(text).cast("string"))) == want


def test_text(spark):
    assert one(spark, T.normalize_instruction(F.lit("  Pick   the cup.. "))) == "Pick the cup"
    assert one(spark, T.intents(F.lit("Grasp the plug, then insert it"))) == ["ACQUIRE", "INSERT_CONNECT"]
    assert one(spark, T.redact(F.lit("API_KEY=abc hf_0123456789 Bearer zz"))) == "API_KEY=[REDACTED] [REDACTED] Bearer [REDACTED]"
    assert one(spark, T.actuator_words(F.lit("the motor, 关节"))) == ["motor", "关节"]
    assert one(spark, T.frame_path(1000, F.lit(1234).cast("long"))) == "data/chunk-001/episode_001234.parquet"


def test_arrays(spark):
    v = F.array(*[F.lit(float(x)) for x in (1, 2, 3, 4)])
    assert one(spark, A.flip(v, (1, 3))) == [1.0, -2.0, 3.0, -4.0]
    assert one(spark, A.rot180(v)) == [4.0, 3.0, 2.0, 1.0]
    assert one(spark, A.norm(F.array(F.lit(3.0), F.lit(4.0)))) == 5.0
    assert one(spark, A.neighbour_difference(v, 2, 2)) == 1.5
    assert one(spark, A.span(v, 1, 3)) == [2.0, 3.0]
    assert one(spark, A.all_finite(F.array(F.lit(1.0), F.lit(float("nan"))))) is False
    assert one(spark, A.float32_error(F.array(F.lit(1e300)))) is None
    assert abs(one(spark, A.luminance(F.lit(10.0), F.lit(10.0), F.lit(10.0))) - 10) < 1e-9


def test_reasons(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (5, 9)], "a int, b int").select(reasons(("A_LOW", F.col("a") < 3), ("A_TINY", F.col("a") < 2), ("B_BIG", F.col("b") > 5)).alias("reasons"))
    assert [r["reasons"] for r in df.collect()] == [["A_LOW", "A_TINY"], ["A_LOW"], ["B_BIG"]]
    assert {r["reason"]: r["n"] for r in reason_counts(df).collect()} == {"A_LOW": 2, "A_TINY": 1, "B_BIG": 1}
    groups = {r["reason_group"]: r["n"] for r in zero_filled(group_counts(df), "reason_group", "n", ["A", "B", "C"]).collect()}
    assert groups == {"A": 2, "B": 1, "C": 0}
    nan = F.array(F.lit(float("nan")))
    assert one(spark, component_mismatch(nan, nan, F.array(F.lit(1.0), F.lit(2.0)))) is False


def test_stats(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    r = df.agg(*summary(F.col("v"))).first()
    assert (r["n"], r["mean"], r["median"], r["max"]) == (2, 2.0, 2.0, 3.0)
    assert df.limit(0).agg(*summary(F.col("v"))).first()["median"] is None
    modes = most_frequent(spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int"), ["k"], ["v"]).collect()
    assert {r["k"]: r["v"] for r in modes} == {"a": 1, "b": 5}
    assert one(spark, close_enough(F.lit(1.0), F.lit(1.0000001)))


@pytest.mark.parametrize("cell_rows", [5, 10**6])
def test_quantiles_are_exact_in_cells_of_any_size(spark, cell_rows):
    import random

    import numpy as np

    from rigweave.operators.stats import exact_summary, quantiles

    rng = random.Random(3)
    rows = [("a", rng.choice([0.0, -0.0, 1.0, rng.uniform(-1e-5, 1e12), 1.5e18 + rng.randrange(4000) * 256.0])) for _ in range(700)] + [("b", 1.0 + rng.random() / 50) for _ in range(500)]
    rows += [("c", float("nan")), ("c", None), (None, 5.0), (None, 7.0), ("d", float("inf")), ("d", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    points = (0.0, 0.1, 0.5, 0.95, 0.99, 1.0)
    got = {r["k"]: r for r in quantiles(df, ["k"], F.col("v"), points, cell_rows=cell_rows).collect()}
    for k in ("a", "b", None, "d"):
        x = [v for g, v in rows if g == k and v is not None and np.isfinite(v)]
        assert got[k]["n"] == len(x) and np.allclose(got[k]["q"], np.quantile(x, points), rtol=1e-12, atol=0)
    assert got["c"]["n"] == 0 and got["c"]["q"] == [None] * 6
    assert exact_summary(df.limit(0), ["k"], F.col("v")).count() == 0
    whole = exact_summary(df.where("k = 'b'"), [], F.col("v")).first()
    assert whole["n"] == 500 and abs(whole["median"] - np.median([v for g, v in rows if g == "b"])) < 1e-6


def test_canonical_object_is_that_of_json(spark):
    import json

    rows = [("x", 5, True, None), ('q"\\\né数', None, False, "t"), (None, -3, None, "")]
    df = spark.createDataFrame(rows, "b string, a long, d boolean, c string")
    got = [r["j"] for r in df.select(T.canonical_object({c: F.col(c) for c in df.columns}, df.schema).alias("j")).collect()]
    assert got == [json.dumps(dict(zip("badc", r)), sort_keys=True, ensure_ascii=False) for r in rows]
    compact = df.select(T.canonical_object({"a": F.col("a"), "b": F.col("b")}, df.schema, ",", ":").alias("j")).first()["j"]
    assert compact == '{"a":5,"b":"x"}'
    with pytest.raises(TypeError):
        T.canonical_object({"v": F.lit(1.5)}, spark.createDataFrame([(1.5,)], "v double").schema)
