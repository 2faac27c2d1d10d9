import math

import pytest

from rigweave.operators.frames import frame_changes, review_rows


def test_changes_start_again_at_what_cannot_be_read(spark):
    a, b, c = [0.0] * 4, [0.0, 0.0, 0.0, 4.0], [9.0] * 4
    rows = [("x", 0, a, 2, 2), ("x", 1, a, 2, 2), ("x", 2, b, 2, 2), ("x", 3, None, 2, 2), ("x", 4, b, 2, 2), ("x", 5, b, 4, 1), ("x", 6, c, 4, 1), ("y", 0, a, 2, 2), (None, 0, a, 2, 2), (None, 1, a, 2, 2)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "k string, s long, pixels array<double>, width int, height int, difference string")
    got = {(r["k"], r["s"]): (r["difference"], r["exact"], r["near_static"]) for r in frame_changes(df, "k", "s").collect()}
    assert got["x", 0] == got["x", 3] == got["x", 4] == got["y", 0] == (None, False, False)
    assert got["x", 1] == (0.0, True, True) and got["x", 2] == (1.0, False, True) and got["x", 6] == (8.0, False, False) and got[None, 1] == (0.0, True, True)
    assert math.isnan(got["x", 5][0]) and got["x", 5][1:] == (False, False)
    assert frame_changes(df.limit(0), "k", "s").count() == 0


def test_review_rows(spark):
    rows = spark.createDataFrame([("e", 0, 0, True, 1), ("e", 1, 0, False, 2), ("e", 2, 1, None, 3), ("e", 3, 1, False, 4), ("e", 4, 1, True, None)], "episode_id string, row long, segment long, keep boolean, frame_index long")
    frames = spark.createDataFrame([("e", 1, True), ("e", 2, None), ("e", 3, False), ("e", 4, True)], "episode_id string, frame_index long, decodable boolean")
    pick = lambda which: sorted(r["row"] for r in review_rows(rows, frames, which).collect())
    assert pick("all") == [0, 1, 3] and pick("valid") == [0] and pick("invalid") == [1, 3]
    with pytest.raises(ValueError):
        review_rows(rows, frames, "some")
