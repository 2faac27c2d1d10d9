import numpy as np
from pyspark.sql import functions as F

from rigweave.operators.hilbert import cluster, code_ranges, hilbert_code, row_digests, same_record_pairs, with_codes, write_shards

SCHEMA = "file_id long, path string, n_bytes long, digest string, bucket int"


def test_curve_visits_each_cell_once_and_moves_by_one():
    n = 16
    x, y = (a.ravel() for a in np.meshgrid(np.arange(n), np.arange(n)))
    code = hilbert_code(x, y, 4)
    assert sorted(code) == list(range(n * n))
    order = np.argsort(code)
    assert (np.abs(np.diff(x[order])) + np.abs(np.diff(y[order])) == 1).all()


def files(spark):
    ways = [
        "/data/curated/c1/episode_000007/media/right_wrist/rgb/000003.jpg", "file:///data/curated/c1/episode_000007/media/wrist/rgb/000003.JPG", "D:\\curated\\c1\\episode_000007\\media\\right_wrist\\rgb\\000003.jpeg",
        "/data//curated/c1/episode_000007/./media/right_wrist//rgb/000003 (2).jpg", "/data/curated/c1/episode_000007/media/right_wrist/rgb/../rgb/000003.jpg", "episode_000007/media/WRIST/rgb/000003.jpg"]
    rows = [(i, p, 100, "d", 1) for i, p in enumerate(ways)]
    rows += [(10, ways[0], 100, "other", 1), (11, ways[0].replace("right_wrist", "head"), 100, "d", 1), (12, ways[0].replace("000003", "000004"), None, "d", 1)]
    rows += [(20, None, 5, "d", 1), (21, "nonsense", 5, "d", 1), (22, ways[0], 5, None, 1), (None, None, None, None, None)]
    rows += [rows[0], rows[8]]
    return spark.createDataFrame(rows, SCHEMA)


def test_spellings_of_one_record(spark):
    got = {(r["file_id"], r["other_file_id"]) for r in same_record_pairs(cluster(files(spark), 1000)).collect()}
    assert got == {(a, b) for a in range(6) for b in range(a + 1, 6)}


def test_no_file_is_lost_or_kept_twice(spark):
    c = cluster(files(spark), 250).collect()
    assert sorted(r["file_id"] for r in c if r["file_id"] is not None) == [*range(6), 10, 11, 12, 20, 21, 22]
    assert sum(r["keeper"] for r in c if r["keeper"] is not None and r["known"] and r["record"].endswith("|d")) == 3
    assert len({r["record"] for r in c}) == len({r["record"] for r in c if r["keeper"] or r["file_id"] is None})


def test_shards_are_balanced_and_written_once(spark, tmp_path):
    rows = [(i, f"/d/episode_{i % 40:06d}/media/head/rgb/{i:06d}.jpg", 90 + i % 20, f"g{i}", 0) for i in range(3000)]
    c = cluster(spark.createDataFrame(rows, SCHEMA), 20000, ranges=32)
    sizes = {r["shard_id"]: r["b"] for r in c.groupBy("shard_id").sum("bytes").withColumnRenamed("sum(bytes)", "b").collect()}
    assert len(sizes) == -(-sum(r[2] for r in rows) // 20000) and max(sizes.values()) <= 20000 + 110 and sorted(sizes)[0] == 0
    out = write_shards(c, str(tmp_path / "s"), ["file_id", "bytes"]).first()
    assert out["n_rows"] == 3000 and out["files"] == len(sizes)


def test_ranges_split_heavy_cells(spark):
    df = spark.createDataFrame([(i if i % 3 else 7, 1) for i in range(3000)], "code long, w long")
    bounds = code_ranges(df, "w", 16)
    assert bounds == sorted(set(bounds)) and len(bounds) >= 3


def test_empty(spark):
    empty = files(spark).limit(0)
    assert with_codes(empty).count() == 0
    assert same_record_pairs(cluster(empty, 10)).count() == 0


def test_row_digest_sees_a_change(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i long, s string")
    b = spark.createDataFrame([(2, "y"), (1, "z")], "i long, s string")
    assert row_digests(a, ["i", "s"]).first() == row_digests(a.orderBy("s", ascending=False), ["i", "s"]).first()
    assert row_digests(a, ["i", "s"]).first() != row_digests(b, ["i", "s"]).first()




def test_nested_steps_up_resolve_at_any_depth(spark):
    from rigweave.operators.hilbert import clean_path, with_record

    deep = lambda n: "/data/episode_000007/media/head/rgb/" + "x/" * n + "../" * n + "000003.jpg"
    rows = [(deep(n),) for n in (1, 4, 5, 10, 60)] + [("C:\\data\\episode_000007\\media\\head\\rgb\\a\\.\\..\\000003.JPG",), ("../../episode_7/media/head//rgb/000003.jpg",)]
    got = with_record(spark.createDataFrame(rows, "p string"), "p").collect()
    assert {(r["episode"], r["camera"], r["frame"]) for r in got} == {(7, "head", 3)}
    assert spark.createDataFrame([("/a/../../b/./c//d",)], "p string").select(clean_path(F.col("p")).alias("c")).first()["c"] == "/../b/c/d"
