"""Consolidating many small files: Hilbert-curve clustering into balanced shards (problem 3).

A file's record is known by episode, camera and frame number, read from any spelling of its path, and its content digest.
Records get a code on the Hilbert curve over (episode, frame and camera), with bits of the content digest below it. An
exact histogram of bytes by code, refined only where it is heavy, cuts the codes into ranges; rows are shuffled by range
and filled into shards in curve order. Repeated files of a record are found inside the range that the record falls in.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigweave.operators.skew import join_unique
from rigweave.session import settle

ORDER = 21
DIGEST_BITS = 20
CODE_BITS = 2 * ORDER + DIGEST_BITS
#: Counts of the histogram that reach the driver at a time, and the number of ranges: so many rows each, within bounds.
CELLS = 1 << 18
RANGE_ROWS, FEWEST_RANGES, MOST_RANGES = 250_000, 256, 16_384


def hilbert_code(x: np.ndarray, y: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Position on the Hilbert curve of the given order of each point of the square."""
    x, y = x.astype(np.int64).copy(), y.astype(np.int64).copy()
    code = np.zeros(len(x), dtype=np.int64)
    for level in range(order - 1, -1, -1):
        side = np.int64(1) << level
        rx, ry = (x & side) > 0, (y & side) > 0
        code += side * side * ((3 * rx) ^ ry)
        # turn the quadrant so that the curve goes on where it ended
        flip = ~ry & rx
        x, y = np.where(flip, side - 1 - (x & (side - 1)), x & (side - 1)), np.where(flip, side - 1 - (y & (side - 1)), y & (side - 1))
        x, y = np.where(~ry, y, x), np.where(~ry, x, y)
    return code


def clean_path(path: Column) -> Column:
    """One spelling of a path: forward slashes, lower case, no empty or '.' steps, '..' resolved however deeply nested."""
    p = F.lower(F.trim(F.translate(path, "\\", "/")))
    none = F.array().cast("array<string>")

    def step(done: Column, name: Column) -> Column:
        up = (name == "..") & (F.size(done) > 0) & (F.get(done, F.size(done) - 1) != "..")
        return F.when((name == "") | (name == "."), done).when(up, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(F.array_append(done, name))

    resolved = F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(p, "/"), none, step), "/"))
    return F.when(F.contains(p, F.lit("/.")) | F.contains(p, F.lit("//")), resolved).otherwise(p)


def with_record(df: DataFrame, path: str) -> DataFrame:
    """Add episode, camera and frame of a path; camera 'wrist' stands for right_wrist too. Null where the path does not tell."""
    # projections of their own: the cleaned path and its steps are read several times and must not be computed as often
    df = df.withColumn("__path", clean_path(F.col(path))).withColumn("__steps", F.split("__path", "/"))
    number = lambda c: F.nullif(c, F.lit("")).cast("long")
    back = lambda k: F.get("__steps", F.size("__steps") - k)
    episode = number(F.regexp_extract("__path", r"episode[_\- ]?(\d+)(?:_media)?/", 1))
    camera = F.when((back(2) == "rgb") & (F.size("__steps") > 3), F.when(back(3) == "right_wrist", "wrist").otherwise(F.nullif(back(3), F.lit(""))))
    frame = F.when(F.size("__steps") > 1, number(F.regexp_extract(back(1), r"^(\d+)(?: ?\(\d+\))?\.jpe?g$", 1)))
    return df.withColumns({"episode": episode, "camera": camera, "frame": frame}).drop("__path", "__steps")


def with_codes(files: DataFrame) -> DataFrame:
    """files(file_id, path, n_bytes, digest) -> one row per file_id with episode, camera, frame and code.

    A file that arrives again is one file. Paths that do not tell their record, and missing digests, make a file a record
    of its own (record null) whose code follows a hash of its id.
    """

    @F.pandas_udf("long")
    def code(episode: pd.Series, lane: pd.Series, low: pd.Series) -> pd.Series:
        mask = (1 << ORDER) - 1
        return pd.Series((hilbert_code(episode.to_numpy() & mask, lane.to_numpy() & mask) << DIGEST_BITS) | low.to_numpy())

    once = files.groupBy("file_id").agg(F.max("path").alias("path"), F.max("n_bytes").alias("n_bytes"), F.max("digest").alias("digest"))
    rows = with_record(once, "path")
    known = F.col("episode").isNotNull() & F.col("camera").isNotNull() & F.col("frame").isNotNull() & F.col("digest").isNotNull()
    spare = F.shiftrightunsigned(F.xxhash64(F.lit("spare"), "file_id"), 1)
    low = F.shiftrightunsigned(F.xxhash64(F.lit("digest"), "digest"), 64 - DIGEST_BITS)
    return rows.withColumn("known", known).withColumn(
        "code",
        code(F.when(known, F.col("episode")).otherwise(spare), F.when(known, F.col("frame") * 2 + F.pmod(F.xxhash64("camera"), F.lit(2))).otherwise(F.shiftright(spare, ORDER)), F.when(known, low).otherwise(spare % (1 << DIGEST_BITS))),
    )


def code_histogram(coded: DataFrame, weight: str, ranges: int, low: int, high: int, total: int) -> tuple[list[int], list[int]]:
    """Lower bounds of code ranges, and the weight of each; none is heavier than 1/ranges of the total unless it is a single code.

    low, high and total: the smallest and largest code and the sum of weights. The histogram is exact at every level; only
    cells that are too heavy are counted again at the next, so finely that about CELLS counts reach the driver at a time.
    """
    weighted = coded.groupBy("code").agg(F.sum(weight).alias("w"))
    limit = max(1, -(-total // ranges))
    done: list[tuple[int, int]] = []
    # leading bits that all codes share need no counting
    shift, heavy = min(CODE_BITS, (low ^ high).bit_length()), None
    while True:
        last_shift = shift
        shift = max(0, shift - max(1, (CELLS // len(heavy or [0])).bit_length() - 1))
        cells = weighted.withColumn("cell", F.shiftright("code", shift))
        if heavy is not None:
            parents = coded.sparkSession.createDataFrame([(int(h),) for h in heavy], "parent long")
            cells = cells.join(F.broadcast(parents), F.shiftright("cell", last_shift - shift) == F.col("parent"), "left_semi")
        counts = cells.groupBy("cell").agg(F.sum("w").alias("w")).collect()
        heavy = [r["cell"] for r in counts if r["w"] > limit and shift > 0]
        done += [(r["cell"] << shift, int(r["w"])) for r in counts if not (r["w"] > limit and shift > 0)]
        if not heavy:
            break
    bounds, loads = [], []
    for start, w in sorted(done):
        if not bounds or loads[-1] + w > limit:
            bounds.append(start)
            loads.append(0)
        loads[-1] += w
    return bounds, loads


def code_ranges(coded: DataFrame, weight: str, ranges: int = FEWEST_RANGES) -> list[int]:
    """Lower bounds of code ranges by code_histogram."""
    low, high, total = coded.agg(F.min("code"), F.max("code"), F.sum(weight)).first()
    return code_histogram(coded, weight, ranges, low or 0, high or 0, int(total or 0))[0]


def cluster(files: DataFrame, capacity: int, ranges: int | None = None) -> DataFrame:
    """Assign every image record to a shard of about `capacity` bytes, in curve order.

    Result: every file with code, keeper (true for the one file that is kept of each record, the smallest file_id),
    keeper_id, copies (files of the record) and shard_id (that of its record). Null sizes count as the mean of the known
    ones. No file is lost or stored twice. ranges: at how many the codes are cut; by default as many as the rows need.
    """
    coded = with_codes(files)
    record = F.when(F.col("known"), F.concat_ws("|", "episode", "camera", "frame", "digest")).otherwise(F.concat(F.lit("#"), F.coalesce(F.col("file_id").cast("string"), F.lit("null"))))
    coded = settle(coded.withColumn("record", record), "codes")
    kept = coded.groupBy("record").agg(F.min("file_id").alias("keeper_id"), F.min("code").alias("code"), F.max("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("copies"))
    kept = settle(kept, "records")
    n, low, high, known, total = kept.agg(F.count(F.lit(1)), F.min("code"), F.max("code"), F.count("n_bytes"), F.sum("n_bytes")).first()
    mean = int((total or 0) // known) if known else 1
    size = F.coalesce("n_bytes", F.lit(mean)).cast("long")
    if ranges is None:
        ranges = min(MOST_RANGES, max(FEWEST_RANGES, -(-n // RANGE_ROWS)))
    kept = kept.withColumn("bytes", size)
    bounds, loads = code_histogram(kept, "bytes", ranges, low or 0, high or 0, int(total or 0) + mean * (n - known))
    bounds = np.array(bounds, dtype=np.int64)
    before = np.r_[0, np.cumsum(np.array(loads, dtype=np.int64))]

    @F.pandas_udf("range_id int, before long")
    def range_of(code: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(bounds, code.to_numpy(), side="right") - 1
        return pd.DataFrame({"range_id": at.astype(np.int32), "before": before[at]})

    # the shuffle by range; inside one, the running sum in curve order tells the shard
    ranged = kept.withColumn("r", range_of("code")).select("record", "keeper_id", "code", "bytes", "copies", "r.range_id", "r.before")
    inside = Window.partitionBy("range_id").orderBy("code", "record").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("bytes").over(inside), F.lit(0))
    shards = ranged.select(F.col("record").alias("of_record"), "keeper_id", "copies", F.floor(at / F.lit(capacity)).cast("long").alias("shard_id"), "range_id")
    return join_unique(coded.withColumn("bytes", size), "record", shards, "of_record", rows=None).select(
        "file_id", "episode", "camera", "frame", "digest", "bytes", "known", "record", "code", "range_id", "shard_id", "keeper_id", "copies", (F.col("file_id") == F.col("keeper_id")).alias("keeper"))


def same_record_pairs(clustered: DataFrame) -> DataFrame:
    """(file_id, other_file_id), smaller first: files of one range and code that hold the same record.

    As many rows as there are pairs, so quadratic in a record's copies; `cluster` gives each file's keeper instead, which
    tells the same in one row a file.
    """
    rows = settle(clustered.where("known and copies > 1").select("range_id", "code", "record", "file_id"), "copies")
    other = rows.select(F.col("range_id").alias("r2"), F.col("code").alias("c2"), F.col("record").alias("rec2"), F.col("file_id").alias("other_file_id"))
    met = (F.col("range_id") == F.col("r2")) & (F.col("code") == F.col("c2")) & (F.col("record") == F.col("rec2")) & (F.col("file_id") < F.col("other_file_id"))
    return rows.join(other, met).select("file_id", "other_file_id")


def row_digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Order-free digest of a table: row count, sum and xor of row hashes. Equal tables give equal digests."""
    h = F.xxhash64(*columns)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h.cast("decimal(38,0)")).alias("sum_hash"), F.bit_xor(h).alias("xor_hash"))


def write_shards(clustered: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """Write the kept records, one file per shard, and compare digests of what was meant and what is on disk.

    Result: one row n_rows, sum_hash, xor_hash, files; raises if a record was lost, changed or written twice.
    """
    kept = clustered.where("keeper")
    shards = kept.agg(F.max("shard_id")).first()[0]
    spark = clustered.sparkSession
    if shards is not None:
        # a shard is the work of one task and one file; the number of tasks follows the number of shards
        kept.repartitionByRange(min(shards + 1, 100_000), "shard_id").sortWithinPartitions("shard_id", "code").write.partitionBy("shard_id").parquet(path)
        stored = spark.read.parquet(path)
        wanted, got = row_digests(kept, columns).first(), row_digests(stored, columns).first()
        if wanted != got:
            raise RuntimeError(f"shards differ from their source: {wanted} and {got}")
        files = stored.select(F.input_file_name().alias("f")).distinct().count()
        return row_digests(stored, columns).withColumn("files", F.lit(files).cast("long"))
    return row_digests(kept, columns).withColumn("files", F.lit(0).cast("long"))
