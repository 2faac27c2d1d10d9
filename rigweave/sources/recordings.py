"""Raw recordings: episode_NNNNNN.npz files of named arrays, with JSON sidecars and image directories."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigweave.functions.media import jpeg_complete
from rigweave.sources.contracts import CURATED, RAW_TICKS, breaks


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """path, episode_id, issue of every .npz below the folder; only names are read.

    issue: INVALID_EPISODE_NAME for episode_* that is no episode_NNNNNN, MISSING_MEDIA_DIRECTORY without a sibling
    episode_NNNNNN_media holding files, null otherwise. Files of other names are ignored, and so are files without
    any content, which Spark's file sources do not list.
    """
    names = lambda glob, deep: spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", deep).load(folder).select("path")
    found = names("*.npz", "false").withColumn("stem", F.regexp_extract("path", r"([^/]+)\.npz$", 1)).where(F.col("stem").startswith("episode_"))
    media = names("*.jp*g", "true").select(F.regexp_extract("path", r"/(episode_\d{6})_media/", 1).alias("m")).where("m <> ''").distinct()
    joined = found.join(media, F.col("stem") == F.col("m"), "left")
    issue = F.when(~F.col("stem").rlike(r"^episode_\d{6}$"), "INVALID_EPISODE_NAME").when(F.col("m").isNull(), "MISSING_MEDIA_DIRECTORY")
    return joined.select("path", F.when(F.col("stem").rlike(r"^episode_\d{6}$"), F.col("stem")).alias("episode_id"), issue.alias("issue"))


def read_npz(spark: SparkSession, folder: str, schema: T.StructType = RAW_TICKS) -> DataFrame:
    """One row per tick of every canonical episode file. Arrays that a file lacks are null; pickled arrays are refused.

    A file is one recording and is read whole by one task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                episode = path.rsplit("/", 1)[-1][:-4]
                with np.load(io.BytesIO(content), allow_pickle=False) as arrays:
                    n = len(arrays["timestamp_ns"]) if "timestamp_ns" in arrays else 0
                    out = {"episode_id": [episode] * n, "tick": np.arange(n)}
                    for f in schema.fields[2:]:
                        out[f.name] = list(arrays[f.name]) if f.name in arrays and arrays[f.name].shape[:1] == (n,) else [None] * n
                yield pd.DataFrame(out, columns=schema.names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "episode_[0-9][0-9][0-9][0-9][0-9][0-9].npz").load(folder)
    return files.select("path", "content").mapInPandas(run, schema)


def read_scalars(spark: SparkSession, folder: str) -> DataFrame:
    """episode_id, name, value (text) of each file's scalars; the JSON sidecar's values stand before the file's own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with np.load(io.BytesIO(content), allow_pickle=False) as arrays:
                    rows = [(path.rsplit("/", 1)[-1][:-4], k, str(arrays[k][()])) for k in arrays.files if arrays[k].ndim == 0]
                yield pd.DataFrame(rows, columns=["episode_id", "name", "value"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "episode_[0-9][0-9][0-9][0-9][0-9][0-9].npz").load(folder)
    own = files.select("path", "content").mapInPandas(run, "episode_id string, name string, value string")
    texts = spark.read.format("binaryFile").option("pathGlobFilter", "episode_[0-9][0-9][0-9][0-9][0-9][0-9].json").load(folder)
    side = texts.select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("episode_id"), F.explode(F.from_json(F.decode("content", "UTF-8"), "map<string,string>")).alias("name", "side"))
    return own.join(side, ["episode_id", "name"], "full").select("episode_id", "name", F.coalesce("side", "value").alias("value"))


def stored_frames(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """episode_id, role, frame_index of the images below a folder; with `content`, the bytes too.

    Names that are no frame number give frame_index null.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jp*g").option("recursiveFileLookup", "true").load(folder)
    number = F.regexp_extract("path", r"/(\d+)\.jpe?g$", 1)
    return files.select(
        F.regexp_extract("path", r"/(episode_\d{6})(?:_media)?/", 1).alias("episode_id"), F.regexp_extract("path", r"/([^/]+)/rgb/[^/]+$", 1).alias("role"),
        F.when(number != "", number.cast("long")).alias("frame_index"), "path", *(["content"] if content else []))


def media_frames(spark: SparkSession, folder: str) -> DataFrame:
    """episode_id, channel (head, wrist), frame_index and decodable of the images below a folder, by their bytes' begin and end."""
    role = F.when(F.col("role") == "right_wrist", "wrist").otherwise(F.col("role"))
    rows = stored_frames(spark, folder, content=True).where("frame_index is not null and episode_id <> ''")
    return rows.select("episode_id", role.alias("channel"), "frame_index", jpeg_complete(F.col("content")).alias("decodable"))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns; a missing one is an error that names it."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def read_curated(spark: SparkSession, folder: str) -> DataFrame:
    """Curated transitions stored as Parquet, checked against their contract; a table that breaks it is refused."""
    rows = spark.read.parquet(folder)
    broken = {k: v for k, v in breaks(rows.drop("episode_id", "segment"), CURATED).items() if v}
    if broken:
        raise ValueError(f"not a curated table: {broken}")
    return rows


def read_masks(spark: SparkSession, folder: str) -> DataFrame:
    """episode_id, row, keep of every <episode>/quality_mask.npy: a mask that is no one-dimensional boolean array is refused."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                mask = np.load(io.BytesIO(content), allow_pickle=False)
                if mask.ndim != 1 or mask.dtype != bool:
                    raise ValueError(f"not a boolean mask: {path}")
                yield pd.DataFrame({"episode_id": path.rsplit("/", 2)[-2], "row": np.arange(len(mask)), "keep": mask})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "quality_mask.npy").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInPandas(run, "episode_id string, row long, keep boolean")
