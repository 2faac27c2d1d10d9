"""Changes between consecutive images of a sequence, and the choice of rows to look at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigweave.functions.arrays import total
from rigweave.operators.sequence import neighbour

#: Fixed value: images whose mean absolute difference is no more than this are nearly static.
NEAR_STATIC = 1.0


def frame_changes(images: DataFrame, key: str, seq: str) -> DataFrame:
    """key, seq, difference, exact, near_static of each image and the one before it in its sequence.

    images(key, seq, pixels array<double>, width, height); pixels null for an image that could not be decoded. The first
    image of a sequence and those at or after an undecodable one have no difference (null) and are no repeats; nor are
    images of another shape than the one before, whose difference is NaN. Other columns are ignored; empty input gives no rows.
    """
    rows = images.select(key, seq, "pixels", "width", "height")
    seen = neighbour(rows, key, seq, {"__p": "pixels", "__w": "width", "__h": "height"})
    both = F.col("pixels").isNotNull() & F.col("__p").isNotNull()
    alike = both & (F.col("width") == F.col("__w")) & (F.col("height") == F.col("__h")) & (F.size("pixels") == F.size("__p"))
    mean = total(F.zip_with("pixels", "__p", lambda a, b: F.abs(a - b))) / F.size("pixels")
    difference = F.when(alike, mean).when(both, F.lit(float("nan")))
    rows = seen.withColumn("difference", difference)
    known = F.col("difference").isNotNull() & ~F.isnan("difference")
    return rows.select(key, seq, "difference", (known & (F.col("difference") == 0)).alias("exact"), (known & (F.col("difference") <= NEAR_STATIC)).alias("near_static"))


def review_rows(rows: DataFrame, frames: DataFrame, which: str = "all") -> DataFrame:
    """The rows to look at: all, or those whose keep flag is set ("valid") or not ("invalid"), with their stored image; rows without one are left out.

    rows(episode_id, row, segment, keep, frame_index); frames(episode_id, frame_index, decodable null or boolean), one row an image.
    """
    if which not in ("all", "valid", "invalid"):
        raise ValueError(f"not a selection: {which}")
    keep = F.coalesce("keep", F.lit(False))
    chosen = rows if which == "all" else rows.where(keep if which == "valid" else ~keep)
    fine = frames.where(F.coalesce("decodable", F.lit(True))).select(F.col("episode_id").alias("f_episode"), F.col("frame_index").alias("f_frame"))
    met = chosen.join(fine, (F.col("episode_id") == F.col("f_episode")) & (F.col("frame_index") == F.col("f_frame")), "left_semi")
    return met.select("episode_id", "row", "segment", keep.alias("keep"), "frame_index")
