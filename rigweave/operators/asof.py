"""Strict as-of joins: the latest sample before, or the earliest after, a boundary, never at it.

Boundaries and samples are cut into time buckets per entity. A window inside the bucket finds the nearest sample there;
the best of all earlier (later) buckets comes from a table with one row per bucket. Everything stays in whole-stage
generated code, and a single entity may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 34


def strict_asof(boundaries: DataFrame, samples: DataFrame, after: bool = False, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """For each boundary: the nearest eligible sample strictly before (after) it, and what was there at all.

    boundaries(boundary_id, entity string, ts long); samples(entity, ts long, row long, eligible boolean, payload any).
    Result: boundary_id, entity, ts, pick_ts, pick_row, payload (null without an eligible sample), any_positive (a sample
    with a positive time exists on that side, eligible or not). Before: of equal times the largest row wins; after: the
    smallest. Null entities or times never match; eligible null counts as false; repeated boundaries keep their rows.
    """
    sign = -1 if after else 1
    t = F.col("ts") * sign
    asked = boundaries.where("entity is not null and ts is not null").select(
        "entity", t.alias("t"), F.lit(1).alias("kind"), "boundary_id", F.lit(None).cast("long").alias("row"), F.lit(False).alias("eligible"), F.lit(None).cast(dict(samples.dtypes)["payload"]).alias("payload"), F.lit(False).alias("positive"))
    have = samples.where("entity is not null and ts is not null").select(
        "entity", t.alias("t"), F.lit(0).alias("kind"), F.lit(None).cast(dict(boundaries.dtypes)["boundary_id"]).alias("boundary_id"), (F.col("row") * sign).alias("row"), F.coalesce("eligible", F.lit(False)).alias("eligible"), "payload", (F.col("ts") > 0).alias("positive"))
    rows = have.unionByName(asked).withColumn("bucket", F.shiftright("t", bucket_bits))
    best = F.max(F.when(F.col("eligible"), F.struct("t", "row", "payload")))
    seen = F.max(F.when((F.col("kind") == 0) & F.col("positive"), F.lit(True)))
    earlier = Window.partitionBy("entity").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket; buckets that hold boundaries only must appear too
    carry = rows.groupBy("entity", "bucket").agg(best.alias("b"), seen.alias("s"))
    carry = carry.select(F.col("entity").alias("c_entity"), F.col("bucket").alias("c_bucket"), F.max("b").over(earlier).alias("b_before"), F.max("s").over(earlier).alias("s_before"))
    inside = Window.partitionBy("entity", "bucket").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("b_in", best.over(inside)).withColumn("s_in", seen.over(inside)).where("kind = 1")
    met = near.join(carry, (F.col("entity") == F.col("c_entity")) & (F.col("bucket") == F.col("c_bucket")))
    pick = F.coalesce("b_in", "b_before")
    return met.select(
        "boundary_id", "entity", (F.col("t") * sign).alias("ts"), (pick["t"] * sign).alias("pick_ts"), (pick["row"] * sign).alias("pick_row"), pick["payload"].alias("payload"),
        F.coalesce("s_in", "s_before", F.lit(False)).alias("any_positive"))


def both_sides(asked: DataFrame, samples: DataFrame, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """strict_asof for questions on either side in one pass: ask, entity, channel, after, ts, pick_ts, pick_row, payload, any_positive.

    asked(ask any, entity string, channel string, ts long, after boolean); samples(entity, channel, ts, row, eligible,
    payload). Rows are shuffled once by entity, channel and time bucket; the best of all other buckets comes from a table
    with one row per bucket. Rules as in strict_asof.
    """
    key = ["entity", "channel", "bucket"]
    known = "entity is not null and channel is not null and ts is not null"
    none = lambda df, c: F.lit(None).cast(dict(df.dtypes)[c]).alias(c)
    q = asked.where(known).select("entity", "channel", "ts", "after", "ask", F.lit(None).cast("long").alias("row"), F.lit(False).alias("eligible"), none(samples, "payload"), F.lit(False).alias("positive"), F.lit(True).alias("asks"))
    s = samples.where(known).select(
        "entity", "channel", "ts", F.lit(None).cast("boolean").alias("after"), none(asked, "ask"), F.col("row").cast("long").alias("row"), F.coalesce("eligible", F.lit(False)).alias("eligible"), "payload", (F.col("ts") > 0).alias("positive"), F.lit(False).alias("asks"))
    rows = s.unionByName(q).withColumn("bucket", F.shiftright("ts", bucket_bits))
    last = F.max(F.when(F.col("eligible"), F.struct("ts", "row", "payload")))
    # the earliest of the following, the smallest row of equal times: the largest of negated values
    turned = F.max(F.when(F.col("eligible"), F.struct((-F.col("ts")).alias("t"), (-F.col("row")).alias("r"), "payload")))
    seen = F.max(F.when(F.col("positive"), F.lit(True)))
    order = Window.partitionBy("entity", "channel").orderBy("bucket")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("entity", "channel").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(*key).agg(last.alias("l"), turned.alias("n"), seen.alias("p"))
    carry = carry.select(*[F.col(k).alias(f"c_{k}") for k in key], F.max("l").over(earlier).alias("l_far"), F.max("p").over(earlier).alias("p_before"), F.max("n").over(later).alias("n_far"), F.max("p").over(later).alias("p_after"))
    inside = Window.partitionBy(*key)
    up, down = inside.orderBy("ts").rangeBetween(Window.unboundedPreceding, -1), inside.orderBy(-F.col("ts")).rangeBetween(Window.unboundedPreceding, -1)
    near = rows.withColumns({"l_in": last.over(up), "s_before": seen.over(up)}).withColumns({"n_in": turned.over(down), "s_after": seen.over(down)}).where("asks")
    met = near.join(carry, (F.col("entity") == F.col("c_entity")) & (F.col("channel") == F.col("c_channel")) & (F.col("bucket") == F.col("c_bucket")))
    before, after = F.coalesce("l_in", "l_far"), F.coalesce("n_in", "n_far")
    side = lambda a, b: F.when(F.col("after"), a).otherwise(b)
    return met.select(
        "ask", "entity", "channel", "after", "ts", side(-after["t"], before["ts"]).alias("pick_ts"), side(-after["r"], before["row"]).alias("pick_row"), side(after["payload"], before["payload"]).alias("payload"),
        side(F.coalesce("s_after", "p_after", F.lit(False)), F.coalesce("s_before", "p_before", F.lit(False))).alias("any_positive"))
