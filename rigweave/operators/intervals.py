"""Points in time against closed intervals of the same entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigweave.operators.sequence import neighbour, running_total

TIME_BITS = 36
_PASSED = 1 << 32


def classify_points(points: DataFrame, intervals: DataFrame, entity: str, ts: str, name: str = "domain") -> DataFrame:
    """Add `name`: how many of the entity's intervals ended before ts, or null where ts lies inside one (ends included).

    points: any columns with entity and ts; intervals(entity, start_ns, end_ns), not overlapping; end_ns null is open.
    One running count over the merged events answers all points, however many intervals an entity has. Points without
    entity or time get null.
    """
    columns = [F.col(c) for c in points.columns]
    packed = F.struct(*columns).alias("__iv_row")
    kind = dict(points.select(packed).dtypes)["__iv_row"]
    asked = points.select(F.col(entity).alias("__iv_entity"), F.col(ts).cast("long").alias("__iv_at"), F.lit(1).alias("__iv_kind"), packed)
    none = F.lit(None).cast(kind).alias("__iv_row")
    # at one instant starts count before the points and ends after them: both bounds lie inside
    starts = intervals.select(F.col(entity).alias("__iv_entity"), F.col("start_ns").alias("__iv_at"), F.lit(0).alias("__iv_kind"), none)
    ends = intervals.where("end_ns is not null").select(F.col(entity).alias("__iv_entity"), F.col("end_ns").alias("__iv_at"), F.lit(2).alias("__iv_kind"), none)
    events = asked.unionByName(starts).unionByName(ends)
    value = F.when(F.col("__iv_kind") == 0, F.lit(1)).when(F.col("__iv_kind") == 2, F.lit(_PASSED)).otherwise(0).cast("long")
    done = running_total(events, "__iv_entity", "__iv_at", value, "__iv_seen", ["__iv_kind"], TIME_BITS).where("__iv_kind = 1")
    started, passed = F.col("__iv_seen") % _PASSED, F.shiftright("__iv_seen", 32)
    result = F.when(F.col("__iv_entity").isNotNull() & F.col("__iv_at").isNotNull() & (started == passed), passed)
    return done.select("__iv_row.*", result.alias(name))


def clean_gaps(points: DataFrame, intervals: DataFrame, entity: str, ts: str) -> DataFrame:
    """Add clean (ts lies in no interval of the entity, ends included), lo (last end before ts) and hi (first start after it).

    intervals(entity, start_ns, end_ns), not overlapping; end_ns null is open. Two clean points lie in one clean stretch if
    their lo are the same, and lo < at < hi tells whether any other time does. Points without entity or time are not clean.
    """
    packed = F.struct(*[F.col(c) for c in points.columns]).alias("__iv_row")
    kind = dict(points.select(packed).dtypes)["__iv_row"]
    none, null = F.lit(None).cast(kind).alias("__iv_row"), F.lit(None).cast("long")
    asked = points.select(F.col(entity).alias("__iv_entity"), F.col(ts).cast("long").alias("__iv_at"), null.alias("__iv_start"), null.alias("__iv_end"), packed)
    starts = intervals.select(F.col(entity).alias("__iv_entity"), F.col("start_ns").alias("__iv_at"), F.col("start_ns").alias("__iv_start"), null.alias("__iv_end"), none)
    ends = intervals.where("end_ns is not null").select(F.col(entity).alias("__iv_entity"), F.col("end_ns").alias("__iv_at"), null.alias("__iv_start"), F.col("end_ns").alias("__iv_end"), none)
    # a key without nulls: the windows and the join share one partitioning
    events = asked.unionByName(starts).unionByName(ends).withColumns({
        "__iv_key": F.concat(F.when(F.col("__iv_entity").isNull(), "-").otherwise("+"), F.coalesce(F.col("__iv_entity").cast("string"), F.lit(""))), "__iv_chunk": F.coalesce(F.shiftright("__iv_at", TIME_BITS), F.lit(-(2**62)))})
    chunks = events.groupBy("__iv_key", "__iv_chunk").agg(F.max("__iv_end").alias("e"), F.max("__iv_start").alias("s"), F.min("__iv_start").alias("n"))
    whole = Window.partitionBy("__iv_key")
    past, coming = whole.orderBy("__iv_chunk").rowsBetween(Window.unboundedPreceding, -1), whole.orderBy(F.desc("__iv_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    far = chunks.select(F.col("__iv_key").alias("__iv_k"), F.col("__iv_chunk").alias("__iv_c"), F.max("e").over(past).alias("__iv_e"), F.max("s").over(past).alias("__iv_s"), F.min("n").over(coming).alias("__iv_n"))
    part = Window.partitionBy("__iv_key", "__iv_chunk")
    up, down = part.orderBy("__iv_at"), part.orderBy(-F.col("__iv_at"))
    near = events.withColumns({"__iv_e_in": F.max("__iv_end").over(up.rangeBetween(Window.unboundedPreceding, -1)), "__iv_s_in": F.max("__iv_start").over(up.rangeBetween(Window.unboundedPreceding, 0))})
    near = near.withColumn("__iv_n_in", F.min("__iv_start").over(down.rangeBetween(Window.unboundedPreceding, -1))).where("__iv_row is not null")
    met = near.join(far, (F.col("__iv_key") == F.col("__iv_k")) & (F.col("__iv_chunk") == F.col("__iv_c")))
    e, s, n = F.coalesce("__iv_e_in", "__iv_e"), F.coalesce("__iv_s_in", "__iv_s"), F.coalesce("__iv_n_in", "__iv_n")
    known = F.col("__iv_entity").isNotNull() & F.col("__iv_at").isNotNull()
    # the last start at or before ts belongs to an interval that has ended unless it lies behind the last end before ts
    inside = s.isNotNull() & (e.isNull() | (s > e))
    return met.select("__iv_row.*", (known & ~inside).alias("clean"), F.when(known, e).alias("lo"), F.when(known, n).alias("hi"))


def merge_overlaps(intervals: DataFrame, entity: str) -> DataFrame:
    """entity, start_ns, end_ns of the unions of overlapping or touching intervals; end_ns null is open to the end."""
    far = F.lit(2**62)
    marks = intervals.select(F.col(entity), F.col("start_ns").alias("t"), F.lit(1).alias("d")).unionByName(intervals.select(F.col(entity), F.coalesce("end_ns", far).alias("t"), F.lit(-1).alias("d")))
    # starts before ends at one instant, so that touching intervals join
    depth = running_total(marks.withColumn("o", -F.col("d")), entity, "t", F.col("d"), "depth", ["o"], TIME_BITS)
    edge = depth.where("(d = 1 and depth = 1) or (d = -1 and depth = 0)")
    paired = neighbour(edge, entity, "t", {"end_at": "t"}, ["o"], after=True, bits=TIME_BITS)
    return paired.where("d = 1").select(entity, F.col("t").alias("start_ns"), F.when(F.col("end_at") < far, F.col("end_at")).alias("end_ns"))


def origin(number: Column, count: Column) -> Column:
    """Where a clean stretch lies: full_clean without intervals, else before, between or after them."""
    return (
        F.when(count == 0, "full_clean").when(number == 0, "pre_intervention").when(number == count, "post_intervention").otherwise("between_interventions")
    )


def contained(inner: DataFrame, outer: DataFrame, key: str) -> DataFrame:
    """How many outer ranges [start, end) of the key contain each inner range: inner's columns and n_containers.

    Outer ranges do not overlap, so the one that starts last at or before the inner start is the only candidate; it is
    found by the running maximum of starts.
    """
    marks = outer.select(F.col(key), F.col("start_idx").alias("t"), F.lit(0).alias("kind"), F.col("end_idx").alias("bound"), F.lit(None).cast(dict(inner.select(F.struct("*").alias("p")).dtypes)["p"]).alias("p"))
    asked = inner.select(F.col(key), F.col("start_idx").alias("t"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("bound"), F.struct(*inner.columns).alias("p"))
    events = marks.unionByName(asked)
    # outer ranges start in order, so the number of starts so far names the last of them
    counted = running_total(events, key, "t", F.when(F.col("kind") == 0, 1).otherwise(0), "ordinal", ["kind"])
    holder = counted.where("kind = 0").select(F.col(key).alias("__iv_k"), F.col("ordinal").alias("__iv_o"), F.col("bound").alias("__iv_b"))
    rows = counted.where("kind = 1")
    met = rows.join(holder, (F.col(key) == F.col("__iv_k")) & (F.col("ordinal") == F.col("__iv_o")), "left")
    fits = F.coalesce((F.col("__iv_b") >= F.col("p.end_idx")) & (F.col("p.start_idx") < F.col("p.end_idx")), F.lit(False))
    return met.select("p.*", fits.cast("int").alias("n_containers"))
