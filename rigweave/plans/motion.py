"""Segments, runs, lags, motion and image statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigweave.functions.arrays import all_finite, difference, flip, float32_error, luminance, neighbour_difference, norm, rot180, total
from rigweave.operators.intervals import contained
from rigweave.operators.merging import dense_ids
from rigweave.operators.sequence import islands, neighbour, row_index
from rigweave.operators.stats import bookkeeping, exact_summary, most_frequent, quantiles
from rigweave.plans.base import MOVES, TICKS, VECTORS, moves, table, ticks, vectors
from rigweave.session import settle

ARM, HAND = (0, 6), (6, 17)
#: Hand joints of a source whose sign is turned, and their places in the whole vector.
FLIPPED = (9, 12, 14)
#: Readings below this are added as decimals, so that a sum does not depend on the order of rows.
EXACT = 1e15
LAGS = {
    "state_component_skew_ns": ("abs", "arm_pre_timestamp_ns", "hand_pre_timestamp_ns"),
    "action_component_skew_ns": ("abs", "arm_action_timestamp_ns", "hand_action_timestamp_ns"),
    "arm_state_age_at_action_ns": ("age", "arm_pre_timestamp_ns", None),
    "hand_state_age_at_action_ns": ("age", "hand_pre_timestamp_ns", None),
    "head_frame_age_at_action_ns": ("age", "head_timestamp_ns", None),
    "wrist_frame_age_at_action_ns": ("age", "wrist_timestamp_ns", None),
    "head_wrist_frame_skew_ns": ("abs", "head_timestamp_ns", "wrist_timestamp_ns"),
}
LIMITS = {"state_component_skew_ns": 15_000_000, "action_component_skew_ns": 3_000_000, "head_frame_age_at_action_ns": 60_000_000, "wrist_frame_age_at_action_ns": 60_000_000, "head_wrist_frame_skew_ns": 20_000_000}


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Maximal stretches in which each transition starts where the one before ended, as [start, end) over row numbers."""
    rows = moves(spark, folder).where("episode_id is not null").select("episode_id", "tick", "next_tick")
    placed = row_index(settle(islands(rows, "episode_id", "tick", F.col("tick") != F.col("_n"), "segment", {"_n": "next_tick"}), "segments"), "episode_id", "tick", "i")
    return placed.groupBy("episode_id", "segment").agg(F.min("i").alias("start_row"), (F.max("i") + 1).alias("end_row"))


SEGMENTS = f"""{MOVES}, seg0 AS (SELECT *, row_number() OVER w - 1 AS i, CASE WHEN lag(next_tick) OVER w IS NULL OR lag(next_tick) OVER w <> tick THEN 1 ELSE 0 END AS b FROM moves WHERE episode_id IS NOT NULL WINDOW w AS (PARTITION BY episode_id ORDER BY tick)),
seg AS (SELECT *, (sum(b) OVER (PARTITION BY episode_id ORDER BY tick) - 1)::BIGINT AS segment FROM seg0)"""


def _kept(spark: SparkSession, folder: str) -> DataFrame:
    """Transitions in segments, with a keep flag: both camera times known."""
    rows = moves(spark, folder).where("episode_id is not null").withColumn("keep", F.col("head_timestamp_ns").isNotNull() & F.col("wrist_timestamp_ns").isNotNull())
    rows = rows.select("episode_id", "tick", "next_tick", "keep")
    return settle(islands(rows, "episode_id", "tick", F.col("tick") != F.col("_n"), "segment", {"_n": "next_tick"}), "kept")


def contiguous_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Maximal kept runs inside each segment, numbered inside it, as [start, end) over row numbers, with the run's name."""
    rows = _kept(spark, folder)
    cut = settle(islands(rows, "episode_id", "tick", (F.col("segment") != F.col("_s")) | (F.col("keep") != F.col("_k")), "stretch", {"_s": "segment", "_k": "keep"}), "stretches")
    runs = row_index(cut, "episode_id", "tick", "i").where("keep").groupBy("episode_id", "segment", "stretch").agg(F.min("i").alias("start_row"), (F.max("i") + 1).alias("end_row"))
    # runs of a segment are few next to its rows; their number comes from the stretches before them
    numbered = row_index(settle(runs.withColumn("key", F.concat_ws("|", "episode_id", "segment")), "runs"), "key", "stretch", "run")
    return numbered.select("episode_id", "segment", "run", "start_row", "end_row", F.format_string("%s__segment_%03d__run_%03d", "episode_id", "segment", "run").alias("run_id"))


def frame_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Dense indices of an export: episode index by run, frame index inside it and time at 30 frames a second."""
    runs = contiguous_runs(spark, folder).select("episode_id", "run_id", "start_row", "end_row")
    indexed = dense_ids(runs.withColumn("n", F.col("end_row") - F.col("start_row")), ["episode_id", "start_row"], "episode_index", "n", "base")
    frames = indexed.select("run_id", "episode_index", "base", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("frame_index"))
    return frames.select("run_id", "episode_index", "frame_index", (F.col("base") + F.col("frame_index")).alias("index"), F.round(F.col("frame_index") / F.lit(30.0), 6).alias("timestamp"), (F.col("frame_index") == F.col("n") - 1).cast("int").alias("success"))


def longest_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: longest run of one head frame reference, and of rows whose reference equals the one before (1 if none)."""
    rows = moves(spark, folder).where("episode_id is not null").select("episode_id", "tick", "head_rgb_frame_index")
    runs = islands(rows, "episode_id", "tick", ~F.col("head_rgb_frame_index").eqNullSafe(F.col("_f")) | F.col("head_rgb_frame_index").isNull(), "run", {"_f": "head_rgb_frame_index"})
    lengths = runs.groupBy("episode_id", "run").agg(F.count(F.lit(1)).alias("n"))
    return lengths.groupBy("episode_id").agg(F.max("n").alias("longest_equal"), F.sum(F.col("n") - 1).alias("same_pairs"))


def longest_repeat(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: the longest repeat of one positive head camera time, the earliest if several, and the last change."""
    return _repeats(row_index(ticks(spark, folder).where("episode_id is not null").select("episode_id", "tick", "head_ts"), "episode_id", "tick", "i"))


def _repeats(placed: DataFrame) -> DataFrame:
    rows = placed.select("episode_id", "i", "head_ts")
    rows = settle(islands(rows, "episode_id", "i", F.col("head_ts") != F.col("_h"), "run", {"_h": "head_ts"}), "repeats")
    runs = rows.groupBy("episode_id", "run").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("first"), F.max("i").alias("last"), F.max("head_ts").alias("v"))
    best = F.max(F.when(F.col("v") > 0, F.struct("n", (-F.col("first")).alias("o"), "last")))
    return runs.groupBy("episode_id").agg(best.alias("b"), F.max("first").alias("last_change")).select("episode_id", F.col("b.n").alias("repeat"), (-F.col("b.o")).alias("first_row"), F.col("b.last").alias("last_row"), "last_change")


def master_clock(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: sampler times that go back or stand still."""
    rows = neighbour(ticks(spark, folder).where("episode_id is not null").select("episode_id", "tick", "ts_ns"), "episode_id", "tick", {"before": "ts_ns"})
    step = F.col("ts_ns") - F.col("before")
    return rows.groupBy("episode_id").agg(F.count_if(step < 0).alias("backwards"), F.count_if(step == 0).alias("equal"), F.count(F.lit(1)).alias("ticks"))


def camera_health(spark: SparkSession, folder: str) -> DataFrame:
    """Head camera of each episode: ratios, lag and a conservative status."""
    rows = settle(ticks(spark, folder).where("episode_id is not null").select("episode_id", "tick", "ts_ns", "head_ts", "head_valid", "head_frame"), "ticks")
    delta = F.when((F.col("head_ts") > 0) & (F.col("ts_ns") > 0), F.col("ts_ns") - F.col("head_ts"))
    base = rows.groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("head_ts") > 0).alias("positive"), F.count_if("head_valid").alias("valid"), F.count_if(F.col("head_frame") >= 0).alias("frames"),
        F.min(delta).alias("lo"), F.max(delta).alias("hi"),
        F.min_by("ts_ns", F.when(F.col("ts_ns") > 0, F.col("tick"))).alias("m0"), F.max_by("ts_ns", F.when(F.col("ts_ns") > 0, F.col("tick"))).alias("m1"))
    # distinct times and the median lag by counts that are summed before they meet
    uniq = rows.where("head_ts > 0").select("episode_id", "head_ts").distinct().groupBy("episode_id").agg(F.count(F.lit(1)).alias("uniq"))
    median = quantiles(rows, ["episode_id"], delta, (0.5,), keep=False).select("episode_id", F.col("q")[0].alias("median"))
    base = base.join(uniq, "episode_id", "left").withColumn("uniq", F.coalesce("uniq", F.lit(0))).join(median, "episode_id")
    placed = settle(row_index(rows.select("episode_id", "tick", "ts_ns", "head_ts"), "episode_id", "tick", "i"), "placed")
    repeat = _repeats(placed).select("episode_id", F.coalesce("repeat", F.lit(0)).alias("repeat"), "first_row", "last_row")
    ends = repeat.join(placed.select("episode_id", F.col("i").alias("last_row"), F.col("ts_ns").alias("end_master"), F.col("head_ts").alias("camera_value")), ["episode_id", "last_row"], "left")
    c = base.join(ends, "episode_id", "left")
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    c = c.withColumns({"pr": ratio("positive", "total"), "vr": ratio("valid", "total"), "fr": ratio("frames", "total"), "ur": ratio("uniq", "positive"), "span_ns": F.col("m1") - F.col("m0")})
    c = c.withColumn("frozen_ns", F.when((F.col("repeat") >= 2) & (F.col("camera_value") > 0) & (F.col("end_master") > 0), F.greatest(F.lit(0), F.col("end_master") - F.col("camera_value"))))
    second = 1_000_000_000
    updating = (F.col("pr") >= 0.9) & (F.col("ur") >= 0.8)
    status = (
        F.when((F.col("total") == 0) | (F.col("positive") == 0) | (F.col("frames") == 0), "MISSING")
        .when((F.col("pr") >= 0.9) & (F.col("span_ns") >= second) & (F.col("uniq") <= F.greatest(F.lit(2), F.ceil(F.col("positive") * 0.01))) & (F.col("repeat") >= F.greatest(F.lit(3), F.ceil(F.col("total") * 0.8))) & (F.coalesce("frozen_ns", F.lit(0)) >= second), "FROZEN")
        .when(updating & (F.col("median") <= -second), "CLOCK_MISMATCH")
        .when(updating & (F.col("median") > second), F.when((F.col("median") >= 60 * second) & (F.col("hi") - F.col("lo") < second), "UNKNOWN").otherwise("STALE"))
        .when((F.col("pr") >= 0.99) & (F.col("vr") >= 0.95) & (F.col("fr") >= 0.99) & (F.col("ur") >= 0.9) & F.col("median").between(-100_000_000, 250_000_000), "HEALTHY")
        .when((F.col("pr") >= 0.5) & (F.col("fr") >= 0.5), "DEGRADED").otherwise("UNKNOWN"))
    return c.select("episode_id", "total", "positive", "valid", "frames", "uniq", "repeat", "frozen_ns", F.round("median", 3).alias("median_lag"), status.alias("status"))


def lag_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Skews and ages of each transition's evidence."""
    start = F.least("arm_action_timestamp_ns", "hand_action_timestamp_ns")
    known = F.col("arm_action_timestamp_ns").isNotNull() & F.col("hand_action_timestamp_ns").isNotNull()
    columns = [(F.abs(F.col(a) - F.col(b)) if kind == "abs" else F.when(known, start - F.col(a))).alias(name) for name, (kind, a, b) in LAGS.items()]
    return moves(spark, folder).select("transition_id", "episode_id", *columns)


_LAGS = ", ".join((f"abs({a} - {b})" if kind == "abs" else f"CASE WHEN arm_action_timestamp_ns IS NOT NULL AND hand_action_timestamp_ns IS NOT NULL THEN least(arm_action_timestamp_ns, hand_action_timestamp_ns) - {a} END") + f" AS {name}" for name, (kind, a, b) in LAGS.items())
LAG_CTE = f"{MOVES}, lags AS (SELECT transition_id, episode_id, {_LAGS} FROM moves)"
_SUM = "count({v}) AS n, round(avg({v}), 6) AS mean, round(quantile_cont({v}, 0.5), 6) AS median, round(quantile_cont({v}, 0.95), 6) AS p95, round(quantile_cont({v}, 0.99), 6) AS p99, round(max({v})::DOUBLE, 6) AS max"


def _long_lags(spark: SparkSession, folder: str) -> DataFrame:
    return lag_metrics(spark, folder).select("episode_id", F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("v")) for n in LAGS])).alias("x")).select("episode_id", "x.metric", "x.v")


def lag_summary(spark: SparkSession, folder: str) -> DataFrame:
    return exact_summary(_long_lags(spark, folder), ["metric"], F.col("v"))


def episode_median_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Distribution over episodes of each metric's median in the episode."""
    medians = quantiles(_long_lags(spark, folder), ["metric", "episode_id"], F.col("v"), (0.5,)).select("metric", F.col("q")[0].alias("m"))
    return exact_summary(medians, ["metric"], F.col("m"))


def temporal_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Transitions beyond each limit, and how many stay below all."""
    rows = lag_metrics(spark, folder)
    flags = [F.coalesce(F.col(n) > F.lit(limit), F.lit(False)) for n, limit in LIMITS.items()]
    clean = ~flags[0]
    for f in flags[1:]:
        clean = clean & ~f
    return rows.agg(*[F.count_if(f).alias(n) for f, n in zip(flags, LIMITS)], F.count_if(clean).alias("kept"), F.count(F.lit(1)).alias("total"))


def _elements(df: DataFrame, vector: str) -> DataFrame:
    return df.select(F.posexplode(vector).alias("joint", "v")).where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < F.lit(float("inf"))))


def vector_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of the size of all elements (joint -1) and of each joint, of the state vector."""
    e = _elements(vectors(spark, folder), "state").withColumn("v", F.abs("v"))
    both = e.select(F.explode(F.array(F.col("joint"), F.lit(-1))).alias("joint"), "v")
    return exact_summary(both, ["joint"], F.col("v"))


def joint_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Joints that move in each episode, by action, and the kind of hand activity."""
    e = vectors(spark, folder).where("episode_id is not null").select("episode_id", F.posexplode("action").alias("joint", "v")).where(F.col("v").isNotNull() & (F.abs("v") < F.lit(float("inf"))))
    moved = e.groupBy("episode_id", "joint").agg((F.max("v") - F.min("v") > 1e-6).alias("active"))
    per = moved.groupBy("episode_id").agg(F.count_if(F.col("active") & (F.col("joint") < ARM[1])).alias("arm_active"), F.count_if(F.col("active") & (F.col("joint") >= HAND[0])).alias("hand_active"))
    kind = F.when(F.col("hand_active") == 0, "STATIC").when(F.col("hand_active") == 1, "SINGLE_JOINT").when(F.col("hand_active") == HAND[1] - HAND[0], "FULL_HAND").otherwise("PARTIAL_HAND")
    return per.select("episode_id", "arm_active", "hand_active", kind.alias("hand_activity"))


def velocity(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: arm velocity over real time steps inside segments, and pairs skipped for steps that are not positive."""
    v = vectors(spark, folder).where("episode_id is not null").select("episode_id", "tick", "next_tick", "arm_pre_timestamp_ns", F.slice("state", 1, 6).alias("arm"))
    p = neighbour(v, "episode_id", "tick", {"p_next": "next_tick", "p_ts": "arm_pre_timestamp_ns", "p_arm": "arm"}).where("p_next = tick and p_ts is not null and arm_pre_timestamp_ns is not null")
    dt = F.col("arm_pre_timestamp_ns") - F.col("p_ts")
    p = p.withColumn("dt", dt).withColumn("step", difference(F.col("arm"), F.col("p_arm")))
    fine = (F.col("dt") > 0) & F.coalesce(all_finite(F.col("step")), F.lit(False))
    speed = F.when(fine, F.array_max(F.transform("step", lambda x: F.abs(x) / (F.col("dt") / F.lit(1e9)))))
    return p.groupBy("episode_id").agg(F.count_if(F.col("dt") <= 0).alias("skipped"), F.count(speed).alias("pairs"), F.round(F.max(speed), 6).alias("fastest"), F.round(F.avg(speed), 6).alias("mean_fastest"))


def step_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Per joint: sizes of state steps inside segments."""
    v = vectors(spark, folder).where("episode_id is not null").select("episode_id", "tick", "next_tick", "state")
    p = neighbour(v, "episode_id", "tick", {"p_next": "next_tick", "p_state": "state"}).where("p_next = tick")
    e = p.select(F.posexplode(F.zip_with("state", "p_state", lambda a, b: F.abs(a - b))).alias("joint", "v")).where(F.col("v") < F.lit(float("inf")))
    return exact_summary(e, ["joint"], F.col("v"))


def sign_flip(spark: SparkSession, folder: str) -> DataFrame:
    """Sum of each action joint after the turned joints' signs are flipped."""
    v = vectors(spark, folder).select(flip(F.col("action"), FLIPPED).alias("a"))
    fine = F.abs("v") < EXACT
    exact = F.coalesce(F.sum(F.when(fine, F.col("v").cast("decimal(28,12)"))).cast("double"), F.lit(0.0))
    return _elements(v, "a").groupBy("joint").agg(F.round(exact + F.coalesce(F.sum(F.when(~fine, F.col("v"))), F.lit(0.0)), 4).alias("total"), F.count(F.lit(1)).alias("n"))


def float32_cast(spark: SparkSession, folder: str) -> DataFrame:
    """Largest error of 32-bit storage over the finite action vectors, and vectors that cannot be stored."""
    e = vectors(spark, folder).where("action is not null").select(float32_error(F.filter("action", lambda x: x.isNotNull())).alias("e"))
    return e.agg(F.round(F.max("e"), 12).alias("worst"), F.count_if(F.col("e").isNull()).alias("unstorable"), F.count(F.lit(1)).alias("n"))


def _pixels(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings read as 8 x 8 luminance images, one sequence per label."""
    e = table(spark, folder, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: (x.cast("double") + 1) * 127.5).alias("lum"))
    return e


def pixel_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Brightness, contrast, dark and bright shares and sharpness of each image."""
    p = _pixels(spark, folder)
    mean = total(F.col("lum")) / 64
    deviation = F.sqrt(F.aggregate("lum", F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / 64)
    share = lambda test: F.size(F.filter("lum", test)) / F.lit(64.0)
    return p.select(
        "vec_id", F.round(mean, 6).alias("mean_luminance"), F.round(deviation, 6).alias("luminance_std"), F.round(share(lambda x: x <= 16), 6).alias("dark"), F.round(share(lambda x: x >= 240), 6).alias("bright"),
        F.round(neighbour_difference(F.col("lum"), 8, 8), 6).alias("blur_score"))


def frame_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Per sequence: mean absolute difference of consecutive images, exact repeats and nearly static pairs."""
    p = neighbour(_pixels(spark, folder), "label", "vec_id", {"before": "lum"}).where("before is not null")
    p = p.withColumn("d", total(F.zip_with("lum", "before", lambda a, b: F.abs(a - b))) / 64)
    return p.groupBy("label").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("d"), 6).alias("mean_difference"), F.count_if(F.col("d") == 0).alias("exact"), F.count_if(F.col("d") <= 1.0).alias("near_static"))


def rotated_corner(spark: SparkSession, folder: str) -> DataFrame:
    """First and last pixel before and after half a turn."""
    p = _pixels(spark, folder).withColumn("r", rot180(F.col("lum")))
    return p.select("vec_id", F.round(F.col("r")[0], 6).alias("first_after"), F.round(F.col("r")[63], 6).alias("last_after"))


def resolution_mode(spark: SparkSession, folder: str) -> DataFrame:
    """Per camera episode prefix: the most frequent image size class, ties to the smallest."""
    rows = table(spark, folder, "media_files").select("file_id", "n_bytes").where("n_bytes is not null").distinct()
    return most_frequent(rows.select((F.col("file_id") % 10).alias("lane"), F.floor(F.col("n_bytes") / 4096).cast("long").alias("pages")), ["lane"], ["pages"])


def bookkeeping_stats(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(*bookkeeping(F.col("l_extendedprice")))


def rules_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that break each rule of the transition contract."""
    v = vectors(spark, folder)
    m = moves(spark, folder)
    rules_m = {
        "TICK_NEGATIVE": F.col("tick") < 0, "NEXT_TICK_NOT_SUCCESSOR": F.col("next_tick") != F.col("tick") + 1, "EPISODE_ID_FORM": ~F.coalesce(F.col("episode_id").rlike(r"^episode_\d{6}$"), F.lit(False)),
        "PRE_NOT_BEFORE_ACTION": F.greatest("arm_pre_timestamp_ns", "hand_pre_timestamp_ns") >= F.least("arm_action_timestamp_ns", "hand_action_timestamp_ns"),
        "CAMERA_AFTER_ACTION": F.greatest("head_timestamp_ns", "wrist_timestamp_ns") >= F.least("arm_action_timestamp_ns", "hand_action_timestamp_ns"), "RIG_UNKNOWN": F.col("rig_id").isNull()}
    rules_v = {"STATE_MISSING": F.col("state").isNull(), "ACTION_MISSING": F.col("action").isNull(), "STATE_NOT_FINITE": ~all_finite(F.col("state")), "ACTION_NOT_FINITE": ~all_finite(F.col("action")), "STATE_WIDTH": F.size("state") != 17}
    def counted(df, rules):
        return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]).unpivot([], list(rules), "rule", "violations")
    return counted(m, rules_m).unionByName(counted(v, rules_v))


def keyframes(spark: SparkSession, folder: str) -> DataFrame:
    """Six frames of each episode with more: the ends, and the moment of most motion around each even anchor between."""
    points = 6
    v = vectors(spark, folder).where("episode_id is not null and state is not null").select("episode_id", "tick", "state")
    p = neighbour(v, "episode_id", "tick", {"after_state": "state"}, after=True)
    motion = F.coalesce(norm(F.transform(difference(F.col("after_state"), F.col("state")), lambda x: F.coalesce(x, F.lit(0.0)))), F.lit(0.0))
    rows = settle(row_index(p.select("episode_id", "tick", F.round(motion, 9).alias("motion")), "episode_id", "tick", "i"), "motion")
    sizes = rows.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))
    at = lambda k: F.bround(F.lit(k / (points - 1)) * (F.col("n") - 1)).cast("long")
    big = sizes.where(F.col("n") > points)
    inner = F.array(*[F.struct(F.lit(k).alias("k"), F.floor((at(k - 1) + at(k)) / 2).alias("lo"), (F.floor((at(k) + at(k + 1)) / 2) - 1).alias("hi")) for k in range(1, points - 1)])
    windows = big.select(F.col("episode_id").alias("e"), F.explode(inner).alias("w")).select("e", "w.*")
    # which window a row lies in follows from its position: an equi-join on the window number is enough
    placed = rows.join(windows, (F.col("episode_id") == F.col("e")) & F.col("i").between(F.col("lo"), F.col("hi")))
    best = placed.groupBy("episode_id", "k").agg(F.max_by("tick", F.struct("motion", (-F.col("i")).alias("o"))).alias("tick")).select("episode_id", "tick")
    ends = rows.join(sizes, "episode_id").where((F.col("n") <= points) | (F.col("i") == 0) | (F.col("i") == F.col("n") - 1)).select("episode_id", "tick")
    return best.unionByName(ends).distinct()


def even_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Up to 20 evenly spaced rows of each episode, positions cut to whole numbers."""
    rows = row_index(moves(spark, folder).where("episode_id is not null").select("episode_id", "tick"), "episode_id", "tick", "i")
    sizes = moves(spark, folder).where("episode_id is not null").groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))
    j = rows.join(sizes, "episode_id")
    # row i is sampled if some k gives floor(k * (n - 1) / 19) = i: the smallest k at or above i is the only candidate
    k = F.ceil(F.col("i") * 19 / (F.col("n") - 1))
    take = (F.col("n") <= 20) | ((k <= 19) & (F.floor(k * (F.col("n") - 1) / 19) == F.col("i")))
    return j.where(take).select("episode_id", "tick")


def coarse_allocation(spark: SparkSession, folder: str) -> DataFrame:
    """Points for each segment of an episode: one each, then always to the one with most rows per point, ties to the first; 24 in all."""
    from pyspark.sql import Window

    most = 24
    segs = settle(segments(spark, folder).select("episode_id", "segment", (F.col("end_row") - F.col("start_row")).alias("len")), "segments")
    count = segs.groupBy("episode_id").agg(F.count(F.lit(1)).alias("m"))
    # the k-th further point of a segment has worth len / k; no segment takes more than the points that are left
    offers = segs.join(count, "episode_id").where(F.col("m") < most).select("episode_id", "segment", "len", "m", F.explode(F.sequence(F.lit(1), F.lit(most) - F.col("m"))).alias("k"))
    w = Window.partitionBy("episode_id").orderBy((F.col("len") / F.col("k")).desc(), "segment", "k")
    won = offers.withColumn("r", F.row_number().over(w)).where(F.col("r") <= most - F.col("m")).groupBy("episode_id", "segment").agg(F.count(F.lit(1)).alias("extra"))
    return segs.join(won, ["episode_id", "segment"], "left").select("episode_id", "segment", "len", (F.lit(1) + F.coalesce("extra", F.lit(0))).alias("points"))


def boundary_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Around each inner boundary of 50-row blocks: the candidate rows within 5, clipped to the segment."""
    radius = 5
    segs = segments(spark, folder)
    cut = segs.where("end_row - start_row > 50").select("episode_id", "segment", "start_row", "end_row", F.explode(F.sequence(F.lit(1), F.floor((F.col("end_row") - F.col("start_row") - 1) / 50).cast("int"))).alias("b"))
    edge = F.col("start_row") + F.col("b") * 50
    return cut.select("episode_id", "segment", edge.alias("boundary"), F.greatest("start_row", edge - radius).alias("lo"), (F.least("end_row", edge + radius + 1) - 1).alias("hi"))


def tiling(spark: SparkSession, folder: str) -> DataFrame:
    """Whether an episode's segments cover its rows without gap or overlap."""
    segs = settle(segments(spark, folder), "segments")
    p = neighbour(segs, "episode_id", "start_row", {"p_end": "end_row"})
    return p.groupBy("episode_id").agg(F.count_if(F.col("p_end") != F.col("start_row")).alias("breaks"), F.min("start_row").alias("first"), F.max("end_row").alias("last"))


def containment(spark: SparkSession, folder: str) -> DataFrame:
    """For each kept run, how many segments contain it."""
    runs = settle(contiguous_runs(spark, folder).select("episode_id", F.col("start_row").alias("start_idx"), F.col("end_row").alias("end_idx")), "inner")
    outer = settle(segments(spark, folder).select("episode_id", F.col("start_row").alias("start_idx"), F.col("end_row").alias("end_idx")), "outer")
    return contained(runs, outer, "episode_id")


def timeline(spark: SparkSession, folder: str) -> DataFrame:
    """At most 600 points of each episode's ticks, evenly spaced, half to even."""
    rows = settle(row_index(ticks(spark, folder).where("episode_id is not null").select("episode_id", "tick"), "episode_id", "tick", "i"), "rows")
    sizes = rows.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))
    points = sizes.select("episode_id", "n", F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(600)) - 1)).alias("k"))
    pick = points.select("episode_id", F.when(F.col("n") <= 600, F.col("k")).otherwise(F.bround(F.col("k") * (F.col("n") - 1) / F.lit(599.0))).cast("long").alias("i")).distinct()
    return rows.join(pick, ["episode_id", "i"]).select("episode_id", "tick")


def queries() -> dict:
    return {f.__name__: f for f in (
        segments, contiguous_runs, frame_numbers, longest_runs, longest_repeat, master_clock, camera_health, lag_metrics, lag_summary, episode_median_distribution, temporal_flags, vector_summary, joint_activity,
        velocity, step_summary, sign_flip, float32_cast, pixel_metrics, frame_difference, rotated_corner, resolution_mode, bookkeeping_stats, rules_report, keyframes, even_samples, coarse_allocation,
        boundary_candidates, tiling, containment, timeline)}


_RUNS = f"""{SEGMENTS}, kept AS (SELECT *, head_timestamp_ns IS NOT NULL AND wrist_timestamp_ns IS NOT NULL AS keep FROM seg),
isl AS (SELECT *, i - row_number() OVER (PARTITION BY episode_id, segment, keep ORDER BY tick) AS grp FROM kept),
runs0 AS (SELECT episode_id, segment, min(i) AS start_row, max(i) + 1 AS end_row FROM isl WHERE keep GROUP BY episode_id, segment, grp),
runs AS (SELECT *, row_number() OVER (PARTITION BY episode_id, segment ORDER BY start_row) - 1 AS run FROM runs0),
named AS (SELECT *, episode_id || '__segment_' || lpad(segment::VARCHAR, 3, '0') || '__run_' || lpad(run::VARCHAR, 3, '0') AS run_id FROM runs)"""
_SEGTAB = f"{SEGMENTS}, segments AS (SELECT episode_id, segment, min(i) AS start_row, max(i) + 1 AS end_row FROM seg GROUP BY ALL)"
_REPEAT = f"""{TICKS}, ti AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY tick) - 1 AS i FROM ticks WHERE episode_id IS NOT NULL),
ch AS (SELECT *, CASE WHEN lag(head_ts) OVER w IS NULL OR lag(head_ts) OVER w <> head_ts THEN 1 ELSE 0 END AS b FROM ti WINDOW w AS (PARTITION BY episode_id ORDER BY i)),
rn AS (SELECT *, sum(b) OVER (PARTITION BY episode_id ORDER BY i) AS run FROM ch),
rr AS (SELECT episode_id, run, count(*) AS n, min(i) AS first, max(i) AS last, max(head_ts) AS v FROM rn GROUP BY ALL),
best AS (SELECT episode_id, arg_max(n, n * 1000000000 - first) FILTER (v > 0) AS repeat, arg_max(first, n * 1000000000 - first) FILTER (v > 0) AS first_row, arg_max(last, n * 1000000000 - first) FILTER (v > 0) AS last_row, max(first) AS last_change FROM rr GROUP BY 1)"""
_PIX = "px AS (SELECT vec_id, label, list_transform(embedding, lambda x: (x::DOUBLE + 1) * 127.5) AS lum FROM embeddings)"
_ACROSS = "list_transform(list_filter(range(64), lambda i: i % 8 < 7), lambda i: abs(lum[i + 2] - lum[i + 1]))"
_DOWN = "list_transform(range(56), lambda i: abs(lum[i + 9] - lum[i + 1]))"
_EL = "SELECT *, generate_subscripts({v}, 1) - 1 AS joint, unnest({v}) AS v FROM vectors"


def oracle_sql() -> dict[str, str]:
    fin = "v IS NOT NULL AND isfinite(v)"
    s = lambda v: _SUM.format(v=v)
    longlag = " UNION ALL ".join(f"SELECT episode_id, '{n}' AS metric, {n} AS v FROM lags" for n in LAGS)
    at = lambda k: f"round_even({k / 5!r} * (n - 1), 0)::BIGINT"
    return {
        "segments": f"WITH {_SEGTAB} SELECT * FROM segments",
        "contiguous_runs": f"WITH {_RUNS} SELECT episode_id, segment, run, start_row, end_row, run_id FROM named",
        "frame_numbers": f"""WITH {_RUNS}, o AS (SELECT run_id, row_number() OVER w - 1 AS episode_index, end_row - start_row AS n, coalesce(sum(end_row - start_row) OVER (ORDER BY episode_id, start_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM named WINDOW w AS (ORDER BY episode_id, start_row)),
f AS (SELECT *, unnest(range(n)) AS frame_index FROM o) SELECT run_id, episode_index, frame_index, base + frame_index AS index, round(frame_index / 30.0, 6) AS timestamp, (frame_index = n - 1)::INT AS success FROM f""",
        "longest_runs": f"""WITH {MOVES}, b AS (SELECT episode_id, tick, CASE WHEN head_rgb_frame_index = lag(head_rgb_frame_index) OVER (PARTITION BY episode_id ORDER BY tick) THEN 0 ELSE 1 END AS b FROM moves WHERE episode_id IS NOT NULL),
r AS (SELECT episode_id, sum(b) OVER (PARTITION BY episode_id ORDER BY tick) AS run FROM b), l AS (SELECT episode_id, run, count(*) AS n FROM r GROUP BY ALL)
SELECT episode_id, max(n) AS longest_equal, sum(n - 1)::BIGINT AS same_pairs FROM l GROUP BY 1""",
        "longest_repeat": f"WITH {_REPEAT} SELECT * FROM best",
        "master_clock": f"WITH {TICKS}, s AS (SELECT episode_id, ts_ns - lag(ts_ns) OVER (PARTITION BY episode_id ORDER BY tick) AS d FROM ticks WHERE episode_id IS NOT NULL) SELECT episode_id, count(*) FILTER (d < 0) AS backwards, count(*) FILTER (d = 0) AS equal, count(*) AS ticks FROM s GROUP BY 1",
        "camera_health": f"""WITH {_REPEAT}, base AS (SELECT episode_id, count(*) AS total, count(*) FILTER (head_ts > 0) AS positive, count(*) FILTER (head_valid) AS valid, count(*) FILTER (head_frame >= 0) AS frames, count(DISTINCT CASE WHEN head_ts > 0 THEN head_ts END) AS uniq,
  quantile_cont(CASE WHEN head_ts > 0 AND ts_ns > 0 THEN (ts_ns - head_ts)::DOUBLE END, 0.5) AS median, min(CASE WHEN head_ts > 0 AND ts_ns > 0 THEN ts_ns - head_ts END) AS lo, max(CASE WHEN head_ts > 0 AND ts_ns > 0 THEN ts_ns - head_ts END) AS hi,
  arg_max(ts_ns, tick) FILTER (ts_ns > 0) - arg_min(ts_ns, tick) FILTER (ts_ns > 0) AS span FROM ti GROUP BY 1),
c AS (SELECT b.*, coalesce(r.repeat, 0) AS repeat, CASE WHEN coalesce(r.repeat, 0) >= 2 AND t.head_ts > 0 AND t.ts_ns > 0 THEN greatest(0, t.ts_ns - t.head_ts) END AS frozen_ns,
  positive / total AS pr, valid / total AS vr, frames / total AS fr, CASE WHEN positive > 0 THEN uniq / positive ELSE 0 END AS ur FROM base b LEFT JOIN best r USING (episode_id) LEFT JOIN ti t ON t.episode_id = b.episode_id AND t.i = r.last_row)
SELECT episode_id, total, positive, valid, frames, uniq, repeat, frozen_ns, round(median, 3) AS median_lag, CASE WHEN total = 0 OR positive = 0 OR frames = 0 THEN 'MISSING'
  WHEN pr >= 0.9 AND span >= 1000000000 AND uniq <= greatest(2, ceil(positive * 0.01)) AND repeat >= greatest(3, ceil(total * 0.8)) AND coalesce(frozen_ns, 0) >= 1000000000 THEN 'FROZEN'
  WHEN pr >= 0.9 AND ur >= 0.8 AND median <= -1000000000 THEN 'CLOCK_MISMATCH' WHEN pr >= 0.9 AND ur >= 0.8 AND median > 1000000000 THEN CASE WHEN median >= 60000000000 AND hi - lo < 1000000000 THEN 'UNKNOWN' ELSE 'STALE' END
  WHEN pr >= 0.99 AND vr >= 0.95 AND fr >= 0.99 AND ur >= 0.9 AND median BETWEEN -100000000 AND 250000000 THEN 'HEALTHY' WHEN pr >= 0.5 AND fr >= 0.5 THEN 'DEGRADED' ELSE 'UNKNOWN' END AS status FROM c""",
        "lag_metrics": f"WITH {LAG_CTE} SELECT * FROM lags",
        "lag_summary": f"WITH {LAG_CTE}, x AS ({longlag}) SELECT metric, {s('v')} FROM x GROUP BY 1",
        "episode_median_distribution": f"WITH {LAG_CTE}, x AS ({longlag}), m AS (SELECT metric, episode_id, quantile_cont(v::DOUBLE, 0.5) AS m FROM x GROUP BY ALL) SELECT metric, {s('m')} FROM m GROUP BY 1",
        "temporal_flags": f"WITH {LAG_CTE} SELECT {', '.join(f'count(*) FILTER ({n} > {v}) AS {n}' for n, v in LIMITS.items())}, count(*) FILTER ({' AND '.join(f'NOT coalesce({n} > {v}, false)' for n, v in LIMITS.items())}) AS kept, count(*) AS total FROM lags",
        "vector_summary": f"WITH {VECTORS}, e AS ({_EL.format(v='state')}), x AS (SELECT joint, abs(v) AS v FROM e WHERE {fin} AND abs(v) < 1e6 UNION ALL SELECT -1, abs(v) FROM e WHERE {fin} AND abs(v) < 1e6) SELECT joint, {s('v')} FROM x GROUP BY 1",
        "joint_activity": f"""WITH {VECTORS}, e AS ({_EL.format(v='action')}), m AS (SELECT episode_id, joint, max(v) - min(v) > 1e-6 AS active FROM e WHERE {fin} AND episode_id IS NOT NULL GROUP BY ALL),
p AS (SELECT episode_id, count(*) FILTER (active AND joint < 6) AS arm_active, count(*) FILTER (active AND joint >= 6) AS hand_active FROM m GROUP BY 1)
SELECT *, CASE hand_active WHEN 0 THEN 'STATIC' WHEN 1 THEN 'SINGLE_JOINT' WHEN 11 THEN 'FULL_HAND' ELSE 'PARTIAL_HAND' END AS hand_activity FROM p""",
        "velocity": f"""WITH {VECTORS}, p AS (SELECT episode_id, tick, state, arm_pre_timestamp_ns - lag(arm_pre_timestamp_ns) OVER w AS dt, lag(next_tick) OVER w AS p_next, lag(state) OVER w AS p_state FROM vectors WHERE episode_id IS NOT NULL WINDOW w AS (PARTITION BY episode_id ORDER BY tick)),
x AS (SELECT episode_id, dt, CASE WHEN state IS NOT NULL AND p_state IS NOT NULL THEN list_transform(range(1, 7), lambda i: abs(state[i] - p_state[i])) END AS st FROM p WHERE p_next = tick AND dt IS NOT NULL),
y AS (SELECT episode_id, dt, CASE WHEN dt > 0 AND st IS NOT NULL AND len(list_filter(st, lambda v: v IS NULL OR NOT isfinite(v))) = 0 THEN list_max(st) / (dt / 1e9) END AS sp FROM x)
SELECT episode_id, count(*) FILTER (dt <= 0) AS skipped, count(sp) AS pairs, round(max(sp), 6) AS fastest, round(avg(sp), 6) AS mean_fastest FROM y GROUP BY 1""",
        "step_summary": f"""WITH {VECTORS}, p AS (SELECT tick, state, lag(next_tick) OVER w AS p_next, lag(state) OVER w AS p_state FROM vectors WHERE episode_id IS NOT NULL WINDOW w AS (PARTITION BY episode_id ORDER BY tick)),
x AS (SELECT unnest(range(17)) AS joint, state, p_state FROM p WHERE p_next = tick AND state IS NOT NULL AND p_state IS NOT NULL), y AS (SELECT joint, CASE WHEN isfinite(state[joint + 1]) AND isfinite(p_state[joint + 1]) THEN abs(state[joint + 1] - p_state[joint + 1]) END AS v FROM x)
SELECT joint, {s('v')} FROM y WHERE v < 1e6 GROUP BY 1""",
        "sign_flip": f"WITH {VECTORS}, e AS ({_EL.format(v='action')}) SELECT joint, round(sum(CASE WHEN joint IN (9, 12, 14) THEN -v ELSE v END), 4) AS total, count(*) AS n FROM e WHERE {fin} AND abs(v) < 1e6 GROUP BY 1",
        "float32_cast": f"""WITH {VECTORS}, f AS (SELECT list_filter(action, lambda x: x IS NOT NULL) AS a FROM vectors WHERE action IS NOT NULL),
e AS (SELECT CASE WHEN len(list_filter(a, lambda x: NOT isfinite(x) OR abs(x) > 3.4028235e38)) = 0 THEN list_max(list_transform(a, lambda x: abs(x - x::FLOAT::DOUBLE))) END AS e FROM f)
SELECT round(max(CASE WHEN e < 1 THEN e END), 12) AS worst, count(*) FILTER (e IS NULL) AS unstorable, count(*) AS n FROM e""",
        "pixel_metrics": f"""WITH {_PIX} SELECT vec_id, round(list_avg(lum), 6) AS mean_luminance, round(list_stddev_pop(lum), 6) AS luminance_std, round(len(list_filter(lum, lambda x: x <= 16)) / 64.0, 6) AS dark,
  round(len(list_filter(lum, lambda x: x >= 240)) / 64.0, 6) AS bright, round((list_avg({_ACROSS}) + list_avg({_DOWN})) / 2, 6) AS blur_score FROM px""",
        "frame_difference": f"""WITH {_PIX}, p AS (SELECT label, lum, lag(lum) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM px), d AS (SELECT label, list_avg(list_transform(range(1, 65), lambda i: abs(lum[i] - b[i]))) AS d FROM p WHERE b IS NOT NULL)
SELECT label, count(*) AS pairs, round(avg(d), 6) AS mean_difference, count(*) FILTER (d = 0) AS exact, count(*) FILTER (d <= 1.0) AS near_static FROM d GROUP BY 1""",
        "rotated_corner": f"WITH {_PIX} SELECT vec_id, round(lum[64], 6) AS first_after, round(lum[1], 6) AS last_after FROM px",
        "resolution_mode": """WITH m AS (SELECT DISTINCT file_id, n_bytes FROM media_files WHERE n_bytes IS NOT NULL), c AS (SELECT file_id % 10 AS lane, n_bytes // 4096 AS pages, count(*) AS n FROM m GROUP BY ALL)
SELECT lane, pages, n FROM c QUALIFY row_number() OVER (PARTITION BY lane ORDER BY n DESC, pages) = 1""",
        "bookkeeping_stats": "SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, round(min(l_extendedprice), 6) AS min, round(max(l_extendedprice), 6) AS max, round(avg(l_extendedprice), 6) AS mean, round(stddev_pop(l_extendedprice), 6) AS std FROM lineitem GROUP BY 1, 2",
        "rules_report": f"""WITH {MOVES}, {VECTORS}, a AS (SELECT least(arm_action_timestamp_ns, hand_action_timestamp_ns) AS act, * FROM moves)
SELECT 'TICK_NEGATIVE' AS rule, count(*) FILTER (tick < 0) AS violations FROM a UNION ALL SELECT 'NEXT_TICK_NOT_SUCCESSOR', count(*) FILTER (next_tick <> tick + 1) FROM a
UNION ALL SELECT 'EPISODE_ID_FORM', count(*) FILTER (NOT coalesce(regexp_full_match(episode_id, 'episode_\\d{{6}}'), false)) FROM a UNION ALL SELECT 'PRE_NOT_BEFORE_ACTION', count(*) FILTER (greatest(arm_pre_timestamp_ns, hand_pre_timestamp_ns) >= act) FROM a
UNION ALL SELECT 'CAMERA_AFTER_ACTION', count(*) FILTER (greatest(head_timestamp_ns, wrist_timestamp_ns) >= act) FROM a UNION ALL SELECT 'RIG_UNKNOWN', count(*) FILTER (rig_id IS NULL) FROM a
UNION ALL SELECT 'STATE_MISSING', count(*) FILTER (state IS NULL) FROM vectors UNION ALL SELECT 'ACTION_MISSING', count(*) FILTER (action IS NULL) FROM vectors
UNION ALL SELECT 'STATE_NOT_FINITE', count(*) FILTER (len(list_filter(state, lambda x: x IS NULL OR NOT isfinite(x))) > 0) FROM vectors UNION ALL SELECT 'ACTION_NOT_FINITE', count(*) FILTER (len(list_filter(action, lambda x: x IS NULL OR NOT isfinite(x))) > 0) FROM vectors
UNION ALL SELECT 'STATE_WIDTH', count(*) FILTER (len(state) <> 17) FROM vectors""",
        "keyframes": f"""WITH {VECTORS}, p AS (SELECT episode_id, tick, state, lead(state) OVER w AS nxt, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY episode_id) AS n FROM vectors WHERE episode_id IS NOT NULL AND state IS NOT NULL WINDOW w AS (PARTITION BY episode_id ORDER BY tick)),
m AS (SELECT episode_id, tick, i, n, round(coalesce(sqrt(list_sum(list_transform(range(1, 18), lambda j: coalesce(power(nxt[j] - state[j], 2), 0)))), 0), 9) AS motion FROM p),
w AS (SELECT DISTINCT episode_id, k, (CASE k WHEN 1 THEN {at(0)} + {at(1)} WHEN 2 THEN {at(1)} + {at(2)} WHEN 3 THEN {at(2)} + {at(3)} ELSE {at(3)} + {at(4)} END) // 2 AS lo, (CASE k WHEN 1 THEN {at(1)} + {at(2)} WHEN 2 THEN {at(2)} + {at(3)} WHEN 3 THEN {at(3)} + {at(4)} ELSE {at(4)} + {at(5)} END) // 2 - 1 AS hi
  FROM m, (VALUES (1), (2), (3), (4)) t(k) WHERE n > 6),
r AS (SELECT m.episode_id, m.tick, row_number() OVER (PARTITION BY m.episode_id, k ORDER BY isfinite(motion), motion DESC, i) AS o FROM m JOIN w ON m.episode_id = w.episode_id AND m.i BETWEEN lo AND hi)
SELECT DISTINCT episode_id, tick FROM (SELECT episode_id, tick FROM r WHERE o = 1 UNION ALL SELECT episode_id, tick FROM m WHERE n <= 6 OR i = 0 OR i = n - 1)""",
        "even_samples": f"""WITH {MOVES}, p AS (SELECT episode_id, tick, row_number() OVER (PARTITION BY episode_id ORDER BY tick) - 1 AS i, count(*) OVER (PARTITION BY episode_id) AS n FROM moves WHERE episode_id IS NOT NULL),
k AS (SELECT DISTINCT episode_id, n, unnest(list_transform(range(20), lambda k: (k * (n - 1)) // 19)) AS i FROM (SELECT DISTINCT episode_id, n FROM p WHERE n > 20))
SELECT episode_id, tick FROM p WHERE n <= 20 UNION SELECT p.episode_id, p.tick FROM p JOIN k USING (episode_id, i)""",
        "coarse_allocation": f"""WITH {_SEGTAB}, s AS (SELECT episode_id, segment, end_row - start_row AS len, count(*) OVER (PARTITION BY episode_id) AS m FROM segments),
o AS (SELECT *, unnest(range(1, 25 - m)) AS k FROM s WHERE m < 24), w AS (SELECT episode_id, segment FROM o QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY len / k DESC, segment, k) <= 24 - m)
SELECT s.episode_id, s.segment, s.len, 1 + count(w.segment) AS points FROM s LEFT JOIN w ON s.episode_id = w.episode_id AND s.segment = w.segment GROUP BY ALL""",
        "boundary_candidates": f"""WITH {_SEGTAB}, b AS (SELECT *, start_row + 50 * unnest(range(1, (end_row - start_row - 1) // 50 + 1)) AS boundary FROM segments WHERE end_row - start_row > 50)
SELECT episode_id, segment, boundary, greatest(start_row, boundary - 5) AS lo, least(end_row, boundary + 6) - 1 AS hi FROM b""",
        "tiling": f"WITH {_SEGTAB}, p AS (SELECT *, lag(end_row) OVER (PARTITION BY episode_id ORDER BY start_row) AS pe FROM segments) SELECT episode_id, count(*) FILTER (pe <> start_row) AS breaks, min(start_row) AS first, max(end_row) AS last FROM p GROUP BY 1",
        "containment": f"WITH {_RUNS}, segments AS (SELECT episode_id, segment, min(i) AS start_row, max(i) + 1 AS end_row FROM seg GROUP BY ALL) SELECT r.episode_id, r.start_row AS start_idx, r.end_row AS end_idx, count(s.segment)::INT AS n_containers FROM named r LEFT JOIN segments s ON s.episode_id = r.episode_id AND s.start_row <= r.start_row AND r.end_row <= s.end_row GROUP BY ALL",
        "timeline": f"""WITH {TICKS}, p AS (SELECT episode_id, tick, row_number() OVER (PARTITION BY episode_id ORDER BY tick) - 1 AS i, count(*) OVER (PARTITION BY episode_id) AS n FROM ticks WHERE episode_id IS NOT NULL),
k AS (SELECT DISTINCT episode_id, CASE WHEN n <= 600 THEN k ELSE round_even(k * (n - 1) / 599.0, 0)::BIGINT END AS i FROM (SELECT episode_id, n, unnest(range(least(n, 600))) AS k FROM (SELECT DISTINCT episode_id, n FROM p)))
SELECT p.episode_id, p.tick FROM p JOIN k USING (episode_id, i)""",
    }
