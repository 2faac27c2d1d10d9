"""Evaluation of curated episodes: contract, velocities and steps, activity, durations, references and health of channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rigweave.functions.arrays import all_finite, luminance, total
from rigweave.operators.hashrank import below_fraction
from rigweave.operators.hilbert import with_record
from rigweave.operators.contract import verdicts, violations
from rigweave.operators.frames import frame_changes, review_rows
from rigweave.operators.sequence import islands, neighbour, row_index
from rigweave.operators.stats import exact_summary, most_frequent, quantiles
from rigweave.plans.base import MEDIA, MOVES, SAMPLES, TICKS, VECTORS, media, moves, samples, table, ticks
from rigweave.session import settle

#: Part of the robot, vector, first and last place in it (1-based), and the clock that times it.
PARTS = (("arm_state", "state", 1, 6, "arm_pre_timestamp_ns"), ("hand_state", "state", 7, 11, "hand_pre_timestamp_ns"), ("arm_action", "action", 1, 6, "arm_action_timestamp_ns"), ("hand_action", "action", 7, 11, "hand_action_timestamp_ns"))
#: Fixed value: a joint moves if its range exceeds this.
EPSILON = 1e-6


def _contract_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Transitions under the contract's names; of redelivered rows any one, as they are equal."""
    state, action = F.greatest("arm_pre_timestamp_ns", "hand_pre_timestamp_ns"), F.greatest("arm_action_timestamp_ns", "hand_action_timestamp_ns")
    return table(spark, folder, "transitions").dropDuplicates(["transition_id"]).select(
        "episode_id", "source_tick_index", "next_state_tick_index", state.alias("state_timestamp_ns"), action.alias("action_timestamp_ns"), F.lit(None).cast("long").alias("next_state_timestamp_ns"),
        F.col("arm_pre_timestamp_ns").alias("arm_qpos_source_timestamp_ns"), F.col("hand_pre_timestamp_ns").alias("hand_qpos_source_timestamp_ns"), F.col("arm_action_timestamp_ns").alias("arm_qcmd_source_timestamp_ns"),
        F.col("hand_action_timestamp_ns").alias("hand_qcmd_source_timestamp_ns"), F.col("state17").alias("robot_qpos_17d_rad"), F.col("action17").alias("robot_qcmd_17d_rad"), "head_rgb_frame_index", F.col("wrist_rgb_frame_index").alias("right_wrist_rgb_frame_index"))


def _broken(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = settle(_contract_rows(spark, folder).where("episode_id is not null"), "contract")
    return rows, violations(rows, media(spark, folder).where(F.col("role").isin("head", "wrist")))


def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each episode that break each rule of the contract."""
    return _broken(spark, folder)[1]


def contract_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """FAIL, WARN or PASS for each episode; images that nothing refers to only warn."""
    rows, broken = _broken(spark, folder)
    return verdicts(rows.select("episode_id").distinct(), broken, ("MEDIA_UNREFERENCED",)).select("episode_id", "quality", F.size("errors").alias("n_errors"))


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Consecutive transitions of a segment with both vectors and all four clocks of each."""
    rows = table(spark, folder, "transitions").select(
        "transition_id", "episode_id", F.col("source_tick_index").alias("tick"), F.col("next_state_tick_index").alias("next_tick"), F.col("state17").alias("state"), F.col("action17").alias("action"), *[p[4] for p in PARTS]).dropDuplicates(["transition_id"])
    rows = rows.where("episode_id is not null").drop("transition_id")
    before = {f"p_{c}": c for c in ("next_tick", "state", "action", *[p[4] for p in PARTS])}
    return neighbour(rows, "episode_id", "tick", before).where("p_next_tick = tick")


def _velocities(spark: SparkSession, folder: str) -> DataFrame:
    """part, dt and joint speeds of each pair and part whose clock is known at both ends."""
    each = F.array(*[
        F.struct(F.lit(part).alias("part"), (F.col(clock) - F.col(f"p_{clock}")).alias("dt"), F.slice(v, first, n).alias("now"), F.slice(f"p_{v}", first, n).alias("before")) for part, v, first, n, clock in PARTS])
    return _pairs(spark, folder).select("episode_id", F.explode(each).alias("x")).select("episode_id", "x.*").where("dt is not null")


def _summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    """exact_summary to nine places; a mean depends on the order of additions in its last digits and is given to four, or to thousands where it is large."""
    mean = F.when(F.abs("mean") < 1e5, F.round("mean", 4)).otherwise(F.round("mean", -3))
    return exact_summary(rows, keys, F.col("v"), 9).withColumn("mean", mean)


def velocity_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Speeds over real time steps inside segments, by part and joint (-1 for all of a part); steps of no time are left out."""
    v = _velocities(spark, folder).where("dt > 0").select("part", F.posexplode(F.zip_with("now", "before", lambda a, b: F.abs(a - b))).alias("joint", "d"), "dt")
    both = v.select("part", F.explode(F.array(F.col("joint"), F.lit(-1))).alias("joint"), (F.col("d") / (F.col("dt") / F.lit(1e9))).alias("v"))
    return _summary(both, ["part", "joint"])


def velocity_timing(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of each part and those skipped for a time step that is not positive."""
    return _velocities(spark, folder).groupBy("part").agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("dt") <= 0).alias("skipped"))


def _both_vectors(v: Column, w: Column) -> Column:
    return F.explode(F.array(F.struct(F.lit("state").alias("field"), v.alias("x")), F.struct(F.lit("action").alias("field"), w.alias("x")))).alias("f")


def step_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of all finite steps of both vectors inside segments, by joint (-1 for all)."""
    size = lambda c: F.zip_with(c, f"p_{c}", lambda a, b: F.abs(a - b))
    e = _pairs(spark, folder).select(_both_vectors(size("state"), size("action"))).select("f.field", F.posexplode("f.x").alias("joint", "v"))
    return _summary(e.select("field", F.explode(F.array(F.col("joint"), F.lit(-1))).alias("joint"), "v"), ["field", "joint"])


def vector_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of all finite readings of both vectors, by joint (-1 for all)."""
    rows = table(spark, folder, "transitions").select("transition_id", F.col("state17").alias("state"), F.col("action17").alias("action")).dropDuplicates(["transition_id"])
    e = rows.select(_both_vectors(F.col("state"), F.col("action"))).select("f.field", F.posexplode("f.x").alias("joint", "v"))
    return _summary(e.select("field", F.explode(F.array(F.col("joint"), F.lit(-1))).alias("joint"), F.abs("v").alias("v")), ["field", "joint"])


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """Joints of each episode that move by state, by action and by either, the masks of both, and the kinds of activity that follow."""
    rows = table(spark, folder, "transitions").where("episode_id is not null").select("transition_id", "episode_id", F.col("state17").alias("state"), F.col("action17").alias("action")).dropDuplicates(["transition_id"])
    e = rows.select("episode_id", _both_vectors(F.col("state"), F.col("action"))).select("episode_id", "f.field", F.posexplode("f.x").alias("joint", "v")).where("joint < 17 and v is not null and abs(v) < double('inf')")
    moved = e.groupBy("episode_id", "joint").agg(*[(F.max(F.when(F.col("field") == f, F.col("v"))) - F.min(F.when(F.col("field") == f, F.col("v"))) > EPSILON).alias(f) for f in ("state", "action")])
    moved = moved.select("episode_id", "joint", F.coalesce("state", F.lit(False)).alias("state"), F.coalesce("action", F.lit(False)).alias("action"))
    arm, hand, any_ = F.col("joint") < 6, F.col("joint") >= 6, F.col("state") | F.col("action")
    bit = lambda c: F.coalesce(F.bit_or(F.when(c, F.expr("shiftleft(1, joint)"))), F.lit(0))
    per = moved.groupBy("episode_id").agg(
        F.count_if(any_).alias("active"), F.count_if(any_ & arm).alias("arm_active"), F.count_if(any_ & hand).alias("hand_active"), F.count_if(F.col("action") & hand).alias("hand_action_active"),
        bit(F.col("state")).cast("long").alias("state_mask"), bit(F.col("action")).cast("long").alias("action_mask"))
    kind = F.when(F.col("hand_action_active") == 0, "STATIC").when(F.col("hand_action_active") == 1, "SINGLE_JOINT").when(F.col("hand_action_active") == 11, "FULL_HAND").otherwise("PARTIAL_HAND")
    return per.select(
        "*", kind.alias("hand_action_activity"), (F.col("active") == 0).alias("static_episode"), (F.col("active") == 1).alias("single_active_joint"),
        F.col("hand_active").between(1, 10).alias("partial_hand"), (F.col("hand_active") == 11).alias("full_hand"), ((F.col("arm_active") > 0) & (F.col("hand_active") == 11)).alias("full_arm_hand"))


def durations(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: seconds of action inside segments, and from the first action to the last."""
    rows = moves(spark, folder).where("episode_id is not null").select("episode_id", "tick", "next_tick", F.greatest("arm_action_timestamp_ns", "hand_action_timestamp_ns").alias("at"))
    cut = islands(rows, "episode_id", "tick", F.col("tick") != F.col("_n"), "segment", {"_n": "next_tick"})
    ends = cut.groupBy("episode_id", "segment").agg(F.min_by("at", "tick").alias("first"), F.max_by("at", "tick").alias("last"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    return ends.groupBy("episode_id").agg(F.count(F.lit(1)).alias("segments"), F.coalesce(F.sum(F.col("last") - F.col("first")), F.lit(0)).alias("duration_ns"), (F.max("hi") - F.min("lo")).alias("span_ns"))


def media_references(spark: SparkSession, folder: str) -> DataFrame:
    """References to images of each camera, and the distinct images among them."""
    m = moves(spark, folder).where("episode_id is not null")
    cameras = F.array(F.struct(F.lit("head").alias("camera"), F.col("head_rgb_frame_index").alias("frame")), F.struct(F.lit("wrist").alias("camera"), F.col("wrist_rgb_frame_index").alias("frame")))
    rows = m.select("episode_id", F.explode(cameras).alias("c")).select("episode_id", "c.*").where("frame >= 0")
    # summed by image before it is counted: no list of distinct images in one task
    return rows.groupBy("camera", "episode_id", "frame").agg(F.count(F.lit(1)).alias("n")).groupBy("camera").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct_images"))


def channel_health(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of each episode and channel: with a positive time, eligible, and their shares (0 without samples)."""
    s = samples(spark, folder).where("episode_id is not null").groupBy("episode_id", "channel").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("ts") > 0).alias("positive"), F.count_if("eligible").alias("eligible"))
    share = lambda c: F.round(F.when(F.col("total") > 0, F.col(c) / F.col("total")).otherwise(0.0), 6)
    return s.select("*", share("positive").alias("positive_share"), share("eligible").alias("eligible_share"))


def action_health(spark: SparkSession, folder: str) -> DataFrame:
    """Actions of each episode: those with both times, with positive ones, with a vector and with a finite one, and the shares of the first and the last."""
    rows = table(spark, folder, "transitions").where("episode_id is not null").select(
        "transition_id", "episode_id", F.col("arm_action_timestamp_ns").alias("a"), F.col("hand_action_timestamp_ns").alias("h"), F.col("action17").isNotNull().alias("present"), F.coalesce(all_finite(F.col("action17")), F.lit(False)).alias("finite")).distinct()
    per = rows.groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("a").isNotNull() & F.col("h").isNotNull()).alias("timed"), F.count_if((F.col("a") > 0) & (F.col("h") > 0)).alias("positive"), F.count_if("present").alias("present"), F.count_if("finite").alias("finite"))
    return per.select("*", F.round(F.col("timed") / F.col("total"), 6).alias("timed_share"), F.round(F.col("finite") / F.col("total"), 6).alias("finite_share"))


def image_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings read as 8 x 8 images in one sequence per label: pairs with a difference, exact repeats, near-static pairs and the largest difference."""
    e = table(spark, folder, "embeddings").select("label", "vec_id", F.transform("embedding", lambda x: (x.cast("double") + 1) * 127.5).alias("pixels"), F.lit(8).alias("width"), F.lit(8).alias("height"))
    c = frame_changes(e, "label", "vec_id")
    return c.groupBy("label").agg(F.count("difference").alias("pairs"), F.count_if("exact").alias("exact"), F.count_if("near_static").alias("near_static"), F.round(F.max("difference"), 6).alias("largest"))


def review_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Transitions without both camera times, with their segment, whose head image is stored: what a reviewer of invalid rows is shown."""
    rows = moves(spark, folder).where("episode_id is not null").withColumn("keep", F.col("head_timestamp_ns").isNotNull() & F.col("wrist_timestamp_ns").isNotNull())
    cut = islands(rows, "episode_id", "tick", F.col("tick") != F.col("_n"), "segment", {"_n": "next_tick"}).select("episode_id", F.col("tick").alias("row"), "segment", "keep", F.col("head_rgb_frame_index").alias("frame_index"))
    stored = media(spark, folder).where("role = 'head'").select("episode_id", "frame_index", F.lit(None).cast("boolean").alias("decodable"))
    return review_rows(cut, stored, "invalid").select("episode_id", "row", "segment", "frame_index")


#: Points of the report, and thresholds of the work they would cause.
PERCENTILES, THRESHOLDS = (0, 10, 25, 50, 75, 90, 95, 100), (0.70, 0.80, 0.90, 0.95)


def _confidence(spark: SparkSession, folder: str) -> DataFrame:
    """Share of eligible samples of each episode and channel, as confidence in it."""
    return settle(channel_health(spark, folder).select(F.concat_ws("/", "episode_id", "channel").alias("id"), F.col("eligible_share").alias("c"), (F.col("positive_share") < 1).alias("flagged")), "confidence")


def health_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles and mean of the confidence in channels."""
    q = quantiles(_confidence(spark, folder), [], F.col("c"), tuple(p / 100 for p in PERCENTILES), keep=False)
    points = F.array(*[F.lit(p) for p in PERCENTILES])
    return q.select(F.posexplode("q").alias("i", "value"), F.round(F.col("total") / F.col("n"), 6).alias("mean")).select(points[F.col("i")].alias("percentile"), F.round("value", 6).alias("value"), "mean")


def health_workload(spark: SparkSession, folder: str) -> DataFrame:
    """Channels that each threshold of confidence would send to review."""
    counts = _confidence(spark, folder).agg(*[F.count_if(F.col("c") < t).alias(str(i)) for i, t in enumerate(THRESHOLDS)])
    return counts.unpivot([], [str(i) for i in range(len(THRESHOLDS))], "i", "n").select(F.array(*[F.lit(t) for t in THRESHOLDS])[F.col("i").cast("int")].alias("threshold"), "n")


def health_review(spark: SparkSession, folder: str) -> DataFrame:
    """Channels below a confidence of 0.9, then flagged ones, then a hash-ranked tenth of the rest."""
    c = _confidence(spark, folder)
    low, flagged = F.col("c") < 0.9, F.col("flagged")
    rest = below_fraction(c.where(~low & ~flagged).select("id"), "id", 0.1, 7, "s", "r").where("split = 's'").select("id", F.lit("RANDOM").alias("why"))
    return c.where(low).select("id", F.lit("LOW_CONFIDENCE").alias("why")).unionByName(c.where(~low & flagged).select("id", F.lit("QUALITY_WARNING").alias("why"))).unionByName(rest)


def size_mode(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent size of the image files of each episode and camera, ties to the smallest; files that arrived again count once."""
    files = with_record(table(spark, folder, "media_files").select("file_id", "rgb_path", "n_bytes").where("n_bytes is not null").distinct(), "rgb_path").where("episode is not null and camera is not null")
    return most_frequent(files.select("episode", "camera", "n_bytes"), ["episode", "camera"], ["n_bytes"])


def longest_flagged(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: 1 and the longest streak of ticks whose wrist camera flag holds (1 where none does)."""
    rows = ticks(spark, folder).where("episode_id is not null").select("episode_id", "tick", F.coalesce("wrist_valid", F.lit(False)).alias("flag"))
    runs = islands(rows, "episode_id", "tick", F.col("flag") != F.col("_f"), "run", {"_f": "flag"}).groupBy("episode_id", "run").agg(F.count(F.lit(1)).alias("n"), F.max("flag").alias("flag"))
    return runs.groupBy("episode_id").agg((F.lit(1) + F.coalesce(F.max(F.when(F.col("flag"), F.col("n"))), F.lit(0))).alias("longest"))


def homogeneity(spark: SparkSession, folder: str) -> DataFrame:
    """Rigs of each episode, and whether it is recorded on one only."""
    rows = ticks(spark, folder).where("episode_id is not null and rig_id is not null").select("episode_id", "rig_id").distinct()
    return rows.groupBy("episode_id").agg(F.count(F.lit(1)).alias("rigs"), F.min("rig_id").alias("rig_id")).withColumn("single", F.col("rigs") == 1)


def rgb_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings read as 21 RGB pixels: mean and spread of luminance, dark and bright shares."""
    e = table(spark, folder, "embeddings").select("vec_id", F.transform("embedding", lambda x: (x.cast("double") + 1) * 127.5).alias("p"))
    lum = e.select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: luminance(F.get("p", i * 3), F.get("p", i * 3 + 1), F.get("p", i * 3 + 2))).alias("lum"))
    mean = total(F.col("lum")) / 21
    spread = F.sqrt(F.aggregate("lum", F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / 21)
    share = lambda test: F.size(F.filter("lum", test)) / F.lit(21.0)
    return lum.select("vec_id", F.round(mean, 6).alias("mean_luminance"), F.round(spread, 6).alias("luminance_std"), F.round(share(lambda x: x <= 16), 6).alias("dark"), F.round(share(lambda x: x >= 240), 6).alias("bright"))


def even_rounded(spark: SparkSession, folder: str) -> DataFrame:
    """Up to 20 evenly spaced rows of each episode, positions rounded half to even."""
    rows = settle(row_index(moves(spark, folder).where("episode_id is not null").select("episode_id", "tick"), "episode_id", "tick", "i"), "rows")
    sizes = rows.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))
    # at most 20 positions an episode
    pick = sizes.select("episode_id", "n", F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(20)) - 1)).alias("k"))
    pick = pick.select("episode_id", F.when(F.col("n") <= 20, F.col("k")).otherwise(F.bround(F.col("k") * (F.col("n") - 1) / F.lit(19.0))).cast("long").alias("i")).distinct()
    return rows.join(pick, ["episode_id", "i"]).select("episode_id", "tick")


def queries() -> dict:
    return {f.__name__: f for f in (
        contract_violations, contract_verdicts, velocity_summary, velocity_timing, step_statistics, vector_statistics, activity, durations, media_references, channel_health, action_health, image_changes, review_selection, health_percentiles, health_workload, health_review, size_mode, longest_flagged, homogeneity, rgb_metrics, even_rounded)}


_SUM = "count(v) AS n, CASE WHEN abs(avg(v)) < 1e5 THEN round(avg(v), 4) ELSE round(avg(v), -3) END AS mean, round(quantile_cont(v, 0.5), 9) AS median, round(quantile_cont(v, 0.95), 9) AS p95, round(quantile_cont(v, 0.99), 9) AS p99, round(max(v), 9) AS max"
_ONE = """tr AS (SELECT DISTINCT transition_id, episode_id, source_tick_index AS tick, next_state_tick_index AS next_tick, state17 AS state, action17 AS action, arm_pre_timestamp_ns AS t1, hand_pre_timestamp_ns AS t2, arm_action_timestamp_ns AS t3,
  hand_action_timestamp_ns AS t4, head_rgb_frame_index AS hf, wrist_rgb_frame_index AS wf FROM transitions)"""
_PAIR = f"""{_ONE}, pr AS (SELECT *, lag(next_tick) OVER w AS pn, lag(state) OVER w AS ps, lag(action) OVER w AS pa, t1 - lag(t1) OVER w AS d1, t2 - lag(t2) OVER w AS d2, t3 - lag(t3) OVER w AS d3, t4 - lag(t4) OVER w AS d4
  FROM tr WHERE episode_id IS NOT NULL WINDOW w AS (PARTITION BY episode_id ORDER BY tick)), pp AS (SELECT * FROM pr WHERE pn = tick)"""
_VEL = f"""{_PAIR}, vel AS (SELECT 'arm_state' AS part, d1 AS dt, state[1:6] AS a, ps[1:6] AS b FROM pp UNION ALL SELECT 'hand_state', d2, state[7:17], ps[7:17] FROM pp
  UNION ALL SELECT 'arm_action', d3, action[1:6], pa[1:6] FROM pp UNION ALL SELECT 'hand_action', d4, action[7:17], pa[7:17] FROM pp), vk AS (SELECT * FROM vel WHERE dt IS NOT NULL)"""


_FILES = r"""files AS (SELECT DISTINCT file_id, n_bytes, nullif(regexp_extract(p, 'episode[_\- ]?(\d+)(?:_media)?/', 1), '')::BIGINT AS episode,
  nullif(replace(regexp_extract(p, '/([^/]+)/rgb/[^/]*$', 1), 'right_wrist', 'wrist'), '') AS camera FROM (SELECT file_id, n_bytes, replace(regexp_replace(regexp_replace(lower(trim(replace(rgb_path, '\', '/'))), '/(\./)+', '/', 'g'), '/{2,}', '/', 'g'), 'rgb/../', '') AS p FROM media_files))"""


def _all_and_each(inner: str, keys: str) -> str:
    return f"x AS ({inner}), y AS (SELECT {keys}, joint, v FROM x UNION ALL SELECT {keys}, -1, v FROM x) SELECT {keys}, joint::INT AS joint, {_SUM.replace('(v', '(w')} FROM (SELECT *, CASE WHEN isfinite(v) THEN v END AS w FROM y) GROUP BY {keys}, joint"


def oracle_sql() -> dict[str, str]:
    conf = f"{SAMPLES}, conf AS (SELECT episode_id || '/' || channel AS id, round(count(*) FILTER (eligible) / count(*), 6) AS c, count(*) FILTER (ts > 0) < count(*) AS f FROM samples WHERE episode_id IS NOT NULL GROUP BY episode_id, channel)"
    bad = lambda a: f"len(list_filter({a}, lambda x: x IS NULL OR NOT isfinite(x))) > 0"
    rules = {
        "ARM_QPOS_SOURCE_TIMESTAMP_NS_NOT_POSITIVE": "t1 <= 0", "HAND_QPOS_SOURCE_TIMESTAMP_NS_NOT_POSITIVE": "t2 <= 0", "ARM_QCMD_SOURCE_TIMESTAMP_NS_NOT_POSITIVE": "t3 <= 0", "HAND_QCMD_SOURCE_TIMESTAMP_NS_NOT_POSITIVE": "t4 <= 0",
        "ARM_QPOS_SOURCE_TIMESTAMP_NS_MISSING": "t1 IS NULL", "HAND_QPOS_SOURCE_TIMESTAMP_NS_MISSING": "t2 IS NULL", "ARM_QCMD_SOURCE_TIMESTAMP_NS_MISSING": "t3 IS NULL", "HAND_QCMD_SOURCE_TIMESTAMP_NS_MISSING": "t4 IS NULL",
        "ROBOT_QPOS_17D_RAD_MISSING": "state IS NULL", "ROBOT_QCMD_17D_RAD_MISSING": "action IS NULL", "ROBOT_QPOS_17D_RAD_WIDTH": "len(state) <> 17", "ROBOT_QCMD_17D_RAD_WIDTH": "len(action) <> 17",
        "ROBOT_QPOS_17D_RAD_NOT_FINITE": bad("state"), "ROBOT_QCMD_17D_RAD_NOT_FINITE": bad("action"), "TICK_NEGATIVE": "tick < 0", "NEXT_TICK_NOT_SUCCESSOR": "next_tick <> tick + 1", "TICK_NOT_INCREASING": "tick <= p_tick",
        "STATE_NOT_BEFORE_ACTION": "greatest(t1, t2) >= least(t3, t4)", "HEAD_FRAME_NEGATIVE": "hf < 0", "WRIST_FRAME_NEGATIVE": "wf < 0"}
    contract = f"""WITH {_ONE}, {MEDIA}, o AS (SELECT *, lag(tick) OVER (PARTITION BY episode_id ORDER BY tick) AS p_tick FROM tr WHERE episode_id IS NOT NULL),
asked AS (SELECT DISTINCT episode_id, 'head' AS role, hf AS f FROM o WHERE hf >= 0 UNION SELECT DISTINCT episode_id, 'wrist', wf FROM o WHERE wf >= 0),
have AS (SELECT episode_id, role, frame_index AS f FROM media WHERE role IN ('head', 'wrist') AND episode_id IN (SELECT episode_id FROM asked)),
broken AS ({' UNION ALL '.join(f"SELECT episode_id, '{n}' AS rule, count(*) FILTER ({c}) AS n FROM o GROUP BY 1" for n, c in rules.items())}
  UNION ALL SELECT episode_id, 'MEDIA_MISSING', count(*) FROM (SELECT * FROM asked EXCEPT SELECT * FROM have) GROUP BY 1 UNION ALL SELECT episode_id, 'MEDIA_UNREFERENCED', count(*) FROM (SELECT * FROM have EXCEPT SELECT * FROM asked) GROUP BY 1)"""
    steps = "SELECT '{f}' AS field, unnest(range(len({v}))) AS joint, unnest(list_transform(range(1, len({v}) + 1), lambda i: abs({v}[i] - {p}[i]))) AS v FROM pp WHERE {v} IS NOT NULL AND {p} IS NOT NULL"
    sizes = "SELECT '{v}' AS field, unnest(range(len({v}))) AS joint, abs(unnest({v})) AS v FROM tr"
    return {
        "contract_violations": f"{contract} SELECT * FROM broken WHERE n > 0",
        "contract_verdicts": f"""{contract}, b AS (SELECT episode_id, count(*) FILTER (rule <> 'MEDIA_UNREFERENCED') AS e, count(*) AS k FROM broken WHERE n > 0 GROUP BY 1)
SELECT episode_id, CASE WHEN e > 0 THEN 'FAIL' WHEN k > 0 THEN 'WARN' ELSE 'PASS' END AS quality, coalesce(e, 0)::INT AS n_errors FROM (SELECT DISTINCT episode_id FROM o) LEFT JOIN b USING (episode_id)""",
        "velocity_summary": f"WITH {_VEL}, {_all_and_each('SELECT part, unnest(range(len(a))) AS joint, unnest(list_transform(range(1, len(a) + 1), lambda i: abs(a[i] - b[i]) / (dt / 1e9))) AS v FROM vk WHERE dt > 0 AND a IS NOT NULL AND b IS NOT NULL', 'part')}",
        "velocity_timing": f"WITH {_VEL} SELECT part, count(*) AS pairs, count(*) FILTER (dt <= 0) AS skipped FROM vk GROUP BY 1",
        "step_statistics": f"WITH {_PAIR}, {_all_and_each(steps.format(f='state', v='state', p='ps') + ' UNION ALL ' + steps.format(f='action', v='action', p='pa'), 'field')}",
        "vector_statistics": f"WITH {_ONE}, {_all_and_each(sizes.format(v='state') + ' UNION ALL ' + sizes.format(v='action'), 'field')}",
        "activity": f"""WITH {_ONE}, e AS (SELECT episode_id, 'state' AS f, unnest(range(len(state))) AS j, unnest(state) AS v FROM tr UNION ALL SELECT episode_id, 'action', unnest(range(len(action))), unnest(action) FROM tr),
g AS (SELECT episode_id, j, coalesce(max(v) FILTER (f = 'state') - min(v) FILTER (f = 'state') > 1e-6, false) AS s, coalesce(max(v) FILTER (f = 'action') - min(v) FILTER (f = 'action') > 1e-6, false) AS a FROM e WHERE episode_id IS NOT NULL AND j < 17 AND v IS NOT NULL AND isfinite(v) GROUP BY ALL),
p AS (SELECT episode_id, count(*) FILTER (s OR a) AS active, count(*) FILTER ((s OR a) AND j < 6) AS arm_active, count(*) FILTER ((s OR a) AND j >= 6) AS hand_active, count(*) FILTER (a AND j >= 6) AS hand_action_active,
  coalesce(sum((1::BIGINT << j::INT)) FILTER (s), 0)::BIGINT AS state_mask, coalesce(sum((1::BIGINT << j::INT)) FILTER (a), 0)::BIGINT AS action_mask FROM g GROUP BY 1)
SELECT *, CASE hand_action_active WHEN 0 THEN 'STATIC' WHEN 1 THEN 'SINGLE_JOINT' WHEN 11 THEN 'FULL_HAND' ELSE 'PARTIAL_HAND' END AS hand_action_activity, active = 0 AS static_episode, active = 1 AS single_active_joint,
  hand_active BETWEEN 1 AND 10 AS partial_hand, hand_active = 11 AS full_hand, arm_active > 0 AND hand_active = 11 AS full_arm_hand FROM p""",
        "durations": f"""WITH {MOVES}, s0 AS (SELECT episode_id, tick, greatest(arm_action_timestamp_ns, hand_action_timestamp_ns) AS a, CASE WHEN lag(next_tick) OVER w = tick THEN 0 ELSE 1 END AS b FROM moves WHERE episode_id IS NOT NULL WINDOW w AS (PARTITION BY episode_id ORDER BY tick)),
s1 AS (SELECT *, sum(b) OVER (PARTITION BY episode_id ORDER BY tick) AS seg FROM s0), e AS (SELECT episode_id, seg, arg_min_null(a, tick) AS f, arg_max_null(a, tick) AS l, min(a) AS lo, max(a) AS hi FROM s1 GROUP BY ALL)
SELECT episode_id, count(*) AS segments, coalesce(sum(l - f), 0)::BIGINT AS duration_ns, max(hi) - min(lo) AS span_ns FROM e GROUP BY 1""",
        "media_references": f"""WITH {MOVES}, r AS (SELECT episode_id, 'head' AS camera, head_rgb_frame_index AS f FROM moves UNION ALL SELECT episode_id, 'wrist', wrist_rgb_frame_index FROM moves)
SELECT camera, count(*) AS total, count(DISTINCT episode_id || '|' || f) AS distinct_images FROM r WHERE f >= 0 AND episode_id IS NOT NULL GROUP BY 1""",
        "channel_health": f"WITH {SAMPLES} SELECT episode_id, channel, count(*) AS total, count(*) FILTER (ts > 0) AS positive, count(*) FILTER (eligible) AS eligible, round(count(*) FILTER (ts > 0) / count(*), 6) AS positive_share, round(count(*) FILTER (eligible) / count(*), 6) AS eligible_share FROM samples WHERE episode_id IS NOT NULL GROUP BY 1, 2",
        "action_health": f"""WITH {_ONE}, p AS (SELECT episode_id, count(*) AS total, count(*) FILTER (t3 IS NOT NULL AND t4 IS NOT NULL) AS timed, count(*) FILTER (t3 > 0 AND t4 > 0) AS positive, count(*) FILTER (action IS NOT NULL) AS present,
  count(*) FILTER (action IS NOT NULL AND len(list_filter(action, lambda x: x IS NULL OR NOT isfinite(x))) = 0) AS finite FROM tr WHERE episode_id IS NOT NULL GROUP BY 1) SELECT *, round(timed / total, 6) AS timed_share, round(finite / total, 6) AS finite_share FROM p""",
        "image_changes": """WITH p AS (SELECT label, vec_id, list_transform(embedding, lambda x: (x::DOUBLE + 1) * 127.5) AS x FROM embeddings), q AS (SELECT label, x, lag(x) OVER (PARTITION BY label ORDER BY vec_id) AS y FROM p),
d AS (SELECT label, CASE WHEN y IS NOT NULL THEN list_sum(list_transform(range(1, 65), lambda i: abs(x[i] - y[i]))) / 64 END AS d FROM q) SELECT label, count(d) AS pairs, count(*) FILTER (d = 0) AS exact, count(*) FILTER (d <= 1) AS near_static, round(max(d), 6) AS largest FROM d GROUP BY 1""",
        "review_selection": f"""WITH {MOVES}, {MEDIA}, s0 AS (SELECT *, CASE WHEN lag(next_tick) OVER w = tick THEN 0 ELSE 1 END AS b FROM moves WHERE episode_id IS NOT NULL WINDOW w AS (PARTITION BY episode_id ORDER BY tick)),
s1 AS (SELECT *, (sum(b) OVER (PARTITION BY episode_id ORDER BY tick) - 1)::BIGINT AS segment FROM s0)
SELECT s.episode_id, s.tick AS row, segment, head_rgb_frame_index AS frame_index FROM s1 s WHERE (head_timestamp_ns IS NULL OR wrist_timestamp_ns IS NULL) AND EXISTS (SELECT 1 FROM media m WHERE m.role = 'head' AND m.episode_id = s.episode_id AND m.frame_index = s.head_rgb_frame_index)""",
        "health_percentiles": f"WITH {conf}, p AS (SELECT unnest([0, 10, 25, 50, 75, 90, 95, 100]) AS percentile) SELECT percentile, round((SELECT quantile_cont(c, [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]) FROM conf)[list_position([0, 10, 25, 50, 75, 90, 95, 100], percentile)], 6) AS value, round((SELECT avg(c) FROM conf), 6) AS mean FROM p",
        "health_workload": f"WITH {conf} SELECT t AS threshold, count(*) FILTER (c < t) AS n FROM conf, (VALUES (0.7::DOUBLE), (0.8::DOUBLE), (0.9::DOUBLE), (0.95::DOUBLE)) v(t) GROUP BY 1",
        "health_review": f"""WITH {conf}, r AS (SELECT id, row_number() OVER (ORDER BY sha256('7:' || id), id) AS k, count(*) OVER () AS n FROM conf WHERE c >= 0.9 AND NOT f)
SELECT id, 'LOW_CONFIDENCE' AS why FROM conf WHERE c < 0.9 UNION ALL SELECT id, 'QUALITY_WARNING' FROM conf WHERE c >= 0.9 AND f UNION ALL SELECT id, 'RANDOM' FROM r WHERE k <= floor(n * 0.1)""",
        "size_mode": f"""WITH {_FILES}, c AS (SELECT episode, camera, n_bytes, count(*) AS n FROM files WHERE episode IS NOT NULL AND camera IS NOT NULL AND n_bytes IS NOT NULL GROUP BY ALL)
SELECT episode, camera, n_bytes, n FROM c QUALIFY row_number() OVER (PARTITION BY episode, camera ORDER BY n DESC, n_bytes) = 1""",
        "longest_flagged": f"""WITH {TICKS}, f AS (SELECT episode_id, tick, coalesce(wrist_valid, false) AS f FROM ticks WHERE episode_id IS NOT NULL),
g AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY tick) - row_number() OVER (PARTITION BY episode_id, f ORDER BY tick) AS grp FROM f), r AS (SELECT episode_id, f, count(*) AS n FROM g GROUP BY episode_id, f, grp)
SELECT episode_id, 1 + coalesce(max(n) FILTER (f), 0) AS longest FROM r GROUP BY 1""",
        "homogeneity": f"WITH {TICKS} SELECT episode_id, count(DISTINCT rig_id) AS rigs, min(rig_id) AS rig_id, count(DISTINCT rig_id) = 1 AS single FROM ticks WHERE episode_id IS NOT NULL AND rig_id IS NOT NULL GROUP BY 1",
        "rgb_metrics": """WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: (x::DOUBLE + 1) * 127.5) AS p FROM embeddings), l AS (SELECT vec_id, list_transform(range(21), lambda i: p[3 * i + 1] * 0.2126 + p[3 * i + 2] * 0.7152 + p[3 * i + 3] * 0.0722) AS lum FROM p)
SELECT vec_id, round(list_avg(lum), 6) AS mean_luminance, round(list_stddev_pop(lum), 6) AS luminance_std, round(len(list_filter(lum, lambda x: x <= 16)) / 21.0, 6) AS dark, round(len(list_filter(lum, lambda x: x >= 240)) / 21.0, 6) AS bright FROM l""",
        "even_rounded": f"""WITH {MOVES}, p AS (SELECT episode_id, tick, row_number() OVER (PARTITION BY episode_id ORDER BY tick) - 1 AS i, count(*) OVER (PARTITION BY episode_id) AS n FROM moves WHERE episode_id IS NOT NULL),
k AS (SELECT DISTINCT episode_id, unnest(list_transform(range(20), lambda k: round_even(k * (n - 1) / 19.0, 0)::BIGINT)) AS i FROM (SELECT DISTINCT episode_id, n FROM p WHERE n > 20))
SELECT episode_id, tick FROM p WHERE n <= 20 UNION SELECT p.episode_id, p.tick FROM p JOIN k USING (episode_id, i)""",
    }
