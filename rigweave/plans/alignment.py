"""Alignment of channels: as-of joins, gates, rejections and clean runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rigweave.functions.arrays import all_finite
from rigweave.operators.asof import strict_asof
from rigweave.operators.causal import curated, synchronize
from rigweave.operators.intervals import classify_points, origin
from rigweave.operators.reasons import component_mismatch, group_counts, reason_counts
from rigweave.operators.sequence import islands, neighbour, row_index
from rigweave.operators.stats import zero_filled
from rigweave.plans.base import INTERVENTIONS, MEDIA, MOVES, SAMPLES, TICKS, VECTORS, interventions, media, moves, readings, table, ticks
from rigweave.session import settle

GROUPS = ["ACTION", "FEEDBACK", "CAUSALITY", "CAMERA", "INTERVENTION"]


def _action(spark: SparkSession, folder: str) -> DataFrame:
    return moves(spark, folder).select("transition_id", "episode_id", F.least("arm_action_timestamp_ns", "hand_action_timestamp_ns").alias("start_ns"), F.greatest("arm_action_timestamp_ns", "hand_action_timestamp_ns").alias("end_ns"))


def _by_channel(spark: SparkSession, folder: str, channels: list[str], bound: str, after: bool) -> DataFrame:
    """As-of for every transition and channel; the entity is the channel of the episode."""
    entity = F.concat_ws("|", "channel", "episode_id")
    asked = _action(spark, folder).select(F.col("transition_id").alias("boundary_id"), "episode_id", F.col(bound).alias("ts"), F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel"))
    asked = asked.select("boundary_id", F.when(F.col("episode_id").isNotNull(), entity).alias("entity"), "ts")
    have = readings(spark, folder).where(F.col("channel").isin(channels) & F.col("episode_id").isNotNull()).select(entity.alias("entity"), "ts", F.col("sample_id").alias("row"), "eligible", F.col("frame_index").alias("payload"))
    found = strict_asof(asked, have, after)
    return found.select(F.col("boundary_id").alias("transition_id"), F.substring_index("entity", "|", 1).alias("channel"), "ts", F.col("pick_row").alias("sample_id"), "pick_ts", F.col("payload").alias("frame_index"), "any_positive")


def asof_pre(spark: SparkSession, folder: str) -> DataFrame:
    """Latest eligible arm and hand sample strictly before the action."""
    return _by_channel(spark, folder, ["arm", "hand"], "start_ns", False).select("transition_id", "channel", "sample_id", "pick_ts")


def asof_post(spark: SparkSession, folder: str) -> DataFrame:
    """Earliest eligible arm and hand sample strictly after the action."""
    return _by_channel(spark, folder, ["arm", "hand"], "end_ns", True).select("transition_id", "channel", "sample_id", "pick_ts")


def _state() -> Column:
    return F.when(~F.col("any_positive"), "UNAVAILABLE").when(F.col("sample_id").isNull(), "INVALID").otherwise("OK")


def availability_class(spark: SparkSession, folder: str) -> DataFrame:
    """Why a side has no sample: nothing there, or nothing eligible."""
    pre = _by_channel(spark, folder, ["arm", "hand"], "start_ns", False).select("channel", F.lit("PRE").alias("side"), _state().alias("state"))
    post = _by_channel(spark, folder, ["arm", "hand"], "end_ns", True).select("channel", F.lit("POST").alias("side"), _state().alias("state"))
    return pre.unionByName(post).groupBy("channel", "side", "state").agg(F.count(F.lit(1)).alias("n"))


def camera_asof_media(spark: SparkSession, folder: str) -> DataFrame:
    """The last frame before each action and whether its image is stored; no older frame stands in."""
    found = _by_channel(spark, folder, ["head", "wrist"], "start_ns", False).join(moves(spark, folder).select("transition_id", "episode_id"), "transition_id")
    stored = media(spark, folder).withColumnRenamed("role", "channel").withColumn("there", F.lit(True))
    met = found.join(stored, ["episode_id", "channel", "frame_index"], "left")
    state = F.when(F.col("sample_id").isNull(), "UNAVAILABLE").when(F.col("there").isNull(), "MEDIA_MISSING").otherwise("OK")
    return met.select("transition_id", "channel", "sample_id", state.alias("state"))


_B = """acts AS (SELECT transition_id, episode_id, least(arm_action_timestamp_ns, hand_action_timestamp_ns) AS start_ns, greatest(arm_action_timestamp_ns, hand_action_timestamp_ns) AS end_ns FROM moves),
good_last AS (SELECT episode_id, channel, ts, max(sample_id) AS sample_id, arg_max(frame_index, sample_id) AS frame_index FROM samples WHERE eligible AND ts IS NOT NULL GROUP BY ALL),
good_first AS (SELECT episode_id, channel, ts, min(sample_id) AS sample_id FROM samples WHERE eligible AND ts IS NOT NULL GROUP BY ALL),
bounds AS (SELECT episode_id, channel, min(CASE WHEN ts > 0 THEN ts END) AS lo, max(ts) AS hi FROM samples GROUP BY ALL),
wanted AS (SELECT a.*, c.channel FROM acts a CROSS JOIN (VALUES ('arm'), ('hand'), ('head'), ('wrist')) c(channel) WHERE start_ns IS NOT NULL),
pre AS (SELECT w.*, g.sample_id, g.ts AS pick_ts, g.frame_index FROM wanted w ASOF LEFT JOIN good_last g ON w.episode_id = g.episode_id AND w.channel = g.channel AND w.start_ns > g.ts),
post AS (SELECT w.*, g.sample_id, g.ts AS pick_ts FROM wanted w ASOF LEFT JOIN good_first g ON w.episode_id = g.episode_id AND w.channel = g.channel AND w.end_ns < g.ts)"""
_WITH = f"WITH {MOVES}, {SAMPLES}, {_B}"


def _synchronized(spark: SparkSession, folder: str) -> DataFrame:
    """The test tables as `synchronize` reads them. Their recordings bear no command flags; a missing time or vector stands for a false one."""
    rows = settle(ticks(spark, folder).where("episode_id is not null").select("episode_id", "tick", "ts_ns", "head_valid"), "ticks")
    holes = settle(interventions(spark, folder, rows), "interventions")
    # the vector is judged at the scan; only flags of it travel on
    vector = F.col("action17")
    acts = table(spark, folder, "transitions").select(
        "episode_id", F.col("source_tick_index").alias("tick"), F.col("transition_id").alias("action_id"), F.col("arm_action_timestamp_ns").alias("arm_ns"), F.col("hand_action_timestamp_ns").alias("hand_ns"),
        F.col("arm_action_timestamp_ns").isNotNull().alias("arm_ok"), F.col("hand_action_timestamp_ns").isNotNull().alias("hand_ok"), vector.isNotNull().alias("whole_ok"), all_finite(vector).alias("finite"),
        component_mismatch(F.slice(vector, 1, 6), F.slice(vector, 7, 11), vector).alias("mismatch")).distinct()
    have = readings(spark, folder).select("episode_id", "channel", "ts", F.col("sample_id").alias("row"), "eligible", "frame_index")
    stored = media(spark, folder).select("episode_id", F.col("role").alias("channel"), "frame_index", F.lit(None).cast("boolean").alias("decodable"))
    return synchronize(rows.select("episode_id", "tick", "ts_ns"), holes, acts, have, stored)


def sync_transitions(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate (a tick and the next one of its episode) with the reasons that reject it, none if accepted."""
    return _synchronized(spark, folder).select("episode_id", "tick", "reasons")


def curated_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The accepted transitions with the times and frames of their evidence and the lags between them."""
    return curated(_synchronized(spark, folder)).drop("start_ns", "arm_row", "hand_row", "head_ns", "wrist_ns")


_SYNC = f"""{_WITH}, {TICKS}, {INTERVENTIONS}, {MEDIA}, {VECTORS},
dom AS (SELECT t.episode_id, t.tick, t.ts_ns, CASE WHEN count(CASE WHEN t.ts_ns BETWEEN i.start_ns AND i.end_ns THEN 1 END) = 0 THEN count(CASE WHEN i.end_ns < t.ts_ns THEN 1 END) END AS here
  FROM ticks t LEFT JOIN interventions i ON t.episode_id = i.episode_id WHERE t.episode_id IS NOT NULL GROUP BY t.tick_id, t.episode_id, t.tick, t.ts_ns),
pairs AS (SELECT *, lead(tick) OVER w AS next_row, lead(here) OVER w AS next_here FROM dom WINDOW w AS (PARTITION BY episode_id ORDER BY tick)),
cand AS (SELECT p.episode_id, p.tick, p.here, p.next_here, v.transition_id, m.arm_action_timestamp_ns AS arm_ns, m.hand_action_timestamp_ns AS hand_ns, v.action,
  least(m.arm_action_timestamp_ns, m.hand_action_timestamp_ns) AS start_ns, greatest(m.arm_action_timestamp_ns, m.hand_action_timestamp_ns) AS end_ns
  FROM pairs p LEFT JOIN vectors v ON p.episode_id = v.episode_id AND p.tick = v.tick LEFT JOIN moves m ON v.transition_id = m.transition_id WHERE next_row IS NOT NULL),
g AS (SELECT *, CASE WHEN here IS NULL OR next_here IS NULL OR here <> next_here THEN ['INTERVENTION_CONTAMINATED'] ELSE list_filter([
  CASE WHEN arm_ns IS NULL THEN 'ACTION_ARM_COMMAND_FLAG_INVALID' END, CASE WHEN hand_ns IS NULL THEN 'ACTION_HAND_COMMAND_FLAG_INVALID' END,
  CASE WHEN len(list_filter(action, lambda x: x IS NULL OR NOT isfinite(x))) > 0 THEN 'ACTION_NONFINITE' END,
  CASE WHEN action IS NULL THEN 'ACTION_ROBOT_COMMAND_FLAG_INVALID' END, CASE WHEN arm_ns <= 0 OR hand_ns <= 0 THEN 'ACTION_TIMESTAMP_NONPOSITIVE' END], lambda x: x IS NOT NULL) END AS first FROM cand),
ready AS (SELECT * FROM g WHERE len(first) = 0),
ev AS (SELECT r.transition_id, r.episode_id, r.here, r.start_ns, r.end_ns, upper(p.channel) || CASE WHEN p.channel IN ('arm', 'hand') THEN '_PRE' ELSE '_CAMERA' END AS part, p.channel, p.sample_id, p.pick_ts, p.frame_index,
    coalesce(b.lo < r.start_ns, false) AS pos FROM ready r JOIN pre p USING (transition_id) LEFT JOIN bounds b ON b.episode_id = r.episode_id AND b.channel = p.channel
  UNION ALL SELECT r.transition_id, r.episode_id, r.here, r.start_ns, r.end_ns, upper(p.channel) || '_POST', p.channel, p.sample_id, p.pick_ts, NULL, coalesce(b.hi > greatest(r.end_ns, 0), false)
    FROM ready r JOIN post p USING (transition_id) LEFT JOIN bounds b ON b.episode_id = r.episode_id AND b.channel = p.channel WHERE p.channel IN ('arm', 'hand')
  UNION ALL SELECT transition_id, episode_id, here, start_ns, end_ns, 'START', NULL, NULL, start_ns, NULL, true FROM ready UNION ALL SELECT transition_id, episode_id, here, start_ns, end_ns, 'END', NULL, NULL, end_ns, NULL, true FROM ready),
ev2 AS (SELECT e.*, m.role IS NOT NULL AS stored, CASE WHEN (SELECT count(*) FROM interventions i WHERE i.episode_id = e.episode_id AND coalesce(e.pick_ts, -1) BETWEEN i.start_ns AND i.end_ns) = 0
    THEN (SELECT count(*) FROM interventions i WHERE i.episode_id = e.episode_id AND i.end_ns < coalesce(e.pick_ts, -1)) END AS at_dom
  FROM ev e LEFT JOIN media m ON e.part LIKE '%_CAMERA' AND m.episode_id = e.episode_id AND m.role = e.channel AND m.frame_index = e.frame_index),
coded AS (SELECT *, CASE WHEN part IN ('START', 'END') THEN NULL WHEN part LIKE '%_CAMERA' THEN CASE WHEN sample_id IS NULL THEN 'CAMERA_' || part || '_UNAVAILABLE' WHEN NOT stored THEN 'CAMERA_' || part || '_MEDIA_MISSING' END
  WHEN NOT pos THEN 'CAUSALITY_' || part || '_UNAVAILABLE' WHEN sample_id IS NULL THEN 'FEEDBACK_' || part || '_INVALID' END AS code, coalesce(at_dom <> here, true) AS off FROM ev2),
jud AS (SELECT transition_id, max(part IN ('START', 'END') AND off) AS action_off, list_sort(coalesce(list(code) FILTER (code IS NOT NULL), [])) AS missing, max(part NOT IN ('START', 'END') AND off) AS evidence_off FROM coded GROUP BY 1),
sync AS (SELECT g.episode_id, g.tick, CASE WHEN len(first) > 0 THEN first WHEN action_off THEN ['INTERVENTION_CONTAMINATED'] WHEN len(missing) > 0 THEN missing WHEN evidence_off THEN ['INTERVENTION_CONTAMINATED'] ELSE [] END AS reasons
  FROM g LEFT JOIN jud USING (transition_id))"""


def rejection_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reason_counts(sync_transitions(spark, folder))


def rejection_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected candidates per group, 0 where none."""
    return zero_filled(group_counts(sync_transitions(spark, folder)), "reason_group", "n", GROUPS)


def primary_reason(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: the one other reason that blocked every candidate with a sound action if none was accepted, else the most frequent, ties by name."""
    rows = settle(sync_transitions(spark, folder), "sync")
    per = rows.groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(F.size("reasons") == 0).alias("accepted"), F.count_if(F.exists("reasons", lambda r: r.startswith("ACTION_"))).alias("bad_action"))
    counts = rows.select("episode_id", F.explode("reasons").alias("reason")).groupBy("episode_id", "reason").agg(F.count(F.lit(1)).alias("n"))
    joined = counts.join(per, "episode_id")
    ready = F.col("candidates") - F.col("bad_action")
    blocks = (F.col("accepted") == 0) & (ready > 0) & (F.col("n") == ready) & ~F.col("reason").startswith("ACTION_")
    best = joined.groupBy("episode_id").agg(
        F.count_if(blocks).alias("n_block"), F.min(F.when(blocks, F.col("reason"))).alias("blocker"), F.min(F.struct((-F.col("n")).alias("o"), "reason")).alias("top"))
    return best.select("episode_id", F.when(F.col("n_block") == 1, F.col("blocker")).otherwise(F.col("top.reason")).alias("reason"))


def first_mid_last(spark: SparkSession, folder: str) -> DataFrame:
    """The first, middle and last rejected candidate of each episode."""
    rejected = settle(sync_transitions(spark, folder).where(F.size("reasons") > 0).select("episode_id", "tick"), "rejected")
    placed = row_index(rejected, "episode_id", "tick", "i")
    sizes = rejected.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))
    at = placed.join(sizes, "episode_id")
    position = F.when(F.col("i") == F.col("n") - 1, "last").when(F.col("i") == F.floor(F.col("n") / 2), "middle").when(F.col("i") == 0, "first")
    return at.select("episode_id", "tick", position.alias("position")).where("position is not null")


def intervention_domain(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks of each episode by clean domain; null counts the ticks inside an intervention."""
    rows = ticks(spark, folder).where("episode_id is not null").select("episode_id", "ts_ns")
    return classify_points(rows, interventions(spark, folder), "episode_id", "ts_ns").groupBy("episode_id", "domain").agg(F.count(F.lit(1)).alias("n"))


def runs_by_origin(spark: SparkSession, folder: str) -> DataFrame:
    """Clean runs of accepted candidates by where they lie among the interventions."""
    good = settle(sync_transitions(spark, folder).where(F.size("reasons") == 0).select("episode_id", "tick"), "accepted")
    runs = islands(good, "episode_id", "tick", F.col("tick") != F.col("_t") + 1, "segment", {"_t": "tick"})
    ends = runs.groupBy("episode_id", "segment").agg(F.min("tick").alias("tick"), F.count(F.lit(1)).alias("rows"))
    at = settle(ends.join(ticks(spark, folder).select("episode_id", "tick", "ts_ns"), ["episode_id", "tick"]), "runs")
    holes = settle(interventions(spark, folder), "interventions")
    number = holes.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n_holes"))
    placed = classify_points(at, holes, "episode_id", "ts_ns").join(number, "episode_id", "left")
    kind = origin(F.col("domain"), F.coalesce("n_holes", F.lit(0)))
    return placed.groupBy(kind.alias("origin")).agg(F.count(F.lit(1)).alias("runs"), F.sum("rows").alias("rows"))


def queries() -> dict:
    return {f.__name__: f for f in (asof_pre, asof_post, availability_class, camera_asof_media, sync_transitions, curated_rows, rejection_counts, rejection_groups, primary_reason, first_mid_last, intervention_domain, runs_by_origin)}


def oracle_sql() -> dict[str, str]:
    state = "CASE WHEN NOT pos THEN 'UNAVAILABLE' WHEN sample_id IS NULL THEN 'INVALID' ELSE 'OK' END"
    return {
        "asof_pre": f"{_WITH} SELECT transition_id, channel, sample_id, pick_ts FROM pre WHERE channel IN ('arm', 'hand') AND episode_id IS NOT NULL",
        "asof_post": f"{_WITH} SELECT transition_id, channel, sample_id, pick_ts FROM post WHERE channel IN ('arm', 'hand') AND episode_id IS NOT NULL",
        "availability_class": f"""{_WITH}, x AS (
  SELECT p.channel, 'PRE' AS side, sample_id, coalesce(b.lo < start_ns, false) AS pos FROM pre p LEFT JOIN bounds b ON p.episode_id = b.episode_id AND p.channel = b.channel WHERE p.channel IN ('arm', 'hand') AND p.episode_id IS NOT NULL
  UNION ALL SELECT p.channel, 'POST', sample_id, coalesce(b.hi > greatest(end_ns, 0), false) FROM post p LEFT JOIN bounds b ON p.episode_id = b.episode_id AND p.channel = b.channel WHERE p.channel IN ('arm', 'hand') AND p.episode_id IS NOT NULL)
SELECT channel, side, {state} AS state, count(*) AS n FROM x GROUP BY ALL""",
        "camera_asof_media": f"""{_WITH}, {MEDIA} SELECT transition_id, p.channel, sample_id, CASE WHEN sample_id IS NULL THEN 'UNAVAILABLE' WHEN m.role IS NULL THEN 'MEDIA_MISSING' ELSE 'OK' END AS state
FROM pre p LEFT JOIN media m ON p.episode_id = m.episode_id AND p.channel = m.role AND p.frame_index = m.frame_index WHERE p.channel IN ('head', 'wrist') AND p.episode_id IS NOT NULL""",
        "sync_transitions": f"{_SYNC} SELECT episode_id, tick, reasons FROM sync",
        "curated_rows": f"""{_SYNC}, ok AS (SELECT g.* FROM g JOIN sync s ON g.episode_id = s.episode_id AND g.tick = s.tick WHERE len(s.reasons) = 0),
e AS (SELECT transition_id, max(CASE WHEN channel = 'arm' THEN pick_ts END) AS arm, max(CASE WHEN channel = 'hand' THEN pick_ts END) AS hand, max(CASE WHEN channel = 'head' THEN pick_ts END) AS head, max(CASE WHEN channel = 'wrist' THEN pick_ts END) AS wrist,
  max(CASE WHEN channel = 'head' THEN frame_index END) AS head_frame, max(CASE WHEN channel = 'wrist' THEN frame_index END) AS wrist_frame FROM pre GROUP BY 1),
f AS (SELECT transition_id, min(pick_ts) AS next_ts FROM post WHERE channel IN ('arm', 'hand') GROUP BY 1),
nx AS (SELECT episode_id, tick, next_row FROM pairs)
SELECT ok.episode_id, ok.tick AS source_tick_index, nx.next_row AS next_state_tick_index, ok.transition_id AS action_id, greatest(arm, hand) AS state_timestamp_ns, end_ns AS action_timestamp_ns, next_ts AS next_state_timestamp_ns,
  arm AS arm_qpos_source_timestamp_ns, hand AS hand_qpos_source_timestamp_ns, head_frame AS head_rgb_frame_index, wrist_frame AS right_wrist_rgb_frame_index, abs(arm - hand) AS state_component_skew_ns, end_ns - start_ns AS action_component_skew_ns,
  start_ns - arm AS arm_state_age_at_action_ns, start_ns - hand AS hand_state_age_at_action_ns, start_ns - head AS head_frame_age_at_action_ns, start_ns - wrist AS wrist_frame_age_at_action_ns, abs(head - wrist) AS head_wrist_frame_skew_ns,
  next_ts - greatest(arm, hand) AS state_to_next_state_ns
FROM ok JOIN e USING (transition_id) JOIN f USING (transition_id) JOIN nx ON nx.episode_id = ok.episode_id AND nx.tick = ok.tick""",
        "rejection_counts": f"{_SYNC} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM sync) GROUP BY 1",
        "rejection_groups": f"""{_SYNC}, x AS (SELECT DISTINCT episode_id, tick, split_part(reason, '_', 1) AS g FROM (SELECT episode_id, tick, unnest(reasons) AS reason FROM sync))
SELECT v.g AS reason_group, count(x.g) AS n FROM (VALUES ('ACTION'), ('FEEDBACK'), ('CAUSALITY'), ('CAMERA'), ('INTERVENTION')) v(g) LEFT JOIN x USING (g) GROUP BY 1""",
        "primary_reason": f"""{_SYNC}, per AS (SELECT episode_id, count(*) AS candidates, count(*) FILTER (len(reasons) = 0) AS accepted, count(*) FILTER (len(list_filter(reasons, lambda r: starts_with(r, 'ACTION_'))) > 0) AS bad FROM sync GROUP BY 1),
c AS (SELECT episode_id, reason, count(*) AS n FROM (SELECT episode_id, unnest(reasons) AS reason FROM sync) GROUP BY ALL),
j AS (SELECT *, accepted = 0 AND candidates - bad > 0 AND n = candidates - bad AND NOT starts_with(reason, 'ACTION_') AS blocks FROM c JOIN per USING (episode_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY n DESC, reason) AS k, sum(blocks::INT) OVER (PARTITION BY episode_id) AS nb FROM j)
SELECT episode_id, coalesce(max(CASE WHEN nb = 1 AND blocks THEN reason END), max(CASE WHEN k = 1 THEN reason END)) AS reason FROM r GROUP BY 1""",
        "first_mid_last": f"""{_SYNC}, r AS (SELECT episode_id, tick, row_number() OVER (PARTITION BY episode_id ORDER BY tick) - 1 AS i, count(*) OVER (PARTITION BY episode_id) AS n FROM sync WHERE len(reasons) > 0)
SELECT episode_id, tick, CASE WHEN i = n - 1 THEN 'last' WHEN i = n // 2 THEN 'middle' ELSE 'first' END AS position FROM r WHERE i IN (0, n // 2, n - 1)""",
        "intervention_domain": f"""WITH {TICKS}, {INTERVENTIONS}, d AS (SELECT t.tick_id, t.episode_id, CASE WHEN count(CASE WHEN t.ts_ns BETWEEN i.start_ns AND i.end_ns THEN 1 END) = 0 THEN count(CASE WHEN i.end_ns < t.ts_ns THEN 1 END) END AS domain
  FROM ticks t LEFT JOIN interventions i ON t.episode_id = i.episode_id WHERE t.episode_id IS NOT NULL GROUP BY ALL)
SELECT episode_id, domain, count(*) AS n FROM d GROUP BY ALL""",
        "runs_by_origin": f"""{_SYNC}, ok AS (SELECT episode_id, tick, tick - row_number() OVER (PARTITION BY episode_id ORDER BY tick) AS grp FROM sync WHERE len(reasons) = 0),
e AS (SELECT episode_id, min(tick) AS tick, count(*) AS rows FROM ok GROUP BY episode_id, grp),
o AS (SELECT e.rows, d.here, (SELECT count(*) FROM interventions i WHERE i.episode_id = e.episode_id) AS k FROM e JOIN dom d ON e.episode_id = d.episode_id AND e.tick = d.tick)
SELECT CASE WHEN k = 0 THEN 'full_clean' WHEN here = 0 THEN 'pre_intervention' WHEN here = k THEN 'post_intervention' ELSE 'between_interventions' END AS origin, count(*) AS runs, sum(rows)::BIGINT AS rows FROM o GROUP BY 1""",
    }
