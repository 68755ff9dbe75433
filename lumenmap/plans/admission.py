"""Queries of session admission: events and users stand in for pairs, edges and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import admission as M
from .registry import query, table


def _events(spark: SparkSession, d: str, **columns) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", *[F.expr(e).alias(c) for c, e in columns.items()])


_PAIR = """SELECT event_id, CASE WHEN event_id % 9 > 0 THEN event_id % 8 END AS config, CASE WHEN event_id % 4 > 0 THEN (user_id % 10) / 10.0::DOUBLE END AS h, (event_id % 7) / 10.0::DOUBLE AS e,
  CASE WHEN event_id % 3 = 0 THEN (event_id % 30)::DOUBLE END AS rot, CASE WHEN event_id % 5 = 0 THEN (event_id % 10) / 20.0::DOUBLE END AS tr FROM events"""


@query(f"""SELECT event_id, config IN (4, 5, 6) IS TRUE OR (h >= 0.6 AND e <= 0.3) IS TRUE AS planar, (config = 1) IS TRUE AS degenerate, (rot > 15) IS TRUE OR (tr > 0.35) IS TRUE AS pose_bad,
  config IS NOT NULL OR (h IS NOT NULL AND e IS NOT NULL) AS has_model, rot IS NOT NULL OR tr IS NOT NULL AS has_pose FROM ({_PAIR})""")
def pair_model_flags(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, config="if(event_id % 9 > 0, event_id % 8, null)", h="if(event_id % 4 > 0, (user_id % 10) / 10, null)", e="(event_id % 7) / 10", rot="if(event_id % 3 = 0, double(event_id % 30), null)", tr="if(event_id % 5 = 0, (event_id % 10) / 20, null)")
    return e.select("event_id", M.pair_flags("config", "h", "e", "rot", "tr").alias("f")).select("event_id", "f.*")


_VERIFIED = """SELECT event_id, event_id % 60 AS n, user_id % 40 AS fi, event_id % 37 AS hi, (event_id % 11) / 20.0::DOUBLE AS fr, (user_id % 13) / 20.0::DOUBLE AS hr, event_id % 2 = 0 AS pl, user_id % 3 = 0 AS same, event_id % 5 < 2 AS cd FROM events"""


@query(f"""SELECT event_id, reason IN ('same_video_fundamental', 'same_video_rotation_bridge', 'cross_direction_fundamental', 'cross_direction_planar_consistent', 'cross_video_fundamental', 'cross_video_planar_consistent') AS keep, reason FROM (SELECT event_id,
  CASE WHEN n < 20 THEN 'too_few_sampled_matches' WHEN same THEN CASE WHEN fi >= 15 AND fr >= 0.25 THEN 'same_video_fundamental' WHEN hi >= 15 AND hr >= 0.25 THEN 'same_video_rotation_bridge' ELSE 'same_video_geometry_failed' END
  WHEN cd THEN CASE WHEN fi >= 15 AND fr >= 0.25 THEN 'cross_direction_fundamental' WHEN hi >= 15 AND hr >= 0.25 AND pl THEN 'cross_direction_planar_consistent' WHEN hi >= 15 AND hi >= 1.2 * greatest(1, fi) THEN 'cross_direction_rotation_like' ELSE 'cross_direction_geometry_failed' END
  WHEN fi >= 15 AND fr >= 0.25 THEN 'cross_video_fundamental' WHEN hi >= 15 AND hr >= 0.25 AND pl THEN 'cross_video_planar_consistent' ELSE 'cross_video_geometry_failed' END AS reason FROM ({_VERIFIED}))""")
def verified_pairs(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, n="event_id % 60", fi="user_id % 40", hi="event_id % 37", fr="(event_id % 11) / 20", hr="(user_id % 13) / 20", pl="event_id % 2 = 0", same="user_id % 3 = 0", cd="event_id % 5 < 2")
    return e.select("event_id", M.verified_pair("n", "fi", "hi", "fr", "hr", "pl", "same", "cd").alias("v")).select("event_id", "v.*")


_ROLES = "['BASE_CORE', 'BASE_SUPPORT', 'GEOMETRY_REINFORCEMENT', 'UPDATE_CANDIDATE', 'APPEARANCE_REF', 'NEW_SUBMAP', 'VALIDATION_ONLY', 'QUARANTINE']"


@query(f"""WITH s AS (SELECT DISTINCT user_id AS session, {_ROLES}[user_id % 8 + 1] AS role, user_id % 3 = 0 AS left_out FROM events),
  g AS (SELECT user_id AS session, min(event_id) AS grant_edge, arg_min(event_id % 4, event_id) AS gr, arg_min(event_id % 3 > 0, event_id) AS ge, arg_min(event_id % 5 > 0, event_id) AS dj FROM events WHERE event_type = 'purchase' GROUP BY 1)
  SELECT s.*, grant_edge, CASE role WHEN 'BASE_CORE' THEN CASE WHEN grant_edge IS NULL THEN 'GLOBAL_BA_PENDING_APPROVAL' ELSE 'GLOBAL_BA' END WHEN 'BASE_SUPPORT' THEN CASE WHEN grant_edge IS NULL THEN 'LOCAL_RELATION_ONLY' ELSE 'GLOBAL_BA' END
    WHEN 'GEOMETRY_REINFORCEMENT' THEN CASE WHEN dj AND gr >= 2 AND ge THEN 'LOCAL_FUSION' ELSE 'LOCAL_RELATION_ONLY' END WHEN 'UPDATE_CANDIDATE' THEN CASE WHEN left_out THEN 'LOCAL_FUSION' ELSE 'LOCAL_FUSION_PENDING_LOO' END
    WHEN 'APPEARANCE_REF' THEN 'LOCALIZATION_ONLY' WHEN 'NEW_SUBMAP' THEN 'SUBMAP_ONLY' WHEN 'VALIDATION_ONLY' THEN 'EVALUATION_ONLY' ELSE 'NONE' END AS "authorization" FROM s LEFT JOIN g USING (session)""")
def incident_authorization(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, session="user_id", edge="event_id", authorized="event_type = 'purchase'", independent_bridge_groups="event_id % 4", geometry_complete="event_id % 3 > 0", disjoint="event_id % 5 > 0")
    s = e.select("session").distinct().select("session", F.expr(f"array{_ROLES.replace('[', '(').replace(']', ')')}[int(session % 8)]").alias("role"), (F.col("session") % 3 == 0).alias("left_out"))
    return M.incident_authorization(s, e.select("session", "edge", "authorized", "independent_bridge_groups", "geometry_complete", "disjoint"))


_SCOPE_WORDS = "['exact-pair', ' Shared', 'tracks', 'retrieval', 'other', '', 'exact_pair']"


@query(f"""WITH e AS (SELECT event_id, lower(trim({_SCOPE_WORDS}[event_id % 7 + 1])) AS w, event_id % 2 = 0 AS ind, user_id % 4 = 0 AS shared, CASE user_id % 5 WHEN 0 THEN 'vpr' WHEN 1 THEN 'map' WHEN 2 THEN '' END AS src FROM events),
  n AS (SELECT *, CASE w WHEN '' THEN 'unknown' WHEN 'exact-pair' THEN 'exact_pair' WHEN 'shared' THEN 'shared_map' WHEN 'tracks' THEN 'raw_tracks' WHEN 'retrieval' THEN 'vpr' ELSE w END AS sc, coalesce(src, '') AS o FROM e)
  SELECT event_id, CASE WHEN (shared OR o IN ('vpr', 'map')) AND sc = 'exact_pair' AND NOT ind THEN CASE WHEN o = 'vpr' THEN 'vpr' ELSE 'shared_map' END
    WHEN (shared OR o IN ('vpr', 'map')) AND sc IN ('shared_map', 'vpr', 'raw_tracks', 'unknown') THEN CASE WHEN o = 'vpr' OR sc = 'vpr' THEN 'vpr' ELSE 'shared_map' END WHEN sc = 'exact_pair' AND NOT ind THEN 'unknown' ELSE sc END AS scope FROM n""")
def evidence_scopes(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, w=f"array{_SCOPE_WORDS.replace('[', '(').replace(']', ')')}[int(event_id % 7)]", ind="event_id % 2 = 0", shared="user_id % 4 = 0", src="case user_id % 5 when 0 then 'vpr' when 1 then 'map' when 2 then '' end")
    return e.select("event_id", M.evidence_scope("w", independent="ind", shared="shared", source="src").alias("scope"))


_STATUS = "['STRONG', 'USABLE', 'WEAK', 'REJECT', 'USABLE']"
_SESSIONS_SQL = f"""SELECT DISTINCT user_id AS session, {_STATUS}[user_id % 5 + 1] AS status, CASE WHEN user_id % 6 > 0 THEN (user_id % 4) * 10.0::DOUBLE END AS sharp, CASE WHEN user_id % 7 > 0 THEN user_id % 3 END AS strong, user_id % 5 AS queries,
  CASE WHEN user_id % 4 > 0 THEN (user_id % 3) / 2.0::DOUBLE END AS hits, (user_id % 8) / 10.0::DOUBLE - 0.4 AS change, user_id % 11 = 0 AS influential, user_id % 6 = 1 AS improves, user_id % 13 = 2 AS different FROM events"""
_EDGES_SQL = "SELECT user_id AS session_a, (user_id * 7 + event_id) % 40 AS session_b, ['STRONG', 'USABLE', 'WEAK', 'AMBIGUOUS', 'STRONG'][event_id % 5 + 1] AS status, event_id % 4 AS groups, event_id % 6 AS verified, event_id % 3 AS tracks, event_id % 9 AS candidates, event_id % 2 = 0 AS critical FROM events WHERE event_type = 'purchase' AND value > 60"
_LINKS_SQL = f"""SELECT session_a AS session, session_b AS other, x.* FROM ({_EDGES_SQL}) x UNION ALL SELECT session_b AS session, session_a AS other, x.* FROM ({_EDGES_SQL}) x"""
_BASE = "session % 10 = 3"


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "events").select(F.col("user_id").alias("session")).distinct()
    cols = {
        "status": f"array{_STATUS.replace('[', '(').replace(']', ')')}[int(session % 5)]",
        "sharpness_p10": "if(session % 6 > 0, (session % 4) * 10.0D, null)",
        "loc_strong": "if(session % 7 > 0, session % 3, null)",
        "loc_queries": "session % 5",
        "core_hit_fraction": "if(session % 4 > 0, (session % 3) / 2, null)",
        "change_score": "(session % 8) / 10 - 0.4D",
        "high_influence": "session % 11 = 0",
        "improves": "session % 6 = 1",
        "appears_different": "session % 13 = 2",
        "num_tracks": "if(session % 9 > 0, session % 50, null)",
        "num_observations": "session % 70",
        "internal_quality_score": "(session % 17) / 17",
        "convex_hull_coverage": "if(session % 3 > 0, (session % 5) / 5, null)",
        "grid_occupancy": "session % 4",
        "fim_logdet": "double(session % 6)",
        "rotation_cycle_error": "if(session % 2 > 0, double(session % 7), null)",
    }
    return s.select("session", *[F.expr(e).alias(c) for c, e in cols.items()])


def _edges(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("event_type = 'purchase' and value > 60")
    cols = {
        "session_a": "user_id",
        "session_b": "(user_id * 7 + event_id) % 40",
        "status": "array('STRONG', 'USABLE', 'WEAK', 'AMBIGUOUS', 'STRONG')[int(event_id % 5)]",
        "independent_bridge_groups": "event_id % 4",
        "num_verified_pairs": "event_id % 6",
        "num_shared_tracks": "event_id % 3",
        "num_candidate_pairs": "event_id % 9",
        "is_critical_bridge": "event_id % 2 = 0",
    }
    return e.select(*[F.expr(x).alias(c) for c, x in cols.items()])


_GEOMETRIC = "status NOT IN ('AMBIGUOUS', 'REJECT', 'WEAK') AND NOT (candidates > 0 AND tracks = 0 AND verified = 0 AND groups = 0)"
_TO_BASE = f"SELECT *, {_GEOMETRIC} AS ok FROM ({_LINKS_SQL}) WHERE other IN (SELECT user_id FROM events WHERE user_id % 10 = 3) AND session <> other"


@query(f"""WITH l AS ({_TO_BASE}), f AS (SELECT session, coalesce(max(CASE WHEN ok THEN groups END), 0) AS g, bool_or(ok) AS usable, bool_or(critical) AS crit, bool_or(status IN ('AMBIGUOUS', 'REJECT', 'WEAK')) AS blocked FROM l GROUP BY 1),
  r AS (SELECT s.*, coalesce(usable, false) AS us, coalesce(blocked, false) AS bl, CASE WHEN coalesce(crit, false) AND coalesce(g, 0) < 2 AND coalesce(usable, false) THEN 1 ELSE coalesce(g, 0) END AS br, CASE WHEN queries > 0 THEN strong > 0 END AS ok FROM ({_SESSIONS_SQL}) s LEFT JOIN f USING (session) WHERE NOT (session % 10 = 3)),
  k AS (SELECT *, coalesce(ok, false) AND NOT improves AND NOT different AS covered, status IN ('STRONG', 'USABLE') AS sound FROM r)
  SELECT session, CASE WHEN status = 'REJECT' OR (status = 'WEAK' AND coalesce(sharp <= 0, false)) THEN 'REJECT' WHEN sound AND (NOT us OR br = 0) THEN CASE WHEN coalesce(ok, false) OR bl THEN 'QUARANTINE' ELSE 'NEW_SUBMAP' END
    WHEN influential OR (us AND br = 1) THEN 'QUARANTINE' WHEN coalesce(ok, false) AND (NOT us OR coalesce(hits <= 0, false)) THEN 'QUARANTINE' WHEN sound AND change > 0 THEN 'UPDATE_CANDIDATE' WHEN sound AND us AND NOT covered THEN 'GEOMETRY_REINFORCEMENT'
    WHEN sound AND coalesce(ok, false) AND covered THEN 'APPEARANCE_REF' ELSE 'QUARANTINE' END AS role FROM k""")
def leftover_roles(spark: SparkSession, d: str) -> DataFrame:
    s = _sessions(spark, d)
    return M.leftover_roles(s.where(f"not ({_BASE})"), _edges(spark, d), s.where(_BASE)).select("session", "role")


@query(f"""WITH l AS ({_TO_BASE}), f AS (SELECT session, count(*) FILTER (ok) AS u, count(*) FILTER (status IN ('AMBIGUOUS', 'REJECT', 'WEAK')) AS b, count(*) FILTER (ok AND critical) AS c, count(*) FILTER (ok AND NOT critical) AS f, count(*) FILTER (ok AND critical AND status <> 'STRONG') AS w FROM l GROUP BY 1),
  r AS (SELECT s.session, CASE WHEN u IS NULL THEN 'no_connection_to_core' WHEN u = 0 AND b > 0 THEN 'only_blocked_edges' WHEN u = 0 THEN 'no_geometric_edge' WHEN f = 0 AND c = 1 THEN 'single_critical_bridge' WHEN f = 0 AND w > 0 THEN 'unverified_critical_bridge' ELSE 'admissible' END AS reason
    FROM (SELECT DISTINCT user_id AS session FROM events WHERE user_id % 10 <> 3) s LEFT JOIN f USING (session)) SELECT session, reason = 'admissible' AS admissible, reason FROM r""")
def admissible_sessions(spark: SparkSession, d: str) -> DataFrame:
    s = _sessions(spark, d)
    return M.admissible(_edges(spark, d), s.where(_BASE).select("session"), s.where(f"not ({_BASE})"))


@query(f"""SELECT session FROM (SELECT session, row_number() OVER (ORDER BY (session % 17) / 17.0::DOUBLE DESC, CASE WHEN session % 3 > 0 THEN (session % 5) / 5.0::DOUBLE ELSE 0 END + session % 4 DESC, session % 6 DESC, CASE WHEN session % 2 > 0 THEN session % 7 ELSE 0 END, session) AS r
  FROM (SELECT DISTINCT user_id AS session, {_STATUS}[user_id % 5 + 1] AS status FROM events) WHERE status IN ('STRONG', 'USABLE')) WHERE r = 1""")
def seed_session(spark: SparkSession, d: str) -> DataFrame:
    return M.seed_session(_sessions(spark, d)).select("session")


@query("""WITH s AS (SELECT DISTINCT user_id AS session, CASE WHEN user_id % 9 > 0 THEN user_id % 50 END AS t, user_id % 70 AS o FROM events), b AS (SELECT count(*) AS n, coalesce(sum(t), 0) AS bt, coalesce(sum(o), 0) AS bo FROM s WHERE session % 10 = 3)
  SELECT session, n + 1 <= 40 AND bt + coalesce(t, 0) <= (SELECT bt + 30 FROM b) AND bo + o <= (SELECT bo + 50 FROM b) AND coalesce(t, 0) <= 25 AS fits FROM s, b WHERE session % 10 <> 3""")
def session_budget(spark: SparkSession, d: str) -> DataFrame:
    s = _sessions(spark, d)
    base = s.where(_BASE)
    sums = base.agg(F.sum("num_tracks").alias("t"), F.sum("num_observations").alias("o")).first()
    got = M.within_budget(s.where(f"not ({_BASE})"), base, sessions=40, tracks=(sums["t"] or 0) + 30, observations=(sums["o"] or 0) + 50, tracks_each=25)
    return got.select("session", "fits")


@query(f"""WITH e AS (SELECT * FROM ({_EDGES_SQL}) WHERE status IN ('STRONG', 'USABLE') AND NOT (candidates > 0 AND tracks = 0 AND verified = 0 AND groups = 0)), b AS (SELECT DISTINCT user_id AS session FROM events WHERE user_id % 40 IN (3, 4)),
  l AS (SELECT session_a AS session, session_b AS other, critical FROM e UNION ALL SELECT session_b, session_a, critical FROM e), t AS (SELECT * FROM l WHERE other IN (FROM b) AND session <> other),
  k AS (SELECT session FROM t WHERE NOT critical GROUP BY 1 HAVING count(*) >= 2), n AS (SELECT count(*) / 2 AS inner_edges FROM t WHERE session IN (FROM b)), z AS (SELECT count(*) AS size FROM b)
  SELECT session FROM (SELECT session, row_number() OVER (ORDER BY (session % 17) / 17.0::DOUBLE DESC, session) AS r FROM (SELECT DISTINCT user_id AS session, {_STATUS}[user_id % 5 + 1] AS status FROM events) JOIN k USING (session), n, z WHERE session NOT IN (FROM b) AND status IN ('STRONG', 'USABLE') AND size >= 2 AND inner_edges < size) WHERE r = 1""")
def cycle_closer(spark: SparkSession, d: str) -> DataFrame:
    s = _sessions(spark, d)
    return M.close_cycle(s.where("session % 40 in (3, 4)"), s.where("session % 40 not in (3, 4)"), _edges(spark, d)).select("session")


_INTERVALS = "SELECT user_id AS session, ['parallax', 'hover', 'low_parallax', 'ambiguous', 'pure_rotation', 'fast_motion', 'parallax'][event_id % 7 + 1] AS class, event_id % 4 AS tracks, (event_id % 19) / 19.0::DOUBLE AS epi, value AS flow FROM events"
_MOTION = f"""SELECT session, count(*) AS intervals, avg((class = 'parallax')::INT) AS parallax_ratio, avg((class = 'low_parallax')::INT) AS low_parallax_ratio, avg((class = 'hover')::INT) AS hover_ratio, avg((class = 'pure_rotation')::INT) AS pure_rotation_ratio, avg((class = 'fast_motion')::INT) AS fast_motion_ratio,
  avg((class = 'ambiguous')::INT) AS unproven_ratio, quantile_cont(epi, 0.5) FILTER (tracks > 0) AS epipolar_outlier_ratio_median, quantile_cont(flow, 0.5) FILTER (tracks > 0) AS flow_px_median FROM ({_INTERVALS}) GROUP BY 1"""


def _motion(spark: SparkSession, d: str) -> DataFrame:
    kinds = "array('parallax', 'hover', 'low_parallax', 'ambiguous', 'pure_rotation', 'fast_motion', 'parallax')[int(event_id % 7)]"
    e = table(spark, d, "events").select(F.col("user_id").alias("session"), F.expr(kinds).alias("class"), F.expr("event_id % 4").alias("tracks"), F.expr("(event_id % 19) / 19").alias("epipolar_outlier_ratio"), F.col("value").alias("flow_px"))
    return M.motion_ratios(e, ["session"])


@query(f"SELECT session, intervals, {', '.join(f'round({c}, 9) AS {c}' for c in ('parallax_ratio', 'low_parallax_ratio', 'hover_ratio', 'pure_rotation_ratio', 'fast_motion_ratio', 'unproven_ratio', 'epipolar_outlier_ratio_median', 'flow_px_median'))} FROM ({_MOTION})")
def motion_ratios(spark: SparkSession, d: str) -> DataFrame:
    m = _motion(spark, d)
    return m.select("session", "intervals", *[F.round(c, 9).alias(c) for c in m.columns if c not in ("session", "intervals")])


_QA = "SELECT DISTINCT user_id AS session, CASE WHEN user_id % 8 > 0 THEN (user_id % 15) * 10.0::DOUBLE END AS sharp, CASE WHEN user_id % 5 > 0 THEN (user_id % 10) / 10.0::DOUBLE END AS dup, (user_id % 6) / 10.0::DOUBLE AS un, (user_id % 7) / 10.0::DOUBLE AS ov FROM events"
_VIDEO = f"""SELECT *, least(1, parallax_ratio + 0.35 * low_parallax_ratio) AS moving, least(1, hover_ratio + pure_rotation_ratio + fast_motion_ratio + 0.5 * low_parallax_ratio) AS still, coalesce(dup, 0) AS dp, least(1, un + ov) AS bad, epipolar_outlier_ratio_median AS epi FROM ({_QA}) q LEFT JOIN ({_MOTION}) m USING (session)"""


def _qa(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "events").select(F.col("user_id").alias("session")).distinct()
    cols = {"sharpness_p10": "if(session % 8 > 0, (session % 15) * 10.0D, null)", "near_duplicate_ratio": "if(session % 5 > 0, (session % 10) / 10, null)", "underexposed_ratio": "(session % 6) / 10", "overexposed_ratio": "(session % 7) / 10"}
    return s.select("session", *[F.expr(e).alias(c) for c, e in cols.items()])


@query(f"""WITH v AS (SELECT *, least(0.9, greatest(0, 0.38 * moving + 0.22 * least(1, sharp / 100) + 0.12 * (1 - dp) + 0.10 * (1 - bad) + 0.10 * CASE WHEN epi IS NULL THEN 0.5 ELSE 1 - epi END + 0.08 * (1 - unproven_ratio) - 0.12 * still)) AS val, moving < 0.20 OR still > 0.70 OR fast_motion_ratio > 0.45 OR dp > 0.75 OR bad > 0.75 OR coalesce(epi > 0.75, false) AS br FROM ({_VIDEO}))
  SELECT session, CASE WHEN sharp IS NULL THEN 'WEAK' WHEN sharp < 15 THEN 'REJECT' WHEN br THEN 'WEAK' ELSE 'USABLE' END AS status, round(CASE WHEN sharp IS NULL THEN 0.2 WHEN sharp < 15 THEN 0.05 WHEN br THEN least(val, 0.45) ELSE greatest(val, 0.46) END, 9) AS score FROM v""")
def video_status(spark: SparkSession, d: str) -> DataFrame:
    return M.session_quality(_qa(spark, d), _motion(spark, d)).select("session", "status", F.round("internal_quality_score", 9).alias("score"))


_TERMS = [("0.5", "0.2"), ("parallax_ratio", "0.2"), ("low_parallax_ratio", "0.05"), ("CASE WHEN sharp IS NOT NULL THEN least(1, sharp / 100) END", "0.15"), ("1 - unproven_ratio", "0.1"), ("1 - dup", "0.1"), ("1 - un", "0.05"), ("1 - ov", "0.05"), ("1 - epi", "0.1")]
_RISKS = [("hover_ratio", "0.1"), ("pure_rotation_ratio", "0.1"), ("fast_motion_ratio", "0.1"), ("low_parallax_ratio", "0.05"), ("dup", "0.2"), ("un", "0.075"), ("ov", "0.075"), ("epi", "0.2"), ("unproven_ratio", "0.1")]


def _mean_sql(terms: list[tuple[str, str]]) -> tuple[str, str]:
    seen = " + ".join(f"CASE WHEN ({t}) IS NOT NULL THEN {w}::DOUBLE ELSE 0 END" for t, w in terms)
    value = " + ".join(f"coalesce(({t})::DOUBLE * {w}::DOUBLE, 0)" for t, w in terms)
    return f"({value}) / ({seen})", f"({seen}) / {sum(float(w) for _, w in terms)}::DOUBLE"


@query("SELECT session, " + ", ".join(f"round({e}, 9) AS {n}" for n, e in zip(("quality", "quality_seen", "risk", "risk_seen"), (*_mean_sql(_TERMS), *_mean_sql(_RISKS)))) + f" FROM ({_VIDEO})")
def video_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = _qa(spark, d).join(_motion(spark, d), "session", "left").withColumn("internal_quality_score", F.lit(0.5))
    cols = dict(zip(("quality", "quality_seen", "risk", "risk_seen"), (*M.video_score(), *M.risk_score())))
    return rows.select("session", *[F.round(c, 9).alias(n) for n, c in cols.items()])


@query("""WITH e AS (SELECT least(o_custkey % 200, o_orderkey % 200) AS a, greatest(o_custkey % 200, o_orderkey % 200) AS b, max(o_orderkey % 90)::DOUBLE AS n FROM orders WHERE o_custkey % 200 <> o_orderkey % 200 AND o_orderkey % 90 > 0 GROUP BY 1, 2) SELECT a, b, round(ln(1 + n) / ln(1 + (SELECT max(n) FROM e)), 9) AS strength FROM e""")
def proposal_graph(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.expr("o_custkey % 200").alias("session_a"), F.expr("o_orderkey % 200").alias("session_b"), F.expr("o_orderkey % 90").alias("num_candidate_pairs"))
    return M.proposal_graph(o).select("a", "b", F.round("strength", 9).alias("strength"))


@query("""WITH h AS (SELECT o_custkey AS pair, CASE WHEN o_orderkey % 4 > 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 30) / 40.0 ELSE (o_orderkey % 10) / 10.0 END END::DOUBLE AS sup, CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey % 25)::DOUBLE END AS ang, CASE WHEN o_orderkey % 7 > 1 THEN (o_orderkey % 9) / 9.0::DOUBLE - 0.5 END AS sim, CASE WHEN o_orderkey % 6 > 2 THEN (o_orderkey % 11)::DOUBLE END AS rot, (1 + o_orderkey % 3)::DOUBLE AS w FROM orders),
  t AS (SELECT pair, w, CASE WHEN sup IS NOT NULL THEN least(1, greatest(0, sup)) END AS t1, coalesce(exp(-0.5 * (ang / 10) ** 2), CASE WHEN sim IS NOT NULL THEN least(1, abs(sim)) END) AS t2, exp(-0.5 * (rot / 5) ** 2) AS t3 FROM h), n AS (SELECT *, (t1 IS NOT NULL)::INT + (t2 IS NOT NULL)::INT + (t3 IS NOT NULL)::INT AS n, coalesce(t1, 0) + coalesce(t2, 0) + coalesce(t3, 0) AS s FROM t)
  SELECT pair, round(score, 9) AS score, least(1, observed / 2.0) AS completeness, coalesce(score >= 0.6 AND observed >= 2, false) AS validated FROM (SELECT pair, sum(CASE WHEN n > 0 THEN s / n * w END) / sum(CASE WHEN n > 0 THEN w END) AS score, max(n) AS observed FROM n GROUP BY 1)""")
def planar_consistency(spark: SparkSession, d: str) -> DataFrame:
    cols = {
        "pair": "o_custkey",
        "inlier_support": "if(o_orderkey % 4 > 0, if(o_orderkey % 3 = 0, (o_orderkey % 30) / 40, (o_orderkey % 10) / 10), null)",
        "num_matches": "double(100)",
        "normal_angle_deg": "if(o_orderkey % 5 = 0, double(o_orderkey % 25), null)",
        "normal_similarity": "if(o_orderkey % 7 > 1, (o_orderkey % 9) / 9 - 0.5D, null)",
        "rotation_error_deg": "if(o_orderkey % 6 > 2, double(o_orderkey % 11), null)",
        "confidence": "double(1 + o_orderkey % 3)",
    }
    h = table(spark, d, "orders").select(*[F.expr(e).alias(c) for c, e in cols.items()])
    return M.planar_consistency(h, ["pair"]).select("pair", F.round("score", 9).alias("score"), "completeness", "validated")
