"""Queries of recapture and consensus: events, orders and line items stand in for cells, trials and observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import recapture as R
from . import analogues as A
from .registry import query, table


def _cols(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.round(c, 7).alias(c) if c in names else F.col(c) for c in df.columns])


@query("SELECT event_id, round(greatest(0, least(1, 1 / (1 + exp(-0.8 * (event_id % 12 - 4))) * exp(-greatest(value - 5, 0) / 2))), 9) AS weight FROM events WHERE value IS NOT NULL")
def point_weights(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events").where("value is not null"), event_id="event_id", track_length="event_id % 12", error="value - 5")
    return e.select("event_id", F.round(R.point_weight(), 9).alias("weight"))


@query("""WITH x AS (SELECT user_id, CASE WHEN value > 20 THEN value END AS g FROM events), s AS (SELECT user_id, avg((g IS NOT NULL)::INT) AS positive_depth_ratio, quantile_cont(g, 0.1) AS depth_p10, quantile_cont(g, 0.5) AS depth_p50, quantile_cont(g, 0.9) AS depth_p90, (quantile_cont(g, 0.75) - quantile_cont(g, 0.25)) / greatest(abs(quantile_cont(g, 0.5)), 1e-12) AS depth_iqr_ratio, min(ln(g)) AS lo, max(ln(g)) AS hi, count(g) AS n FROM x GROUP BY 1),
  b AS (SELECT x.user_id, least(7, floor((ln(g) - lo) / (hi - lo) * 8)) AS bin, count(*) / any_value(n) AS p FROM x JOIN s ON x.user_id = s.user_id WHERE g IS NOT NULL AND hi > lo GROUP BY 1, 2), h AS (SELECT user_id, -sum(p * ln(p)) / ln(8) AS depth_entropy FROM b GROUP BY 1)
  SELECT user_id, round(positive_depth_ratio, 7) AS positive_depth_ratio, round(depth_p10, 7) AS depth_p10, round(depth_p50, 7) AS depth_p50, round(depth_p90, 7) AS depth_p90, round(depth_iqr_ratio, 7) AS depth_iqr_ratio, round(coalesce(depth_entropy, 0), 7) AS depth_entropy FROM s LEFT JOIN h USING (user_id)""")
def depth_summary(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events"), user_id="user_id", depth="if(value > 20, value, -value)")
    got = R.depth_summary(e, ["user_id"])
    return _rounded(got, *[c for c in got.columns if c != "user_id"])


@query("""WITH v AS (SELECT DISTINCT l_orderkey AS query, l_partkey AS point FROM lineitem), x AS (SELECT *, (query * 7 + point) % 50 + 1.0::DOUBLE AS r, (query + point * 3) % 40 / 4.0::DOUBLE AS a FROM v), o AS (SELECT l_partkey AS point, median(l_quantity) AS mid, min(l_quantity) AS near, max(l_quantity) AS far FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), j AS (SELECT x.*, mid, near, far, CASE WHEN mid IS NOT NULL THEN NOT (r BETWEEN 0.6 * near AND 1.4 * far) END AS outside FROM x LEFT JOIN o USING (point))
  SELECT query, round(quantile_cont(a, 0.1), 7) AS angle_p10, round(quantile_cont(a, 0.5), 7) AS angle_p50, round(quantile_cont(a, 0.9), 7) AS angle_p90, round(avg((a < 2)::INT), 7) AS low_parallax_fraction, round(quantile_cont(r, 0.5), 7) AS range_p50, round(quantile_cont(mid, 0.5), 7) AS past_range_p50, round(quantile_cont(r / mid, 0.5), 7) AS scale_ratio_p50, round(quantile_cont(r / mid, 0.9), 7) AS scale_ratio_p90, round(coalesce(sum(outside::INT), 0) / greatest(count(mid), 1), 7) AS extrapolated_fraction FROM j GROUP BY 1""")
def query_geometry(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "lineitem")
    v = _cols(i, query="l_orderkey", point="l_partkey", range_m="(l_orderkey * 7 + l_partkey) % 50 + 1.0D", angle_deg="(l_orderkey + l_partkey * 3) % 40 / 4")
    got = R.query_geometry(v, _cols(i.where("l_returnflag = 'R'"), point="l_partkey", range_m="l_quantity"))
    return _rounded(got, *[c for c in got.columns if c != "query"])


@query("""SELECT l_orderkey AS query, sum(coalesce(p >= 0.3, false)::INT)::BIGINT AS matchable, round(avg((p IS NOT NULL)::INT), 7) AS evidenced_fraction, round(avg(p), 7) AS mean, round(coalesce(sum(p), 0), 7) AS effective FROM lineitem LEFT JOIN (SELECT p_partkey, p_size / 50.0::DOUBLE AS p FROM part WHERE p_partkey % 3 > 0) ON l_partkey = p_partkey GROUP BY 1""")
def query_matchability(spark: SparkSession, d: str) -> DataFrame:
    v = _cols(table(spark, d, "lineitem"), query="l_orderkey", point="l_partkey")
    got = R.query_matchability(v, _cols(table(spark, d, "part").where("p_partkey % 3 > 0"), point="p_partkey", p="p_size / 50"))
    return _rounded(got, "evidenced_fraction", "mean", "effective")


_MEMBERS = "SELECT s_nationkey AS region, s_suppkey AS image, s_suppkey % 3 = 0 AS anchor FROM supplier"


@query(f"""WITH m AS ({_MEMBERS}), p AS (SELECT DISTINCT l_suppkey AS a, (l_suppkey * 3 + l_partkey) % 100 AS b, l_partkey % 2 = 0 AS selected, CASE WHEN l_partkey % 4 > 0 THEN (l_partkey % 90) END AS nm, CASE WHEN l_partkey % 5 > 0 THEN (l_partkey % 40) END AS ni, l_partkey % 7 = 0 AS planar, l_partkey % 6 = 0 AS bad, l_partkey % 11 = 0 AS deg FROM lineitem),
  j AS (SELECT m.region, m.anchor AS x, n.anchor AS y, p.* FROM p JOIN m ON p.a = m.image JOIN m n ON p.b = n.image AND m.region = n.region WHERE NOT (m.anchor AND n.anchor))
  SELECT region, count(*) AS candidate_pairs, count(*) FILTER (NOT x AND NOT y) AS internal_pairs, count(*) FILTER (x OR y) AS anchor_pairs, round(avg(selected::INT), 7) AS selected_ratio, count(nm) AS attempted_pairs, count(*) FILTER (ni > 0) AS verified_pairs, median(nm)::DOUBLE AS matches_p50, quantile_cont(ni, 0.5) FILTER (nm IS NOT NULL) AS inliers_p50, round(avg(planar::INT), 7) AS planar_fraction, round(avg(bad::INT), 7) AS pose_bad_fraction, count(*) FILTER (deg) AS degenerate_pairs FROM j GROUP BY 1""")
def region_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = _cols(table(spark, d, "lineitem"), a="l_suppkey", b="(l_suppkey * 3 + l_partkey) % 100", selected="l_partkey % 2 = 0", num_matches="if(l_partkey % 4 > 0, l_partkey % 90, null)", num_inliers="if(l_partkey % 5 > 0, l_partkey % 40, null)", planar="l_partkey % 7 = 0", pose_bad="l_partkey % 6 = 0", degenerate="l_partkey % 11 = 0").distinct()
    return _rounded(R.region_pairs(p, _members(spark, d)), "selected_ratio", "planar_fraction", "pose_bad_fraction")


def _members(spark: SparkSession, d: str) -> DataFrame:
    return _cols(table(spark, d, "supplier"), region="s_nationkey", image="s_suppkey", anchor="s_suppkey % 3 = 0")


@query(f"""WITH m AS ({_MEMBERS}), p AS (SELECT DISTINCT region, l_partkey AS point FROM lineitem JOIN m ON l_suppkey = image WHERE l_partkey % 2 = 0), s AS (SELECT region, l_partkey AS point, bool_or(anchor) AND bool_or(NOT anchor) AS both_see FROM lineitem JOIN m ON l_suppkey = image GROUP BY 1, 2)
  SELECT region, round(avg(coalesce(both_see, false)::INT), 7) AS anchor_track_ratio FROM p LEFT JOIN s USING (region, point) GROUP BY 1""")
def anchor_track_ratio(spark: SparkSession, d: str) -> DataFrame:
    t = _cols(table(spark, d, "lineitem"), image="l_suppkey", point="l_partkey")
    m = _members(spark, d)
    points = t.where("point % 2 = 0").join(m.select("region", "image"), "image").select("region", "point")
    return _rounded(R.anchor_track_ratio(t, m, points), "anchor_track_ratio")


@query("""WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT x.u AS a, y.u AS b FROM (SELECT DISTINCT c_custkey AS u, c_nationkey * 100 + c_custkey % 7 AS p FROM customer WHERE c_custkey % 5 < 2) x JOIN (SELECT DISTINCT c_custkey AS u, c_nationkey * 100 + c_custkey % 7 AS p FROM customer WHERE c_custkey % 5 < 2) y ON x.p = y.p),
  r AS (SELECT c_custkey AS n, c_custkey AS m FROM customer UNION SELECT r.n, e.b FROM r JOIN e ON r.m = e.a), c AS (SELECT n, min(m) AS m FROM r GROUP BY 1), z AS (SELECT m, count(*) AS k FROM c GROUP BY 1) SELECT round(max(k) / sum(k), 9) AS largest_share FROM z""")
def largest_image_share(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    t = _cols(c.where("c_custkey % 5 < 2"), image="c_custkey", point="c_nationkey * 100 + c_custkey % 7")
    return R.largest_share(_cols(c, image="c_custkey"), t).select(F.round("largest_share", 9).alias("largest_share"))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    cols = {"region": "user_id % 30", "cell": "event_id", "x": "double(user_id % 4)", "y": "double(event_id % 3)", "z": "0.0D", "success_rate": "if(event_id % 6 > 0, (event_id % 21) / 20, null)", "attempts": "if(user_id % 5 > 0 and event_id % 4 > 0, event_id % 9, null)"}
    return _cols(table(spark, d, "events"), **cols, health="(event_id % 17) / 16", best="if(event_id % 29 = 0, 0.9D, null)", mean="if(event_id % 29 = 0, 0.8D, null)", worst="if(event_id % 58 = 0, 0.7D, null)")


_CELLS = "SELECT user_id % 30 AS region, event_id AS cell, user_id % 4 AS x, event_id % 3 AS y, CASE WHEN event_id % 6 > 0 THEN (event_id % 21) / 20.0::DOUBLE END AS s, CASE WHEN user_id % 5 > 0 AND event_id % 4 > 0 THEN event_id % 9 END AS n, (event_id % 17) / 16.0::DOUBLE AS h, event_id % 58 = 0 AS given FROM events"
_SUCCESS = f"SELECT region, coalesce(sum(s * n) FILTER (n > 0) / sum(n) FILTER (n > 0 AND s IS NOT NULL), median(s)) AS success_rate FROM ({_CELLS}) GROUP BY 1"
_DIRECTIONAL = f"""SELECT region, avg(hi) AS best, avg(mid) AS mean, avg(lo) AS worst, avg(hi) - avg(mid) AS sensitivity FROM (SELECT region, x, y, CASE WHEN bool_or(given) THEN 0.9 ELSE max(h) END AS hi, CASE WHEN bool_or(given) THEN 0.8 ELSE avg(h) END AS mid, CASE WHEN bool_or(given) THEN 0.7 ELSE min(h) END AS lo FROM ({_CELLS}) GROUP BY 1, 2, 3) GROUP BY 1"""


@query(f"SELECT region, round(success_rate, 7) AS success_rate FROM ({_SUCCESS})")
def weighted_success(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(R.weighted_success(_cells(spark, d), ["region"]), "success_rate")


@query(f"SELECT region, round(best, 7) AS best, round(mean, 7) AS mean, round(worst, 7) AS worst, round(sensitivity, 7) AS sensitivity FROM ({_DIRECTIONAL})")
def directional_health(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(R.directional(_cells(spark, d), ["region"]), "best", "mean", "worst", "sensitivity")


_SPECS = [("depth", "INTEGRITY", 0.0, 150.0), ("support", "RECAPTURE_AUTHORIZATION", 0.0, None), ("texture", "DIAGNOSTIC", None, None)]
_SPECS_SQL = "(VALUES ('depth', 'INTEGRITY', 0.0::DOUBLE, 150.0::DOUBLE), ('support', 'RECAPTURE_AUTHORIZATION', 0.0, NULL), ('texture', 'DIAGNOSTIC', NULL, NULL)) specs(metric, requirement, low, high)"
_METRICS_SQL = """SELECT user_id AS region, event_id AS cell, 'depth' AS metric, value, CASE WHEN user_id % 4 = 1 THEN 'ESTIMATED' ELSE 'MEASURED' END AS status FROM events UNION ALL SELECT user_id, event_id, 'support', (event_id % 7)::DOUBLE, CASE WHEN event_id % 400 = 0 THEN 'UNAVAILABLE' ELSE 'MEASURED' END FROM events
  UNION ALL SELECT user_id, event_id, 'texture', 1.0, 'MEASURED' FROM events WHERE user_id % 3 > 0"""
_AUDIT = f"""WITH r AS (SELECT e.user_id AS region, e.event_id AS cell, s.*, m.value, m.status FROM events e CROSS JOIN {_SPECS_SQL.replace('specs(', 's(')} LEFT JOIN ({_METRICS_SQL}) m ON m.region = e.user_id AND m.cell = e.event_id AND m.metric = s.metric),
  t AS (SELECT *, CASE WHEN value IS NULL OR status = 'UNAVAILABLE' THEN 'MISSING' WHEN value < coalesce(low, value) OR value > coalesce(high, value) THEN 'INVALID' WHEN status = 'ESTIMATED' THEN 'ESTIMATED_ONLY' ELSE 'PASS' END AS st FROM r),
  g AS (SELECT region, metric, requirement, count(*) AS cells, count(*) FILTER (st = 'PASS') AS usable, count(*) FILTER (st = 'ESTIMATED_ONLY') AS estimated, count(*) FILTER (st = 'MISSING') AS missing, count(*) FILTER (st = 'INVALID') AS invalid FROM t GROUP BY 1, 2, 3)
  SELECT *, CASE WHEN missing = cells THEN 'MISSING' WHEN invalid > 0 THEN 'INVALID' WHEN estimated = cells THEN 'ESTIMATED_ONLY' WHEN usable = cells THEN 'PASS' ELSE 'PARTIAL' END AS state FROM g"""
_READY = f"""SELECT region, bool_and(requirement <> 'INTEGRITY' OR state = 'PASS') AS integrity_ready, bool_and(requirement = 'DIAGNOSTIC' OR state = 'PASS') AS authorization_ready, bool_and(requirement <> 'DIAGNOSTIC' OR state = 'PASS') AS diagnosis_ready,
  array_to_string(list_sort(list(metric) FILTER (requirement <> 'DIAGNOSTIC' AND state <> 'PASS')), ',') AS blocking FROM ({_AUDIT}) GROUP BY 1"""


def _audit(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    m = _cols(e, region="user_id", cell="event_id", metric="'depth'", value="value", status="if(user_id % 4 = 1, 'ESTIMATED', 'MEASURED')")
    m = m.unionByName(_cols(e, region="user_id", cell="event_id", metric="'support'", value="double(event_id % 7)", status="if(event_id % 400 = 0, 'UNAVAILABLE', 'MEASURED')"))
    m = m.unionByName(_cols(e.where("user_id % 3 > 0"), region="user_id", cell="event_id", metric="'texture'", value="1.0D", status="'MEASURED'"))
    specs = spark.createDataFrame(_SPECS, "metric string, requirement string, low double, high double")
    return R.audit_metrics(m, _cols(e, region="user_id", cell="event_id"), specs)


@query(_AUDIT)
def metric_audit(spark: SparkSession, d: str) -> DataFrame:
    return _audit(spark, d)


@query(f"SELECT region, integrity_ready, authorization_ready, diagnosis_ready, coalesce(blocking, '') AS blocking FROM ({_READY})")
def recapture_readiness(spark: SparkSession, d: str) -> DataFrame:
    return R.readiness(_audit(spark, d)).withColumn("blocking", F.array_join("blocking", ","))


@query(f"""SELECT region, CASE WHEN success_rate >= 0.5 THEN 'HEALTHY' WHEN NOT coalesce(integrity_ready, false) THEN 'FIX_EVIDENCE' WHEN best >= 0.5 THEN 'REPAIR_EXISTING' WHEN coalesce(authorization_ready, false) THEN 'RECAPTURE' ELSE 'COLLECT_EVIDENCE' END AS decision
  FROM ({_SUCCESS}) JOIN ({_DIRECTIONAL}) USING (region) LEFT JOIN ({_READY}) USING (region)""")
def region_plan(spark: SparkSession, d: str) -> DataFrame:
    return R.plan_regions(_cells(spark, d), _audit(spark, d), healthy=0.5).select("region", "decision")


_HEALTH_METRICS = {"visible_landmark_count": ("sqrt(value) * 5", 50.0), "inlier_convex_hull_coverage": ("(event_id % 10) / 19e0", 0.2), "grid_occupancy_count": ("event_id % 13", 8.0), "positive_depth_ratio": ("(event_id % 8) / 7e0", 0.95), "fim_rank": ("event_id % 7", 6.0), "triangulation_angle_p10_deg": ("(user_id % 5) / 1e0", 2.0), "view_direction_entropy": ("(user_id % 9) / 1e1", 0.4)}
_HEALTH_SQL = " + ".join(f"least(1, greatest(0, ({e})::DOUBLE / {t}))" for e, t in _HEALTH_METRICS.values())


@query(f"""SELECT event_id, round(({_HEALTH_SQL} + least(1, 1e6 / greatest(user_id * 39937e0, 1)) + CASE WHEN event_id % 3 = 0 THEN least(1, (event_id % 6) / 3e0) ELSE 0 END) / (8 + (event_id % 3 = 0)::INT), 9) AS health FROM events WHERE value IS NOT NULL AND event_id % 5 > 0
  UNION ALL SELECT event_id, NULL FROM events WHERE value IS NULL OR event_id % 5 = 0""")
def structural_health(spark: SparkSession, d: str) -> DataFrame:
    cols = {c: f"double({e})" for c, (e, _) in _HEALTH_METRICS.items()}
    e = _cols(table(spark, d, "events"), event_id="event_id", **cols, fim_condition_number="if(event_id % 5 > 0, user_id * 39937.0D, null)", fim_effective_rank="if(event_id % 3 = 0, double(event_id % 6), null)", track_length_p50="double(null)", reprojection_error_p90_px="double(null)")
    return e.select("event_id", F.round(R.structural_health(), 9).alias("health"))


@query("""WITH t AS (SELECT user_id % 20 AS region, event_id, ['solve', 'match ', 'retrieve'][event_id % 3 + 1] AS stage, (event_id % 10) / 10.0::DOUBLE AS b, (event_id % 13) / 13.0::DOUBLE AS a, event_id % 4 > 0 AS ok FROM events WHERE event_type = 'purchase' AND event_id % 3 <= user_id % 3),
  s AS (SELECT *, trim(stage) AS st, CASE WHEN NOT ok THEN 0 WHEN b >= 0.95 THEN 1 ELSE least(1, greatest(0, (a - b) / (0.95 - b))) END AS sc FROM t), k AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY sc DESC, event_id) AS r FROM s), q AS (SELECT DISTINCT user_id % 20 AS region FROM events)
  SELECT q.region, (SELECT count(DISTINCT st) FROM s WHERE s.region = q.region AND st IN ('solve', 'match')) = 2 AS complete, k.st AS best_stage, round(coalesce(k.sc, 0), 7) AS repairability FROM q LEFT JOIN k ON k.region = q.region AND r = 1""")
def repair_counterfactual(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    t = _cols(e.where("event_type = 'purchase' and event_id % 3 <= user_id % 3"), region="user_id % 20", stage="array('solve', 'match ', 'retrieve')[int(event_id % 3)]", before="(event_id % 10) / 10", after="(event_id % 13) / 13", stable_ok="event_id % 4 > 0", order="event_id")
    need = _cols(e, region="user_id % 20").distinct().withColumn("stage", F.explode(F.array(F.lit("solve"), F.lit("match"), F.lit(" "))))
    return _rounded(R.counterfactual(t, need), "repairability")


_CONSENSUS = """SELECT event_id AS query, event_id % 5 AS hypothesis_count, (event_id % 30) / 30.0::DOUBLE AS sigma_disp_m, CASE WHEN event_id % 3 > 0 THEN (user_id % 9)::DOUBLE END AS rotation_dispersion_deg, (user_id % 11) / 10.0::DOUBLE AS covariance_eligible_ratio, CASE WHEN event_id % 7 > 0 THEN (event_id % 41) / 60.0::DOUBLE END AS sigma_cons_m FROM events"""


def _consensus(spark: SparkSession, d: str) -> DataFrame:
    return _cols(table(spark, d, "events"), query="event_id", hypothesis_count="event_id % 5", sigma_disp_m="(event_id % 30) / 30", rotation_dispersion_deg="if(event_id % 3 > 0, double(user_id % 9), null)", covariance_eligible_ratio="(user_id % 11) / 10", sigma_cons_m="if(event_id % 7 > 0, (event_id % 41) / 60, null)")


@query(f"""WITH c AS ({_CONSENSUS}), n AS (SELECT median(sigma_cons_m) AS mc, median(sigma_disp_m) AS md FROM c WHERE sigma_cons_m IS NOT NULL AND query % 2 = 0) SELECT query, CASE WHEN sigma_cons_m IS NOT NULL THEN round(greatest(sigma_cons_m / greatest(mc, 1e-12), sigma_disp_m / greatest(md, 1e-12)), 7) END AS sigma_joint FROM c, n WHERE query % 2 = 1""")
def sigma_joint(spark: SparkSession, d: str) -> DataFrame:
    c = _consensus(spark, d)
    got = R.sigma_joint(c.where("query % 2 = 1"), R.selective_normalization(c.where("query % 2 = 0")))
    return got.select("query", F.round("sigma_joint", 7).alias("sigma_joint"))


@query(f"""WITH c AS (SELECT *, sigma_disp_m > 0.5 OR coalesce(rotation_dispersion_deg > 5, false) AS apart, covariance_eligible_ratio < 0.5 OR coalesce(sigma_cons_m > 0.5, true) AS dim FROM ({_CONSENSUS}))
  SELECT query, CASE WHEN hypothesis_count < 2 THEN 'INSUFFICIENT_EVIDENCE' WHEN apart AND dim THEN 'CRITICAL' WHEN apart THEN 'REFERENCE_DISAGREEMENT' WHEN dim THEN 'OBSERVABILITY_WEAK' ELSE 'HEALTHY' END AS status,
    round(greatest(2.0::DOUBLE / greatest(hypothesis_count, 1), sigma_disp_m / 0.5, coalesce(rotation_dispersion_deg / 5, 0), 0.5::DOUBLE / greatest(covariance_eligible_ratio, 1e-12), coalesce(sigma_cons_m / 0.5, 1 + 1e-9)), 5) AS ratio FROM c""")
def consensus_status(spark: SparkSession, d: str) -> DataFrame:
    status, ratio = R.consensus_status()
    return _consensus(spark, d).select("query", status.alias("status"), F.round(ratio, 5).alias("ratio"))


@query(f"""WITH r AS ({A.RISKS_SQL}), t AS (SELECT risk, count(*) AS n, sum(count(*)) OVER (ORDER BY risk) AS c FROM r GROUP BY 1), z AS (SELECT sum(n) AS total, ceil(sum(n) / 7) AS target FROM t),
  s AS (WITH RECURSIVE w(i, start) AS (SELECT 0, 0::HUGEINT UNION ALL SELECT i + 1, (SELECT min(c) FROM t, z WHERE c >= w.start + target AND c < total) FROM w WHERE i < 6 AND start IS NOT NULL) SELECT * FROM w WHERE start IS NOT NULL)
  SELECT event_id, ((SELECT count(*) FROM s WHERE s.start <= t.c - t.n) - 1)::INT AS bin FROM r JOIN t USING (risk)""")
def equal_mass_bins(spark: SparkSession, d: str) -> DataFrame:
    return R.equal_mass_bins(A.risks(spark, d), "risk", 7).select("event_id", "bin")


@query(f"""WITH r AS (SELECT risk, failed::INT AS f, row_number() OVER (ORDER BY risk, event_id) AS place, sum(failed::INT) OVER (ORDER BY risk, event_id ROWS UNBOUNDED PRECEDING) AS s, count(*) OVER () AS n FROM ({A.RISKS_SQL})), k AS (SELECT greatest(1, ceil(max(n) * i / 10.0))::BIGINT AS place FROM r, range(1, 11) t(i) GROUP BY i)
  SELECT round(place / n, 9) AS coverage, round(s / place, 9) AS failure_rate, risk AS most_risk, place AS accepted FROM r JOIN k USING (place)""")
def coverage_deciles(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(R.coverage_deciles(A.risks(spark, d), "risk", "failed", "event_id"), "coverage", "failure_rate").select(F.round("coverage", 9).alias("coverage"), F.round("failure_rate", 9).alias("failure_rate"), "most_risk", "accepted")


@query(f"SELECT event_id, CASE WHEN risk >= 0.71 THEN 0.8 WHEN risk >= 0.4 THEN 0.35 WHEN risk >= 0.2 THEN 0.2 ELSE 0.05 END::DOUBLE AS probability FROM ({A.RISKS_SQL})")
def calibrator_steps(spark: SparkSession, d: str) -> DataFrame:
    steps = spark.createDataFrame([(0.1, 0.05), (0.2, 0.2), (0.4, 0.35), (0.71, 0.8)], "threshold double, probability double")
    return R.apply_steps(A.risks(spark, d), "risk", steps).select("event_id", "probability")


@query(f"SELECT query, x, y, z, success, inliers::BIGINT AS pnp_inliers, inlier_ratio, grid4_occupancy AS grid_occupancy, hull_coverage, positive_depth_ratio, reproj_p90_px AS reproj_p90 FROM ({A.results_sql()}) WHERE x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
def history_rows(spark: SparkSession, d: str) -> DataFrame:
    return R.history_rows(A.results(spark, d))


@query(f"""WITH n AS (SELECT vec_id, x / sqrt(x * x + y * y + z * z) AS x, y / sqrt(x * x + y * y + z * z) AS y, z / sqrt(x * x + y * y + z * z) AS z FROM ({A.PLACES_SQL})), r AS (SELECT *, CASE WHEN abs(z) < 0.9 THEN -y ELSE z END AS a, CASE WHEN abs(z) < 0.9 THEN x ELSE 0 END AS b, CASE WHEN abs(z) < 0.9 THEN 0 ELSE -x END AS c FROM n),
  u AS (SELECT vec_id, x, y, z, a / sqrt(a * a + b * b + c * c) AS a, b / sqrt(a * a + b * b + c * c) AS b, c / sqrt(a * a + b * b + c * c) AS c FROM r) SELECT vec_id, round(a, 7) AS xx, round(y * c - z * b, 7) AS xy, round(x, 7) AS xz, round(b, 7) AS yx, round(z * a - x * c, 7) AS yy, round(z, 7) AS zz FROM u""")
def direction_frames(spark: SparkSession, d: str) -> DataFrame:
    f = A.places(spark, d).select("vec_id", R.frame_of_direction("x", "y", "z").alias("f"))
    return f.select("vec_id", *[F.round(F.element_at("f", i), 7).alias(n) for n, i in (("xx", 1), ("xy", 2), ("xz", 3), ("yx", 4), ("yy", 5), ("zz", 9))])


@query("""SELECT user_id, count(DISTINCT least(greatest(trunc(value / 200 * 4)::INT, 0), 3) * 4 + least(greatest(trunc((event_id % 130) / 100.0 * 4)::INT, 0), 3)) AS occupied FROM events WHERE value IS NOT NULL GROUP BY 1""")
def grid_occupancy(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events").where("value is not null"), user_id="user_id", u="double(event_id % 130)", v="value", width="100", height="200")
    return R.grid_occupancy(e, ["user_id"])


@query(f"SELECT count(*) AS total, count(*) FILTER (strict) AS successes, ((count(*) * 19 + 19) // 20)::BIGINT AS required, CASE WHEN count(*) FILTER (strict) >= (count(*) * 19 + 19) // 20 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({A.gated_sql()})")
def attempts_summary(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.gates import with_failures

    return R.attempts_summary(with_failures(A.results(spark, d)))
