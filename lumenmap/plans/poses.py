"""Queries of poses and reports: events and embeddings stand in for points, hypotheses, pairs and videos."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import poses as P
from . import analogues as A
from .recapture import _cols
from .registry import query, table

_POINTS = "SELECT user_id, (event_id % 21 - 10) / 1e1 AS x, (event_id % 17 - 8) / 1e1 AS y, (event_id % 13) - 2e0 AS z, CASE WHEN event_id % 9 > 0 THEN (event_id % 5) / 4e0 END AS w FROM events"


def _points(spark: SparkSession, d: str) -> DataFrame:
    return _cols(table(spark, d, "events"), user_id="user_id", x="(event_id % 21 - 10) / 10", y="(event_id % 17 - 8) / 10", z="(event_id % 13) - 2.0D", weight="if(event_id % 9 > 0, (event_id % 5) / 4, null)")


@query(f"""WITH j AS (SELECT user_id, w, 100 / z AS u0, -100 * x / z / z AS u2, -100 * x / z * y / z AS u3, 100 * (1 + x / z * x / z) AS u4, -100 * y / z AS u5, 90 / z AS v1, -90 * y / z / z AS v2, -90 * (1 + y / z * y / z) AS v3, 90 * x / z * y / z AS v4, 90 * x / z AS v5 FROM ({_POINTS}) WHERE z > 1e-9 AND w > 0)
  SELECT user_id, count(*) AS points_used, round(sum(w * u0 * u0), 4) AS tt, round(sum(w * (u2 * u2 + v2 * v2)), 4) AS zz, round(sum(w * (u4 * u4 + v4 * v4)), 3) AS rr, round(sum(w * v1 * v3), 4) AS yx, round(sum(w * (u3 * u5 + v3 * v5)), 3) AS xz FROM j GROUP BY 1""")
def pose_information(spark: SparkSession, d: str) -> DataFrame:
    m = P.information(_points(spark, d), ["user_id"], 100.0, 90.0).where("points_used > 0")
    at = {e: k + 1 for k, e in enumerate(P.ENTRIES)}
    g = lambda e, n, k: F.round(F.element_at("information", at[e]), k).alias(n)
    return m.select("user_id", "points_used", g((0, 0), "tt", 4), g((2, 2), "zz", 4), g((4, 4), "rr", 3), g((1, 3), "yx", 4), g((3, 5), "xz", 3))


@query()
def pose_spectrum(spark: SparkSession, d: str) -> DataFrame:
    """Eigenvalues aren't for SQL; tests hold them against numpy."""
    return P.information(_points(spark, d), ["user_id"], 100.0, 90.0).select("user_id", P.information_summary().alias("s")).select("user_id", "s.rank", "s.condition", "s.weakest")


@query("""WITH m AS (SELECT user_id, event_id % 40 AS point, event_id % 3 > 0 AS inl, (event_id % 101) / 1e2 AS conf, value AS err, event_id % 7 - 1 AS depth, event_id % 11 AS ref FROM events WHERE value IS NOT NULL), b AS (SELECT *, row_number() OVER (PARTITION BY user_id, point ORDER BY conf DESC, ref) AS r FROM m WHERE inl), g AS (SELECT user_id, count(*) AS inliers, sqrt(avg(err * err)) AS rmse, quantile_cont(err, 0.9) AS p90, avg((depth > 0)::INT) AS pd, count(DISTINCT ref) AS refs FROM b WHERE r = 1 GROUP BY 1)
  SELECT a.user_id, points, coalesce(inliers, 0) AS inliers, round(rmse, 6) AS rmse, round(p90, 6) AS p90, round(pd, 6) AS positive_depth_ratio, coalesce(refs, 0) AS "references", round(coalesce(inliers, 0) / greatest(points, 1), 6) AS inlier_ratio FROM (SELECT user_id, count(DISTINCT point) AS points FROM m GROUP BY 1) a LEFT JOIN g USING (user_id)""")
def pose_quality(spark: SparkSession, d: str) -> DataFrame:
    m = _cols(table(spark, d, "events").where("value is not null"), user_id="user_id", point="event_id % 40", inlier="event_id % 3 > 0", confidence="(event_id % 101) / 100", error="value", depth="event_id % 7 - 1", reference="event_id % 11")
    return P.pose_quality(m, ["user_id"]).select("user_id", "points", "inliers", *[F.round(c, 6).alias(c) for c in ("rmse", "p90", "positive_depth_ratio")], "references", F.round("inlier_ratio", 6).alias("inlier_ratio"))


@query(f"""WITH p AS ({A.PLACES_SQL}), n AS (SELECT a.vec_id AS pose, least(1, count(b.vec_id) / 20e0) * avg((b.label + 1) / 20e0) AS pp FROM p a JOIN p b ON b.vec_id % 2 = 0 AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 0.04 WHERE a.vec_id % 5 = 0 GROUP BY 1),
  c AS (SELECT a.vec_id AS pose, least(1, count(*) / 3e0) AS cc, max((least(1, greatest(-1, a.x * b.x * 9 + a.y * b.y * 9 + a.z * b.z * 9)) + 1) / 2) AS vv FROM p a JOIN p b ON b.vec_id % 3 = 0 AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 0.01 WHERE a.vec_id % 5 = 0 GROUP BY 1)
  SELECT p.vec_id AS pose, round(least(1, greatest(0, 0.55 * coalesce(pp, 0) + 0.25 * coalesce(cc, 0) + 0.2 * coalesce(vv, 0))), 6) AS support FROM p LEFT JOIN n ON n.pose = p.vec_id LEFT JOIN c ON c.pose = p.vec_id WHERE p.vec_id % 5 = 0""")
def support_proxy(spark: SparkSession, d: str) -> DataFrame:
    p = A.places(spark, d)
    view = [(F.col(c) * 3).alias(f"f{c}") for c in "xyz"]
    poses = p.where("vec_id % 5 = 0").select(F.col("vec_id").alias("pose"), "x", "y", "z", *view)
    points = p.where("vec_id % 2 = 0").select(F.col("vec_id").alias("point"), "x", "y", "z", ((F.col("label") + 1) / 20).alias("weight"))
    cameras = p.where("vec_id % 3 = 0").select(F.col("vec_id").alias("camera"), "x", "y", "z", *view)
    got = P.support_proxy(poses, points, cameras, point_radius=0.2, camera_radius=0.1, enough_points=20.0, enough_cameras=3.0)
    return got.select("pose", F.round("support", 6).alias("support"))


@query(f"""WITH RECURSIVE p AS MATERIALIZED ({A.PLACES_SQL}), u AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON a.vec_id <> b.vec_id AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 0.0036),
  cc(node, c) USING KEY (node) AS (SELECT vec_id, vec_id FROM p UNION SELECT u.a, min(k.c) FROM cc k JOIN u ON u.b = k.node JOIN recurring.cc r ON r.node = u.a WHERE k.c < r.c GROUP BY u.a) SELECT c AS cluster, round(avg(x), 6) AS x, round(avg(y), 6) AS y, count(*) AS members FROM cc JOIN p ON vec_id = node GROUP BY 1""")
def marker_clusters(spark: SparkSession, d: str) -> DataFrame:
    got = P.marker_clusters(A.places(spark, d), "vec_id", 0.06)
    return got.select("cluster", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "members")


@query(f"""WITH RECURSIVE p AS MATERIALIZED (SELECT *, (vec_id * 7) % 360 AS yaw FROM ({A.PLACES_SQL})), u AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 0.0225 AND least((a.yaw - b.yaw + 360) % 360, (b.yaw - a.yaw + 360) % 360) <= 60),
  cc(node, c) USING KEY (node) AS (SELECT vec_id, vec_id FROM p UNION SELECT u.a, min(k.c) FROM cc k JOIN u ON u.b = k.node JOIN recurring.cc r ON r.node = u.a WHERE k.c < r.c GROUP BY u.a) SELECT label AS query, c AS cluster, sum(vec_id % 10)::DOUBLE AS score, count(*) AS members FROM cc JOIN p ON vec_id = node GROUP BY 1, 2""")
def hypothesis_clusters(spark: SparkSession, d: str) -> DataFrame:
    h = A.places(spark, d).select(F.col("vec_id").alias("id"), F.col("label").alias("query"), "x", "y", "z", (F.col("vec_id") * 7 % 360).alias("yaw_deg"), (F.col("vec_id") % 10).cast("double").alias("score"))
    return P.hypothesis_clusters(h, 0.15, 60.0)


@query("""WITH t AS (SELECT event_id, event_id % 90 AS da, user_id % 70 AS db, radians(event_id % 90) AS a, radians(user_id % 70) AS b, 1 + (event_id % 5) / 1e1 AS sa, 1 + (user_id % 4) / 1e1 AS sb, (event_id % 7)::DOUBLE AS x, (user_id % 5)::DOUBLE AS y FROM events)
  SELECT event_id, round(abs(degrees(a - b)), 5) AS rotation, round(sqrt((x - sa / sb * (cos(a - b) * y - sin(a - b))) ** 2 + (1 - sa / sb * (sin(a - b) * y + cos(a - b))) ** 2), 6) AS translation, round(abs(sa / sb - 1), 6) AS scale FROM t WHERE abs(da - db) > 1""")
def similarity_cycles(spark: SparkSession, d: str) -> DataFrame:
    turn = lambda a: f"array(cos({a}), -sin({a}), 0.0D, sin({a}), cos({a}), 0.0D, 0.0D, 0.0D, 1.0D)"
    e = _cols(table(spark, d, "events").where("abs(event_id % 90 - user_id % 70) > 1"), event_id="event_id", sa="1 + (event_id % 5) / 10", ra=turn("radians(event_id % 90)"), ta="array(double(event_id % 7), 1.0D, 0.0D)", sb="1 + (user_id % 4) / 10", rb=turn("radians(user_id % 70)"), tb="array(double(user_id % 5), 1.0D, 0.0D)")
    r, t, s = P.similarity_cycle(("sa", "ra", "ta"), ("sb", "rb", "tb"))
    return e.select("event_id", F.round(r, 5).alias("rotation"), F.round(t, 6).alias("translation"), F.round(s, 6).alias("scale"))


@query("""SELECT p.s_suppkey AS a, q.s_suppkey AS b, round(least(d, 360 - d), 4) AS rotation_error_deg FROM supplier p JOIN supplier q ON p.s_nationkey = q.s_nationkey AND p.s_suppkey < q.s_suppkey, LATERAL (SELECT ((q.s_suppkey * 3 - p.s_suppkey * 3 - 10) % 360 + 360) % 360 AS d) WHERE least(d, 360 - d) BETWEEN 1 AND 179""")
def relative_pose_errors(spark: SparkSession, d: str) -> DataFrame:
    turn = lambda a: f"array(cos({a}), -sin({a}), 0.0D, sin({a}), cos({a}), 0.0D, 0.0D, 0.0D, 1.0D)"
    s = table(spark, d, "supplier")
    i = _cols(s, image="s_suppkey", rotation=turn("radians(s_suppkey * 3)"), translation="array(double(s_suppkey), 1.0D, 2.0D)")
    p = _cols(s, a="s_suppkey", n="s_nationkey").join(_cols(s, b="s_suppkey", n="s_nationkey"), "n").where("a < b").select("a", "b", F.expr(turn("radians(10)")).alias("rotation"), F.expr("array(1.0D, 0.0D, 0.0D)").alias("direction"))
    got = P.relative_pose_error(p, i).select("a", "b", F.round("rotation_error_deg", 4).alias("rotation_error_deg"))
    return got.where("rotation_error_deg between 1 and 179")


@query(f"WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT s_suppkey % 30 AS a, (s_suppkey % 30 + 1 + s_nationkey % 3) % 30 AS b FROM supplier), u AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e), r(s, n, h) AS (SELECT a, a, 0 FROM u UNION SELECT r.s, u.b, h + 1 FROM r JOIN u ON u.a = r.n WHERE h < 20) SELECT max(m) AS diameter FROM (SELECT s, n, min(h) AS m FROM r GROUP BY 1, 2)")
def graph_diameter(spark: SparkSession, d: str) -> DataFrame:
    return P.diameter(_cols(table(spark, d, "supplier"), a="s_suppkey % 30", b="(s_suppkey % 30 + 1 + s_nationkey % 3) % 30").distinct(), 20)


@query("""WITH n AS (SELECT event_type || '/' || (event_id % 50) || '.jpg' AS image, 'r' || event_id AS role, event_id FROM events WHERE event_id % 3 > 0), w AS (SELECT image, arg_max(role, event_id) AS role FROM n GROUP BY 1), b AS (SELECT split_part(image, '/', 2) AS image, arg_min(role, event_id) AS role FROM n GROUP BY 1) FROM w UNION ALL FROM b""")
def image_roles(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events"), name="concat(event_type, '/', event_id % 50, '.jpg')", role="string(null)", image_role="if(event_id % 3 = 1, concat('r', event_id), null)", motion_role="if(event_id % 3 > 0, concat('r', event_id), null)", order="event_id")
    return P.image_roles(e)


@query("""WITH i AS (SELECT c_custkey AS image, c_nationkey AS video, c_nationkey % 2 AS direction, CASE WHEN c_custkey % 5 = 0 THEN 'hover' WHEN c_custkey % 7 > 0 THEN 'rotation' END AS motion FROM customer)
  SELECT CASE WHEN a.direction <> b.direction THEN 'cross_direction' WHEN a.video <> b.video THEN 'cross_video' ELSE 'same_video' END AS relation, least(coalesce(a.motion, 'parallax'), coalesce(b.motion, 'parallax')) || '+' || greatest(coalesce(a.motion, 'parallax'), coalesce(b.motion, 'parallax')) AS motion, coalesce(CASE WHEN o_orderkey % 3 > 0 THEN 'k' || o_orderkey % 3 END, 'unknown') AS kind, count(*) AS pairs FROM orders JOIN i a ON a.image = o_custkey JOIN i b ON b.image = o_orderkey % 1500 GROUP BY 1, 2, 3""")
def pair_report(spark: SparkSession, d: str) -> DataFrame:
    i = _cols(table(spark, d, "customer"), image="c_custkey", video="c_nationkey", direction="c_nationkey % 2", motion="case when c_custkey % 5 = 0 then 'hover' when c_custkey % 7 > 0 then 'rotation' end")
    return P.pair_report(_cols(table(spark, d, "orders"), a="o_custkey", b="o_orderkey % 1500", kind="if(o_orderkey % 3 > 0, concat('k', o_orderkey % 3), null)"), i)


@query("""WITH s AS (SELECT user_id % 12 AS base, event_id AS session, (event_id % 50) / 1e3 AS c, (event_id % 40) / 1e3 AS i, (event_id % 60) / 1e3 AS n, (event_id % 200) / 1e3 AS r, (event_id % 31) / 31e0 AS q FROM events WHERE event_id % 60 < 18), k AS (SELECT *, c >= 0.02 OR i >= 0.02 OR n > 0.05 OR r > 0.15 AS core, row_number() OVER (PARTITION BY base ORDER BY q DESC, session) AS rn FROM s)
  SELECT base, session, CASE WHEN core OR (rn = 1 AND NOT bool_or(core) OVER (PARTITION BY base)) THEN 'CORE' ELSE 'SUPPORT' END AS part FROM k""")
def core_or_support(spark: SparkSession, d: str) -> DataFrame:
    s = _cols(table(spark, d, "events").where("event_id % 60 < 18"), base="user_id % 12", session="event_id", coverage="(event_id % 50) / 1000", information="(event_id % 40) / 1000", connectivity="(event_id % 60) / 1000", redundancy="(event_id % 200) / 1000", quality="(event_id % 31) / 31")
    return P.core_or_support(s).select("base", "session", "part")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_partkey % 20, l_linenumber * 2) IN (SELECT (p_size % 20, p_partkey % 15) FROM part WHERE p_partkey % 4 = 1)")
def stable_associations(spark: SparkSession, d: str) -> DataFrame:
    a = _cols(table(spark, d, "lineitem"), l_orderkey="l_orderkey", l_linenumber="l_linenumber", image="l_partkey % 20", x="l_linenumber * 2 + 0.3D", y="4.9D")
    p = _cols(table(spark, d, "part"), image="p_size % 20", x="p_partkey % 15", y="5", label="p_partkey % 4")
    return P.stable_associations(a, p).select("l_orderkey", "l_linenumber")


@query("SELECT c_name, c_mktsegment AS sequence, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) - 1)::INT AS place FROM customer")
def grouped_frames(spark: SparkSession, d: str) -> DataFrame:
    f = _cols(table(spark, d, "customer"), c_name="c_name", name="concat(c_mktsegment, '/', c_name)")
    return P.grouped_frames(f).select("c_name", "sequence", "place")


@query("SELECT p_size AS width, length(p_name)::INT AS height, count(*) AS videos FROM part GROUP BY 1, 2")
def resolution_groups(spark: SparkSession, d: str) -> DataFrame:
    return P.resolution_groups(_cols(table(spark, d, "part"), video="p_partkey", width="p_size", height="length(p_name)")).select("width", "height", "videos")


@query("""WITH v AS (SELECT s_suppkey % 70 AS sequence, s_suppkey % 90 AS path, s_suppkey % 9 > 0 AS b FROM supplier), s AS (SELECT sequence, count(*) FILTER (b) AS b, count(*) FILTER (NOT b) AS t FROM v GROUP BY 1), p AS (SELECT path, count(*) FILTER (b) AS b, count(*) FILTER (NOT b) AS t FROM v GROUP BY 1)
  SELECT 'repeated_sequence' AS problem, sequence AS name FROM s WHERE b > 1 UNION ALL SELECT 'shared_sequence', sequence FROM s WHERE b > 0 AND t > 0 UNION ALL SELECT 'shared_path', path FROM p WHERE b > 0 AND t > 0""")
def corpus_problems(spark: SparkSession, d: str) -> DataFrame:
    return P.corpus_problems(_cols(table(spark, d, "supplier"), sequence="s_suppkey % 70", path="s_suppkey % 90", part="if(s_suppkey % 9 > 0, 'BUILD', 'TEST')"))


@query("SELECT c_name AS query FROM customer")
def checked_manifest(spark: SparkSession, d: str) -> DataFrame:
    return P.checked_manifest(_cols(table(spark, d, "customer"), query="concat(' ', c_name)"))


@query("SELECT event_id AS query, CASE WHEN event_id % 3 = 0 THEN 'CURRENT' WHEN event_id % 4 = 0 AND event_id % 5 > 0 THEN 'HISTORICAL' WHEN event_id % 4 = 0 THEN 'AMBIGUOUS' ELSE 'FAILED' END AS source, CASE WHEN event_id % 3 = 0 THEN user_id WHEN event_id % 4 = 0 AND event_id % 5 > 0 THEN -user_id END AS pose FROM events")
def current_first(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return P.current_first(_cols(e, query="event_id", strict="event_id % 3 = 0", pose="user_id"), _cols(e.where("event_id % 2 = 0"), query="event_id", strict="event_id % 4 = 0", pose="-user_id"), _cols(e.where("event_id % 5 = 0"), query="event_id", modes="2"))
