"""Decisions: pose gates, motion classes, session edges, diagnosis codes, relative quality, snapshots, jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import diagnosis as D
from ..operators import gates as G
from ..operators import graph as N
from ..operators import sessions as Z
from ..operators import windows as W
from . import analogues as A
from .registry import query, table


def _rank_sql(metric: str, order: str) -> str:
    return f"CASE WHEN {metric} IS NULL THEN NULL WHEN count({metric}) OVER () = 1 THEN 1.0 ELSE (rank() OVER (ORDER BY {metric} {order} NULLS LAST) - 1 + (count(*) OVER (PARTITION BY {metric}) - 1) / 2.0) / (count({metric}) OVER () - 1) END AS r_{metric}"


_W = Z.RELATIVE
_RANKS = ", ".join(_rank_sql(m, "DESC" if m == "reproj_p90_px" else "ASC") for m in _W)
_OBSERVED = " + ".join(f"CASE WHEN r_{m} IS NOT NULL THEN {w}::DOUBLE ELSE 0 END" for m, w in _W.items())
_VALUE = " + ".join(f"coalesce(r_{m}, 0)::DOUBLE * {w}::DOUBLE" for m, w in _W.items())


@query(f"WITH r AS (SELECT query, {_RANKS} FROM ({A.results_sql()})), s AS (SELECT query, {_OBSERVED} AS o, {_VALUE} AS v FROM r) SELECT query, round(v / o * (0.70 + 0.30 * o / {sum(_W.values())}::DOUBLE), 7) AS quality, round(o / {sum(_W.values())}::DOUBLE, 7) AS completeness FROM s")
def relative_quality(spark: SparkSession, d: str) -> DataFrame:
    return Z.relative_quality(A.results(spark, d)).select("query", F.round("quality", 7).alias("quality"), F.round("completeness", 7).alias("completeness"))


@query("""WITH s AS (SELECT user_id, event_id, sqrt((value - lag(value) OVER w) ** 2 + (event_id % 11 - lag(event_id % 11) OVER w) ** 2) AS step FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), m AS (SELECT user_id, median(step) AS med FROM s WHERE step IS NOT NULL GROUP BY 1)
  SELECT user_id, event_id, round(step, 6) AS step FROM s JOIN m USING (user_id) WHERE step > 2 * med""")
def trajectory_jumps(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", F.col("value").alias("x"), (F.col("event_id") % 11).cast("double").alias("y"))
    return D.trajectory_jumps(e, ["user_id"], "event_id", ("x", "y"), 2.0).select("user_id", "event_id", F.round("step", 6).alias("step"))


_SESSION_TRACKS = """WITH n AS (SELECT l_orderkey AS p, s_nationkey % 5 AS s, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
  SELECT x.s AS session_a, y.s AS session_b, count(*) AS num_shared_tracks, sum(x.n)::BIGINT AS observations_a, sum(y.n)::BIGINT AS observations_b FROM n x JOIN n y ON x.p = y.p AND x.s < y.s GROUP BY 1, 2"""


def _session_tracks(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("point3d_id"), F.col("l_suppkey").alias("image_id"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("image_id"), (F.col("s_nationkey") % 5).alias("session"))
    return Z.shared_tracks(t, s)


@query(_SESSION_TRACKS)
def session_shared_tracks(spark: SparkSession, d: str) -> DataFrame:
    return _session_tracks(spark, d)


@query("""SELECT user_id AS k, CASE WHEN n <= 0 THEN 'REJECT' WHEN rot > 5 OR tr > 15 OR sc > 0.15 THEN 'AMBIGUOUS' WHEN rot IS NULL OR n < 8 OR t < 30 THEN 'WEAK' WHEN g < 2 OR re > 5 OR ho < 0.45 THEN 'USABLE' ELSE 'STRONG' END AS status FROM
  (SELECT user_id, count(*) - 55 AS n, (sum(event_id) % 100) AS t, user_id % 4 AS g, CASE WHEN user_id % 9 > 0 THEN (user_id % 8)::DOUBLE END AS rot, (user_id % 17)::DOUBLE AS tr, (user_id % 20) / 100.0::DOUBLE AS sc, (user_id % 7)::DOUBLE AS re, (user_id % 10) / 10.0::DOUBLE AS ho FROM events GROUP BY user_id)""")
def session_edge_status(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("user_id")
    g = table(spark, d, "events").groupBy("user_id").agg((F.count("*") - 55).alias("num_verified_pairs"), (F.sum("event_id") % 100).alias("num_shared_tracks"))
    g = g.select(u.alias("k"), "num_verified_pairs", "num_shared_tracks", (u % 4).alias("independent_bridge_groups"), F.when(u % 9 > 0, (u % 8).cast("double")).alias("rotation_consensus_deg"), (u % 17).cast("double").alias("translation_direction_consensus_deg"), ((u % 20) / 100).alias("scale_consensus"), (u % 7).cast("double").alias("cross_session_reprojection_error"), ((u % 10) / 10).alias("holdout_inlier_ratio"))
    status, _ = G.session_edge()
    return g.select("k", status.alias("status"))


@query("""SELECT query, array_to_string([r FOR r IN [CASE WHEN coalesce(inliers < 30, true) THEN 'min_inliers' END, CASE WHEN coalesce(inlier_ratio < 0.25, true) THEN 'min_inlier_ratio' END, CASE WHEN coalesce(reproj_p90_px > 6.0, true) THEN 'max_reproj_p90' END,
  CASE WHEN coalesce(positive_depth_ratio < 0.98, true) THEN 'min_depth' END] IF r IS NOT NULL], ',') AS failed FROM (""" + A.results_sql() + ")")
def pose_gates(spark: SparkSession, d: str) -> DataFrame:
    gates = {k: v for k, v in G.POSE_GATES.items() if k in ("min_inliers", "min_inlier_ratio", "max_reproj_p90", "min_depth")}
    return A.results(spark, d).select("query", F.array_join(G.pose_gates(gates), ",").alias("failed"))


@query("""SELECT event_id, CASE WHEN t < 12 THEN 'UNKNOWN' WHEN f < 0.8 THEN 'HOVER' WHEN f > 35 AND b < 25 THEN 'FAST_BLUR' WHEN rot >= 0.35 AND par <= 0.75 AND h >= 0.9 THEN 'PURE_ROTATION' WHEN e < 20 THEN 'WEAK_GEOMETRY' WHEN par < 2 THEN 'LOW_PARALLAX' ELSE 'PARALLAX' END AS motion FROM
  (SELECT event_id, event_id % 40 AS t, (event_id % 50) / 1.0 AS f, (user_id % 60)::DOUBLE AS b, (event_id % 10) / 10.0 AS rot, (user_id % 8) / 2.0 AS par, (event_id % 12) / 10.0 AS h, user_id % 45 AS e FROM events)""")
def motion_classes(spark: SparkSession, d: str) -> DataFrame:
    i, u = F.col("event_id"), F.col("user_id")
    c = G.motion_class(i % 40, (i % 50) / 1.0, (i % 10) / 10, (u % 60).cast("double"), u % 45, (i % 12) / 10, (u % 8) / 2)
    return table(spark, d, "events").select("event_id", c.alias("motion"))


@query("""SELECT path, CASE WHEN b IS NULL THEN 'added' WHEN a IS NULL THEN 'missing' ELSE 'changed' END AS change FROM (SELECT coalesce(x.c_custkey, y.c_custkey) AS path, x.h AS b, y.h AS a FROM
  (SELECT c_custkey, sha256(c_mktsegment) AS h FROM customer WHERE c_custkey % 10 <> 1) x FULL JOIN (SELECT c_custkey, sha256(CASE WHEN c_custkey % 7 = 0 THEN 'X' ELSE c_mktsegment END) AS h FROM customer WHERE c_custkey % 10 <> 2) y ON x.c_custkey = y.c_custkey) WHERE b IS DISTINCT FROM a""")
def snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    before = c.where("c_custkey % 10 <> 1").select(F.col("c_custkey").alias("path"), F.sha2("c_mktsegment", 256).alias("sha256"))
    after = c.where("c_custkey % 10 <> 2").select(F.col("c_custkey").alias("path"), F.sha2(F.when(F.col("c_custkey") % 7 == 0, "X").otherwise(F.col("c_mktsegment")), 256).alias("sha256"))
    return G.snapshot_changes(before, after)


@query("""SELECT l_suppkey AS k, array_to_string(CASE WHEN len(f) = 0 THEN ['HEALTHY'] ELSE f END, ',') AS codes, CASE WHEN len(f) = 0 THEN 'HEALTHY' ELSE f[1] END AS first_code FROM (SELECT l_suppkey, [r FOR r IN [CASE WHEN v < 40 THEN 'LOW_VISIBILITY' END, CASE WHEN e < 25 THEN 'LOW_EFFECTIVE_LANDMARKS' END, CASE WHEN g < 6 THEN 'LOW_COVERAGE' END, CASE WHEN c < 3 THEN 'FEW_CAMERAS' END] IF r IS NOT NULL] AS f FROM
  (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS v, count(*) FILTER (l_tax > 0.04) AS e, count(DISTINCT l_linenumber) AS g, count(DISTINCT l_linestatus) AS c FROM lineitem GROUP BY 1))""")
def diagnosis_codes(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "lineitem")
    g = i.groupBy(F.col("l_suppkey").alias("k")).agg(F.sum((F.col("l_returnflag") == "R").cast("long")).alias("visible"), F.sum((F.col("l_tax") > 0.04).cast("long")).alias("effective"), F.countDistinct("l_linenumber").alias("grid"), F.countDistinct("l_linestatus").alias("cameras"))
    for c in ("rank", "condition", "hull", "diversity", "support", "parallax", "matchability"):
        g = g.withColumn(c, F.lit(None).cast("double"))
    return D.diagnose(g).select("k", F.array_join("codes", ",").alias("codes"), F.element_at("codes", 1).alias("first_code"))


@query("""SELECT least(o_custkey % 300, o_orderkey % 300) AS a, greatest(o_custkey % 300, o_orderkey % 300) AS b, max(o_totalprice) AS score FROM orders WHERE o_custkey % 300 <> o_orderkey % 300 GROUP BY 1, 2""")
def undirected_best_edges(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "orders").select((F.col("o_custkey") % 300).alias("a"), (F.col("o_orderkey") % 300).alias("b"), F.col("o_totalprice").alias("score"))
    return N.undirected_best(e)


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    return W.first_wins(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""SELECT x.vec_id AS q, y.vec_id AS r, round(sqrt(list_sum([(x.embedding[i]::DOUBLE - y.embedding[i]::DOUBLE) ** 2 FOR i IN range(1, len(x.embedding) + 1)])), 7) AS l2 FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1""")
def vector_distance(spark: SparkSession, d: str) -> DataFrame:
    v = A.vectors(spark, d)
    q = v.select(F.col("vec_id").alias("q"), (F.col("vec_id") + 1).alias("r"), F.col("embedding").alias("_q"))
    return q.join(v.select(F.col("vec_id").alias("r"), "embedding"), "r").select("q", "r", F.round(E.l2("_q", "embedding"), 7).alias("l2"))


@query("SELECT c_custkey, bit_count(xor(c_custkey::BIGINT, (c_custkey * 7919)::BIGINT))::BIGINT AS bits FROM customer")
def hamming_distance(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", E.hamming("c_custkey", F.col("c_custkey") * 7919).cast("long").alias("bits"))


@query("SELECT p_partkey, CASE WHEN a >= 0.6 AND b >= 2 AND c <= 0.02 THEN 'ADMIT' ELSE 'REJECT' END AS decision FROM (SELECT p_partkey, p_size / 50.0::DOUBLE AS a, CASE WHEN p_partkey % 5 > 0 THEN p_partkey % 4 END AS b, (p_partkey % 9) / 200.0::DOUBLE AS c FROM part)")
def fringe_admission(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", G.admission(F.col("p_size") / 50, F.when(k % 5 > 0, k % 4), (k % 9) / 200).alias("decision"))


@query("""WITH h AS (SELECT user_id AS x, event_type AS y, value / 500 AS health, event_id AS yaw FROM events) SELECT x, y, round(max(health), 9) AS best, round(avg(health), 9) AS mean, round(min(health), 9) AS worst FROM h GROUP BY 1, 2""")
def heat_positions(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "events").select(F.col("user_id").alias("x"), F.col("event_type").alias("y"), (F.col("value") / 500).alias("health"), F.col("event_id").alias("yaw_deg"))
    return D.heat_positions(h, ("x", "y")).select("x", "y", *[F.round(c, 9).alias(c) for c in ("best", "mean", "worst")])


@query("""SELECT event_id, CASE WHEN b >= 0.45 THEN 'MAP_LIMITED' WHEN s >= 0.45 AND s - b >= 0.05 THEN 'ORIENTATION_LIMITED' WHEN s >= 0.45 THEN 'MARGINAL' ELSE 'HEALTHY' END AS limitation FROM (SELECT event_id, least(1, value / 97) AS s, least(1, value / 97) - (event_id % 13) / 101.0::DOUBLE AS b FROM events WHERE value IS NOT NULL)""")
def route_limitations(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("value is not null").select("event_id", F.expr("least(1.0D, value / 97)").alias("s"), F.expr("least(1.0D, value / 97) - (event_id % 13) / 101").alias("b"))
    return e.select("event_id", D.limitation("s", "b").alias("limitation"))


@query(f"""WITH RECURSIVE e AS MATERIALIZED ({A.PART_EDGES_SQL}), u AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), r(source, node, hops) AS (SELECT range, range, 0 FROM range(1, 4) UNION SELECT r.source, u.b, r.hops + 1 FROM r JOIN u ON u.a = r.node WHERE r.hops < 3) SELECT source, node, min(hops) AS hops FROM r GROUP BY 1, 2""")
def hop_distances(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.graph import hop_distances as hops

    sources = spark.createDataFrame([(1,), (2,), (3,)], "node long")
    return hops(A.part_edges(spark, d), sources, 3)


@query()
def calibration_cross_fit(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.kernels import cross_fit

    return cross_fit(A.risks(spark, d), "risk", "failed", "user_id")


@query()
def safe_operating_points(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.kernels import safe_operating_points as points

    return points(W.risk_coverage(A.risks(spark, d), "risk", "failed"), (0.1, 0.2, 0.3))


@query()
def query_consensus(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.kernels import query_consensus as consensus

    h = A.places(spark, d).select(F.col("label").alias("query_id"), "x", "y", "z", F.lit(None).cast("array<double>").alias("covariance"))
    return consensus(h)


@query()
def harmonic_models(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.kernels import harmonic_models as models

    e = table(spark, d, "events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 86400e6).alias("t"), "value")
    m = models(e, "user_id", "t", "value")
    return m.select("user_id", "mean", "n", F.size("components").alias("components"))
