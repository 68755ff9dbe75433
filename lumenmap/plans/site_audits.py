"""Queries of site audits: suppliers and parts stand in for images and sequences, orders and events for pairs and observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import site_audits as S
from . import analogues as A
from .recapture import _cols, _rounded
from .registry import query, table

_IMAGES = "SELECT c_custkey AS image, c_nationkey AS sequence FROM customer"
_PAIRS = "SELECT DISTINCT least(o_custkey, o_orderkey % 1400) AS a, greatest(o_custkey, o_orderkey % 1400) AS b FROM orders WHERE o_custkey <> o_orderkey % 1400 AND o_custkey IN (SELECT c_custkey FROM customer) AND o_orderkey % 1400 IN (SELECT c_custkey FROM customer)"
_CLOSURE = f"r AS (SELECT c_custkey AS n, c_custkey AS m FROM customer UNION SELECT r.n, x.b FROM r JOIN (SELECT a, b FROM ({_PAIRS}) UNION ALL SELECT b, a FROM ({_PAIRS})) x ON r.m = x.a)"


def _images(spark: SparkSession, d: str) -> DataFrame:
    return _cols(table(spark, d, "customer"), image="c_custkey", sequence="c_nationkey")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return _cols(table(spark, d, "orders"), a="o_custkey", b="o_orderkey % 1400")


@query(f"""WITH e AS ({_PAIRS}), g AS (SELECT i, count(*) AS k FROM (SELECT a AS i FROM e UNION ALL SELECT b FROM e) GROUP BY 1), s AS (SELECT count(*) AS images, count(*) FILTER (k IS NULL) AS isolated, median(coalesce(k, 0))::DOUBLE AS median_degree FROM customer LEFT JOIN g ON i = c_custkey),
  x AS (SELECT count(*) AS pairs, count(*) FILTER (p.c_nationkey <> q.c_nationkey) AS cross_pairs FROM e JOIN customer p ON a = p.c_custkey JOIN customer q ON b = q.c_custkey) SELECT *, isolated = 0 AND median_degree >= 2 AND cross_pairs > 0 AS passed_but_components FROM s, x""")
def pair_graph_gate(spark: SparkSession, d: str) -> DataFrame:
    """Without the components, whose closure is slow in SQL; tests hold them against brute force."""
    got = S.pair_graph_gate(S.pair_graph(_images(spark, d), _pairs(spark, d)), 2.0)
    return got.select("images", "isolated", "median_degree", "pairs", "cross_pairs", (F.col("passed") | ((F.col("components") != 1) & (F.col("isolated") == 0) & (F.col("median_degree") >= 2) & (F.col("cross_pairs") > 0))).alias("passed_but_components"))


_SEQ = "SELECT s_suppkey AS sequence, CASE WHEN s_suppkey % 3 = 0 THEN 'reverse' ELSE 'forward' END AS direction FROM supplier"
_SEQ_EDGES = "SELECT DISTINCT least(l_suppkey, (l_suppkey + l_partkey % 4 * 5) % 100) AS a, greatest(l_suppkey, (l_suppkey + l_partkey % 4 * 5) % 100) AS b FROM lineitem WHERE l_partkey % 4 > 0 AND l_partkey % 9 < 2 AND (l_suppkey + l_partkey % 4 * 5) % 100 IN (SELECT s_suppkey FROM supplier)"


@query(f"""WITH RECURSIVE e AS MATERIALIZED (SELECT a, b FROM ({_SEQ_EDGES}) WHERE (a % 3 = 0) = (b % 3 = 0) OR (a + b) % 4 >= 2), u AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), r AS (SELECT s_suppkey AS n, s_suppkey AS m FROM supplier UNION SELECT r.n, u.b FROM r JOIN u ON r.m = u.a), c AS (SELECT n, min(m) AS m FROM r GROUP BY 1)
  SELECT round(max(k) / sum(k), 9) AS share FROM (SELECT m, count(*) AS k FROM c GROUP BY 1)""")
def robust_sequence_share(spark: SparkSession, d: str) -> DataFrame:
    s = _cols(table(spark, d, "supplier"), sequence="s_suppkey", direction="if(s_suppkey % 3 = 0, 'reverse', 'forward')")
    e = _cols(table(spark, d, "lineitem").where("l_partkey % 4 > 0 and l_partkey % 9 < 2"), a="l_suppkey", b="(l_suppkey + l_partkey % 4 * 5) % 100").distinct()
    bridges = e.select("a", "b", ((F.col("a") + F.col("b")) % 4).alias("count")).withColumns({"_l": F.least("a", "b"), "_h": F.greatest("a", "b")}).select(F.col("_l").alias("a"), F.col("_h").alias("b"), "count").distinct()
    return S.robust_sequence_share(s, e, bridges).select(F.round("share", 9).alias("share"))


@query(f"""WITH RECURSIVE e AS MATERIALIZED (SELECT * FROM ({_SEQ_EDGES}) WHERE (a + b) % 3 > 0), u AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), r AS (SELECT s_suppkey AS n, s_suppkey AS m FROM supplier UNION SELECT r.n, u.b FROM r JOIN u ON r.m = u.a), c AS (SELECT n, min(m) AS m FROM r GROUP BY 1), t AS (SELECT m FROM c GROUP BY 1 ORDER BY count(*) DESC, m LIMIT 1)
  SELECT a, b FROM e WHERE a IN (SELECT n FROM c WHERE m = (FROM t)) AND b IN (SELECT n FROM c WHERE m = (FROM t))""")
def pairs_of_largest(spark: SparkSession, d: str) -> DataFrame:
    i = _cols(table(spark, d, "supplier"), image="s_suppkey")
    e = _cols(table(spark, d, "lineitem").where("l_partkey % 4 > 0 and l_partkey % 9 < 2"), a="l_suppkey", b="(l_suppkey + l_partkey % 4 * 5) % 100")
    e = e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().where("(a + b) % 3 > 0").join(i.select(F.col("image").alias("b")), "b", "left_semi")
    return S.pairs_of_largest(i, e).select("a", "b")


@query("""WITH p AS (SELECT user_id, event_id, (event_id % 23) / 40.0::DOUBLE AS x, (event_id % 29) / 50.0::DOUBLE AS y FROM events WHERE event_type = 'purchase') SELECT a.user_id, 1 + coalesce(max((abs(a.x - b.x) >= 0.41 AND abs(a.y - b.y) >= 0.41)::INT), 0) AS independent FROM p a LEFT JOIN p b ON a.user_id = b.user_id GROUP BY 1""")
def independent_bridges(spark: SparkSession, d: str) -> DataFrame:
    p = _cols(table(spark, d, "events").where("event_type = 'purchase'"), user_id="user_id", x="(event_id % 23) / 40", y="(event_id % 29) / 50")
    return S.independent_bridges(p, ["user_id"], 0.41)


@query("""WITH e AS (SELECT event_id, event_id % 300 AS t, event_id % 90 AS b, event_id % 300 + event_id % 170 AS n FROM events), k AS (SELECT *, greatest(0, ceil(n * 0.6) - t) AS lo, greatest(0, floor(t / 0.7 - t)) AS p, greatest(0, floor(t * 0.3 / 0.7)) AS s FROM e)
  SELECT event_id, CASE WHEN b = 0 THEN 0 WHEN lo <= least(b, p, s) THEN least(b, p, s) ELSE least(b, p) END::BIGINT AS target, b = 0 OR lo <= least(b, p, s) AS feasible FROM k""")
def bridge_keep_counts(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events"), event_id="event_id", t="event_id % 300", b="event_id % 90", n="event_id % 300 + event_id % 170")
    return e.select("event_id", S.bridge_keep_count("t", "b", "n", most_bridges=0.3, least_parallax=0.7, least_selected=0.6).alias("k")).select("event_id", "k.target", "k.feasible")


@query("""WITH f AS (SELECT user_id, event_id, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events WHERE value IS NOT NULL), q AS (SELECT *, least(n, greatest(5, ceil(n * 0.2)))::BIGINT AS q, row_number() OVER (PARTITION BY user_id ORDER BY v DESC, i) AS rk FROM f),
  g AS (SELECT *, rk <= greatest(1, q // 4) OR (CASE WHEN q = 1 THEN i = 0 ELSE len([k FOR k IN range(q) IF floor(k * (n - 1) / (q - 1) + 1e-9) = i]) > 0 END) AS pick FROM q), p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY v DESC, abs(i - n / 2), i) AS pl FROM g WHERE pick) SELECT user_id, event_id FROM p WHERE pl <= q""")
def temporal_cover(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("value is not null").select("user_id", "event_id", "value")
    return S.temporal_cover(e, "user_id", ["event_id"], "value", 0.2, 5).select("user_id", "event_id")


@query("SELECT vec_id AS camera, round(greatest(abs(embedding[1]::DOUBLE - 0.2) / 0.2, abs(embedding[2]::DOUBLE + 0.1) / 0.1), 7) AS focal_drift, round(greatest(abs(embedding[3]::DOUBLE), abs(embedding[4]::DOUBLE - 1)), 7) AS centre_drift_px FROM embeddings")
def intrinsics_drift(spark: SparkSession, d: str) -> DataFrame:
    c = A.vectors(spark, d).select(F.col("vec_id").alias("camera"), F.transform("embedding", lambda x: x.cast("double")).alias("params"))
    return _rounded(S.intrinsics_drift(c, [0.2, -0.1, 0.0, 1.0]), "focal_drift", "centre_drift_px")


@query("""WITH c AS (SELECT s_suppkey AS camera, s_nationkey AS kind FROM supplier), s AS (SELECT n_nationkey + 3 AS kind FROM nation) SELECT coalesce(c.kind, s.kind) AS kind, camera, CASE WHEN s.kind IS NULL THEN 'no seed' WHEN c.kind IS NULL THEN 'unused seed' END AS problem FROM c FULL JOIN s ON c.kind = s.kind""")
def restored_intrinsics(spark: SparkSession, d: str) -> DataFrame:
    c = _cols(table(spark, d, "supplier"), camera="s_suppkey", kind="s_nationkey", params="array(1.0D)")
    s = _cols(table(spark, d, "nation"), kind="n_nationkey + 3", params="array(2.0D)")
    return S.restore_intrinsics(c, s, ["kind"]).select("kind", "camera", "problem")


@query("""WITH r AS (SELECT label, embedding[1]::DOUBLE / n AS x, embedding[2]::DOUBLE / n AS y, embedding[3]::DOUBLE / n AS z FROM (SELECT *, sqrt(embedding[1]::DOUBLE ** 2 + embedding[2]::DOUBLE ** 2 + embedding[3]::DOUBLE ** 2) AS n FROM embeddings) WHERE vec_id % 7 = 0) SELECT a.label, round(degrees(acos(greatest(-1, least(1, min(a.x * b.x + a.y * b.y + a.z * b.z))))), 4) AS angle_deg FROM r a JOIN r b ON a.label = b.label GROUP BY 1""")
def ray_angles(spark: SparkSession, d: str) -> DataFrame:
    n = F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2)
    r = A.places(spark, d).where("vec_id % 7 = 0").select("label", *[(F.col(c) / n).alias(c) for c in "xyz"])
    return S.ray_angle(r, ["label"]).select("label", F.round("angle_deg", 4).alias("angle_deg"))


@query("""WITH o AS (SELECT l_suppkey AS image, l_partkey AS point, l_quantity - 2 AS depth, l_discount AS err FROM lineitem WHERE l_linenumber % 4 > 0 AND l_suppkey % 10 > 0), j AS (SELECT o.*, p_partkey IS NOT NULL AS there FROM o LEFT JOIN (SELECT p_partkey FROM part WHERE p_partkey % 50 > 0) ON p_partkey = point),
  a AS (SELECT count(*) AS observations, count(*) FILTER (NOT there) AS missing_points, count(*) FILTER (there AND depth <= 1e-12) AS invalid_depth, count(*) FILTER (there AND depth > 1e-12) AS residuals, round(avg(err) FILTER (there AND depth > 1e-12), 7) AS residual_mean, max(err) FILTER (there AND depth > 1e-12) AS residual_max FROM j), i AS (SELECT count(*) AS images, count(*) FILTER (s_suppkey % 10 > 0) AS registered FROM supplier), p AS (SELECT count(*) AS points, sum(p_size)::BIGINT AS track_elements, min(p_size) AS track_min, max(p_size) AS track_max FROM part WHERE p_partkey % 50 > 0)
  SELECT *, missing_points = 0 AND observations = track_elements AS consistent FROM a, i, p""")
def model_facts(spark: SparkSession, d: str) -> DataFrame:
    i = _cols(table(spark, d, "supplier"), image="s_suppkey", registered="s_suppkey % 10 > 0", x="s_acctbal", y="0.0D", z="0.0D")
    o = _cols(table(spark, d, "lineitem"), image="l_suppkey", point="if(l_linenumber % 4 > 0, l_partkey, null)", depth="l_quantity - 2", error="l_discount")
    p = _cols(table(spark, d, "part").where("p_partkey % 50 > 0"), point="p_partkey", x="p_retailprice", y="0.0D", z="1.0D", track_length="p_size")
    got = _rounded(S.model_facts(i, o, p), "residual_mean")
    return got.select("observations", "missing_points", "invalid_depth", "residuals", "residual_mean", "residual_max", "images", "registered", "points", "track_elements", "track_min", "track_max", "consistent")


@query("""WITH r AS (SELECT event_id, (event_id % 21) / 20.0::DOUBLE AS f, (event_id % 19) / 18.0::DOUBLE AS b, event_id % 3 AS o, event_id % 5 AS fr, CASE WHEN event_id % 4 > 0 THEN event_id % 6 END AS br FROM events), k AS (SELECT *, o <= 1 AND fr <= 3 AS st, b < 0.9 AND f >= b AND fr <= coalesce(br, 3) AND o <= 1 AND fr <= 3 AS im FROM r)
  SELECT event_id, CASE WHEN f >= 0.9 THEN 'PASS' WHEN im THEN 'PASS_BASELINE_IMPROVED' ELSE 'FAIL' END AS result, st AND (f >= 0.9 OR im) AS ok FROM k""")
def holdout_gate(spark: SparkSession, d: str) -> DataFrame:
    r = _cols(table(spark, d, "events"), event_id="event_id", final_success="(event_id % 21) / 20", base_success="(event_id % 19) / 18", ok_to_fail="event_id % 3", final_run="event_id % 5", base_run="if(event_id % 4 > 0, event_id % 6, null)")
    return S.holdout_gate(r, success=0.9, most_ok_to_fail=1, most_run=3).select("event_id", "result", "ok")


@query("""WITH e AS (SELECT p_partkey AS edge, CASE WHEN p_partkey % 7 = 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM part), c AS (SELECT p_partkey AS edge, (p_partkey % 21)::BIGINT AS remaining FROM part WHERE p_partkey % 14 = 0) SELECT edge, CASE WHEN status = 'FAIL' AND remaining = 0 THEN 'QUARANTINED' ELSE status END AS state, (SELECT count(*) FROM e WHERE status = 'PASS') >= 2 AND (SELECT count(*) FROM e LEFT JOIN c USING (edge) WHERE status = 'FAIL' AND coalesce(remaining, 1) <> 0) = 0 AS release FROM e LEFT JOIN c USING (edge)""")
def quarantine_verdicts(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "part"), edge="p_partkey", status="if(p_partkey % 7 = 0, 'FAIL', 'PASS')")
    return S.quarantine_verdict(e, _cols(table(spark, d, "part").where("p_partkey % 14 = 0"), edge="p_partkey", count="p_partkey % 21")).select("edge", "state", "release")


@query("SELECT user_id, aligned_with, rho, CASE WHEN rho > 0.4 THEN aligned_with ELSE 'ambiguous' END AS direction FROM (SELECT user_id, event_type AS aligned_with, max(value % 1) AS rho, row_number() OVER (PARTITION BY user_id ORDER BY max(value % 1) DESC, event_type) AS r FROM events WHERE value IS NOT NULL AND event_id % 17 = 0 GROUP BY 1, 2) WHERE r = 1")
def video_directions(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events").where("value is not null and event_id % 17 = 0"), user_id="user_id", anchor="event_type", rho="value % 1")
    return S.directions(e.groupBy("user_id", "anchor").agg(F.max("rho").alias("rho")), ["user_id"])


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'NONE' WHEN (event_id % 30) / 100.0 < 0.1 THEN 'RARE' ELSE 'ENOUGH' END AS verdict FROM events")
def retrieval_verdicts(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events"), event_id="event_id", s="(event_id % 30) / 100", m="event_id % 4")
    return e.select("event_id", S.retrieval_verdict("s", "m").alias("verdict"))


@query("SELECT c_custkey AS result, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_nationkey < 20 THEN c_nationkey END AS identity FROM customer")
def resolved_identities(spark: SparkSession, d: str) -> DataFrame:
    video = "case when c_custkey % 5 = 0 then null when c_custkey % 5 = 1 then concat('NATION_', c_nationkey) when c_custkey % 5 = 2 then concat('a/b/NATION_', c_nationkey, '.mp4') when c_custkey % 5 = 3 then concat(' x/NATION_', c_nationkey, ' ') end"
    c = _cols(table(spark, d, "customer"), result="c_custkey", video_id="if(c_custkey % 2 = 0, '', 'unknown')", seq=video, source="if(c_custkey % 5 = 4, concat('NATION_', c_nationkey, '.mov'), null)")
    return S.resolve_identity(c, _cols(table(spark, d, "nation").where("n_nationkey < 20"), alias="n_name", identity="n_nationkey"), ["video_id", "seq", "source"])


@query("SELECT count(*) AS trusted, count(*) FILTER (NOT (p_size % 3 = 2 AND p_partkey % 9 >= 3)) AS invalid, CASE WHEN count(*) FILTER (NOT (p_size % 3 = 2 AND p_partkey % 9 >= 3)) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM part")
def route_cluster_audit(spark: SparkSession, d: str) -> DataFrame:
    return S.route_clusters(_cols(table(spark, d, "part"), edge="p_partkey", clusters="p_size % 3", separation="0.25D", least_cluster="p_partkey % 9"))


@query("WITH s AS (SELECT n_nationkey AS k FROM nation), e AS (SELECT DISTINCT s_suppkey % 25 AS f, s_nationkey AS r, s_suppkey % 3 AS n FROM supplier WHERE s_suppkey < 60) SELECT x.k AS forward, y.k AS reverse, CASE WHEN n IS NULL THEN 'PENDING' WHEN n < 2 THEN 'MISSING' ELSE 'PROVEN' END AS state FROM s x JOIN s y ON x.k % 2 = 0 AND y.k % 2 = 1 LEFT JOIN e ON e.f = x.k AND e.r = y.k")
def gap_policy(spark: SparkSession, d: str) -> DataFrame:
    s = _cols(table(spark, d, "nation"), sequence="n_nationkey", direction="if(n_nationkey % 2 = 0, 'forward', 'reverse')")
    return S.gap_policy(s, _cols(table(spark, d, "supplier").where("s_suppkey < 60"), forward="s_suppkey % 25", reverse="s_nationkey", independent="s_suppkey % 3").distinct())


@query("""SELECT event_id, array_to_string([c FOR c IN [CASE WHEN NOT ((bf - nf) / bf >= 0.1 - 1e-12) THEN 'failed_edges' END, CASE WHEN NOT (CASE WHEN bo > 0 THEN (no_ - bo) / bo <= 0.1 + 1e-12 ELSE no_ = 0 END) THEN 'other_edges' END, CASE WHEN NOT (br - nr <= 0.01 + 1e-12) THEN 'registration' END, CASE WHEN al <> 0 THEN 'alone' END] IF c IS NOT NULL], ',') AS failed
  FROM (SELECT event_id, 1 + event_id % 9 AS bf, event_id % 8 AS nf, event_id % 5 AS bo, event_id % 7 AS no_, 0.95::DOUBLE AS br, 0.9 + (event_id % 10) / 100.0::DOUBLE AS nr, event_id % 3 AS al FROM events)""")
def promotion_checks(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events"), event_id="event_id", base_failed_score="1 + event_id % 9", new_failed_score="event_id % 8", base_other_score="event_id % 5", new_other_score="event_id % 7", base_registration="0.95D", new_registration="0.9D + (event_id % 10) / 100", new_alone="event_id % 3")
    return e.select("event_id", F.array_join(S.promotion_checks(), ",").alias("failed"))


@query("""WITH b AS (SELECT p_partkey AS key, p_brand AS edge, p_size AS digest FROM part WHERE p_partkey % 11 > 0), a AS (SELECT p_partkey AS key, p_brand AS edge, CASE WHEN p_partkey % 6 = 0 THEN -1 ELSE p_size END AS digest FROM part WHERE p_partkey % 13 > 0) SELECT coalesce(b.key, a.key) AS key, coalesce(b.edge, a.edge) AS edge, coalesce(b.edge, a.edge) IN ('Brand#2', 'Brand#17') AS allowed FROM b FULL JOIN a ON a.key = b.key WHERE a.digest IS DISTINCT FROM b.digest""")
def changed_outside(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    b = _cols(p.where("p_partkey % 11 > 0"), key="p_partkey", edge="p_brand", digest="p_size")
    a = _cols(p.where("p_partkey % 13 > 0"), key="p_partkey", edge="p_brand", digest="if(p_partkey % 6 = 0, -1, p_size)")
    return S.changed_outside(b, a, spark.createDataFrame([("Brand#2",), ("Brand#17",)], "edge string"))


@query("SELECT n_nationkey AS a, n_regionkey AS b FROM nation WHERE n_nationkey % 3 = 0 OR n_nationkey % 4 = 1")
def failing_edges(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    official = _cols(n, a="n_nationkey", b="n_regionkey")
    return S.failing_edges(official, _cols(n.where("n_nationkey % 3 > 0"), a="n_nationkey", b="n_regionkey", status="if(n_nationkey % 4 = 1, 'FAIL', 'PASS')"))


@query("SELECT p_brand AS grp, bool_and(CASE WHEN p_size % 2 = 0 THEN true ELSE false END) AS passed FROM part WHERE p_brand IN ('Brand#2') GROUP BY 1 UNION ALL SELECT 'all pass', true")
def required_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").where("p_brand = 'Brand#2'")
    s = _cols(p, pair="p_partkey", status="if(p_size % 2 = 0, 'PASS', 'FAIL')", applicable="true", reason="string(null)", left_points="50", right_points="60", cells="9", coverage="0.5D", ratio="0.1D", maximum="0.2D")
    one = S.required_pairs_pass(s.select("pair"), s, points=20, cells=5, coverage=0.3, most=0.15).withColumn("grp", F.lit("Brand#2"))
    two = S.required_pairs_pass(s.select("pair"), s.withColumn("status", F.lit("PASS")), points=20, cells=5, coverage=0.3, most=0.15).withColumn("grp", F.lit("all pass"))
    return one.unionByName(two).select("grp", "passed")


@query("""WITH k AS (SELECT user_id, event_id, event_id % 50 = 7 OR event_id % 31 = 0 AS bad, CASE WHEN event_id % 31 > 0 THEN (event_id % 40) + 1.0 END AS sc FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY bad, sc DESC NULLS LAST, event_id) AS r, sum(bad::INT) OVER (PARTITION BY user_id)::BIGINT AS removed, count(*) OVER (PARTITION BY user_id) AS n FROM k) SELECT user_id, event_id AS "index", removed, n - removed > 40 AS clipped FROM r WHERE NOT bad AND r <= 40""")
def kept_keypoints(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events"), user_id="user_id", index="event_id", x="if(event_id % 50 = 7, 99999.0D, 5.0D)", y="6.0D", scale="if(event_id % 31 > 0, (event_id % 40) + 1.0D, double('NaN'))")
    return S.keep_keypoints(e, ["user_id"], 40, 10000.0)


@query("SELECT c_custkey AS path, CASE WHEN c_custkey % 9 = 0 THEN 'missing' ELSE 'changed' END AS problem FROM customer WHERE c_custkey % 9 = 0 OR c_custkey % 5 = 0")
def stale_inputs(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    now = c.where("c_custkey % 9 > 0").select(F.col("c_custkey").alias("path"), F.sha2(F.when(F.col("c_custkey") % 5 == 0, "x").otherwise(F.col("c_name")), 256).alias("sha256"))
    return S.stale_inputs(c.select(F.col("c_custkey").alias("path"), F.sha2("c_name", 256).alias("sha256")), now)


@query("SELECT c_nationkey, sha256(string_agg(c_name || chr(0) || sha256(c_mktsegment) || chr(0) || c_custkey || chr(10), '' ORDER BY c_name)) AS digest, count(*) AS files FROM customer GROUP BY 1")
def folder_digests(spark: SparkSession, d: str) -> DataFrame:
    c = _cols(table(spark, d, "customer"), c_nationkey="c_nationkey", path="c_name", sha256="sha2(c_mktsegment, 256)", size="c_custkey")
    return S.snapshot_digest(c, ["c_nationkey"])


@query("SELECT user_id, count(DISTINCT event_id % 12) = 12 AND bool_and(event_id % 10 = 0 OR (event_id % 12) // 4 = CASE WHEN event_id % 1009 = 5 THEN 9 ELSE (event_id % 12) // 4 END) AS ok FROM events GROUP BY 1")
def packed_cells(spark: SparkSession, d: str) -> DataFrame:
    e = _cols(table(spark, d, "events"), user_id="user_id", cell="event_id % 12", x="if(event_id % 10 = 0, double('NaN'), 1.0D)", cx="event_id % 4", cy="if(event_id % 1009 = 5, 9, floor(event_id % 12 / 4))")
    return S.packed_cells_ok(e, ["user_id"], 4, 12)
