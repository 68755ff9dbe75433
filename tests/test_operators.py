import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenmap.operators import evolution as V
from lumenmap.operators import graph as N
from lumenmap.operators import health as H
from lumenmap.operators import kernels as K
from lumenmap.operators import selection as L
from lumenmap.operators import spatial as S
from lumenmap.operators import windows as W


def tracks_of(spark, edges):
    """Weighted edges as tracks: w points for each edge, each seen by its two ends."""
    rows, p = [], 0
    for a, b, w in edges:
        for _ in range(w):
            rows += [(a, p), (b, p)]
            p += 1
    return spark.createDataFrame(rows, "image_id long, point3d_id long")


BARBELL = [(1, 2, 20), (2, 3, 20), (1, 3, 20), (3, 4, 16), (4, 5, 20), (5, 6, 20), (4, 6, 20), (7, 8, 30)]


def test_covisibility_and_fragility(spark):
    edges = N.covisibility(tracks_of(spark, BARBELL))
    assert {tuple(r) for r in edges.collect()} == set(BARBELL)
    nodes = spark.range(1, 10).withColumnRenamed("id", "node")
    comp = {r["node"]: r["component"] for r in N.components(nodes, edges).collect()}
    assert comp == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 7, 8: 7, 9: 9}
    report = {r["component"]: r for r in N.fragility(nodes, edges).collect()}
    assert report[1]["bridges"] == "[[3,4]]" and report[1]["articulation"] == "[3,4]" and 0 < report[1]["lambda2"] < 0.3
    assert report[7]["bridges"] == "[[7,8]]" and report[7]["lambda2"] == pytest.approx(2)
    sens = {r["threshold"]: r for r in N.threshold_sensitivity(nodes, edges, (15, 18, 25)).collect()}
    assert [sens[k]["components"] for k in (15, 18, 25)] == [3, 4, 8]
    assert {r["node"] for r in N.largest_component(N.components(nodes, edges)).collect()} == {1, 2, 3, 4, 5, 6}
    assert {r["node"]: r["degree"] for r in N.degrees(nodes, edges).collect()}[9] == 0


def test_triangles_and_triplets(spark):
    edges = N.covisibility(tracks_of(spark, BARBELL))
    assert {tuple(r) for r in N.triangles(edges).collect()} == {(1, 2, 3), (4, 5, 6)}
    assert all(r["triplet_score"] == 1 for r in N.triplet_support(edges).collect())
    turn = lambda deg: [math.cos(math.radians(deg)), -math.sin(math.radians(deg)), 0.0, math.sin(math.radians(deg)), math.cos(math.radians(deg)), 0.0, 0.0, 0.0, 1.0]
    rot = spark.createDataFrame([(1, 2, turn(10)), (2, 3, turn(20)), (1, 3, turn(37))], "a long, b long, rotation array<double>")
    assert all(r["max_cycle_error_deg"] == pytest.approx(7) for r in N.rotation_cycle_error(rot).collect())


def test_spanning_trees(spark):
    r = random.Random(1)
    edges = [(a, b, r.randint(1, 6)) for a in range(12) for b in range(a + 1, 12) if r.random() < 0.4]
    df = spark.createDataFrame(edges, "a long, b long, score long")
    parent = list(range(12))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    want = set()
    for a, b, w in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            want.add((a, b, w))
    got = N.k_spanning_trees(df, 2).collect()
    assert {(x["a"], x["b"], x["score"]) for x in got if x["tree"] == 1} == want
    assert not {(x["a"], x["b"]) for x in got if x["tree"] == 2} & {e[:2] for e in want}


def test_hops_and_knn(spark):
    line = spark.createDataFrame([(i, i + 1, 1) for i in range(5)], "a long, b long, score long")
    got = {r["node"]: r["hops"] for r in N.hop_distances(line, spark.createDataFrame([(0,)], "node long"), 3).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3}
    star = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 2.0), ("a", "d", 3.0), ("d", "d", 9.0)], "a string, b string, score double")
    assert {(r["a"], r["b"]) for r in N.knn_edges(star, 1).collect()} == {("a", "b"), ("a", "c"), ("a", "d")}


def test_spatial_joins_match_brute_force(spark):
    r = random.Random(2)
    pts = [(i, r.uniform(-3, 3), r.uniform(-3, 3), r.uniform(-3, 3)) for i in range(150)] + [(150, float("nan"), 0.0, 0.0), (151, None, 0.0, 0.0)]
    df = spark.createDataFrame(pts, "id long, x double, y double, z double")
    d = lambda a, b: math.dist(pts[a][1:], pts[b][1:])
    want = {(a, b) for a in range(150) for b in range(150) if d(a, b) <= 0.8}
    assert {(x["left_id"], x["right_id"]) for x in S.radius_pairs(df, df, "id", "id", "xyz", 0.8).collect()} == want
    near = S.nearest_within(df, df, "id", "id", "xyz", 0.8, k=3, exclude_self=True).collect()
    for a in range(150):
        best = sorted((d(a, b), b) for b in range(150) if b != a and d(a, b) <= 0.8)[:3]
        assert [b for _, b in best] == [x["right_id"] for x in sorted((x for x in near if x["left_id"] == a), key=lambda x: x["rank"])]
    spacing = H.nearest_spacing(df.where("id < 150"), "id", "xyz").first()
    assert spacing["p50"] == pytest.approx(np.median([min(d(a, b) for b in range(150) if b != a) for a in range(150)]))


def test_ranks_with_ties(spark):
    df = spark.createDataFrame([("g", v) for v in (1.0, 2.0, 2.0, 5.0, None)] + [("h", 3.0)] + [("t", 4.0)] * 3, "g string, v double")
    got = Counter((r["g"], r["v"], r["rank"]) for r in W.percentile_rank(df, "v", by=["g"]).collect())
    assert got == Counter([("g", 1.0, 0.0), ("g", 2.0, 0.5), ("g", 2.0, 0.5), ("g", 5.0, 1.0), ("g", None, None), ("h", 3.0, 1.0), ("t", 4.0, 0.5), ("t", 4.0, 0.5), ("t", 4.0, 0.5)])


def test_hysteresis_crosses_both_limits(spark):
    v = [0.1, 0.4, 0.46, 0.4, 0.36, 0.35, 0.44, 0.5, None, 0.36]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(v)], "g int, i int, r double")
    got = [r["weak"] for r in W.hysteresis(df, ["g"], ["i"], "r").orderBy("i").collect()]
    assert got == [False, False, True, True, True, False, False, True, True, True]
    with pytest.raises(ValueError):
        W.hysteresis(df, ["g"], ["i"], "r", 0.4, 0.4)
    assert W.longest_run(df.withColumn("f", F.col("r") >= 0.4), ["g"], ["i"], "f").first()["longest"] == 3


def test_selective_risk_with_ties(spark):
    rows = [(0.2, False)] * 2 + [(0.2, True)] + [(0.8, True), (0.8, False)]
    df = spark.createDataFrame(rows, "risk double, failed boolean")
    got = W.aurc(df, "risk", "failed").first()
    expected = [(k / 3) / k for k in (1, 2, 3)] + [(1 + j / 2) / (3 + j) for j in (1, 2)]
    assert got["aurc"] == pytest.approx(np.mean(expected))
    assert got["oracle_aurc"] == pytest.approx(np.mean([0, 0, 0, 1 / 4, 2 / 5]))
    assert W.auroc(df, "risk", "failed").first()[0] == pytest.approx((1 * 1 + 0.5 * 2 + 0.5 * 1 + 0 * 2 + 1 * 1) / 6)
    points = K.safe_operating_points(W.risk_coverage(df, "risk", "failed"), (0.02, 0.99)).collect()
    assert {r["target"]: r["coverage"] for r in points} == {0.02: 0.0, 0.99: 1.0}


def test_resampling(spark):
    df = spark.createDataFrame([("r", 0, 0.0, 0.0), ("r", 1, 3.0, 0.0), ("r", 2, 3.0, 0.0), ("r", 3, 3.0, 4.5)], "k string, o int, x double, y double")
    got = [(r["s"], r["x"], r["y"]) for r in W.resample_route(df, ["k"], "o", ["x", "y"], 2.0).orderBy("s").collect()]
    assert got == [(0.0, 0.0, 0.0), (2.0, 2.0, 0.0), (4.0, 3.0, 1.0), (6.0, 3.0, 3.0), (7.5, 3.0, 4.5)]


def test_merge_last_keeps_values(spark):
    df = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, 5), ("k", 3, None, None), ("m", 1, None, None)], "k string, o int, p string, q int")
    assert {tuple(r) for r in W.merge_last(df, ["k"], "o", ["p", "q"]).collect()} == {("k", "a", 5), ("m", None, None)}


def test_ledger_is_idempotent_and_takes_late_matches(spark):
    rows = [(1, "s1", True, True), (1, "s2", True, False), (1, "s3", True, False), (2, "s1", True, False), (2, "s2", False, False), (3, "s4", True, True)]
    cols = "point_id long, session string, visible boolean, matched boolean"
    once = {r["point_id"]: r for r in V.ledger(spark.createDataFrame(rows, cols)).collect()}
    twice = {r["point_id"]: r for r in V.ledger(spark.createDataFrame(rows[::-1] + rows, cols)).collect()}
    assert once == twice
    assert once[1]["state"] == "RETIRED" and once[1]["unmatched_streak"] == 2 and once[1]["stability"] == 0.25
    late = {r["point_id"]: r for r in V.ledger(spark.createDataFrame([*rows, (1, "s3", True, True)], cols)).collect()}
    assert late[1]["state"] == "ACTIVE" and late[1]["stability"] == 1.0


def test_lifting(spark):
    m = spark.createDataFrame([(1, "q", "r", 10.0, 10.0, 5.0, 5.0, 0.9), (2, "q", "r", 50.0, 50.0, 6.0, 6.0, 0.5), (3, "q", "r", 90.0, 90.0, 7.0, 7.0, 0.5)], "match_id long, query_id string, ref_id string, r_x double, r_y double, q_x double, q_y double, confidence double")
    o = spark.createDataFrame([("r", 10.5, 10.0, 1), ("r", 50.0, 50.9, 2), ("r", 50.0, 48.9, 3)], "image_id string, x double, y double, point3d_id long")
    got = V.lift_matches(m, o).collect()
    assert [(r["match_id"], r["point3d_id"]) for r in got] == [(1, 1)]  # the second is between two points, the third near none
    merged = V.merge_lifted(V.lift_matches(m, o)).first()
    assert merged["confidence"] == pytest.approx(0.9) and merged["references"] == 1


def test_feature_memory_clamps_in_order(spark):
    ev = [(1, float(t), "CORRECT") for t in range(8)] + [(1, 8.0, "INCORRECT")]
    got = V.feature_memory(spark.createDataFrame(ev[::-1], "feature_id long, ts double, event string")).first()
    assert got["score"] == pytest.approx(0.9) and got["last_ts"] == 8.0
    s = V.stability_fold(spark.createDataFrame([("a", 0.0, "geometric", 0.3), ("a", 0.0, "appearance", 0.3), ("a", -5.0, "geometric", 0.1)], "record string, ts double, kind string, value double")).first()
    assert s["state"] == "STABLE" and s["confirmations"] == 3


def test_distribution_and_hull(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(float("nan"),), (None,)], "v double")
    d = H.distribution(df, "v").first()
    assert (d["n"], d["med"], d["mad"], d["p10"], d["p90"]) == (11, 5, 3, 1, 9)
    assert H.hull_area(np.array([[0, 0], [4, 0], [4, 3], [0, 3], [2, 1]])) == 12
    assert H.hull_area(np.array([[0, 0], [1, 1]])) == 0


def test_information_of_rays(spark):
    r = np.random.default_rng(3)
    rays = r.normal(size=(40, 3))
    rays /= np.linalg.norm(rays, axis=1, keepdims=True)
    rows = [(1, u.tolist(), float(d), 1.0) for u, d in zip(rays, r.uniform(2, 5, 40))]
    f = H.bearing_information(spark.createDataFrame(rows, "pose long, ray array<double>, depth double, weight double"), ["pose"], "ray", "depth", "weight")
    want = np.zeros((6, 6))
    for _, u, d, w in rows:
        u = np.array(u)
        sk = np.array([[0, -u[2], u[1]], [u[2], 0, -u[0]], [-u[1], u[0], 0]])
        j = np.hstack([-sk, -(np.eye(3) - np.outer(u, u)) / d])
        want += w * j.T @ j / 0.002**2
    got = f.first()
    for a in range(6):
        for b in range(a, 6):
            assert got[f"f{a}{b}"] == pytest.approx(want[a, b], rel=1e-9, abs=1e-6)
    m = H.information_metrics(f, ["pose"]).first()
    assert m["rank"] == 6 and m["min_eigenvalue"] == pytest.approx(np.linalg.eigvalsh(want)[0], rel=1e-6)


def test_similarity_fits():
    r = np.random.default_rng(4)
    a = r.normal(size=(30, 3))
    q, _ = np.linalg.qr(r.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    b = 2.5 * a @ q.T + [1, 2, 3]
    s, rot, t = K.umeyama(a, b)
    assert s == pytest.approx(2.5) and np.allclose(rot, q) and np.allclose(t, [1, 2, 3])
    b[:10] += 50
    s, rot, t, inside = K.ransac_similarity(a, b, 0.01, 500)
    assert s == pytest.approx(2.5) and inside.sum() == 20
    with pytest.raises(ValueError):
        K.umeyama(np.outer(np.arange(5.0), [1, 1, 1]), b[:5])
    assert np.nanmax(K.leave_one_out_residuals(a[10:16], b[10:16])) < 1e-9


def test_align_groups(spark):
    rows = [("g", float(i), float(i * i), float(-i), 2.0 * i + 1, 2.0 * i * i, -2.0 * i) for i in range(6)] + [("line", float(i), 0.0, 0.0, float(i), 0.0, 0.0) for i in range(4)]
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, x double, y double, z double")
    got = {r["k"]: r for r in K.align(df, ["k"], ["a", "b", "c"], ["x", "y", "z"]).collect()}
    assert got["g"]["scale"] == pytest.approx(2) and got["g"]["shift"] == pytest.approx([1, 0, 0], abs=1e-9) and got["line"]["scale"] is None


def test_beta_bounds_and_calibration():
    assert K.beta_cdf(0.3, 2, 5) == pytest.approx(0.579825)
    assert K.upper_failure_bound(0, 59) == pytest.approx(1 - 0.05 ** (1 / 59))
    x, f, n = np.array([0.1, 0.2, 0.3, 0.4]), np.array([1, 0, 3, 2]), np.array([4, 4, 4, 4])
    ends, values = K.isotonic(x, f, n)
    assert ends.tolist() == [0.2, 0.4] and values.tolist() == [0.125, 0.625]
    p = np.linspace(0.05, 0.95, 19)
    w = K.beta_calibration(p, p * 1000, np.full(19, 1000.0))
    assert w == pytest.approx([1, 1, 0], abs=1e-3)


def test_cross_fit_chooses(spark):
    r = random.Random(5)
    rows = [(i, (p := r.choice([0.1, 0.3, 0.6, 0.9])), r.random() < p) for i in range(800)]
    got = K.cross_fit(spark.createDataFrame(rows, "g long, risk double, failed boolean"), "risk", "failed", "g").collect()
    assert len(got) == 3 and sum(x["chosen"] for x in got) == 1


def test_paths_and_consensus(spark):
    local = [np.array([0.0, 1.0]), np.array([1.0, 0.0]), np.array([0.0, 1.0])]
    assert K.best_path(local, [np.array([[0, 5], [5, 0]])] * 2) == [0, 0, 0]
    assert K.best_path(local, [np.zeros((2, 2))] * 2) == [0, 1, 0]
    rows = [("q", float(x), 0.0, 0.0, None) for x in (0.0, 0.01, -0.01, 5.0)] + [("alone", 1.0, 1.0, 1.0, None)]
    got = {r["query_id"]: r for r in K.query_consensus(spark.createDataFrame(rows, "query_id string, x double, y double, z double, covariance array<double>")).collect()}
    assert abs(got["q"]["x"]) < 0.2 and got["q"]["outliers"] == 1 and got["alone"]["x"] is None
    mean, parts = K.harmonic_fit(t := np.linspace(0, 20, 200), 0.5 + 0.2 * np.cos(2 * np.pi * t / 7), (7.0,), 1e-6)
    assert mean == pytest.approx(0.5, abs=1e-3) and parts[0][1] == pytest.approx(0.2, abs=1e-3)
    assert K.smooth_classes(["a", "a", "b", "a", "c", "pure_rotation"], 1) == ["a", "a", "a", "a", "c", "pure_rotation"]
    assert K.circular_two_means(np.array([1.0, -1, 0, 179, 181, 180]))["separation_deg"] == pytest.approx(180, abs=1)


def test_greedy_selections(spark):
    pairs = spark.createDataFrame([(0, "a", "b"), (1, "a", "c"), (2, "a", "d"), (3, "b", "c")], "i int, a string, b string").withColumn("g", F.lit(1))
    assert {r["i"] for r in L.degree_cap(pairs, ["g"], "a", "b", ["i"], 2).collect()} == {0, 1, 3}
    m = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.8), (2, 1, 0.85), (2, 2, 0.1)], "l int, r int, s double").withColumn("g", F.lit(1))
    assert {(x["l"], x["r"]) for x in L.unique_matches(m, ["g"], "l", "r", "s").collect()} == {(1, 1), (2, 2)}
    f = spark.createDataFrame([("s", i, h) for i, h in enumerate([0, 1, 255, 255, -1])], "session string, i int, h long")
    assert [r["i"] for r in L.keyframes(f, "session", "i", "h", 1, 4).orderBy("i").collect()] == [0, 2, 4]
    v = spark.createDataFrame([("g", i, x) for i, x in enumerate([[0.0], [1.0], [10.0], [1.1]])], "g string, id int, v array<double>")
    assert [r["id"] for r in L.rank_by_uniqueness(v, ["g"], "id", "v").orderBy("rank").collect()][:2] == [2, 0]
    c = spark.createDataFrame([("g", 1, [1, 2, 3], 0.0, 1.0), ("g", 2, [1, 2], 0.0, 1.0), ("g", 3, [9], 0.5, 5.0)], "g string, id int, cells array<int>, u double, c double")
    assert [r["id"] for r in L.cover(c, ["g"], "id", "cells", "u", "c", 2.0).orderBy("pick").collect()] == [1, 2]
    b = spark.createDataFrame([("x", 5.0), ("y", 3.0), ("z", 1.0)], "k string, w double")
    counts = {r["k"]: r["count"] for r in L.bridge_counts(b, "w", 10, "k").collect()}
    assert sum(counts.values()) == 10 and min(counts.values()) >= 1 and counts["x"] > counts["y"] > counts["z"]
    core = L.greedy_core([{"session": s, "quality": q} for s, q in (("a", 0.9), ("b", 0.8), ("c", 0.7), ("d", 0.99))], [{"a": "a", "b": "b", "status": "STRONG", "score": 1.0}, {"a": "b", "b": "c", "status": "WEAK", "score": 1.0}], 3)
    assert [s for s, _ in core] == ["a", "b"]


def test_fragility_takes_all_events(spark, tmp_path):
    from lumenmap.plans import QUERIES

    rows = [(1, "2024-01-01 01:00:00", 5.0), (2, "2024-01-01 09:00:00", 7.0), (2, "2024-01-02 09:00:00", 300.0), (3, "2024-01-02 10:00:00", 290.0), (4, "2024-01-03 10:00:00", 1.0), (5, "2024-01-03 11:00:00", 2.0), (6, "2024-01-04 11:00:00", 400.0)]
    spark.createDataFrame(rows, "user_id long, ts string, value double").selectExpr("user_id", "cast(ts as timestamp) as ts", "value").write.parquet(f"{tmp_path}/events.parquet")
    edges = {(a, b) for a, t, _ in rows for b, u, _ in rows if a < b and t[:10] == u[:10]}
    group = {r[0]: r[0] for r in rows}
    for _ in rows:
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    want = {(c, sum(g == c for g in group.values()), sum(group[a] == c for a, _ in edges)) for a, _ in edges for c in [group[a]]}
    got = QUERIES["graph_fragility"](spark, str(tmp_path)).collect()
    assert {(r["component"], r["nodes"], r["edges"]) for r in got} == want
