import pytest
from pyspark.sql import functions as F

from lumenmap.operators import diagnosis as D
from lumenmap.operators import sessions as Z


def test_lattice(spark):
    box = spark.createDataFrame([(0.0, 1.0, 0.0, 0.5, 2.0, 2.0)], "x0 double, x1 double, y0 double, y1 double, z0 double, z1 double")
    got = {tuple(r) for r in D.lattice(box, 0.5).collect()}
    assert got == {(x, y, 2.0) for x in (0.0, 0.5, 1.0) for y in (0.0, 0.5)}
    with pytest.raises(Exception, match="over 3 points"):
        D.lattice(box, 0.5, 3).collect()
    assert D.orientations(D.lattice(box, 0.5)).count() == 18


def test_visibility(spark):
    identity = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    poses = spark.createDataFrame([(1, 0.0, 0.0, 0.0, identity)], "pose_id long, x double, y double, z double, r_wc array<double>")
    points = spark.createDataFrame([(1, 0.0, 0.0, 5.0), (2, 0.0, 0.0, -5.0), (3, 50.0, 0.0, 5.0), (4, 4.0, 0.0, 5.0), (5, 5.0, 0.0, 5.0)], "point_id long, x double, y double, z double")
    got = {r["point_id"]: r for r in D.visible(poses, points, "pose_id", "point_id").collect()}
    assert set(got) == {1, 4} and got[1]["u"] == 500 and got[4]["u"] == 980


def test_codes(spark):
    cols = "visible double, effective double, rank int, condition double, grid double, hull double, diversity double, cameras int, support double, parallax double, matchability double"
    rows = [(100.0, 90.0, 6, 10.0, 12.0, 0.5, 0.2, 9, 0.9, 0.9, 0.9), (0.0, 0.0, 0, None, 0.0, 0.0, None, 0, 0.0, 0.0, None), (100.0, 90.0, 6, 1e9, 2.0, 0.5, 0.2, 9, 0.9, 0.9, 0.9)]
    got = D.diagnose(spark.createDataFrame(rows, cols)).collect()
    assert [r["primary"] for r in got] == ["HEALTHY", "OUTSIDE_MAP", "ILL_CONDITIONED"]
    assert got[2]["codes"] == ["ILL_CONDITIONED", "LOW_COVERAGE"]


def test_route_over_a_constant_lattice(spark):
    heat = [(i * 10 + k, float(i), 0.0, 0.0, float(45 * (k - 1)), h) for i in range(11) for k, h in enumerate((0.2, 0.9 if i < 5 else 0.3, 0.2))]
    heat = spark.createDataFrame(heat, "pose_id long, x double, y double, z double, yaw_deg double, health double")
    route = spark.createDataFrame([("r", 0, 0.0, 0.0, 0.0), ("r", 1, 10.0, 0.0, 0.0), ("far", 0, 500.0, 0.0, 0.0), ("far", 1, 501.0, 0.0, 0.0)], "route_id string, seq int, x double, y double, z double")
    got = D.audit_route(route, heat)
    rows = [r for r in got["samples"].orderBy("s").collect() if r["route_id"] == "r"]
    assert len(rows) == 21 and all(r["selected_yaw_deg"] == 0 for r in rows)
    assert rows[0]["status"] == "HEALTHY" and rows[-1]["status"] == "MAP_LIMITED"
    seg = got["segments"].collect()
    assert len(seg) == 1 and seg[0]["last"] == 10.0 and seg[0]["max_risk"] == pytest.approx(0.7)
    summary = {r["route_id"]: r for r in got["summary"].collect()}
    assert summary["r"]["length"] == pytest.approx(10) and summary["r"]["supported"] == 1 and summary["far"]["supported"] == 0
    spots = D.heat_positions(heat).where("x = 0").first()
    assert (spots["best"], spots["worst"], spots["best_yaw_deg"]) == (0.9, 0.2, 0.0)


def test_markers(spark):
    poses = spark.createDataFrame([(0.0, 0.0, 0.0, 0.9, 50, 6, 1.0), (0.0, 0.0, 0.0, 0.3, 50, 6, 1e9), (1.0, 0.0, 0.0, 0.1, 0, 3, None)], "x double, y double, z double, health double, visible int, rank int, condition double")
    got = {(r["kind"], r["x"]) for r in D.heat_markers(poses).collect()}
    assert got == {("fim_weak", 0.0), ("direction_sensitive", 0.0), ("coverage_hole", 1.0), ("fim_rank_deficient", 1.0)}
    cols = "query string, success boolean, status string, decision string, x double, y double, z double, proxy_x double, proxy_y double, proxy_z double"
    rows = [("a", True, None, None, 1.0, 1.0, 1.0, None, None, None), ("b", True, "DIRECT_WEAK", "ACCEPT", 1.0, 1.0, 1.0, None, None, None), ("c", False, None, None, None, None, None, 2.0, 2.0, 2.0), ("d", False, "X", "PROVISIONAL", 3.0, 3.0, 3.0, None, None, None)]
    assert {(r["query"], r["kind"]) for r in D.localization_markers(spark.createDataFrame(rows, cols)).collect()} == {("b", "weak"), ("c", "retrieval_proxy"), ("d", "provisional")}
    line = spark.createDataFrame([("s", i, float(i) if i < 8 else 100.0 + i, 0.0, 0.0) for i in range(12)], "s string, i int, x double, y double, z double")
    assert [r["i"] for r in D.trajectory_jumps(line, ["s"], "i").collect()] == [8]
    box = D.clip_box(spark.createDataFrame([(float(i % 7), 0.0, 0.0) for i in range(300)] + [(1e4, 0.0, 0.0)], "x double, y double, z double"))
    assert box.where("not inside").count() == 1


EDGE = {"num_verified_pairs": 20.0, "num_shared_tracks": 90.0, "independent_bridge_groups": 3.0, "rotation_consensus_deg": 1.0, "translation_direction_consensus_deg": 2.0, "scale_consensus": 0.01, "cross_session_reprojection_error": 1.0, "holdout_inlier_ratio": 0.9}


def test_layers_of_edges(spark):
    retrieval = spark.createDataFrame([("b", "a", 40.0), ("a", "c", 9.0)], "session_a string, session_b string, num_candidates double")
    probe = spark.createDataFrame([("a", "b", *EDGE.values())], "session_a string, session_b string, " + ", ".join(f"{k} double" for k in EDGE))
    got = {r["session_b"]: r for r in Z.merge_edges([retrieval, probe]).collect()}
    assert got["b"]["status"] == "STRONG" and got["b"]["num_candidates"] == 40 and got["c"]["status"] == "REJECT"
    rel = {r["session_b"]: r["r"] for r in Z.merge_edges([retrieval, probe]).select("session_b", Z.reliability().alias("r")).collect()}
    assert 0.7 < rel["b"] < 1 and rel["c"] == 0
    roles = {r["session"]: r["role"] for r in Z.roles(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "session string"), Z.merge_edges([retrieval, probe])).collect()}
    assert roles == {"a": "SUPPORT", "b": "SUPPORT", "c": "ISOLATED", "d": "ISOLATED"}


def test_bridges_and_tracks(spark):
    pairs = spark.createDataFrame([("a", "b", 0, 0), ("a", "b", 10, 12), ("a", "b", 35, 30), ("a", "b", 500, 500), ("a", "b", 502, 900)], "session_a string, session_b string, frame_a int, frame_b int")
    groups = {}
    for r in Z.bridge_groups(pairs).collect():
        groups.setdefault(r["bridge"], set()).add(r["frame_a"])
    assert sorted(map(sorted, groups.values())) == [[0, 10, 35], [500], [502]]
    tracks = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 1)], "point3d_id long, image_id long")
    images = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "image_id long, session string")
    assert [tuple(r) for r in Z.shared_tracks(tracks, images).collect()] == [("a", "b", 1, 2, 1)]


def test_relative_quality_and_utility(spark):
    cols = "query string, inliers double, inlier_ratio double, hull_coverage double, grid4_occupancy double, pose_consensus double, positive_depth_ratio double, reproj_p90_px double"
    rows = [("best", 90.0, 0.9, 0.9, 16.0, 0.9, 1.0, 0.5), ("worst", 10.0, 0.1, 0.1, 1.0, 0.1, 0.5, 5.0), ("part", 90.0, None, None, None, None, None, None)]
    got = {r["query"]: r for r in Z.relative_quality(spark.createDataFrame(rows, cols)).collect()}
    assert got["best"]["quality"] > got["part"]["quality"] > got["worst"]["quality"] and got["part"]["completeness"] == pytest.approx(0.2 / 0.85)
    terms = spark.createDataFrame([("a", 1.0, 0.5), ("b", 0.2, 1.0)], "session string, coverage double, risk double")
    for k in Z.UTILITY:
        if k not in terms.columns:
            terms = terms.withColumn(k, F.lit(0.0))
    assert {r["session"]: r["delta"] for r in Z.leave_one_out(terms).collect()} == pytest.approx({"a": 0.25, "b": -1.3})
    odd = spark.createDataFrame([("a", str(i), 1.0 + i * 0.01) for i in range(20)] + [("a", "z", 9.0)], "session_a string, session_b string, v double")
    assert [r["session_b"] for r in Z.feature_anomalies(odd, ["v"]).where("anomalous").collect()] == ["z"]
