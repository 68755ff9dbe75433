import pytest
from pyspark.sql import functions as F

from lumenmap.functions import exprs as E
from lumenmap.operators import gates as G

RESULT = "query string, success boolean, inliers double, inlier_ratio double, reproj_p90_px double, hull_coverage double, grid4_occupancy int, positive_depth_ratio double, pose_consensus double, x double, y double, z double"


def one(df, expr):
    return df.select(expr).first()[0]


@pytest.fixture
def results(spark):
    good = (50.0, 0.5, 1.0, 0.4, 10, 1.0, 0.9)
    rows = [("q1.jpg", True, *good, 0.0, 0.0, 0.0), ("q2.jpg", True, *good, 1.0, 0.0, 0.0), ("q3.jpg", True, 22.0, 0.20, *good[2:], 10.0, 0.0, 0.0), ("q4.jpg", False, None, None, None, None, None, None, None, 10.5, 0.0, 0.0)]
    return spark.createDataFrame(rows, RESULT)


def test_strict_benchmark_of_four(results):
    rows = G.with_failures(results)
    s = G.summarize(rows).first()
    assert (s["total"], s["raw_rate"], s["strict_rate"]) == (4, 0.75, 0.5)
    reasons = {r["query"]: r["reasons"] for r in rows.collect()}
    assert reasons["q3.jpg"] == ["low_inliers", "low_inlier_ratio"] and reasons["q4.jpg"] == ["localization_failed"]
    weak = G.cell_regions(rows).collect()
    assert len(weak) == 1 and weak[0]["failures"] == 2
    gain = {r["criterion"]: r["gain"] for r in G.leave_one_criterion(rows).collect()}
    assert all(v == 0 for v in gain.values())


def test_missing_metric_fails_only_if_required(results):
    gates = G.LocalizationGates(required=("pose_consensus",))
    got = {r["query"]: r["reasons"] for r in G.with_failures(results.withColumn("pose_consensus", F.lit(None).cast("double")), gates).collect()}
    assert got["q1.jpg"] == ["missing_pose_consensus"]
    assert {r["query"]: r["reasons"] for r in G.with_failures(results.drop("pose_consensus"), gates).collect()}["q1.jpg"] == ["missing_pose_consensus"]


def test_comparison(spark, results):
    base = G.with_failures(results.withColumn("success", F.col("query") != "q4.jpg"))
    candidate = G.with_failures(results.withColumn("success", F.col("query") != "q2.jpg").withColumn("inliers", F.lit(50.0)).withColumn("inlier_ratio", F.lit(0.5)))
    rows = G.compare(base, candidate)
    change = {r["query"]: r["change"] for r in rows.collect()}
    assert change == {"q1.jpg": "common_success", "q2.jpg": "newly_failed", "q3.jpg": "newly_recovered", "q4.jpg": "newly_recovered"}
    gate = G.comparison_gate(rows).first()
    assert gate["status"] == "FAIL" and gate["failed_gates"] == ["new_failures"]
    manifest = spark.createDataFrame([("q1.jpg",), ("q9.jpg",)], "query string")
    assert {r["query"]: r["change"] for r in G.compare(base, candidate, manifest).collect()} == {"q1.jpg": "common_success", "q9.jpg": "common_failure"}
    assert G.comparison_gate(G.compare(base.limit(0), candidate.limit(0))).first()["status"] == "FAIL"


def test_validation(results):
    assert G.validate_results(results).count() == 4
    with pytest.raises(Exception, match="out of domain"):
        G.validate_results(results.withColumn("inlier_ratio", F.lit(1.5))).collect()


def test_wilson_and_status(spark):
    df = spark.createDataFrame([(0, 0), (4, 10), (0, 50), (9, 10)], "f int, n int")
    low, high = E.wilson("f", "n")
    rows = df.select("f", "n", low.alias("l"), high.alias("h")).withColumn("s", E.region_status("n", "f", "l", "h")).collect()
    assert (rows[0]["l"], rows[0]["h"]) == (0, 1)
    assert rows[1]["l"] == pytest.approx(0.1682, abs=1e-4) and rows[1]["h"] == pytest.approx(0.6873, abs=1e-4)
    assert [r["s"] for r in rows] == ["INSUFFICIENT_EVIDENCE", "UNCERTAIN", "HEALTHY", "WEAK"]


def test_parse_bool(spark):
    df = spark.createDataFrame([("Yes",), (" fail ",), (None,)], "v string")
    assert [r[0] for r in df.select(E.parse_bool("v")).collect()] == [True, False, None]
    with pytest.raises(Exception, match="not a boolean"):
        spark.createDataFrame([("maybe",)], "v string").select(E.parse_bool("v")).collect()


def test_session_edges(spark):
    cols = "name string, num_verified_pairs int, num_shared_tracks int, independent_bridge_groups int, rotation_consensus_deg double, translation_direction_consensus_deg double, scale_consensus double, cross_session_reprojection_error double, holdout_inlier_ratio double"
    rows = [("strong", 20, 90, 3, 1.0, 2.0, 0.01, 1.0, 0.9), ("alone", 0, 90, 3, 1.0, 2.0, 0.01, 1.0, 0.9), ("nan", 20, 90, 3, float("nan"), 2.0, 0.01, 1.0, 0.9), ("twisted", 20, 90, 3, 30.0, 2.0, 0.01, 1.0, 0.9), ("one group", 20, 90, 1, 1.0, 2.0, 0.01, 1.0, 0.9)]
    status, reasons = G.session_edge()
    got = {r["name"]: r["s"] for r in spark.createDataFrame(rows, cols).select("name", status.alias("s"), reasons.alias("r")).collect()}
    assert got == {"strong": "STRONG", "alone": "REJECT", "nan": "WEAK", "twisted": "AMBIGUOUS", "one group": "USABLE"}


def test_fail_closed_decisions(spark):
    df = spark.createDataFrame([(0.9, 3.0, 0.0), (0.9, None, 0.0), (float("nan"), 3.0, 0.0)], "h double, b double, d double")
    assert [r[0] for r in df.select(G.admission("h", "b", "d")).collect()] == ["ADMIT", "REJECT", "REJECT"]
    receipts = G.check_receipts(df, {"h": ("h", ">=", 0.5), "b": ("b", ">=", 2.0)}).collect()
    assert [r["state"] for r in receipts] == ["PASS", "PASS", "PASS", "HARD_FAIL", "HARD_FAIL", "PASS"]


def test_snapshot_and_chain(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "3")], "path string, sha256 string")
    b = spark.createDataFrame([("x", "1"), ("y", "9"), ("w", "4")], "path string, sha256 string")
    assert {tuple(r) for r in G.snapshot_changes(a, b).collect()} == {("y", "changed"), ("z", "missing"), ("w", "added")}
    gates = spark.createDataFrame([("r", 1, "a", None), ("r", 2, "b", "a"), ("r", 3, "c", "x")], "run string, stage int, digest string, previous string")
    assert [r["stage"] for r in G.chain_breaks(gates, "stage").collect()] == [3]


def test_geometry(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0, 0.0, 90.0, 0.0)], "w double, x double, y double, z double, yaw double, pitch double")
    identity = E.rotation_of_quaternion("w", "x", "y", "z")
    assert one(df, identity) == [1, 0, 0, 0, 1, 0, 0, 0, 1]
    turned = E.rotation_of_quaternion(F.sqrt(F.lit(0.5)), F.lit(0.0), F.lit(0.0), F.sqrt(F.lit(0.5)))
    assert one(df, E.rotation_angle_deg(identity, turned)) == pytest.approx(90)
    assert one(df, E.camera_centre(turned, F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)))) == pytest.approx([0, 1, 0])
    r = one(df, E.yaw_pitch_rotation("yaw", "pitch"))
    assert [r[2], r[5], r[8]] == pytest.approx([0, 1, 0], abs=1e-12)
    assert one(df, E.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0)))) is None
    assert one(df, E.jaccard(F.array().cast("array<int>"), F.array().cast("array<int>"))) == 1.0
    i, j = E.pair_ids(F.lit(2147483647 * 5 + 9))
    assert df.select(i, j).first() == (5, 9)
    assert E.min_units_without_failure(0.05) == 59
