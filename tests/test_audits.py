import math

import pytest
from pyspark.sql import functions as F

from lumenmap.operators import audits as A
from lumenmap.sources import registry as R

TRACKS = "point3d_id long, image_id long, point2d_idx int"


@pytest.fixture
def model(spark):
    images = spark.createDataFrame([(i, f"i{i}", "ab"[i % 2], [float(i), 0.0, 0.0]) for i in range(4)], "image_id long, name string, sequence string, centre array<double>")
    points = spark.createDataFrame([(p, float(p), 0.0, 0.0) for p in (1, 2, 3)], "point3d_id long, x double, y double, z double")
    tracks = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (1, 2, 0), (2, 0, 1), (2, 2, 1), (3, 3, 0)], TRACKS)
    return {"images": images, "points": points, "tracks": tracks}


def test_tracks_and_quarantine(spark, model):
    assert {r["point3d_id"] for r in A.without_short_tracks(model["points"], model["tracks"]).collect()} == {1}
    kept, gone = A.quarantine(model["points"], model["tracks"], model["images"], spark.createDataFrame([("a", "b")], "a string, b string"))
    assert {r["point3d_id"] for r in kept.collect()} == {2, 3} and tuple(gone.first()) == (1, 3)
    a, b = (A.topology_signature(t).first() for t in (model["tracks"], model["tracks"].orderBy(F.desc("image_id")).repartition(3)))
    assert a == b and a["elements"] == 6
    assert A.topology_signature(model["tracks"].where("image_id < 3")).first() != a
    moved = {**model, "points": model["points"].where("point3d_id < 3").withColumn("y", F.lit(2.0))}
    c = A.compare_models(model, moved).first()
    assert (c["points_removed"], c["max_point_shift"], c["max_centre_shift"], c["images_added"]) == (1, 2.0, 0.0, 0) and c["survival"] == pytest.approx(2 / 3)
    rows = spark.createDataFrame([(1.0, 2.0), (-1.0, None), (3.0, 9.0)], "depth double, residual double")
    good, stats = A.filter_residuals(rows)
    assert good.count() == 1 and tuple(stats.first()) == (3, 1, 1)
    cams = spark.createDataFrame([([600.0, 606.0, 500.0, 398.0],)], "params array<double>")
    assert tuple(A.intrinsics_drift(cams, [600, 600, 500, 400]).first()) == (pytest.approx(0.01), 2.0)


def test_cross_map_points(spark):
    obs = "image_id long, point2d_idx int, point3d_id long"
    left = spark.createDataFrame([(1, 0, 10), (2, 5, 10), (1, 1, None)], obs)
    right = spark.createDataFrame([(7, 3, 20), (8, 4, 20)], obs)
    m = spark.createDataFrame([(1, 0, 7, 3), (2, 5, 8, 4), (1, 1, 7, 3)], "image_a long, idx_a int, image_b long, idx_b int")
    assert [tuple(r) for r in A.cross_map_points(m, left, right).collect()] == [(10, 20, 2)]


def test_pairs(spark):
    p = spark.createDataFrame([(i, x) for i, x in enumerate((0.0, 0.05, 0.1, 0.8, 0.9, 1.0))], "i int, p double")
    assert [r["side"] for r in A.two_clusters(p, "p").orderBy("i").collect()] == [0, 0, 0, 1, 1, 1]
    with pytest.raises(Exception, match="no two clusters"):
        A.two_clusters(p.where("i < 5"), "p").collect()
    frames = spark.createDataFrame([(s, f"{s}{i:02d}", i, float(i), 0.0, 0.0) for s in "abc" for i in range(10)], "sequence string, name string, frame int, x double, y double, z double")
    g = A.gap_pairs(frames, spark.createDataFrame([("b", "a"), ("a", "c")], "a string, b string"), 7)
    rows = g.collect()
    assert len(rows) == 7 and {(r["name_a"], r["name_b"]) for r in rows if r["b"] == "b"} == {("a00", "b00"), ("a03", "b03"), ("a06", "b06"), ("a09", "b09")}
    near = A.nearest_pairs(frames, "a", ["b", "c"], 2, 9).collect()
    assert {(r["target_name"], r["rank"]) for r in near} == {("b09", 1), ("b08", 2), ("c09", 1), ("c08", 2)}
    jobs = A.source_jobs(frames.select(F.col("sequence").alias("source"), F.col("name").alias("target")), 4).collect()
    assert len(jobs) == 9 and len({r["job_id"] for r in jobs}) == 9
    assert {tuple(r) for r in A.pair_file(spark.createDataFrame([("b a",), ("",), ("c  d",)], "value string")).collect()} == {("a", "b"), ("c", "d")}
    with pytest.raises(Exception, match="a bad pair"):
        A.pair_file(spark.createDataFrame([("b a",), ("a b",)], "value string")).collect()
    assert (A.merges_to_share(100, 10), A.merges_to_share(100, 20), A.merges_to_share(10, 10)) == (0, math.ceil(10 / 0.9), 10)
    roles = {r["name"]: r["role"] for r in A.motion_roles(frames.where("sequence = 'a' and frame < 3"), spark.createDataFrame([("a02", "hover")], "name string, role string")).collect()}
    assert roles == {"a00": "seed", "a01": "parallax", "a02": "hover"}
    scores = spark.createDataFrame([(i, j, 1.0 - abs(i - j) * 0.1) for i in range(5) for j in range(5)], "i int, j int, s double")
    assert tuple(A.rank_alignment(scores, "i", "j", "s").first()) == (pytest.approx(1.0), 1.0)


def test_routes_and_neighbours(spark):
    route = spark.createDataFrame([(0, 0.0, 0.0, 0.0), (1, 10.0, 0.0, 0.0), (2, 10.0, 10.0, 0.0)], "seq int, x double, y double, z double")
    pts = spark.createDataFrame([(1, 5.0, 2.0, 0.0), (2, 13.0, 5.0, 4.0), (3, -3.0, -4.0, 0.0)], "id int, x double, y double, z double")
    assert {r["id"]: r["distance"] for r in A.distance_to_route(pts, route, "id").collect()} == {1: 2.0, 2: 5.0, 3: 5.0}
    other = pts.withColumn("x", F.col("x") + 1)
    n = A.neighbour_summary(pts, other, "id", "xyz", 2.0).first()
    assert n["forward_median"] == 1.0 and n["backward_alone"] == 0


def test_registry(spark, tmp_path):
    with pytest.raises(KeyError):
        R.adapter("none")
    with pytest.raises(ValueError):
        R.register_adapter("sparse", R.read_model)
    R.register_adapter("mine", lambda s, p: {"points": s.range(3)}, replace=True)
    assert R.load_map(spark, "x", "mine")["points"].count() == 3
    assert R.adapter("lumenmap.sources.sparse:read_model") is R.read_model
    for name, n in (("a", 10), ("b/0", 99)):
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / "points3D.txt").write_text("x" * n)
    assert R.find_model(spark, str(tmp_path)).endswith("/b/0")
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "points3D.csv").write_text("x")
    with pytest.raises(FileNotFoundError):
        R.find_model(spark, str(tmp_path / "empty"))
    (tmp_path / "r.json").write_text('{"q1": "north", "q2": "south"}')
    assert {tuple(r) for r in R.region_assignments(spark, str(tmp_path / "r.json")).collect()} == {("q1", "north"), ("q2", "south")}
    raw = spark.createDataFrame([("a.jpg", 1.0, 2.0, 3.0, "r1"), ("b.jpg", None, None, None, None)], "filename string, x double, y double, z double, route_id string")
    assert {(r["name"], r["registered"]) for r in R.image_rows(raw).collect()} == {("a.jpg", True), ("b.jpg", False)}
    desc = spark.createDataFrame([("a", [1.0, 2.0])], "name string, descriptor array<float>")
    assert R.aligned_descriptors(desc, spark.createDataFrame([("a",)], "name string"), 2).count() == 1
    with pytest.raises(Exception, match="no descriptor"):
        R.aligned_descriptors(desc, spark.createDataFrame([("a",), ("b",)], "name string"), 2).collect()
    double = R.predictor(lambda rows: rows["x"] * 2)
    assert [r[0] for r in raw.where("x is not null").select(double("x")).collect()] == [1.0]
    made = R.matcher(raw.select("filename"), lambda b: b.assign(n=b["filename"].str.len()), "filename string, n long")
    assert {r["n"] for r in made.collect()} == {5}
    many = R.run_protocol([{"name": "E0"}, {"name": "E1"}], lambda s: spark.range(2))
    assert many.groupBy("experiment").count().count() == 2
