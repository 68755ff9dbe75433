import sqlite3
import struct

import pytest

from lumenmap.operators import gates as G
from lumenmap.operators import health as H
from lumenmap.sources import sinks, sparse, tables

IMAGES = [(1, (1.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0), "one.jpg"), (2, (1.0, 0.0, 0.0, 0.0), (-1.0, 0.0, 0.0), "two words.jpg"), (3, (1.0, 0.0, 0.0, 0.0), (-2.0, 0.0, 0.0), "three.jpg")]
POINTS = [(i, (float(i), float(i % 2), 5.0), (1, 2, 3), e) for i, e in enumerate((0.5, 0.7, 0.9, 1.1, 0.4), 1)]


def pixel(image, point):
    x, y, z = (p + t for p, t in zip(point, image[2]))
    return 500 + 600 * x / z, 400 + 600 * y / z


@pytest.fixture
def text_model(tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    (folder / "cameras.txt").write_text("# cameras\n1 PINHOLE 1000 800 600 600 500 400\n")
    lines = ["# images"]
    for im in IMAGES:
        lines.append(" ".join(map(str, (im[0], *im[1], *im[2], 1, im[3]))))
        obs = [(*pixel(im, p[1]), p[0]) for p in POINTS] + ([(1.0, 1.0, -1)] if im[0] == 3 else [])
        lines.append(" ".join(f"{x} {y} {p}" for x, y, p in obs))
    (folder / "images.txt").write_text("\n".join(lines) + "\n")
    rows = [" ".join(map(str, (p[0], *p[1], *p[2], p[3], *[v for im in IMAGES for v in (im[0], p[0] - 1)]))) for p in POINTS]
    (folder / "points3D.txt").write_text("# points\n" + "\n".join(rows) + "\n")
    return str(folder)


@pytest.fixture
def binary_model(tmp_path):
    folder = tmp_path / "binary"
    folder.mkdir()
    (folder / "cameras.bin").write_bytes(struct.pack("<QiiQQ4d", 1, 1, 1, 1000, 800, 600, 600, 500, 400))
    out = struct.pack("<Q", len(IMAGES))
    for im in IMAGES:
        obs = [(*pixel(im, p[1]), p[0]) for p in POINTS] + ([(1.0, 1.0, sparse.NO_POINT)] if im[0] == 3 else [])
        out += struct.pack("<i7di", im[0], *im[1], *im[2], 1) + im[3].encode() + b"\0" + struct.pack("<Q", len(obs)) + b"".join(struct.pack("<ddQ", *o) for o in obs)
    (folder / "images.bin").write_bytes(out)
    out = struct.pack("<Q", len(POINTS))
    for p in POINTS:
        out += struct.pack("<Q3d3BdQ", p[0], *p[1], *p[2], p[3], len(IMAGES)) + b"".join(struct.pack("<ii", im[0], p[0] - 1) for im in IMAGES)
    (folder / "points3D.bin").write_bytes(out)
    return str(folder)


def test_models_as_text_and_binary(spark, text_model, binary_model):
    a, b = sparse.read_model(spark, text_model), sparse.read_model(spark, binary_model)
    sizes = {"cameras": 1, "images": 3, "observations": 16, "points": 5, "tracks": 15}
    for name, n in sizes.items():
        rows = [sorted(map(str, m[name].select(sorted(m[name].columns)).collect())) for m in (a, b)]
        assert len(rows[0]) == n and rows[0] == rows[1], name
    centres = {r["name"]: r["centre"] for r in a["images"].collect()}
    assert centres["two words.jpg"] == pytest.approx([1, 0, 0])
    assert all(r["ok"] for r in G.integrity_checks(a["cameras"], a["images"], a["observations"], a["points"], a["tracks"]).collect())
    broken = a["tracks"].where("image_id <> 2")
    bad = {r["check"]: r["violations"] for r in G.integrity_checks(a["cameras"], a["images"], a["observations"], a["points"], broken).collect()}
    assert bad["observation_has_track"] == 5
    res = H.residual_summary(H.residuals(a["observations"], a["images"], a["points"], a["cameras"])).first()
    assert res["n"] == 15 and res["max"] < 1e-9 and res["invalid_depth"] == 0
    metrics = {r["name"]: r for r in H.image_metrics(a["cameras"], a["images"], a["observations"], a["points"]).collect()}
    assert metrics["one.jpg"]["observations"] == 5 and metrics["one.jpg"]["mean_track"] == 3


def test_results_csv(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("query,success,localizer,inliers,inlier_ratio,weather\nq1,yes,,50,0.5,sun\nq2,0,pnp,,nan,\n")
    rows = {r["query"]: r for r in tables.results(spark, str(p)).collect()}
    assert rows["q1"]["success"] and rows["q1"]["localizer"] == "unspecified" and rows["q1"]["metrics"] == {"weather": "sun"}
    assert not rows["q2"]["success"] and rows["q2"]["inlier_ratio"] is None and rows["q2"]["metrics"] == {}
    p.write_text("query,success\nq1,yes\nq1,no\n")
    with pytest.raises(Exception, match="query twice"):
        tables.results(spark, str(p)).collect()
    p.write_text("query,x\nq1,1\n")
    with pytest.raises(ValueError):
        tables.results(spark, str(p))


def test_manifest_and_risks(spark, tmp_path):
    (tmp_path / "m.txt").write_text("# all\nq2\nq1 # first\n\n")
    (tmp_path / "m.json").write_text('{"queries": ["q2", "q1"]}')
    for n in ("m.txt", "m.json"):
        assert [r["query"] for r in tables.manifest(spark, str(tmp_path / n)).orderBy("i").collect()] == ["q2", "q1"]
    (tmp_path / "k.csv").write_text("query,risk\nq1,0.4\nq2,1.4\n")
    with pytest.raises(Exception, match="risk out of range"):
        tables.risk_scores(spark, str(tmp_path / "k.csv")).collect()


def test_pairs_merge(spark):
    a = spark.createDataFrame([("x", "y", 100, None), ("z", "z", 1, 1)], "image_i string, image_j string, num_matches int, num_inliers int")
    b = spark.createDataFrame([("y", "x", 40)], "name1 string, name2 string, inliers int")
    got = tables.merge_pairs([a, b]).collect()
    assert len(got) == 1 and (got[0]["image_i"], got[0]["num_matches"], got[0]["num_inliers"]) == ("x", 100, 40)


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "d.db")
    c = sqlite3.connect(path)
    c.executescript("create table images(image_id integer primary key, name text); create table matches(pair_id integer primary key, rows integer); create table two_view_geometries(pair_id integer primary key, rows integer); create table keypoints(image_id integer primary key, rows integer)")
    c.executemany("insert into images values(?,?)", [(1, "a"), (2, "b"), (3, "c")])
    k = 2147483647
    c.executemany("insert into matches values(?,?)", [(k + 2, 100), (k + 3, 0)])
    c.execute("insert into two_view_geometries values(?,?)", (k + 2, 25))
    c.executemany("insert into keypoints values(?,?)", [(1, 10), (2, 0)])
    c.commit()
    c.close()
    rows = {r["image_j"]: r for r in tables.database_pairs(spark, path).collect()}
    assert rows["b"]["inlier_ratio"] == 0.25 and rows["c"]["inlier_ratio"] is None and rows["b"]["image_i"] == "a"
    assert {r["name"] for r in tables.images_without_keypoints(spark, path).collect()} == {"b", "c"}
    assert tables.read_sqlite(spark, path, "images", "image_id long, name string", 3).count() == 3


def test_sinks(spark, tmp_path):
    pts = spark.createDataFrame([(float(i), 0.0, 1.0, 1, 2, 3) for i in range(10)] + [(float("nan"), 0.0, 0.0, 0, 0, 0)], "x double, y double, z double, r int, g int, b int").repartition(3)
    assert sinks.write_point_cloud(pts, f"file://{tmp_path}/c.ply") == 10
    data = (tmp_path / "c.ply").read_bytes()
    head, body = data.split(b"end_header\n", 1)
    assert b"element vertex 10" in head and len(body) == 150
    assert sorted(r[0] for r in struct.iter_unpack("<fffBBB", body)) == list(range(10))
    assoc = spark.createDataFrame([(1,), (7,)], "point3d_id long")
    with pytest.raises(ValueError, match="7"):
        sinks.write_sidecar(assoc, spark.createDataFrame([(1,)], "point3d_id long"), str(tmp_path / "s"))
    store = sinks.BundleStore(f"file://{tmp_path}/bundles")
    store.promote("v1", {"status": "PASS"}, "a", "a")
    store.promote("v2", {"status": "PASS"}, "a", "a")
    with pytest.raises(ValueError):
        store.promote("v3", {"status": "FAIL"}, "a", "a")
    assert store.current() == "v2" and store.rollback() == "v1" and store.current() == "v1" and len(store.history()) == 3


def test_provenance(spark):
    p = sparse.with_provenance(spark.createDataFrame([(1,), (2,)], "point3d_id long"), spark.createDataFrame([(2, "ADDED")], "point3d_id long, provenance string"))
    assert {tuple(r) for r in p.collect()} == {(1, "BASE"), (2, "ADDED")}


def test_precomputed_matches(spark, tmp_path):
    import numpy as np

    np.savez(tmp_path / "q1__r1.npz", query_xy=np.array([[1.0, 2.0], [3.0, 4.0]]), reference_xy=np.array([[5.0, 6.0], [7.0, 8.0]]), confidence=np.array([0.5, 0.9]))
    got = sorted(map(tuple, tables.precomputed_matches(spark, str(tmp_path)).collect()))
    assert got == [("q1", "r1", 0, 1.0, 2.0, 5.0, 6.0, 0.5), ("q1", "r1", 1, 3.0, 4.0, 7.0, 8.0, 0.9)]
    back = tables.precomputed_matches(spark, str(tmp_path), swap=True).where("match_id = 0").first()
    assert (back["query_id"], back["q_x"], back["r_x"]) == ("r1", 5.0, 1.0)
