"""Graphs whose nodes are linked by shared points: the same reports as from their pairs."""

import random

import pytest

from lumenmap.operators import graph as N
from lumenmap.operators import poses as P


def of_pairs(points):
    """The report of each component from all pairs."""
    pairs = {}
    for a in points:
        for b in points:
            if a < b and points[a] & points[b]:
                pairs[a, b] = float(len(points[a] & points[b]))
    return N.small_graph_report([(a, b, w) for (a, b), w in sorted(pairs.items())])


@pytest.mark.parametrize("seed", range(12))
def test_report_equals_that_of_pairs(seed):
    rng = random.Random(seed)
    # a chain of groups that are joined by few points, some nodes alike, so there are bridges and articulation nodes
    points, k = {}, 0
    for g in range(rng.randint(1, 5)):
        for _ in range(rng.randint(1, 7)):
            points[k] = {10 * g + rng.randint(0, 2 + seed % 4)} | {10 * g}
            k += 1
        if g:
            points[rng.choice([x for x in points if 10 * g in points[x]])].add(1000 + g)
            points[rng.choice([x for x in points if 10 * (g - 1) in points[x]])].add(1000 + g)
    if k < 2:
        points[k] = {0}
    want, sets = of_pairs(points), {}
    for a in sorted(points):
        sets.setdefault(tuple(sorted(points[a])), []).append(a)
    got = N.shared_graph_report(list(sets), [len(v) for v in sets.values()], [v[0] for v in sets.values()], [v[-1] for v in sets.values()], dense=0)
    assert {x: got[x] for x in ("nodes", "edges", "bridges", "articulation")} == {x: want[x] for x in ("nodes", "edges", "bridges", "articulation")}
    assert got["fiedler"] == pytest.approx(want["fiedler"], abs=1e-9) and got["lambda2"] == pytest.approx(want["lambda2"], abs=1e-9)


def test_shared_queries_equal_those_of_pairs(spark):
    rng = random.Random(3)
    rows = [(n, 20 * (n // 40) + rng.randint(0, 9)) for n in range(120) for _ in range(3)] + [(500, 77), (501, 78), (502, 78), (503, None)]
    seen = spark.createDataFrame(rows, "node long, point long")
    edges = N.covisibility(seen, "node", "point", least=1)
    assert sorted(map(tuple, N.shared_components(seen).collect())) == sorted(map(tuple, N.components(seen.select("node"), edges).collect()))
    got, want = ({r["component"]: r for r in df.collect()} for df in (N.shared_fragility(seen), N.fragility(seen.select("node"), edges)))
    assert got.keys() == want.keys()
    for c, r in want.items():
        assert got[c][:5] == r[:5] and got[c][5:] == pytest.approx(r[5:], abs=1e-9)


def test_pose_quality_has_no_open_ties(spark):
    rows = [(1, p, True, 0.5, float(e), e - 3, 2) for p in range(4) for e in range(6)]
    for order in (rows, rows[::-1]):
        got = P.pose_quality(spark.createDataFrame(order, "pose int, point int, inlier boolean, confidence double, error double, depth int, reference int").coalesce(1), ["pose"]).first()
        assert (got["inliers"], got["rmse"], got["p90"], got["positive_depth_ratio"]) == (4, 0.0, 0.0, 0.0)
