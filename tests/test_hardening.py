import random

import pytest

from lumenmap.operators import hardening as H

TWO = [(a, b, 1.0) for g in ("abcd", "wxyz") for i, a in enumerate(g) for b in g[i + 1 :]] + [("d", "w", 0.2)]


def test_communities():
    got = H.communities(TWO)
    assert len(set(got.values())) == 2 and len({got[n] for n in "abcd"}) == 1 and got["a"] != got["z"]
    assert H.communities([]) == {}


def test_spanning_window_matches_brute_force():
    r = random.Random(3)
    for _ in range(20):
        names = "abcde"
        edges = [(a, b, r.randint(1, 20) / 2) for i, a in enumerate(names) for b in names[i + 1 :] if r.random() < 0.8]
        best, full = None, len({n for e in edges for n in e[:2]}) - 1
        weights = sorted({w for *_, w in edges})
        for lo in weights:
            for hi in weights:
                part = [e for e in edges if lo <= e[2] <= hi]
                if len(H._forest(part)) == full:
                    best = hi - lo if best is None else min(best, hi - lo)
        tree = H.spanning_window(edges)
        assert (best is None) == (tree == [])
        if tree:
            assert max(e[2] for e in tree) - min(e[2] for e in tree) == best and len(H._forest(tree)) == full


def test_cycles_and_paths():
    line = [("a", "b", 1.0), ("b", "c", 1.0), ("c", "d", 1.0)]
    assert H.close_cycles(line, [("a", "d", 0.5), ("a", "c", 0.4), ("a", "b", 0.9)]) == [("a", "d", 0.5)]
    value, path = H.best_path([("s", "m", 0.9), ("m", "x", 0.9), ("s", "x", 0.5)], "s", {"x"})
    assert path == ["s", "m", "x"] and value == pytest.approx(0.81)
    assert H.best_path([("s", "m", 0.9), ("m", "x", 0.9), ("s", "x", 0.5)], "s", {"x"}, 1)[1] == ["s", "x"]
    assert H.best_path([("s", "m", 0.9)], "s", {"x"}) is None
    assert H.disjoint_paths([("s", "m", 1), ("s", "n", 1), ("m", "x", 1), ("n", "x", 1), ("m", "n", 1)], "s", {"x"}) == 2
    assert H.disjoint_paths([("s", "m", 1), ("m", "x", 1), ("m", "y", 1)], "s", {"x", "y"}) == 1


def test_harden(spark):
    df = spark.createDataFrame(TWO, "session_a string, session_b string, reliability double")
    got = {(r["session_a"], r["session_b"]): r for r in H.harden(df).collect()}
    assert len(got) == 13 and sum(r["use"] == "backbone" for r in got.values()) == 7
    assert got["d", "w"]["use"] == "backbone" and got["d", "w"]["community_a"] != got["d", "w"]["community_b"]
    e = spark.createDataFrame([("STRONG", 5, 1, True, True, True), ("STRONG", 5, 1, True, None, True), ("WEAK", 5, 1, True, True, True), (None, None, None, None, None, None)], "status string, num_verified_pairs int, independent_bridge_groups int, independent_artifact boolean, geometry_complete boolean, group_holdout_disjoint boolean")
    assert [r[0] for r in e.select(H.eligible()).collect()] == [None, "geometry_incomplete", "status", "status"]
    b = spark.createDataFrame([(50.0, 0.5, 0.1, 10.0, 1.0), (50.0, None, 0.1, 10.0, 1.0)], "inliers double, inlier_ratio double, support_area double, angle_deg double, residual_px double")
    assert H.valid_bridges(b).count() == 1


def test_plans(spark):
    s = [{"session": "a", "cells": [1, 2, 3], "quality": 0.5, "cost": 1.0}, {"session": "b", "cells": [1, 2], "quality": 0.5, "cost": 1.0}, {"session": "c", "cells": [9], "quality": 0.1, "cost": 1.0}, {"session": "d", "cells": [1, 2, 3, 4, 5], "quality": 1, "cost": 9.0}]
    assert [n for n, _ in H.portfolio(s, {("a", "b"): 0.2}, 2.0)] == ["a", "c"]
    assert H.plan_frames([0, 0.5, 1, 1.5, 2, 2.5], ["PARALLAX", "PARALLAX", "HOVER", "HOVER", "PARALLAX", "PARALLAX"]) == [0, 1, 4, 5]
    f = spark.createDataFrame([("s", i / 2, "HOVER" if i > 3 else "PARALLAX") for i in range(20)], "s string, t double, m string")
    assert [r["t"] for r in H.frame_plan(f, "s", "t", "m").orderBy("t").collect()] == [0.0, 0.5, 1.0, 1.5, 6.5]
    assert H.cap_class([True] * 10 + [False] * 5, 0.5) == [0, 2, 4, 7, 9, 10, 11, 12, 13, 14]
    assert H.cap_class([True, False], 0.0) == [1]
