"""What SQL can't hold: eigenvalues, folds, and plans that must not gather rows."""

import random

import numpy as np
import pytest

from lumenmap.operators import poses, recapture, site_audits, upkeep, windows


def test_information_matches_numpy(spark):
    r = np.random.default_rng(3)
    rows = [(i % 3, *map(float, r.uniform(-2, 2, 2)), float(r.uniform(-1, 6)), float(r.uniform(0, 2))) for i in range(120)]
    df = spark.createDataFrame(rows, "pose long, x double, y double, z double, weight double")
    got = {x["pose"]: x for x in poses.information(df, ["pose"], 100.0, 80.0, 2.0, 3.0).withColumn("s", poses.information_summary()).collect()}
    for k in range(3):
        m = np.zeros((6, 6))
        for p, x, y, z, w in rows:
            if p == k and z > 1e-9:
                j = np.array([[100 / z * 3, 0, -100 * x / z**2 * 3, -100 * x * y / z**2, 100 * (1 + x * x / z**2), -100 * y / z], [0, 80 / z * 3, -80 * y / z**2 * 3, -80 * (1 + y * y / z**2), 80 * x * y / z**2, 80 * x / z]])
                m += w / 4 * j.T @ j
        assert np.allclose(got[k]["information"], [m[i, j] for i, j in poses.ENTRIES])
        values = np.linalg.eigvalsh(m)
        s = got[k]["s"]
        assert s["rank"] == 6 and np.isclose(s["condition"], values[-1] / values[0], rtol=1e-6) and np.isclose(s["trace_inverse"], np.trace(np.linalg.inv(m)), rtol=1e-5)
    none = poses.spectrum(np.zeros((6, 6)))
    assert none[0] == 0 and none[4] == 1e12


def test_folds_are_balanced():
    r = random.Random(2)
    groups = [(f"g{i}", n := r.randint(1, 40), r.randint(0, n)) for i in range(60)]
    folds = poses.balanced_folds(groups, 5)
    assert set(folds) == {g for g, _, _ in groups} and set(folds.values()) == set(range(5))
    largest = sorted(groups, key=lambda g: -g[1])[:4]
    assert len({folds[g] for g, _, _ in largest}) == 4  # these begin folds of their own
    assert poses.balanced_folds(groups, 5) == poses.balanced_folds(groups[::-1], 5)


def test_harmonic_numbers(spark):
    got = spark.range(0, 300).select("id", windows.harmonic(__import__("pyspark.sql.functions", fromlist=["col"]).col("id")).alias("h")).collect()
    for x in got:
        assert abs(x["h"] - sum(1 / k for k in range(1, x["id"] + 1))) < 1e-12


def test_areas_match_prefix_means(spark):
    r = random.Random(4)
    rows = [(r.choice([0.1, 0.2, 0.2, 0.5, 0.9, r.random()]), r.random() < 0.4) for _ in range(200)]
    got = windows.aurc(spark.createDataFrame(rows, "risk double, failed boolean"), "risk", "failed").first()
    ties = {}
    for risk, f in rows:
        ties.setdefault(risk, []).append(f)
    before, bad, values = 0, 0, []
    for risk in sorted(ties):
        share = sum(ties[risk]) / len(ties[risk])
        values += [(bad + k * share) / (before + k) for k in range(1, len(ties[risk]) + 1)]
        before, bad = before + len(ties[risk]), bad + sum(ties[risk])
    good = len(rows) - bad
    assert abs(got["aurc"] - np.mean(values)) < 1e-9
    assert abs(got["oracle_aurc"] - np.mean([max(0, a - good) / a for a in range(1, len(rows) + 1)])) < 1e-9


def test_order_numbers_and_steps_over_ranges(spark):
    r = random.Random(6)
    rows = [(i, r.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v double").repartition(7)
    order = sorted(rows, key=lambda x: x[1])
    want, total = {}, 0.0
    for k, (i, v) in enumerate(order, 1):
        total += v
        want[i] = (k, round(total, 9))
    assert {x["id"]: (x["place"], round(x["running"], 9)) for x in windows.ordered_numbers(df, ["v"], "v").collect()} == want
    steps = [(0.3, 1.0), (0.31, 2.0), (0.9, 3.0)]
    got = windows.last_before(df, "v", spark.createDataFrame(steps, "s double, p double"), "s", "p", "p")
    assert all(x["p"] == ([p for s, p in steps if s <= x["v"]] or [1.0])[-1] for x in got.collect()) and got.count() == 500


def test_no_window_over_all_rows(spark):
    """Ranks and curves sort values in ranges: no exchange to a single partition of rows."""
    df = spark.range(1000).selectExpr("double(id) as v", "id % 3 = 0 as f")
    plan = windows.percentile_rank(df, "v")._jdf.queryExecution().executedPlan().toString()
    windows_in_plan = [line for line in plan.split("\n") if "Window [" in line and "_part" not in line]
    assert not windows_in_plan


def test_pair_graph_matches_brute_force(spark):
    r = random.Random(9)
    images = [(i, i % 4) for i in range(60)]
    pairs = [(r.randrange(66), r.randrange(66)) for _ in range(45)]
    got = site_audits.pair_graph(spark.createDataFrame(images, "image long, sequence long"), spark.createDataFrame(pairs, "a long, b long")).first()
    edges = {(min(p), max(p)) for p in pairs if p[0] != p[1] and max(p) < 60}
    root = list(range(60))
    for a, b in edges:
        x, y = root[a], root[b]
        root = [min(x, y) if v in (x, y) else v for v in root]
    degree = [sum(i in e for e in edges) for i in range(60)]
    assert (got["components"], got["largest"]) == (len(set(root)), max(root.count(v) for v in set(root)))
    assert got["isolated"] == degree.count(0) and got["median_degree"] == float(np.median(degree)) and got["cross_pairs"] == sum(a % 4 != b % 4 for a, b in edges)


def test_unknown_strategy_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown strategy"):
        upkeep.plan_update(None, None, None, "BEST")


def test_bins_keep_ties_together(spark):
    rows = [(i, v) for i, v in enumerate([0.1] * 10 + [0.2] * 3 + [0.3] * 4 + [0.9] * 20 + [1.0])]
    got = recapture.equal_mass_bins(spark.createDataFrame(rows, "id long, v double"), "v", 4).collect()
    assert {(x["v"], x["bin"]) for x in got} == {(0.1, 0), (0.2, 1), (0.3, 1), (0.9, 1), (1.0, 2)}
