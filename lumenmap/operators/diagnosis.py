"""Diagnosis of poses and routes: lattices, visibility, view support, health scores, codes, heat maps, route audits, markers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import angle_between_deg, clip, dot, finite, first_by_priority, reasons, weighted_observed
from .kernels import route_orientation
from .spatial import nearest_within, radius_pairs
from .windows import hysteresis, resample_route, top_k, trapezoid_weights, weak_segments


def lattice(box: DataFrame, spacing: float, most: int = 25_000) -> DataFrame:
    """(x, y, z) every `spacing` of a one-row box (x0, x1, y0, y1, z0, z1); an error where it would have over `most` points."""
    n = [F.floor((F.col(f"{c}1") - F.col(f"{c}0")) / spacing + 1e-9) + 1 for c in "xyz"]
    checked = box.withColumn("_n", F.when(n[0] * n[1] * n[2] > most, F.raise_error(F.lit(f"over {most} points")).cast("long")).otherwise(n[0] * n[1] * n[2])).where("_n > 0")
    out = checked
    for c, k in zip("xyz", n):
        out = out.withColumn(c, F.explode(F.sequence(F.lit(0).cast("long"), k - 1))).withColumn(c, F.col(f"{c}0") + F.col(c) * spacing)
    return out.select("x", "y", "z")


def orientations(positions: DataFrame, count: int = 3, step_deg: float = 45.0) -> DataFrame:
    """positions with `count` headings (yaw_deg), step_deg apart around 0."""
    yaws = [(i - (count - 1) / 2) * step_deg for i in range(count)]
    return positions.withColumn("yaw_deg", F.explode(F.array(*[F.lit(float(y)) for y in yaws])))


def visible(poses: DataFrame, points: DataFrame, pose_id: str, point_id: str, reach: float = 30.0, near: float = 0.05, width: float = 1000, height: float = 800, focal: float = 600) -> DataFrame:
    """(pose_id, point_id, distance, depth, u, v) of points in a pose's frustum and reach (half-open image).

    poses: x, y, z and a camera-to-world rotation r_wc of 9. Candidates come from cells of the reach's size.
    """
    pairs = radius_pairs(poses, points, pose_id, point_id, ("x", "y", "z"), reach)
    p = poses.select(F.col(pose_id).alias("left_id"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("z").alias("_z"), "r_wc")
    q = points.select(F.col(point_id).alias("right_id"), "x", "y", "z")
    j = pairs.join(p, "left_id").join(q, "right_id")
    d = [F.col(c) - F.col(f"_{c}") for c in "xyz"]
    cam = [reduce(lambda a, b: a + b, [F.element_at("r_wc", 3 * i + k + 1) * d[i] for i in range(3)]) for k in range(3)]
    j = j.withColumn("depth", cam[2]).where(F.col("depth") > near)
    u, v = focal * cam[0] / F.col("depth") + width / 2, focal * cam[1] / F.col("depth") + height / 2
    j = j.withColumn("u", u).withColumn("v", v).where((F.col("u") >= 0) & (F.col("u") < width) & (F.col("v") >= 0) & (F.col("v") < height))
    return j.select(F.col("left_id").alias(pose_id), F.col("right_id").alias(point_id), "distance", "depth", "u", "v")


def view_support(poses: DataFrame, views: DataFrame, pose_id: str, view_id: str, direction: str, radius: float, k: int = 10, orientation_weight: float = 5.0) -> DataFrame:
    """The k nearest views of the map to each pose, by distance over the radius and angle over a half turn: (pose, view, distance, angle_deg, rank)."""
    pairs = radius_pairs(poses, views, pose_id, view_id, ("x", "y", "z"), radius)
    j = pairs.join(poses.select(F.col(pose_id).alias("left_id"), F.col(direction).alias("_a")), "left_id").join(views.select(F.col(view_id).alias("right_id"), F.col(direction).alias("_b")), "right_id")
    j = j.withColumn("angle_deg", angle_between_deg("_a", "_b")).withColumn("_d", F.col("distance") / radius + orientation_weight * F.col("angle_deg") / 180)
    return top_k(j, ["left_id"], ["_d", "right_id"], k, "rank").select(F.col("left_id").alias(pose_id), F.col("right_id").alias(view_id), "distance", "angle_deg", "rank")


#: The weights of a pose's health.
HEALTH_WEIGHTS = {"visibility": 0.25, "coverage": 0.20, "information": 0.22, "diversity": 0.13, "support": 0.20}
OPTIONAL_WEIGHTS = {"history": 0.20, "consensus": 0.20}


def health_score(available: Sequence[str]) -> Column:
    """Weighted mean of the terms (columns in [0, 1]); history and consensus count where they are there."""
    terms = [(clip(c), w) for c, w in {**HEALTH_WEIGHTS, **OPTIONAL_WEIGHTS}.items() if c in available]
    return weighted_observed(terms)[0]


@dataclass(frozen=True)
class PoseLimits:
    visible: float = 40
    effective: float = 25
    grid: float = 6
    hull: float = 0.15
    rank: int = 6
    condition: float = 1e8
    diversity: float = 0.015
    cameras: int = 3
    support: float = 0.10
    parallax: float = 0.60
    matchability: float = 0.30


#: Which of several codes is named first.
PRIORITY = ("OUTSIDE_MAP", "LOW_VISIBILITY", "LOW_EFFECTIVE_LANDMARKS", "RANK_DEFICIENT", "ILL_CONDITIONED", "LOW_COVERAGE", "LOW_HULL", "LOW_DIVERSITY", "FEW_CAMERAS", "LOW_VIEW_SUPPORT", "LOW_PARALLAX", "LOW_MATCHABILITY", "HEALTHY")


def diagnose(metrics: DataFrame, limits: PoseLimits = PoseLimits()) -> DataFrame:
    """metrics with `codes` in order and the `primary` one; a metric that is null gives no code."""
    c = F.col
    found = reasons(
        [
            ("OUTSIDE_MAP", c("visible") == 0),
            ("LOW_VISIBILITY", c("visible") < limits.visible),
            ("LOW_EFFECTIVE_LANDMARKS", c("effective") < limits.effective),
            ("RANK_DEFICIENT", c("rank") < limits.rank),
            ("ILL_CONDITIONED", c("condition") > limits.condition),
            ("LOW_COVERAGE", c("grid") < limits.grid),
            ("LOW_HULL", c("hull") < limits.hull),
            ("LOW_DIVERSITY", c("diversity") < limits.diversity),
            ("FEW_CAMERAS", c("cameras") < limits.cameras),
            ("LOW_VIEW_SUPPORT", c("support") < limits.support),
            ("LOW_PARALLAX", c("parallax") < limits.parallax),
            ("LOW_MATCHABILITY", c("matchability") < limits.matchability),
        ]
    )
    codes = F.when(F.size(found) == 0, F.array(F.lit("HEALTHY"))).otherwise(found)
    return metrics.withColumn("codes", codes).withColumn("primary", first_by_priority("codes", PRIORITY))


def heat_positions(poses: DataFrame, by: Sequence[str] = ("x", "y", "z"), health: str = "health") -> DataFrame:
    """For each position its best, mean and worst heading and the spread."""
    return poses.groupBy(*by).agg(F.max(health).alias("best"), F.avg(health).alias("mean"), F.min(health).alias("worst"), F.max_by("yaw_deg", health).alias("best_yaw_deg")).withColumn("spread", F.col("best") - F.col("worst"))


def weakest_positions(positions: DataFrame, n: int = 100) -> DataFrame:
    return positions.orderBy("best", "x", "y", "z").limit(n)


def candidate_risk(health: str | Column, weak_direction: str, weak_fraction: str, weak_sigma: str, task: str, weight: float = 0.1) -> Column:
    """Risk of a heading: 1 - health, and a penalty where the weakest direction lies along the task's."""
    align = F.abs(dot(weak_direction, task))
    h = F.col(health) if isinstance(health, str) else health
    return clip(1 - h + weight * F.coalesce(align * F.col(weak_fraction) * F.col(weak_sigma), F.lit(0.0)))


def limitation(selected, best, enter: float = 0.45, gain: float = 0.05) -> Column:
    """What limits a sample: the map where even the best heading is weak, the heading where another would gain enough."""
    s, b = (F.col(c) if isinstance(c, str) else c for c in (selected, best))
    return F.when(b >= enter, "MAP_LIMITED").when(s >= enter, F.when(s - b >= gain, "ORIENTATION_LIMITED").otherwise("MARGINAL")).otherwise("HEALTHY")


def audit_route(route: DataFrame, heat: DataFrame, by: Sequence[str] = ("route_id",), order: str = "seq", spacing: float = 0.5, reach: float = 2.0, smooth: float = 0.25, least: float = 1.0) -> dict[str, DataFrame]:
    """samples, segments and summary of routes over a heat map (pose_id, x, y, z, yaw_deg, health).

    A sample takes the headings of the nearest position within reach; the cheapest smooth choice of headings
    follows; weak stretches come from hysteresis, shares are weighted by length.
    """
    samples = resample_route(route, by, order, ("x", "y", "z"), spacing)
    samples = samples.withColumn("sample_id", F.concat_ws("@", *by, F.format_string("%.6f", "s")))
    spots = heat.groupBy("x", "y", "z").agg(F.min("pose_id").alias("spot_id"))
    near = nearest_within(samples, spots, "sample_id", "spot_id", ("x", "y", "z"), reach)
    named = heat.join(spots, ["x", "y", "z"]).select("spot_id", "yaw_deg", (1 - F.col("health")).alias("risk"))
    options = near.join(named.withColumnRenamed("spot_id", "right_id"), "right_id").select(F.col("left_id").alias("sample_id"), "yaw_deg", "risk", F.col("distance").alias("support_distance"))
    best = options.groupBy("sample_id").agg(F.min("risk").alias("best_risk"), F.min("support_distance").alias("support_distance"))
    placed = options.join(samples.select(*by, "s", "sample_id"), "sample_id").select(*by, "s", F.col("yaw_deg").alias("candidate"), "yaw_deg", "risk")
    chosen = route_orientation(placed, by, "s", "candidate", "risk", "yaw_deg", smooth).select(*by, "s", F.col("yaw_deg").alias("selected_yaw_deg"), F.col("risk").alias("selected_risk"))
    rows = samples.join(chosen, [*by, "s"], "left").join(best, "sample_id", "left")
    rows = trapezoid_weights(rows, by, "s")
    rows = rows.withColumn("status", F.when(F.col("selected_risk").isNull(), "UNSUPPORTED").otherwise(limitation("selected_risk", "best_risk")))
    segments = weak_segments(rows.where("selected_risk is not null"), by, ["s"], "selected_risk", "weight", least=least)
    share = lambda c: F.sum(F.when(c, F.col("weight")).otherwise(0.0)) / F.sum("weight")
    summary = rows.groupBy(*by).agg(
        F.count("*").alias("samples"),
        F.sum("weight").alias("length"),
        share(F.col("selected_risk").isNotNull()).alias("supported"),
        share(F.col("status") == "MAP_LIMITED").alias("map_limited"),
        share(F.col("status") == "ORIENTATION_LIMITED").alias("orientation_limited"),
        (F.sum(F.col("selected_risk") * F.col("weight")) / F.sum(F.when(F.col("selected_risk").isNotNull(), F.col("weight")))).alias("mean_risk"),
        F.expr("percentile(selected_risk, 0.9)").alias("p90_risk"),
    )
    return {"samples": rows, "segments": segments, "summary": summary}


def heat_markers(poses: DataFrame, spread: float = 0.25, good: float = 0.45) -> DataFrame:
    """(kind, x, y, z): holes and weak information by pose, positions whose health depends on the heading."""
    kinds = reasons([("coverage_hole", F.col("visible") == 0), ("fim_rank_deficient", F.col("rank") < 6), ("fim_weak", (F.col("rank") >= 6) & (F.col("condition") > 1e8))])
    a = poses.select(F.explode(kinds).alias("kind"), "x", "y", "z").distinct()
    r = poses.select(*[F.round(c, 5).alias(c) for c in "xyz"], "health")
    b = r.groupBy("x", "y", "z").agg((F.max("health") - F.min("health")).alias("d"), F.max("health").alias("m")).where((F.col("d") >= spread) & (F.col("m") >= good))
    return a.unionByName(b.select(F.lit("direction_sensitive").alias("kind"), "x", "y", "z"))


def localization_markers(results: DataFrame) -> DataFrame:
    """(query, kind, x, y, z) of queries that did not succeed. Where a richer status is there, only DIRECT_STRONG with ACCEPT is a success."""
    rich = F.col("status").isNotNull() | F.col("decision").isNotNull()
    ok = F.when(rich, F.coalesce((F.col("status") == "DIRECT_STRONG") & (F.col("decision") == "ACCEPT"), F.lit(False))).otherwise(F.coalesce("success", F.lit(False)))
    has_pose = finite("x").isNotNull() & finite("y").isNotNull() & finite("z").isNotNull()
    at = [F.when(has_pose, F.col(c)).otherwise(F.col(f"proxy_{c}")).alias(c) for c in "xyz"]
    kind = F.when(~has_pose, "retrieval_proxy").when(F.col("decision") == "PROVISIONAL", "provisional").otherwise("weak")
    return results.where(~ok).select("query", kind.alias("kind"), *at).where("x is not null")


def clip_box(points: DataFrame, xyz: Sequence[str] = ("x", "y", "z"), scale: float = 6.0) -> DataFrame:
    """points with `inside`: within `scale` robust deviations of the median on every axis, or between the 1st and 99th percentile."""
    aggs = [F.expr(f"percentile({c}, array(0.01, 0.5, 0.99))").alias(f"_q_{c}") for c in xyz]
    q = points.agg(*aggs)
    dev = points.crossJoin(F.broadcast(q)).agg(*[F.expr(f"percentile(abs({c} - _q_{c}[1]), 0.5)").alias(f"_m_{c}") for c in xyz])  # one row
    j = points.crossJoin(F.broadcast(q.crossJoin(dev)))  # one row
    ok = reduce(lambda a, b: a & b, [(F.abs(F.col(c) - F.col(f"_q_{c}")[1]) <= scale * 1.4826 * F.col(f"_m_{c}")) | ((F.col(c) >= F.col(f"_q_{c}")[0]) & (F.col(c) <= F.col(f"_q_{c}")[2])) for c in xyz])
    return j.withColumn("inside", F.coalesce(ok, F.lit(False))).select(*points.columns, "inside")


def trajectory_jumps(rows: DataFrame, by: Sequence[str], order: str, xyz: Sequence[str] = ("x", "y", "z"), factor: float = 10.0) -> DataFrame:
    """Steps of over `factor` times the route's median step: (by, order, step, median_step)."""
    w = Window.partitionBy(*by).orderBy(order)
    step = F.sqrt(reduce(lambda a, b: a + b, [(F.col(c) - F.lag(c).over(w)) ** 2 for c in xyz]))
    s = rows.select(*by, order, step.alias("step")).where("step is not null")
    m = s.groupBy(*by).agg(F.expr("percentile(step, 0.5)").alias("median_step"))
    return s.join(m, list(by)).where(F.col("step") > factor * F.col("median_step"))


def weak_flags(rows: DataFrame, by: Sequence[str], order: Sequence[str], risk: str) -> DataFrame:
    return hysteresis(rows, by, order, risk)
