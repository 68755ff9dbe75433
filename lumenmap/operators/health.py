"""Map health: distributions, per-image metrics, readiness, weak images and regions, matchability, spans."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.exprs import clip, decay, dot, finite, grade, grid_cell, robust_badness, score_higher_better, score_lower_better, weighted_observed
from .spatial import nearest_within


def distribution(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, med, mad, p10, p90) over finite values; exact, with linear interpolation. The MAD is a second pass."""
    x = df.select(*by, finite(value).alias("v")).where("v is not null")
    g = x.groupBy(*by).agg(F.count("*").alias("n"), F.expr("percentile(v, array(0.1, 0.5, 0.9))").alias("p"))
    g = g.select(*by, "n", F.col("p")[1].alias("med"), F.col("p")[0].alias("p10"), F.col("p")[2].alias("p90"))
    joined = x.join(g, list(by)) if by else x.crossJoin(F.broadcast(g))  # one row without groups
    mad = joined.groupBy(*by).agg(F.expr("percentile(abs(v - med), 0.5)").alias("mad"))
    return g.join(mad, list(by)) if by else g.crossJoin(mad)


def distribution_summary(df: DataFrame, value: str) -> DataFrame:
    """One row: count, mean, p10, p50, p90, p95 and max of the finite values."""
    return df.select(finite(value).alias("v")).where("v is not null").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), *[F.expr(f"percentile(v, {q})").alias(f"p{int(q * 100)}") for q in (0.1, 0.5, 0.9, 0.95)], F.max("v").alias("max"))


@dataclass(frozen=True)
class HealthGates:
    observations: float = 50
    hull: float = 0.15
    grid: float = 6
    reproj_p90: float = 3.0
    track: float = 3
    component: float = 0.95


def hull_area(points: np.ndarray) -> float:
    """Area of the convex hull of points in the plane; the hull is built along sorted points, one side after the other."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return 0.0

    def side(rows: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for q in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    h = np.array(side(p) + side(p[::-1]))
    x, y = h[:, 0], h[:, 1]
    return float(abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2)


@F.pandas_udf(DoubleType())
def hull_share(x: pd.Series, y: pd.Series, w: pd.Series, h: pd.Series) -> float:
    """Hull of an image's points over the image's area; points out of the image don't count."""
    xy = np.column_stack([x, y]).astype(float)
    inside = np.isfinite(xy).all(1) & (xy >= 0).all(1) & (xy[:, 0] <= w.iloc[0]) & (xy[:, 1] <= h.iloc[0]) if len(xy) else np.zeros(0, bool)
    area = float(w.iloc[0]) * float(h.iloc[0]) if len(xy) else 0.0
    return hull_area(xy[inside]) / area if area > 0 else 0.0


def image_metrics(cameras: DataFrame, images: DataFrame, observations: DataFrame, points: DataFrame) -> DataFrame:
    """For each image: observations with a point, grid cells, hull share, p90 of the point errors and mean track length."""
    sized = images.select("image_id", "camera_id", "name").join(cameras.select("camera_id", "width", "height"), "camera_id")
    tracks = observations.where("point3d_id is not null").groupBy("point3d_id").agg(F.countDistinct("image_id").alias("track"))
    seen = observations.where("point3d_id is not null").join(points.select("point3d_id", "error"), "point3d_id").join(tracks, "point3d_id").join(sized, "image_id")
    seen = seen.withColumn("cell", grid_cell("x", "y", "width", "height"))
    counts = seen.groupBy("image_id").agg(F.count("*").alias("observations"), F.countDistinct("cell").alias("grid"), F.expr("percentile(error, 0.9)").alias("error_p90"), F.avg("track").alias("mean_track"))
    hull = seen.groupBy("image_id").agg(hull_share("x", "y", "width", "height").alias("hull"))
    rows = sized.join(counts, "image_id", "left").join(hull, "image_id", "left")
    return rows.fillna({"observations": 0, "grid": 0, "hull": 0.0})


def weak_images(metrics: DataFrame, g: HealthGates = HealthGates()) -> DataFrame:
    """Images with reasons: too few observations, cells or hull, or errors too high."""
    from ..functions.exprs import reasons

    r = reasons([("few_observations", F.col("observations") < g.observations), ("low_grid", F.col("grid") < g.grid), ("low_hull", F.col("hull") < g.hull), ("high_error", F.col("error_p90") > g.reproj_p90)])
    return metrics.withColumn("reasons", r).where(F.size("reasons") > 0)


def readiness(summary: DataFrame, g: HealthGates = HealthGates()) -> DataFrame:
    """summary (median_observations, median_hull, median_grid, error_p90, median_track, largest_component) with score and grade.

    Fixed weights: .20 observations, .15 hull, .20 grid, .15 error, .15 track, .15 component.
    """
    parts = [
        (score_higher_better("median_observations", g.observations), 0.20),
        (score_higher_better("median_hull", g.hull), 0.15),
        (score_higher_better("median_grid", g.grid), 0.20),
        (score_lower_better("error_p90", g.reproj_p90), 0.15),
        (score_higher_better("median_track", g.track), 0.15),
        (score_higher_better("largest_component", g.component), 0.15),
    ]
    score = 100 * reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) * w for c, w in parts])
    return summary.withColumn("score", score).withColumn("grade", grade("score"))


def view_diversity(images: DataFrame, direction: str = "view_dir") -> DataFrame:
    """One row: 1 less the length of the mean viewing direction."""
    m = images.agg(*[F.avg(F.element_at(direction, i + 1)).alias(f"m{i}") for i in range(3)])
    return m.select((1 - F.least(F.lit(1.0), F.sqrt(F.col("m0") ** 2 + F.col("m1") ** 2 + F.col("m2") ** 2))).alias("diversity"))


def direction_diversity(rays: DataFrame, point: str, ray: str) -> DataFrame:
    """For each point the mean over pairs of (1 - cos) / 2 of its unit rays, from one pass: the rays' sum gives the mean of cosines."""
    unit = rays.select(point, F.transform(ray, lambda v: v / F.sqrt(dot(ray, ray))).alias("u"))
    g = unit.groupBy(point).agg(F.count("*").cast("double").alias("n"), *[F.sum(F.element_at("u", i + 1)).alias(f"s{i}") for i in range(3)])
    s2 = F.col("s0") ** 2 + F.col("s1") ** 2 + F.col("s2") ** 2
    return g.select(point, F.when(F.col("n") > 1, (F.col("n") ** 2 - s2) / (F.col("n") * (F.col("n") - 1)) / 2).alias("diversity"))


def triangulation_angles(rays: DataFrame, point: str, ray: str, order: str, most: int = 24) -> DataFrame:
    """The widest angle (degrees) between a point's rays; of more than `most` rays an even pick in the order is compared."""
    from .windows import select_evenly

    r = select_evenly(rays, [point], [order], most).select(point, order, F.transform(ray, lambda v: v / F.sqrt(dot(ray, ray))).alias("u"))
    p = r.alias("a").join(r.alias("b"), (F.col(f"a.{point}") == F.col(f"b.{point}")) & (F.col(f"a.{order}") < F.col(f"b.{order}")))
    return p.groupBy(F.col(f"a.{point}").alias(point)).agg(F.degrees(F.acos(clip(F.min(dot("a.u", "b.u")), -1.0, 1.0))).alias("angle_deg"))


def matchability(events: DataFrame, point: str = "point_id", half_life: float | None = None, alpha: float = 1.0, beta: float = 1.0, known: DataFrame | None = None) -> DataFrame:
    """(point, weight, p) of observed events: smoothed share of inliers, each event weighing less with age where a half-life is given. Unknown points go."""
    e = events.where("observed")
    if known is not None:
        e = e.join(known.select(point).distinct(), point, "left_semi")
    if half_life is None:
        w = F.lit(1.0)
    else:
        e = e.crossJoin(F.broadcast(e.agg(F.max("timestamp").alias("_latest"))))  # one row
        w = decay(F.col("_latest") - F.col("timestamp"), half_life)
    g = e.groupBy(point).agg(F.sum(w).alias("weight"), F.sum(F.when(F.col("inlier"), w).otherwise(0.0)).alias("hits"))
    return g.select(point, "weight", ((F.col("hits") + alpha) / (F.col("weight") + alpha + beta)).alias("p"))


#: The weights of a weak image's score.
WEAKNESS = {"observations": 0.22, "grid": 0.20, "hull": 0.16, "error": 0.12, "track": 0.16, "angle": 0.14}


def weakness(images: DataFrame, metrics: dict[str, tuple[str, bool]], weights: dict[str, float] = WEAKNESS) -> DataFrame:
    """images with `weakness` in [0, 1] and its completeness: robust badness of each metric (column, higher is worse) against all images."""
    rows = images
    for name, (column, worse) in metrics.items():
        base = distribution(images, column).select(*[F.col(c).alias(f"_{name}_{c}") for c in ("med", "mad", "p10", "p90")])
        rows = rows.crossJoin(F.broadcast(base))  # one row
        rows = rows.withColumn(f"bad_{name}", robust_badness(finite(column), f"_{name}_med", f"_{name}_mad", f"_{name}_p10", f"_{name}_p90", higher_is_worse=worse)).drop(*base.columns)
    score, share = weighted_observed([(f"bad_{n}", weights.get(n, 1.0)) for n in metrics])
    return rows.withColumn("weakness", score).withColumn("completeness", share)


def severity(weak: str = "weakness", by: Sequence[str] = ("region",)) -> list[Column]:
    """Aggregates of a region: .75 of the worst and .25 of the mean."""
    return [F.count("*").alias("images"), (0.75 * F.max(weak) + 0.25 * F.avg(weak)).alias("severity")]


def weak_regions(scored: DataFrame, id_col: str, xyz: Sequence[str], least: float = 0.35, radius: float | None = None) -> DataFrame:
    """(region, images, severity, status, centre) of clusters of weak images; the radius follows from the spacing where none is given."""
    from .graph import radius_components

    if radius is None:
        near = nearest_spacing(scored, id_col, xyz).first()
        radius = max(2.5 * (near["p50"] or 0.0), 1.5 * (near["p90"] or 0.0), 1e-9)
    weak = scored.where(F.col("weakness") >= least)
    r = weak.join(radius_components(weak, id_col, xyz, radius), id_col)
    g = r.groupBy(F.col("component").alias("region")).agg(*severity(), *[F.avg(c).alias(c) for c in xyz])
    return g.withColumn("status", F.when(F.col("severity") >= 0.75, "CRITICAL").when(F.col("severity") >= 0.5, "WEAK").otherwise("MARGINAL"))


def nearest_spacing(points: DataFrame, id_col: str, xyz: Sequence[str], start: float | None = None) -> DataFrame:
    """One row (n, p50, p90) of the distances to the nearest other point, coincident ones not counted.

    The search radius doubles until every point has a neighbour; only points without one go on.
    """
    box = points.agg(F.count("*").alias("n"), *[F.min(c).alias(f"lo_{c}") for c in xyz], *[F.max(c).alias(f"hi_{c}") for c in xyz]).first()
    span = max([(box[f"hi_{c}"] or 0.0) - (box[f"lo_{c}"] or 0.0) for c in xyz] + [0.0])
    if box["n"] < 2 or span <= 0:
        return points.agg(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("p50"), F.lit(None).cast("double").alias("p90"))
    radius = start or span / max(1.0, box["n"] ** (1 / len(xyz)))
    left, found = points.select(id_col, *xyz), None
    for _ in range(40):
        got = nearest_within(left, points, id_col, id_col, xyz, radius, exclude_self=True)
        found = got if found is None else found.unionByName(got)
        if radius > 2 * span:
            break
        left = left.join(got.select(F.col("left_id").alias(id_col)), id_col, "left_anti")
        if left.isEmpty():
            break
        radius *= 2
    return found.where("distance > 0").agg(F.count("*").alias("n"), F.expr("percentile(distance, 0.5)").alias("p50"), F.expr("percentile(distance, 0.9)").alias("p90"))


def robust_span(points: DataFrame, xyz: Sequence[str]) -> DataFrame:
    """One row: twice the p95 of the distances to the median point."""
    centre = points.agg(*[F.expr(f"percentile({c}, 0.5)").alias(f"_m_{c}") for c in xyz])
    d = F.sqrt(reduce(lambda a, b: a + b, [(F.col(c) - F.col(f"_m_{c}")) ** 2 for c in xyz]))
    return points.crossJoin(F.broadcast(centre)).withColumn("_d", d).agg((2 * F.expr("percentile(_d, 0.95)")).alias("span"))  # one row


def exclusive_points(seen: DataFrame, point: str, sequence: str) -> DataFrame:
    """Points that one sequence alone sees: (point, sequence)."""
    g = seen.groupBy(point).agg(F.min(sequence).alias(sequence), F.max(sequence).alias("_o"))
    return g.where(F.col(sequence) == F.col("_o")).drop("_o")


def sequence_support(seen: DataFrame, point: str, sequence: str) -> DataFrame:
    """(sequences, points): how many points so many sequences see."""
    return seen.groupBy(point).agg(F.countDistinct(sequence).alias("sequences")).groupBy("sequences").agg(F.count("*").alias("points"))


def spatial_entropy(df: DataFrame, by: Sequence[str], cell: str, cells: int) -> DataFrame:
    """Entropy of each group's cells over the greatest there can be."""
    c = df.groupBy(*by, cell).agg(F.count("*").alias("n"))
    t = c.groupBy(*by).agg(F.sum("n").alias("t"))
    p = F.col("n") / F.col("t")
    return c.join(t, list(by)).groupBy(*by).agg((F.sum(-p * F.log(p)) / F.lit(float(np.log(cells)))).alias("entropy"))


def residuals(observations: DataFrame, images: DataFrame, points: DataFrame, cameras: DataFrame) -> DataFrame:
    """Observations with the reprojection residual in pixels of a pinhole camera (fx, fy, cx, cy) and validity of the depth."""
    from ..functions.exprs import project_pinhole

    j = observations.where("point3d_id is not null").join(points.select("point3d_id", F.col("x").alias("_px"), F.col("y").alias("_py"), F.col("z").alias("_pz")), "point3d_id")
    j = j.join(images.select("image_id", "camera_id", "r_cw", "t_cw"), "image_id").join(cameras.select("camera_id", "params"), "camera_id")
    p = [F.element_at("params", i) for i in range(1, 5)]
    u, v, depth = project_pinhole([F.col("_px"), F.col("_py"), F.col("_pz")], "r_cw", "t_cw", *p)
    return j.withColumn("depth", depth).withColumn("residual", F.when(F.col("depth") > 0, F.sqrt((u - F.col("x")) ** 2 + (v - F.col("y")) ** 2))).drop("_px", "_py", "_pz", "params", "r_cw", "t_cw")


def residual_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("n"), F.sum((F.col("depth") <= 0).cast("long")).alias("invalid_depth"), F.sqrt(F.avg(F.col("residual") ** 2)).alias("rmse"), *[F.expr(f"percentile(residual, {q})").alias(f"p{int(q * 100)}") for q in (0.5, 0.9, 0.95)], F.max("residual").alias("max"))


def bearing_information(rows: DataFrame, by: Sequence[str], ray: str, depth: str, weight: str, sigma: float = 0.002, scale: float = 1.0) -> DataFrame:
    """Fisher information (upper triangle of 6 x 6: rotation, then translation) of unit rays seen at a depth, as 21 sums.

    A ray's Jacobian is (-[u]x, -(I - uu')/depth * scale); its square sums natively.
    """
    u = [F.element_at(ray, i + 1) for i in range(3)]
    skew = [[F.lit(0.0), -u[2], u[1]], [u[2], F.lit(0.0), -u[0]], [-u[1], u[0], F.lit(0.0)]]
    proj = [[(F.lit(1.0 if i == j else 0.0) - u[i] * u[j]) / F.col(depth) * scale for j in range(3)] for i in range(3)]
    jac = [[-skew[i][j] for j in range(3)] + [-proj[i][j] for j in range(3)] for i in range(3)]
    sums = []
    for a in range(6):
        for b in range(a, 6):
            sums.append(F.sum(F.col(weight) * reduce(lambda x, y: x + y, [jac[i][a] * jac[i][b] for i in range(3)]) / sigma**2).alias(f"f{a}{b}"))
    return rows.groupBy(*by).agg(*sums)


INFORMATION = "rank int, min_eigenvalue double, condition double, logdet double, worst_sigma double, weakest_direction array<double>"


def information_metrics(fim: DataFrame, by: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """Rank, least eigenvalue, condition, log-determinant, worst translation sigma and its direction of each matrix."""
    names = [f"f{a}{b}" for a in range(6) for b in range(a, 6)]

    @F.pandas_udf(INFORMATION)
    def of(values: pd.Series) -> pd.DataFrame:
        out = []
        for v in values:
            m = np.zeros((6, 6))
            m[np.triu_indices(6)] = v
            m = m + np.triu(m, 1).T
            e = np.linalg.eigvalsh(m)
            top = max(float(e[-1]), 1e-300)
            rank = int((e > tolerance * top).sum())
            cov = np.linalg.pinv(m)[3:, 3:]
            ev, vec = np.linalg.eigh(cov)
            worst = vec[:, -1] * (1 if vec[np.abs(vec[:, -1]).argmax(), -1] >= 0 else -1)
            out.append((rank, float(e[0]), float(top / e[0]) if e[0] > tolerance * top else None, float(np.log(np.maximum(e, 1e-300)).sum()), float(np.sqrt(max(ev[-1], 0.0))) if rank == 6 else None, worst.tolist()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in INFORMATION.split(", ")])

    return fim.select(*by, of(F.array(*names)).alias("m")).select(*by, "m.*")
