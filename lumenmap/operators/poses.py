"""Poses and what supports them: information of projected points, clusters of hypotheses, cycles, relative errors, reports on pairs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clip, col, finite, rotation_angle_deg
from .graph import components, hop_distances, radius_components
from .windows import top_k

#: The entries of a symmetric 6 x 6 matrix, by rows.
ENTRIES = [(i, j) for i in range(6) for j in range(i, 6)]


def information(points: DataFrame, by: Sequence[str], fx: float, fy: float, sigma: float = 1.0, length: float = 1.0) -> DataFrame:
    """The Fisher information of each pose from its points in the camera's frame (x, y, z, weight), as 21 sums.

    Rows of a point's Jacobian are those of its two pixel coordinates by translation (scaled by a length) and
    rotation. Points behind the camera and without weight don't count; a pose without points has zeros.
    """
    x, y, z, w = (col(c).cast("double") for c in ("x", "y", "z", "weight"))
    a, b = x / z, y / z
    u = [fx / z * length, F.lit(0.0), -fx * a / z * length, -fx * a * b, fx * (1 + a * a), -fx * b]
    v = [F.lit(0.0), fy / z * length, -fy * b / z * length, -fy * (1 + b * b), fy * a * b, fy * a]
    valid = (z > 1e-9) & (finite("weight") > 0)
    scale = w / max(sigma * sigma, 1e-12)
    sums = [F.coalesce(F.sum(F.when(valid, scale * (u[i] * u[j] + v[i] * v[j]))), F.lit(0.0)) for i, j in ENTRIES]
    return points.groupBy(*by).agg(F.array(*sums).alias("information"), F.count(F.when(valid, 1)).alias("points_used"))


SPECTRUM = "rank int, effective_rank double, lambda_min double, logdet double, condition double, trace_inverse double, translation_trace double, rotation_trace double, weakest string"


def spectrum(m: np.ndarray, regularization: float = 1e-9) -> tuple:
    """Rank, effective rank, least eigenvalue, log-determinant, capped condition, traces of the inverse, and the weakest direction of freedom."""
    values, vectors = np.linalg.eigh((m + m.T) / 2)
    values = np.maximum(values, 0.0)
    floor = max(values[-1] * 1e-8, 1e-12)
    big = values[values > floor]
    share = big / big.sum() if len(big) else big
    effective = float(np.exp(-(share * np.log(share)).sum())) if len(big) else 0.0
    condition = max(1.0, float(values[-1] / max(values[0], floor))) if len(big) else 1e12
    full = m + np.eye(6) * regularization
    inverse = np.linalg.pinv(full)
    weakest = ("tx", "ty", "tz", "rx", "ry", "rz")[int(np.argmax(np.abs(vectors[:, 0])))]
    return len(big), effective, float(values[0]), float(np.linalg.slogdet(full)[1]), condition, float(np.trace(inverse)), float(np.trace(inverse[:3, :3])), float(np.trace(inverse[3:, 3:])), weakest


def information_summary(column: str = "information") -> Column:
    """The spectrum of matrices that are given as 21 sums."""

    @F.pandas_udf(SPECTRUM)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rows, cols = zip(*ENTRIES)
        for s in batches:
            out = []
            for v in s:
                m = np.zeros((6, 6))
                m[rows, cols] = v
                out.append(spectrum(m + np.triu(m, 1).T))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SPECTRUM.split(", ")])

    return of(F.col(column))


def pose_quality(matches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of each pose the inliers by different points, their share, residuals, depths and references; of a point's matches the surest counts.

    Of equally sure matches that of the least reference counts, then that of the least error, then of the least
    depth, so that the order of rows has no say. matches: by, point, inlier, confidence, error, depth, reference.
    """
    all_points = matches.groupBy(*by).agg(F.count_distinct("point").alias("points"), F.count("*").alias("matches"))
    best = top_k(matches.where("inlier"), [*by, "point"], [F.desc("confidence"), "reference", "error", "depth"], 1)
    e = F.col("error")
    got = best.groupBy(*by).agg(F.count("*").alias("inliers"), F.sqrt(F.avg(e * e)).alias("rmse"), F.percentile("error", 0.5).alias("p50"), F.percentile("error", 0.9).alias("p90"), F.avg((F.col("depth") > 0).cast("double")).alias("positive_depth_ratio"), F.count_distinct("reference").alias("references"))
    rows = all_points.join(got, list(by), "left").fillna(0, ["inliers", "references"])
    return rows.withColumn("inlier_ratio", F.col("inliers") / F.greatest("points", F.lit(1)))


def support_proxy(poses: DataFrame, points: DataFrame, cameras: DataFrame, *, point_radius: float = 10.0, camera_radius: float = 10.0, enough_points: float = 200.0, enough_cameras: float = 10.0) -> DataFrame:
    """How well a place looks supported, in [0, 1]: points nearby by their weight, cameras nearby, and the likest of their views.

    poses: pose, x, y, z and the view fx, fy, fz; points: point, x, y, z, weight; cameras: camera, x, y, z, fx, fy, fz.
    """
    from .spatial import radius_pairs

    xyz = ("x", "y", "z")
    near = radius_pairs(poses, points, "pose", "point", xyz, point_radius).join(points.select(F.col("point").alias("right_id"), "weight"), "right_id")
    p = near.groupBy(F.col("left_id").alias("pose")).agg((F.least(F.count("*") / max(enough_points, 1.0), F.lit(1.0)) * F.avg("weight")).alias("_p"))
    seen = radius_pairs(poses, cameras, "pose", "camera", xyz, camera_radius)
    view = lambda df, k, n: df.select(F.col(k).alias(n), *[F.col(c).alias(f"_{n}_{c}") for c in ("fx", "fy", "fz")])
    seen = seen.join(view(poses, "pose", "left_id"), "left_id").join(view(cameras, "camera", "right_id"), "right_id")
    dot = sum((F.col(f"_left_id_{c}") * F.col(f"_right_id_{c}") for c in ("fy", "fz")), F.col("_left_id_fx") * F.col("_right_id_fx"))
    c = seen.groupBy(F.col("left_id").alias("pose")).agg(F.least(F.count("*") / max(enough_cameras, 1.0), F.lit(1.0)).alias("_c"), F.max((clip(dot, -1.0, 1.0) + 1) / 2).alias("_v"))
    z = lambda n: F.coalesce(n, F.lit(0.0))
    rows = poses.join(p, "pose", "left").join(c, "pose", "left")
    return rows.select("pose", clip(0.55 * z("_p") + 0.25 * z("_c") + 0.20 * z("_v")).alias("support"))


# hypotheses and cycles


def marker_clusters(markers: DataFrame, id_col: str, radius: float) -> DataFrame:
    """Clusters of markers within the radius of one another: their least marker, centre and size."""
    named = radius_components(markers, id_col, ("x", "y", "z"), radius)
    return markers.join(named, id_col).groupBy(F.col("component").alias("cluster")).agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.avg("z").alias("z"), F.count("*").alias("members"))


def hypothesis_clusters(hypotheses: DataFrame, radius: float, most_turn: float) -> DataFrame:
    """Clusters of pose hypotheses (id, query, x, y, z, yaw_deg, score) of a query that are near in place and direction, with the sum of their scores."""
    h = lambda n: hypotheses.select(*[F.col(c).alias(f"{n}_{c}") for c in ("id", "query", "x", "y", "z", "yaw_deg")])
    # the few hypotheses of a query meet each other only
    pairs = h("a").join(h("b"), (F.col("a_query") == F.col("b_query")) & (F.col("a_id") < F.col("b_id")))
    d2 = sum((F.pow(F.col(f"a_{c}") - F.col(f"b_{c}"), 2) for c in "yz"), F.pow(F.col("a_x") - F.col("b_x"), 2))
    turn = F.abs(F.pmod(F.col("a_yaw_deg") - F.col("b_yaw_deg") + 180, F.lit(360.0)) - 180)
    links = pairs.where((d2 <= radius * radius) & (turn <= most_turn)).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    named = components(hypotheses.select(F.col("id").alias("node")), links).withColumnRenamed("node", "id")
    return hypotheses.join(named, "id").groupBy("query", F.col("component").alias("cluster")).agg(F.sum("score").alias("score"), F.count("*").alias("members"))


def similarity_cycle(a: Sequence[str], b: Sequence[str]) -> tuple[Column, Column, Column]:
    """Rotation (degrees), translation and relative scale of a after the inverse of b; each is (scale, rotation of 9, translation of 3)."""
    sa, ra, ta = (F.col(c) for c in a)
    sb, rb, tb = (F.col(c) for c in b)
    g = lambda m, i: F.element_at(m, i + 1)
    s = sa / sb
    # the rotation of a times the transpose of b's, then what is left of the translation
    r = [[sum((g(ra, 3 * i + k) * g(rb, 3 * j + k) for k in (1, 2)), g(ra, 3 * i) * g(rb, 3 * j)) for j in range(3)] for i in range(3)]
    t = [g(ta, i) - s * sum((r[i][j] * g(tb, j) for j in (1, 2)), r[i][0] * g(tb, 0)) for i in range(3)]
    return rotation_angle_deg(ra, rb), F.sqrt(t[0] * t[0] + t[1] * t[1] + t[2] * t[2]), F.abs(s - 1)


def relative_pose_error(pairs: DataFrame, images: DataFrame) -> DataFrame:
    """For each pair (a, b, rotation, direction) how far its two-view pose is off the map's: degrees, and 1 less the alignment of the directions.

    images: image, rotation (9, world to camera) and translation (3). Null where the pair has no direction.
    """
    i = lambda n: images.select(F.col("image").alias(n), F.col("rotation").alias(f"_r{n}"), F.col("translation").alias(f"_t{n}"))
    rows = pairs.join(i("a"), "a").join(i("b"), "b")
    g = lambda m, k: F.element_at(m, k + 1)
    rel = [[sum((g(F.col("_rb"), 3 * p + k) * g(F.col("_ra"), 3 * q + k) for k in (1, 2)), g(F.col("_rb"), 3 * p) * g(F.col("_ra"), 3 * q)) for q in range(3)] for p in range(3)]
    t = [g(F.col("_tb"), p) - sum((rel[p][q] * g(F.col("_ta"), q) for q in (1, 2)), rel[p][0] * g(F.col("_ta"), 0)) for p in range(3)]
    d = [g(F.col("direction"), p) for p in range(3)]
    size = lambda v: F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    dot = (t[0] * d[0] + t[1] * d[1] + t[2] * d[2]) / F.nullif(size(t) * size(d), F.lit(0.0))
    return rows.select("a", "b", rotation_angle_deg(F.array(*[x for row in rel for x in row]), F.col("rotation")).alias("rotation_error_deg"), (1 - F.abs(dot)).alias("direction_error"))


def diameter(edges: DataFrame, most: int) -> DataFrame:
    """The greatest number of hops between two nodes that edges connect, found up to `most`: one row."""
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return hop_distances(edges, nodes, most).agg(F.max("hops").alias("diameter"))


# reports


def image_roles(rows: DataFrame, name: str = "name") -> DataFrame:
    """The role of each image by its name, and by its file name where that is no name of its own; a later row of a name wins (column order)."""
    role = F.coalesce("role", "image_role", "motion_role")
    named = rows.select(F.col(name).alias("image"), role.alias("role"), "order").where("image is not null and role is not null")
    whole = named.groupBy("image").agg(F.max_by("role", "order").alias("role"))
    base = named.select(F.element_at(F.split("image", "/"), -1).alias("image"), "role", "order").groupBy("image").agg(F.min_by("role", "order").alias("role"))
    return whole.unionByName(base.join(whole.select("image"), "image", "left_anti"))


def pair_report(pairs: DataFrame, images: DataFrame) -> DataFrame:
    """Counts of pairs by relation (same video, across videos, across directions), motion classes of both ends, and kind.

    images: image, video, direction, motion.
    """
    i = lambda n: images.select(F.col("image").alias(n), *[F.col(c).alias(f"{n}_{c}") for c in ("video", "direction", "motion")])
    rows = pairs.join(i("a"), "a").join(i("b"), "b")
    relation = F.when(F.col("a_direction") != F.col("b_direction"), "cross_direction").when(F.col("a_video") != F.col("b_video"), "cross_video").otherwise("same_video")
    motion = F.array_join(F.array_sort(F.array(F.coalesce("a_motion", F.lit("parallax")), F.coalesce("b_motion", F.lit("parallax")))), "+")
    return rows.groupBy(relation.alias("relation"), motion.alias("motion"), F.coalesce("kind", F.lit("unknown")).alias("kind")).agg(F.count("*").alias("pairs"))


def core_or_support(drops: DataFrame, key: str = "session", by: Sequence[str] = ("base",), coverage: float = 0.02, information: float = 0.02, connectivity: float = 0.05, redundancy: float = 0.15) -> DataFrame:
    """CORE or SUPPORT of each session of a base, by what the base loses without it; without any core the best of quality is it."""
    core = (F.col("coverage") >= coverage) | (F.col("information") >= information) | (F.col("connectivity") > connectivity) | (F.col("redundancy") > redundancy)
    w = Window.partitionBy(*by)
    rows = drops.withColumn("_core", core).withColumn("_any", F.max(F.col("_core").cast("int")).over(w)).withColumn("_n", F.row_number().over(w.orderBy(F.desc("quality"), key)))
    return rows.select(*drops.columns, F.when(F.col("_core") | ((F.col("_any") == 0) & (F.col("_n") == 1)), "CORE").otherwise("SUPPORT").alias("part"))


def balanced_folds(groups: list[tuple[str, int, int]], folds: int) -> dict[str, int]:
    """A fold for each group (name, rows, failures), the largest first: one each to begin with, then the fold whose own rows and failures come nearest to an equal share. Ties of size go to the most unusual rate, then by name."""
    total, failed = sum(g[1] for g in groups), sum(g[2] for g in groups)
    rate = failed / max(1, total)
    order = sorted(groups, key=lambda g: (-g[1], -abs(g[2] / max(1, g[1]) - rate), g[0]))
    want = np.array([total / folds, failed / folds])
    held, out = np.zeros((folds, 2)), {}
    for k, (name, n, f) in enumerate(order):
        cost = (((held + (n, f) - want) / np.maximum(want, 1.0)) ** 2).sum(axis=1)
        fold = k if k < folds else min(range(folds), key=lambda i: (cost[i], held[i, 0], held[i, 1], i))
        out[name], held[fold] = fold, held[fold] + (n, f)
    return out


def stable_associations(associations: DataFrame, pixels: DataFrame, stable: int = 1) -> DataFrame:
    """Associations (image, x, y) whose rounded pixel the image's mask calls stable."""
    place = [F.rint("x").cast("long").alias("_x"), F.rint("y").cast("long").alias("_y")]
    good = pixels.where(F.col("label") == stable).select("image", F.col("x").cast("long").alias("_x"), F.col("y").cast("long").alias("_y")).distinct()
    return associations.select("*", *place).join(good, ["image", "_x", "_y"], "left_semi").select(*associations.columns)


def grouped_frames(frames: DataFrame, name: str = "name") -> DataFrame:
    """Frames with their sequence (the name's first part), file name and place within the sequence."""
    parts = frames.withColumn("sequence", F.substring_index(name, "/", 1)).withColumn("filename", F.expr(f"substring({name}, length(sequence) + 2)"))
    return parts.withColumn("place", F.row_number().over(Window.partitionBy("sequence").orderBy("filename")) - 1)


def resolution_groups(videos: DataFrame) -> DataFrame:
    return videos.groupBy("width", "height").agg(F.count("*").alias("videos"), F.array_sort(F.collect_list("video")).alias("names"))


def corpus_problems(videos: DataFrame) -> DataFrame:
    """Names of rules that a corpus (sequence, path, part: BUILD or TEST) breaks: a sequence twice in BUILD, sequences or paths in both parts."""
    b = F.col("part") == "BUILD"
    n = lambda c: F.count(F.when(c, 1))
    s = videos.groupBy("sequence").agg(n(b).alias("b"), n(~b).alias("t"))
    p = videos.groupBy("path").agg(n(b).alias("b"), n(~b).alias("t"))
    rows = s.where("b > 1").select(F.lit("repeated_sequence").alias("problem"), F.col("sequence").alias("name"))
    rows = rows.unionByName(s.where("b > 0 and t > 0").select(F.lit("shared_sequence").alias("problem"), F.col("sequence").alias("name")))
    return rows.unionByName(p.where("b > 0 and t > 0").select(F.lit("shared_path").alias("problem"), F.col("path").alias("name")))


def checked_manifest(queries: DataFrame, name: str = "query") -> DataFrame:
    """The trimmed names of a manifest; an error at an empty or a repeated one."""
    rows = queries.select(F.trim(F.col(name)).alias(name)).groupBy(name).agg(F.count("*").alias("_n"))
    bad = F.coalesce(F.col(name) == "", F.lit(True)) | (F.col("_n") > 1)
    return rows.select(F.when(bad, F.raise_error(F.concat(F.lit("empty or repeated query: "), F.coalesce(F.col(name), F.lit(""))))).otherwise(F.col(name)).alias(name))


def current_first(current: DataFrame, historical: DataFrame, modes: DataFrame, key: str = "query") -> DataFrame:
    """For each query the current map's pose if it is strict, else the historical one's unless several modes compete; else none."""
    h = historical.select(key, F.col("strict").alias("_strict"), F.col("pose").alias("_pose"))
    rows = current.join(h, key, "left").join(modes.select(key, F.col("modes").alias("_modes")), key, "left")
    one = F.coalesce(F.col("_modes"), F.lit(1)) <= 1
    source = F.when(F.col("strict"), "CURRENT").when(F.col("_strict") & one, "HISTORICAL").when(F.col("_strict"), "AMBIGUOUS").otherwise("FAILED")
    return rows.select(key, source.alias("source"), F.when(source == "CURRENT", F.col("pose")).when(source == "HISTORICAL", F.col("_pose")).alias("pose"))
