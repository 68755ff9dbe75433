"""Audits and repairs of reconstructions: short tracks, residuals, quarantined edges, intrinsics, topology, pairs, routes."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .spatial import nearest_within
from .windows import top_k


def without_short_tracks(points: DataFrame, tracks: DataFrame, least: int = 3) -> DataFrame:
    kept = tracks.groupBy("point3d_id").agg(F.countDistinct("image_id").alias("n")).where(F.col("n") >= least).select("point3d_id")
    return points.join(kept, "point3d_id", "left_semi")


def filter_residuals(rows: DataFrame, most: float = 8.0) -> tuple[DataFrame, DataFrame]:
    """Observations with a valid depth and a small residual, and one row of counts of the others."""
    bad_depth, bad_size = F.col("depth") <= 0, F.col("residual") > most
    stats = rows.agg(F.count("*").alias("n"), F.sum(bad_depth.cast("long")).alias("invalid_depth"), F.sum((~bad_depth & bad_size).cast("long")).alias("large_residual"))
    return rows.where(~bad_depth & (F.col("residual") <= most)), stats


def points_across(tracks: DataFrame, images: DataFrame, edges: DataFrame) -> DataFrame:
    """Points that both sequences of any given edge (a, b) see."""
    seen = tracks.join(images.select("image_id", "sequence"), "image_id").select("point3d_id", "sequence").distinct()
    e = edges.select(F.col("a").alias("sequence"), F.col("b").alias("_other"))
    return seen.join(e, "sequence").select("point3d_id", F.col("_other").alias("sequence")).join(seen, ["point3d_id", "sequence"], "left_semi").select("point3d_id").distinct()


def quarantine(points: DataFrame, tracks: DataFrame, images: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points without those across quarantined edges, and one row: points and observations removed."""
    gone = points_across(tracks, images, edges)
    removed = tracks.join(gone, "point3d_id", "left_semi").agg(F.countDistinct("point3d_id").alias("points"), F.count("*").alias("observations"))
    return points.join(gone, "point3d_id", "left_anti"), removed


def intrinsics_drift(cameras: DataFrame, seed: Sequence[float], focal: int = 2) -> DataFrame:
    """One row: the greatest relative drift of the first `focal` parameters and the greatest shift of the two after them."""
    rel = F.greatest(*[F.abs(F.element_at("params", i + 1) / seed[i] - 1) for i in range(focal)]) if focal > 1 else F.abs(F.element_at("params", 1) / seed[0] - 1)
    shift = F.greatest(*[F.abs(F.element_at("params", i + 1) - seed[i]) for i in range(focal, focal + 2)])
    return cameras.agg(F.max(rel).alias("focal_drift"), F.max(shift).alias("centre_shift_px"))


def topology_signature(tracks: DataFrame) -> DataFrame:
    """One row: a signature of all tracks that doesn't depend on their order. Points are hashed by themselves and the hashes summed."""
    per = tracks.groupBy("point3d_id").agg(F.sum(F.xxhash64("image_id", "point2d_idx").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    g = per.agg(F.sum(F.xxhash64("point3d_id", F.col("s").cast("string"), "n").cast("decimal(38,0)")).alias("s"), F.count("*").alias("points"), F.sum("n").alias("elements"))
    return g.select("points", "elements", F.sha2(F.concat_ws("|", F.col("s").cast("string"), "points", "elements"), 256).alias("signature"))


def compare_models(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """One row: images and points added and removed, the greatest shift of a centre and of a point, and the points' survival."""
    i = before["images"].select("name", F.col("centre").alias("_b")).join(after["images"].select("name", F.col("centre").alias("_a")), "name", "full_outer")
    step = F.sqrt(reduce(lambda x, y: x + y, [(F.element_at("_a", k) - F.element_at("_b", k)) ** 2 for k in (1, 2, 3)]))
    images = i.agg(F.sum(F.col("_b").isNull().cast("long")).alias("images_added"), F.sum(F.col("_a").isNull().cast("long")).alias("images_removed"), F.max(step).alias("max_centre_shift"))
    b, a = (m["points"].select("point3d_id", *[F.col(c).alias(f"{c}{s}") for c in "xyz"]) for m, s in ((before, "0"), (after, "1")))
    p = b.join(a, "point3d_id", "full_outer")
    move = F.sqrt(reduce(lambda x, y: x + y, [(F.col(f"{c}1") - F.col(f"{c}0")) ** 2 for c in "xyz"]))
    points = p.agg(F.sum(F.col("x0").isNull().cast("long")).alias("points_added"), F.sum(F.col("x1").isNull().cast("long")).alias("points_removed"), F.max(move).alias("max_point_shift"), F.expr("try_divide(count_if(x0 is not null and x1 is not null), count(x0))").alias("survival"))
    return images.crossJoin(points)  # one row each


def cross_map_points(matches: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(source_id, target_id, pairs): points of two maps that verified 2-D matches connect, with the number of image pairs.

    matches: image_a, idx_a, image_b, idx_b; left and right: observations (image_id, point2d_idx, point3d_id).
    """
    l = left.where("point3d_id is not null").select(F.col("image_id").alias("image_a"), F.col("point2d_idx").alias("idx_a"), F.col("point3d_id").alias("source_id"))
    r = right.where("point3d_id is not null").select(F.col("image_id").alias("image_b"), F.col("point2d_idx").alias("idx_b"), F.col("point3d_id").alias("target_id"))
    return matches.join(l, ["image_a", "idx_a"]).join(r, ["image_b", "idx_b"]).groupBy("source_id", "target_id").agg(F.countDistinct("image_a", "image_b").alias("pairs"))


def neighbour_summary(left: DataFrame, right: DataFrame, id_col: str, xyz: Sequence[str], reach: float) -> DataFrame:
    """One row: medians and p90 of the nearest distances both ways; points without a neighbour within reach count apart."""

    def one(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
        d = nearest_within(a, b, id_col, id_col, xyz, reach).agg(F.expr("percentile(distance, 0.5)").alias(f"{name}_median"), F.expr("percentile(distance, 0.9)").alias(f"{name}_p90"), F.count("*").alias("_n"))
        return d.crossJoin(a.agg(F.count("*").alias("_t"))).select(f"{name}_median", f"{name}_p90", (F.col("_t") - F.col("_n")).alias(f"{name}_alone"))

    return one(left, right, "forward").crossJoin(one(right, left, "backward"))  # one row each


def two_clusters(pairs: DataFrame, position: str, separation: float = 0.25, least: int = 3) -> DataFrame:
    """pairs with `side` 0 or 1: the ends of the range of positions are the seeds, each pair goes to the nearer one.

    An error where the ends are too near or a side is too small.
    """
    ends = pairs.agg(F.min(position).alias("_lo"), F.max(position).alias("_hi"), F.count("*").alias("_n"))
    rows = pairs.crossJoin(F.broadcast(ends))  # one row
    side = (F.abs(F.col(position) - F.col("_hi")) < F.abs(F.col(position) - F.col("_lo"))).cast("int")
    rows = rows.withColumn("side", side)
    sizes = rows.agg(F.sum("side").alias("_one"), F.sum(1 - F.col("side")).alias("_zero"))
    bad = (F.col("_hi") - F.col("_lo") < separation) | (F.least("_one", "_zero") < least) | (F.col("_n") < 2 * least)
    return rows.crossJoin(F.broadcast(sizes)).withColumn("side", F.when(bad, F.raise_error(F.lit("no two clusters")).cast("int")).otherwise(F.col("side"))).drop("_lo", "_hi", "_n", "_one", "_zero")  # one row


def nearest_pairs(centres: DataFrame, source: str, targets: Sequence[str], k: int, least_frame: int = 0) -> DataFrame:
    """For each image of a sequence, its k nearest images of each target sequence: (name, target, target_name, distance, rank)."""
    s = centres.where((F.col("sequence") == source) & (F.col("frame") >= least_frame)).select("name", *[F.col(c).alias(f"_{c}") for c in "xyz"])
    t = centres.where(F.col("sequence").isin(*targets)).select(F.col("name").alias("target_name"), F.col("sequence").alias("target"), *"xyz")
    d = F.sqrt(reduce(lambda a, b: a + b, [(F.col(c) - F.col(f"_{c}")) ** 2 for c in "xyz"]))
    # every image of one sequence with every image of the named others: the sequences are single videos
    j = s.join(t, F.lit(True)).select("name", "target", "target_name", d.alias("distance"))
    return top_k(j, ["name", "target"], ["distance", "target_name"], k, "rank")


def gap_pairs(frames: DataFrame, combos: DataFrame, most: int) -> DataFrame:
    """Even picks of frame pairs for missing pairs of sequences: the total is shared out evenly, rest to the first ones.

    frames: sequence, name, frame; combos: a, b. The n-th pick of one side meets the n-th of the other.
    """
    w = Window.orderBy("a", "b")  # pairs of sequences, few
    c = combos.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().withColumn("_i", F.row_number().over(w) - 1)
    c = c.crossJoin(F.broadcast(c.agg(F.count("*").alias("_n"))))  # one row
    c = c.withColumn("_k", (F.floor(F.lit(most) / F.col("_n")) + (F.col("_i") < F.lit(most) % F.col("_n")).cast("int")).cast("int")).where("_k > 0")
    sizes = frames.groupBy("sequence").agg(F.count("*").alias("_m"))
    place = frames.withColumn("_p", F.row_number().over(Window.partitionBy("sequence").orderBy("frame", "name")) - 1).select("sequence", "name", "_p")
    picks = c.join(sizes.toDF("a", "_ma"), "a").join(sizes.toDF("b", "_mb"), "b").withColumn("_j", F.explode(F.sequence(F.lit(0), F.least("_k", "_ma", "_mb").cast("int") - 1)))
    q = F.least("_k", "_ma", "_mb")
    at = lambda m: F.when(q > 1, F.rint(F.col("_j") * (F.col(m) - 1) / (q - 1))).otherwise(F.lit(0.0)).cast("int")
    picks = picks.select("a", "b", at("_ma").alias("_pa"), at("_mb").alias("_pb"))
    return picks.join(place.toDF("a", "name_a", "_pa"), ["a", "_pa"]).join(place.toDF("b", "name_b", "_pb"), ["b", "_pb"]).select("a", "b", "name_a", "name_b")


def distance_to_route(points: DataFrame, route: DataFrame, id_col: str, order: str = "seq", xyz: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Each point's distance to the nearest segment of one route. The route's segments go to the points by Spark's own size check."""
    w = Window.orderBy(order)  # one route
    s = route.select(*[F.col(c).alias(f"_a{c}") for c in xyz], *[F.lead(c).over(w).alias(f"_b{c}") for c in xyz]).where(F.col(f"_b{xyz[0]}").isNotNull())
    j = points.join(s, F.lit(True))
    ab2 = reduce(lambda a, b: a + b, [(F.col(f"_b{c}") - F.col(f"_a{c}")) ** 2 for c in xyz])
    t = F.when(ab2 > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), reduce(lambda a, b: a + b, [(F.col(c) - F.col(f"_a{c}")) * (F.col(f"_b{c}") - F.col(f"_a{c}")) for c in xyz]) / ab2))).otherwise(0.0)
    d = F.sqrt(reduce(lambda a, b: a + b, [(F.col(c) - F.col(f"_a{c}") - t * (F.col(f"_b{c}") - F.col(f"_a{c}"))) ** 2 for c in xyz]))
    return j.groupBy(id_col).agg(F.min(d).alias("distance"))


def merges_to_share(total: int, high: int, share: float = 0.1) -> int:
    """How many high records must go so that at most a share of what is left is high."""
    if total < 0 or high < 0 or high > total:
        raise ValueError("the counts are invalid")
    return max(0, math.ceil((high - share * total) / (1 - share) - 1e-12))


def source_jobs(pairs: DataFrame, chunk: int, limit: int | None = None) -> DataFrame:
    """(source, chunk, targets, job_id): sorted targets of each source in chunks, with a name from their content."""
    w = Window.partitionBy("source").orderBy("target")
    p = pairs.select("source", "target").distinct().withColumn("_i", F.row_number().over(w) - 1)
    if limit is not None:
        p = p.where(F.col("_i") < limit)
    g = p.groupBy("source", F.floor(F.col("_i") / chunk).alias("chunk")).agg(F.sort_array(F.collect_list("target")).alias("targets"))
    return g.withColumn("job_id", F.substring(F.sha2(F.concat_ws("\n", "source", F.array_join("targets", "\n")), 256), 1, 16))


def pair_file(lines: DataFrame, column: str = "value") -> DataFrame:
    """(a, b) of a text file of pairs, ends in order; a pair with itself or one that is there twice is an error."""
    f = F.split(F.trim(column), r"\s+")
    p = lines.where(F.trim(column) != "").select(F.least(f[0], f[1]).alias("a"), F.greatest(f[0], f[1]).alias("b"))
    g = p.groupBy("a", "b").agg(F.count("*").alias("n"))
    return g.select(F.when((F.col("a") == F.col("b")) | (F.col("n") > 1), F.raise_error(F.concat(F.lit("a bad pair: "), "a"))).otherwise(F.col("a")).alias("a"), "b")


def motion_roles(frames: DataFrame, records: DataFrame, default: str = "parallax", first: str = "seed") -> DataFrame:
    """(name, role): the record's role, else `first` for each sequence's first frame, else the default."""
    w = Window.partitionBy("sequence").orderBy("frame", "name")
    f = frames.withColumn("_first", F.row_number().over(w) == 1)
    return f.join(records.select("name", F.col("role").alias("_r")), "name", "left").select("name", F.coalesce("_r", F.when(F.col("_first"), first), F.lit(default)).alias("role"))


def rank_alignment(scores: DataFrame, left: str, right: str, score: str) -> DataFrame:
    """One row: Spearman's rho between the order of rows and that of their best matches (0 where undefined), and the median best score."""
    from .windows import percentile_rank

    best = scores.groupBy(left).agg(F.max(F.struct(F.col(score).alias("s"), (-F.col(right)).alias("r"))).alias("m")).select(F.col(left).alias("i"), (-F.col("m.r")).alias("j"), "m.s")
    r = percentile_rank(percentile_rank(best, "i", "_a"), "j", "_b")
    return r.agg(F.coalesce(F.nanvl(F.corr("_a", "_b"), F.lit(0.0)), F.lit(0.0)).alias("rho"), F.expr("percentile(s, 0.5)").alias("median_best"))
