"""Joins in space: pairs within a radius, nearest neighbours, voxels. A lattice of cells makes them equi-joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cells(xyz: Sequence[str], size: float) -> list[Column]:
    return [F.floor(F.col(c) / size).cast("long").alias(f"_k{i}") for i, c in enumerate(xyz)]


def _halo(xyz: Sequence[str], size: float, rings: int = 1) -> Column:
    steps = range(-rings, rings + 1)
    offsets = F.array(*[F.struct(*[F.lit(v).cast("long").alias(f"d{i}") for i, v in enumerate(o)]) for o in product(steps, repeat=len(xyz))])
    return F.explode(offsets).alias("_o")


def squared_distance(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [(x - y) * (x - y) for x, y in zip(left, right)])


def radius_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, xyz: Sequence[str], radius: float) -> DataFrame:
    """(left_id, right_id, distance) of all pairs within the radius; cells have the radius as size, so 3 ** n cells hold all candidates.

    Points with a null or NaN coordinate have no pairs.
    """
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in xyz])
    n = len(xyz)
    l = left.where(ok).select(F.col(left_id).alias("left_id"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(xyz)], *_cells(xyz, radius), _halo(xyz, radius))
    l = l.select("left_id", *[f"_x{i}" for i in range(n)], *[(F.col(f"_k{i}") + F.col(f"_o.d{i}")).alias(f"_k{i}") for i in range(n)])
    r = right.where(ok).select(F.col(right_id).alias("right_id"), *[F.col(c).cast("double").alias(f"_y{i}") for i, c in enumerate(xyz)], *_cells(xyz, radius))
    d2 = squared_distance([F.col(f"_x{i}") for i in range(n)], [F.col(f"_y{i}") for i in range(n)])
    return l.join(r, [f"_k{i}" for i in range(n)]).select("left_id", "right_id", F.sqrt(d2).alias("distance")).where(F.col("distance") <= radius)


def nearest_within(left: DataFrame, right: DataFrame, left_id: str, right_id: str, xyz: Sequence[str], radius: float, k: int = 1, exclude_self: bool = False) -> DataFrame:
    """The k nearest right points within the radius of each left point, ties by id: (left_id, right_id, distance, rank)."""
    pairs = radius_pairs(left, right, left_id, right_id, xyz, radius)
    if exclude_self:
        pairs = pairs.where("left_id <> right_id")
    if k == 1:
        best = pairs.groupBy("left_id").agg(F.min(F.struct("distance", "right_id")).alias("m"))
        return best.select("left_id", "m.right_id", "m.distance", F.lit(1).alias("rank"))
    w = Window.partitionBy("left_id").orderBy("distance", "right_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("left_id", "right_id", "distance", "rank")


def voxel_sample(points: DataFrame, id_col: str, xyz: Sequence[str], size: float, most: int) -> DataFrame:
    """The first `most` points of each voxel in the order of ids."""
    w = Window.partitionBy(*[f"_k{i}" for i in range(len(xyz))]).orderBy(id_col)
    rows = points.select("*", *_cells(xyz, size)).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most)
    return rows.drop("_r", *[f"_k{i}" for i in range(len(xyz))])


def halo_distance(source: DataFrame, target: DataFrame, id_col: str, xyz: Sequence[str], size: float) -> DataFrame:
    """Each source point's distance to the nearest target in its cell's neighbourhood, twice the size where there is none."""
    n = len(xyz)
    s = source.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(xyz)], *_cells(xyz, size), _halo(xyz, size))
    s = s.select("id", *[f"_x{i}" for i in range(n)], *[(F.col(f"_k{i}") + F.col(f"_o.d{i}")).alias(f"_k{i}") for i in range(n)])
    t = target.select(*[F.col(c).cast("double").alias(f"_y{i}") for i, c in enumerate(xyz)], *_cells(xyz, size))
    d2 = squared_distance([F.col(f"_x{i}") for i in range(n)], [F.col(f"_y{i}") for i in range(n)])
    joined = s.join(t, [f"_k{i}" for i in range(n)], "left").withColumn("_d", F.sqrt(d2))
    return joined.groupBy("id").agg(F.coalesce(F.min("_d"), F.lit(2.0 * size)).alias("distance"))


def supported_cells(left: DataFrame, right: DataFrame, xyz: Sequence[str], size: float) -> DataFrame:
    """One row: the lesser of the two numbers of cells that have a point of the other side in their neighbourhood."""
    keys = [f"_k{i}" for i in range(len(xyz))]

    def directed(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
        cells = a.select(*_cells(xyz, size)).distinct()
        around = cells.select(*keys, _halo(xyz, size)).select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], *[(F.col(k) + F.col(f"_o.d{i}")).alias(k) for i, k in enumerate(keys)])
        hit = around.join(b.select(*_cells(xyz, size)).distinct(), keys, "left_semi").select(*[f"_c{i}" for i in range(len(keys))]).distinct()
        return hit.agg(F.count("*").alias(name))

    both = directed(left, right, "l").crossJoin(directed(right, left, "r"))  # one row each
    return both.select(F.least("l", "r").alias("supported_cells"))


def weighted_history(queries: DataFrame, history: DataFrame, query_id: str, history_id: str, xyz: Sequence[str], values: Sequence[str], radius: float = 2.0, floor: float = 0.25, forward: str | None = None, most_angle_deg: float = 60.0) -> DataFrame:
    """For each query the records within the radius (and view angle), and means weighted by 1 / max(distance, floor) over values that are there."""
    pairs = radius_pairs(queries, history, query_id, history_id, xyz, radius)
    rows = pairs.join(history.select(F.col(history_id).alias("right_id"), *values, *([F.col(forward).alias("_hf")] if forward else [])), "right_id")
    if forward:
        from ..functions.exprs import angle_between_deg

        rows = rows.join(queries.select(F.col(query_id).alias("left_id"), F.col(forward).alias("_qf")), "left_id").where(angle_between_deg("_qf", "_hf") <= most_angle_deg)
    w = 1.0 / F.greatest("distance", F.lit(floor))
    means = [(F.sum(w * F.col(v).cast("double")) / F.sum(F.when(F.col(v).isNotNull(), w))).alias(v) for v in values]
    return rows.groupBy(F.col("left_id").alias(query_id)).agg(F.count("*").alias("records"), *means)
