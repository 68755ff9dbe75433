"""Sessions and the edges between them: merged evidence, reliability, bridges, roles, and the utility of a set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clip, finite, weighted_observed
from .gates import GEOMETRY, SessionEdgeGates, session_edge
from .graph import components
from .windows import percentile_rank

EDGE_FIELDS = ("num_candidates", "num_verified_pairs", "num_shared_tracks", "independent_bridge_groups", *GEOMETRY)


def _keyed(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("session_a", "session_b")]
    return df.where("session_a <> session_b").select(F.least("session_a", "session_b").alias("session_a"), F.greatest("session_a", "session_b").alias("session_b"), *rest)


def merge_edges(layers: Sequence[DataFrame], g: SessionEdgeGates = SessionEdgeGates()) -> DataFrame:
    """One row for each pair of sessions from layers of rising authority: a later layer's values win, candidates take the greatest; classified."""
    rows = None
    for i, layer in enumerate(layers):
        k = _keyed(layer)
        for f in EDGE_FIELDS:
            if f not in k.columns:
                k = k.withColumn(f, F.lit(None).cast("double"))
        k = k.select("session_a", "session_b", *[F.col(f).cast("double").alias(f) for f in EDGE_FIELDS], F.lit(i).alias("_i"))
        rows = k if rows is None else rows.unionByName(k)
    last = [F.max(F.when(finite(f).isNotNull(), F.struct(F.col("_i"), F.col(f).alias("v"))))["v"].alias(f) for f in EDGE_FIELDS if f != "num_candidates"]
    m = rows.groupBy("session_a", "session_b").agg(F.max("num_candidates").alias("num_candidates"), *last)
    status, why = session_edge(g)
    return m.withColumn("status", status).withColumn("reasons", why)


def shared_tracks(tracks: DataFrame, sessions: DataFrame) -> DataFrame:
    """(session_a, session_b, num_shared_tracks, observations_a, observations_b) of tracks (point3d_id, image_id) and images' sessions."""
    seen = tracks.join(sessions.select("image_id", "session"), "image_id").groupBy("point3d_id", "session").agg(F.count("*").alias("n"))
    p = seen.alias("x").join(seen.alias("y"), (F.col("x.point3d_id") == F.col("y.point3d_id")) & (F.col("x.session") < F.col("y.session")))
    return p.groupBy(F.col("x.session").alias("session_a"), F.col("y.session").alias("session_b")).agg(F.count("*").alias("num_shared_tracks"), F.sum("x.n").alias("observations_a"), F.sum("y.n").alias("observations_b"))


def bridge_groups(pairs: DataFrame, separation: int = 30) -> DataFrame:
    """pairs (session_a, session_b, frame_a, frame_b) with `bridge`: those near one another in frames on both sides are one bridge.

    Only neighbours in the order of frames are compared: two pairs near on both sides are joined through those
    between them, which are near as well on the first side; the second side is checked on each link.
    """
    key = ["session_a", "session_b"]
    w = Window.partitionBy(*key).orderBy("frame_a", "frame_b")
    n = pairs.withColumn("_id", F.concat_ws(":", *key, F.format_string("%012d", F.row_number().over(w))))
    cell = lambda c: F.floor(F.col(c) / separation)
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("o")
    left = n.select(*key, "_id", "frame_a", "frame_b", cell("frame_a").alias("_ca"), cell("frame_b").alias("_cb"), steps)
    left = left.select(*key, F.col("_id").alias("a"), F.col("frame_a").alias("_fa"), F.col("frame_b").alias("_fb"), (F.col("_ca") + F.col("o.i")).alias("_ca"), (F.col("_cb") + F.col("o.j")).alias("_cb"))
    right = n.select(*key, F.col("_id").alias("b"), "frame_a", "frame_b", cell("frame_a").alias("_ca"), cell("frame_b").alias("_cb"))
    links = left.join(right, [*key, "_ca", "_cb"]).where((F.col("a") < F.col("b")) & (F.abs(F.col("_fa") - F.col("frame_a")) < separation) & (F.abs(F.col("_fb") - F.col("frame_b")) < separation))
    c = components(n.select(F.col("_id").alias("node")), links.select("a", "b"))
    return n.join(c.select(F.col("node").alias("_id"), F.col("component").alias("bridge")), "_id").drop("_id")


#: Weights of an edge's reliability.
RELIABILITY = {"pairs": 0.15, "groups": 0.15, "tracks": 0.15, "geometry": 0.35, "holdout": 0.20}


def reliability() -> Column:
    """Reliability of an edge in [0, 1]: saturating counts, consensus, held-out inliers; missing terms lower it by completeness."""
    sat = lambda c, k: 1 - F.exp(-finite(c) / k)
    geometry = F.exp(-(finite("rotation_consensus_deg") / 5 + finite("translation_direction_consensus_deg") / 15 + finite("scale_consensus") / 0.15) / 3)
    terms = {"pairs": sat("num_verified_pairs", 8), "groups": sat("independent_bridge_groups", 2), "tracks": clip(F.log1p(finite("num_shared_tracks")) / F.log(F.lit(1001.0))), "geometry": geometry, "holdout": clip(finite("holdout_inlier_ratio"))}
    value, share = weighted_observed([(terms[k], w) for k, w in RELIABILITY.items()])
    return F.coalesce(value, F.lit(0.0)) * (0.5 + 0.5 * share)


def feature_anomalies(edges: DataFrame, features: Sequence[str], by: Sequence[str] = ("session_a", "session_b"), limit: float = 3.5) -> DataFrame:
    """edges with the root mean square of the robust z of their features, and whether it is over the limit."""
    from .health import distribution

    rows = edges
    for f in features:
        d = distribution(edges, f).select(F.col("med").alias(f"_m_{f}"), F.col("mad").alias(f"_s_{f}"))
        rows = rows.crossJoin(F.broadcast(d))  # one row
    z = [F.when(F.col(f"_s_{f}") > 0, (finite(f) - F.col(f"_m_{f}")) / (1.4826 * F.col(f"_s_{f}"))) for f in features]
    n = reduce(lambda a, b: a + b, [F.when(x.isNotNull(), 1).otherwise(0) for x in z])
    s = reduce(lambda a, b: a + b, [F.coalesce(x * x, F.lit(0.0)) for x in z])
    rows = rows.withColumn("anomaly", F.when(n > 0, F.sqrt(s / n)))
    return rows.select(*edges.columns, "anomaly", (F.coalesce(F.col("anomaly"), F.lit(0.0)) > limit).alias("anomalous"))


#: Weights of relative quality, in the order of reports.
RELATIVE = {"inliers": 0.20, "inlier_ratio": 0.15, "hull_coverage": 0.15, "grid4_occupancy": 0.10, "pose_consensus": 0.10, "positive_depth_ratio": 0.05, "reproj_p90_px": 0.10}


def relative_quality(results: DataFrame, key: str = "query", weights: dict[str, float] = RELATIVE) -> DataFrame:
    """(key, quality, completeness): tie-aware ranks of each metric, weighted over those that are there, times .70 + .30 * completeness."""
    rows = results.select(key, *weights)
    for m in weights:
        rows = percentile_rank(rows, m, f"_r_{m}", higher_is_better=m != "reproj_p90_px")
    value, share = weighted_observed([(f"_r_{m}", w) for m, w in weights.items()])
    return rows.select(key, (value * (0.70 + 0.30 * share)).alias("quality"), share.alias("completeness"))


#: Weights of a set's utility.
UTILITY = {"coverage": 1.0, "connectivity": 1.0, "redundancy": 1.0, "quality": 1.0, "holdout": 1.0, "diversity": 0.5, "cost": -0.5, "risk": -1.5}


def utility(weights: dict[str, float] = UTILITY) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(k), F.lit(0.0)) * w for k, w in weights.items()])


def leave_one_out(terms: DataFrame, key: str = "session", weights: dict[str, float] = UTILITY) -> DataFrame:
    """(key, delta): the utility of additive terms with each row, less that without it."""
    total = terms.agg(*[F.sum(F.coalesce(F.col(k), F.lit(0.0))).alias(k) for k in weights]).select(utility(weights).alias("_all"))
    rest = terms.crossJoin(F.broadcast(total)).withColumn("_own", utility(weights))  # one row
    return rest.select(key, F.col("_own").alias("delta"), (F.col("_all") - F.col("_own")).alias("utility_without"))


def roles(sessions: DataFrame, edges: DataFrame) -> DataFrame:
    """(session, best_status, strong_edges, role): CORE with two strong edges, SUPPORT with one usable, FRINGE with a weak one, else ISOLATED."""
    rank = F.when(F.col("status") == "STRONG", 4).when(F.col("status") == "USABLE", 3).when(F.col("status") == "AMBIGUOUS", 2).when(F.col("status") == "WEAK", 1).otherwise(0)
    ends = edges.select(F.explode(F.array("session_a", "session_b")).alias("session"), rank.alias("r"))
    g = ends.groupBy("session").agg(F.max("r").alias("best"), F.sum((F.col("r") == 4).cast("long")).alias("strong_edges"))
    j = sessions.select("session").join(g, "session", "left").fillna({"best": 0, "strong_edges": 0})
    names = F.element_at(F.array(*[F.lit(s) for s in ("REJECT", "WEAK", "AMBIGUOUS", "USABLE", "STRONG")]), F.col("best") + 1)
    role = F.when(F.col("strong_edges") >= 2, "CORE").when(F.col("best") >= 3, "SUPPORT").when(F.col("best") >= 1, "FRINGE").otherwise("ISOLATED")
    return j.select("session", names.alias("best_status"), "strong_edges", role.alias("role"))
