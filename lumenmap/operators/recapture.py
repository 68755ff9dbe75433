"""Recapture: what the cells of a region show, whether their metrics may be used, and what repairs of existing data reach.

A cell is a pose and a direction in a region with metrics. Metrics come as rows (region, cell, metric, value, status),
so a new metric is a row, not a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clip, col, finite
from ..storage import cut
from .graph import components
from .windows import last_before, ordered_numbers

# points and depths


def point_weight(track="track_length", error="error", midpoint: float = 4.0, slope: float = 0.8, scale: float = 2.0) -> Column:
    """A prior in [0, 1] for a landmark to be seen again: it rises with the track's length and falls with the error."""
    grown = 1 / (1 + F.exp(-slope * (col(track) - midpoint)))
    return clip(grown * F.exp(-F.greatest(col(error), F.lit(0.0)) / max(scale, 1e-6)))


def depth_summary(depths: DataFrame, by: Sequence[str], depth: str = "depth") -> DataFrame:
    """Of each group: the share of positive depths, their deciles and median, spread over the median, and the entropy of their logarithms in 8 bins."""
    good = F.when(finite(depth) > 0, finite(depth))
    p = F.percentile(good, [0.1, 0.25, 0.5, 0.75, 0.9])
    stats = depths.groupBy(*by).agg(F.avg(good.isNotNull().cast("double")).alias("positive_depth_ratio"), p.alias("_p"), F.min(F.log(good)).alias("_lo"), F.max(F.log(good)).alias("_hi"), F.count(good).alias("_n"))
    rows = depths.select(*by, F.log(good).alias("_log")).where("_log is not null").join(stats.select(*by, "_lo", "_hi", "_n"), list(by)).where("_hi > _lo")
    bins = rows.groupBy(*by, F.least(F.lit(7), F.floor((F.col("_log") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 8)).alias("_bin")).agg(F.count("*").alias("_c"), F.first("_n").alias("_n"))
    share = F.col("_c") / F.col("_n")
    entropy = bins.groupBy(*by).agg((-F.sum(share * F.log(share)) / F.log(F.lit(8.0))).alias("depth_entropy"))
    at = lambda i: F.element_at("_p", i)
    return stats.join(entropy, list(by), "left").select(
        *by, "positive_depth_ratio", at(1).alias("depth_p10"), at(3).alias("depth_p50"), at(5).alias("depth_p90"),
        ((at(4) - at(2)) / F.greatest(F.abs(at(3)), F.lit(1e-12))).alias("depth_iqr_ratio"), F.coalesce("depth_entropy", F.lit(0.0)).alias("depth_entropy"),
    )


def query_geometry(visible: DataFrame, observations: DataFrame, by: Sequence[str] = ("query",), expansion: float = 0.40, parallax: float = 2.0) -> DataFrame:
    """Of each query, over the points that it sees: angles, ranges beside those of the map's own views, and the share outside their envelope.

    visible: by, point, range_m and angle_deg; observations: point and range_m of each view of the map.
    """
    past = observations.where("range_m > 1e-9").groupBy("point").agg(F.percentile("range_m", 0.5).alias("_mid"), F.min("range_m").alias("_near"), F.max("range_m").alias("_far"))
    e = min(max(expansion, 0.0), 0.95)
    rows = visible.dropDuplicates([*by, "point"]).join(past, "point", "left")
    known, r = F.col("_mid").isNotNull(), F.col("range_m")
    outside = known & ~r.between((1 - e) * F.col("_near"), (1 + e) * F.col("_far"))
    q = lambda c, p: F.percentile(c, p)
    ratio = F.when(F.col("_mid") > 1e-12, r / F.col("_mid"))
    return rows.groupBy(*by).agg(
        q("angle_deg", 0.1).alias("angle_p10"), q("angle_deg", 0.5).alias("angle_p50"), q("angle_deg", 0.9).alias("angle_p90"),
        F.avg((F.col("angle_deg") < parallax).cast("double")).alias("low_parallax_fraction"),
        q("range_m", 0.5).alias("range_p50"), q("_mid", 0.5).alias("past_range_p50"), q(ratio, 0.5).alias("scale_ratio_p50"), q(ratio, 0.9).alias("scale_ratio_p90"),
        (F.sum(outside.cast("int")) / F.greatest(F.sum(known.cast("int")), F.lit(1))).alias("extrapolated_fraction"),
    )


def query_matchability(visible: DataFrame, matchability: DataFrame, by: Sequence[str] = ("query",), least: float = 0.3) -> DataFrame:
    """Of each query, over the points that it sees: how many can be matched, how many have evidence, and their mean and sum."""
    rows = visible.join(matchability.select("point", finite("p").alias("_p")), "point", "left")
    return rows.groupBy(*by).agg(F.sum(F.coalesce((F.col("_p") >= least).cast("long"), F.lit(0))).alias("matchable"), F.avg(F.col("_p").isNotNull().cast("double")).alias("evidenced_fraction"), F.avg("_p").alias("mean"), F.coalesce(F.sum("_p"), F.lit(0.0)).alias("effective"))


# regions of images and their pairs


def region_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Of each region: counts, medians and shares of the pairs inside it and between it and its anchors.

    pairs: a, b, selected, num_matches, num_inliers, inlier_ratio, planar, pose_bad, degenerate; members: region, image, anchor.
    """
    m = members.select("region", F.col("image").alias("a"), F.col("anchor").alias("_x"))
    n = members.select("region", F.col("image").alias("b"), F.col("anchor").alias("_y"))
    rows = pairs.join(m, "a").join(n, ["region", "b"]).where("not (_x and _y)")
    inner = ~F.col("_x") & ~F.col("_y")
    tried, ok = F.col("num_matches").isNotNull(), F.coalesce(F.col("num_inliers"), F.lit(0)) > 0
    count = lambda c: F.sum(c.cast("long"))
    share = lambda c: F.avg(F.col(c).cast("double"))
    return rows.groupBy("region").agg(
        F.count("*").alias("candidate_pairs"), count(inner).alias("internal_pairs"), count(~inner).alias("anchor_pairs"), share("selected").alias("selected_ratio"), count(tried).alias("attempted_pairs"), count(ok).alias("verified_pairs"),
        F.percentile("num_matches", 0.5).alias("matches_p50"), F.percentile(F.when(tried, F.col("num_inliers")), 0.5).alias("inliers_p50"), share("planar").alias("planar_fraction"), share("pose_bad").alias("pose_bad_fraction"), count(F.coalesce("degenerate", F.lit(False))).alias("degenerate_pairs"),
    )


def anchor_track_ratio(tracks: DataFrame, members: DataFrame, points: DataFrame) -> DataFrame:
    """Of each region's points (region, point), the share that both its members and its anchors see."""
    seen = tracks.join(members, "image").groupBy("region", "point").agg((F.max(F.col("anchor").cast("int")) - F.min(F.col("anchor").cast("int")) == 1).alias("both"))
    return points.distinct().join(seen, ["region", "point"], "left").groupBy("region").agg(F.avg(F.coalesce(F.col("both").cast("double"), F.lit(0.0))).alias("anchor_track_ratio"))


def largest_share(images: DataFrame, tracks: DataFrame) -> DataFrame:
    """The share of images (image) in the largest component of those that any point joins. Each point's images link to its least, so links are linear."""
    t = tracks.join(images.select("image").distinct(), "image", "left_semi").select("image", "point").distinct()
    hub = t.groupBy("point").agg(F.min("image").alias("a"), F.count("*").alias("n")).where("n > 1")
    links = t.join(hub, "point").where("image <> a").select("a", F.col("image").alias("b")).distinct()
    sizes = components(images.select(F.col("image").alias("node")), links).groupBy("component").agg(F.count("*").alias("n"))
    return sizes.agg((F.max("n") / F.sum("n")).alias("largest_share"))


# cells


def weighted_success(cells: DataFrame, by: Sequence[str], success: str = "success_rate", attempts: str = "attempts") -> DataFrame:
    """The success rate weighted by attempts; the median of the rates where no attempts are known."""
    s, n = finite(success), F.when((finite(attempts) > 0) & finite(success).isNotNull(), finite(attempts))
    return cells.groupBy(*by).agg(F.coalesce(F.sum(s * n) / F.sum(n), F.percentile(s, 0.5)).alias("success_rate"))


def directional(cells: DataFrame, by: Sequence[str], health: str = "health") -> DataFrame:
    """Of each region: means over positions of the best, mean and worst health of their directions, and how much the direction matters.

    Values that a position has already (best, mean, worst, all three) go before those of its directions.
    """
    place = [F.round(c, 6).alias(f"_{c}") for c in ("x", "y", "z")]
    given = F.when(F.col("best").isNotNull() & F.col("mean").isNotNull() & F.col("worst").isNotNull(), F.struct("cell", "best", "mean", "worst"))
    h = F.col(health)
    per = cells.select(*by, *place, h.alias("_h"), given.alias("_given")).groupBy(*by, "_x", "_y", "_z").agg(F.min("_given").alias("g"), F.max("_h").alias("hi"), F.avg("_h").alias("mid"), F.min("_h").alias("lo"))
    pick = lambda f, c: F.avg(F.coalesce(F.col(f"g.{f}"), F.col(c))).alias(f)
    out = per.groupBy(*by).agg(pick("best", "hi"), pick("mean", "mid"), pick("worst", "lo"))
    return out.withColumn("sensitivity", F.col("best") - F.col("mean"))


REQUIRED = {"visible_landmark_count": 50.0, "inlier_convex_hull_coverage": 0.2, "grid_occupancy_count": 8.0, "positive_depth_ratio": 0.95, "fim_rank": 6.0, "triangulation_angle_p10_deg": 2.0, "view_direction_entropy": 0.4}
CAPPED = {"fim_condition_number": 1e6}
MORE = {"fim_effective_rank": 3.0, "track_length_p50": 3.0}
MORE_CAPPED = {"reprojection_error_p90_px": 3.0}


def structural_health() -> Column:
    """The mean share of their targets that a region's metrics reach, each at most 1; null unless the required ones are all there."""
    up = lambda c, t: clip(finite(c) / max(t, 1e-9))
    down = lambda c, t, least: clip(t / F.greatest(finite(c), F.lit(least)))
    first = {c: up(c, t) for c, t in REQUIRED.items()} | {c: down(c, t, 1.0) for c, t in CAPPED.items()}
    more = {c: up(c, t) for c, t in MORE.items()} | {c: down(c, t, 1e-9) for c, t in MORE_CAPPED.items()}
    whole = F.lit(True)
    for c in first:
        whole = whole & finite(c).isNotNull()
    total, n = F.lit(0.0), F.lit(0)
    for c, v in (first | more).items():
        there = finite(c).isNotNull()
        total, n = total + F.when(there, v).otherwise(0.0), n + there.cast("int")
    return F.when(whole, total / n)


def audit_metrics(metrics: DataFrame, cells: DataFrame, specs: DataFrame, by: Sequence[str] = ("region",)) -> DataFrame:
    """For each region and metric of specs (metric, requirement, low, high): how many cells have it, and its state.

    metrics: by, cell, metric, value, status (MEASURED, ESTIMATED, UNAVAILABLE, NOT_APPLICABLE). A value beyond its
    bounds is INVALID, one that is only estimated is ESTIMATED_ONLY. A region passes a metric that all cells pass.
    """
    wanted = cells.select(*by, "cell").crossJoin(F.broadcast(specs))  # specs: one row for each named metric
    rows = wanted.join(metrics, [*by, "cell", "metric"], "left")
    there = F.coalesce(~F.col("status").isin("UNAVAILABLE", "NOT_APPLICABLE"), F.lit(False)) & F.col("value").isNotNull()
    good = F.coalesce(finite("value").between(F.coalesce("low", F.lit(float("-inf"))), F.coalesce("high", F.lit(float("inf")))), F.lit(False))
    state = F.when(~there, "MISSING").when(~good, "INVALID").when(F.col("status") == "ESTIMATED", "ESTIMATED_ONLY").otherwise("PASS")
    rows = rows.withColumn("_state", state)
    n = lambda s: F.sum((F.col("_state") == s).cast("long"))
    got = rows.groupBy(*by, "metric", "requirement").agg(F.count("*").alias("cells"), n("PASS").alias("usable"), n("ESTIMATED_ONLY").alias("estimated"), n("MISSING").alias("missing"), n("INVALID").alias("invalid"))
    summary = F.when(F.col("missing") == F.col("cells"), "MISSING").when(F.col("invalid") > 0, "INVALID").when(F.col("estimated") == F.col("cells"), "ESTIMATED_ONLY").when(F.col("usable") == F.col("cells"), "PASS").otherwise("PARTIAL")
    return got.withColumn("state", summary)


def readiness(audit: DataFrame, by: Sequence[str] = ("region",)) -> DataFrame:
    """Of each audited region: whether its integrity metrics and those that authorise a recapture all pass, and what blocks it."""
    bad = lambda *r: F.col("requirement").isin(*r) & (F.col("state") != "PASS")
    block = F.array_sort(F.collect_list(F.when(bad("INTEGRITY", "RECAPTURE_AUTHORIZATION"), F.col("metric"))))
    return audit.groupBy(*by).agg(
        (F.sum(bad("INTEGRITY").cast("int")) == 0).alias("integrity_ready"),
        (F.sum(bad("INTEGRITY", "RECAPTURE_AUTHORIZATION").cast("int")) == 0).alias("authorization_ready"),
        (F.sum(bad("DIAGNOSTIC").cast("int")) == 0).alias("diagnosis_ready"),
        block.alias("blocking"),
    )


def plan_regions(cells: DataFrame, audit: DataFrame, by: Sequence[str] = ("region",), healthy: float = 0.95) -> DataFrame:
    """Of each region its success, directions, readiness and decision.

    HEALTHY by its success; else, without integrity, FIX_EVIDENCE; RECAPTURE where that is authorised and even the
    best directions fall short; REPAIR_EXISTING where they don't; and COLLECT_EVIDENCE for the rest.
    """
    rows = weighted_success(cells, by).join(directional(cells, by), list(by)).join(readiness(audit, by), list(by), "left")
    ready = lambda c: F.coalesce(c, F.lit(False))
    decision = (
        F.when(F.col("success_rate") >= healthy, "HEALTHY")
        .when(~ready("integrity_ready"), "FIX_EVIDENCE")
        .when(F.col("best") >= healthy, "REPAIR_EXISTING")
        .when(ready("authorization_ready"), "RECAPTURE")
        .otherwise("COLLECT_EVIDENCE")
    )
    return rows.withColumn("decision", decision)


def counterfactual(trials: DataFrame, required: DataFrame, by: Sequence[str] = ("region",), healthy: float = 0.95) -> DataFrame:
    """Of each region: the best repair of existing data, and whether every stage declared beforehand was tried.

    trials: by, stage, before, after, stable_ok, order. A repair's score is the share of the gap to `healthy` that it
    closes, none if stable places got worse; of equal ones the earliest counts. required: by and stage.
    """
    gap = F.lit(healthy) - F.col("before")
    score = F.when(~F.col("stable_ok"), 0.0).when(gap <= 0, 1.0).otherwise(clip((F.col("after") - F.col("before")) / gap))
    rows = trials.withColumns({"stage": F.trim("stage"), "_score": score})
    best = rows.groupBy(*by).agg(F.max_by(F.struct("stage", "_score"), F.struct(F.col("_score"), -F.col("order"))).alias("b"))
    tried = rows.select(*by, "stage").distinct().withColumn("_tried", F.lit(True))
    whole = required.select(*by, F.trim("stage").alias("stage")).where("stage <> ''").distinct().join(tried, [*by, "stage"], "left").groupBy(*by).agg(F.min(F.coalesce("_tried", F.lit(False))).alias("complete"))
    return whole.join(best, list(by), "left").select(*by, "complete", F.col("b.stage").alias("best_stage"), F.coalesce(F.col("b._score"), F.lit(0.0)).alias("repairability"))


# consensus of references


def selective_normalization(consensus: DataFrame) -> DataFrame:
    """Medians of both spreads over queries that have a covariance: one row, fitted on queries held out for it."""
    return consensus.where("sigma_cons_m is not null").agg(F.percentile("sigma_cons_m", 0.5).alias("median_cons"), F.percentile("sigma_disp_m", 0.5).alias("median_disp"), F.count("*").alias("eligible")).where("eligible > 0")


def sigma_joint(consensus: DataFrame, normalization: DataFrame) -> DataFrame:
    """consensus with the greater of its two spreads over their medians; null without a covariance."""
    floor = lambda c: F.greatest(F.col(c), F.lit(1e-12))
    joint = F.when(F.col("sigma_cons_m").isNotNull(), F.greatest(F.col("sigma_cons_m") / floor("median_cons"), F.col("sigma_disp_m") / floor("median_disp")))
    return consensus.join(F.broadcast(normalization), how="left").select(*consensus.columns, joint.alias("sigma_joint"))  # one row at most


def consensus_status(*, dispersion: float = 0.5, sigma: float = 0.5, rotation: float = 5.0, eligible: float = 0.5, least: int = 2) -> tuple[Column, Column]:
    """The status of a query's references and the greatest ratio of a measure to its limit.

    Columns hypothesis_count, sigma_disp_m, rotation_dispersion_deg, covariance_eligible_ratio and sigma_cons_m. Too
    few hypotheses go before disagreement of centres or rotations and before weak observability.
    """
    count, disp, rot, share, cons = (F.col(c) for c in ("hypothesis_count", "sigma_disp_m", "rotation_dispersion_deg", "covariance_eligible_ratio", "sigma_cons_m"))
    ratios = [F.lit(float(max(least, 1))) / F.greatest(count, F.lit(1)), disp / dispersion, rot / rotation, F.coalesce(cons / sigma, F.lit(1 + 1e-9))]
    if eligible > 0:
        ratios.append(eligible / F.greatest(share, F.lit(1e-12)))
    apart = (disp > dispersion) | F.coalesce(rot > rotation, F.lit(False))
    dim = (share < eligible) | F.coalesce(cons > sigma, F.lit(True))
    status = F.when(count < max(least, 1), "INSUFFICIENT_EVIDENCE").when(apart & dim, "CRITICAL").when(apart, "REFERENCE_DISAGREEMENT").when(dim, "OBSERVABILITY_WEAK").otherwise("HEALTHY")
    return status, F.greatest(*ratios)


# risk


def equal_mass_bins(df: DataFrame, risk: str, bins: int) -> DataFrame:
    """df with bin: about equal numbers of rows in ascending order of risk, ties never parted.

    A bin ends with the tie group that fills it. The groups are summed up in ranges; each bin's end is one query.
    """
    ties = df.groupBy(F.col(risk).alias("_r")).agg(F.count("*").alias("_n"))
    sums = cut(ordered_numbers(ties, ["_r"], "_n").select("_r", (F.col("running") - F.col("_n")).alias("_before"), "running"), "mass-bins")
    total = sums.agg(F.max("running")).first()[0] or 0
    target = max(1, -(-total // max(1, min(bins, total))))
    starts = [0]
    while len(starts) < bins:
        end = sums.where(F.col("running") >= starts[-1] + target).agg(F.min("running")).first()[0]
        if end is None or end >= total:
            break
        starts.append(end)
    which = F.size(F.filter(F.array(*[F.lit(x) for x in starts]), lambda x: x <= F.col("_before"))) - 1
    return df.join(sums.select(F.col("_r").alias(risk), which.alias("bin")), risk)


def coverage_deciles(df: DataFrame, risk: str, failed: str, key: str) -> DataFrame:
    """At each tenth of coverage: the rows accepted, their failure rate and the greatest risk among them. Rows go by risk, ties by key."""
    rows = ordered_numbers(df.select(risk, F.col(failed).cast("double").alias("_f"), key), [risk, key], "_f")
    total = df.agg(F.count("*").alias("n"))
    steps = total.select("n", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("tenth")).select("tenth", F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("tenth") / 10)).alias("place"), "n")
    return rows.join(F.broadcast(steps), "place").select((F.col("place") / F.col("n")).alias("coverage"), (F.col("running") / F.col("place")).alias("failure_rate"), F.col(risk).alias("most_risk"), F.col("place").alias("accepted"))  # ten rows


def apply_steps(df: DataFrame, risk: str, steps: DataFrame, to: str = "probability") -> DataFrame:
    """df with the probability of an isotonic calibrator: that of the last step (threshold, probability) at or below the risk, else of the first.

    Rows and steps are sorted together by range, so steps may be as many as they like.
    """
    return last_before(df, risk, steps, "threshold", "probability", to)


# projections


def history_rows(results: DataFrame) -> DataFrame:
    """Localisation results with a finite place, under the names that a history has."""
    names = {"inliers": ("pnp_inliers", "long"), "inlier_ratio": ("inlier_ratio", "double"), "grid4_occupancy": ("grid_occupancy", "long"), "hull_coverage": ("hull_coverage", "double"), "positive_depth_ratio": ("positive_depth_ratio", "double"), "reproj_p90_px": ("reproj_p90", "double")}
    place = [finite(c).alias(c) for c in ("x", "y", "z")]
    return results.select("query", *place, "success", *[F.col(c).cast(t).alias(n) for c, (n, t) in names.items() if c in results.columns]).where("x is not null and y is not null and z is not null")


def frame_of_direction(x, y, z) -> Column:
    """Nine numbers, by rows: a right-handed frame whose third column is the direction; null for one of no length."""
    x, y, z = (col(c).cast("double") for c in (x, y, z))
    n = F.sqrt(x * x + y * y + z * z)
    fx, fy, fz = x / n, y / n, z / n
    steep = F.abs(fz) >= 0.9
    # the hint, z or y for a steep one, crossed with the direction
    rx, ry, rz = F.when(steep, fz).otherwise(-fy), F.when(steep, F.lit(0.0)).otherwise(fx), F.when(steep, -fx).otherwise(F.lit(0.0))
    m = F.sqrt(rx * rx + ry * ry + rz * rz)
    rx, ry, rz = rx / m, ry / m, rz / m
    ux, uy, uz = fy * rz - fz * ry, fz * rx - fx * rz, fx * ry - fy * rx
    return F.when(n >= 1e-12, F.array(rx, ux, fx, ry, uy, fy, rz, uz, fz))


def grid_occupancy(points: DataFrame, by: Sequence[str], width: str = "width", height: str = "height", rows: int = 4, cols: int = 4) -> DataFrame:
    """How many cells of the image's grid hold a point; points beyond the image count to its nearest cells."""
    cell = lambda c, size, k: F.least(F.greatest((F.col(c) / F.greatest(F.col(size), F.lit(1)) * k).cast("int"), F.lit(0)), F.lit(k - 1))
    return points.groupBy(*by).agg(F.count_distinct(cell("v", height, rows) * cols + cell("u", width, cols)).alias("occupied"))


def attempts_summary(attributed: DataFrame, rate: str = "0.95") -> DataFrame:
    """Of attributed queries (strict, attribution): totals, the successes that the rate demands in whole numbers, and the status. One row."""
    from fractions import Fraction

    target = Fraction(rate)
    total, ok = F.count("*"), F.sum(F.col("strict").cast("long"))
    got = attributed.agg(total.alias("total"), F.coalesce(ok, F.lit(0)).alias("successes"))
    need = F.floor((F.col("total") * target.numerator + (target.denominator - 1)) / target.denominator).cast("long")
    return got.withColumn("required", need).withColumn("status", F.when((F.col("total") > 0) & (F.col("successes") >= need), "PASS").otherwise("FAIL"))

