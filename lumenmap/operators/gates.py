"""Gates: ordered reasons for failure, decisions with their receipts, and audits of references.

A gate whose evidence is missing fails closed where the rule says so; each decision row keeps its reasons.
Thresholds are parameters with the usual defaults.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import col, finite, reasons


@dataclass(frozen=True)
class LocalizationGates:
    min_inliers: float = 25
    min_inlier_ratio: float = 0.25
    max_reproj_p90_px: float = 3.0
    min_hull_coverage: float = 0.15
    min_grid4_occupancy: float = 6
    min_positive_depth_ratio: float = 1.0
    min_pose_consensus: float = 0.67
    min_strict_rate: float = 0.95
    required: tuple[str, ...] = ()

    def rules(self) -> list[tuple[str, str, str, float]]:
        """(reason, metric, direction, limit) in the order of reports."""
        return [
            ("low_inliers", "inliers", "<", self.min_inliers),
            ("low_inlier_ratio", "inlier_ratio", "<", self.min_inlier_ratio),
            ("high_reprojection_error", "reproj_p90_px", ">", self.max_reproj_p90_px),
            ("low_hull_coverage", "hull_coverage", "<", self.min_hull_coverage),
            ("low_grid_occupancy", "grid4_occupancy", "<", self.min_grid4_occupancy),
            ("low_positive_depth_ratio", "positive_depth_ratio", "<", self.min_positive_depth_ratio),
            ("low_pose_consensus", "pose_consensus", "<", self.min_pose_consensus),
        ]


def failures(gates: LocalizationGates = LocalizationGates(), columns: Sequence[str] | None = None) -> Column:
    """Ordered reasons of a localisation row; a null metric is no reason unless it is required."""
    have = set(columns) if columns is not None else {m for _, m, _, _ in gates.rules()}
    rules: list[tuple[str, Column]] = [("localization_failed", ~F.col("success"))]
    for reason, metric, way, limit in gates.rules():
        if metric not in have:
            if metric in gates.required:
                rules.append((f"missing_{metric}", F.lit(True)))
            continue
        v = F.col(metric)
        if metric in gates.required:
            rules.append((f"missing_{metric}", v.isNull()))
        rules.append((reason, v < limit if way == "<" else v > limit))
    return reasons(rules)


def with_failures(results: DataFrame, gates: LocalizationGates = LocalizationGates()) -> DataFrame:
    """results with `reasons` and `strict` (no reason)."""
    r = results.withColumn("reasons", failures(gates, results.columns))
    return r.withColumn("strict", F.size("reasons") == 0)


def validate_results(results: DataFrame) -> DataFrame:
    """The rows, or an error at the first value out of its domain: shares in [0, 1], counts and errors not negative, cells 0 to 16."""
    checks = []
    for c in ("inlier_ratio", "hull_coverage", "positive_depth_ratio", "pose_consensus"):
        if c in results.columns:
            checks.append((c, (F.col(c) < 0) | (F.col(c) > 1) | F.isnan(c)))
    for c in ("inliers", "reproj_p90_px", "position_error_m", "rotation_error_deg"):
        if c in results.columns:
            checks.append((c, F.col(c) < 0))
    if "grid4_occupancy" in results.columns:
        checks.append(("grid4_occupancy", (F.col("grid4_occupancy") < 0) | (F.col("grid4_occupancy") > 16)))
    checks.append(("query", F.col("query").isNull() | (F.trim("query") == "")))
    bad = reasons(checks)
    return results.withColumn("query", F.when(F.size(bad) > 0, F.raise_error(F.concat(F.lit("out of domain: "), F.array_join(bad, ",")))).otherwise(F.col("query")))


def summarize(rows: DataFrame) -> DataFrame:
    """One row: total, raw and strict rate, deciles and medians of the metrics."""
    p = lambda c, q: F.expr(f"percentile({c}, {q})")
    return rows.agg(
        F.count("*").alias("total"),
        F.avg(F.col("success").cast("double")).alias("raw_rate"),
        F.avg(F.col("strict").cast("double")).alias("strict_rate"),
        p("inliers", 0.1).alias("p10_inliers"),
        p("inliers", 0.5).alias("median_inliers"),
        p("reproj_p90_px", 0.9).alias("p90_reproj"),
    )


def reason_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def leave_one_criterion(rows: DataFrame, gates: LocalizationGates = LocalizationGates()) -> DataFrame:
    """For each criterion the strict rate if it did not count: (criterion, strict_rate, gain)."""
    aggs = []
    for reason, metric, _, _ in gates.rules():
        without = F.array_except("reasons", F.array(F.lit(reason), F.lit(f"missing_{metric}")))
        aggs.append(F.avg((F.size(without) == 0).cast("double")).alias(metric))
    base = F.avg(F.col("strict").cast("double")).alias("_strict")
    one = rows.agg(base, *aggs)
    pairs = ", ".join(f"'{m}', `{m}`" for _, m, _, _ in gates.rules())
    return one.select("_strict", F.expr(f"stack({len(gates.rules())}, {pairs}) as (criterion, strict_rate)")).select("criterion", "strict_rate", (F.col("strict_rate") - F.col("_strict")).alias("gain"))


def cell_regions(rows: DataFrame, xyz: Sequence[str] = ("x", "y", "z"), size: float = 5.0, least: int = 2) -> DataFrame:
    """Cells with failures: (cell, n, failures, strict_rate, status); rows without a place are not in any cell."""
    from ..functions.exprs import cell_of

    placed = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in xyz]))
    g = placed.groupBy(cell_of(size, *xyz).alias("cell")).agg(F.count("*").alias("n"), F.sum((~F.col("strict")).cast("long")).alias("failures"))
    g = g.withColumn("strict_rate", 1 - F.col("failures") / F.col("n")).where("failures > 0")
    return g.withColumn("status", F.when(F.col("n") < least, "INSUFFICIENT_EVIDENCE").otherwise("WEAK"))


@dataclass(frozen=True)
class ComparisonGates:
    max_rate_drop: tuple[int, int] = (2, 100)
    max_inlier_drop: float = 0.05
    max_reproj_rise: float = 0.5
    max_new_failures: tuple[int, int] = (2, 100)


def compare(base: DataFrame, candidate: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """One row for each query of the universe (the manifest, or all of either side) with both sides and `change`.

    A query that a side lacks failed there.
    """
    b = base.select("query", F.col("strict").alias("base"), F.col("inliers").alias("base_inliers"), F.col("reproj_p90_px").alias("base_reproj"))
    c = candidate.select("query", F.col("strict").alias("candidate"), F.col("inliers").alias("candidate_inliers"), F.col("reproj_p90_px").alias("candidate_reproj"))
    rows = b.join(c, "query", "full_outer") if manifest is None else manifest.select("query").distinct().join(b, "query", "left").join(c, "query", "left")
    rows = rows.withColumn("base", F.coalesce("base", F.lit(False))).withColumn("candidate", F.coalesce("candidate", F.lit(False)))
    change = F.when(F.col("base") & ~F.col("candidate"), "newly_failed").when(~F.col("base") & F.col("candidate"), "newly_recovered").when(F.col("base"), "common_success").otherwise("common_failure")
    return rows.withColumn("change", change)


def comparison_gate(rows: DataFrame, gates: ComparisonGates = ComparisonGates()) -> DataFrame:
    """One row: counts, medians over common successes, the failed gates and the status; rates are compared in whole numbers."""
    common = F.col("change") == "common_success"
    med = lambda c: F.expr(f"percentile({c}, 0.5) filter (where change = 'common_success')")
    one = rows.agg(
        F.count("*").alias("n"),
        F.sum(F.col("base").cast("long")).alias("base_ok"),
        F.sum(F.col("candidate").cast("long")).alias("candidate_ok"),
        F.sum((F.col("change") == "newly_failed").cast("long")).alias("newly_failed"),
        F.sum((F.col("change") == "newly_recovered").cast("long")).alias("newly_recovered"),
        F.sum(common.cast("long")).alias("common"),
        med("base_inliers").alias("base_inliers"),
        med("candidate_inliers").alias("candidate_inliers"),
        med("base_reproj").alias("base_reproj"),
        med("candidate_reproj").alias("candidate_reproj"),
    )
    drop, new = gates.max_rate_drop, gates.max_new_failures
    failed = reasons(
        [
            ("success_rate_drop", (F.col("base_ok") - F.col("candidate_ok")) * drop[1] > F.col("n") * drop[0]),
            ("new_failures", F.col("newly_failed") * new[1] > F.col("n") * new[0]),
            ("inlier_drop", F.col("candidate_inliers") < F.col("base_inliers") * (1 - gates.max_inlier_drop)),
            ("reprojection_rise", F.col("candidate_reproj") > F.col("base_reproj") + gates.max_reproj_rise),
        ]
    )
    return one.withColumn("failed_gates", failed).withColumn("status", F.when(F.col("n") == 0, "FAIL").when(F.size("failed_gates") == 0, "PASS").otherwise("FAIL"))


# maps


def integrity_checks(cameras: DataFrame, images: DataFrame, observations: DataFrame, points: DataFrame, tracks: DataFrame) -> DataFrame:
    """(check, violations, ok) over references and finiteness; an empty table violates nothing."""

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")

    obs = observations.where("point3d_id is not null")
    link = obs.select("point3d_id", "image_id", "point2d_idx")
    parts = [
        count(images.join(cameras, "camera_id", "left_anti"), "image_camera_known"),
        count(observations.join(images, "image_id", "left_anti"), "observation_image_known"),
        count(obs.join(points, "point3d_id", "left_anti"), "observation_point_known"),
        count(tracks.join(images, "image_id", "left_anti"), "track_image_known"),
        count(tracks.join(points, "point3d_id", "left_anti"), "track_point_known"),
        count(tracks.join(link, ["point3d_id", "image_id", "point2d_idx"], "left_anti"), "track_has_observation"),
        count(link.join(tracks, ["point3d_id", "image_id", "point2d_idx"], "left_anti"), "observation_has_track"),
        count(points.where(finite("x").isNull() | finite("y").isNull() | finite("z").isNull()), "point_finite"),
        count(points.where((F.col("error") < 0) | F.isnan("error")), "point_error_valid"),
        count(images.groupBy("name").count().where("count > 1"), "image_name_unique"),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("ok", F.col("violations") == 0)


def overall_status(map_ok, localization_ok, integrity_ok=True) -> Column:
    """One word for the map and the localisation together; null: not measured."""
    m, l, i = (c if isinstance(c, Column) else F.lit(c) for c in (map_ok, localization_ok, integrity_ok))
    return F.when(~i, "MAP_INVALID").when(l.isNull(), F.when(m, "MAP_OK_LOCALIZATION_UNKNOWN").otherwise("MAP_WEAK_LOCALIZATION_UNKNOWN")).when(m & l, "READY").when(m, "LOCALIZATION_LIMITED").when(l, "MAP_WEAK_LOCALIZATION_OK").otherwise("NOT_READY")


def attribute_failure(strict, code, map_codes: Sequence[str], alias_codes: Sequence[str], localizer_codes: Sequence[str]) -> Column:
    """Who is to blame for a failed query, from its diagnosis code."""
    s, c = col(strict), col(code)
    return F.when(s, "OK").when(c.isin(*map_codes), "MAP_LIMITED").when(c.isin(*alias_codes), "ALIAS_OR_PNP").when(c.isin(*localizer_codes), "LOCALIZER_LIMITED").otherwise("UNATTRIBUTED")


# decisions on evidence


def pair_relation(a: str, b: str, folder: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs with same_video, cross_video and cross_direction, from (name, folder, direction)."""
    f = folder.select("name", "folder", "direction")
    x = pairs.join(f.toDF(a, "_fa", "_da"), a, "left").join(f.toDF(b, "_fb", "_db"), b, "left")
    return x.select(*pairs.columns, (F.col("_fa") == F.col("_fb")).alias("same_video"), (F.col("_fa") != F.col("_fb")).alias("cross_video"), (F.col("_da") != F.col("_db")).alias("cross_direction"))


def keep_pairs_by_role(pairs: DataFrame, roles: DataFrame, a: str = "a", b: str = "b", keep: str = "parallax") -> tuple[DataFrame, DataFrame]:
    """Pairs of which both ends have the role, and one row with what was removed. Unknown names count as that role."""
    r = roles.select("name", "role")
    x = pairs.join(r.toDF(a, "_ra"), a, "left").join(r.toDF(b, "_rb"), b, "left")
    ok = (F.coalesce("_ra", F.lit(keep)) == keep) & (F.coalesce("_rb", F.lit(keep)) == keep)
    stats = x.agg(F.count("*").alias("pairs"), F.sum((~ok).cast("long")).alias("removed"))
    return x.where(ok).select(pairs.columns), stats


def motion_class(tracks, flow, rotation_deg, blur, essential_inliers, homography_ratio, parallax_px, *, least_tracks: int = 12, hover_px: float = 0.8, fast_px: float = 35, fast_blur: float = 25, rotation: float = 0.35, still_px: float = 0.75, planar: float = 0.9, least_inliers: int = 20, low_parallax: float = 2.0) -> Column:
    """The motion of an interval; evidence that is missing or not finite gives UNKNOWN."""
    t, f, r, bl, e, h, p = (finite(c) for c in (tracks, flow, rotation_deg, blur, essential_inliers, homography_ratio, parallax_px))
    return (
        F.when(t.isNull() | f.isNull() | (t < least_tracks), "UNKNOWN")
        .when(f < hover_px, "HOVER")
        .when((f > fast_px) & (F.coalesce(bl, F.lit(1e9)) < fast_blur), "FAST_BLUR")
        .when((F.abs(r) >= rotation) & (p <= still_px) & (h >= planar), "PURE_ROTATION")
        .when(e < least_inliers, "WEAK_GEOMETRY")
        .when(p < low_parallax, "LOW_PARALLAX")
        .otherwise("PARALLAX")
    )


@dataclass(frozen=True)
class SessionEdgeGates:
    tracks: int = 30
    pairs: int = 8
    rotation_deg: float = 5
    translation_deg: float = 15
    scale: float = 0.15
    reprojection_px: float = 5
    holdout_ratio: float = 0.45
    groups: int = 2


GEOMETRY = ("rotation_consensus_deg", "translation_direction_consensus_deg", "scale_consensus", "cross_session_reprojection_error", "holdout_inlier_ratio")


def session_edge(g: SessionEdgeGates = SessionEdgeGates()) -> tuple[Column, Column]:
    """(status, reasons) of an edge between sessions: REJECT, WEAK, AMBIGUOUS, USABLE or STRONG. Similarity alone never passes WEAK."""
    complete = reduce(lambda a, b: a & b, [finite(c).isNotNull() for c in GEOMETRY])
    bad = reasons(
        [
            ("no_verified_pairs", F.coalesce("num_verified_pairs", F.lit(0)) <= 0),
            ("few_pairs", F.coalesce("num_verified_pairs", F.lit(0)) < g.pairs),
            ("few_tracks", F.coalesce("num_shared_tracks", F.lit(0)) < g.tracks),
            ("few_independent_groups", F.coalesce("independent_bridge_groups", F.lit(0)) < g.groups),
            ("geometry_incomplete", ~complete),
            ("rotation_inconsistent", finite("rotation_consensus_deg") > g.rotation_deg),
            ("translation_inconsistent", finite("translation_direction_consensus_deg") > g.translation_deg),
            ("scale_inconsistent", finite("scale_consensus") > g.scale),
            ("reprojection_high", finite("cross_session_reprojection_error") > g.reprojection_px),
            ("holdout_low", finite("holdout_inlier_ratio") < g.holdout_ratio),
        ]
    )
    has = lambda r: F.array_contains(bad, r)
    broken = has("rotation_inconsistent") | has("translation_inconsistent") | has("scale_inconsistent")
    status = F.when(has("no_verified_pairs"), "REJECT").when(broken, "AMBIGUOUS").when(has("geometry_incomplete") | has("few_pairs") | has("few_tracks"), "WEAK").when(F.size(bad) == 0, "STRONG").otherwise("USABLE")
    return status, bad


def admission(core_hits, bridges, reproj_delta, *, least_hits: float = 0.6, least_bridges: int = 2, most_delta: float = 0.02) -> Column:
    """ADMIT or REJECT; a value that is missing or not finite rejects."""
    h, b, d = finite(core_hits), finite(bridges), finite(reproj_delta)
    return F.when(F.coalesce((h >= least_hits) & (b >= least_bridges) & (d <= most_delta), F.lit(False)), "ADMIT").otherwise("REJECT")


def update_class(localized, covered, changed) -> Column:
    l, c, e = map(col, (localized, covered, changed))
    return F.when(l & e & ~c, "UPDATE_CANDIDATE").when(l & c & ~e, "APPEARANCE_REF").when(l & e, "UPDATE_CANDIDATE").otherwise("QUARANTINE")


def check_receipts(rows: DataFrame, checks: dict[str, tuple[str, str, float]], key: Sequence[str] = ()) -> DataFrame:
    """One row for each check: (key, check, value, limit, margin, state). A value that is not finite is HARD_FAIL; margin is positive where it passes."""
    items = []
    for name, (column, way, limit) in checks.items():
        v = finite(column)
        margin = v - limit if way == ">=" else limit - v
        items.append(F.struct(F.lit(name).alias("check"), v.alias("value"), F.lit(float(limit)).alias("limit"), margin.alias("margin"), F.when(v.isNull(), "HARD_FAIL").when(margin >= 0, "PASS").otherwise("FAIL").alias("state")))
    return rows.select(*key, F.explode(F.array(*items)).alias("c")).select(*key, "c.*")


POSE_GATES: dict[str, tuple[str, str, float]] = {
    "min_inliers": ("inliers", ">=", 30),
    "min_inlier_ratio": ("inlier_ratio", ">=", 0.25),
    "min_unique_points": ("unique_points", ">=", 20),
    "max_reproj_median": ("reproj_median_px", "<=", 3.0),
    "max_reproj_p90": ("reproj_p90_px", "<=", 6.0),
    "min_hull": ("hull_coverage", ">=", 0.1),
    "min_grid": ("grid4_occupancy", ">=", 5),
    "min_depth": ("positive_depth_ratio", ">=", 0.98),
    "min_references": ("references", ">=", 2),
}


def pose_gates(gates: dict[str, tuple[str, str, float]] = POSE_GATES) -> Column:
    """Names of the pose gates that fail, in order; a missing value fails its gate."""
    return reasons([(n, F.coalesce(F.col(c) < v if w == ">=" else F.col(c) > v, F.lit(True))) for n, (c, w, v) in gates.items()])


def direct_failure(registered, inliers, matches, lifted, *, least_matches: int = 30, least_lifted: int = 20, least_inliers: int = 20) -> Column:
    return F.when(col(registered), "NONE").when(F.coalesce(col(matches), F.lit(0)) < least_matches, "RETRIEVAL_OR_MATCHING").when(F.coalesce(col(lifted), F.lit(0)) < least_lifted, "LIFTING").when(F.coalesce(col(inliers), F.lit(0)) < least_inliers, "POSE").otherwise("GATES")


@dataclass(frozen=True)
class RegionLadder:
    """Decision of a recapture region, first that applies."""

    attempts: int = 8
    coverage: float = 0.75
    healthy: float = 0.95
    weak: float = 0.60
    repair: float = 0.55
    structural: float = 0.52
    steps: tuple[str, ...] = field(default=("INSUFFICIENT_EVIDENCE", "HEALTHY", "REPAIR_EXISTING_DATA", "RECAPTURE", "NAVIGATION_LIMITED", "MONITOR"))

    def decide(self, attempts="attempts", coverage="coverage", success="success", repairability="repairability", structural="structural", reachable="reachable") -> Column:
        a, c, s, r, t, n = (F.col(x) for x in (attempts, coverage, success, repairability, structural, reachable))
        return (
            F.when(F.coalesce(a, F.lit(0)) < self.attempts, self.steps[0])
            .when(F.coalesce(c, F.lit(0.0)) < self.coverage, self.steps[0])
            .when(s >= self.healthy, self.steps[1])
            .when((s < self.weak) & (r >= self.repair), self.steps[2])
            .when((s < self.weak) & ~F.coalesce(n, F.lit(True)), self.steps[4])
            .when((s < self.weak) & (F.coalesce(t, F.lit(0.0)) < self.structural), self.steps[3])
            .otherwise(self.steps[5])
        )


def rules_plan(found: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Ordered actions for each key: found (key, cause) by rules (cause, step, action)."""
    rows = found.join(rules, "cause").groupBy(key, "action").agg(F.min("step").alias("step"))
    return rows.groupBy(key).agg(F.expr("transform(sort_array(collect_list(struct(step, action))), x -> x.action)").alias("actions"))


def split_leakage(records: DataFrame, split: str, keys: Sequence[str]) -> DataFrame:
    """(key_name, split_a, split_b, shared): values that two splits share, for each key column; nulls are no values."""
    out = None
    for k in keys:
        v = records.where(F.col(k).isNotNull()).select(F.col(split).alias("s"), F.col(k).cast("string").alias("v")).distinct()
        pairs = v.alias("x").join(v.alias("y"), (F.col("x.v") == F.col("y.v")) & (F.col("x.s") < F.col("y.s")))
        rows = pairs.groupBy(F.col("x.s").alias("split_a"), F.col("y.s").alias("split_b")).agg(F.count("*").alias("shared")).select(F.lit(k).alias("key_name"), "split_a", "split_b", "shared")
        out = rows if out is None else out.unionByName(rows)
    return out


def snapshot_changes(before: DataFrame, after: DataFrame, key: str = "path", value: str = "sha256") -> DataFrame:
    """(path, change): added, missing or changed."""
    j = before.select(key, F.col(value).alias("_b")).join(after.select(key, F.col(value).alias("_a")), key, "full_outer")
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "missing").when(F.col("_a") != F.col("_b"), "changed")
    return j.select(key, change.alias("change")).where("change is not null")


def chain_breaks(gates: DataFrame, order: str, digest: str = "digest", previous: str = "previous", partition: str = "run") -> DataFrame:
    """Rows whose recorded predecessor is not the digest before them."""
    from pyspark.sql import Window

    w = Window.partitionBy(partition).orderBy(order)
    expected = F.lag(digest).over(w)
    return gates.withColumn("expected", expected).where(~F.col(previous).eqNullSafe(F.col("expected")))


def held_out_release(manifest: DataFrame, results: DataFrame, *, rate: float = 0.95, inliers_p05: float = 30) -> DataFrame:
    """One row: missing, duplicate and unknown queries, the rate over the manifest, the inliers' p05 and whether it may be released."""
    m = manifest.select("query").distinct()
    per = results.groupBy("query").agg(F.count("*").alias("n"), F.max("success").alias("success"), F.max("inliers").alias("inliers"))
    j = m.withColumn("_m", F.lit(1)).join(per, "query", "full_outer")
    one = j.agg(
        F.sum((F.col("_m").isNotNull() & F.col("n").isNull()).cast("long")).alias("missing"),
        F.sum((F.coalesce("n", F.lit(0)) > 1).cast("long")).alias("duplicate"),
        F.sum(F.col("_m").isNull().cast("long")).alias("unknown"),
        (F.sum((F.col("_m").isNotNull() & F.coalesce("success", F.lit(False))).cast("double")) / F.sum(F.col("_m"))).alias("rate"),
        F.expr("percentile(inliers, 0.05) filter (where success)").alias("inliers_p05"),
    )
    ok = (F.col("missing") == 0) & (F.col("duplicate") == 0) & (F.col("unknown") == 0) & (F.col("rate") >= rate) & (F.col("inliers_p05") >= inliers_p05)
    return one.withColumn("released", F.coalesce(ok, F.lit(False)))
