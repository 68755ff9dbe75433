"""Admission of sessions: what a session's role may change, which edges connect it, its place beside a frozen base, and its video evidence.

Decisions are column expressions over one row per session or edge; what needs several rows is an aggregate first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clip, finite, first_finite, weighted_observed

# Statuses of sessions and edges.
SOUND = ("STRONG", "USABLE")
REJECTED = ("REJECT", "INCONSISTENT")
BLOCKED = ("AMBIGUOUS", "REJECT", "WEAK")


def col(c) -> Column:
    """A column by name, a column, or a plain value."""
    return F.col(c) if isinstance(c, str) else c if isinstance(c, Column) else F.lit(c)


def _or(c, otherwise) -> Column:
    return F.coalesce(col(c), F.lit(otherwise))


# pairs


def pair_flags(config="two_view_config", homography="homography_support", essential="essential_support", rotation="rotation_error_deg", direction="direction_error", *, least_homography: float = 0.60, most_essential: float = 0.30, most_rotation: float = 15.0, most_direction: float = 0.35) -> Column:
    """A struct of planar, degenerate, pose_bad, has_model and has_pose of an image pair.

    Two-view configurations 4, 5 and 6 are planar or panoramic, 1 is degenerate (fixed values of the format).
    """
    config, h, e, rot, tr = col(config), finite(homography), finite(essential), finite(rotation), finite(direction)
    both = h.isNotNull() & e.isNotNull()
    return F.struct(
        (_or(config.isin(4, 5, 6), False) | _or(both & (h >= least_homography) & (e <= most_essential), False)).alias("planar"),
        _or(config == 1, False).alias("degenerate"),
        (_or(rot > most_rotation, False) | _or(tr > most_direction, False)).alias("pose_bad"),
        (config.isNotNull() | both).alias("has_model"),
        (rot.isNotNull() | tr.isNotNull()).alias("has_pose"),
    )


def verified_pair(sampled, f_inliers, h_inliers, f_ratio, h_ratio, planar, same_video, cross_direction, *, least_sampled: int = 20, least_inliers: int = 15, least_ratio: float = 0.25, rotation_share: float = 1.2) -> Column:
    """A struct of keep and reason: geometry that a pair of one video, of two directions, or of two videos must show."""
    f_in, h_in = col(f_inliers), col(h_inliers)
    fundamental = (f_in >= least_inliers) & (col(f_ratio) >= least_ratio)
    homography = (h_in >= least_inliers) & (col(h_ratio) >= least_ratio)
    planar = homography & col(planar)
    rotating = (h_in >= least_inliers) & (h_in >= rotation_share * F.greatest(F.lit(1), f_in))
    kind = F.when(col(same_video), "same_video").when(col(cross_direction), "cross_direction").otherwise("cross_video")
    end = (
        F.when(fundamental, "fundamental")
        .when((kind == "same_video") & homography, "rotation_bridge")
        .when((kind != "same_video") & planar, "planar_consistent")
        .when((kind == "cross_direction") & rotating, "rotation_like")
        .otherwise("geometry_failed")
    )
    few = _or(col(sampled) < least_sampled, True)
    return F.struct((~few & ~end.isin("rotation_like", "geometry_failed")).alias("keep"), F.when(few, "too_few_sampled_matches").otherwise(F.concat_ws("_", kind, end)).alias("reason"))


# what a role may do


def fusion_authorization(role="role", *, admitted=False, holdout=False, groups=0, geometry=False, disjoint=False, left_out=False) -> Column:
    """What a session of a role may change. A base role needs an authorised edge; reinforcement needs two groups, complete geometry and a disjoint holdout."""
    role = col(role)
    proven = col(holdout) & (col(groups) >= 2) & col(geometry) & col(disjoint)
    return (
        F.when(role.isin("BASE_CORE", "BASE_SUPPORT") & col(admitted), "GLOBAL_BA")
        .when(role == "BASE_CORE", "GLOBAL_BA_PENDING_APPROVAL")
        .when((role == "GEOMETRY_REINFORCEMENT") & proven, "LOCAL_FUSION")
        .when(role.isin("BASE_SUPPORT", "GEOMETRY_REINFORCEMENT"), "LOCAL_RELATION_ONLY")
        .when(role == "UPDATE_CANDIDATE", F.when(col(left_out), "LOCAL_FUSION").otherwise("LOCAL_FUSION_PENDING_LOO"))
        .when(role == "APPEARANCE_REF", "LOCALIZATION_ONLY")
        .when(role == "NEW_SUBMAP", "SUBMAP_ONLY")
        .when(role == "VALIDATION_ONLY", "EVALUATION_ONLY")
        .otherwise("NONE")
    )


def incident_authorization(sessions: DataFrame, edges: DataFrame, key: str = "session", order: str = "edge") -> DataFrame:
    """sessions (key, role, left_out) with the authorisation that their first authorised edge gives.

    edges: key, order, authorized, independent_bridge_groups, geometry_complete, disjoint.
    """
    first = edges.where("authorized").groupBy(key).agg(F.min_by(F.struct("independent_bridge_groups", "geometry_complete", "disjoint"), order).alias("grant"), F.min(order).alias("grant_edge"))
    got = sessions.join(first, key, "left")
    g = lambda f, d: _or(F.col(f"grant.{f}"), d)
    state = fusion_authorization(admitted=F.col("grant_edge").isNotNull(), holdout=g("disjoint", False), groups=g("independent_bridge_groups", 0), geometry=g("geometry_complete", False), disjoint=g("disjoint", False), left_out="left_out")
    return got.select(*sessions.columns, "grant_edge", state.alias("authorization"))


# Other words for a scope of evidence.
SCOPES = {"exact-pair": "exact_pair", "pair": "exact_pair", "independent": "exact_pair", "shared": "shared_map", "map": "shared_map", "reconstruction": "shared_map", "retrieval": "vpr", "raw": "raw_tracks", "tracks": "raw_tracks"}


def evidence_scope(value, *, independent=False, shared=False, source=None) -> Column:
    """The scope of a piece of evidence. An exact pair counts only as an independent artifact; what comes from a shared map stays so."""
    word = F.lower(F.trim(_or(col(value).cast("string"), "")))
    word = F.when(word == "", "unknown").otherwise(word)
    scope = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in SCOPES.items() for x in kv]), word), word)
    origin = F.lower(F.trim(_or(col(source).cast("string"), "")))
    bound = col(shared) | origin.isin("shared_map", "vpr", "map", "reconstruction")
    own = (scope == "exact_pair") & ~col(independent)
    return (
        F.when(bound & own, F.when(origin == "vpr", "vpr").otherwise("shared_map"))
        .when(bound & scope.isin("shared_map", "vpr", "raw_tracks", "unknown"), F.when((origin == "vpr") | (scope == "vpr"), "vpr").otherwise("shared_map"))
        .when(own, "unknown")
        .otherwise(scope)
    )


# sessions beside a frozen base


def loc_succeeds(strong, queries) -> Column:
    """Whether any query is strong; null without queries."""
    return F.when(finite(queries) > 0, finite(strong) > 0)


def leftover_role(status="status", sharpness="sharpness_p10", localized="loc_ok", hits="core_hit_fraction", bridges="independent_bridges", usable="usable_edge", change="change_score", influential="high_influence", covered="geometry_covered") -> Column:
    """The role of a session outside the base; what is uncertain is set apart, and one bridge never merges."""
    status, bridges, usable = F.upper(F.trim(col(status))), col(bridges), _or(usable, False)
    sound, ok, change = status.isin(*SOUND), _or(localized, False), _or(finite(change), 0.0)
    apart = F.lit("QUARANTINE")
    loose = ~usable | _or(bridges == 0, False)
    return (
        F.when(status.isin(*REJECTED) | ((status == "WEAK") & _or(finite(sharpness) <= 0, False)), "REJECT")
        .when(sound & loose, F.when(ok, apart).otherwise("NEW_SUBMAP"))
        .when(_or(influential, False) | (usable & _or(bridges == 1, True)), apart)
        .when(ok & (~usable | _or(finite(hits) <= 0, False)), apart)
        .when(sound & (change > 0), "UPDATE_CANDIDATE")
        .when(sound & usable & ~_or(covered, False), "GEOMETRY_REINFORCEMENT")
        .when(sound & ok, "APPEARANCE_REF")
        .otherwise(apart)
    )


def geometric(edge: str = "") -> Column:
    """Whether an edge has geometry: it is not blocked, and not retrieval candidates alone."""
    c = lambda n: _or(f"{edge}{n}", 0)
    retrieval = (c("num_candidate_pairs") > 0) & (c("num_shared_tracks") == 0) & (c("num_verified_pairs") == 0) & (c("independent_bridge_groups") == 0)
    return ~col(f"{edge}status").isin(*BLOCKED) & ~retrieval


def connecting_edges(edges: DataFrame, base: DataFrame, key: str = "session") -> DataFrame:
    """Edges (session_a, session_b) as rows (session, other) that end at a session of base. base has the column key."""
    ends = edges.withColumn(key, F.explode(F.array("session_a", "session_b"))).withColumn("other", F.when(F.col(key) == F.col("session_a"), F.col("session_b")).otherwise(F.col("session_a")))
    return ends.join(base.select(F.col(key).alias("other")).distinct(), "other", "left_semi").where(F.col(key) != F.col("other"))


def leftover_roles(sessions: DataFrame, edges: DataFrame, base: DataFrame, key: str = "session", weak_base: bool = False) -> DataFrame:
    """sessions with their role: links to base, localisation and change come together here.

    sessions: key, status, sharpness_p10, loc_strong, loc_queries, core_hit_fraction, change_score, high_influence,
    improves, appears_different. A lone critical bridge counts as one; a new submap with blocked links is set apart.
    """
    links = connecting_edges(edges, base, key).withColumn("_ok", geometric())
    found = links.groupBy(key).agg(
        F.max(F.when(F.col("_ok"), F.col("independent_bridge_groups"))).alias("_groups"),
        F.max(F.col("_ok")).alias("_usable"),
        F.max(_or("is_critical_bridge", False)).alias("_critical"),
        F.max(F.col("status").isin(*BLOCKED)).alias("_blocked"),
    )
    rows = sessions.join(found, key, "left")
    usable, groups = _or("_usable", False), _or("_groups", 0)
    bridges = F.when(_or("_critical", False) & (groups < 2) & usable, 1).otherwise(groups)
    ok = loc_succeeds("loc_strong", "loc_queries")
    covered = _or(ok, False) & ~_or("improves", False) & ~_or("appears_different", False) & F.lit(not weak_base)
    role = leftover_role(localized=ok, bridges=bridges, usable=usable, covered=covered)
    role = F.when((role == "NEW_SUBMAP") & _or("_blocked", False), "QUARANTINE").otherwise(role)
    return rows.select(*sessions.columns, role.alias("role"))


def admissible(edges: DataFrame, base: DataFrame, candidates: DataFrame, key: str = "session") -> DataFrame:
    """(key, admissible, reason) of each candidate: its links to base must have geometry, and more than one weak critical bridge."""
    links = connecting_edges(edges, base, key).withColumn("_ok", geometric()).withColumn("_crit", _or("is_critical_bridge", False))
    n = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0))
    ok, crit = F.col("_ok"), F.col("_crit")
    found = links.groupBy(key).agg(n(ok).alias("u"), n(F.col("status").isin(*BLOCKED)).alias("b"), n(ok & crit).alias("c"), n(ok & ~crit).alias("f"), n(ok & crit & (F.col("status") != "STRONG")).alias("w"))
    first = base.limit(1).agg((F.count("*") == 0).alias("empty"))  # one row
    rows = candidates.select(key).join(found, key, "left").crossJoin(F.broadcast(first))
    reason = (
        F.when(F.col("empty"), "empty_core")
        .when(F.col("u").isNull(), "no_connection_to_core")
        .when(F.col("u") == 0, F.when(F.col("b") > 0, "only_blocked_edges").otherwise("no_geometric_edge"))
        .when((F.col("f") == 0) & (F.col("c") == 1), "single_critical_bridge")
        .when((F.col("f") == 0) & (F.col("w") > 0), "unverified_critical_bridge")
        .otherwise("admissible")
    )
    return rows.select(key, reason.isin("empty_core", "admissible").alias("admissible"), reason.alias("reason"))


def seed_session(sessions: DataFrame, key: str = "session") -> DataFrame:
    """The sound session to begin with: by quality, coverage, information and least cycle error; ties to the least key."""
    z = lambda c: _or(c, 0.0)
    order = [F.desc("internal_quality_score"), F.desc(z("convex_hull_coverage") + z("grid_occupancy")), F.desc(z("fim_logdet")), F.asc(z("rotation_cycle_error")), F.asc(key)]
    return sessions.where(F.col("status").isin(*SOUND)).orderBy(*order).limit(1)


def within_budget(candidates: DataFrame, base: DataFrame, *, sessions: int | None = None, tracks: int | None = None, observations: int | None = None, tracks_each: int | None = None) -> DataFrame:
    """candidates (num_tracks, num_observations) with fits: whether base and the candidate stay within every limit."""
    held = base.agg(F.count("*").alias("_n"), F.coalesce(F.sum("num_tracks"), F.lit(0)).alias("_t"), F.coalesce(F.sum("num_observations"), F.lit(0)).alias("_o"))
    t, o = _or("num_tracks", 0), _or("num_observations", 0)
    fits = F.lit(True)
    for value, most in ((F.col("_n") + 1, sessions), (F.col("_t") + t, tracks), (F.col("_o") + o, observations), (t, tracks_each)):
        if most is not None:
            fits = fits & (value <= most)
    return candidates.crossJoin(F.broadcast(held)).select(*candidates.columns, fits.alias("fits"))  # one row of sums


def close_cycle(base: DataFrame, leftover: DataFrame, edges: DataFrame, key: str = "session") -> DataFrame:
    """The sound session outside base that closes a cycle, if base with its geometric edges is no more than a tree: two sure links at least, the best quality, ties to the least key."""
    pairs = edges.where(F.col("status").isin(*SOUND) & geometric())
    inner = connecting_edges(pairs, base, key).join(base.select(key), key, "left_semi").agg((F.count("*") / 2).alias("_edges"))
    size = base.agg(F.count("*").alias("_size"))
    links = connecting_edges(pairs.where(~_or("is_critical_bridge", False)), base, key).groupBy(key).agg(F.count("*").alias("_links")).where("_links >= 2")
    rows = leftover.where(F.col("status").isin(*SOUND)).join(links, key).crossJoin(F.broadcast(inner)).crossJoin(F.broadcast(size))  # one row each
    return rows.where("_size >= 2 and _edges < _size").orderBy(F.desc("internal_quality_score"), key).limit(1).select(*leftover.columns)


# what a video shows


def motion_ratios(intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of each group of intervals (class, tracks, and measures): shares of the motion classes and medians of the measures over intervals with tracks.

    A class without a name here is unproven; so is a group without intervals.
    """
    named = F.when(F.col("class").isin("parallax", "low_parallax", "hover", "pure_rotation", "fast_motion"), F.col("class")).otherwise("unproven")
    rows = intervals.withColumn("_class", named)
    share = [F.avg((F.col("_class") == k).cast("double")).alias(f"{k}_ratio") for k in ("parallax", "low_parallax", "hover", "pure_rotation", "fast_motion", "unproven")]
    tracked = F.col("tracks") > 0
    measures = [F.percentile(F.when(tracked, finite(c)), 0.5).alias(f"{c}_median") for c in ("epipolar_outlier_ratio", "essential_inlier_ratio", "flow_px", "parallax_px") if c in intervals.columns]
    return rows.groupBy(*by).agg(F.count("*").alias("intervals"), *share, *measures)


def video_status(sharpness="sharpness_p10", duplicate="near_duplicate_ratio", under="underexposed_ratio", over="overexposed_ratio", outliers="epipolar_outlier_ratio_median", prefix: str = "") -> tuple[Column, Column, Column]:
    """Status, score and the limits that are broken, of a session known by its video alone: USABLE at best, never STRONG.

    Ratios of motion classes are the columns parallax_ratio and so on. Without a sharpness it is WEAK.
    """
    r = lambda c: clip(_or(finite(f"{prefix}{c}"), 0.0))
    sharp, epi = finite(sharpness), clip(finite(outliers))
    dup, bad = clip(_or(finite(duplicate), 0.0)), F.least(F.lit(1.0), clip(_or(finite(under), 0.0)) + clip(_or(finite(over), 0.0)))
    moving = F.least(F.lit(1.0), r("parallax_ratio") + 0.35 * r("low_parallax_ratio"))
    still = F.least(F.lit(1.0), r("hover_ratio") + r("pure_rotation_ratio") + r("fast_motion_ratio") + 0.5 * r("low_parallax_ratio"))
    value = clip(
        0.38 * moving + 0.22 * F.least(F.lit(1.0), sharp / 100.0) + 0.12 * (1 - dup) + 0.10 * (1 - bad) + 0.10 * F.when(epi.isNull() | finite(outliers).isNull(), 0.5).otherwise(1 - epi) + 0.08 * (1 - r("unproven_ratio")) - 0.12 * still,
        0.0,
        0.90,
    )
    limits = [("geometric_motion", moving < 0.20), ("degenerate_motion", still > 0.70), ("fast_motion", r("fast_motion_ratio") > 0.45), ("near_duplicate", dup > 0.75), ("bad_exposure", bad > 0.75), ("epipolar_outliers", _or(finite(outliers).isNotNull() & (epi > 0.75), False))]
    broken = F.when(sharp >= 15.0, F.array_compact(F.array(*[F.when(c, n) for n, c in limits])))
    status = F.when(sharp < 15.0, "REJECT").when(sharp.isNull() | (F.size(broken) > 0), "WEAK").otherwise("USABLE")
    score = F.when(sharp < 15.0, 0.05).when(sharp.isNull(), 0.2).when(F.size(broken) > 0, F.least(value, F.lit(0.45))).otherwise(F.greatest(value, F.lit(0.46)))
    return status, score, broken


def session_quality(qa: DataFrame, motion: DataFrame, key: str = "session") -> DataFrame:
    """One row for each session of qa with its motion ratios, status, score and broken limits."""
    rows = qa.join(motion, key, "left").withColumn("unproven_ratio", _or("unproven_ratio", 1.0))
    status, score, broken = video_status()
    return rows.withColumns({"status": status, "internal_quality_score": score, "broken": broken})


VIDEO_WEIGHTS = {"internal_quality": 0.20, "parallax": 0.25 * 0.80, "low_parallax": 0.25 * 0.20, "sharpness": 0.15, "motion_evidence": 0.10, "non_duplicate": 0.10, "underexposure": 0.10 * 0.50, "overexposure": 0.10 * 0.50, "epipolar": 0.10}


def video_terms(reference: float = 100.0) -> dict[str, Column]:
    """The nine observed terms of a video's quality; a term without its measure is null."""
    less = lambda c: 1 - clip(finite(c))
    seen = lambda c, e: F.when(finite(c).isNotNull(), e)
    rest = {"motion_evidence": "unproven_ratio", "non_duplicate": "near_duplicate_ratio", "underexposure": "underexposed_ratio", "overexposure": "overexposed_ratio", "epipolar": "epipolar_outlier_ratio_median"}
    return {
        "internal_quality": clip("internal_quality_score"),
        "parallax": seen("parallax_ratio", clip("parallax_ratio")),
        "low_parallax": seen("low_parallax_ratio", clip("low_parallax_ratio")),
        "sharpness": seen("sharpness_p10", clip(finite("sharpness_p10") / reference)),
        **{name: seen(c, less(c)) for name, c in rest.items()},
    }


def video_score() -> tuple[Column, Column]:
    """Weighted mean of the observed terms, and the share of weight that is observed."""
    return weighted_observed([(term, VIDEO_WEIGHTS[name]) for name, term in video_terms().items()])


RISK_WEIGHTS = {"hover_ratio": 0.10, "pure_rotation_ratio": 0.10, "fast_motion_ratio": 0.10, "low_parallax_ratio": 0.05, "near_duplicate_ratio": 0.20, "underexposed_ratio": 0.075, "overexposed_ratio": 0.075, "epipolar_outlier_ratio_median": 0.20, "unproven_ratio": 0.10}


def risk_score(empty: float = 0.5) -> tuple[Column, Column]:
    """Weighted mean of the observed risks (a fixed value without any), and the share of weight that is observed."""
    value, seen = weighted_observed([(F.when(finite(c).isNotNull(), clip(c)), w) for c, w in RISK_WEIGHTS.items()])
    return F.coalesce(value, F.lit(empty)), seen


def proposal_graph(edges: DataFrame, count: str = "num_candidate_pairs") -> DataFrame:
    """(a, b, strength) of each pair of sessions with candidates: log counts over the greatest, its largest count if given twice."""
    e = edges.select(F.least("session_a", "session_b").alias("a"), F.greatest("session_a", "session_b").alias("b"), F.col(count).cast("double").alias("n")).where("a <> b and n > 0")
    e = e.groupBy("a", "b").agg(F.max("n").alias("n"))
    most = e.agg(F.max("n").alias("m"))
    strength = F.when(F.col("m") <= 1, F.col("n") / F.greatest("m", F.lit(1.0))).otherwise(F.log1p("n") / F.log1p("m"))
    return e.crossJoin(F.broadcast(most)).select("a", "b", clip(strength).alias("strength"))  # one row


def planar_consistency(hypotheses: DataFrame, by: Sequence[str], *, least_terms: int = 2, least_score: float = 0.6, angle_scale: float = 10.0, rotation_scale: float = 5.0) -> DataFrame:
    """For each pair the confidence-weighted mean over its plane hypotheses of their observed terms, and whether they validate it.

    Terms: shared inliers (as a share, or over the matches), likeness of normals (or their angle), and agreement of rotation.
    """
    bell = lambda c, s: F.exp(-0.5 * F.pow(c / s, 2))
    support = finite("inlier_support")
    shared = clip(F.when(support > 1, support / F.nullif(finite("num_matches"), F.lit(0.0))).otherwise(support))
    alike = F.when(finite("normal_similarity").isNotNull(), clip(F.abs(finite("normal_similarity"))))
    normal = F.coalesce(bell(finite("normal_angle_deg"), angle_scale), alike)
    terms = [F.when(support.isNotNull(), F.coalesce(shared, F.lit(1.0))), normal, bell(finite("rotation_error_deg"), rotation_scale)]
    n = sum((t.isNotNull().cast("int") for t in terms[1:]), terms[0].isNotNull().cast("int"))
    total = sum((_or(t, 0.0) for t in terms[1:]), _or(terms[0], 0.0))
    weight = F.greatest(F.when(finite("confidence") != 0, finite("confidence")).otherwise(1.0), F.lit(1e-6))
    rows = hypotheses.select(*by, n.alias("_n"), (total / F.nullif(n, F.lit(0))).alias("_s"), F.coalesce(weight, F.lit(1.0)).alias("_w"))
    got = rows.groupBy(*by).agg(F.max("_n").alias("observed"), F.count("_s").alias("hypotheses"), (F.sum(F.col("_s") * F.col("_w")) / F.sum(F.when(F.col("_s").isNotNull(), F.col("_w")))).alias("score"))
    return got.withColumns({"completeness": clip(F.col("observed") / float(max(least_terms, 1))), "validated": _or((F.col("score") >= least_score) & (F.col("observed") >= least_terms), False)})


def first_number(*aliases: str) -> Column:
    """The first finite number among columns of other names."""
    return first_finite(*aliases)
