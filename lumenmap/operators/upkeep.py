"""Upkeep of a map over sessions: which features go and come, which references serve a place, and checks of updates, masks and bridges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clip, col, cosine, finite, jaccard, reasons
from ..storage import cut
from .vectors import best_by_tag
from .windows import longest_run, top_k

# features


def partition_candidates(candidates: DataFrame, by: Sequence[str] = ("map",), feature: str = "feature", order: str = "order", once: bool = True) -> tuple[DataFrame, DataFrame]:
    """The first candidate of each feature, or each candidate for itself, as those with verified geometry and a point, and the others."""
    first = top_k(candidates, [*by, feature], [order], 1) if once else candidates
    good = F.coalesce(F.col("verified"), F.lit(False)) & F.col("point").isNotNull()
    return first.where(good), first.where(~good)


def exchange_target(active, fraction: float = 0.05, least: int = 1) -> Column:
    """How many of the active features change places in a session."""
    n = col(active)
    return F.when((n > 0) & F.lit(fraction > 0), F.least(n, F.greatest(F.lit(least), F.ceil(n * fraction)))).otherwise(0).cast("long")


def worst_active(records: DataFrame, by: Sequence[str] = ("map",), temporal: bool = False) -> DataFrame:
    """Active records with their place from the lowest score on; a temporal strategy goes by mean event score first."""
    order = [*(["mean_event"] if temporal else []), "score", "feature"]
    return records.where("state = 'ACTIVE'").withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


STRATEGIES = ("STATIC", "LATEST", "AGGRESSIVE", "STRICT", "SUMMARY", "SCORE", "FREMEN")


def plan_update(records: DataFrame, events: DataFrame, candidates: DataFrame, strategy: str, gate: DataFrame | None = None, by: Sequence[str] = ("map",), budget: int = 1000, fraction: float = 0.05, least_exchange: int = 1, once: bool = True) -> DataFrame:
    """Rows (by, feature, action): ACTIVATE, RETIRE or QUARANTINE, by which a session changes each map.

    records: by, feature, state, score, mean_event; events: by, feature, event; candidates: by, feature, point,
    verified, uniqueness, order. gate: by and passed; a map whose gate did not pass doesn't change at all. LATEST
    puts the candidates in place of all; AGGRESSIVE and STRICT exchange features with bad events one for one;
    SUMMARY drops incorrect ones and takes every candidate; SCORE and FREMEN keep to the budget, fill it, and
    exchange a share of the worst. once: of several candidates for a feature the first counts; else each does.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    if gate is not None:
        passed = gate.where("passed").select(*by)
        records, events, candidates = (x.join(passed, list(by), "left_semi") for x in (records, events, candidates))
    key = [*by, "feature"]
    active = records.where("state = 'ACTIVE'")
    good, other = partition_candidates(candidates, by, once=once)
    act = lambda df, name: df.select(*key, F.lit(name).alias("action"))
    if strategy == "STATIC":
        return act(records.limit(0), "RETIRE")
    apart = act(other.join(active.select(*key), key, "left_anti"), "QUARANTINE")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("uniqueness"), "feature")))
    if strategy == "LATEST":
        chosen = ranked(good).where(F.col("rank") <= budget)
        # what is chosen stays or comes; all else that was active goes where anything is chosen
        gone = active.join(chosen.select(*by).distinct(), list(by), "left_semi").join(chosen.select(*key), key, "left_anti")
        return act(chosen, "ACTIVATE").unionByName(act(gone, "RETIRE")).unionByName(apart)
    available = ranked(good.join(active.select(*key), key, "left_anti"))
    bad = events.where(F.col("event").isin(*(["INCORRECT", "UNMATCHED"] if strategy == "AGGRESSIVE" else ["INCORRECT"]))).select(*key).distinct()
    requested = active.join(bad, key, "left_semi")
    if strategy == "SUMMARY":
        return act(available, "ACTIVATE").unionByName(act(requested, "RETIRE")).unionByName(apart)
    count = lambda df, name: df.groupBy(*by).agg(F.count("*").alias(name))
    n = count(active, "_active").join(count(available, "_available"), list(by), "full").join(count(requested, "_requested"), list(by), "full").fillna(0, ["_active", "_available", "_requested"])
    a, v, q = F.col("_active"), F.col("_available"), F.col("_requested")
    if strategy in ("AGGRESSIVE", "STRICT"):
        swap = F.least(q, v)
        n = n.select(*by, swap.alias("_out"), F.least(swap, F.greatest(budget - (a - swap), F.lit(0))).alias("_in"))
        leaving = requested.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy("feature")))
    else:
        over = F.greatest(a - budget, F.lit(0))
        fill = F.least(F.greatest(budget - (a - over), F.lit(0)), v)
        swap = F.when(a >= budget, F.least(exchange_target(a - over + fill, fraction, least_exchange), v - fill)).otherwise(0)
        n = n.select(*by, (over + swap).alias("_out"), (fill + swap).alias("_in"))
        leaving = worst_active(records, by, strategy == "FREMEN")
    gone = leaving.join(n, list(by)).where("place <= _out")
    come = available.join(n, list(by)).where("rank <= _in")
    return act(come, "ACTIVATE").unionByName(act(gone, "RETIRE")).unionByName(apart)


def apply_update(records: DataFrame, plan: DataFrame, by: Sequence[str] = ("map",), start: float = 0.5) -> DataFrame:
    """records after a plan: states change, and new features come with the starting score."""
    key = [*by, "feature"]
    state = F.element_at(F.create_map(*[F.lit(x) for x in ("ACTIVATE", "ACTIVE", "RETIRE", "RETIRED", "QUARANTINE", "QUARANTINED")]), F.col("action"))
    rows = records.join(plan, key, "full")
    return rows.select(*key, F.coalesce(state, F.col("state")).alias("state"), F.coalesce("score", F.lit(start)).alias("score"), F.coalesce("mean_event", F.lit(0.0)).alias("mean_event"))


def select_features(records: DataFrame, k: int, by: Sequence[str] = ("map",), predicted: Column | str = "score") -> DataFrame:
    """The k active features of each map with the highest predicted score; ties by score, then by name."""
    rows = records.where("state = 'ACTIVE'").withColumn("predicted", col(predicted))
    return top_k(rows, by, [F.desc("predicted"), F.desc("score"), "feature"], k)


def uniqueness(queries: DataFrame, kept: DataFrame, id_col: str = "feature", vector: str = "vector") -> DataFrame:
    """For each query the least cosine distance to a kept vector: -1 without a vector, 1 where nothing is kept.

    Vectors are compared in blocks (see vectors); each task keeps one minimum for each query.
    """
    q = queries.select(F.col(id_col).alias("_q"), F.col(vector).alias("_v"))
    # rows are numbered by their vectors: ids may be of any type, and a vector that is given twice is compared once
    named = cut(q.where("_v is not null").select("_v").distinct().select(F.monotonically_increasing_id().alias("_n"), "_v"), "uniqueness-queries")
    found = kept.select(F.col(vector).alias("_v")).where(F.col("_v").isNotNull() & ~F.exists("_v", F.isnan))
    near = best_by_tag(named, found, "_n", "_v", own=True).where("score is not null").select(F.col("q").alias("_n"), (1 - F.col("score")).alias("_d")).join(named, "_n")
    return q.join(near.drop("_n"), "_v", "left").select(F.col("_q").alias(id_col), F.when(F.col("_v").isNull(), -1.0).otherwise(F.coalesce("_d", F.lit(1.0))).alias("uniqueness"))


# references and places


def route_cell(position, height, yaw, pitch, *, position_size: float = 5.0, height_size: float = 2.0, yaw_deg: float = 30.0, pitch_deg: float = 15.0) -> Column:
    """Bins of a place on a route: along it, in height, and of the direction of view."""
    b = lambda c, size, shift=0.0: F.floor((col(c) + shift) / size)
    return F.struct(b(position, position_size).alias("position_bin"), b(height, height_size).alias("height_bin"), b(yaw, yaw_deg, 180.0).alias("yaw_bin"), b(pitch, pitch_deg, 90.0).alias("pitch_bin"))


def viewpoint_gain(candidates: DataFrame, coverage: DataFrame, by: Sequence[str]) -> DataFrame:
    """For each candidate the mean over its different cells of 1 / (1 + how often a cell is covered already)."""
    rows = candidates.select(*by, "cell").distinct().join(coverage.select("cell", F.col("n").alias("_n")), "cell", "left")
    return rows.groupBy(*by).agg(F.avg(1 / (1 + F.coalesce("_n", F.lit(0)))).alias("gain"))


def active_references(references: DataFrame, support: DataFrame, cells: DataFrame, k: int = 20) -> DataFrame:
    """For each cell (cell) the active references that support it, all of them for a cell without support: by stable share, points and bridge depth, at most k.

    The references that any cell may take are cut to the k best first, so a cell without support costs k rows.
    """
    order = [F.desc("stable_ratio"), F.desc("points"), F.asc("bridge_depth"), F.asc("reference")]
    active = references.where("state = 'HIST_ACTIVE'")
    own = support.join(active, "reference")
    mine = top_k(cells.join(own, "cell"), ["cell"], order, k)
    bare = cells.join(support.select("cell").distinct(), "cell", "left_anti")
    rest = bare.crossJoin(F.broadcast(active.orderBy(*order).limit(k)))  # k rows
    cols = ["cell", "reference", "stable_ratio", "points", "bridge_depth"]
    return mine.select(*cols).unionByName(rest.select(*cols))


def candidate_risk(provenance="provenance", depth="bridge_depth", anchors="anchors", paths="bridge_paths", stable="stable_ratio", passed="passed") -> Column:
    """The risk of a reference: of its bridges, its unstable share and a failed registration, at most 1.5."""
    bridged = F.least(col(depth) * 0.05, F.lit(0.25)) + 0.20 + F.when(col(anchors) < 2, 0.40).otherwise(0.0) + F.when(col(paths) < 2, 0.25).otherwise(0.0)
    risk = F.when(col(provenance) == "BRIDGED", bridged).otherwise(0.0) + F.greatest(F.lit(0.0), 0.7 - col(stable)) + F.when(~F.coalesce(col(passed), F.lit(True)), 0.50).otherwise(0.0)
    return F.least(risk, F.lit(1.5))


def redundant_pairs(candidates: DataFrame, by: Sequence[str], *, translation: float = 0.5, rotation: float = 10.0, points: float = 0.8, descriptor: float = 0.95) -> DataFrame:
    """Pairs (a, b) of candidates of a group that are near in pose, see the same points, and look alike or serve the same cells.

    candidates: by, id, x, y, z, yaw_deg, points (array), vector, cells (array). Pairs are sought among neighbouring
    cubes of the translation's size, not among all.
    """
    cube = [F.floor(F.col(c) / translation).alias(f"_c{c}") for c in ("x", "y", "z")]
    rows = candidates.withColumns({f"_c{c}": e for c, e in zip("xyz", cube)})
    moves = F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip("xyz", m)]) for m in ((i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1))]))
    right = rows.withColumn("_m", moves).withColumns({f"_c{c}": F.col(f"_c{c}") + F.col(f"_m.{c}") for c in "xyz"}).drop("_m")
    a, b = rows.alias("a"), right.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*by, "_cx", "_cy", "_cz")]
    d2 = sum((F.pow(F.col(f"a.{c}") - F.col(f"b.{c}"), 2) for c in "yz"), F.pow(F.col("a.x") - F.col("b.x"), 2))
    turn = F.abs(F.pmod(F.col("a.yaw_deg") - F.col("b.yaw_deg") + 180, F.lit(360.0)) - 180)
    alike = F.coalesce(cosine("a.vector", "b.vector") >= descriptor, F.lit(False)) | (F.array_sort("a.cells") == F.array_sort("b.cells"))
    pairs = a.join(b, same).where((F.col("a.id") < F.col("b.id")) & (d2 <= translation**2) & (turn <= rotation) & (jaccard("a.points", "b.points") >= points) & alike)
    return pairs.select(*[F.col(f"a.{c}") for c in by], F.col("a.id").alias("a"), F.col("b.id").alias("b"))


def complete_neighbours(images: DataFrame, existing: DataFrame, nearest: DataFrame, k: int) -> DataFrame:
    """(image, neighbour, place): an image's own neighbours in their order, then its nearest others, at most k.

    existing: image, neighbour, order; nearest: image, neighbour, distance.
    """
    own = existing.where("image <> neighbour").join(images.select(F.col("image").alias("neighbour")), "neighbour", "left_semi").select("image", "neighbour", F.lit(0).alias("_kind"), F.col("order").cast("double").alias("_by"))
    more = nearest.where("image <> neighbour").select("image", "neighbour", F.lit(1).alias("_kind"), F.col("distance").cast("double").alias("_by"))
    one = own.unionByName(more).groupBy("image", "neighbour").agg(F.min(F.struct("_kind", "_by", "neighbour")).alias("_o"))
    return one.withColumn("place", F.row_number().over(Window.partitionBy("image").orderBy("_o"))).where(F.col("place") <= k).select("image", "neighbour", "place")


# bridges and masks


def edge_confidence(matches, inliers, ratio, coverage, epipolar=None) -> Column:
    """How sure an edge is: matches and inliers that saturate, their ratio, coverage and epipolar error."""
    full = lambda c, scale: 1 - F.exp(-F.greatest(col(c), F.lit(0)) / scale)
    error = F.lit(1.0) if epipolar is None else F.when(col(epipolar).isNull(), 1.0).otherwise(F.exp(-F.greatest(col(epipolar), F.lit(0.0)) / 2))
    return clip(0.20 * full(matches, 100.0) + 0.25 * full(inliers, 40.0) + 0.25 * clip(ratio) + 0.20 * clip(col(coverage) / 0.25) + 0.10 * error, 1e-6, 1.0)


def bridge_gates(anchors, paths, rotation, translation, scale, *, least_anchors: int = 2, least_paths: int = 2, most_rotation: float = 5.0, most_translation: float = 0.5, most_scale: float = 0.05) -> Column:
    """The gates that a bridge fails; a cycle without evidence is one."""
    r = col(rotation)
    return reasons(
        [
            ("min_anchor_count", col(anchors) < least_anchors),
            ("min_disjoint_paths", col(paths) < least_paths),
            ("max_rotation_cycle_deg", r > most_rotation),
            ("max_translation_cycle", r.isNotNull() & (col(translation) > most_translation)),
            ("max_scale_cycle_fraction", r.isNotNull() & (col(scale) > most_scale)),
            ("missing_cycle_evidence", r.isNull()),
        ]
    )


def competitive_modes(clusters: DataFrame, by: Sequence[str], ratio: float = 1.5, score: str = "score") -> DataFrame:
    """How many clusters of each group come within the ratio of its best."""
    best = clusters.groupBy(*by).agg((F.max(score) / max(ratio, 1.0)).alias("_least"))
    return clusters.join(best, list(by)).groupBy(*by).agg(F.sum((F.col(score) >= F.col("_least")).cast("long")).alias("modes"))


# Labels of a mask.
INVALID, STABLE, CHANGED, UNCERTAIN = range(4)


def fuse_masks(pixels: DataFrame, by: Sequence[str], votes: int = 2, label: str = "label") -> DataFrame:
    """One label for each pixel from its views: changed, else stable with enough votes, else uncertain with any, with the share of the stronger vote."""
    n = lambda v: F.sum((F.col(label) == v).cast("long"))
    got = pixels.groupBy(*by).agg(F.sum((F.col(label) != INVALID).cast("long")).alias("_valid"), n(STABLE).alias("_stable"), n(CHANGED).alias("_changed"))
    fused = F.when(F.col("_changed") >= votes, CHANGED).when(F.col("_stable") >= votes, STABLE).when(F.col("_valid") > 0, UNCERTAIN).otherwise(INVALID)
    return got.select(*by, fused.alias("label"), (F.greatest("_stable", "_changed") / F.greatest("_valid", F.lit(1))).alias("confidence"))


def mask_states(pixels: DataFrame, by: Sequence[str], active: float = 0.7, candidate: float = 0.4, label: str = "label") -> DataFrame:
    """The stable share of each mask and the state that it gives the reference."""
    got = pixels.groupBy(*by).agg(F.avg((F.col(label) == STABLE).cast("double")).alias("stable_ratio"))
    state = F.when(F.col("stable_ratio") >= active, "HIST_STABLE").when(F.col("stable_ratio") >= candidate, "HIST_CANDIDATE").otherwise("HISTORICAL_ONLY")
    return got.withColumn("state", state)


# evidence of changes


def point_id(pid, ref, cx, cy) -> Column:
    """The name of a point: by its number, or by its cell in a reference; an error where neither is there."""
    number = F.nullif(col(pid).cast("string"), F.lit(""))
    cell = F.when(col(ref).isNotNull() & col(cx).isNotNull() & col(cy).isNotNull(), F.concat_ws(":", F.lit("cell"), col(ref), col(cx).cast("long"), col(cy).cast("long")))
    return F.coalesce(F.concat(F.lit("pid:"), number), cell, F.raise_error(F.lit("a point needs a number or a cell")).cast("string"))


def score_candidate(counts: Sequence[str], ratio: str = "support_ratio") -> Column:
    """Why a candidate can't be scored: the first of its counts that is no whole number from 0 on, or its ratio; null if it can."""
    rules = []
    for c in counts:
        v = F.coalesce(col(c).cast("double"), F.lit(0.0))
        rules.append(F.when(F.isnan(v) | (v < 0) | (v != F.floor(v)), f"unscorable_{c}"))
    rules.append(F.when(col(ratio).isNotNull() & finite(ratio).isNull(), f"unscorable_{ratio}"))
    return F.coalesce(*rules)


def candidate_rows(explicit: DataFrame, tiles: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """A source's explicit candidates, else its tiles with low support (none are dropped where support is unknown)."""
    derived = tiles.join(explicit.select(*by).distinct(), list(by), "left_anti").where("low_support_frames is null or not (low_support_frames <= 0)")
    return explicit.unionByName(derived.withColumn("reason", F.lit("derived_from_session_tile_low_support")), allowMissingColumns=True)


def route_score(route="route", status="status", bridges="bridges", geometry="bridge_geometry", ratio="inlier_ratio") -> Column:
    """What a route is worth beforehand."""
    z = lambda c: F.coalesce(col(c).cast("double"), F.lit(0.0))
    loose = F.coalesce(F.instr(col(status), "retrieval_high_but_inliers_low") > 0, F.lit(False)) | (z(geometry) < 4)
    grown = clip(0.90 + F.least(F.lit(0.25), z(bridges) / 200) + F.least(F.lit(0.15), z(ratio) * 0.25), 0.8, 1.3)
    return F.when(col(route) == "submap", F.when(loose, 0.65).otherwise(grown)).when(col(route) == "register", 0.85).when(col(route) == "connector_only", 0.70).otherwise(1.0)


def reference_hits(hits: DataFrame, fallback: DataFrame) -> DataFrame:
    """The hits of each reference (key, count) over sessions; the fallback's only where there are none at all."""
    named = lambda df: df.where("key <> ''").groupBy("key").agg(F.sum(F.col("count").cast("double")).alias("hits"))
    any_hit = hits.where("key <> ''").limit(1).agg((F.count("*") > 0).alias("_any"))  # one row
    rest = named(fallback).crossJoin(F.broadcast(any_hit)).where("not _any").drop("_any")
    return named(hits).unionByName(rest)


# Labels of an update's rows, and those that fail it.
FAILING = ("UNIMPLEMENTED_TILE", "REGISTER_POINTS_CONTRACT_BROKEN")


def update_labels(route="route", status="status", added="points_added", tiles: Sequence[str] = ("tile_replace", "changed")) -> Column:
    """What a row of an update owns up to, by its route: registering makes no points, tiles are not replaced, submaps are not grown."""
    registers = col(route) == "register"
    return reasons(
        [
            ("REGISTER_PNP_ONLY", registers),
            ("REGISTER_POINTS_CONTRACT_BROKEN", registers & (F.coalesce(col(added), F.lit(0)) != 0)),
            ("UNIMPLEMENTED_TILE", col(route).isin(*tiles) | F.coalesce(col(status) == "needs_tile_replace", F.lit(False))),
            ("SUBMAP_NOT_INCREMENTAL", col(route) == "submap"),
        ]
    )


def update_verdict(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of each update: whether no row has a failing label, and all its labels."""
    labelled = rows.withColumn("_l", update_labels())
    return labelled.groupBy(*by).agg((F.max(F.arrays_overlap("_l", F.array(*map(F.lit, FAILING))).cast("int")) == 0).alias("ok"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("_l")))).alias("labels"))


def summary_problems(rows: DataFrame, by: Sequence[str], closed_out: str = "closed_out") -> DataFrame:
    """Of each update, the sequences that break its contract: unfinished tiles, points invented by registering, submaps without a close-out."""
    seq = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("seq"))))
    l = update_labels()  # noqa: E741
    has = lambda n: F.array_contains(l, n)
    done = (F.col("route") == "submap") & (F.col("status") == "ok") & ~F.col(closed_out)
    return rows.groupBy(*by).agg(seq(has("UNIMPLEMENTED_TILE")).alias("unfinished"), seq(has("REGISTER_POINTS_CONTRACT_BROKEN")).alias("invented_points"), seq(done).alias("needs_closeout"))


def require_no_leakage(critical="critical") -> Column:
    """An aggregate: true, or an error when any row is a critical leak."""
    return F.when(F.count(F.when(col(critical), 1)) > 0, F.raise_error(F.lit("critical leakage between splits")).cast("boolean")).otherwise(True)


def query_report(results: DataFrame, order: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row for each group of results: success, errors and latency at percentiles, the worst tenth of route cells and the longest run of failures.

    results: success, confident_wrong, translation_error, rotation_error_deg, latency_ms, route_cell and the order.
    """
    keys, rows = list(by), results
    q = lambda c, p, n: F.percentile(c, p).alias(n)
    flat = rows.groupBy(*keys).agg(
        F.count("*").alias("queries"), F.sum(F.col("success").cast("long")).alias("successes"), F.avg(F.col("success").cast("double")).alias("success_rate"), F.sum(F.col("confident_wrong").cast("long")).alias("confident_wrong"),
        q("translation_error", 0.5, "translation_median"), q("translation_error", 0.9, "translation_p90"), q("translation_error", 0.95, "translation_p95"), q("rotation_error_deg", 0.5, "rotation_median"), q("rotation_error_deg", 0.9, "rotation_p90"), q("rotation_error_deg", 0.95, "rotation_p95"),
        q("latency_ms", 0.5, "latency_p50"), q("latency_ms", 0.95, "latency_p95"), q("latency_ms", 0.99, "latency_p99"),
    )
    cells = rows.where("route_cell is not null").groupBy(*keys, "route_cell").agg(F.avg(F.col("success").cast("double")).alias("rate"))
    w = Window.partitionBy(*keys)
    ranked = cells.withColumn("place", F.row_number().over(w.orderBy("rate", "route_cell"))).withColumn("worst", F.greatest(F.lit(1), F.ceil(F.count("*").over(w) * 0.1)))
    tail = ranked.groupBy(*keys).agg(F.sum((F.col("rate") == 0).cast("long")).alias("failed_cells"), F.avg(F.when(F.col("place") <= F.col("worst"), F.col("rate"))).alias("worst_decile"))
    run = longest_run(rows.withColumn("failed", ~F.col("success")), keys, list(order), "failed")
    return flat.join(tail, keys, "left").join(run.withColumnRenamed("longest", "longest_failure_run"), keys, "left")
