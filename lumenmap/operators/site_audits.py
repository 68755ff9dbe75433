"""Audits of pair graphs, reconstructions and sites: gates over tables, each with the facts that it rests on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clip, col, finite
from .graph import components
from .windows import top_k

# pair graphs


def pair_graph(images: DataFrame, pairs: DataFrame, sequence: str = "sequence") -> DataFrame:
    """One row on the graph of images (image, sequence) that pairs (a, b) make: sizes, degrees, components, pairs across sequences.

    Pairs with unknown images or of an image with itself don't count, repeated ones count once.
    """
    named = lambda c: images.select(F.col("image").alias(c), F.col(sequence).alias(f"_{c}"))
    e = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct().join(named("a"), "a").join(named("b"), "b")
    ends = e.select(F.explode(F.array("a", "b")).alias("image")).groupBy("image").agg(F.count("*").alias("degree"))
    degree = images.select("image").distinct().join(ends, "image", "left").agg(F.count("*").alias("images"), F.sum(F.col("degree").isNull().cast("long")).alias("isolated"), F.percentile(F.coalesce("degree", F.lit(0)), 0.5).alias("median_degree"))
    flat = e.agg(F.count("*").alias("pairs"), F.coalesce(F.sum((F.col("_a") != F.col("_b")).cast("long")), F.lit(0)).alias("cross_pairs"))
    parts = components(images.select(F.col("image").alias("node")), e).groupBy("component").agg(F.count("*").alias("n")).agg(F.count("*").alias("components"), F.max("n").alias("largest"))
    return degree.crossJoin(flat).crossJoin(parts)  # one row each


def pair_graph_gate(facts: DataFrame, least_degree: float = 20.0) -> DataFrame:
    """facts with passed: one component, no isolated image, enough pairs for the median image, and pairs across sequences."""
    return facts.withColumn("passed", (F.col("components") == 1) & (F.col("isolated") == 0) & (F.col("median_degree") >= least_degree) & (F.col("cross_pairs") > 0))


def pairs_of_largest(images: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs within the largest component of images; of equal ones that with the least image."""
    named = components(images.select(F.col("image").alias("node")), pairs.select("a", "b"))
    best = named.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "component").limit(1).select("component")
    kept = named.join(F.broadcast(best), "component").select("node")  # one row
    return pairs.join(kept.select(F.col("node").alias("a")), "a", "left_semi").join(kept.select(F.col("node").alias("b")), "b", "left_semi")


def robust_sequence_share(sequences: DataFrame, edges: DataFrame, bridges: DataFrame, least: int = 2) -> DataFrame:
    """The largest component's share of sequences (sequence, direction) over edges of one direction or with enough bridges: one row."""
    d = lambda c: sequences.select(F.col("sequence").alias(c), F.col("direction").alias(f"_{c}"))
    und = lambda df: df.withColumns({"_lo": F.least("a", "b"), "_hi": F.greatest("a", "b")}).drop("a", "b").withColumnsRenamed({"_lo": "a", "_hi": "b"})
    held = und(edges.select("a", "b")).distinct().join(und(bridges), ["a", "b"], "left").join(d("a"), "a").join(d("b"), "b")
    held = held.where((F.col("_a") == F.col("_b")) | (F.coalesce("count", F.lit(0)) >= least))
    sizes = components(sequences.select(F.col("sequence").alias("node")), held.select("a", "b")).groupBy("component").agg(F.count("*").alias("n"))
    return sizes.agg((F.max("n") / F.sum("n")).alias("share"))


def independent_bridges(pairs: DataFrame, by: Sequence[str], separation: float) -> DataFrame:
    """0, 1 or 2 for each group of pairs with places x and y in [0, 1] on both sequences: 2 where two are apart on both.

    Two pairs are apart on both sides only if a far and a near one by x are apart by y as well: for each pair the
    extremes of y among those that lie far enough below it by x decide, so no pair meets all others.
    """
    below = f"over (partition by {', '.join(by)} order by x range between unbounded preceding and {float(separation)}D preceding)"
    rows = pairs.withColumns({"_lo": F.expr(f"min(y) {below}"), "_hi": F.expr(f"max(y) {below}")})
    apart = F.coalesce(F.greatest(F.col("_hi") - F.col("y"), F.col("y") - F.col("_lo")) >= separation, F.lit(False))
    return rows.groupBy(*by).agg((1 + F.max(apart.cast("int"))).alias("independent"))


def bridge_keep_count(triangulated, bridges, total, *, most_bridges: float, least_parallax: float, least_selected: float) -> Column:
    """How many rotation bridges to keep: the struct of target, its bounds, and whether they leave any choice."""
    t, b = col(triangulated), col(bridges)
    low = F.greatest(F.lit(0), F.ceil(col(total) * least_selected) - t)
    parallax = F.greatest(F.lit(0), F.floor(t / least_parallax - t))
    share = F.greatest(F.lit(0), F.floor(t * most_bridges / (1.0 - most_bridges)))
    high = F.least(b, parallax, share)
    none = b <= 0
    z = lambda c: F.when(none, 0).otherwise(c).cast("long")
    return F.struct(z(F.when(low <= high, high).otherwise(F.least(b, parallax))).alias("target"), z(low).alias("least"), z(parallax).alias("most_by_parallax"), z(share).alias("most_by_share"), (none | (low <= high)).alias("feasible"))


def temporal_cover(frames: DataFrame, by: str, order: Sequence[str], score: str, share: float, least: int, keep_all: Sequence = ()) -> DataFrame:
    """Frames to keep of each sequence: an even cover in time and the best by score, cut to a quota by score and nearness to the middle."""
    w = Window.partitionBy(by)
    rows = frames.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    whole = F.col(by).isin(*keep_all) if keep_all else F.lit(False)
    quota = F.when(whole, F.col("_n")).otherwise(F.least(F.col("_n"), F.greatest(F.lit(least), F.ceil(F.col("_n") * share))))
    rows = rows.withColumn("_q", quota).withColumn("_rank", F.row_number().over(w.orderBy(F.desc(score), "_i")))
    # a frame is on the even grid of q places if some k gives floor(k (n - 1) / (q - 1)) its place
    step = (F.col("_n") - 1) / F.greatest(F.col("_q") - 1, F.lit(1))
    k = F.ceil(F.when(step > 0, F.col("_i") / step - 1e-9).otherwise(0.0))
    even = F.when(F.col("_q") == 1, F.col("_i") == 0).otherwise((F.floor(k * step + 1e-9) == F.col("_i")) & (k < F.col("_q")))
    top = F.col("_rank") <= F.greatest(F.lit(1), F.floor(F.col("_q") / 4))
    picked = rows.where((even | top) & (F.col("_q") > 0))
    near = F.abs(F.col("_i") - F.col("_n") / 2)
    picked = picked.withColumn("_place", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(score), near, "_i")))
    return picked.where(whole | (F.col("_place") <= F.col("_q"))).select(*frames.columns)


# reconstructions


def intrinsics_drift(cameras: DataFrame, seed: Sequence[float]) -> DataFrame:
    """For each camera (camera, params) the greatest relative change of its focal lengths and the greatest change of its centre, against the seed."""
    p = lambda i: F.element_at("params", i + 1)
    focal = F.greatest(*[F.abs(p(i) - seed[i]) / max(abs(seed[i]), 1e-9) for i in (0, 1)])
    centre = F.greatest(*[F.abs(p(i) - seed[i]) for i in (2, 3)])
    return cameras.select("camera", focal.alias("focal_drift"), centre.alias("centre_drift_px"))


def restore_intrinsics(cameras: DataFrame, seeds: DataFrame, key: Sequence[str] = ("model", "width", "height")) -> DataFrame:
    """cameras with the parameters of the seed of their kind, and a problem where a camera has no seed or a seed no camera."""
    s = seeds.select(*key, F.col("params").alias("_seed"), F.lit(True).alias("_known"))
    rows = cameras.withColumn("_used", F.lit(True)).join(s, list(key), "full")
    problem = F.when(F.col("_known").isNull(), "no seed").when(F.col("_used").isNull(), "unused seed")
    return rows.select(*key, "camera", F.coalesce("_seed", "params").alias("params"), problem.alias("problem"))


def ray_angle(rays: DataFrame, by: Sequence[str]) -> DataFrame:
    """The widest angle (degrees) between any two rays of a point; rays: by, and the unit direction x, y, z. Of a point's rays only pairs of its own meet."""
    r = F.sort_array(F.collect_set(F.struct("x", "y", "z")))
    got = rays.groupBy(*by).agg(r.alias("_r"))
    dot = lambda p, q: p["x"] * q["x"] + p["y"] * q["y"] + p["z"] * q["z"]
    least = F.array_min(F.transform("_r", lambda p: F.array_min(F.transform("_r", lambda q: dot(p, q)))))
    return got.select(*by, F.degrees(F.acos(clip(least, -1.0, 1.0))).alias("angle_deg"))


def model_facts(images: DataFrame, observations: DataFrame, points: DataFrame) -> DataFrame:
    """One row of facts on a model: sizes, dangling and badly placed observations, residuals, tracks, and whether all is finite and consistent.

    images: image, registered, x, y, z; observations: image, point (null: none), depth, error; points: point, x, y, z, track_length.
    """
    ok = lambda *c: F.greatest(*[finite(x).isNull().cast("int") for x in c]) == 0
    reg = images.where("registered")
    o = observations.where("point is not null").join(reg.select("image"), "image", "left_semi").join(points.select("point", F.lit(True).alias("_there"), ok("x", "y", "z").alias("_placed")), "point", "left")
    there, placed = F.col("_there").isNotNull(), F.coalesce(F.col("_placed"), F.lit(False))
    bad = there & placed & (finite("depth").isNull() | (F.col("depth") <= 1e-12))
    e = F.when(there & placed & ~bad, finite("error"))
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    one = o.agg(F.count("*").alias("observations"), n(~there).alias("missing_points"), n(bad).alias("invalid_depth"), F.count(e).alias("residuals"), F.avg(e).alias("residual_mean"), F.percentile(e, 0.5).alias("residual_median"), F.percentile(e, 0.95).alias("residual_p95"), F.max(e).alias("residual_max"))
    i = images.agg(F.count("*").alias("images"), n(F.col("registered")).alias("registered"), (n(F.col("registered") & ~ok("x", "y", "z")) == 0).alias("finite_poses"))
    p = points.agg(F.count("*").alias("points"), F.coalesce(F.sum("track_length"), F.lit(0)).alias("track_elements"), F.min("track_length").alias("track_min"), F.percentile("track_length", 0.5).alias("track_median"), F.max("track_length").alias("track_max"), (n(~ok("x", "y", "z")) == 0).alias("finite_points"))
    return one.crossJoin(i).crossJoin(p).withColumn("consistent", (F.col("missing_points") == 0) & (F.col("observations") == F.col("track_elements")))  # one row each


# sites


def holdout_gate(rows: DataFrame, *, success: float, most_ok_to_fail: int, most_run: int) -> DataFrame:
    """Each set's result (PASS, PASS_BASELINE_IMPROVED or FAIL) and whether it passes: no regression, and enough success or better than a weak base."""
    steady = (F.col("ok_to_fail") <= most_ok_to_fail) & (F.col("final_run") <= most_run)
    enough = F.col("final_success") >= success
    better = (F.col("base_success") < success) & (F.col("final_success") >= F.col("base_success")) & (F.col("final_run") <= F.coalesce("base_run", F.lit(most_run))) & steady
    return rows.withColumns({"result": F.when(enough, "PASS").when(better, "PASS_BASELINE_IMPROVED").otherwise("FAIL"), "ok": steady & (enough | better)})


def quarantine_verdict(edges: DataFrame, counts: DataFrame, least: int = 2) -> DataFrame:
    """edges (edge, status) with the points that remain; a failed edge without any is quarantined. release: enough passed, and all pass or are quarantined."""
    rows = edges.join(counts.select("edge", F.col("count").alias("remaining")), "edge", "left")
    state = F.when((F.col("status") == "FAIL") & F.coalesce(F.col("remaining") == 0, F.lit(False)), "QUARANTINED").otherwise(F.col("status"))
    rows = rows.withColumn("state", state)
    all_ = rows.agg(((F.sum((F.col("status") == "PASS").cast("int")) >= least) & (F.sum((~F.col("state").isin("PASS", "QUARANTINED")).cast("int")) == 0)).alias("release"))
    return rows.crossJoin(F.broadcast(all_))  # one row


def directions(scores: DataFrame, by: Sequence[str], least: float = 0.4) -> DataFrame:
    """For each video the anchor that it is best aligned with (score rho), its direction if that is clear, else ambiguous; ties to the least anchor."""
    best = top_k(scores, by, [F.desc("rho"), "anchor"], 1)
    return best.select(*by, F.col("anchor").alias("aligned_with"), "rho", F.when(F.col("rho") > least, F.col("anchor")).otherwise("ambiguous").alias("direction"))


def retrieval_verdict(share="cross_share", mutual="mutual", least: float = 0.10) -> Column:
    """Whether pairs across directions must be forced: NONE (no mutual ones), RARE, or ENOUGH."""
    return F.when(col(mutual) == 0, "NONE").when(col(share) < least, "RARE").otherwise("ENOUGH")


def resolve_identity(results: DataFrame, aliases: DataFrame, fields: Sequence[str], key: str = "result") -> DataFrame:
    """The identity of each result: the first of its fields that is an alias as it stands, as a file's name, or as that without its ending.

    aliases: alias and identity, one row for each alias.
    """
    text = [F.nullif(F.trim(F.col(f).cast("string")), F.lit("")) for f in fields]
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    forms = [F.struct(F.lit(3 * i + k).alias("_p"), e.alias("alias")) for i, t in enumerate(text) for k, e in enumerate((t, name(t), F.regexp_replace(name(t), r"(?<=.)\.[^.]*$", "")))]
    rows = results.select(key, F.explode(F.array(*forms)).alias("f")).select(key, "f.*").where("alias is not null")
    found = rows.join(aliases, "alias").groupBy(key).agg(F.min_by("identity", "_p").alias("identity"))
    return results.select(key).join(found, key, "left")


def route_clusters(edges: DataFrame, separation: float = 0.25, clusters: int = 2, least_size: int = 3, least_edges: int = 2) -> DataFrame:
    """One row over trusted edges (edge, clusters, separation, least_cluster): how many break the rule of separate clusters, and the status."""
    bad = F.coalesce(~((F.col("clusters") == clusters) & (F.col("separation") == separation) & (F.col("least_cluster") >= least_size)), F.lit(True))
    got = edges.agg(F.count("*").alias("trusted"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("invalid"))
    return got.withColumn("status", F.when((F.col("trusted") >= least_edges) & (F.col("invalid") == 0), "PASS").otherwise("FAIL"))


def gap_policy(sequences: DataFrame, evidence: DataFrame, least: int = 2) -> DataFrame:
    """For each pair of a forward and a reverse sequence: PENDING without evidence, MISSING with too few independent clusters, else PROVEN.

    sequences: sequence and direction, few rows for a site; evidence: forward, reverse, independent.
    """
    f, r = (sequences.where(F.col("direction") == d).select(F.col("sequence").alias(d)) for d in ("forward", "reverse"))
    rows = f.join(r).join(evidence, ["forward", "reverse"], "left")
    state = F.when(F.col("independent").isNull(), "PENDING").when(F.col("independent") < least, "MISSING").otherwise("PROVEN")
    return rows.select("forward", "reverse", state.alias("state"))


def promotion_checks(base: str = "base_", new: str = "new_") -> Column:
    """The checks that a candidate fails: failed edges a tenth better, others no tenth worse, registration within a point, nothing that it alone sees."""
    b, c = (lambda n: F.col(f"{base}{n}")), (lambda n: F.col(f"{new}{n}"))
    better = (b("failed_score") - c("failed_score")) / b("failed_score")
    worse = F.when(b("other_score") > 0, (c("other_score") - b("other_score")) / b("other_score")).when(c("other_score") == 0, 0.0).otherwise(float("inf"))
    rules = [("failed_edges", better >= 0.10 - 1e-12), ("other_edges", worse <= 0.10 + 1e-12), ("registration", b("registration") - c("registration") <= 0.01 + 1e-12), ("alone", c("alone") == 0)]
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), n) for n, ok in rules]))


def changed_outside(before: DataFrame, after: DataFrame, allowed: DataFrame) -> DataFrame:
    """Keys (key, edge) whose digest changed, and whether their edge is on the list of those that may."""
    a = after.select("key", F.col("digest").alias("_d"), F.col("edge").alias("_e"))
    rows = before.join(a, "key", "full").where(~F.col("digest").eqNullSafe(F.col("_d"))).select("key", F.coalesce("edge", "_e").alias("edge"))
    return rows.join(allowed.select("edge", F.lit(True).alias("_ok")).distinct(), "edge", "left").select("key", "edge", F.coalesce("_ok", F.lit(False)).alias("allowed"))


def failing_edges(official: DataFrame, summaries: DataFrame) -> DataFrame:
    """Official edges (a, b) whose summary is not there or does not pass."""
    return official.join(summaries.where("status = 'PASS'").select("a", "b"), ["a", "b"], "left_anti")


def required_pairs_pass(required: DataFrame, summaries: DataFrame, *, points: int, cells: int, coverage: float, most: float) -> DataFrame:
    """One row: whether every required pair is supported on both sides and near enough, and every other pair passes or says why it doesn't apply.

    summaries: pair, status, applicable, reason, left_points, right_points, cells, coverage, ratio, maximum.
    """
    f = F.col
    near = finite("ratio").isNotNull() & (f("ratio") <= F.least(f("maximum"), F.lit(most)))
    good = (f("status") == "PASS") & f("applicable") & (F.least("left_points", "right_points") >= points) & (f("cells") >= cells) & (f("coverage") >= coverage) & near
    rest = ((f("status") == "PASS") & f("applicable")) | ((f("status") == "NOT_APPLICABLE") & ~f("applicable") & (F.length(F.trim("reason")) > 0))
    rows = summaries.join(required.select("pair", F.lit(True).alias("_need")), "pair", "full")
    ok = F.coalesce(F.when(f("_need"), good).otherwise(rest), F.lit(False))
    return rows.agg((F.sum((~ok).cast("int")) == 0).alias("_all"), F.count("_need").alias("_n")).select((f("_all") & (f("_n") > 0)).alias("passed"))


def keep_keypoints(keypoints: DataFrame, by: Sequence[str], most: int, limit: float) -> DataFrame:
    """Keypoints (index, x, y, scale) that are finite, of a size and within the limit: the largest of each image, with how many went and whether it was cut."""
    bad = finite("x").isNull() | finite("y").isNull() | F.coalesce(finite("scale") <= 0, F.lit(True)) | (F.abs("x") > limit) | (F.abs("y") > limit)
    rows = keypoints.withColumn("_bad", bad)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_bad", F.desc("scale"), "index"))
    n = Window.partitionBy(*by)
    rows = rows.withColumns({"_rank": rank, "removed": F.sum(F.col("_bad").cast("int")).over(n)}).withColumn("clipped", F.count("*").over(n) - F.col("removed") > most)
    return rows.where(~F.col("_bad") & (F.col("_rank") <= most)).select(*by, "index", "removed", "clipped")


def stale_inputs(recorded: DataFrame, now: DataFrame) -> DataFrame:
    """Recorded inputs (path, sha256) that are gone or have other bytes now."""
    rows = recorded.join(now.select("path", F.col("sha256").alias("_now")), "path", "left").where(~F.col("sha256").eqNullSafe(F.col("_now")))
    return rows.select("path", F.when(F.col("_now").isNull(), "missing").otherwise("changed").alias("problem"))


def snapshot_digest(files: DataFrame, by: Sequence[str]) -> DataFrame:
    """One digest for each folder: of its files' lines of path, digest and size, in order of path (path, sha256, size)."""
    line = F.concat_ws("\0", "path", "sha256", F.col("size").cast("string"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("path", line.alias("line")))), lambda x: F.concat(x["line"], F.lit("\n")))
    return files.groupBy(*by).agg(F.sha2(F.array_join(lines, ""), 256).alias("digest"), F.count("*").alias("files"))


def packed_cells_ok(cells: DataFrame, by: Sequence[str], width: int, count: int) -> DataFrame:
    """Whether every group has all `count` cells, and each with a finite place holds the column and row that its number packs."""
    right = finite("x").isNull() | ((F.col("cx") == F.col("cell") % width) & (F.col("cy") == F.floor(F.col("cell") / width)))
    return cells.groupBy(*by).agg(((F.count_distinct("cell") == count) & (F.min(right.cast("int")) == 1)).alias("ok"))
