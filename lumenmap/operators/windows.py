"""Sequence operators: tie-aware ranks, runs, hysteresis, sampling, curves over tie groups, quotas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import cut

EULER = 0.5772156649015329


def in_ranges(df: DataFrame, order: Sequence[str], name: str = "ranges") -> DataFrame:
    """df dealt by ranges of the order columns, with the number of the range in _part; written, so that the numbers stay."""
    return cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)


def ordered_numbers(df: DataFrame, order: Sequence[str], value: str) -> DataFrame:
    """df with place (from 1) and running (the sum of value so far) in the order of all its rows.

    The rows are sorted range by range, never in one task; one sum for each range is added up. Ties of order come
    in any order, so order should tell rows apart.
    """
    ranged = in_ranges(df, order)
    sums = ranged.groupBy("_part").agg(F.count("*").alias("_in_part"), F.sum(value).alias("_of_part"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    base = sums.select("_part", F.coalesce(F.sum("_in_part").over(before), F.lit(0)).alias("_places"), F.coalesce(F.sum("_of_part").over(before), F.lit(0)).alias("_sums"))
    w = Window.partitionBy("_part").orderBy(*order)
    rows = ranged.join(F.broadcast(base), "_part")
    so_far = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(*df.columns, (F.row_number().over(w) + F.col("_places")).alias("place"), (so_far + F.col("_sums")).alias("running"))


def last_before(df: DataFrame, at: str, steps: DataFrame, start: str, value: str, to: str) -> DataFrame:
    """df with the value of the last step whose start is at or below `at`; before the first step, the first one's."""
    both = df.select(F.col(at).alias("_k"), F.lit(1).alias("_tag"), F.struct(*df.columns).alias("_row"), F.lit(None).cast("double").alias("_v"))
    both = both.unionByName(steps.select(F.col(start).alias("_k"), F.lit(0).alias("_tag"), F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), F.col(value).cast("double").alias("_v")))
    ranged = in_ranges(both, ["_k", "_tag"])
    ends = ranged.where("_tag = 0").groupBy("_part").agg(F.max_by("_v", "_k").alias("_end"))
    parts = ranged.select("_part").distinct().join(ends, "_part", "left")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    carried = parts.select("_part", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    first = steps.agg(F.min_by(F.col(value).cast("double"), F.col(start)).alias("_first"))
    w = Window.partitionBy("_part").orderBy("_k", "_tag").rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.withColumn("_seen", F.last("_v", ignorenulls=True).over(w)).where("_tag = 1")
    rows = rows.join(F.broadcast(carried), "_part").crossJoin(F.broadcast(first))  # one row for each range; one row
    return rows.select("_row.*", F.coalesce("_seen", "_carried", "_first").alias(to))


def harmonic(n: Column) -> Column:
    """The n-th harmonic number: a sum for small n, else its expansion, which is exact to 13 digits there."""
    few = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(n, F.lit(20)), F.lit(1)).cast("int")), F.lit(0.0), lambda a, k: a + 1 / k)
    x = n.cast("double")
    many = F.log(x) + EULER + 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6)
    return F.when(n < 1, 0.0).when(n <= 20, few).otherwise(many)


def percentile_rank(df: DataFrame, value: str, to: str = "rank", by: Sequence[str] = (), higher_is_better: bool = True) -> DataFrame:
    """Average rank of ties in [0, 1]; null stays null, a single value is 1, all tied are 0.5.

    Ranks come from one count for each distinct value. Without `by` the values are sorted in ranges.
    """
    g = [*by, value]
    counts = df.where(F.col(value).isNotNull()).groupBy(*g).agg(F.count("*").alias("_n"))
    if by:
        w = Window.partitionBy(*by).orderBy(F.col(value).asc() if higher_is_better else F.col(value).desc())
        before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.select(*g, "_n", before.alias("_before"), F.sum("_n").over(Window.partitionBy(*by)).alias("_total"))
    else:
        sums = ordered_numbers(counts, [value], "_n")
        rows = sums.crossJoin(F.broadcast(counts.agg(F.sum("_n").alias("_total"))))  # one row
        below = F.col("running") - F.col("_n")
        counts = rows.select(value, "_n", (below if higher_is_better else F.col("_total") - F.col("running")).alias("_before"), "_total")
    rank = F.when(F.col("_total") == 1, 1.0).otherwise((F.col("_before") + (F.col("_n") - 1) / 2) / (F.col("_total") - 1))
    return df.join(counts.select(*g, rank.alias(to)), g, "left")


def runs(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Stretches of equal values: (by, run, value, n, first and last of the first order column)."""
    w = Window.partitionBy(*by).orderBy(*order)
    changed = (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("long")
    marked = df.withColumn("_c", changed).withColumn("run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    o = order[0]
    return marked.groupBy(*by, "run").agg(F.first(value).alias(value), F.count("*").alias("n"), F.min(o).alias("first"), F.max(o).alias("last"))


def longest_run(df: DataFrame, by: Sequence[str], order: Sequence[str], flag: str) -> DataFrame:
    """(by, longest): the longest stretch of true flags, 0 where there is none."""
    r = runs(df.withColumn("_f", F.coalesce(F.col(flag), F.lit(False))), by, order, "_f")
    return r.groupBy(*by).agg(F.coalesce(F.max(F.when(F.col("_f"), F.col("n"))), F.lit(0)).alias("longest"))


def hysteresis(df: DataFrame, by: Sequence[str], order: Sequence[str], risk: str, enter: float = 0.45, exit: float = 0.35, to: str = "weak") -> DataFrame:
    """A flag that is set from a value of `enter` on and cleared from a value of `exit` on; between, and at null, it stays."""
    if not enter > exit:
        raise ValueError("enter must be above exit")
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col(risk) >= enter, True).when(F.col(risk) <= exit, False)
    return df.withColumn(to, F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit(False)))


def weak_segments(df: DataFrame, by: Sequence[str], order: Sequence[str], risk: str, length: str, least: float = 1.0, **limits) -> DataFrame:
    """Stretches of the hysteresis flag of at least a length: (by, run, n, first, last, length, mean_risk, max_risk), worst first by rank."""
    h = hysteresis(df, by, order, risk, to="_weak", **limits)
    w = Window.partitionBy(*by).orderBy(*order)
    h = h.withColumn("_c", (~F.col("_weak").eqNullSafe(F.lag("_weak").over(w))).cast("long")).withColumn("run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    o = order[0]
    g = h.where("_weak").groupBy(*by, "run").agg(F.count("*").alias("n"), F.min(o).alias("first"), F.max(o).alias("last"), F.sum(length).alias("length"), F.avg(risk).alias("mean_risk"), F.max(risk).alias("max_risk")).where(F.col("length") >= least)
    p = Window.partitionBy(*by).orderBy(F.desc(F.col("mean_risk") * F.col("length")), "run")
    return g.withColumn("priority", F.row_number().over(p))


def trapezoid_weights(df: DataFrame, by: Sequence[str], order: str, to: str = "weight") -> DataFrame:
    """Half the way to the neighbour on either side."""
    w = Window.partitionBy(*by).orderBy(order)
    back, ahead = F.col(order) - F.lag(order).over(w), F.lead(order).over(w) - F.col(order)
    return df.withColumn(to, (F.coalesce(back, F.lit(0.0)) + F.coalesce(ahead, F.lit(0.0))) / 2)


def resample_route(route: DataFrame, by: Sequence[str], order: str, xyz: Sequence[str], spacing: float) -> DataFrame:
    """Points every `spacing` along each polyline and its end: (by, s, xyz); equal neighbours count once."""
    w = Window.partitionBy(*by).orderBy(order)
    step2 = sum(((F.col(c) - F.lag(c).over(w)) * (F.col(c) - F.lag(c).over(w)) for c in xyz), F.lit(0.0))
    legs = route.withColumn("_d", F.coalesce(F.sqrt(step2), F.lit(0.0))).withColumn("_s1", F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    legs = legs.select(*by, "_s1", (F.col("_s1") - F.col("_d")).alias("_s0"), "_d", *[F.col(c).alias(f"_b_{c}") for c in xyz], *[F.lag(c).over(w).alias(f"_a_{c}") for c in xyz])
    legs = legs.where("_d > 0")
    total = F.max("_s1").over(Window.partitionBy(*by))
    legs = legs.withColumn("_total", total)
    last = F.col("_s1") == F.col("_total")
    low = F.ceil(F.col("_s0") / spacing)
    high = F.ceil(F.col("_s1") / spacing) - 1
    ticks = F.when(high >= low, F.transform(F.sequence(low, F.greatest(low, high)), lambda k: k.cast("double") * spacing)).otherwise(F.array().cast("array<double>"))
    s = F.explode(F.when(last, F.concat(ticks, F.array("_s1"))).otherwise(ticks)).alias("s")
    rows = legs.select(*by, "_s0", "_d", *[f"_a_{c}" for c in xyz], *[f"_b_{c}" for c in xyz], s)
    t = (F.col("s") - F.col("_s0")) / F.col("_d")
    return rows.select(*by, "s", *[(F.col(f"_a_{c}") + t * (F.col(f"_b_{c}") - F.col(f"_a_{c}"))).alias(c) for c in xyz])


def stride_sample(df: DataFrame, by: Sequence[str], order: Sequence[str], stride: int, ends: int = 0) -> DataFrame:
    """Every stride-th row of each group, and all of the first and last `ends` rows."""
    w = Window.partitionBy(*by).orderBy(*order)
    n = F.count("*").over(Window.partitionBy(*by))
    i = F.row_number().over(w) - 1
    return df.withColumn("_i", i).withColumn("_n", n).where((F.col("_i") % stride == 0) | (F.col("_i") < ends) | (F.col("_i") >= F.col("_n") - ends)).drop("_i", "_n")


def select_evenly(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """k rows of each group at even places, both ends among them; places round half to even."""
    w = Window.partitionBy(*by).orderBy(*order)
    n = F.count("*").over(Window.partitionBy(*by))
    x = df.withColumn("_i", (F.row_number().over(w) - 1).cast("long")).withColumn("_n", n)
    places = F.when(F.col("_n") <= k, F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).otherwise(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.rint(j * (F.col("_n") - 1) / max(k - 1, 1)).cast("long")))
    return x.where(F.array_contains(places, F.col("_i"))).drop("_i", "_n")


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], k: int, to: str | None = None) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    r = df.withColumn(to or "_rank", F.row_number().over(w)).where(F.col(to or "_rank") <= k)
    return r if to else r.drop("_rank")


def mutual_top_k(scores: DataFrame, left: str, right: str, score: str, k: int = 1) -> DataFrame:
    """Pairs that are among the k best of both their ends; ties by the other's name."""
    a = Window.partitionBy(left).orderBy(F.desc(score), right)
    b = Window.partitionBy(right).orderBy(F.desc(score), left)
    return scores.withColumn("_a", F.row_number().over(a)).withColumn("_b", F.row_number().over(b)).where((F.col("_a") <= k) & (F.col("_b") <= k)).drop("_a", "_b")


def stability_rerank(scores: DataFrame, query: str, item: str, score: str, stability: str, k: int, pool: int = 4, weight: float = 0.1) -> DataFrame:
    """The k best of each query's k * pool best by score, after adding weight * ln(stability)."""
    p = top_k(scores, [query], [F.desc(score), F.col(item)], k * pool)
    return top_k(p.withColumn("adjusted", F.col(score) + weight * F.log(stability)), [query], [F.desc("adjusted"), F.col(item)], k, "rank")


def score_grid_select(df: DataFrame, by: Sequence[str], cell: str, score: str, tie: str, per_cell: int, total: int) -> DataFrame:
    """The best per_cell rows of each cell first, then the best of the others, up to a total for each group."""
    c = Window.partitionBy(*by, cell).orderBy(F.desc(score), tie)
    x = df.withColumn("_q", (F.row_number().over(c) > per_cell).cast("int"))
    return x.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_q", F.desc(score), tie))).where(F.col("_r") <= total).drop("_q", "_r")


def merge_last(df: DataFrame, key: Sequence[str], order: str, fields: Sequence[str]) -> DataFrame:
    """One row for each key; each field has its last value that is not null."""
    # max over (order, value) skips nulls and combines before the shuffle, where a window would sort all rows
    return df.groupBy(*key).agg(*[F.max(F.when(F.col(f).isNotNull(), F.struct(F.col(order).alias("o"), F.col(f).alias("v"))))["v"].alias(f) for f in fields])


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return top_k(df, key, order, 1)


def risk_coverage(df: DataFrame, risk: str, failed: str) -> DataFrame:
    """Curve over tie groups of rising risk: (risk, n, failures, covered, failed_before_or_at, coverage, selective_risk)."""
    g = df.where(F.col(risk).isNotNull()).groupBy(F.col(risk).alias("risk")).agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("failures"))
    total = g.agg(F.sum("n").alias("_total"))
    c = ordered_numbers(g, ["risk"], "n").withColumnRenamed("running", "covered").drop("place")
    c = ordered_numbers(c, ["risk"], "failures").withColumnRenamed("running", "failed_so_far").drop("place")
    return c.crossJoin(F.broadcast(total)).select("risk", "n", "failures", "covered", "failed_so_far", (F.col("covered") / F.col("_total")).alias("coverage"), (F.col("failed_so_far") / F.col("covered")).alias("selective_risk"))  # one row


def aurc(df: DataFrame, risk: str, failed: str) -> DataFrame:
    """One row: the mean over all prefixes of the expected failure rate, ties in expectation, and the same for a perfect order."""
    c = risk_coverage(df, risk, failed)
    # over a tie group after b rows with f failures, the k-th prefix has (f + k p) / (b + k); its sum has a closed form
    b, f, n = F.col("covered") - F.col("n"), F.col("failed_so_far") - F.col("failures"), F.col("n")
    p = F.col("failures") / n
    curve = c.agg((F.sum(p * n + (f - p * b) * (harmonic(b + n) - harmonic(b))) / F.sum("n")).alias("aurc"))
    totals = df.where(F.col(risk).isNotNull()).agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("f"))
    # a perfect order accepts the n - f successes first, then failures only
    s = F.col("n") - F.col("f")
    oracle = totals.select(F.when(F.col("n") > 0, (F.col("f") - s * (harmonic(F.col("n")) - harmonic(s))) / F.col("n")).alias("oracle_aurc"))
    return curve.crossJoin(oracle)  # one row each


def auroc(df: DataFrame, risk: str, failed: str) -> DataFrame:
    """One row: the chance that a failure has the higher risk, ties as half; null without both kinds."""
    c = risk_coverage(df, risk, failed)
    mid = F.col("covered") - F.col("n") + (F.col("n") + 1) / 2
    one = c.agg(F.sum(mid * F.col("failures")).alias("r"), F.sum("failures").alias("p"), F.sum(F.col("n") - F.col("failures")).alias("q"))
    return one.select(F.when((F.col("p") > 0) & (F.col("q") > 0), (F.col("r") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * F.col("q"))).alias("auroc"))


def calibration_error(df: DataFrame, risk: str, failed: str, bins: int = 10) -> DataFrame:
    """One row: expected calibration error over bins of equal width, Brier score and log loss."""
    x = df.where(F.col(risk).isNotNull()).select(F.col(risk).cast("double").alias("p"), F.col(failed).cast("double").alias("y"))
    b = x.groupBy(F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"), F.avg("p").alias("p"), F.avg("y").alias("y"))
    ece = b.agg((F.sum(F.col("n") * F.abs(F.col("p") - F.col("y"))) / F.sum("n")).alias("ece"))
    q = F.least(F.greatest("p", F.lit(1e-12)), F.lit(1 - 1e-12))
    rest = x.agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"), F.avg(-(F.col("y") * F.log(q) + (1 - F.col("y")) * F.log(1 - q))).alias("log_loss"))
    return ece.crossJoin(rest)  # one row each
