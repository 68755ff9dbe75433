"""Gated benchmarks, comparisons, regions, selective risk and calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import gates as G
from ..operators import windows as W
from . import analogues as A
from .registry import query, table


@query(f"SELECT query, array_to_string(reasons, ',') AS reasons, strict FROM ({A.gated_sql()})")
def failure_reasons(spark: SparkSession, d: str) -> DataFrame:
    return G.with_failures(A.results(spark, d)).select("query", F.array_join("reasons", ",").alias("reasons"), "strict")


@query(f"""SELECT count(*) AS total, round(avg(success::INT), 9) AS raw_rate, round(avg(strict::INT), 9) AS strict_rate, round(quantile_cont(inliers, 0.1), 6) AS p10_inliers,
  round(quantile_cont(inliers, 0.5), 6) AS median_inliers, round(quantile_cont(reproj_p90_px, 0.9), 6) AS p90_reproj FROM ({A.gated_sql()})""")
def strict_benchmark(spark: SparkSession, d: str) -> DataFrame:
    one = G.summarize(G.with_failures(A.results(spark, d)))
    return one.select("total", F.round("raw_rate", 9).alias("raw_rate"), F.round("strict_rate", 9).alias("strict_rate"), *[F.round(c, 6).alias(c) for c in ("p10_inliers", "median_inliers", "p90_reproj")])


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM ({A.gated_sql()})) GROUP BY reason")
def failure_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return G.reason_counts(G.with_failures(A.results(spark, d)))


_CRITERIA = G.LocalizationGates().rules()


@query(
    " UNION ALL ".join(
        f"SELECT '{m}' AS criterion, round(avg((len([r FOR r IN reasons IF r NOT IN ('{reason}', 'missing_{m}')]) = 0)::INT), 9) AS strict_rate, round(avg((len([r FOR r IN reasons IF r NOT IN ('{reason}', 'missing_{m}')]) = 0)::INT) - avg(strict::INT), 9) AS gain FROM ({A.gated_sql()})"
        for reason, m, _, _ in _CRITERIA
    )
)
def leave_one_criterion(spark: SparkSession, d: str) -> DataFrame:
    return G.leave_one_criterion(G.with_failures(A.results(spark, d))).select("criterion", F.round("strict_rate", 9).alias("strict_rate"), F.round("gain", 9).alias("gain"))


_CELLS_SQL = f"SELECT concat_ws(':', floor(x / 5)::BIGINT, floor(y / 5)::BIGINT, floor(z / 5)::BIGINT) AS cell, count(*) AS n, sum((NOT strict)::BIGINT)::BIGINT AS failures FROM ({A.gated_sql()}) GROUP BY 1"


@query(f"SELECT *, round(1 - failures / n, 9) AS strict_rate, CASE WHEN n < 2 THEN 'INSUFFICIENT_EVIDENCE' ELSE 'WEAK' END AS status FROM ({_CELLS_SQL}) WHERE failures > 0")
def cell_weak_regions(spark: SparkSession, d: str) -> DataFrame:
    return G.cell_regions(G.with_failures(A.results(spark, d))).withColumn("strict_rate", F.round("strict_rate", 9))


def _regions(spark: SparkSession, d: str) -> DataFrame:
    r = G.with_failures(A.results(spark, d))
    return r.groupBy(E.cell_of(5.0, "x", "y", "z").alias("cell")).agg(F.count("*").alias("n"), F.sum((~F.col("strict")).cast("long")).alias("failures"))


_WILSON_SQL = """greatest(0, (p + z2 / (2 * n)) / (1 + z2 / n) - z * sqrt(p * (1 - p) / n + z2 / (4.0 * n * n)) / (1 + z2 / n)) AS lower_, least(1, (p + z2 / (2 * n)) / (1 + z2 / n) + z * sqrt(p * (1 - p) / n + z2 / (4.0 * n * n)) / (1 + z2 / n)) AS upper_"""


@query(f"""WITH c AS ({_CELLS_SQL}), w AS (SELECT *, {_WILSON_SQL} FROM (SELECT *, failures / n AS p, 1.959963984540054::DOUBLE AS z, (1.959963984540054::DOUBLE * 1.959963984540054::DOUBLE) AS z2 FROM c))
  SELECT cell, n, failures, round(lower_, 9) AS lower, round(upper_, 9) AS upper, CASE WHEN n < 8 THEN 'INSUFFICIENT_EVIDENCE' WHEN failures >= 2 AND lower_ >= 0.30 THEN 'WEAK' WHEN upper_ <= 0.10 THEN 'HEALTHY' ELSE 'UNCERTAIN' END AS status FROM w""")
def region_wilson(spark: SparkSession, d: str) -> DataFrame:
    low, high = E.wilson("failures", "n")
    r = _regions(spark, d).withColumn("lower", low).withColumn("upper", high).withColumn("status", E.region_status("n", "failures", "lower", "upper"))
    return r.withColumn("lower", F.round("lower", 9)).withColumn("upper", F.round("upper", 9))


@query(f"""WITH c AS ({_CELLS_SQL}), t AS (SELECT sum(failures) AS f, sum(n) AS m FROM c)
  SELECT cell, n, failures, round((failures + 8.0 * (f + 0.5) / (m + 1)) / (n + 8.0), 9) AS posterior FROM c, t""")
def region_posterior(spark: SparkSession, d: str) -> DataFrame:
    r = _regions(spark, d)
    total = r.agg(F.sum("failures").alias("f"), F.sum("n").alias("m"))
    a, b = E.beta_prior("f", "m")
    j = r.crossJoin(F.broadcast(total)).withColumn("a", a).withColumn("b", b)  # one row
    return j.select("cell", "n", "failures", F.round(E.beta_posterior_mean("failures", "n", "a", "b"), 9).alias("posterior"))


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return G.with_failures(A.results(spark, d, "N")), G.with_failures(A.results(spark, d, "R"))


_COMPARE_SQL = f"""SELECT query, CASE WHEN b AND NOT c THEN 'newly_failed' WHEN NOT b AND c THEN 'newly_recovered' WHEN b THEN 'common_success' ELSE 'common_failure' END AS change, bi, ci, br, cr, b, c FROM
  (SELECT coalesce(x.query, y.query) AS query, coalesce(x.strict, false) AS b, coalesce(y.strict, false) AS c, x.inliers AS bi, y.inliers AS ci, x.reproj_p90_px AS br, y.reproj_p90_px AS cr
   FROM ({A.gated_sql("N")}) x FULL JOIN ({A.gated_sql("R")}) y ON x.query = y.query)"""


@query(f"SELECT query, change FROM ({_COMPARE_SQL})")
def compare_universe(spark: SparkSession, d: str) -> DataFrame:
    return G.compare(*_sides(spark, d)).select("query", "change")


@query(f"SELECT query FROM ({_COMPARE_SQL}) WHERE change = 'newly_failed'")
def newly_failed(spark: SparkSession, d: str) -> DataFrame:
    return G.compare(*_sides(spark, d)).where("change = 'newly_failed'").select("query")


@query(f"""SELECT n, base_ok, candidate_ok, newly_failed, newly_recovered, common, concat_ws(',', CASE WHEN (base_ok - candidate_ok) * 100 > n * 2 THEN 'success_rate_drop' END, CASE WHEN newly_failed * 100 > n * 2 THEN 'new_failures' END,
  CASE WHEN ci < bi * (1 - 0.05::DOUBLE) THEN 'inlier_drop' END, CASE WHEN cr > br + 0.5 THEN 'reprojection_rise' END) AS failed_gates FROM
  (SELECT count(*) AS n, sum(b::BIGINT)::BIGINT AS base_ok, sum(c::BIGINT)::BIGINT AS candidate_ok, count(*) FILTER (change = 'newly_failed') AS newly_failed, count(*) FILTER (change = 'newly_recovered') AS newly_recovered,
   count(*) FILTER (change = 'common_success') AS common, quantile_cont(bi, 0.5) FILTER (change = 'common_success') AS bi, quantile_cont(ci, 0.5) FILTER (change = 'common_success') AS ci,
   quantile_cont(br, 0.5) FILTER (change = 'common_success') AS br, quantile_cont(cr, 0.5) FILTER (change = 'common_success') AS cr FROM ({_COMPARE_SQL}))""")
def comparison_gate(spark: SparkSession, d: str) -> DataFrame:
    return G.comparison_gate(G.compare(*_sides(spark, d))).select("n", "base_ok", "candidate_ok", "newly_failed", "newly_recovered", "common", F.array_join("failed_gates", ",").alias("failed_gates"))


@query(f"""WITH r AS ({A.RISKS_SQL}), g AS (SELECT risk, count(*) AS n, sum(failed::BIGINT)::BIGINT AS failures FROM r GROUP BY risk), t AS (SELECT count(*) AS m FROM r)
  SELECT risk, n, failures, sum(n) OVER (ORDER BY risk)::BIGINT AS covered, round(sum(n) OVER (ORDER BY risk) / m, 9) AS coverage, round(sum(failures) OVER (ORDER BY risk) / sum(n) OVER (ORDER BY risk), 9) AS selective_risk FROM g, t""")
def risk_coverage_curve(spark: SparkSession, d: str) -> DataFrame:
    c = W.risk_coverage(A.risks(spark, d), "risk", "failed")
    return c.select("risk", "n", "failures", "covered", F.round("coverage", 9).alias("coverage"), F.round("selective_risk", 9).alias("selective_risk"))


@query(f"""WITH r AS (SELECT *, rank() OVER (ORDER BY risk) AS lo, count(*) OVER (PARTITION BY risk) AS k FROM ({A.RISKS_SQL})), s AS (SELECT sum(lo + (k - 1) / 2.0) FILTER (failed) AS rs, count(*) FILTER (failed) AS p, count(*) FILTER (NOT failed) AS q FROM r)
  SELECT round((rs - p * (p + 1) / 2.0) / (p * q), 9) AS auroc FROM s""")
def failure_auroc(spark: SparkSession, d: str) -> DataFrame:
    return W.auroc(A.risks(spark, d), "risk", "failed").select(F.round("auroc", 9).alias("auroc"))


@query(f"""WITH r AS ({A.RISKS_SQL}), g AS (SELECT risk, count(*) AS n, sum(failed::INT) AS f FROM r GROUP BY risk), c AS (SELECT *, sum(n) OVER (ORDER BY risk) - n AS bn, sum(f) OVER (ORDER BY risk) - f AS bf FROM g),
  e AS (SELECT bn, bf, f / n AS share, unnest(range(1, n + 1)) AS k FROM c), t AS (SELECT count(*) AS m, sum(failed::INT) AS ff FROM r), o AS (SELECT m - ff AS s, unnest(range(1, m + 1)) AS a FROM t)
  SELECT round((SELECT avg((bf + k * share) / (bn + k)) FROM e), 9) AS aurc, round((SELECT avg(greatest(0, a - s) / a) FROM o), 9) AS oracle_aurc""")
def selective_risk_area(spark: SparkSession, d: str) -> DataFrame:
    return W.aurc(A.risks(spark, d), "risk", "failed").select(F.round("aurc", 9).alias("aurc"), F.round("oracle_aurc", 9).alias("oracle_aurc"))


@query(f"""WITH r AS (SELECT risk AS p, failed::INT AS y FROM ({A.RISKS_SQL})), b AS (SELECT least(floor(p * 10), 9) AS bin, count(*) AS n, avg(p) AS p, avg(y) AS y FROM r GROUP BY 1)
  SELECT round((SELECT sum(n * abs(p - y)) / sum(n) FROM b), 9) AS ece, round(avg((p - y) * (p - y)), 9) AS brier, round(avg(-(y * ln(least(greatest(p, 1e-12), 1 - 1e-12)) + (1 - y) * ln(1 - least(greatest(p, 1e-12), 1 - 1e-12)))), 7) AS log_loss FROM r""")
def calibration_error(spark: SparkSession, d: str) -> DataFrame:
    return W.calibration_error(A.risks(spark, d), "risk", "failed").select(F.round("ece", 9).alias("ece"), F.round("brier", 9).alias("brier"), F.round("log_loss", 7).alias("log_loss"))


@query("""WITH x AS (SELECT p_partkey, p_brand, p_retailprice AS v FROM part), m AS (SELECT p_brand, count(*) AS n, median(v) AS med, quantile_cont(v, 0.1) AS p10, quantile_cont(v, 0.9) AS p90 FROM x GROUP BY 1),
  d AS (SELECT p_brand, median(abs(v - med)) AS mad FROM x JOIN m USING (p_brand) GROUP BY 1) SELECT p_brand, n, round(med, 6) AS med, round(mad, 6) AS mad, round(p10, 6) AS p10, round(p90, 6) AS p90 FROM m JOIN d USING (p_brand)""")
def distribution_block(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.health import distribution

    r = distribution(table(spark, d, "part"), "p_retailprice", ["p_brand"])
    return r.select("p_brand", "n", *[F.round(c, 6).alias(c) for c in ("med", "mad", "p10", "p90")])


@query("""WITH x AS (SELECT p_partkey, p_brand, p_retailprice AS v FROM part), m AS (SELECT p_brand, median(v) AS med, quantile_cont(v, 0.1) AS p10, quantile_cont(v, 0.9) AS p90 FROM x GROUP BY 1), d AS (SELECT p_brand, median(abs(v - med)) AS mad FROM x JOIN m USING (p_brand) GROUP BY 1)
  SELECT p_partkey, round(CASE WHEN mad * 1.4826 > 1e-12 THEN least(1, greatest(0, (v - med) / (mad * 1.4826) / 2.5)) WHEN (p90 - p10) / 2.563 > 1e-12 THEN least(1, greatest(0, (v - med) / ((p90 - p10) / 2.563) / 2.5)) WHEN v > med THEN 1 ELSE 0 END, 6) AS badness FROM x JOIN m USING (p_brand) JOIN d USING (p_brand)""")
def robust_badness(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.health import distribution

    parts = table(spark, d, "part")
    base = distribution(parts, "p_retailprice", ["p_brand"])
    return parts.join(base, "p_brand").select("p_partkey", F.round(E.robust_badness("p_retailprice", "med", "mad", "p10", "p90"), 6).alias("badness"))


@query(f"""SELECT 'x' AS k, missing, duplicate, unknown_ AS unknown, round(rate, 9) AS rate, released FROM (SELECT sum((n IS NULL)::INT)::BIGINT AS missing, sum((coalesce(n, 0) > 1)::INT)::BIGINT AS duplicate, 0::BIGINT AS unknown_, sum(coalesce(success, false)::INT) / count(*) AS rate,
  false AS released FROM (SELECT o_orderkey FROM orders) m LEFT JOIN (SELECT query, count(*) AS n, bool_or(success) AS success FROM ({A.results_sql()}) GROUP BY 1) r ON o_orderkey = query)""")
def held_out_release(spark: SparkSession, d: str) -> DataFrame:
    manifest = table(spark, d, "orders").select(F.col("o_orderkey").alias("query"))
    return G.held_out_release(manifest, A.results(spark, d)).select(F.lit("x").alias("k"), "missing", "duplicate", "unknown", F.round("rate", 9).alias("rate"), "released")


@query(f"""SELECT query, c.* FROM (SELECT query, unnest([{{'check': 'inliers', 'value': inliers::DOUBLE, 'limit': 25.0::DOUBLE, 'margin': inliers::DOUBLE - 25, 'state': CASE WHEN inliers >= 25 THEN 'PASS' ELSE 'FAIL' END}},
  {{'check': 'depth', 'value': positive_depth_ratio, 'limit': 0.98::DOUBLE, 'margin': round(positive_depth_ratio - 0.98, 6), 'state': CASE WHEN positive_depth_ratio IS NULL THEN 'HARD_FAIL' WHEN positive_depth_ratio - 0.98 >= 0 THEN 'PASS' ELSE 'FAIL' END}}]) AS c FROM ({A.results_sql()}))""")
def check_receipts(spark: SparkSession, d: str) -> DataFrame:
    r = G.check_receipts(A.results(spark, d), {"inliers": ("inliers", ">=", 25), "depth": ("positive_depth_ratio", ">=", 0.98)}, ["query"])
    return r.withColumn("margin", F.round("margin", 6))


@query("""SELECT lower(trim(text)) AS v, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1""".replace("lower(trim(text)) AS v", "sha256(lower(trim(text))) AS content_sha256").replace("GROUP BY 1", "GROUP BY sha256(lower(trim(text)))"))
def content_duplicates(spark: SparkSession, d: str) -> DataFrame:
    h = F.sha2(F.lower(F.trim("text")), 256).alias("content_sha256")
    return table(spark, d, "documents").groupBy(h).agg(F.count("*").alias("n")).where("n > 1")


@query("""WITH r AS (SELECT DISTINCT lang AS s, source AS v FROM documents) SELECT 'source' AS key_name, x.s AS split_a, y.s AS split_b, count(*) AS shared FROM r x JOIN r y ON x.v = y.v AND x.s < y.s GROUP BY 2, 3""")
def split_leakage(spark: SparkSession, d: str) -> DataFrame:
    return G.split_leakage(table(spark, d, "documents"), "lang", ["source"])


@query("SELECT event_id, CAST(props::JSON ->> 'k' AS DOUBLE) AS k FROM events")
def metrics_map_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", E.first_finite(F.get_json_object("props", "$.k").cast("double"), F.get_json_object("props", "$.key").cast("double")).alias("k"))


@query("SELECT user_id, event_type, CASE WHEN n_err * 5 > n THEN true ELSE false END AS exceeds, n, n_err FROM (SELECT user_id, min(event_type) AS event_type, count(*) AS n, count(*) FILTER (event_type = 'error') AS n_err FROM events GROUP BY user_id)")
def exact_rate_gate(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "events").groupBy("user_id").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), F.sum((F.col("event_type") == "error").cast("long")).alias("n_err"))
    return g.select("user_id", "event_type", E.rate_exceeds("n_err", "n", 1, 5).alias("exceeds"), "n", "n_err")
