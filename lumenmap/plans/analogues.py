"""The driver's tables read as map data: the structural stand-ins that the registered queries use.

Each has a DataFrame and the SQL of the same rows, so that a query and its oracle start from the same place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table


def results(spark: SparkSession, d: str, flag: str | None = None) -> DataFrame:
    """Orders as localisation results; flag keeps the line items of one return flag only."""
    items = table(spark, d, "lineitem")
    if flag is not None:
        items = items.where(F.col("l_returnflag") == flag)
    per = items.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("inliers"),
        F.round(F.avg("l_discount") * 10, 6).alias("inlier_ratio"),
        F.round(F.max("l_tax") * 50, 6).alias("reproj_p90_px"),
        F.round(F.count("*") / 7.0, 6).alias("hull_coverage"),
        (F.countDistinct("l_suppkey") * 2).alias("grid4_occupancy"),
        F.when(F.max("l_linenumber") > 1, F.round(F.avg(F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.95)), 6)).alias("positive_depth_ratio"),
        F.round(F.min("l_tax") * 20, 6).alias("pose_consensus"),
    )
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    j = o.join(per, o["o_orderkey"] == per["l_orderkey"])
    return j.select(
        F.col("o_orderkey").alias("query"),
        (F.col("o_orderstatus") != "F").alias("success"),
        "inliers", "inlier_ratio", "reproj_p90_px", "hull_coverage", "grid4_occupancy", "positive_depth_ratio", "pose_consensus",
        (F.col("o_custkey") % 40).cast("double").alias("x"),
        F.floor(F.col("o_totalprice") / 10000).cast("double").alias("y"),
        (F.col("o_orderkey") % 7).cast("double").alias("z"),
    )


def results_sql(flag: str | None = None) -> str:
    where = f"WHERE l_returnflag = '{flag}'" if flag else ""
    return f"""SELECT o_orderkey AS query, o_orderstatus <> 'F' AS success, inliers, inlier_ratio, reproj_p90_px, hull_coverage, grid4_occupancy, positive_depth_ratio, pose_consensus,
      CAST(o_custkey % 40 AS DOUBLE) AS x, floor(o_totalprice / 10000) AS y, CAST(o_orderkey % 7 AS DOUBLE) AS z
    FROM orders JOIN (SELECT l_orderkey, sum(l_quantity) AS inliers, round(avg(l_discount) * 10, 6) AS inlier_ratio, round(max(l_tax) * 50, 6) AS reproj_p90_px,
      round(count(*) / 7.0, 6) AS hull_coverage, count(DISTINCT l_suppkey) * 2 AS grid4_occupancy,
      CASE WHEN max(l_linenumber) > 1 THEN round(avg(CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.95::DOUBLE END), 6) END AS positive_depth_ratio,
      round(min(l_tax) * 20, 6) AS pose_consensus FROM lineitem {where} GROUP BY l_orderkey) i ON o_orderkey = l_orderkey"""


FAILURES_SQL = """[r FOR r IN [CASE WHEN NOT success THEN 'localization_failed' END, CASE WHEN inliers < 25 THEN 'low_inliers' END, CASE WHEN inlier_ratio < 0.25 THEN 'low_inlier_ratio' END,
  CASE WHEN reproj_p90_px > 3.0 THEN 'high_reprojection_error' END, CASE WHEN hull_coverage < 0.15 THEN 'low_hull_coverage' END, CASE WHEN grid4_occupancy < 6 THEN 'low_grid_occupancy' END,
  CASE WHEN positive_depth_ratio < 1.0 THEN 'low_positive_depth_ratio' END, CASE WHEN pose_consensus < 0.67 THEN 'low_pose_consensus' END] IF r IS NOT NULL]"""


def gated_sql(flag: str | None = None) -> str:
    return f"SELECT *, len(reasons) = 0 AS strict FROM (SELECT *, {FAILURES_SQL} AS reasons FROM ({results_sql(flag)}))"


def tracks(spark: SparkSession, d: str) -> DataFrame:
    """Line items as tracks: suppliers are images that see parts as points."""
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("image_id"), F.col("l_partkey").alias("point3d_id"))


def order_tracks(spark: SparkSession, d: str) -> DataFrame:
    """The sparse graph: parts are images that share orders."""
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("image_id"), F.col("l_orderkey").alias("point3d_id"))


PART_EDGES_SQL = """SELECT x.p AS a, y.p AS b, count(*) AS support FROM (SELECT DISTINCT l_partkey AS p, l_orderkey AS o FROM lineitem) x
  JOIN (SELECT DISTINCT l_partkey AS p, l_orderkey AS o FROM lineitem) y ON x.o = y.o AND x.p < y.p GROUP BY 1, 2 HAVING count(*) >= 2"""


def part_edges(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.graph import covisibility

    return covisibility(order_tracks(spark, d), least=2)


def risks(spark: SparkSession, d: str) -> DataFrame:
    """Events as scored queries: a rounded risk with many ties, failed where the event is an error."""
    e = table(spark, d, "events").where("value is not null")
    return e.select("event_id", "user_id", "ts", (F.floor(F.least(F.greatest(F.col("value") / 2, F.lit(0.0)), F.lit(100.0))) / 100).alias("risk"), (F.col("event_type") == "error").alias("failed"))


RISKS_SQL = "SELECT event_id, user_id, ts, floor(least(greatest(value / 2, 0.0), 100.0)) / 100 AS risk, event_type = 'error' AS failed FROM events WHERE value IS NOT NULL"


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings")


def places(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as points in space: the first three components."""
    return vectors(spark, d).select("vec_id", "label", *[F.element_at("embedding", i + 1).cast("double").alias(c) for i, c in enumerate("xyz")])


PLACES_SQL = "SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings"
