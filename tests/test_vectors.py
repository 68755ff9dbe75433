"""Searches among vectors in blocks give what comparing every pair gives."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lumenmap.functions.exprs import cosine
from lumenmap.operators import upkeep, vectors
from lumenmap.operators import windows as W


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], i % 4 if i % 9 else None) for i in range(160)]
    rows += [(200 + i, rows[i % 7][1], 1) for i in range(60)]  # copies: ties
    rows += [(300, None, 2), (301, [0.0] * 6, 2), (302, [1.0, 2.0], 2), (303, [1.0, None, 0.0, 0.0, 0.0, 0.0], 3), (304, [], 3), (None, [1.0] * 6, 1)]
    return spark.createDataFrame(rows, "id long, v array<float>, tag int").cache()


def pairs(table, queries):
    q = queries.select(F.col("id").alias("q"), F.col("v").alias("_q"))
    return table.select(F.col("id").alias("r"), "tag", F.col("v").alias("_r")).join(q, F.col("q") != F.col("r")).select("q", "r", "tag", F.round(cosine("_q", "_r"), 9).alias("score"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(autouse=True, params=["small", "large"])
def sizes(request, monkeypatch):
    if request.param == "small":
        monkeypatch.setattr(vectors, "PIECE", 50)
        monkeypatch.setattr(vectors, "BLOCK", 100)
        monkeypatch.setattr(vectors, "HELD", 10)


def test_searches_equal_all_pairs(spark, table):
    q = table.where("id % 10 = 0 or id > 300")
    s = pairs(table, q)
    for k in (3, 80):
        assert rows(vectors.nearest(q, table, k, "id", "v", "tag", 9).select("q", "r", "tag", "score", "rank")) == rows(W.top_k(s, ["q"], [F.desc("score"), "r"], k, "rank"))
    assert rows(vectors.best_by_tag(q, table, "id", "v", "tag", 9)) == rows(s.groupBy("q", "tag").agg(F.max("score").alias("score")))
    assert rows(vectors.mutual_nearest(q, table, 3, "id", "v", 9)) == rows(W.mutual_top_k(s.where("score is not null"), "q", "r", "score", 3).select("q", "r", "score").unionByName(W.mutual_top_k(s, "q", "r", "score", 3).where("score is null").select("q", "r", "score")))
    assert rows(vectors.nearest(q.limit(0), table, 3, "id", "v")) == rows(vectors.nearest(q, table.limit(0), 3, "id", "v")) == []


def test_uniqueness_equals_all_pairs(spark, table):
    q, kept = table.where("id % 10 = 0 or id > 299"), table.where("id % 10 > 2 and id < 160")
    got = {r["id"]: r["uniqueness"] for r in upkeep.uniqueness(q, kept, "id", "v").collect()}
    near = q.alias("x").join(kept.alias("y"), F.size("x.v") == F.size("y.v")).groupBy("x.id").agg(F.min(1 - cosine("x.v", "y.v")).alias("d"))
    want = {r["id"]: r["d"] for r in near.collect()}
    assert len(got) == q.count() and got[300] == -1
    assert all(math.isclose(u, 1.0 if want.get(i) is None else want[i], abs_tol=1e-15) for i, u in got.items() if i != 300)


def test_tasks_keep_few_rows(spark, table):
    """A task hands on k rows for each query, not one for each pair."""
    q = table.where("id % 10 = 0")
    got = vectors._search(q.select(F.col("id").alias("q"), "v"), table.where("id is not null").select(F.col("id").alias("r"), "v", "tag").coalesce(1), 9, lambda n: vectors._Best(n, 2), True)
    assert got.count() <= 2 * q.count() * got.rdd.getNumPartitions() < pairs(table, q).count()


def test_uniqueness_is_rounded_once(spark, tmp_path):
    from lumenmap.plans import QUERIES

    # a distance of 0.57109749...: 7 digits first make 0.5710975, then 0.571098
    c = 1 - 0.57109749
    spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [c, math.sqrt(1 - c * c)], 1)], "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [r["uniqueness"] for r in QUERIES["descriptor_uniqueness"](spark, str(tmp_path)).collect()] == [0.571097]
