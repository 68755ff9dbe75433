"""Update plans where several candidates name one feature, held against their SQL."""

import duckdb
import pytest

from lumenmap.plans import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    # events 8 + 12 k and 1000008 + 12 k are candidates for the same feature
    folder = str(tmp_path_factory.mktemp("events"))
    rows = [(base + i, (i // 24) % 4, ("view", "click", "error")[i % 3]) for base in (0, 1_000_000, 2_000_000) for i in range(600)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["update_strict", "update_aggressive", "update_by_score", "update_latest", "update_summary_strategy", "update_with_gate"])
def test_candidates_of_one_feature_count_each(spark, events, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{events}/events.parquet/*.parquet'")
    df = QUERIES[name](spark, events)
    rel = con.sql(ORACLE_SQL[name])
    got = sorted(map(tuple, df.select(*rel.columns).collect()), key=repr)
    want = sorted(map(tuple, rel.fetchall()), key=repr)
    assert got == want
