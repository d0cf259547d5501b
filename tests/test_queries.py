"""Every query against its SQL twin, and the shape of the plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from flowwarden.session import shared_dir

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
STREAMS = {"stream_rolling_alerts", "stream_blocks"}  # have tests of their own
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def normal(values):
    return tuple(None if v is None or v != v else v for v in values)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - STREAMS))
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    result = duck.execute(entry.oracle_sql()[name])
    have = [d[0] for d in result.description]
    assert sorted(have) == columns
    want = sorted((normal(r[have.index(c)] for c in columns) for r in result.fetchall()), key=repr)
    assert sorted((normal(r[c] for c in columns) for r in got.collect()), key=repr) == want


def test_every_query_has_a_twin_or_a_reason():
    assert not {q for q in set(entry.queries()) - set(entry.oracle_sql()) if not q.startswith("op") and q != "pipeline"}
    assert not set(entry.oracle_sql()) - set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


BATCH = ["rolling_window_alerts", "window_statistics", "alert_targets", "block_episodes", "block_counters", "service_stats", "alert_intake", "packet_flows"]


@pytest.mark.parametrize("name", BATCH)
def test_plans_stay_in_the_engine(spark, name):
    plan = final_plan(entry.queries()[name](spark, SF))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert node not in plan


def test_whitelist_is_probed_without_a_shuffle_of_the_rows(spark):
    plan = final_plan(entry.queries()["whitelist_antijoin"](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "c_custkey" in plan and "c_acctbal" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = final_plan(entry.queries()["rolling_window_alerts"](spark, SF))
    assert "props" not in plan and "event_type" not in plan


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
