"""Registered queries against their SQL on the smallest tables, and their plans."""

import duckdb
import pytest
from frame_rows import SF

import __spark_entry__ as entry_points
from check import TABLES, compare
from tonearm.catalog import ORACLE, QUERIES

# Queries that fit a model run once, in test_models.
SLOW = ("ml03", "ml05", "snk06", "rp05", "rp06", "rp09", "gr03_communities", "ag15", "ml08", "ml09", "ml10", "ml11", "jn13_similar_names_matching")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(SLOW)])
def test_query(spark, con, name):
    _, status, note = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    assert status in ("ok", "rows-only"), note


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["artist_id", "total_listens", "unique_listeners", "name"] and df.count() > 0


def test_every_check_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["ag01_user_artist_counts", "ag16_mapping_coverage", "ag21_duplicate_listens", "ag36_mean_overlap", "gr06_redirect_chains", "jn14_artist_search", "ml02_bm25_weights", "set03_best_mapping"])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval"):
        assert word not in plan


def test_scan_reads_only_the_needed_columns(spark):
    plan = QUERIES["ag01_user_artist_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
