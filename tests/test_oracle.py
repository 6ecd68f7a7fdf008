"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from clientele.plans.catalog import QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, con, entry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 150


def test_no_query_pairs_rows_without_a_key(spark):
    eager = {"ingest_pages", "export_all", "ordered_load", "incremental_stream", "export_csv",
             "export_parquet", "append_metrics", "where_clause_export", "merge_progress", "stored_checkpoints",
             "resumed_load", "load_run_metrics", "retention", "exact_numbers", "merge_new_column",
             "stored_snapshots", "stored_snapshot_delta"}
    for name, query in QUERIES.items():
        if name in eager:
            continue
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan, name
