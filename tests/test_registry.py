"""Every registered query against its DuckDB twin at sf0.001, plus plan checks."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.oracle_check import digest
from strata.sources.tables import TABLES
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert df.columns
        return
    res = con.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["slugify", "fold_ascii", "parse_number", "repair_text",
                                 "collated_join", "harmonize_schema"])
def test_cleaning_stays_in_jvm(spark, key):
    assert "BatchEvalPython" not in _plan(QUERIES[key](spark, SF_SMALL))


def test_column_pruning_and_no_cartesian(spark):
    plan = _plan(QUERIES["panel_sum"](spark, SF_SMALL))
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,[^>]*>", plan) and "o_orderstatus" not in plan
    assert re.search(r"o_orderdate:\w+", plan) and "o_orderpriority" not in plan
    for key in ["nearest_fill", "enrich_multi", "panel_flagship", "collated_join", "box_stats"]:
        assert "CartesianProduct" not in _plan(QUERIES[key](spark, SF_SMALL))
