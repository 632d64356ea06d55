import duckdb
import pytest

import __spark_entry__ as entry
from strata.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[key](spark, SF)
    res = con.execute(ORACLE[key])
    names = [d[0] for d in res.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(res.fetchall(), key=repr)


def test_registered(spark):
    keys = entry.queries()
    assert all(any(k.startswith(f"op{n}_") for k in keys) for n in range(1, 14)) and "pipeline" in keys
