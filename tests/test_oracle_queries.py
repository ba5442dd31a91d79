"""Every registered query against its DuckDB oracle on sf0.001 (the driver's gate uses sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["file_name", "seq_no", "seq_size", "line"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, duck, name):
    sdf = entry.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("rows-only query")
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]
