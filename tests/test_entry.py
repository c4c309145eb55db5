import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["area", "product_name", "click_count", "city_remark", "rank"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = df.collect()
    sql = E.oracle_sql().get(name)
    assert sql is not None, "every registered query has a DuckDB twin"
    cur = duck.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert _norm(got, df.columns) == _norm(cur.fetchall(), cols)
