"""Every registered query against its DuckDB SQL on the smallest tables, plus the
entry smoke check."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pulse.plans import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import FAMILY, TABLES, rows_of


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    d_types = {d[0]: str(d[1]) for d in res.description}
    assert {c: FAMILY.get(s_types[c], s_types[c]) for c in s_cols} == \
        {c: FAMILY.get(d_types[c], d_types[c]) for c in s_cols}
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "sentiment_label", "tweet_count", "avg_sentiment"]
    assert df.count() > 0
