"""Every registered query against its DuckDB oracle (order-free, floats to 6 places)."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from tidewater.sources.tables import TABLES

from .conftest import SF_SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()


#: Queries without an oracle that return one row for each row of a table.
ONE_ROW_EACH = {"embed_hashed": "documents", "isolation_forest": "events", "op1_html_text": "pages", "op2_bpe": "documents",
                "op6_quality": "documents", "op7_toxicity": "documents", "op8_url_filter": "pages", "op9_jaccard_join": "documents",
                "op11_pieces": "documents"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    exp_cols, exp = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)
    assert len(got) == len(exp)
    assert _rows(got_cols, got) == _rows(exp_cols, exp)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.count()
    table = ONE_ROW_EACH.get(name)
    assert rows == (spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count() if table else rows) and rows > 0


def test_every_query_has_stable_schema(spark):
    df = E.entry(spark)
    assert len(df.columns) == 20
    assert df.count() > 0
