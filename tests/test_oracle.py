"""Every SQL-expressible registered query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from helpers import canon

from conftest import SF

ORACLE = E.oracle_sql()
QUERIES = E.queries()
NAMES = sorted(n for n in ORACLE if not n.startswith("op") and n != "pipeline")


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_tiny, name):
    df = QUERIES[name](spark, SF["tiny"])
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck_tiny.execute(ORACLE[name])
    d_cols, d_rows = canon([c[0] for c in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 13
