"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from scripts.check_queries import TYPES, comparable, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="tables are not there")


def test_each_query_has_its_sql():
    assert {query.__name__ for query in entry.QUERIES} <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert sum(r["count"] for r in entry.entry(spark).collect()) == 1000


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = connect(FOLDER).execute(entry.oracle_sql()[name])
    kinds = {c[0]: str(c[1]) for c in cur.description}
    assert {n: TYPES[t] for n, t in df.dtypes} == kinds
    mine = comparable(df.columns, [tuple(r) for r in df.collect()])
    assert mine == comparable([c[0] for c in cur.description], cur.fetchall())
    assert mine[1]
