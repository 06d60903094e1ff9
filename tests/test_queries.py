"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from lamina.plans.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    assert got
    if name in SQL:
        cur = duck.execute(SQL[name])
        names = [x[0] for x in cur.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert got == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=str)
