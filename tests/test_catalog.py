"""Every registered query of the engine against its SQL on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from tidewatch import catalog

DATA = Path("/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return "nan" if isinstance(v, float) and math.isnan(v) else f"{float(v):.6g}"
    return str(v).removesuffix(" 00:00:00")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, oracle, name):
    df = catalog.QUERIES[name](spark, str(DATA))
    rows = df.collect()
    if name not in catalog.ORACLE_SQL:
        assert df.columns
        return
    want = oracle.sql(catalog.ORACLE_SQL[name])
    order = sorted(want.columns)
    assert sorted(df.columns) == order
    index = [want.columns.index(c) for c in order]
    assert sorted([plain(r[c]) for c in order] for r in rows) == sorted([plain(r[i]) for i in index] for r in want.fetchall())


def test_flagship(spark):
    assert catalog.flagship(spark, str(DATA)).limit(1).count() == 1
