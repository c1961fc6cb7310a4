"""Every registered query of the field-year library against DuckDB on the smallest driver tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from terrasheaf.plans import assembly, exploration, grids, registry, sources  # noqa: F401

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    return None if v is None else ("nan" if math.isnan(v) else round(v, 9)) if isinstance(v, float) else v


QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    assert got
    if name in ORACLES:
        cur = con.execute(ORACLES[name])
        have = [d[0] for d in cur.description]
        assert sorted(have) == names
        at = [have.index(c) for c in names]
        want = sorted((tuple(plain(float(r[i]) if str(type(r[i])) == "<class 'decimal.Decimal'>" else r[i]) for i in at) for r in cur.fetchall()), key=str)
        assert got == want
        kinds = dict(df.dtypes)
        assert {c: TYPES.get(kinds[c]) for c in names} == {d[0]: str(d[1]) for d in cur.description}


def test_order_and_limits_are_kept(spark):
    rows = [tuple(r) for r in QUERIES["G4_row_limit"](spark, DATA).collect()]
    assert rows == sorted(rows) and len(rows) == 100
    top = [abs(r["pearson_r"]) for r in QUERIES["G2_strongest_signals"](spark, DATA).collect()]
    assert top == sorted(top, reverse=True)
