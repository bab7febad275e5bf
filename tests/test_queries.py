"""Every query of the library that has SQL gives the rows that the SQL gives on another engine."""

import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from palimpsest.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "pages", "events", "conversations")


def plain(row):
    return tuple(round(float(v), 6) if isinstance(v, (float, Decimal)) else v for v in row)


@pytest.fixture(scope="module")
def engine():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables to run over")
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_rows_equal_those_of_sql(spark, engine, name):
    made = catalog.QUERIES[name](spark, FOLDER)
    told = engine.execute(catalog.ORACLES[name])
    names = [d[0] for d in told.description]
    assert sorted(names) == sorted(made.columns)
    want = Counter(map(plain, told.fetchall()))
    assert Counter(plain(r) for r in made.select(*names).collect()) == want
