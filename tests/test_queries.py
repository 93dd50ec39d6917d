"""Every query with SQL gives the same rows as the SQL, on whole tables."""

import datetime
import os
from collections import Counter

import duckdb
import pytest

from strataq.plans import registry

FOLDER = os.environ.get("STRATAQ_TEST_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, db, name):
    df = registry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = db.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in result.fetchall())
