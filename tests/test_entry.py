import os

import duckdb
import pytest

import __spark_entry__ as entry
from locus.plans import queries as plans

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


def plain(x):
    if x is None or isinstance(x, (bool, str)):
        return x
    return round(float(x), 9)


def test_every_query_is_registered():
    found, sql = entry.queries(), entry.oracle_sql()
    assert set(plans.QUERIES) <= set(found) and set(sql) <= set(found)
    assert len(plans.SQL) >= 50


def test_the_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    if name in plans.SQL:
        rel = duck.sql(plans.SQL[name])
        assert sorted(rel.columns) == columns
        want = rel.select(", ".join(f'"{c}"' for c in columns)).fetchall()
        shown = lambda rows: sorted(repr([plain(x) for x in r]) for r in rows)
        assert shown(got) == shown(want)
    else:
        assert got
