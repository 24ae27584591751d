"""Every registered query against its oracle on the driver's tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from granary.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    def one(v):
        if isinstance(v, float):
            return f"{v:.9g}"
        if isinstance(v, (list, tuple)):
            return [one(x) for x in v]
        if isinstance(v, dict):
            return sorted((k, one(x)) for k, x in v.items())
        return str(v)

    return sorted(repr([one(v) for v in r]) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_have_queries():
    assert ORACLES.keys() <= QUERIES.keys()
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [[r[c] for c in columns] for r in df.collect()]
    if name in ORACLES:
        found = duck.execute(ORACLES[name])
        there = [c[0] for c in found.description]
        assert sorted(there) == columns
        at = [there.index(c) for c in columns]
        assert plain(got) == plain([[r[i] for i in at] for r in found.fetchall()])
