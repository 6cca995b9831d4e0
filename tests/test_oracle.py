"""Every query against its SQL on the same tables."""

import os

import pytest

import __spark_entry__ as entry
from tallybridge.plans import bundles, catalogue, committed, landed, landing

QUERIES = catalogue.QUERIES | landing.QUERIES | landed.QUERIES | committed.QUERIES | bundles.QUERIES
duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: int(v) if isinstance(v, float) and v == int(v) else v
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.endswith("_all")))  # the _all queries: test_missing_all_runs
def test_query_matches_sql(spark, sf, con, name):
    sql = entry.oracle_sql().get(name)
    df = QUERIES[name](spark, sf)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        assert got
        return
    result = con.execute(sql)
    want = _rows([d[0] for d in result.description], result.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in con.execute(sql).description)
    assert got == want


def test_digest_is_the_same_for_rows_in_any_order(spark, sf):
    rows = QUERIES["table_digest"](spark, sf).collect()
    assert len(rows) == 2 and rows[0]["digest"] == rows[1]["digest"]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["status", "matched_by", "n"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
