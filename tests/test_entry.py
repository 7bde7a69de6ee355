"""Driver contract and the SQL oracle sweep on the smallest tables."""

import datetime as dt
import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ["events", "part"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_date", "contributor_type", "event_count", "unique_contributors",
                          "_sdc_batched_at"]
    assert df.count() > 0


def test_oracle_keys_subset_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.registry.QUERIES) - set(entry.oracle_sql()) == {"load_history"}


@pytest.mark.parametrize("key", sorted(entry.oracle.ORACLE))
def test_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    s_cols, s_rows = df.columns, df.collect()
    # As a view, the way the correctness check runs it.
    duck.execute(f"CREATE OR REPLACE VIEW expected AS {entry.oracle.ORACLE[key]}")
    res = duck.execute("SELECT * FROM expected")
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert _bag(s_cols, s_rows) == _bag(d_cols, d_rows)


def test_broken_rows_make_rules_fire(spark):
    for key, rules in (("dq_broken_events", {"not_null", "accepted_values"}),
                       ("dq_repeated_repos", {"unique"})):
        rows = entry.queries()[key](spark, SF_SMALL).where("failures > 0").collect()
        assert {r["rule"] for r in rows} >= rules
