"""Driver contract, and every registered query against its DuckDB oracle on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tidelog.plans.queries import QUERIES

TABLES = ["customer", "events", "lineitem", "nation"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_type", "partition", "received_events", "dead_letter_batches",
                          "dead_letter_events", "unconsumed_events", "consumer_lag_seconds"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


def _norm(rows):
    def n(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(n(v) for v in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    cols = sorted(df.columns)
    got = _norm(tuple(r[c] for c in cols) for r in df.collect())
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_small, t + '.parquet')}')")
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = _norm(tuple(r[i] for i in idx) for r in res.fetchall())
    assert got == want
