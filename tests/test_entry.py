"""The driver contract: entry(), queries(), oracle_sql(), checked against
DuckDB on the smallest scale factor for a representative subset (the
full sweep at sf0.01 is ``python scripts/oracle_check.py``)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

SUBSET = ["conversion_global", "conversion_by_age", "pivot_stages", "abandonment", "merge_scd1_catalog",
          "merge_pivot_scd1", "avg_days_state", "top_abandoned_stage", "parse_date", "landing_stream",
          "empty_table_first_merge", "funnel_rollup_conversion_by_age"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def test_entry_smoke(spark):
    df = E.entry(spark)
    out = df.collect()
    assert df.columns == ["stage", "Total_by_stage", "Percentage_conversion"]
    assert len(out) == 6


def test_every_oracle_key_is_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


@pytest.mark.parametrize("key", SUBSET)
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in ("customer", "nation", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    want = sorted("|".join(_norm(r[i]) for i in sorted(range(len(ocols)), key=lambda i: ocols[i]))
                  for r in res.fetchall())
    sdf = E.queries()[key](spark, SF_SMALL)
    scols = sdf.columns
    assert sorted(scols) == sorted(ocols)
    got = sorted("|".join(_norm(r[i]) for i in sorted(range(len(scols)), key=lambda i: scols[i]))
                 for r in sdf.collect())
    assert got == want
