"""Driver contract: entry runs, every key has a callable, and every oracle agrees at sf0.001."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF0001

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, norm  # noqa: E402

#: The keys of the training-data operators have their own tests (tests/llm).
KEYS = sorted(k for k in entry.queries() if k != "pipeline" and not k.startswith("op"))


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() == 95 + 39 + 80  # FIXTURES §3 class sizes at sf0.001


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(KEYS) >= 60


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", [k for k in KEYS if k in entry.oracle_sql()])
def test_oracle_parity(spark, duck, key):
    sql = entry.oracle_sql()[key]
    df = entry.queries()[key](spark, SF0001)
    rows = [tuple(norm(x) for x in r) for r in df.collect()]
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(df.columns)
    idx = [ocols.index(c) for c in df.columns]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert sorted(rows, key=repr) == want


@pytest.mark.parametrize("key", ["fraud_mart", "parse_transactions", "scd2_apply_cards", "lag_client"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, key):
    """Everything is wall-clock (timestamp_ntz): another session zone changes nothing."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_oracle_parity(spark, duck, key)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
