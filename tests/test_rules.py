"""Boundary goldens of the four rules, the priority and the report (FIXTURES.md §5)."""

from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bank import tables
from fraudlane.operators.enrich import enrich_transactions
from fraudlane.operators.report import fraud_mart
from fraudlane.operators.rules import classify


def classes(spark, t, **kw):
    e = enrich_transactions(t.fact_transactions, t.dim_cards_hist, t.dim_accounts_hist,
                            t.dim_clients_hist, t.dim_terminals_hist, t.fact_passport_blacklist)
    return {r.trans_id: r.event_type for r in classify(e, **kw).select("trans_id", "event_type").collect()}


def hop(gap_seconds, second_terminal="T2", second_card="C1"):
    base = "2024-01-05 10:00:00"
    from datetime import datetime
    t2 = (datetime.fromisoformat(base) + timedelta(seconds=gap_seconds)).isoformat(sep=" ")
    return [("a", base, "C1", "DEPOSIT", 10, "SUCCESS", "T1"),
            ("b", t2, second_card, "DEPOSIT", 10, "SUCCESS", second_terminal)]


@pytest.mark.parametrize("gap,expected", [(3599, "3"), (3600, None)])
def test_city_hop_strictly_under_one_hour(spark, gap, expected):
    assert classes(spark, tables(spark, hop(gap)))["b"] == expected


def test_same_city_is_no_hop(spark):
    assert classes(spark, tables(spark, hop(300, second_terminal="T3")))["b"] is None


def test_city_hop_over_two_cards(spark):
    assert classes(spark, tables(spark, hop(600, second_card="C2")))["b"] == "3"


def probe(last_offset_seconds=1200, amounts=(500, 400, 300, 200), types=("PAYMENT",) * 4,
          results=("REJECT", "REJECT", "REJECT", "SUCCESS")):
    from datetime import datetime
    t0 = datetime(2024, 1, 5, 12, 0, 0)
    offsets = [0, 60, 120, last_offset_seconds]
    return [(f"p{i}", (t0 + timedelta(seconds=o)).isoformat(sep=" "), "C1", ty, a, r, "T1")
            for i, (o, a, ty, r) in enumerate(zip(offsets, amounts, types, results))]


@pytest.mark.parametrize("span,expected", [(1200, "4"), (1201, None)])
def test_probe_at_most_twenty_minutes(spark, span, expected):
    assert classes(spark, tables(spark, probe(span)))["p3"] == expected


def test_probe_equal_amounts(spark):
    assert classes(spark, tables(spark, probe(amounts=(500, 400, 400, 200))))["p3"] is None


def test_probe_deposit_never_fires(spark):
    assert classes(spark, tables(spark, probe(types=("DEPOSIT",) * 4)))["p3"] is None


def test_probe_with_other_type_in_between(spark):
    rows = probe()
    rows.insert(2, ("w", "2024-01-05 12:01:30", "C1", "WITHDRAW", 999, "SUCCESS", "T1"))
    assert classes(spark, tables(spark, rows))["p3"] == "4"


def expiring(trans_time, valid_to=date(2024, 1, 5)):
    client = [("1", "Ivanov", "Ivan", "I", date(1980, 1, 1), "P1", valid_to, "+71")]
    return [("x", trans_time, "C1", "DEPOSIT", 10, "SUCCESS", "T1")], client


@pytest.mark.parametrize("when,expected", [("2024-01-05 00:00:01", "1"), ("2024-01-05 00:00:00", None)])
def test_passport_expiring_that_day(spark, when, expected):
    rows, client = expiring(when)
    assert classes(spark, tables(spark, rows, clients=client))["x"] == expected


def test_no_passport_end_is_not_rule_one(spark):
    rows, client = expiring("2024-01-05 00:00:01", valid_to=None)
    assert classes(spark, tables(spark, rows, clients=client))["x"] is None


def test_blacklisted_passport(spark):
    rows, _ = expiring("2024-01-05 00:00:01")
    assert classes(spark, tables(spark, rows, blacklist=("P1",)))["x"] == "1"


def test_expired_contract(spark):
    rows, _ = expiring("2024-01-05 00:00:01")
    t = tables(spark, rows, accounts=[("A1", date(2024, 1, 4), "1")])
    assert classes(spark, t)["x"] == "2"


def test_priority_passport_over_city_hop(spark):
    client = [("1", "Ivanov", "Ivan", "I", date(1980, 1, 1), "P1", date(2024, 1, 1), "+71")]
    assert classes(spark, tables(spark, hop(600), clients=client))["b"] == "1"


def test_null_patronymic_makes_null_name(spark):
    client = [("1", "Ivanov", "Ivan", None, date(1980, 1, 1), "P1", date(2024, 1, 1), "+71")]
    rows = fraud_mart(tables(spark, hop(600), clients=client), "2024-02-01").collect()
    assert rows and all(r.fio is None for r in rows)


def test_full_name_and_report_columns(spark):
    client = [("1", "Ivanov", "Ivan", "I", date(1980, 1, 1), "P1", date(2024, 1, 1), "+71")]
    r = fraud_mart(tables(spark, hop(600), clients=client), "2024-02-01").collect()[0]
    assert (r.fio, r.passport, r.phone, r.report_dt) == ("Ivanov Ivan I", "P1", "+71", date(2024, 2, 1))


def test_rerun_same_report_date_adds_nothing(spark):
    client = [("1", "Ivanov", "Ivan", "I", date(1980, 1, 1), "P1", date(2024, 1, 1), "+71")]
    t = tables(spark, hop(600), clients=client)
    first = fraud_mart(t, "2024-02-01")
    assert first.count() == 2
    assert fraud_mart(t, "2024-02-01", existing=first).count() == 0


def test_unknown_card_rows_share_the_null_client_and_repeat(spark):
    rows = [("a", "2024-01-05 10:00:00", "C9", "DEPOSIT", 10, "SUCCESS", "T1"),
            ("b", "2024-01-05 10:10:00", "C8", "DEPOSIT", 10, "SUCCESS", "T2")]
    t = tables(spark, rows)
    assert classes(spark, t)["b"] == "3"  # strangers' lags run across the null partition
    first = fraud_mart(t, "2024-02-01")
    assert first.count() == 1
    assert fraud_mart(t, "2024-02-01", existing=first).count() == 1  # null passport never matches


def test_slices_do_not_change_results(spark):
    """Many tiny time slices give the same classes as one slice per client."""
    rows = hop(600) + probe() + hop(3599, second_card="C2")
    rows = [(f"{i}{r[0]}",) + r[1:] for i, r in enumerate(rows)]
    t = tables(spark, rows)
    wide = classes(spark, t)
    narrow = classes(spark, t, slice_width=timedelta(minutes=7))
    assert wide == narrow and set(wide.values()) >= {"3", "4"}


def test_slices_match_plain_windows_on_testdata(spark):
    from conftest import SF001
    from fraudlane.sources.bank_fixture import bank_tables
    t = bank_tables(spark, SF001)
    e = enrich_transactions(t.fact_transactions, t.dim_cards_hist, t.dim_accounts_hist,
                            t.dim_clients_hist, t.dim_terminals_hist, t.fact_passport_blacklist)
    wide = classify(e, probe_window=timedelta(days=7)).select("trans_id", "event_type")
    narrow = classify(e, probe_window=timedelta(days=7), slice_width=timedelta(hours=6)) \
        .select("trans_id", "event_type")
    assert wide.exceptAll(narrow).count() == 0 and narrow.exceptAll(wide).count() == 0
    counts = {r.event_type: r["count"] for r in narrow.groupBy("event_type").count().collect()}
    assert counts == {"1": 708, "2": 315, "3": 715, "4": 7, None: 8255}


def test_exact_lags_match_window_lag(spark):
    from conftest import SF001
    from fraudlane.operators.lags import exact_lags
    from fraudlane.operators.rules import window_order
    from fraudlane.sources.bank_fixture import bank_tables
    t = bank_tables(spark, SF001)
    e = enrich_transactions(t.fact_transactions, t.dim_cards_hist, t.dim_accounts_hist,
                            t.dim_clients_hist, t.dim_terminals_hist)
    specs = {"d1": ("trans_date", 1), "d3": ("trans_date", 3), "a2": ("amt", 2), "c1": ("terminal_city", 1)}
    # six-hour slices: most clients have under three rows in a slice, so carries chain
    got = exact_lags(e, ["client_id"], window_order(e), specs, "trans_date", width=6 * 3600)
    w = Window.partitionBy("client_id").orderBy(*window_order(e))
    want = e.select("*", *[F.lag(c, k).over(w).alias(o) for o, (c, k) in specs.items()])
    cols = ["trans_id", *specs]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0


def test_as_of_joins_the_version_in_effect(spark):
    """Card known from 01-01, its account only from 01-05, the client moves on 01-07; a
    same-day change (version ended before it started) never matches."""
    from datetime import datetime as dt
    from fraudlane.schemas import ACCOUNTS, CARDS, CLIENTS, FACT_TRANSACTIONS, TERMINALS
    end = dt(9999, 12, 31)
    fact = spark.createDataFrame(
        [(f"t{d}", dt(2024, 1, d, 12), "C1", "DEPOSIT", None, "SUCCESS", "T1") for d in (3, 6, 8)],
        FACT_TRANSACTIONS)
    cards = spark.createDataFrame([("C1", "A1", dt(2024, 1, 1), end, "N")], CARDS.history_schema())
    accounts = spark.createDataFrame([("A1", date(2030, 1, 1), "1", dt(2024, 1, 5), end, "N")],
                                     ACCOUNTS.history_schema())
    clients = spark.createDataFrame(
        [("1", "Old", "X", "P", "P1", None, "+1", None, dt(2024, 1, 1), dt(2024, 1, 6), "N"),
         ("1", "Gone", "X", "P", "P1", None, "+1", None, dt(2024, 1, 7), dt(2024, 1, 6), "N"),
         ("1", "New", "X", "P", "P1", None, "+1", None, dt(2024, 1, 7), end, "N")],
        CLIENTS.history_schema())
    terminals = spark.createDataFrame([("T1", "POS", "Moscow", "a", dt(2024, 1, 1), end, "N")],
                                      TERMINALS.history_schema())
    e = enrich_transactions(fact, cards, accounts, clients, terminals, versions="as_of")
    got = {r.trans_id: (r.card_num_dim, r.client_id, r.last_name) for r in e.collect()}
    assert got == {"t3": ("C1", None, None), "t6": ("C1", "1", "Old"), "t8": ("C1", "1", "New")}


def test_duplicate_fact_rows_are_flagged_together(spark):
    """The second copy's own lag is its twin (same city), yet IN-semantics flag both."""
    rows = hop(600)
    rows.append(rows[1])
    t = tables(spark, rows)
    e = enrich_transactions(t.fact_transactions, t.dim_cards_hist, t.dim_accounts_hist,
                            t.dim_clients_hist, t.dim_terminals_hist, t.fact_passport_blacklist)
    got = [r.event_type for r in classify(e).where("trans_id = 'b'").collect()]
    assert got == ["3", "3"]


@pytest.mark.parametrize("versions", ["all", "current", "as_of"])
def test_an_id_that_repeats_days_later_is_flagged_with_its_first_copy(spark, versions):
    rows = hop(600)
    late = list(rows[1])
    late[1] = "2024-01-25" + rows[1][1][10:]
    t = tables(spark, rows + [tuple(late)])
    got = fraud_mart(t, "2024-02-01", None, versions=versions).collect()
    assert len(got) == 2 and {r.event_type for r in got} == {"3"}


def test_fanout_class_sizes_match_fixtures(spark):
    """FIXTURES §3.1, both extra versions at sf0.01: rows / distinct transactions per class."""
    from conftest import SF001
    from fraudlane.sources.bank_fixture import bank_tables, with_extra_versions
    t = with_extra_versions(bank_tables(spark, SF001))
    e = enrich_transactions(t.fact_transactions, t.dim_cards_hist, t.dim_accounts_hist,
                            t.dim_clients_hist, t.dim_terminals_hist, t.fact_passport_blacklist)
    c = classify(e, probe_window=timedelta(days=7))
    got = {r.event_type: (r.rows, r.ids) for r in
           c.groupBy("event_type").agg(F.count("*").alias("rows"),
                                       F.countDistinct("trans_id").alias("ids")).collect()}
    assert got == {"1": (881, 708), "2": (394, 315), "3": (2837, 1550), "4": (5, 5), None: (8489, 7422)}


def test_null_card_rows_join_nothing_and_are_spread(spark):
    rows = [("a", "2024-01-05 10:00:00", None, "DEPOSIT", 10, "SUCCESS", "T1"),
            ("b", "2024-01-05 10:05:00", None, "DEPOSIT", 10, "SUCCESS", "T2")]
    t = tables(spark, rows)
    e = enrich_transactions(t.fact_transactions, t.dim_cards_hist, t.dim_accounts_hist,
                            t.dim_clients_hist, t.dim_terminals_hist, t.fact_passport_blacklist)
    assert not any(c.startswith("_") for c in e.columns)
    got = sorted((r.trans_id, r.client_id, r.terminal_city) for r in e.collect())
    assert got == [("a", None, "Moscow"), ("b", None, "Kazan")]
    assert classes(spark, t)["b"] == "3"  # both land in the null client's window


def test_null_spread_stays_in_the_exchange_keys(spark):
    """A constant spread on one side would be folded away by the optimizer."""
    from conftest import SF0001
    from fraudlane.sources.bank_fixture import bank_tables
    t = bank_tables(spark, SF0001)
    e = enrich_transactions(t.fact_transactions, t.dim_cards_hist, t.dim_accounts_hist,
                            t.dim_clients_hist, t.dim_terminals_hist)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = e._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    card_exchanges = [ln for ln in plan.splitlines() if "hashpartitioning(trim(card_num" in ln]
    assert card_exchanges and all("_null_spread" in ln for ln in card_exchanges)


def test_rows_without_a_time_are_kept_and_ordered_last(spark):
    from datetime import datetime as dt
    from fraudlane.operators.lags import exact_lags
    from fraudlane.operators.rules import window_order
    from fraudlane.schemas import FACT_TRANSACTIONS
    rows = hop(600)
    t = tables(spark, rows)
    fact = t.fact_transactions.unionByName(spark.createDataFrame(
        [("z", None, "C1", "DEPOSIT", None, "SUCCESS", "T2")], FACT_TRANSACTIONS))
    e = enrich_transactions(fact, t.dim_cards_hist, t.dim_accounts_hist, t.dim_clients_hist,
                            t.dim_terminals_hist, t.fact_passport_blacklist)
    got = {r.trans_id: r.event_type for r in classify(e).select("trans_id", "event_type").collect()}
    assert got == {"a": None, "b": "3", "z": None}
    lags = exact_lags(e, ["client_id"], window_order(e), {"prev": ("trans_date", 1)}, "trans_date",
                      width=60)
    prev = {r.trans_id: r.prev for r in lags.collect()}
    assert prev == {"a": None, "b": dt(2024, 1, 5, 10, 0), "z": dt(2024, 1, 5, 10, 10)}
