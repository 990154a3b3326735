"""Registered queries: each takes ``(spark, sf_dir)``, derives the bank tables from the
testdata in ``sf_dir`` and returns one operator's result as a DataFrame.

Parameters shared with the SQL oracles (``oracle_queries.py``): report date 2024-02-01,
rule 4 window seven days (FIXTURES §3), morning cut-off 2024-01-08 for the incremental run.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import full_name
from ..operators.enrich import enrich_transactions
from ..operators.lags import exact_lags
from ..operators.report import fraud_mart, report_rows
from ..operators.rules import (amount_probe_rule, city_hop_rule, classify, contract_rule,
                               passport_rule, window_order, with_rule_lags)
from ..schemas import ts_lit
from ..sources.bank_fixture import BankTables, bank_tables, with_extra_versions

REPORT_DT = "2024-02-01"
PROBE_WINDOW = timedelta(days=7)
MORNING_CUTOFF = "2024-01-08 00:00:00"
SINCE = "2024-01-10 00:00:00"

QUERIES: dict = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _enriched(t: BankTables, versions: str = "all") -> DataFrame:
    return enrich_transactions(t.fact_transactions, t.dim_cards_hist, t.dim_accounts_hist,
                               t.dim_clients_hist, t.dim_terminals_hist,
                               t.fact_passport_blacklist, versions=versions)


def _classified(spark, sf_dir, tables=None) -> DataFrame:
    t = tables or bank_tables(spark, sf_dir)
    return classify(_enriched(t), probe_window=PROBE_WINDOW)


@register("fraud_mart")
def q_fraud_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report step on an empty report (first run of the day)."""
    t = bank_tables(spark, sf_dir)
    existing = spark.createDataFrame([], "event_dt timestamp_ntz, passport string, fio string, "
                                         "phone string, event_type string, report_dt date")
    return fraud_mart(t, REPORT_DT, existing, probe_window=PROBE_WINDOW)


@register("fraud_mart_current")
def q_fraud_mart_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 over current versions only (history with extra versions, FIXTURES §3.1): the
    evident intent of the report, and the plan without a ``trans_id`` shuffle."""
    t = with_extra_versions(bank_tables(spark, sf_dir))
    return fraud_mart(t, REPORT_DT, None, versions="current", probe_window=PROBE_WINDOW)


@register("fraud_mart_as_of")
def q_fraud_mart_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 joining each transaction to the versions valid at its time (Q1 'as_of'):
    T3 is in its old city before 2024-01-05 and ELSEWHERE after."""
    t = with_extra_versions(bank_tables(spark, sf_dir))
    return fraud_mart(t, REPORT_DT, None, versions="as_of", probe_window=PROBE_WINDOW)


@register("fraud_mart_since")
def q_fraud_mart_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 for transactions from 2024-01-10 on, reading facts only from one rule horizon
    earlier (the daily run's incremental report)."""
    t = bank_tables(spark, sf_dir)
    return fraud_mart(t, REPORT_DT, None, probe_window=PROBE_WINDOW, since=SINCE)


@register("fraud_mart_repeated_ids")
def q_fraud_mart_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 on a fact whose ids aren't unique (FIXTURES §3.2): every fortieth id again, eleven days later at another
    terminal. A rule that flags one copy flags the other."""
    t = with_extra_versions(bank_tables(spark, sf_dir))
    fact = t.fact_transactions
    number = F.substring("trans_id", 3, 20).cast("long")
    again = fact.where(number % 40 == 0).withColumn("trans_date", F.col("trans_date") + F.expr("INTERVAL 11 DAY"))
    again = again.withColumn("terminal", F.concat(F.lit("T"), ((number * 7 + 1) % 10).cast("string")))
    return fraud_mart(replace(t, fact_transactions=fact.unionByName(again)), REPORT_DT, None, versions="current", probe_window=PROBE_WINDOW)


@register("report_incremental")
def q_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rerun on the same report date after a morning run that saw the transactions
    before the cut-off; only rows not reported in the morning are appended."""
    t = bank_tables(spark, sf_dir)
    morning = BankTables(t.fact_transactions.where(F.col("trans_date") < ts_lit(MORNING_CUTOFF)),
                         t.fact_passport_blacklist, t.dim_terminals_hist, t.dim_cards_hist,
                         t.dim_accounts_hist, t.dim_clients_hist)
    existing = fraud_mart(morning, REPORT_DT, None, probe_window=PROBE_WINDOW)
    return fraud_mart(t, REPORT_DT, existing, probe_window=PROBE_WINDOW)


@register("fraud_report")
def q_fraud_report(spark, sf_dir):
    """Report rows before the dedupe against the existing report."""
    return report_rows(_classified(spark, sf_dir), REPORT_DT)


@register("fraud_classify")
def q_fraud_classify(spark, sf_dir):
    """Priority classification of every transaction."""
    return _classified(spark, sf_dir).select("trans_id", "event_type")


@register("fraud_classify_all_versions")
def q_fraud_classify_all_versions(spark, sf_dir):
    """Q1 parity: every dimension version joined; flags spread over all copies."""
    t = with_extra_versions(bank_tables(spark, sf_dir))
    return _classified(spark, sf_dir, t).select("trans_id", "client_id", "terminal_city", "event_type")


@register("full_name")
def q_full_name(spark, sf_dir):
    """null-propagating full name."""
    return bank_tables(spark, sf_dir).dim_clients_hist.select("client_id", full_name().alias("fio"))


def _rule_rows(spark, sf_dir) -> DataFrame:
    t = bank_tables(spark, sf_dir)
    return with_rule_lags(_enriched(t), probe_window=PROBE_WINDOW)


@register("rule1_passport")
def q_rule1(spark, sf_dir):
    """R1 alone: expired or blacklisted passport."""
    e = _enriched(bank_tables(spark, sf_dir))
    return e.where(passport_rule()).select("trans_id", "trans_date", "passport_num", "passport_valid_to")


@register("rule2_contract")
def q_rule2(spark, sf_dir):
    """R2 alone: expired account contract."""
    e = _enriched(bank_tables(spark, sf_dir))
    return e.where(contract_rule()).select("trans_id", "trans_date", "valid_to")


@register("rule3_city_hop")
def q_rule3(spark, sf_dir):
    """R3 alone: a different city less than an hour after the client's previous transaction."""
    return _rule_rows(spark, sf_dir).where(city_hop_rule()).select(
        "trans_id", "trans_date", "terminal_city", "prev_city", "prev_time")


@register("rule4_amount_probe")
def q_rule4(spark, sf_dir):
    """R4 alone: falling-amount probing ending in a success (seven-day window on testdata)."""
    return _rule_rows(spark, sf_dir).where(amount_probe_rule(PROBE_WINDOW)).select(
        "trans_id", "trans_date", "card_num", "oper_type", "amt")


ENRICHED_COLUMNS = ("trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result",
                    "terminal", "card_num_dim", "client_id", "valid_to", "last_name",
                    "first_name", "patronymic", "passport_num", "passport_valid_to", "phone",
                    "terminal_city")


@register("enrich_transactions")
def q_enrich(spark, sf_dir):
    """The join chain, dimensions pre-joined, fact joined once."""
    return _enriched(bank_tables(spark, sf_dir)).select(*ENRICHED_COLUMNS)


@register("enrich_transactions_all_versions")
def q_enrich_all_versions(spark, sf_dir):
    """J7 with history (Q1): a transaction fans out over every matching version."""
    t = with_extra_versions(bank_tables(spark, sf_dir))
    return _enriched(t).select("trans_id", "trans_date", "card_num_dim", "client_id",
                               "passport_num", "terminal_city")


@register("enrich_transactions_as_of")
def q_enrich_as_of(spark, sf_dir):
    """J7 as an as-of join: one row per transaction, the versions in effect at its time."""
    t = with_extra_versions(bank_tables(spark, sf_dir))
    return _enriched(t, "as_of").select(*ENRICHED_COLUMNS)


@register("lag_client")
def q_lag_client(spark, sf_dir):
    """Previous date and city per client (unbounded lag, time-sliced)."""
    e = _enriched(bank_tables(spark, sf_dir))
    out = exact_lags(e, ["client_id"], window_order(e),
                     {"prev_time": ("trans_date", 1), "prev_city": ("terminal_city", 1)},
                     "trans_date")
    return out.select("trans_id", "prev_time", "prev_city")


@register("lag_card_type")
def q_lag_card_type(spark, sf_dir):
    """Lags 1-3 of date, type, amount and result per client, card and type."""
    e = _enriched(bank_tables(spark, sf_dir))
    specs = {}
    for k in (1, 2, 3):
        specs[f"time_back_{k}"] = ("trans_date", k)
        specs[f"type_back_{k}"] = ("oper_type", k)
        specs[f"amt_back_{k}"] = ("amt", k)
        specs[f"result_back_{k}"] = ("oper_result", k)
    out = exact_lags(e, ["client_id", "card_num_dim", "oper_type"], window_order(e), specs, "trans_date")
    return out.select("trans_id", *specs)
