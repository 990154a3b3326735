"""The suspicious-operations report and its incremental append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import SPREAD, null_spread
from ..functions.text import full_name
from ..schemas import EVENT_TYPES, REPORT
from .enrich import enrich_transactions
from .lags import seconds_of
from .rules import CITY_HOP, PROBE, classify


def report_dt_col(report_dt=None):
    return F.current_date() if report_dt is None else F.lit(str(report_dt)).cast("date")


def report_rows(classified: DataFrame, report_dt=None) -> DataFrame:
    """Project classified rows to the report's six columns, keeping classes '1'..'4'."""
    return classified.where(F.col("event_type").isin(*EVENT_TYPES)).select(
        F.col("trans_date").alias("event_dt"),
        F.col("passport_num").alias("passport"),
        full_name().alias("fio"),
        "phone",
        "event_type",
        report_dt_col(report_dt).alias("report_dt"),
    )


def not_yet_reported(rows: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows whose (passport, report_dt, event_dt) is not in the report yet.

    A null passport never matches, so such rows are appended on every run; duplicates
    inside one batch are kept (both as in the source system).
    """
    if existing is None:
        return rows
    on = ["passport", "report_dt", "event_dt"]
    keys = existing.select(*on, null_spread(on, ["fio", "phone", "event_type"]))
    # rows without a passport (e.g. every row of the unknown-card client) cannot match:
    # scatter them instead of sending them all to the null key's task
    spread = rows.select("*", null_spread(on, ["event_dt", "fio", "phone", "event_type"]))
    return spread.join(keys, on + [SPREAD], "left_anti").select(*REPORT.names)


def fraud_mart(tables, report_dt=None, existing: DataFrame | None = None, versions: str = "all",
               city_window=CITY_HOP, probe_window=PROBE, slice_width=None, since=None,
               require_client: bool = False) -> DataFrame:
    """The whole report step: enrich once, two lag windows on one shuffle, classify, and
    keep the rows not reported yet. ``tables`` carries the facts and history tables.

    ``versions='all'`` (the source system's report) joins every dimension version;
    ``'current'`` joins open versions only and ``'as_of'`` those in effect.

    ``since`` (a timestamp) reports only transactions from then on, judged by the facts from
    ``since - horizon`` on, which is as far as the rules look back; the filter reaches the fact
    scan. It is narrower than the whole report in one point: where an id repeats, a match of an older copy,
    before ``since - horizon``, is not read and flags nothing. Without ``since`` every run re-reads all history,
    as the source system does (Q4). ``require_client`` leaves out transactions of unknown cards, which share the
    null client's windows (Q3)."""
    fact = tables.fact_transactions
    if since is not None:
        horizon = max(seconds_of(city_window), seconds_of(probe_window))
        start = F.lit(str(since)).cast("timestamp_ntz")
        fact = fact.where(F.col("trans_date") >= start - F.make_dt_interval(secs=F.lit(horizon)))
    enriched = enrich_transactions(
        fact, tables.dim_cards_hist, tables.dim_accounts_hist,
        tables.dim_clients_hist, tables.dim_terminals_hist, tables.fact_passport_blacklist,
        versions=versions)
    if require_client:
        enriched = enriched.where(F.col("client_id").isNotNull())
    classified = classify(enriched, city_window, probe_window, slice_width)
    if since is not None:
        classified = classified.where(F.col("trans_date") >= start)
        if existing is not None:
            existing = existing.where(F.col("event_dt") >= start)
    return not_yet_reported(report_rows(classified, report_dt), existing)
