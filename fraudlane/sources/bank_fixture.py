"""Bank-shaped tables derived from the given testdata tables.

The source system has no published inputs, so the mart is exercised on tables Spark derives
from ``events``, ``customer``, ``supplier`` and ``nation``: every row of those tables flows
in, so the work grows with the scale factor. The derivation rules are fixed values shared
with the SQL oracle (``oracle_queries.py``); see ``FIXTURES.md``.
"""

from __future__ import annotations

import weakref
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (ACCOUNTS, CARDS, CLIENTS, FLAG_LIVE, TERMINALS, DimSpec, date_lit,
                       open_end, ts_lit)

# ---------------------------------------------------------------------------
# Fixed values of the derivation (FIXTURES.md §3 and §4).
# ---------------------------------------------------------------------------
VERSION_START = "2024-01-01 00:00:00"  # effective_from of the single-version dimensions
BLACKLIST_ENTRY = "2024-01-01"
REPLAY_DAYS = {
    # day: (business date, load timestamp)
    1: ("2024-01-01", "2024-01-02 02:00:00"),
    2: ("2024-01-10", "2024-01-11 02:00:00"),
    3: ("2024-01-20", "2024-01-21 02:00:00"),
}
REPLAY_CREATE = "2024-01-01 00:00:00"
REPLAY_LATE_CREATE = "2024-01-09 00:00:00"
REPLAY_DAY2_UPDATE = "2024-01-10 00:00:00"
REPLAY_DAY3_UPDATE = "2024-01-20 00:00:00"
# ---------------------------------------------------------------------------


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


_SCANS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One scan DataFrame per session and table: the file listing and footer read happen
    once, and every derived table reuses the same relation (Catalyst still prunes columns
    and pushes filters per use)."""
    scans = _SCANS.setdefault(spark, {})
    path = f"{sf_dir}/{name}.parquet"
    if path not in scans:
        scans[path] = spark.read.parquet(path)
    return scans[path]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fact_transactions`` rows, one per event."""
    ev = _read(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select(
        F.concat(F.lit("TR"), _s(eid)).alias("trans_id"),
        F.col("ts").alias("trans_date"),
        F.concat(F.lit("C"), _s(F.col("user_id") * 2 + eid % 2)).alias("card_num"),
        F.when(eid % 3 == 0, "PAYMENT").when(eid % 3 == 1, "WITHDRAW")
         .otherwise("DEPOSIT").alias("oper_type"),
        F.col("value").cast(T.DecimalType(7, 2)).alias("amt"),
        F.when(F.col("event_type").isin("click", "purchase"), "SUCCESS")
         .otherwise("REJECT").alias("oper_result"),
        F.concat(F.lit("T"), _s((eid * 7) % 10)).alias("terminal"),
    )


def transactions_text(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """The same transactions as the daily text file carries them: all strings, decimal
    comma, and the event time with its microseconds (the load rounds it to seconds); those
    before the day ``until``, if given."""
    tr = transactions(spark, sf_dir)
    if until is not None:
        tr = tr.where(F.col("trans_date") < ts_lit(f"{until} 00:00:00"))
    return tr.select(
        "trans_id",
        F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("trans_date"),
        F.regexp_replace(_s("amt"), r"\.", ",").alias("amt"),
        "card_num", "oper_type", "oper_result", "terminal",
    )


def _scd(df: DataFrame, start: str = VERSION_START) -> DataFrame:
    return df.select("*", ts_lit(start).alias("effective_from"), open_end().alias("effective_to"),
                     F.lit(FLAG_LIVE).alias("deleted_flg"))


def _terminal_type(k: Column) -> Column:
    return F.when(k % 3 == 0, "POS").when(k % 3 == 1, "ATM").otherwise("ECOM")


def terminals_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _read(spark, sf_dir, "supplier")
    nat = _read(spark, sf_dir, "nation")
    return sup.join(nat, sup.s_nationkey == nat.n_nationkey, "left").select(
        F.concat(F.lit("T"), _s("s_suppkey")).alias("terminal_id"),
        _terminal_type(F.col("s_suppkey")).alias("terminal_type"),
        F.col("n_name").alias("terminal_city"),
        F.col("s_name").alias("terminal_address"),
    )


def cards_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cards per customer, padded with trailing spaces like the source system's."""
    k = F.col("c_custkey")
    cust = _read(spark, sf_dir, "customer")
    return cust.select(
        F.explode(F.array(F.concat(F.lit("C"), _s(k * 2), F.lit("  ")),
                          F.concat(F.lit("C"), _s(k * 2 + 1), F.lit(" ")))).alias("card_num"),
        F.concat(F.lit("A"), _s(k)).alias("account_num"),
    )


def accounts_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), _s(k)).alias("account_num"),
        F.when(k % 10 == 0, date_lit("2024-01-20")).otherwise(date_lit("2029-12-31")).alias("valid_to"),
        _s(k).alias("client"),
    )


def _passport_valid_to(k: Column) -> Column:
    return (F.when(k % 5 == 0, F.lit(None).cast("date"))
            .when(k % 13 == 0, date_lit("2024-01-15"))
            .otherwise(date_lit("2030-01-01")))


def _date_of_birth(k: Column) -> Column:
    return F.date_add(date_lit("1960-01-01"), (k % 15000).cast("int"))


def clients_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").select(
        _s(k).alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.lit("P")).alias("patronymic"),
        _date_of_birth(k).alias("date_of_birth"),
        F.concat(F.lit("PN"), _s(k)).alias("passport_num"),
        _passport_valid_to(k).alias("passport_valid_to"),
        F.concat(F.lit("+7"), _s(k)).alias("phone"),
    )


def blacklist_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").where(k % 29 == 3).select(
        F.concat(F.lit("PN"), _s(k)).alias("passport_num"),
        date_lit(BLACKLIST_ENTRY).alias("entry_dt"),
    )


def terminals_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terminals sheet as it arrives: text padded with spaces around every field."""
    t = terminals_rows(spark, sf_dir)
    return t.select(*[F.concat(F.lit("  "), F.col(c), F.lit(" ")).alias(c) for c in t.columns])


def blacklist_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blacklist sheet: every listed passport, entry date spread over January 2024."""
    k = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").where(k % 29 == 3).select(
        F.date_format(F.date_add(date_lit(BLACKLIST_ENTRY), (k % 20).cast("int")), "yyyy-MM-dd")
         .alias("entry_dt"),
        F.concat(F.lit("PN"), _s(k)).alias("passport_num"),
    )


@dataclass
class BankTables:
    fact_transactions: DataFrame
    fact_passport_blacklist: DataFrame
    dim_terminals_hist: DataFrame
    dim_cards_hist: DataFrame
    dim_accounts_hist: DataFrame
    dim_clients_hist: DataFrame


_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def bank_tables(spark: SparkSession, sf_dir: str) -> BankTables:
    """Facts and single-version SCD2 dimensions for the fraud mart (built once per session
    and scale; DataFrames are immutable plans, so sharing them is safe)."""
    cache = _TABLES.setdefault(spark, {})
    if sf_dir not in cache:
        cache[sf_dir] = _bank_tables(spark, sf_dir)
    return cache[sf_dir]


def _bank_tables(spark: SparkSession, sf_dir: str) -> BankTables:
    return BankTables(
        fact_transactions=transactions(spark, sf_dir),
        fact_passport_blacklist=blacklist_rows(spark, sf_dir),
        dim_terminals_hist=_scd(terminals_rows(spark, sf_dir)),
        dim_cards_hist=_scd(cards_rows(spark, sf_dir)),
        dim_accounts_hist=_scd(accounts_rows(spark, sf_dir)),
        dim_clients_hist=_scd(clients_rows(spark, sf_dir)),
    )


def with_extra_versions(tables: BankTables, clients: bool = True, terminal: bool = True) -> BankTables:
    """FIXTURES §3.1: a second version of clients with ``k % 7 = 1`` (same attributes) and of
    terminal ``T3`` in city ``ELSEWHERE``; both start on 2024-01-05 and the first versions
    end the day before."""
    start, end_before = "2024-01-05 00:00:00", "2024-01-04 00:00:00"
    cl, tm = tables.dim_clients_hist, tables.dim_terminals_hist

    def split(df, moved):
        old = df.withColumn("effective_to", F.when(moved, ts_lit(end_before)).otherwise(F.col("effective_to")))
        return old, df.where(moved).drop("effective_from", "effective_to", "deleted_flg")

    if clients:
        cl, extra = split(cl, F.col("client_id").cast("bigint") % 7 == 1)
        cl = cl.unionByName(_scd(extra, start))
    if terminal:
        tm, extra = split(tm, F.col("terminal_id") == "T3")
        tm = tm.unionByName(_scd(extra.withColumn("terminal_city", F.lit("ELSEWHERE")), start))
    return BankTables(tables.fact_transactions, tables.fact_passport_blacklist, tm,
                      tables.dim_cards_hist, tables.dim_accounts_hist, cl)


# ---------------------------------------------------------------------------
# SCD2 three-day replay (FIXTURES §4): the source system's state on each day.
# ---------------------------------------------------------------------------

def _present(k: Column, day: int) -> Column:
    if day == 1:
        return k % 11 != 5
    if day == 2:
        return k % 13 != 4
    return (k % 13 != 4) | (k % 26 == 4)


def _returned(k: Column, day: int) -> Column:
    return (k % 26 == 4) if day == 3 else F.lit(False)


def _changed(k: Column, day: int) -> Column:
    """Rows whose tracked attribute moved on day 2 (and stays moved)."""
    return (k % 7 == 1) & F.lit(day >= 2) & ~_returned(k, day)


def _create_dt(k: Column, day: int) -> Column:
    if day == 1:
        return ts_lit(REPLAY_CREATE)
    return F.when(k % 11 == 5, ts_lit(REPLAY_LATE_CREATE)).otherwise(ts_lit(REPLAY_CREATE))


def _update_dt(k: Column, day: int, extra_touch: Column | None = None) -> Column:
    none = F.lit(None).cast(T.TimestampNTZType())
    if day == 1:
        return none
    touched = (k % 7 == 1) & (k % 11 != 5)
    if extra_touch is not None:
        touched = touched | extra_touch
    upd = F.when(touched, ts_lit(REPLAY_DAY2_UPDATE)).otherwise(none)
    if day == 3:
        upd = F.when(_returned(k, day), ts_lit(REPLAY_DAY3_UPDATE)).otherwise(upd)
    return upd


def replay_source(spark: SparkSession, sf_dir: str, dim: str, day: int) -> DataFrame:
    """Source-system table of ``dim`` on replay ``day``.

    ``generic`` is the one-attribute-pair dimension FIXTURES §4 counts (segment, phone);
    ``terminals`` is the daily sheet (all rows, stamped with the file date);
    the other three are the source tables ``cards`` / ``accounts`` / ``clients``.
    """
    if dim == "terminals":
        k = F.col("s_suppkey")
        sup = _read(spark, sf_dir, "supplier")
        nat = _read(spark, sf_dir, "nation")
        base = sup.join(nat, sup.s_nationkey == nat.n_nationkey, "left")
        return base.where(_present(k, day)).select(
            F.concat(F.lit("T"), _s(k)).alias("terminal_id"),
            _terminal_type(k).alias("terminal_type"),
            F.when(_changed(k, day), F.concat(F.lit("MOVED_"), F.col("n_name")))
             .otherwise(F.col("n_name")).alias("terminal_city"),
            F.col("s_name").alias("terminal_address"),
        )
    k = F.col("c_custkey")
    cust = _read(spark, sf_dir, "customer").where(_present(k, day))
    chg = _changed(k, day)
    phone = F.when(chg, F.concat(F.lit("+8"), _s(k))).otherwise(F.concat(F.lit("+7"), _s(k)))
    stamps = [_create_dt(k, day).alias("create_dt"), _update_dt(k, day).alias("update_dt")]
    if dim == "generic":
        return cust.select(_s(k).alias("client_id"), F.col("c_mktsegment").alias("segment"),
                           phone.alias("phone"), *stamps)
    if dim == "cards":
        return cust.select(
            F.concat(F.lit("C"), _s(k * 2)).alias("card_num"),
            F.when(chg, F.concat(F.lit("A"), _s(k + 1))).otherwise(F.concat(F.lit("A"), _s(k)))
             .alias("account"),
            *stamps)
    if dim == "accounts":
        return cust.select(
            F.concat(F.lit("A"), _s(k)).alias("account"),
            F.when(chg, date_lit("2031-12-31"))
             .when(k % 10 == 0, date_lit("2024-01-20")).otherwise(date_lit("2029-12-31")).alias("valid_to"),
            F.when(chg & (k % 14 == 1), F.lit(None).cast("string")).otherwise(_s(k)).alias("client"),
            *stamps)
    if dim == "clients":
        dob_moved = (k % 7 == 2) & (k % 11 != 5) & F.lit(day >= 2) & ~_returned(k, day)
        return cust.select(
            _s(k).alias("client_id"),
            F.col("c_name").alias("last_name"),
            F.col("c_mktsegment").alias("first_name"),
            F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.lit("P")).alias("patronymic"),
            F.when(dob_moved, F.date_add(_date_of_birth(k), 1)).otherwise(_date_of_birth(k))
             .alias("date_of_birth"),
            F.concat(F.lit("PN"), _s(k)).alias("passport_num"),
            _passport_valid_to(k).alias("passport_valid_to"),
            phone.alias("phone"),
            _create_dt(k, day).alias("create_dt"),
            _update_dt(k, day, extra_touch=dob_moved).alias("update_dt"),
        )
    raise ValueError(f"unknown dimension {dim!r}")


GENERIC = DimSpec("generic", "client_id", tracked=("segment", "phone"))
REPLAY_SPECS = {"generic": GENERIC, "terminals": TERMINALS, "cards": CARDS,
                "accounts": ACCOUNTS, "clients": CLIENTS}
