"""Fact loads, drop files, file-stream ingestion with archiving, and the daily pipeline."""

import os
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from fraudlane.functions.parsing import business_date_from_name, parse_amount, parse_trans_date
from fraudlane.operators.facts import new_blacklist, new_transactions
from fraudlane.operators.watermark import advance_mark, empty_meta, read_mark, seed_marks
from fraudlane.plans.commits import Conflict, Fenced
from fraudlane.plans.daily import DayDrop, Warehouse, run_day
from fraudlane.plans.replay import replay
from fraudlane.plans.stream_queries import write_drops
from fraudlane.schemas import FACT_TRANSACTIONS
from fraudlane.sources.bank_fixture import (REPLAY_DAYS, blacklist_sheet, replay_source,
                                            transactions, transactions_text)
from fraudlane.sources.extracts import jdbc_options, read_source_table
from fraudlane.sources.files import read_terminal_keys, read_terminals, read_transactions, stage_terminals
from fraudlane.streaming.drop_ingest import ingest_drops


def test_amount_and_timestamp_parsing(spark):
    df = spark.createDataFrame([("12,34", "2024-01-05 10:00:00.4"), ("12,345", "2024-01-05 10:00:59.5")],
                               "a string, t string")
    got = df.select(parse_amount("a").alias("a"), parse_trans_date("t").alias("t")).collect()
    assert [r.a for r in got] == [Decimal("12.34"), Decimal("12.35")]
    assert [r.t for r in got] == [datetime(2024, 1, 5, 10, 0, 0), datetime(2024, 1, 5, 10, 1, 0)]


def test_business_date_from_names(spark):
    df = spark.createDataFrame([("terminals_01032021.xlsx",), ("/x/drop_name=transactions_31122023.txt/part-0.csv",)], "f string")
    assert [r.d for r in df.select(business_date_from_name("f").alias("d")).collect()] == [
        date(2021, 3, 1), date(2023, 12, 31)]


def test_leading_zero_ids_and_padded_sheet(spark, scratch):
    path = os.path.join(scratch, "terminals_10012024.csv")
    with open(path, "w") as f:
        f.write("terminal_id;terminal_type;terminal_city;terminal_address\n  00123 ; POS ;  Kazan ; addr \n")
    staged = stage_terminals(read_terminals(spark, path)).collect()[0]
    assert (staged.terminal_id, staged.terminal_city, staged.update_dt) == ("00123", "Kazan", datetime(2024, 1, 10))
    assert read_terminal_keys(spark, path).collect()[0].terminal_id == "00123"


def test_new_transactions_skip_known_ids_keep_batch_duplicates(spark):
    text = spark.createDataFrame([("1", "2024-01-01 00:00:00", "1,00", "C", "PAYMENT", "SUCCESS", "T"),
                                  ("2", "2024-01-01 00:00:01", "2,00", "C", "PAYMENT", "SUCCESS", "T"),
                                  ("2", "2024-01-01 00:00:01", "2,00", "C", "PAYMENT", "SUCCESS", "T")],
                                 "trans_id string, trans_date string, amt string, card_num string, "
                                 "oper_type string, oper_result string, terminal string")
    fact = spark.createDataFrame([("1", datetime(2024, 1, 1), "C", "PAYMENT", Decimal("1.00"), "SUCCESS", "T")],
                                 FACT_TRANSACTIONS)
    assert sorted(r.trans_id for r in new_transactions(text, fact).collect()) == ["2", "2"]
    assert [r.trans_id for r in new_transactions(text, fact, dedupe=True).collect()] == ["2"]


def test_blacklist_first_entry_stays(spark):
    sheet = blacklist_sheet(spark, SF0001)
    fact = new_blacklist(sheet, spark.createDataFrame([], "passport_num string, entry_dt date"))
    assert new_blacklist(sheet, fact).count() == 0


def test_marks_seed_and_advance(spark):
    meta = seed_marks(empty_meta(spark))
    assert read_mark(meta, "stg_cards") == datetime(1899, 12, 31)
    assert read_mark(meta, "stg_terminals") == datetime(9999, 12, 31)
    assert seed_marks(meta).count() == 4
    staged = spark.createDataFrame([(None, datetime(2024, 1, 3)), (None, None)], "create_dt timestamp_ntz, update_dt timestamp_ntz")
    assert read_mark(seed_marks(empty_meta(spark), stages={"stg_cards": staged}), "stg_cards") == datetime(2024, 1, 3)
    empty = spark.createDataFrame([], "create_dt timestamp_ntz, update_dt timestamp_ntz")
    assert read_mark(advance_mark(meta, "stg_cards", empty), "stg_cards") == datetime(1899, 12, 31)


def test_csv_drop_reads_all_rows(spark, scratch):
    write_drops(spark, SF0001, f"{scratch}/drops")
    rows = read_transactions(spark, f"{scratch}/drops")
    assert rows.count() == transactions(spark, SF0001).count()


def test_stream_ingests_each_file_once_and_archives(spark, scratch):
    drops = f"{scratch}/drops"
    write_drops(spark, SF0001, drops)
    files = [os.path.join(r, f) for r, _, fs in os.walk(drops) for f in fs if f.endswith(".csv")]
    args = (drops, f"{scratch}/staging", f"{scratch}/ck")
    ingest_drops(spark, *args, archive_dir=f"{scratch}/archive", max_files_per_trigger=2)
    ingest_drops(spark, *args, archive_dir=f"{scratch}/archive", max_files_per_trigger=2)
    staged = spark.read.parquet(f"{scratch}/staging")
    assert staged.count() == transactions(spark, SF0001).count()  # nothing read twice
    archived = [f for _, _, fs in os.walk(f"{scratch}/archive") for f in fs if f.startswith("part-")]
    assert len(archived) == len(files)  # those of the last batch too
    assert not [f for _, _, fs in os.walk(drops) for f in fs if f.startswith("part-")]


def test_daily_pipeline_two_days_and_rerun(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    text = transactions_text(spark, SF0001)

    def drop(day, upto):
        bd, load_ts = REPLAY_DAYS[day]
        return DayDrop(
            business_date=bd, load_ts=load_ts, report_dt=bd,
            transactions=text.where(F.col("trans_date") < upto),
            terminals=replay_source(spark, SF0001, "terminals", day),
            blacklist=blacklist_sheet(spark, SF0001),
            cards=replay_source(spark, SF0001, "cards", day),
            accounts=replay_source(spark, SF0001, "accounts", day),
            clients=replay_source(spark, SF0001, "clients", day))

    run_day(wh, 1, drop(1, "2024-01-05"), probe_window=timedelta(days=7))
    run_day(wh, 2, drop(2, "2099-01-01"), probe_window=timedelta(days=7))
    assert wh.published("load") == [1, 2] and wh.published("report") == [1, 2]
    for dim in ("terminals", "cards", "accounts", "clients"):
        want = replay(spark, SF0001, dim, (1, 2))
        got = wh.history(dim)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, dim
    assert wh.fact("fact_transactions").count() == transactions(spark, SF0001).count()
    assert read_mark(wh.meta(), "stg_cards") == datetime(2024, 1, 10)
    before = spark.createDataFrame(wh.report().collect(), wh.report().schema)
    assert before.count() > 0
    run_day(wh, 2, drop(2, "2099-01-01"), probe_window=timedelta(days=7))  # re-run is a no-op
    after = wh.report()
    assert after.exceptAll(before).count() == 0 and before.exceptAll(after).count() == 0
    assert wh.fact("fact_transactions").count() == transactions(spark, SF0001).count()


def test_daily_pipeline_current_versions_since(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    text = transactions_text(spark, SF0001)
    for day in (1, 2):
        bd, load_ts = REPLAY_DAYS[day]
        drop = DayDrop(bd, load_ts, bd, text, replay_source(spark, SF0001, "terminals", day),
                       blacklist_sheet(spark, SF0001), replay_source(spark, SF0001, "cards", day),
                       replay_source(spark, SF0001, "accounts", day), replay_source(spark, SF0001, "clients", day))
        run_day(wh, day, drop, probe_window=timedelta(days=7), versions="current",
                report_since=f"{bd} 00:00:00")
    rep = wh.report()
    assert rep.count() > 0
    assert rep.where(F.col("event_dt") < F.col("report_dt").cast("timestamp_ntz")).count() == 0
    assert wh.open_versions("clients").count() == 138 + 11  # FIXTURES §4 day 2: open N + Y


def test_blacklist_sheet_reader_and_source_contracts(spark, scratch):
    from fraudlane.schemas import SRC_ACCOUNTS, SRC_CARDS, SRC_CLIENTS
    from fraudlane.sources.files import read_blacklist, stage_blacklist
    path = os.path.join(scratch, "passport_blacklist_01032021.csv")
    with open(path, "w") as f:
        f.write("entry_dt;passport_num\n2021-03-01;0012 345678\n")
    row = stage_blacklist(read_blacklist(spark, path)).collect()[0]
    assert (row.entry_dt, row.passport_num) == ("2021-03-01", "0012 345678")
    for dim, contract in (("cards", SRC_CARDS), ("accounts", SRC_ACCOUNTS), ("clients", SRC_CLIENTS)):
        got = replay_source(spark, SF0001, dim, 2).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in contract]


def _drop(spark, day, **changes):
    bd, load_ts = REPLAY_DAYS[day]
    sources = {d: replay_source(spark, SF0001, d, day) for d in ("terminals", "cards", "accounts", "clients")}
    return DayDrop(bd, load_ts, bd, transactions_text(spark, SF0001), blacklist=blacklist_sheet(spark, SF0001), **(sources | changes))


def test_hardened_warehouse(spark, scratch):
    """An empty dimension, a re-run that archives, an older load id, a missing published table."""
    wh = Warehouse(spark, f"{scratch}/wh")
    sheet = f"{scratch}/terminals_01012024.csv"
    open(sheet, "w").close()
    empty = _drop(spark, 1, clients=replay_source(spark, SF0001, "clients", 1).where("false"), files=(sheet,), archive_dir=f"{scratch}/archive")
    run_day(wh, 5, empty)
    assert wh.history("clients").count() == 0 and wh.report().count() == wh.report().where("passport IS NULL").count()
    assert os.path.exists(f"{scratch}/archive/terminals_01012024.csv.backup") and not os.path.exists(sheet)
    stamp = os.path.getmtime(f"{scratch}/wh/dim_cards/load_id=5")
    run_day(wh, 5, empty)
    assert os.path.getmtime(f"{scratch}/wh/dim_cards/load_id=5") == stamp
    with pytest.raises(ValueError):
        run_day(wh, 4, empty)
    os.rename(f"{scratch}/wh/fact_transactions", f"{scratch}/moved")
    with pytest.raises(FileNotFoundError):
        wh.fact("fact_transactions")


def test_malformed_lines_stop_the_load(spark, scratch):
    path = os.path.join(scratch, "transactions_01032021.txt")
    with open(path, "w") as f:
        f.write("a;b;c;d;e;f;g\n1;2;3;4;5;6;7\n1;2;3\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_transactions(spark, path).collect()


def test_jdbc_options():
    got = jdbc_options("jdbc:x", "cards", {"user": "u"}, "card_id", (0, 100), 8)
    assert got["numPartitions"] == "8" and got["lowerBound"] == "0" and got["partitionColumn"] == "card_id"
    assert got["preferTimestampNTZ"] == "true" and "partitionColumn" not in jdbc_options("jdbc:x", "cards")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "cards", partition_column="card_id")


def test_catalog_source(spark):
    spark.range(3).createOrReplaceTempView("some_source")
    assert read_source_table(spark, "some_source").count() == 3


def test_a_report_that_failed_is_caught_up(spark, scratch, monkeypatch):
    """Load 2 is published but its report fails; load 3 reports only since its own day, and yet load 2's days appear."""
    from fraudlane.plans import daily
    wh, text, week = Warehouse(spark, f"{scratch}/wh"), transactions_text(spark, SF0001), timedelta(days=7)
    days = {1: (None, "2024-01-08"), 2: ("2024-01-08", "2024-01-15"), 3: ("2024-01-15", "2099-01-01")}

    def drop(day, **changes):
        lower, upper = days[day]
        part = text.where(F.col("trans_date") < upper)
        sources = {d: replay_source(spark, SF0001, d, day) for d in ("terminals", "cards", "accounts", "clients")}
        bd, load_ts = REPLAY_DAYS[day]
        return DayDrop(bd, load_ts, bd, part if lower is None else part.where(F.col("trans_date") >= lower), blacklist=blacklist_sheet(spark, SF0001), **(sources | changes))

    def since(day):
        return f"{days[day][0] or '2024-01-01'} 00:00:00"

    run_day(wh, 1, drop(1), probe_window=week, report_since=since(1))
    sheet = f"{scratch}/terminals_08012024.csv"
    open(sheet, "w").close()
    with monkeypatch.context() as m:
        def fail(*a, **k):
            raise RuntimeError("no report")
        m.setattr(daily, "fraud_mart", fail)
        with pytest.raises(RuntimeError):
            run_day(wh, 2, drop(2, files=(sheet,), archive_dir=f"{scratch}/archive"), probe_window=week, report_since=since(2))
    assert wh.published("load") == [1, 2] and wh.published("report") == [1] and wh.unreported(3) == [2]
    run_day(wh, 3, drop(3), probe_window=week, report_since=since(3))
    assert wh.published("report") == [1, 3] and wh.unreported(9) == []
    middle = wh.report().where("event_dt >= '2024-01-08' AND event_dt < '2024-01-15'")
    assert middle.count() > 0 and {r.report_dt for r in middle.collect()} == {date.fromisoformat(REPLAY_DAYS[3][0])}
    assert os.path.exists(f"{scratch}/archive/terminals_08012024.csv.backup") and not os.path.exists(sheet)
    # a crowded or a sparse day: the files of the facts follow the days, not tasks x days
    folders = [d for d, _, _ in os.walk(f"{scratch}/wh/fact_transactions/load_id=1") if "trans_day=" in d]
    parts = [f for _, _, fs in os.walk(f"{scratch}/wh/fact_transactions/load_id=1") for f in fs if f.endswith(".parquet")]
    assert len(parts) == len(folders) > 3


@pytest.mark.parametrize("other, error", [(1, Fenced), (2, Conflict)])
def test_of_two_writers_one_commits(spark, scratch, monkeypatch, other, error):
    """While a writer loads load 1, another one loads and publishes the same load, or a later one."""
    from fraudlane.plans import daily
    real, root, week = daily.new_blacklist, f"{scratch}/wh", timedelta(days=7)

    def meanwhile(*args):
        monkeypatch.setattr(daily, "new_blacklist", real)
        run_day(Warehouse(spark, root), other, _drop(spark, 1), probe_window=week, versions="current")
        return real(*args)

    monkeypatch.setattr(daily, "new_blacklist", meanwhile)
    with pytest.raises(error):
        run_day(Warehouse(spark, root), 1, _drop(spark, 1), probe_window=week, versions="current")
    wh = Warehouse(spark, root)
    assert wh.published("load") == wh.published("report") == [other]
    assert wh.fact("fact_transactions").count() == transactions(spark, SF0001).count()  # the loser's folders aren't read
    want = replay(spark, SF0001, "cards", (1,))
    assert wh.history("cards").exceptAll(want).count() == 0 and want.exceptAll(wh.history("cards")).count() == 0
    assert wh.report().count() > 0


def test_files_of_one_name_are_archived_apart(spark, scratch):
    from fraudlane.sources.files import archive_files
    for folder in ("a", "b"):
        os.makedirs(f"{scratch}/{folder}")
        open(f"{scratch}/{folder}/cards.csv", "w").close()
    moved = archive_files(spark, [f"{scratch}/a/cards.csv", f"{scratch}/b/cards.csv"], f"{scratch}/archive")
    assert sorted(os.path.basename(m) for m in moved) == ["b-cards.csv.backup", "cards.csv.backup"]
