"""SCD2 three-day replay: expected counts (FIXTURES.md §4) and history invariants."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from fraudlane.operators.scd2 import is_open, scd2_apply, scd2_step
from fraudlane.plans.replay import day_inputs, history_and_next, mark_after, replay
from fraudlane.schemas import CARDS
from fraudlane.sources.bank_fixture import REPLAY_SPECS

EXPECTED = {
    # sf: {day: (staged, versions, open N, open Y, next mark)}
    SF001: {1: (1364, 1364, 1364, 0, "2024-01-01"), 2: (307, 1777, 1384, 106, "2024-01-10"),
            3: (58, 1835, 1442, 53, "2024-01-20")},
    SF0001: {1: (136, 136, 136, 0, "2024-01-01"), 2: (31, 178, 138, 11, "2024-01-10"),
             3: (6, 184, 144, 6, "2024-01-20")},
}


def summary(hist):
    r = hist.agg(
        F.count("*").alias("n"),
        F.sum((is_open() & (F.col("deleted_flg") == "N")).cast("int")).alias("open_n"),
        F.sum((is_open() & (F.col("deleted_flg") == "Y")).cast("int")).alias("open_y")).first()
    return r.n, r.open_n, r.open_y


@pytest.mark.parametrize("sf", [SF0001, SF001])
@pytest.mark.parametrize("dim", ["generic", "cards", "accounts", "clients"])
def test_replay_counts(spark, sf, dim):
    for day, (staged, versions, open_n, open_y, mark) in EXPECTED[sf].items():
        hist = replay(spark, sf, dim, tuple(range(1, day + 1)))
        _, inputs = history_and_next(spark, sf, dim, day)
        next_mark = mark_after(spark, sf, dim, tuple(range(1, day + 1)))
        if dim != "clients":  # clients also stage birth-date touches that open no version
            assert inputs.stage.count() == staged
        assert summary(hist) == (versions, open_n, open_y)
        assert str(next_mark)[:10] == mark


def test_invariants_and_idempotence(spark):
    spec = REPLAY_SPECS["generic"]
    hist = replay(spark, SF0001, "generic", (1, 2, 3))
    _, inputs = history_and_next(spark, SF0001, "generic", 3)
    opens = hist.where(is_open()).groupBy(spec.key).count()
    assert opens.where("count > 1").count() == 0  # at most one open version per key
    keys = inputs.keys.withColumn("live", F.lit(True))
    bad = (hist.where(is_open()).join(keys, spec.key, "left")
               .where(F.col("live").isNull() & (F.col("deleted_flg") == "N")))
    assert bad.count() == 0  # an open key is live in the snapshot or deleted
    again = scd2_apply(hist, inputs.stage, inputs.keys, spec, inputs.load_ts)
    assert again.exceptAll(hist).count() == 0 and hist.exceptAll(again).count() == 0


def test_dob_change_opens_no_version(spark):
    hist2 = replay(spark, SF0001, "clients", (1, 2))
    hist1 = replay(spark, SF0001, "clients", (1,))
    k = F.col("client_id").cast("int")
    moved = hist2.where((k % 7 == 2) & (k % 13 != 4)).groupBy("client_id").count()
    assert moved.where("count > 1").count() == 0
    assert hist1.count() == 136


def test_new_key_missing_from_snapshot_is_deleted_at_once(spark):
    rows = [("C1", "A1", datetime(2024, 1, 1), None)]
    stage = spark.createDataFrame(rows, "card_num string, account_num string, create_dt timestamp_ntz, "
                                        "update_dt timestamp_ntz")
    keys = spark.createDataFrame([("C2",)], "card_num string")
    empty = spark.createDataFrame([], CARDS.history_schema())
    out = scd2_step(empty, stage, keys, CARDS, "2024-01-02 02:00:00").orderBy("effective_from").collect()
    assert [(r.effective_from, r.effective_to, r.deleted_flg) for r in out] == [
        (datetime(2024, 1, 1), datetime(2024, 1, 1, 2), "N"),
        (datetime(2024, 1, 2, 2), datetime(9999, 12, 31), "Y")]


def test_change_without_update_stamp_starts_at_create(spark):
    hist = spark.createDataFrame([("C1", "A1", datetime(2024, 1, 1), datetime(9999, 12, 31), "N")],
                                 CARDS.history_schema())
    stage = spark.createDataFrame([("C1", "A2", datetime(2024, 1, 5), None)],
                                  "card_num string, account_num string, create_dt timestamp_ntz, "
                                  "update_dt timestamp_ntz")
    out = {(r.account_num, r.effective_from, r.effective_to)
           for r in scd2_step(hist, stage, None, CARDS, "2024-01-06 00:00:00").collect()}
    assert out == {("A1", datetime(2024, 1, 1), datetime(2024, 1, 4)),
                   ("A2", datetime(2024, 1, 5), datetime(9999, 12, 31))}


def test_terminals_deleted_on_file_date(spark):
    hist = replay(spark, SF001, "terminals", (1, 2))
    deleted = hist.where(is_open() & (F.col("deleted_flg") == "Y"))
    assert deleted.count() == 7
    assert {r.effective_from for r in deleted.collect()} == {datetime(2024, 1, 10)}


def test_one_shuffle_per_input(spark, scratch):
    """The open versions, the stage and the key snapshot are each exchanged once; the
    full outer join reuses that partitioning."""
    spec = REPLAY_SPECS["generic"]
    hist, mark = replay(spark, SF0001, "generic", (1,)), mark_after(spark, SF0001, "generic", (1,))
    hist.write.parquet(f"{scratch}/hist")
    hist = spark.read.parquet(f"{scratch}/hist")
    inputs = day_inputs(spark, SF0001, "generic", 2, mark)
    step = scd2_step(hist.where(is_open()), inputs.stage, inputs.keys, spec, inputs.load_ts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan shows exchange reuse
    try:
        plan = step._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [ln for ln in plan.splitlines()
                 if "Exchange hashpartitioning" in ln and "ReusedExchange" not in ln]
    assert len(exchanges) == 3


def _terminals(spark, *rows):
    return spark.createDataFrame([(k, "POS", city, "a", at) for k, city, at in rows],
                                 "terminal_id string, terminal_type string, terminal_city string, terminal_address string, update_dt timestamp_ntz")


def test_a_key_staged_twice_adds_no_versions(spark):
    """One terminal twice in the sheet, unchanged over four loads, then changed in one of its rows."""
    spec = REPLAY_SPECS["terminals"]
    hist = spark.createDataFrame([], spec.history_schema())
    for day in (1, 2, 3, 4):
        stage = _terminals(spark, ("T1", "Kazan", datetime(2024, 1, day)), ("T1", "Kazan", datetime(2024, 1, day)))
        hist = spark.createDataFrame(scd2_apply(hist, stage, stage.select("terminal_id"), spec, f"2024-01-0{day}").collect(), spec.history_schema())
        assert hist.count() == 1
    stage = _terminals(spark, ("T1", "Kazan", datetime(2024, 1, 5)), ("T1", "Moscow", datetime(2024, 1, 6)))
    hist = scd2_apply(hist, stage, stage.select("terminal_id"), spec, "2024-01-06")
    assert sorted((r.terminal_city, r.effective_to) for r in hist.collect()) == [("Kazan", datetime(2024, 1, 5)), ("Moscow", datetime(9999, 12, 31))]


def test_repeated_open_versions_are_folded_and_null_ends_are_kept(spark):
    end = datetime(9999, 12, 31)
    rows = [("C1", "A1", datetime(2024, 1, 1), end, "N")] * 4 + [("C2", "A1", datetime(2024, 1, 1), end, "N"), ("C2", "A2", datetime(2024, 1, 5), end, "N"),
            ("C3", "A3", datetime(2023, 1, 1), None, "N"), ("C3", "A4", datetime(2024, 1, 1), end, "N")]
    hist = spark.createDataFrame(rows, CARDS.history_schema())
    stage = spark.createDataFrame([], "card_num string, account_num string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    got = sorted(tuple(r) for r in scd2_apply(hist, stage, None, CARDS, "2024-02-01").select(*CARDS.columns).collect())
    assert sorted((r[0], str(r[CARDS.columns.index("effective_to")])[:10]) for r in got) == [
        ("C1", "9999-12-31"), ("C2", "2024-01-04"), ("C2", "9999-12-31"), ("C3", "9999-12-31"), ("C3", "None")]


def test_padded_snapshot_keys_are_live(spark):
    from fraudlane.sources.extracts import key_snapshot
    sheet = spark.createDataFrame([(" T1 ", "POS", "Kazan", "a")], "terminal_id string, terminal_type string, terminal_city string, terminal_address string")
    assert [r[0] for r in key_snapshot(sheet, "terminals").collect()] == ["T1"]
