"""Dimensions stored as the changes of each load, with buckets written whole again when enough of them has changed."""

from datetime import datetime

import pytest

from fraudlane.operators.scd2 import is_open, scd2_apply, scd2_step
from fraudlane.plans import daily
from fraudlane.plans.daily import BUCKETS, LOAD, Warehouse
from fraudlane.schemas import DIMENSIONS

SPEC = DIMENSIONS["cards"]
N_KEYS = 400


def stage(spark, numbers, account, day):
    """Cards with these numbers, on an account, updated on a day."""
    at = datetime(2024, 1, day)
    rows = [tuple({SPEC.key: f"c{k}"}.get(c, f"{account}{k}") for c in (SPEC.key, *SPEC.attributes)) + (at, at) for k in numbers]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (SPEC.key, *SPEC.attributes)) + ", create_dt timestamp_ntz, update_dt timestamp_ntz")


def keys(spark, numbers):
    return spark.createDataFrame([(f"c{k}",) for k in numbers], f"{SPEC.key} string")


def rows_of(df):
    return sorted(map(str, df.collect()))


#: Load -> (changed cards, their account, all cards that are left)
LOADS = {1: (range(N_KEYS), "a", range(N_KEYS)), 2: (range(4), "b", range(N_KEYS)), 3: ((), "", range(2, N_KEYS)),
         4: (range(300), "c", range(2, N_KEYS)), 5: ((0, 7), "d", range(N_KEYS)), 6: ((), "", range(N_KEYS))}


def write(spark, wh, load, publish=True):
    changed, account, left = LOADS[load]
    wh.write_versions("cards", load, stage(spark, changed, account, load), keys(spark, left), f"2024-01-{load:02d} 12:00:00")
    if publish:
        wh.publish(load, LOAD)


def written(spark, scratch, load):
    return spark.read.parquet(f"{scratch}/wh/dim_cards/load_id={load}")


def test_loads_write_their_changes_and_readers_merge_them(spark, scratch):
    wh, want = Warehouse(spark, f"{scratch}/wh"), None
    for load, (changed, account, left) in LOADS.items():
        write(spark, wh, load)
        before = want if want is not None else wh.history("cards", before=load)
        want = scd2_apply(before, stage(spark, changed, account, load), keys(spark, left), SPEC, f"2024-01-{load:02d} 12:00:00")
        want = spark.createDataFrame(want.collect(), SPEC.history_schema())
        assert rows_of(wh.history("cards")) == rows_of(want), load
        assert rows_of(wh.open_versions("cards")) == rows_of(want.where(is_open())), load
    assert written(spark, scratch, 1).count() == N_KEYS
    assert written(spark, scratch, 2).count() == 2 * 4  # four closed, four opened: 1 % of the keys
    assert written(spark, scratch, 3).count() == 2 * 2
    # load 4 changes three quarters, so that load 5 writes the buckets whole, and load 6 nothing
    assert {b.base for b in wh.buckets("cards", before=5)} == {1} and {b.base for b in wh.buckets("cards")} == {5}
    assert written(spark, scratch, 5).where("state = 'open'").count() == N_KEYS
    scan = next(x for x in wh.open_versions("cards")._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x)
    filters = scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "IN (5,6)" in filters  # folders before the base aren't read
    assert sum(b.base_rows for b in wh.buckets("cards")) == N_KEYS and len(wh.buckets("cards")) == BUCKETS


def test_a_load_that_stops_before_it_is_published_changes_nothing(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    write(spark, wh, 1)
    before = rows_of(wh.history("cards"))
    write(spark, wh, 4, publish=False)
    assert rows_of(Warehouse(spark, wh.root).history("cards")) == before
    assert {b.base for b in wh.buckets("cards")} == {1} and {b.later_rows for b in wh.buckets("cards")} == {0}
    write(spark, wh, 2)  # a load of another number goes on from load 1 alone
    assert sum(b.later_rows for b in wh.buckets("cards")) == 4
    write(spark, wh, 4)  # and the same load again, over what it left
    got = wh.open_versions("cards")
    assert got.count() == got.select(SPEC.key).distinct().count() == N_KEYS


@pytest.mark.parametrize("ratio, bases", [(0.0, {3}), (10.0, {1})])
def test_the_ratio_decides_when_buckets_are_written_whole(spark, scratch, monkeypatch, ratio, bases):
    monkeypatch.setattr(daily, "COMPACT_RATIO", ratio)
    wh = Warehouse(spark, f"{scratch}/wh")
    for load in (1, 2, 3):
        write(spark, wh, load)
    touched = {b.bucket for b in wh.buckets("cards", before=3) if b.later_rows > 0}
    assert touched and {b.base for b in wh.buckets("cards") if b.bucket in touched} == bases


def test_the_change_alone(spark):
    """scd2_step without the open versions that stay: null keys, deletions of deleted keys, repeated open versions."""
    def history(*rows):
        made = [tuple({SPEC.key: key, "effective_from": datetime(2024, 1, 1), "effective_to": end, "deleted_flg": flag}.get(c, value) for c in SPEC.columns)
                for key, value, end, flag in rows]
        return spark.createDataFrame(made, SPEC.history_schema())

    end = datetime(9999, 12, 31)
    opened = history(("c1", "a1", end, "N"), ("c2", "a2", end, "N"), ("c3", "a3", end, "Y"), (None, "x", end, "N"), ("c5", "o", end, "N"), ("c5", "p", end, "N"))
    change = scd2_step(opened, stage(spark, (1,), "a", 9), keys(spark, (1, 2, 5)), SPEC, "2024-01-09 12:00:00", repeat="false")
    whole = scd2_step(opened, stage(spark, (1,), "a", 9), keys(spark, (1, 2, 5)), SPEC, "2024-01-09 12:00:00")
    assert rows_of(change.where(~is_open())) == rows_of(whole.where(~is_open()))
    assert sorted(str(r[0]) for r in change.where(is_open()).select(SPEC.key).collect()) == ["None", "c5"]
    stays = {str(r) for r in rows_of(whole)} - set(rows_of(change))
    assert len(stays) == 3 and change.exceptAll(whole).count() == 0
