"""Flags met by id without an exchange of whole rows, and slices measured from counts."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF0001
from fraudlane.functions.bloom import bits_for, filter_value, may_hold
from fraudlane.operators.lags import HOUR, TASK_ROWS, exact_lags, joint_lags, measured_slices, with_slices
from fraudlane.operators.rules import classify, crowded_buckets, spread_flags, with_rule_lags
from fraudlane.plans.queries import _enriched, bank_tables, with_extra_versions

WEEK = timedelta(days=7)


@pytest.fixture(scope="module")
def enriched(spark):
    return _enriched(with_extra_versions(bank_tables(spark, SF0001)))


def classes(df):
    return sorted(map(repr, df.select("trans_id", "client_id", "terminal_city", "event_type").collect()))


def test_every_path_gives_the_same_classes(enriched):
    base = classes(classify(enriched, probe_window=WEEK))
    assert sum("event_type='3'" in r or "event_type='4'" in r for r in base) > 100
    assert classes(classify(enriched, probe_window=WEEK, broadcast_ids=0)) == base
    assert classes(classify(enriched, probe_window=WEEK, slice_rows=5)) == base
    assert classes(classify(enriched, probe_window=WEEK, slice_width=timedelta(hours=6))) == base


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_rows_are_not_exchanged_by_id(spark, enriched):
    """Few flagged ids are broadcast: no exchange is keyed by trans_id. Many are filtered first, and only what passes is exchanged."""
    flagged = enriched.select("trans_id").distinct().limit(50).select("trans_id", F.lit(True).alias("any_hop"), F.lit(False).alias("any_probe"))
    assert "hashpartitioning(trans_id" not in plan(spread_flags(enriched, flagged)) and "BroadcastHashJoin [trans_id" in plan(spread_flags(enriched, flagged))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spread_flags(enriched, flagged, broadcast_ids=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))
    assert "hashpartitioning(trans_id" in text and "_salt" in text and "ubquery" in text, [line[:300] for line in text.splitlines() if "trans_id" in line and ("Exchange" in line or "Join" in line or "ubquery" in line)]


def test_rows_of_a_hot_id_are_spread_and_flagged(spark):
    rows = [("hot", datetime(2024, 1, 1) + timedelta(seconds=k), f"T{k % 7}", k, "PAYMENT") for k in range(3000)]
    rows += [(f"i{k}", datetime(2024, 1, 2), "T1", k, "PAYMENT") for k in range(3000)] + [(None, datetime(2024, 1, 3), "T1", 1, "PAYMENT")] * 5
    df = spark.createDataFrame(rows, "trans_id string, trans_date timestamp_ntz, terminal string, amt int, oper_type string")
    flagged = spark.createDataFrame([("hot", True, False), ("i7", False, True)], "trans_id string, any_hop boolean, any_probe boolean")
    for most in (0, 100):
        got = spread_flags(df, flagged, most)
        assert got.count() == len(rows) and got.columns[:1] == ["trans_id"]
        assert {(r.trans_id, r.any_hop, r.any_probe, r["count"]) for r in got.where("any_hop OR any_probe").groupBy("trans_id", "any_hop", "any_probe").count().collect()} \
            == {("hot", True, False, 3000), ("i7", False, True, 1)}
        assert got.where("any_hop IS NULL OR any_probe IS NULL").count() == 0
    salt = F.pmod(F.xxhash64("trans_date", "terminal", "amt", "oper_type"), F.lit(16))
    shares = [r["count"] for r in df.where("trans_id = 'hot'").groupBy(salt).count().collect()]
    assert len(shares) == 16 and max(shares) < 2 * 3000 / 16


def test_filter_holds_its_ids_and_few_others(spark):
    ids = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("id")).unionByName(spark.createDataFrame([(None,)], "id string"))
    bits = bits_for(5000)
    asked = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("n"))
    got = asked.select("n", may_hold(filter_value(ids, "id", bits), "id", bits).alias("may")).collect()
    assert all(r.may for r in got if r.n < 5000) and sum(r.may for r in got if r.n >= 5000) < 150
    none = spark.createDataFrame([(None,)], "id string").select(may_hold(filter_value(ids, "id", bits), "id", bits).alias("may"))
    assert [r.may for r in none.collect()] == [False]
    empty = asked.where(may_hold(filter_value(ids.limit(0), "id", 1024), "id", 1024))
    assert empty.count() == 0


def hot_null_client(spark):
    """Twelve thousand rows: a third of them of the null client, on one day, most of these in one hour."""
    rng, day = random.Random(4), datetime(2024, 3, 3)
    rows = [(None, day + timedelta(seconds=rng.randrange(3600) if k % 4 else rng.randrange(86400)), f"n{k:05d}", rng.randrange(50)) for k in range(4000)]
    rows += [(f"c{k % 80}", day + timedelta(seconds=rng.randrange(30 * 86400)), f"o{k:05d}", rng.randrange(50)) for k in range(7980)]
    rows += [(None, None, f"z{k}", k) for k in range(10)] + [("c1", None, f"y{k}", k) for k in range(10)]
    return spark.createDataFrame(rows, "client_id string, trans_date timestamp_ntz, trans_id string, amt int")


def test_measured_slices_of_a_hot_null_client(spark):
    df = hot_null_client(spark)
    slices = measured_slices(df, ["client_id"], "trans_date", 250)
    assert {r.client_id for r in slices.select("client_id").distinct().collect()} == {None}  # others have a hundred rows each
    cut = with_slices(df, ["client_id"], "trans_date", slices)
    assert cut.count() == df.count() and set(cut.columns) == {*df.columns, "_slice"}
    sizes = [r["count"] for r in cut.where("client_id IS NULL AND trans_date IS NOT NULL").groupBy("_slice").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 500 and len(sizes) >= 12
    sizes = sorted(r["count"] for r in cut.groupBy("client_id", "_slice").count().collect() if r["count"] > 50)
    # the largest window partition, hot client or not, is below twice a task's share of 250 rows
    assert sizes[-1] < 500
    order = [r._slice for r in cut.where("client_id IS NULL").orderBy(F.col("trans_date").asc_nulls_last()).collect()]
    assert order == sorted(order)  # slices follow each other in time, rows without one come last
    assert measured_slices(df, ["client_id"], "trans_date", 5000) is None
    assert max(len(r._starts) for r in slices.collect()) > 5 and HOUR == 3600  # the hot hour is cut by the second


def test_lags_over_measured_slices_equal_plain_windows(spark):
    df = hot_null_client(spark)
    order = [F.col(c).asc_nulls_last() for c in ("trans_date", "trans_id")]
    specs = {"d1": ("trans_date", 1), "a1": ("amt", 1), "a3": ("amt", 3)}
    w = Window.partitionBy("client_id").orderBy(*order)
    want = sorted(map(repr, df.select("*", *[F.lag(c, k).over(w).alias(o) for o, (c, k) in specs.items()]).collect()))
    for rows in (1, 2, 40, 250, None):
        got = exact_lags(df, ["client_id"], order, specs, "trans_date", slice_rows=rows)
        assert sorted(map(repr, got.select(*df.columns, *specs).collect())) == want, rows
    by_type = df.withColumn("kind", F.col("amt") % 3)
    w = Window.partitionBy("client_id", "kind").orderBy(*order)
    want = sorted(map(repr, by_type.select("*", F.lag("amt", 3).over(w).alias("a3")).collect()))
    got = exact_lags(by_type, ["client_id", "kind"], order, {"a3": ("amt", 3)}, "trans_date", slice_rows=100)
    assert sorted(map(repr, got.select(*by_type.columns, "a3").collect())) == want


def test_slices_of_an_empty_table_and_of_one_crowded_second(spark):
    df = hot_null_client(spark)
    assert measured_slices(df.limit(0), ["client_id"], "trans_date") is None
    same = spark.createDataFrame([("c", datetime(2024, 1, 1, 5), f"{k:03d}", k) for k in range(300)], df.schema)
    order = [F.col(c).asc_nulls_last() for c in ("trans_date", "trans_id")]
    got = exact_lags(same, ["client_id"], order, {"p": ("amt", 1)}, "trans_date", slice_rows=10).orderBy("trans_id").collect()
    assert [r.p for r in got] == [None, *range(299)]  # one second is one slice, and right


def test_many_flagged_ids_are_not_broadcast(spark, enriched):
    """Beyond the bound the ids' join shuffles, though their file is far below Spark's own threshold."""
    flagged = enriched.select("trans_id").distinct().select("trans_id", F.lit(True).alias("any_hop"), F.lit(False).alias("any_probe"))
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    text = plan(spread_flags(enriched, flagged, broadcast_ids=0))
    assert "SortMergeJoin [trans_id" in text and "BroadcastHashJoin [trans_id" not in text


def test_window_tasks_have_a_bounded_number_of_rows(spark, enriched):
    """With the rows counted, the windows are dealt to tasks by that number, not to the few that AQE makes of their packed bytes."""
    for slice_rows, keys in ((None, "client_id"), (5, "_pkey")):
        text = plan(with_rule_lags(enriched, probe_window=WEEK, slice_rows=slice_rows, rows=100_000_000))
        numbers = [int(n) for n in re.findall(rf"hashpartitioning\({keys}[^\n]*?, (\d+)\), REPARTITION_BY_NUM", text)]
        assert numbers and set(numbers) == {-(-100_000_000 // TASK_ROWS)}, text[:3000]
    assert "REPARTITION_BY_NUM" not in plan(with_rule_lags(enriched, probe_window=WEEK, rows=1000))


def test_windows_over_slices_are_computed_once(spark, enriched):
    """One exchange by client and slice serves the rules' windows, and nothing is joined back to the rows by slice."""
    text = plan(with_rule_lags(enriched, probe_window=WEEK, slice_rows=5, rows=100_000_000))
    assert text.count("REPARTITION_BY_NUM") == 1 and "Join [_pkey" not in text


def test_joint_lags_equal_plain_windows(spark):
    df = hot_null_client(spark).withColumn("kind", F.col("amt") % 3)
    df = df.unionByName(df.where("trans_id < 'n00900'").withColumn("client_id", F.lit("d")))  # a second hot client
    order = ["trans_date", "trans_id"]
    windows = [((), {"d1": ("trans_date", 1), "a1": ("amt", 1)}), (("kind",), {"k1": ("amt", 1), "k3": ("trans_id", 3)})]
    by = [F.col(c).asc_nulls_last() for c in order]
    lags = [F.lag(c, k).over(Window.partitionBy("client_id", *cols).orderBy(*by)).alias(o) for cols, specs in windows for o, (c, k) in specs.items()]
    want = sorted(map(repr, df.select("*", *lags).collect()))
    for slice_rows in (1, 2, 40, 250):
        slices = measured_slices(df, ["client_id"], "trans_date", slice_rows)
        got = joint_lags(df, ["client_id"], windows, order, "trans_date", slices, rows=1_000_000)
        assert sorted(map(repr, got.select(*df.columns, "d1", "a1", "k1", "k3").collect())) == want, slice_rows


def test_only_crowded_ids_are_spread(spark):
    ids = spark.range(3000).select(F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("i"), "id")).alias("trans_id"))
    ids = ids.unionByName(spark.createDataFrame([(None,)] * 2000, "trans_id string"))
    assert len(crowded_buckets(ids, 500)) == 1 and crowded_buckets(ids, 1500) == [] and crowded_buckets(ids.limit(0), 500) == []
    rows = ids.select("trans_id", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("trans_date"), F.monotonically_increasing_id().alias("amt"),
                      F.lit("T1").alias("terminal"), F.lit("PAYMENT").alias("oper_type"))
    flagged = spark.createDataFrame([("hot", True, False), ("i2000", False, True)], "trans_id string, any_hop boolean, any_probe boolean")
    for n_rows in (None, 5, 5_000_000):  # through a filter, all rows at once, and with far more rows than flagged ids
        got = spread_flags(rows, flagged, 0, ids, n_rows, 500)
        assert got.count() == 5000 and got.where("any_hop").count() == 1000 and got.where("any_probe").count() == 1
    text = plan(spread_flags(rows, flagged, 0, ids, 5, 500))
    assert "ubquery" not in text and "SortMergeJoin [trans_id" in text


def test_steps_side_by_side_raise_the_first_error():
    from fraudlane.plans.daily import _together
    done = []
    with pytest.raises(ZeroDivisionError):
        _together([lambda: 1 / 0, lambda: done.append(1)])
    assert done == [1] and _together([lambda: 1, lambda: 2]) == [1, 2]
