"""Bloom filters beside the loads: no known id is denied, and loads without a staged id aren't read."""

import pytest
from pyspark.sql import functions as F

from fraudlane.operators.id_filters import BITS_PER_ID, SEGMENT_BITS, build_filter, possible_loads, segments_for
from fraudlane.plans.daily import LOAD, Warehouse
from fraudlane.schemas import FACT_TRANSACTIONS


def _facts(spark, first, n):
    return spark.range(first, first + n).select(
        F.col("id").cast("string").alias("trans_id"), F.lit("2024-01-05 10:00:00").cast("timestamp_ntz").alias("trans_date"),
        F.lit("C").alias("card_num"), F.lit("PAYMENT").alias("oper_type"), F.lit(1).cast("decimal(7,2)").alias("amt"),
        F.lit("SUCCESS").alias("oper_result"), F.lit("T").alias("terminal")).select(*FACT_TRANSACTIONS.names)


def _publish(wh, load_id, facts, with_filter=True):
    wh.write(facts.withColumn("trans_day", F.to_date("trans_date")), "fact_transactions", load_id, partition_by="trans_day")
    if with_filter:
        wh.write_id_filter(load_id)
    wh.publish(load_id, LOAD)


def test_segments_follow_the_ids():
    per_segment = SEGMENT_BITS // BITS_PER_ID
    assert [segments_for(n) for n in (0, 1, per_segment, per_segment + 1, 5 * per_segment)] == [1, 1, 1, 2, 8]


@pytest.mark.parametrize("n", [0, 1, 20_000])
def test_no_id_is_denied_and_few_strange_ones_pass(spark, n):
    ids = spark.range(n).select(F.concat(F.lit("t-"), "id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    built = build_filter(ids.unionByName(ids), "k").cache()  # repeated ids are one
    assert built.count() == segments_for(n) and {len(r.words) for r in built.collect()} == {SEGMENT_BITS // 64}
    filters, sizes = built.withColumn("load_id", F.lit(3)), [segments_for(n), 2 * segments_for(n)]
    assert possible_loads(ids, "k", filters, sizes).distinct().count() == n  # a null asks for nothing
    strange = spark.range(20_000).select(F.concat(F.lit("other-"), "id").alias("k"))
    assert possible_loads(strange, "k", filters, sizes).count() < 20


def test_only_loads_that_may_hold_an_id_are_read(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    for load_id, first in ((1, 0), (2, 10_000), (3, 20_000)):
        _publish(wh, load_id, _facts(spark, first, 5_000))
    _publish(wh, 4, _facts(spark, 0, 0))  # a load without new facts

    def asked(*ids):
        return wh.loads_that_may_hold(spark.createDataFrame([(i,) for i in ids], "trans_id string"), "trans_id", 9)

    assert asked("10007", None) == [2] and asked("3", "24999") == [1, 3] and asked("999999") == [] and asked(None) == []
    read = wh.transactions_of(asked("10007", "999999"))
    assert {f.split("load_id=")[1][0] for f in read.inputFiles()} <= {"1", "2", "3", "4"}
    assert read.count() == 5_000 and read.where("trans_id = '10007'").count() == 1
    partitions = [line for line in read._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert partitions and all("load_id" in line for line in partitions)  # other folders are pruned
    assert wh.transactions_of(asked("999999")).count() == 0
    _publish(wh, 5, _facts(spark, 30_000, 10), with_filter=False)  # no filter: always read
    assert asked("999999") == [5] and asked("10007") == [2, 5]
    assert wh.loads_that_may_hold(spark.createDataFrame([("10007",)], "trans_id string"), "trans_id", 2) == []
