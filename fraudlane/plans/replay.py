"""Daily SCD2 loads replayed over the testdata-derived source calendar (FIXTURES §4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.scd2 import empty_history, scd2_apply
from ..operators.watermark import next_mark
from ..schemas import FIRST_MARK
from ..sources.bank_fixture import REPLAY_DAYS, REPLAY_SPECS, replay_source
from ..sources.extracts import incremental_extract, key_snapshot
from ..sources.files import stage_terminals


@dataclass
class DayInputs:
    stage: DataFrame
    keys: DataFrame
    load_ts: str
    deleted_from: str | None
    advances: bool  # whether the stage moves the mark (sheets don't)


def day_inputs(spark: SparkSession, sf_dir: str, dim: str, day: int, mark) -> DayInputs:
    """Stage, key snapshot and load stamps of ``dim`` on ``day`` given the current mark.

    Terminals come as a whole daily sheet stamped with the file date, which also starts
    their deleted versions (Q18); the other tables are extracted incrementally.
    """
    business_date, load_ts = REPLAY_DAYS[day]
    src = replay_source(spark, sf_dir, dim, day)
    if dim == "terminals":
        stage = stage_terminals(src, business_date)
        return DayInputs(stage, key_snapshot(src, dim), load_ts, business_date, False)
    stage = incremental_extract(src, dim, mark)
    return DayInputs(stage, key_snapshot(src, dim), load_ts, None, True)


def replay(spark: SparkSession, sf_dir: str, dim: str, days=(1, 2, 3)):
    """History of ``dim`` after the given days. A day's mark is read (a job of its own) only if another day follows."""
    spec = REPLAY_SPECS[dim]
    hist = empty_history(spark, spec)
    mark = FIRST_MARK
    for day in days:
        inputs = day_inputs(spark, sf_dir, dim, day, mark)
        hist = scd2_apply(hist, inputs.stage, inputs.keys, spec, inputs.load_ts, inputs.deleted_from)
        if inputs.advances and day != days[-1]:
            mark = next_mark(inputs.stage, mark)
    return hist


def mark_after(spark: SparkSession, sf_dir: str, dim: str, days) -> object:
    """The mark after the given days' loads."""
    mark = FIRST_MARK
    for day in days:
        inputs = day_inputs(spark, sf_dir, dim, day, mark)
        if inputs.advances:
            mark = next_mark(inputs.stage, mark)
    return mark


def history_and_next(spark: SparkSession, sf_dir: str, dim: str, day: int):
    """History after ``day - 1`` loads and the inputs of ``day`` (for single-step operators)."""
    before = tuple(range(1, day))
    return replay(spark, sf_dir, dim, before), day_inputs(spark, sf_dir, dim, day, mark_after(spark, sf_dir, dim, before))
