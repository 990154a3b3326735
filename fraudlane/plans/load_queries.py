"""Registered queries of the load side: SCD2 statements and replay, extracts, key
snapshots and high-water marks (FIXTURES §4 calendar)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scd2
from ..operators.watermark import (advance_mark, advance_terminals_mark, empty_meta,
                                   seed_marks)
from ..schemas import FIRST_MARK
from ..sources.bank_fixture import REPLAY_DAYS, REPLAY_SPECS, blacklist_sheet, replay_source, transactions_text
from ..sources.extracts import incremental_extract, key_snapshot
from ..sources.files import stage_terminals
from .daily import DayDrop, Warehouse, run_day
from .queries import PROBE_WINDOW, register
from .replay import day_inputs, history_and_next, replay
from .stream_queries import scratch_dir

DIMS = ("terminals", "cards", "accounts", "clients")
FIRST_DROP_UNTIL = "2024-01-08"
DAY2_MARK = "2024-01-01 00:00:00"


def _cols(dim):
    return list(REPLAY_SPECS[dim].columns)


def _register_dim(dim: str) -> None:
    spec = REPLAY_SPECS[dim]

    @register(f"scd2_new_{dim}")
    def _new(spark, sf_dir):
        """Day-2 stage keys with no version in the day-1 history."""
        hist, inp = history_and_next(spark, sf_dir, dim, 2)
        return scd2.scd2_new(inp.stage, hist, spec).select(*_cols(dim))

    @register(f"scd2_changed_{dim}")
    def _changed(spark, sf_dir):
        """New versions for changed or revived day-2 stage rows."""
        hist, inp = history_and_next(spark, sf_dir, dim, 2)
        return scd2.scd2_changed(inp.stage, hist, spec).select(*_cols(dim))

    @register(f"scd2_close_changed_{dim}")
    def _close_changed(spark, sf_dir):
        """Open versions closed by a change, with their new end."""
        hist, inp = history_and_next(spark, sf_dir, dim, 2)
        return scd2.scd2_close_changed(inp.stage, hist, spec).select(*_cols(dim))

    @register(f"scd2_deleted_{dim}")
    def _deleted(spark, sf_dir):
        """Deleted versions for live keys missing from the day-2 snapshot."""
        hist, inp = history_and_next(spark, sf_dir, dim, 2)
        start = inp.deleted_from or inp.load_ts
        return scd2.scd2_deleted(hist, inp.keys, spec, start).select(*_cols(dim))

    @register(f"scd2_close_deleted_{dim}")
    def _close_deleted(spark, sf_dir):
        """The live versions those deletes close."""
        hist, inp = history_and_next(spark, sf_dir, dim, 2)
        start = inp.deleted_from or inp.load_ts
        return scd2.scd2_close_deleted(hist, inp.keys, spec, start).select(*_cols(dim))

    @register(f"scd2_apply_{dim}")
    def _apply(spark, sf_dir):
        """History after the day-1 and day-2 loads."""
        return replay(spark, sf_dir, dim, (1, 2)).select(*_cols(dim))


for _d in DIMS:
    _register_dim(_d)


def _terminal_loads(spark, sf_dir, change):
    """History of the terminals after the day-1 and day-2 sheets, each changed by ``change``."""
    spec = REPLAY_SPECS["terminals"]
    hist = scd2.empty_history(spark, spec)
    for day in (1, 2):
        business_date, load_ts = REPLAY_DAYS[day]
        sheet = change(replay_source(spark, sf_dir, "terminals", day))
        hist = scd2.scd2_apply(hist, stage_terminals(sheet, business_date), key_snapshot(sheet, "terminals"), spec, load_ts, business_date)
    return hist.select(*_cols("terminals"))


@register("scd2_apply_duplicate_stage")
def q_apply_duplicate_stage(spark, sf_dir):
    """Every terminal twice in each day's sheet, once padded; the history is that of the plain sheets."""
    def twice(sheet):
        return sheet.unionByName(sheet.withColumn("terminal_id", F.concat(F.lit(" "), "terminal_id")))
    return _terminal_loads(spark, sf_dir, twice)


@register("scd2_apply_padded_snapshot")
def q_apply_padded_snapshot(spark, sf_dir):
    """All keys of the sheet and of its snapshot padded; no live terminal is taken for deleted."""
    return _terminal_loads(spark, sf_dir, lambda sheet: sheet.withColumn("terminal_id", F.concat(F.lit("  "), "terminal_id", F.lit(" "))))


_RUN: dict = {}


def _two_days(spark, sf_dir) -> Warehouse:
    """A warehouse in the shared scratch space after the daily runs of day 1 and day 2; run once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _RUN:
        return _RUN[key]
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"))
    for day in (1, 2):
        business_date, load_ts = REPLAY_DAYS[day]
        drop = DayDrop(business_date, load_ts, business_date, transactions_text(spark, sf_dir, FIRST_DROP_UNTIL if day == 1 else None),
                       blacklist=blacklist_sheet(spark, sf_dir),
                       **{d: replay_source(spark, sf_dir, d, day) for d in ("terminals", "cards", "accounts", "clients")})
        run_day(wh, day, drop, probe_window=PROBE_WINDOW)
    _RUN[key] = wh
    return wh


@register("daily_run_cards")
def q_daily_run_cards(spark, sf_dir):
    """The cards' history that two daily runs publish."""
    return _two_days(spark, sf_dir).history("cards").select(*_cols("cards"))


@register("daily_run_facts")
def q_daily_run_facts(spark, sf_dir):
    """The transactions that two daily runs publish, the second drop sending the first one's again."""
    return _two_days(spark, sf_dir).fact("fact_transactions")


@register("daily_run_marks")
def q_daily_run_marks(spark, sf_dir):
    """The marks after two daily runs, each read from the last before the next extract."""
    return _two_days(spark, sf_dir).meta()


@register("daily_run_report")
def q_daily_run_report(spark, sf_dir):
    """K5: the published report of two daily runs, the second appending what the first had not reported on its date."""
    return _two_days(spark, sf_dir).report()


@register("scd2_three_day_replay")
def q_three_day_replay(spark, sf_dir):
    """Three daily loads with new, changed, deleted and revived keys."""
    return replay(spark, sf_dir, "generic", (1, 2, 3)).select(*_cols("generic"))


@register("scd2_current")
def q_scd2_current(spark, sf_dir):
    """P5: open versions (live and deleted) after three loads."""
    return scd2.current_versions(replay(spark, sf_dir, "generic", (1, 2, 3))).select(*_cols("generic"))


@register("scd2_revived")
def q_scd2_revived(spark, sf_dir):
    """Day-3 stage rows that bring back keys deleted on day 2."""
    hist, inp = history_and_next(spark, sf_dir, "generic", 3)
    return scd2.revived(inp.stage, hist, REPLAY_SPECS["generic"])


def _register_extract(dim: str) -> None:
    @register(f"extract_{dim}")
    def _extract(spark, sf_dir):
        """Day-2 source rows newer than the 2024-01-01 mark."""
        return incremental_extract(replay_source(spark, sf_dir, dim, 2), dim, DAY2_MARK)


for _d in ("cards", "accounts", "clients"):
    _register_extract(_d)


def _register_keys(dim: str) -> None:
    @register(f"keys_{dim}")
    def _keys(spark, sf_dir):
        """Full key snapshot of the day-2 source."""
        return key_snapshot(replay_source(spark, sf_dir, dim, 2), dim)


for _d in ("cards", "accounts", "clients"):  # the terminals' keys come from a sheet file, see file_queries
    _register_keys(_d)


def _stage(spark, sf_dir, dim, day, mark):
    return day_inputs(spark, sf_dir, dim, day, mark).stage


@register("wm_seed")
def q_wm_seed(spark, sf_dir):
    """Seed marks; cards and accounts already have one from day 1."""
    meta = seed_marks(empty_meta(spark), {"stg_cards": FIRST_MARK, "stg_accounts": FIRST_MARK})
    meta = advance_mark(meta, "stg_cards", _stage(spark, sf_dir, "cards", 1, FIRST_MARK))
    meta = advance_mark(meta, "stg_accounts", _stage(spark, sf_dir, "accounts", 1, FIRST_MARK))
    return seed_marks(meta)


@register("wm_advance")
def q_wm_advance(spark, sf_dir):
    """W4a-c/A2: marks after the day-1 then day-2 extracts of cards, accounts, clients."""
    meta = seed_marks(empty_meta(spark))
    for day in (1, 2):
        for dim in ("cards", "accounts", "clients"):
            table = f"stg_{dim}"
            mark = meta.where(F.col("table_name") == table).first()["max_update_dt"]
            meta = advance_mark(meta, table, _stage(spark, sf_dir, dim, day, mark))
    return meta


@register("wm_advance_terminals")
def q_wm_advance_terminals(spark, sf_dir):
    """W4d/A3: terminals mark from the day-2 sheet and its file date."""
    meta = seed_marks(empty_meta(spark))
    business_date = REPLAY_DAYS[2][0]
    stage = _stage(spark, sf_dir, "terminals", 2, None)
    return advance_terminals_mark(meta, stage, business_date)
