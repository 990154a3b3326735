"""Type-2 history without MERGE: ``old history + stage + key snapshot -> new history``.

Per key, the daily load does, in this order (the warehouse's statement order):

* **D1 new**: a stage key with no version gets ``[from, 9999-12-31] 'N'``;
* **D2/D3 changed or revived**: a stage row that differs (null-safe) from the open version,
  or whose open version is deleted (``'Y'``), opens a new ``'N'`` version at its update
  stamp, and the old version ends one day before it;
* **D4/D5 deleted**: an open live version whose key is missing from the full key snapshot
  gets a ``'Y'`` copy from the load time, and the live version ends one day before it.
  Versions written by D1/D2 in the same load are seen by D4.

:func:`scd2_apply` computes all of that in one pass. Closed versions are passed through
untouched (never shuffled); only open versions, the stage and the snapshot are hash
partitioned on the key, once each, and co-grouped with two left joins and a full outer
join that all reuse that partitioning. Every output row of a key is built from the key's
co-grouped inputs as an array of versions and inlined, so no step re-reads its own output.

A key staged several times counts once, with its latest row (by ``update_dt``, else
``create_dt``, then by content); rows without a key count as one key. Open versions that an earlier
load repeated are folded: equal ones into one, and of different ones the latest stays open while
the others end one day before it. A version with a null end is closed, as any other end
than the open one. A key with no open version is taken to have no version at all, which is what D1 tests.

The single-statement operators (:func:`scd2_new` ... :func:`scd2_close_deleted`) state
one warehouse statement each over a given history, for inspection and tests.

Fixes over the source system, each noted where applied: a changed row without
``update_dt`` starts at its ``create_dt`` (Q10); the cards close step uses the same
grouping as the other dimensions (Q5); terminal keys are trimmed once on staging (Q11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import any_differs
from ..schemas import FLAG_DELETED, FLAG_LIVE, OPEN_END, DimSpec, open_end


def _one_day() -> Column:
    return F.expr("INTERVAL 1 DAY")


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def is_open() -> Column:
    """Never null: a version without an end is a closed one."""
    return F.col("effective_to").eqNullSafe(open_end())


def _differs(spec: DimSpec, a: str, b: str) -> Column:
    return any_differs(spec.tracked, a, b)


def _typed(spec: DimSpec, src: str, c: str) -> Column:
    return F.col(f"{src}.{c}").cast(spec.type_name(c))


def _stamp(stage: DataFrame, c: str) -> Column:
    return (F.col(c) if c in stage.columns else F.lit(None)).cast("timestamp_ntz").alias(c)


def _stage_struct(spec: DimSpec, stage: DataFrame) -> DataFrame:
    return stage.select(F.col(spec.key).alias("_key"),
                        F.struct(*[F.col(c) for c in spec.attributes],
                                 _stamp(stage, "create_dt"), _stamp(stage, "update_dt")).alias("s"))


def _changed_from() -> Column:
    # Q10 fix: a changed row without update_dt starts at create_dt instead of null
    return F.coalesce(F.col("s.update_dt"), F.col("s.create_dt"))


def scd2_apply(hist: DataFrame, stage: DataFrame, keys: DataFrame | None, spec: DimSpec,
               load_ts, deleted_from=None) -> DataFrame:
    """New history after one daily load of ``stage`` (and, if given, the full ``keys``
    snapshot). ``load_ts`` starts deleted versions (terminals pass the file date)."""
    closed = hist.where(~is_open()).select(*spec.columns)
    return closed.unionByName(scd2_step(hist.where(is_open()), stage, keys, spec, load_ts, deleted_from))


def scd2_step(open_versions: DataFrame, stage: DataFrame, keys: DataFrame | None, spec: DimSpec,
              load_ts, deleted_from=None, repeat: str = "true") -> DataFrame:
    """The part of the history a load touches, from the open versions alone: the versions
    it closes (with their new end) and all open versions afterwards. The closed history is
    not needed, so a daily load reads only about one row per key.

    ``repeat`` is a SQL condition on ``_key``: open versions that the load leaves as they are come out only where it
    holds. With ``"false"`` the result is the load's change alone."""
    cols = list(spec.columns)
    load_text = str(deleted_from if deleted_from is not None else load_ts)
    # one row per key on either side, inside the exchanges that the joins need anyway
    opened = open_versions.select(
        F.col(spec.key).alias("_key"),
        F.struct(*[F.col(c) for c in ("effective_from",) + spec.attributes + ("effective_to", "deleted_flg")]).alias("h"))
    opened = opened.groupBy("_key").agg(F.max("h").alias("h"), F.collect_set("h").alias("_same_key"))
    staged = _stage_struct(spec, stage)
    latest = F.struct(F.coalesce("s.update_dt", "s.create_dt").alias("at"), "s")
    staged = staged.groupBy("_key").agg(F.max(latest).alias("l")).select("_key", F.col("l.s").alias("s"))
    if keys is not None:
        present = (keys.select(F.col(spec.key).alias("_key")).where(F.col("_key").isNotNull())
                   .distinct().withColumn("_present", F.lit(True)))
        opened = opened.join(present, "_key", "left").withColumnRenamed("_present", "h_present")
        staged = staged.join(present, "_key", "left").withColumnRenamed("_present", "s_present")
    else:
        opened = opened.withColumn("h_present", F.lit(True))
        staged = staged.withColumn("s_present", F.lit(True))
    j = opened.join(staged, "_key", "full")

    # Per key, the versions to write, as one SQL expression (one call to build, however many
    # attributes; the plan is the same as with Column objects).
    load_sql = f"CAST('{load_text}' AS TIMESTAMP_NTZ)"
    end, before_load = f"TIMESTAMP_NTZ '{OPEN_END}'", f"{load_sql} - INTERVAL 1 DAY"
    live, deleted = f"'{FLAG_LIVE}'", f"'{FLAG_DELETED}'"
    chg_from = "coalesce(s.update_dt, s.create_dt)"  # Q10 fix: no update stamp -> create stamp
    gone = "NOT coalesce(h_present, s_present, false)"
    differs = " OR ".join(f"NOT (s.{c} <=> h.{c})" for c in spec.tracked) or "false"
    changed = f"h IS NOT NULL AND s IS NOT NULL AND (({differs}) OR h.deleted_flg = {deleted})"

    def version(src, start, stop, flag):
        fields = [f"'{spec.key}', CAST(_key AS STRING)"]
        fields += [f"'{c}', CAST({src}.{c} AS {spec.type_name(c)})" for c in spec.attributes]
        fields += [f"'effective_from', CAST({start} AS TIMESTAMP_NTZ)",
                   f"'effective_to', CAST({stop} AS TIMESTAMP_NTZ)", f"'deleted_flg', {flag}"]
        return f"named_struct({', '.join(fields)})"

    def arrays(when, then, otherwise):
        return f"CASE WHEN {when} THEN array({', '.join(then)}) ELSE array({', '.join(otherwise)}) END"

    s_new_from = f"s.{spec.new_from}"
    old_closed = version("h", "h.effective_from", f"{chg_from} - INTERVAL 1 DAY", "h.deleted_flg")
    # new key (D1), deleted at once when missing from the snapshot
    new_key = arrays(gone, [version("s", s_new_from, before_load, live), version("s", load_sql, end, deleted)],
                     [version("s", s_new_from, end, live)])
    # changed or revived (D2/D3), the new version possibly deleted at once
    new_version = arrays(gone, [old_closed, version("s", chg_from, before_load, live),
                                version("s", load_sql, end, deleted)],
                         [old_closed, version("s", chg_from, end, live)])
    # unchanged open version: kept, or deleted when live and missing from the snapshot
    kept = arrays(f"{gone} AND h.deleted_flg = {live}",
                  [version("h", "h.effective_from", before_load, "h.deleted_flg"),
                   version("h", load_sql, end, deleted)],
                  [version("h", "h.effective_from", "h.effective_to", "h.deleted_flg")])
    if repeat != "true":
        same = f"size(_same_key) <= 1 AND NOT ({gone} AND h.deleted_flg = {live}) AND NOT ({repeat})"
        kept = f"filter({kept}, v -> NOT coalesce({same}, false))"
    # further open versions of the key, left by a load that repeated it
    folded = version("o", "o.effective_from", "h.effective_from - INTERVAL 1 DAY", "o.deleted_flg")
    others = f"transform(filter(coalesce(_same_key, array()), o -> NOT (o <=> h)), o -> {folded})"
    versions = f"concat(CASE WHEN h IS NULL THEN {new_key} WHEN {changed} THEN {new_version} ELSE {kept} END, {others})"
    return j.selectExpr(f"inline({versions})").select(*cols)


# ---------------------------------------------------------------------------
# One warehouse statement each (D1-D5), over a given history.
# ---------------------------------------------------------------------------

def _select_version(spec: DimSpec, alias: str, start: Column, end: Column, flag) -> list[Column]:
    flag_col = flag if isinstance(flag, Column) else F.lit(flag)
    return [F.col(f"{alias}.{spec.key}").alias(spec.key)] + \
           [_typed(spec, alias, c).alias(c) for c in spec.attributes] + \
           [start.cast("timestamp_ntz").alias("effective_from"),
            end.cast("timestamp_ntz").alias("effective_to"), flag_col.alias("deleted_flg")]


def scd2_new(stage: DataFrame, hist: DataFrame, spec: DimSpec) -> DataFrame:
    """Stage rows whose key has no version yet, as open live versions."""
    known = hist.select(spec.key)
    fresh = stage.join(known, spec.key, "left_anti").alias("s")
    return fresh.select(*_select_version(spec, "s", F.col(f"s.{spec.new_from}"), open_end(), FLAG_LIVE))


def _with_stamps(stage: DataFrame) -> DataFrame:
    """Stage with both stamps (a terminals sheet carries only ``update_dt``)."""
    for c in ("create_dt", "update_dt"):
        if c not in stage.columns:
            stage = stage.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    return stage


def _changed_pairs(stage: DataFrame, hist: DataFrame, spec: DimSpec) -> DataFrame:
    s, h = _with_stamps(stage).alias("s"), hist.where(is_open()).alias("h")
    return s.join(h, F.col(f"s.{spec.key}") == F.col(f"h.{spec.key}"), "inner").where(
        _differs(spec, "s", "h") | (F.col("h.deleted_flg") == FLAG_DELETED))


def scd2_changed(stage: DataFrame, hist: DataFrame, spec: DimSpec) -> DataFrame:
    """New versions for stage rows that changed or revive a deleted key."""
    pairs = _changed_pairs(stage, hist, spec)
    return pairs.select(*_select_version(spec, "s", _changed_from(), open_end(), FLAG_LIVE))


def scd2_close_changed(stage: DataFrame, hist: DataFrame, spec: DimSpec) -> DataFrame:
    """D3: the open versions that a change or revival closes, with their new end."""
    pairs = _changed_pairs(stage, hist, spec)
    return pairs.select(*_select_version(spec, "h", F.col("h.effective_from"),
                                         _changed_from() - _one_day(), F.col("h.deleted_flg")))


def _gone(hist: DataFrame, keys: DataFrame, spec: DimSpec) -> DataFrame:
    live = hist.where(is_open() & (F.col("deleted_flg") == FLAG_LIVE))
    return live.join(keys.select(spec.key), spec.key, "left_anti").alias("h")


def scd2_deleted(hist: DataFrame, keys: DataFrame, spec: DimSpec, load_ts) -> DataFrame:
    """A ``'Y'`` version for every open live version whose key left the snapshot."""
    return _gone(hist, keys, spec).select(
        *_select_version(spec, "h", _ts(load_ts), open_end(), FLAG_DELETED))


def scd2_close_deleted(hist: DataFrame, keys: DataFrame, spec: DimSpec, load_ts) -> DataFrame:
    """Those live versions, ended one day before the load."""
    return _gone(hist, keys, spec).select(
        *_select_version(spec, "h", F.col("h.effective_from"), _ts(load_ts) - _one_day(),
                         F.col("h.deleted_flg")))


def current_versions(hist: DataFrame, live_only: bool = False) -> DataFrame:
    """Open versions (optionally only live ones)."""
    out = hist.where(is_open())
    return out.where(F.col("deleted_flg") == FLAG_LIVE) if live_only else out


def revived(stage: DataFrame, hist: DataFrame, spec: DimSpec) -> DataFrame:
    """Stage rows that bring back a key whose open version is deleted."""
    h = hist.where(is_open() & (F.col("deleted_flg") == FLAG_DELETED)).select(spec.key)
    return stage.join(h, spec.key, "left_semi")


def empty_history(spark, spec: DimSpec) -> DataFrame:
    return spark.createDataFrame([], spec.history_schema())
