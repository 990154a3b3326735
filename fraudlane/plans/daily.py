"""The daily run: stage the drops and extracts, load history and facts, advance the marks,
publish the load, build and publish the report.

Storage is plain Parquet under one warehouse root on shared storage. Every table is
partitioned by ``load_id`` and ``run``, and each run of a load writes only its own ``load_id=N/run=K`` folders, so
a failed run is simply run again. Readers see only the runs that the commit log names (``commits.py``): it is
written in two steps, after the load (history, facts, marks) and after the report (K7). Of two writers of one
load, or of two loads that started from the same state, one commits and the other gets an error; what it
has written lies in folders of its own that nobody reads. A run reads the state of the
loads before it, never its own output. Stages and key snapshots are written first, and all steps
of the load read these copies, so a source that moves on meanwhile can't outrun its mark.

Dimensions are stored as ``dim_<name>/load_id=N/run=K/state=open|closed/bucket=B``: each load writes the versions it closed
and the open versions it made, not those it left as they were. The open version of a key is the one of the latest load
that wrote one: a key once seen always has one, as a deletion opens a version too. So that a reader doesn't go through all loads, each
key-hash bucket has a base: the load that last wrote all of the bucket's open versions. Once the versions written since are
more than ``COMPACT_RATIO`` of those in the base, the next load writes the bucket whole and becomes its base. A table of
the buckets (base, rows in it, rows since) is written by each load; what a reader sees is that of the
latest published load, so a load that stops before it is published changes nothing.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.facts import new_blacklist, new_transactions
from ..operators.id_filters import FILTER_DDL, build_filter, possible_loads
from ..operators.report import fraud_mart
from ..operators.scd2 import empty_history, is_open, scd2_step
from ..operators.watermark import advance_mark, advance_terminals_mark, read_mark, seed_marks
from ..schemas import DIMENSIONS, FACT_BLACKLIST, FACT_TRANSACTIONS, META, REPORT, TRANSACTIONS_FILE
from ..sources.bank_fixture import BankTables
from ..sources.extracts import incremental_extract, key_snapshot
from ..operators.lags import seconds_of
from ..operators.rules import CITY_HOP, PROBE
from ..sources.files import archive_files, stage_blacklist, stage_terminals
from .commits import CommitLog

#: CAUGHT_UP marks a load without a report of its own whose facts a later load's report has covered.
LOAD, REPORTED, CAUGHT_UP = "load", "report", "caught_up"
ID_FILTERS = "ids_transactions"
#: Key-hash buckets of a dimension, and the rows written since a bucket's base, as a share of the base, that have it written whole again.
BUCKETS, COMPACT_RATIO = 8, 0.5
BUCKET_DDL = "bucket int, base int, base_rows long, later_rows long"
DROP_FILES = StructType([StructField("file", StringType()), StructField("archive_dir", StringType())])


def ddl(schema, *partitions: str) -> str:
    """The DDL of a table's columns followed by those of its folders."""
    known = {p.split()[0] for p in partitions if p}
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields if f.name not in known]
    return ", ".join(columns + [p for p in partitions if p])


class Warehouse:
    """Published, load-partitioned Parquet tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/published")
        self.run, self._seen = 1, None  # this writer's run of its load, and the last commit it goes by
        self._commits = None  # (load_id, phase) -> run, read once and refreshed on publish

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str, schema: str | None = None) -> DataFrame | None:
        """The table, or None if its folder doesn't exist; any other error is raised. With a
        schema a table whose loads are all empty (no Parquet file yet) reads as empty."""
        try:
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.parquet(self._path(table))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _published_table(self, table: str, schema: str) -> DataFrame:
        df = self._read(table, schema)
        if df is None:
            raise FileNotFoundError(f"{self._path(table)} is missing although loads are published")
        return df

    def published(self, phase: str, before: int | None = None) -> list[int]:
        """Load ids published for ``phase`` (a handful of metadata rows)."""
        if self._commits is None:
            self._commits = {(e["load_id"], e["phase"]): e["run"] for e in self.log.entries(self._seen)}
        return sorted(i for i, p in self._commits if p == phase and (before is None or i < before))

    def begin(self, load_id: int) -> None:
        """Start a run of a load: from here on this writer goes by the commits made so far, and its folders are the run's."""
        self._seen, self._commits = self.log.last(), None
        self.run = self.log.claim(load_id)

    def _folder(self, table: str, load_id: int) -> str:
        return f"{self._path(table)}/load_id={load_id}/run={self.run}"

    def _committed(self, ids: list[int], phase: str = LOAD) -> Column:
        """The folders of the loads' committed runs: nearly always the first run of each."""
        self.published(phase)
        by_run = {}
        for i in ids:
            by_run.setdefault(self._commits[i, phase], []).append(i)
        held = [(F.col("run") == run) & F.col("load_id").isin(loads) for run, loads in sorted(by_run.items())]
        return F.col("load_id").isin(ids) & reduce(lambda a, b: a | b, held)

    def _loads(self, table: str, schema, ids: list[int], partitions: str = "", phase: str = LOAD) -> DataFrame:
        if not ids:
            return self.spark.createDataFrame([], schema)
        df = self._published_table(table, ddl(schema, "load_id int", "run int", partitions))
        return df.where(self._committed(ids, phase))

    def fact(self, name: str, before: int | None = None, since_day=None) -> DataFrame:
        """A fact; transactions lie in folders by day, and ``since_day`` reads only those from that day on."""
        schema = {"fact_transactions": FACT_TRANSACTIONS, "fact_passport_blacklist": FACT_BLACKLIST}[name]
        ids = self.published(LOAD, before)
        df = self._loads(name, schema, ids, "trans_day date" if name == "fact_transactions" else "")
        if since_day is not None and ids:
            df = df.where(F.col("trans_day") >= F.lit(str(since_day)).cast("date"))
        return df.select(*schema.names)

    def write_id_filter(self, load_id: int) -> None:
        """The filter of the transaction ids that a load has written, beside its facts."""
        written = self.spark.read.schema(FACT_TRANSACTIONS).parquet(self._folder("fact_transactions", load_id))
        self.write(build_filter(written, "trans_id"), ID_FILTERS, load_id)

    def loads_that_may_hold(self, ids: DataFrame, key: str, load_id: int) -> list[int]:
        """The loads before ``load_id`` whose transactions may hold one of the ids: those whose filter lets
        one pass, and those without a filter. Load ids and segment numbers reach the driver."""
        before = self.published(LOAD, load_id)
        if not before or self._read(ID_FILTERS, f"{FILTER_DDL}, load_id int, run int") is None:
            return before
        filters = self._published_table(ID_FILTERS, f"{FILTER_DDL}, load_id int, run int").where(self._committed(before)).drop("run")
        known = filters.select("load_id", "segments").distinct().collect()
        if not known:
            return before
        pairs = possible_loads(ids, key, filters, sorted({r.segments for r in known}))
        passed = {r.load_id for r in pairs.select("load_id").distinct().collect()}
        return sorted(passed | (set(before) - {r.load_id for r in known}))

    def transactions_of(self, load_ids: list[int]) -> DataFrame:
        """The transactions of some published loads; no other load's folder is listed in the plan's scan."""
        return self._loads("fact_transactions", FACT_TRANSACTIONS, load_ids, "trans_day date").select(*FACT_TRANSACTIONS.names)

    def _versions(self, dim: str, ids: list[int], state: str) -> DataFrame:
        spec = DIMENSIONS[dim]
        df = self._published_table(f"dim_{dim}", ddl(spec.history_schema(), "load_id int", "run int", "state string", "bucket int"))
        return df.where(self._committed(ids) & (F.col("state") == state))

    def buckets(self, dim: str, before: int | None = None) -> list:
        """The dimension's buckets (bucket, base, base_rows, later_rows) after the latest published load: BUCKETS rows."""
        ids = self.published(LOAD, before)
        if not ids:
            return []
        table = self._published_table(f"dim_{dim}_buckets", f"{BUCKET_DDL}, load_id int, run int")
        return table.where(self._committed(ids[-1:])).collect()

    def open_versions(self, dim: str, before: int | None = None) -> DataFrame:
        """One version per key: that of the latest load since its bucket's base. Earlier folders aren't listed in the scan."""
        spec = DIMENSIONS[dim]
        ids = self.published(LOAD, before)
        if not ids:
            return empty_history(self.spark, spec)
        buckets = self.buckets(dim, before)
        df = self._versions(dim, [i for i in ids if i >= min(b.base for b in buckets)], "open")
        since = None
        for base in sorted({b.base for b in buckets}):
            held = F.col("bucket").isin([b.bucket for b in buckets if b.base == base]) & (F.col("load_id") >= base)
            since = held if since is None else since | held
        latest = F.rank().over(Window.partitionBy(spec.key).orderBy(F.col("load_id").desc()))  # rows of one load stay together
        return df.where(since).withColumn("_latest", latest).where(F.col("_latest") == 1).select(*spec.columns)

    def history(self, dim: str, before: int | None = None) -> DataFrame:
        spec = DIMENSIONS[dim]
        ids = self.published(LOAD, before)
        if not ids:
            return empty_history(self.spark, spec)
        return self._versions(dim, ids, "closed").select(*spec.columns).unionByName(self.open_versions(dim, before))

    def write_versions(self, dim: str, load_id: int, stage: DataFrame, keys: DataFrame, load_ts, deleted_from=None) -> None:
        """K4: the versions that the load closes and opens, whole buckets where they are due, and the table of the buckets."""
        spec, earlier = DIMENSIONS[dim], {b.bucket: b for b in self.buckets(dim, before=load_id)}
        due = [k for k in range(BUCKETS) if k not in earlier or earlier[k].later_rows > COMPACT_RATIO * earlier[k].base_rows]
        bucket = f"pmod(xxhash64(cast({{}} AS string)), {BUCKETS})"
        repeat = f"{bucket.format('_key')} IN ({', '.join(map(str, due))})" if due else "false"
        step = scd2_step(self.open_versions(dim, before=load_id), stage, keys, spec, load_ts, deleted_from, repeat)
        rows = step.withColumn("state", F.when(is_open(), F.lit("open")).otherwise(F.lit("closed")))
        rows = rows.withColumn("bucket", F.expr(bucket.format(spec.key)).cast("int"))
        self.write(rows.hint("rebalance", F.col("state"), F.col("bucket")), f"dim_{dim}", load_id, ["state", "bucket"])

        written = self.spark.read.schema(ddl(spec.history_schema(), "state string", "bucket int")).parquet(self._folder(f"dim_{dim}", load_id))
        n = {r.bucket: r.n for r in written.where("state = 'open'").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
        after = [(k, load_id, n.get(k, 0), 0) if k in due else (k, earlier[k].base, earlier[k].base_rows, earlier[k].later_rows + n.get(k, 0))
                 for k in range(BUCKETS)]
        self.write(self.spark.createDataFrame(after, BUCKET_DDL).coalesce(1), f"dim_{dim}_buckets", load_id)

    def meta(self, before: int | None = None) -> DataFrame:
        ids = self.published(LOAD, before)
        return self._loads("meta", META, ids[-1:]).select(*META.names)

    def report(self, before: int | None = None) -> DataFrame:
        return self._loads("rep_fraud", REPORT, self.published(REPORTED, before), phase=REPORTED).select(*REPORT.names)

    def unreported(self, before: int) -> list[int]:
        """Loads before ``before`` that are published but that no report covers yet."""
        covered = {*self.published(REPORTED), *self.published(CAUGHT_UP)}
        return [i for i in self.published(LOAD, before) if i not in covered]

    def first_transaction(self, ids: list[int]):
        """The earliest transaction time of some loads, or None; only their folders are read."""
        return self._loads("fact_transactions", FACT_TRANSACTIONS, ids, "trans_day date").agg(F.min("trans_date")).first()[0]

    def drop_files(self, ids: list[int]) -> list[tuple[str, str]]:
        """(file, archive folder) of the drops of some loads: a few names each."""
        if not ids or self._read("drop_files", ddl(DROP_FILES, "load_id int", "run int")) is None:
            return []
        return [(r.file, r.archive_dir) for r in self._loads("drop_files", DROP_FILES, ids).select("file", "archive_dir").collect()]

    def write(self, df: DataFrame, table: str, load_id: int, partition_by=None) -> None:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
        w.parquet(self._folder(table, load_id))

    def stage(self, df: DataFrame, table: str, load_id: int) -> DataFrame:
        """K1/K2: ``df`` written as this load's staging table and read back, so that whatever is loaded and
        whatever the marks see are the same rows, and the source is read once."""
        self.write(df, table, load_id)
        return self.spark.read.schema(df.schema).parquet(self._folder(table, load_id))

    def publish(self, load_id: int, phase: str, of: int | None = None) -> None:
        """Commit a phase of a load, as the next after the commits that this writer goes by. Fenced or Conflict if another
        writer has started the load (or, for a caught-up one, the load ``of`` that covers it) or committed since."""
        begun = self._seen is not None
        if begun:
            self.log.check(load_id if of is None else of, self.run)
        number = self.log.append({"load_id": load_id, "phase": phase, "run": self.run}, self._seen if begun else self.log.last())
        self._seen, self._commits = number if begun else None, None


@dataclass
class DayDrop:
    """One business day's inputs: the three files (already read) and the source tables."""

    business_date: str
    load_ts: str
    report_dt: str
    transactions: DataFrame  # text rows of the transactions file
    terminals: DataFrame  # raw terminals sheet rows
    blacklist: DataFrame  # raw blacklist sheet rows
    cards: DataFrame  # source tables: current state with create/update stamps
    accounts: DataFrame
    clients: DataFrame
    files: tuple[str, ...] = ()  # the drop files behind the three, moved to archive_dir once the report is published
    archive_dir: str | None = None


def _together(steps: list) -> list:
    """The results of steps that don't read each other's output, run side by side: most of them are short jobs that leave cores
    idle. If one fails, the others end first and the error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def _load_phase(wh: Warehouse, load_id: int, drop: DayDrop) -> None:
    """Stage, load history and facts, advance the marks, publish (the first commit)."""
    # staging and marks (state as of the loads before this one); everything below reads the staged copies
    meta = seed_marks(wh.meta(before=load_id))
    extracted = ("cards", "accounts", "clients")

    def extract(dim: str) -> DataFrame:
        mark = read_mark(meta, f"stg_{dim}")
        return wh.stage(incremental_extract(getattr(drop, dim), dim, mark), f"stg_{dim}", load_id)

    staged = _together([
        lambda: wh.stage(drop.transactions.select(*TRANSACTIONS_FILE.names), "stg_transactions", load_id),
        lambda: wh.stage(stage_terminals(drop.terminals, drop.business_date), "stg_terminals", load_id),
        lambda: wh.stage(stage_blacklist(drop.blacklist), "stg_blacklist", load_id),
        *[lambda dim=dim: extract(dim) for dim in extracted],
        *[lambda dim=dim: wh.stage(key_snapshot(getattr(drop, dim), dim), f"stg_keys_{dim}", load_id) for dim in extracted]])
    transactions, terminals, blacklist = staged[:3]
    stages = {"terminals": terminals, **dict(zip(extracted, staged[3:6]))}
    keys = {"terminals": terminals.select("terminal_id"), **dict(zip(extracted, staged[6:]))}

    def load_history(dim: str) -> None:
        """One pass over the dimension's open versions."""
        wh.write_versions(dim, load_id, stages[dim], keys[dim], drop.load_ts, drop.business_date if dim == "terminals" else None)

    def load_transactions() -> None:
        """Insert-only: only loads that may hold a staged id are read. By day: gathered by day first, so that the files of a day follow
        its bytes and not the tasks (AQE splits a crowded day again)."""
        earlier = wh.loads_that_may_hold(transactions, "trans_id", load_id)
        fresh = new_transactions(transactions, wh.transactions_of(earlier))
        by_day = fresh.withColumn("trans_day", F.to_date("trans_date")).hint("rebalance", F.col("trans_day"))
        wh.write(by_day, "fact_transactions", load_id, partition_by="trans_day")
        wh.write_id_filter(load_id)

    def load_blacklist() -> None:
        wh.write(new_blacklist(blacklist, wh.fact("fact_passport_blacklist", before=load_id)), "fact_passport_blacklist", load_id)

    _together([load_transactions, load_blacklist, *[lambda dim=dim: load_history(dim) for dim in DIMENSIONS]])

    for dim in extracted:
        meta = advance_mark(meta, f"stg_{dim}", stages[dim])
    meta = advance_terminals_mark(meta, stages["terminals"], drop.business_date)
    wh.write(meta, "meta", load_id)
    if drop.files and drop.archive_dir:
        named = wh.spark.createDataFrame([(f, drop.archive_dir) for f in drop.files], DROP_FILES)
        wh.write(named.coalesce(1), "drop_files", load_id)
    wh.publish(load_id, LOAD)


def _first_day(report_since, probe_window, city_window):
    """The first day whose facts a report since that time reads: one rule horizon earlier."""
    if report_since is None:
        return None
    horizon = max(seconds_of(probe_window or PROBE), seconds_of(city_window or CITY_HOP))
    return (datetime.fromisoformat(str(report_since)) - timedelta(seconds=horizon)).date()


def run_day(wh: Warehouse, load_id: int, drop: DayDrop, probe_window=None, city_window=None,
            report_since=None, versions: str = "all") -> None:
    """Steps 0-9 of the daily run for ``load_id``. A published load is never loaded again: a re-run goes
    on with what is missing (the report, or nothing), and an id below a published one is refused. If another writer starts the
    same load or commits any other one meanwhile, this run ends with ``Fenced`` or ``Conflict`` and changes nothing.

    ``report_since`` limits the report to transactions from then on (facts are read from one
    rule horizon earlier), but reaches back to the first transaction of any earlier load whose own report failed: this report then
    covers that load too, and its drop files are archived with this one's. By default the whole history is re-reported each day (Q4).
    ``versions`` is passed to the report ('all', 'current' or 'as_of')."""
    wh.begin(load_id)
    latest = max(wh.published(LOAD), default=None)
    if latest is not None and load_id < latest:
        raise ValueError(f"load {load_id} is older than the published load {latest}")
    if load_id in wh.published(REPORTED):
        archive_files(wh.spark, drop.files, drop.archive_dir)  # what a run that stopped in between left
        return
    if load_id != latest:
        _load_phase(wh, load_id, drop)

    missed = wh.unreported(load_id)
    if report_since is not None and missed and (first := wh.first_transaction(missed)) is not None:
        report_since = str(min(datetime.fromisoformat(str(report_since)), first))

    # report over everything published so far, appended without repeats (second commit)
    # open versions are all a 'current' report needs; 'all' and 'as_of' read the history
    dim = wh.open_versions if versions == "current" else wh.history
    tables = BankTables(
        fact_transactions=wh.fact("fact_transactions", since_day=_first_day(report_since, probe_window, city_window)),
        fact_passport_blacklist=wh.fact("fact_passport_blacklist"),
        dim_terminals_hist=dim("terminals"), dim_cards_hist=dim("cards"),
        dim_accounts_hist=dim("accounts"), dim_clients_hist=dim("clients"))
    kwargs = {}
    if probe_window is not None:
        kwargs["probe_window"] = probe_window
    if city_window is not None:
        kwargs["city_window"] = city_window
    rows = fraud_mart(tables, drop.report_dt, wh.report(before=load_id), versions=versions,
                      since=report_since, **kwargs)
    wh.write(rows, "rep_fraud", load_id, partition_by="report_dt")
    wh.publish(load_id, REPORTED)
    for skipped in missed:
        wh.publish(skipped, CAUGHT_UP, of=load_id)
    archive_files(wh.spark, drop.files, drop.archive_dir)
    for file, archive_dir in wh.drop_files(missed):
        archive_files(wh.spark, [file], archive_dir)
