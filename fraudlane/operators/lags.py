"""``lag`` over per-client windows without letting one client become one task.

A plain ``Window.partitionBy('client_id')`` sends every row of a client to a single task.
One client (or the null client of unmatched cards) may own a third of all rows. So rows of a hot
client are cut into consecutive slices of its sequence that hash to different tasks. Ordering
inside the window always starts with the time column, so every slice is a contiguous run, and only the
first rows of a slice miss their predecessors.

* :func:`measured_slices` finds the slices: rows are counted per client and hour, clients with more rows than one
  task should have are cut where their running count passes multiples of that number, and hours with more
  rows than that are counted again by the second. Only those clients have slices; without any there is
  nothing to cut, and the lag is a plain window.
* :func:`exact_lags` gives the unbounded SQL ``lag`` over slices: the first ``k`` rows of a slice take
  their values from the last ``k`` rows of the preceding slices, gathered per slice (at
  most ``k`` rows each) and joined back on the slice key, which keeps the big side's
  partitioning.
* :func:`joint_lags` takes several windows of one client in one pass: the last rows of each slice are found first and are
  put before the rows of the slices that follow, so that one shuffle by client and slice serves all windows, and no
  window is computed twice or joined back.
* :func:`split_with_horizon` is for consumers that only look back a bounded time and know a width that suits
  their data. Each row is also copied into the following slices of that width
  whose start lies within the horizon, so a row's predecessors inside the horizon always
  share its slice. The copies are dropped after the window (``home_rows``). One shuffle,
  no join, duplication bounded by ``horizon / width``.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

DAY, HOUR = 86400, 3600
#: A client with no more rows than this is never cut: a window task sorts a slice and buffers it once more.
LEAST_SLICE = 250_000
#: Rows of a window task where their number is known: AQE goes by packed bytes, of which rows with lags are many times more.
TASK_ROWS = 250_000
LAST_SLICE = 2 ** 62


def seconds_of(td) -> int:
    return int(td.total_seconds()) if isinstance(td, timedelta) else int(td)


def epoch_seconds(c) -> Column:
    """Whole seconds since 1970-01-01 of a ``timestamp_ntz`` (no time zone involved)."""
    t = F.col(c) if isinstance(c, str) else c
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    return days * DAY + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def slice_width(horizon_s: int, width_s: int | None = None) -> int:
    """Default slice: one day, widened to four horizons so copies stay under a quarter."""
    return int(width_s) if width_s else max(DAY, 4 * horizon_s)


def split_with_horizon(df: DataFrame, time_col: str, horizon, width=None) -> DataFrame:
    """Add ``_slice`` (time bucket) and ``_home``; rows near a slice start are repeated.

    A row at time ``t`` lives in slice ``t // width`` and is copied into every later slice
    ``b`` with ``b * width - horizon <= t`` (one extra second of margin for fractions).
    """
    h = seconds_of(horizon)
    w = slice_width(h, seconds_of(width) if width else None)
    s = epoch_seconds(time_col)
    home = F.floor(s / F.lit(w))
    last = F.floor((s + F.lit(h + 1)) / F.lit(w))
    # a row without a time keeps one copy in the null slice (ordered last, like its time)
    return (df.withColumn("_home_slice", home)
              .withColumn("_slice", F.explode_outer(F.sequence(home, last)))
              .withColumn("_home", F.coalesce(F.col("_slice") == F.col("_home_slice"), F.lit(True)))
              .drop("_home_slice"))


def home_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("_home")).drop("_home", "_slice")


def dealt(df: DataFrame, keys, rows: int | None) -> DataFrame:
    """``df`` partitioned by ``keys`` into tasks of about ``TASK_ROWS`` rows, no fewer than the session's partitions; as it is if
    it has no more than one task's rows or nobody has counted them."""
    if rows is None or rows <= TASK_ROWS:
        return df
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS)), *keys)


def _same(left: DataFrame, right: DataFrame, columns) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def measured_slices(df: DataFrame, client_cols, time_col: str, slice_rows: int | None = None, rows: int | None = None) -> DataFrame | None:
    """(client columns, _hour, _starts): for each hour of a hot client the slices in it, as structs of first second
    and slice number by time; None if no client has more rows than ``slice_rows``. By default that is a quarter of a
    task's even share of the rows, ``LEAST_SLICE`` at least.

    A slice has at most twice ``slice_rows`` rows, but for the rows of one client in one second, which stay together.
    The counts are per client and hour, and per second only in the hot hours; the running count of a client is over these.
    Where the number of all ``rows`` is known and no more than a slice's, nothing is counted."""
    client_cols = list(client_cols)
    if rows is not None and rows <= (LEAST_SLICE if slice_rows is None else slice_rows):
        return None
    per_client = written(df.groupBy(*client_cols).agg(F.count(F.lit(1)).alias("_n")), "client-rows")
    total, most = per_client.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if slice_rows is None:
        slice_rows = max(LEAST_SLICE, total // (4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    if most <= slice_rows:
        return None
    many = per_client.where(F.col("_n") > slice_rows).drop("_n")  # the hours of the others aren't counted
    timed = df.join(many, _same(df, many, client_cols), "left_semi").select(*client_cols, epoch_seconds(time_col).alias("_second"))
    timed = timed.where("_second IS NOT NULL")
    timed = timed.withColumn("_hour", F.floor(F.col("_second") / HOUR))
    hours = written(timed.groupBy(*client_cols, "_hour").agg(F.count(F.lit(1)).alias("_n")), "client-hours")
    hot = hours.groupBy(*client_cols).agg(F.sum("_n").alias("_all")).where(F.col("_all") > slice_rows).drop("_all")
    hours = hours.join(hot, _same(hours, hot, client_cols), "left_semi")
    crowded = hours.where(F.col("_n") > slice_rows).drop("_n")
    seconds = timed.join(crowded, _same(timed, crowded, [*client_cols, "_hour"]), "left_semi").groupBy(*client_cols, "_hour", "_second").agg(F.count(F.lit(1)).alias("_n"))
    whole = hours.where(F.col("_n") <= slice_rows).withColumn("_second", F.col("_hour") * HOUR)
    units = whole.unionByName(seconds)
    before = Window.partitionBy(*client_cols).orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    cut = units.withColumn("_slice", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / slice_rows))
    first = cut.groupBy(*client_cols, "_hour", "_slice").agg(F.min("_second").alias("_second"))
    starts = F.sort_array(F.collect_list(F.struct("_second", "_slice"))).alias("_starts")
    return written(first.groupBy(*client_cols, "_hour").agg(starts), "slices")


def with_slices(df: DataFrame, client_cols, time_col: str, slices: DataFrame) -> DataFrame:
    """Add ``_slice``: the measured slice of a hot client's row, 0 for other clients, and a last slice for rows without a
    time, which sort after every dated one."""
    x = df.withColumns({"_second": epoch_seconds(time_col), "_hour": F.floor(epoch_seconds(time_col) / HOUR)})
    found = slices.select(*[F.col(c).alias(f"_of_{k}") for k, c in enumerate(client_cols)], F.col("_hour").alias("_of_hour"), "_starts")
    on = reduce(lambda a, b: a & b, [x[c].eqNullSafe(found[f"_of_{k}"]) for k, c in enumerate(client_cols)] + [x["_hour"] == found["_of_hour"]])
    begun = F.filter("_starts", lambda s: s["_second"] <= F.col("_second"))
    number = F.coalesce(F.try_element_at(begun, F.lit(-1))["_slice"], F.lit(0).cast("long"))
    return (x.join(found, on, "left").withColumn("_slice", F.when(F.col("_second").isNull(), F.lit(LAST_SLICE)).otherwise(number))
            .drop("_second", "_hour", "_starts", *found.columns))


def exact_lags(df: DataFrame, partition_cols, order_cols, specs: dict, time_col: str,
               width=None, slices: DataFrame | None = None, client_cols=("client_id",), slice_rows: int | None = None,
               rows: int | None = None) -> DataFrame:
    """Add ``lag(col, k)`` columns (``specs = {out: (col, k)}``) over
    ``partition_cols`` ordered by ``order_cols`` (which must start with ``time_col``).

    Equal to ``F.lag(col, k).over(Window.partitionBy(*partition_cols).orderBy(*order_cols))``
    but a hot partition is spread over its slices: those of ``slices`` (a table of :func:`measured_slices` by ``client_cols``,
    which are among the partition columns), or of a fixed ``width``; by default they are measured here. With the number of
    ``rows`` the slices are dealt to tasks of bounded size.
    """
    if width is None and slices is None:
        slices = measured_slices(df, client_cols, time_col, slice_rows)
        if slices is None:
            w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
            return df.select("*", *[F.lag(c, k).over(w).alias(out) for out, (c, k) in specs.items()])
    kmax = max(k for _, k in specs.values())
    values = sorted({c for c, _ in specs.values()})
    x = df.withColumn("_pkey", F.struct(*[F.col(p) for p in partition_cols]))
    if slices is not None:
        x = with_slices(x, client_cols, time_col, slices)
    else:
        # rows without a time sort after every dated row: give them a slice after all real ones
        # (a null slice could not join its carry back)
        x = x.withColumn("_slice", F.coalesce(F.floor(epoch_seconds(time_col) / F.lit(seconds_of(width))), F.lit(LAST_SLICE)))
    x = dealt(x, ["_pkey", "_slice"], rows)
    part = Window.partitionBy("_pkey", "_slice")
    w = part.orderBy(*order_cols)
    # a slice's last kmax rows are those with no row kmax further on: no count, which would buffer the slice
    x = x.select("*", F.row_number().over(w).alias("_rn"), F.lead(F.lit(1), kmax).over(w).isNull().alias("_last"),
                 *[F.lag(c, k).over(w).alias(out) for out, (c, k) in specs.items()])
    # last kmax rows of every slice (bounded), then the kmax slices before each slice
    tails = (x.where("_last")
              .groupBy("_pkey", "_slice")
              .agg(F.sort_array(F.collect_list(F.struct("_rn", *values))).alias("_tail")))
    before = Window.partitionBy("_pkey").orderBy("_slice").rowsBetween(-kmax, -1)
    carry = tails.select("_pkey", "_slice",
                         F.flatten(F.collect_list("_tail").over(before)).alias("_carry"))
    x = x.join(carry, ["_pkey", "_slice"], "left")
    fixed = []
    for out, (c, k) in specs.items():
        from_carry = F.try_element_at(F.col("_carry"), (F.col("_rn") - k - 1).cast("int"))[c]
        fixed.append(F.when(F.col("_rn") <= k, from_carry).otherwise(F.col(out)).alias(out))
    helpers = {"_pkey", "_slice", "_rn", "_last", "_carry"}
    keep = [c for c in x.columns if c not in specs and c not in helpers]
    return x.select(*keep, *fixed)


def joint_lags(df: DataFrame, client_cols, windows, order: list[str], time_col: str, slices: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with the lags of several windows over the slices of :func:`measured_slices`: ``windows`` lists (further partition
    columns, ``specs`` as in :func:`exact_lags`), ``order`` the names of the order columns, which start with ``time_col``.

    The last rows of each slice of a hot client are found on the finest partition, as those of a coarser one are among them, and the
    last ``k`` before a slice are repeated in it for the window that needs them. The repeated rows go once the lags are
    taken; a slice has at most ``k`` of them for each of a window's partitions in it."""
    client_cols, own = list(client_cols), df.columns
    hot = slices.select(*client_cols).distinct().withColumn("_hot", F.lit(True)).toDF(*[f"_hot_{c}" for c in client_cols], "_hot")
    x = with_slices(df, client_cols, time_col, slices)
    x = x.join(hot, reduce(lambda a, b: a & b, [x[c].eqNullSafe(hot[f"_hot_{c}"]) for c in client_cols]), "left")
    x = x.select(*own, F.xxhash64(*client_cols).alias("_pkey"), F.when(F.col("_hot"), F.col("_slice")).otherwise(F.lit(0)).alias("_slice"),
                 F.coalesce("_hot", F.lit(False)).alias("_hot"))
    ascending = [F.col(c).asc_nulls_last() for c in order]
    descending = [F.col(c).desc_nulls_first() for c in order]
    further = list(dict.fromkeys(c for cols, _ in windows for c in cols))
    deepest = max(k for _, specs in windows for _, k in specs.values())

    def last_rows(of: DataFrame, cols, k: int) -> DataFrame:
        w = Window.partitionBy("_pkey", *client_cols, "_slice", *cols).orderBy(*descending)
        return of.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= k)

    ends = written(last_rows(x.where("_hot").drop("_hot"), further, deepest).drop("_back"), "slice-ends")
    x = x.select(*own, "_pkey", "_slice", F.lit(None).cast("int").alias("_for"))
    for m, (cols, specs) in enumerate(windows):
        k, part = max(k for _, k in specs.values()), ["_pkey", *client_cols, *cols]
        tail = F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("_at"), *own))).alias("_tail")
        tails = last_rows(ends, cols, k).groupBy(*[F.col(c).alias(f"_part_{c}") for c in part], "_slice").agg(tail)
        before = Window.partitionBy(*[f"_part_{c}" for c in part]).orderBy("_slice").rowsBetween(-k, -1)
        carry = tails.select(F.col("_part__pkey").alias("_pkey"), "_slice", F.flatten(F.collect_list("_tail").over(before)).alias("_carry"))
        carry = carry.select("_pkey", "_slice", F.explode(F.slice("_carry", F.greatest(F.size("_carry") - (k - 1), F.lit(1)), k)).alias("_row"))
        x = x.unionByName(carry.select(*[F.col("_row")[c].alias(c) for c in own], "_pkey", "_slice", F.lit(m).alias("_for")))
    x = dealt(x, ["_pkey", "_slice"], rows)
    lags = []
    for m, (cols, specs) in enumerate(windows):
        theirs = F.col("_for").isNull() | (F.col("_for") == m)
        w = Window.partitionBy("_pkey", *client_cols, "_slice", *cols, F.coalesce(theirs, F.lit(False))).orderBy(*ascending)
        lags += [F.lag(c, k).over(w).alias(out) for out, (c, k) in specs.items()]
    return x.select("*", *lags).where("_for IS NULL").drop("_pkey", "_slice", "_for")
