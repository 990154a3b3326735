"""The four fraud rules and their priority classification.

1. passport expired before the transaction, or the passport is blacklisted;
2. the account contract expired before the transaction;
3. the client's previous transaction (any card) was in another city less than an hour ago;
4. on one card and operation type, three falling-amount rejects followed by a success with a
   still lower amount, first to last within twenty minutes (PAYMENT or WITHDRAW).

Rules 3 and 4 are evaluated on rows, but like the source system's ``trans_id IN (...)``
they flag every copy of a transaction once any copy matches (copies appear when a
dimension key has several versions). The lags read the few columns the two rules need; what
they leave is a small table of flagged ids, which the whole rows then meet without being shuffled by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.bloom import bits_for, filter_value, may_hold
from ..schemas import CITY_HOP_WINDOW, OPER_REJECT, OPER_SUCCESS, PROBE_OPER_TYPES, PROBE_WINDOW
from .enrich import VERSION_ORDER
from ..session import written
from .lags import TASK_ROWS, dealt, home_rows, joint_lags, measured_slices, seconds_of, split_with_horizon

CITY_HOP = CITY_HOP_WINDOW
PROBE = PROBE_WINDOW
#: Flagged ids that are sent to all tasks (some 30 MB); beyond that a filter of them is.
BROADCAST_IDS = 500_000
#: Tasks over which the rows of a crowded id are spread beyond that number.
ID_SALTS = 16
#: Hash buckets in which the rows of all ids are counted, and the rows that make all ids of a bucket crowded ones.
ID_BUCKETS, CROWD_ROWS = 1 << 16, TASK_ROWS // 4
#: With more flagged ids than this share of the rows no filter is built: most rows would pass it.
FILTER_SHARE = 0.1
CLIENT_LAGS = {"prev_time": ("trans_date", 1), "prev_city": ("terminal_city", 1)}
CARD_LAGS = {f"{name}_back_{k}": (c, k) for k in (1, 2, 3) for name, c in (("time", "trans_date"), ("amt", "amt"), ("result", "oper_result"))}


def interval(td) -> Column:
    return F.expr(f"INTERVAL '{seconds_of(td)}' SECOND")


def _order_columns(df: DataFrame) -> list[str]:
    return ["trans_date", "trans_id"] + [c for c in VERSION_ORDER if c in df.columns]


def window_order(df: DataFrame) -> list[Column]:
    """``trans_date`` then ``trans_id`` (ties), then the version stamps of fanned-out rows;
    nulls last as in the warehouse."""
    return [F.col(c).asc_nulls_last() for c in _order_columns(df)]


def passport_rule() -> Column:
    return (F.col("passport_valid_to") < F.col("trans_date")) | F.col("in_blacklist")


def contract_rule() -> Column:
    return F.col("valid_to") < F.col("trans_date")


def city_hop_rule(window=CITY_HOP) -> Column:
    return (F.col("prev_city").isNotNull()
            & (F.col("terminal_city") != F.col("prev_city"))
            & ((F.col("trans_date") - F.col("prev_time")) < interval(window)))


def amount_probe_rule(window=PROBE) -> Column:
    a, r = F.col("amt"), F.col("oper_result")
    return ((F.col("amt_back_3") > F.col("amt_back_2")) & (F.col("amt_back_2") > F.col("amt_back_1")) & (F.col("amt_back_1") > a)
            & (F.col("result_back_3") == OPER_REJECT) & (F.col("result_back_2") == OPER_REJECT)
            & (F.col("result_back_1") == OPER_REJECT) & (r == OPER_SUCCESS)
            & ((F.col("trans_date") - F.col("time_back_3")) <= interval(window))
            & F.col("oper_type").isin(*PROBE_OPER_TYPES))


def with_rule_lags(enriched: DataFrame, city_window=CITY_HOP, probe_window=PROBE,
                   slice_width=None, slice_rows=None, rows: int | None = None) -> DataFrame:
    """Add the lag columns rules 3 and 4 read.

    By default hot clients are cut into measured slices and the lags are exact; without a hot client both windows are plain
    and share one shuffle by client. The number of ``rows``, if given, bounds the rows of a task. With ``slice_width`` all clients are cut into slices of that width, and values are exact wherever
    a rule can fire: a predecessor older than the rule's horizon may read as null, which fails the rule just as the
    real (too old) value would.
    """
    if slice_width is None:
        slices = measured_slices(enriched, ["client_id"], "trans_date", slice_rows, rows)
        if slices is not None:
            windows = [((), CLIENT_LAGS), (("card_num_dim", "oper_type"), CARD_LAGS)]
            return joint_lags(enriched, ["client_id"], windows, _order_columns(enriched), "trans_date", slices, rows)
        return _lags_in(dealt(enriched, ["client_id"], rows), enriched, "")
    horizon = max(seconds_of(city_window), seconds_of(probe_window))
    x = split_with_horizon(enriched, "trans_date", horizon, slice_width)
    return home_rows(_lags_in(x, enriched, ", _slice"))


def _lags_in(x: DataFrame, enriched: DataFrame, slice_col: str) -> DataFrame:
    # the eleven lags as SQL text: one call to build, same plan as Column objects
    order = ", ".join(f"{c} ASC NULLS LAST" for c in _order_columns(enriched))
    by_client = f"OVER (PARTITION BY client_id{slice_col} ORDER BY {order})"
    by_card = f"OVER (PARTITION BY client_id, card_num_dim, oper_type{slice_col} ORDER BY {order})"
    return x.selectExpr("*", *[f"lag({c}, {k}) {by_client} AS {out}" for out, (c, k) in CLIENT_LAGS.items()],
                        *[f"lag({c}, {k}) {by_card} AS {out}" for out, (c, k) in CARD_LAGS.items()])


def rule_columns(enriched: DataFrame) -> tuple[DataFrame, int]:
    """The columns that rules 3 and 4 read, written once, and the number of rows."""
    needed = dict.fromkeys([*_order_columns(enriched), "client_id", "card_num_dim", "oper_type", "amt", "oper_result", "terminal_city"])
    counted = Observation()
    narrow = written(enriched.select(*needed).observe(counted, F.count(F.lit(1)).alias("n")), "rule-columns")
    return narrow, counted.get["n"]


def flagged_ids(narrow: DataFrame, rows: int, city_window=CITY_HOP, probe_window=PROBE, slice_width=None, slice_rows=None) -> DataFrame:
    """(trans_id, any_hop, any_probe) of the ids that rule 3 or 4 flags on any of their rows, from :func:`rule_columns`. Rows without
    an id take part as predecessors but are never flagged (``NULL IN (...)`` is never true)."""
    x = with_rule_lags(narrow, city_window, probe_window, slice_width, slice_rows, rows)
    no = F.lit(False)
    x = x.select("trans_id", F.coalesce(city_hop_rule(city_window), no).alias("any_hop"), F.coalesce(amount_probe_rule(probe_window), no).alias("any_probe"))
    x = x.where(F.col("trans_id").isNotNull() & (F.col("any_hop") | F.col("any_probe")))
    return x.groupBy("trans_id").agg(F.max("any_hop").alias("any_hop"), F.max("any_probe").alias("any_probe"))


def id_bucket() -> Column:
    return F.pmod(F.xxhash64("trans_id"), F.lit(ID_BUCKETS).cast("long"))


def crowded_buckets(ids: DataFrame, most: int = CROWD_ROWS) -> list[int]:
    """The hash buckets that hold more than ``most`` rows (or four times an even share, where that is more): every id with as
    many rows is in one of them. At most a quarter of the ID_BUCKETS numbers reach the driver, nearly always none."""
    counts = ids.where("trans_id IS NOT NULL").groupBy(id_bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "id-buckets")
    even = (counts.agg(F.sum("n")).first()[0] or 0) // ID_BUCKETS
    return [r.bucket for r in counts.where(F.col("n") > max(most, 4 * even)).collect()]


def spread_flags(rows: DataFrame, flagged: DataFrame, broadcast_ids: int = BROADCAST_IDS, ids: DataFrame | None = None,
                 n_rows: int | None = None, crowd_rows: int = CROWD_ROWS) -> DataFrame:
    """``rows`` with ``any_hop`` and ``any_probe`` of their ids, false where ``flagged`` doesn't list the id.

    The ids are written and counted first. Few are sent to all tasks. Of many, a Bloom filter is: rows it rules out have no flag
    and stay where they are, and only the others are exchanged by id. Where the number of rows (``n_rows``) is known and the
    ids are more than a share of it, all rows are exchanged, and computed once instead of once on either side of the filter. That join
    always shuffles: Spark may take the ids for small, and would send all of them to the driver and every executor.
    The rows of a crowded id (by the counts of ``ids``, a written copy of the rows' ids, or of the rows) go over several tasks."""
    counted = Observation()
    flagged = written(flagged.observe(counted, F.count(F.lit(1)).alias("n")), "flagged-ids")
    n = counted.get["n"]
    unflagged = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("any_hop", "any_probe")}
    if n <= broadcast_ids:
        return rows.join(F.broadcast(flagged), "trans_id", "left").withColumns(unflagged)
    crowded = id_bucket().isin([-1, *crowded_buckets(rows if ids is None else ids, crowd_rows)])  # -1: no bucket, but a list
    content = F.xxhash64("trans_date", "terminal", "amt", "oper_type")
    salt = F.when(F.col("trans_id").isNull(), content).when(crowded, F.pmod(content, F.lit(ID_SALTS))).otherwise(F.lit(0).cast("long"))
    salts = F.when(crowded, F.sequence(F.lit(0), F.lit(ID_SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<long>")
    by_id, tasks = ["trans_id", "_salt"], max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(n_rows or 4 * n) // TASK_ROWS))
    salted = flagged.withColumn("_salt", F.explode(salts)).repartition(tasks, *by_id).hint("merge")

    def meet(some: DataFrame) -> DataFrame:
        return some.withColumn("_salt", salt).repartition(tasks, *by_id).join(salted, by_id, "left").drop("_salt").withColumns(unflagged)

    if n_rows is not None and n > FILTER_SHARE * n_rows:
        return meet(rows)
    bits = bits_for(n)
    hit = may_hold(filter_value(flagged, "trans_id", bits), "trans_id", bits)
    rest = rows.where(~hit).withColumns({c: F.lit(False) for c in unflagged})
    return meet(rows.where(hit)).unionByName(rest)


def classify(enriched: DataFrame, city_window=CITY_HOP, probe_window=PROBE, slice_width=None, slice_rows=None,
             broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Every enriched row with ``event_type`` '1'..'4' (first matching rule) or null.

    Rules 3 and 4 flag a ``trans_id`` when any of its rows matches. Nothing makes ids unique (repeated fact
    rows may be days apart, or a key's versions belong to different clients), so the flags are those of the id, whatever
    versions were joined. They are found in a first pass over the rules' columns, and the whole rows meet the few
    flagged ids in a second one (:func:`spread_flags`): no row is exchanged by its id unless it may be flagged.
    """
    narrow, rows = rule_columns(enriched)
    flagged = flagged_ids(narrow, rows, city_window, probe_window, slice_width, slice_rows)
    x = spread_flags(enriched, flagged, broadcast_ids, narrow.select("trans_id"), rows)
    event_type = (F.when(passport_rule(), "1").when(contract_rule(), "2")
                  .when(F.col("any_hop"), "3").when(F.col("any_probe"), "4"))
    return x.withColumn("event_type", event_type)
