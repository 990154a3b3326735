"""Transaction enrichment: fact -> card -> account -> client, and -> terminal.

The source system's chain joins the big fact three times in a row (card, then account,
then client). All three right-hand sides are dimensions, and each later join condition only
refers to the previous dimension, so the chain is re-associated: the dimensions are joined
to each other first (a "card profile", dimension-sized) and the fact is joined once.
``(F ⟕ C) ⟕ A = F ⟕ (C ⟕ A)`` holds because ``trim(A.account_num) = trim(C.account_num)``
rejects nulls on ``C``. The blacklist membership is a client attribute, so it is resolved
on the profile too. The fact therefore crosses one join on the card key (broadcast by AQE
when the profile measures under the threshold, sort-merge otherwise, skew-split by AQE)
plus a join to the terminals.

``versions`` picks the dimension versions a transaction meets:

* ``'all'`` keeps every version, as the source system's report does (a key with history
  fans a transaction out);
* ``'current'`` joins only open versions;
* ``'as_of'`` joins the version valid at the transaction's time. A version is valid from
  its ``effective_from`` until the next version of the key starts (``effective_to`` is not
  used: it leaves a day's hole between versions). The chain is still resolved on the
  dimension side: profile rows carry the intersection of their card, account and client
  validity, and the fact joins on the card key plus "time within the interval".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skew import SPREAD, null_spread
from ..schemas import OPEN_END, ts_lit

VERSION_ORDER = ("card_version", "account_version", "client_version", "terminal_version")
VERSIONS = ("all", "current", "as_of")


def _versions(dim: DataFrame, versions: str) -> DataFrame:
    if versions in ("all", "as_of"):
        return dim
    if versions == "current":
        return dim.where(F.col("effective_to") == ts_lit(OPEN_END))
    raise ValueError(f"versions must be one of {VERSIONS}, not {versions!r}")


def _order() -> list[Column]:
    # a version that ended before it started (same-day change) sorts first and gets an
    # empty interval
    return [F.col("effective_from").asc_nulls_first(), F.col("effective_to").asc_nulls_last()]


def _validity(df: DataFrame, key: str, prefix: str, placeholder: bool) -> DataFrame:
    """``{prefix}_from`` / ``{prefix}_until``: when each version of ``key`` is in effect (until
    the next version starts; null = unbounded). With ``placeholder`` a key also gets a
    null-attribute row valid before its first version, so an interval left join keeps the
    left row there."""
    w = Window.partitionBy(key).orderBy(*_order())
    v = df.select("*", F.col("effective_from").alias(f"{prefix}_from"),
                  F.lead("effective_from").over(w).alias(f"{prefix}_until"))
    if placeholder:
        first = (v.groupBy(key).agg(F.min(f"{prefix}_from").alias(f"{prefix}_until"))
                  .withColumn(f"{prefix}_from", F.lit(None).cast("timestamp_ntz")))
        v = v.unionByName(first, allowMissingColumns=True)
    return v.drop("effective_from", "effective_to")


def _overlaps(a: str, b: str) -> Column:
    """Intervals ``[a_from, a_until)`` and ``[b_from, b_until)`` meet (null = unbounded)."""
    af, au, bf, bu = (F.col(f"{a}_from"), F.col(f"{a}_until"), F.col(f"{b}_from"), F.col(f"{b}_until"))
    return (af.isNull() | bu.isNull() | (af < bu)) & (bf.isNull() | au.isNull() | (bf < au))


def _intersect(out: str, a: str, b: str) -> list[Column]:
    """Intersection of two intervals (a null bound is unbounded; b may be missing)."""
    af, au, bf, bu = (F.col(f"{a}_from"), F.col(f"{a}_until"), F.col(f"{b}_from"), F.col(f"{b}_until"))
    start = F.when(bf.isNull(), af).when(af.isNull(), bf).otherwise(F.greatest(af, bf))
    until = F.when(bu.isNull(), au).when(au.isNull(), bu).otherwise(F.least(au, bu))
    return [start.alias(f"{out}_from"), until.alias(f"{out}_until")]


def _interval_join(left: DataFrame, right: DataFrame, key: str, lp: str, rp: str, out: str) -> DataFrame:
    """``left ⟕ right`` on ``key`` where their intervals meet; the row's interval becomes
    the intersection (named ``out``). Equi-join on the key plus a residual condition."""
    r = right.withColumnRenamed(key, "_rkey")
    j = left.join(r, (F.col(key) == F.col("_rkey")) & _overlaps(lp, rp), "left").drop("_rkey")
    bounds = {f"{p}_{e}" for p in (lp, rp) for e in ("from", "until")}
    return j.select(*[c for c in j.columns if c not in bounds], *_intersect(out, lp, rp))


def card_profile(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 blacklist: DataFrame | None = None, versions: str = "all") -> DataFrame:
    """Card, account and client attributes keyed by the trimmed card number;
    ``in_blacklist`` is true when the client's passport is blacklisted. Under ``'as_of'``
    every row also carries ``valid_from`` / ``valid_until``."""
    as_of = versions == "as_of"
    c = _versions(cards, versions).select(
        F.trim("card_num").alias("card_key"), F.col("card_num").alias("card_num_dim"),
        F.trim("account_num").alias("account_key"), F.col("effective_from").alias("card_version"),
        "effective_from", "effective_to")
    a = _versions(accounts, versions).select(
        F.trim("account_num").alias("account_key"), "valid_to",
        F.trim("client").alias("client_key"), F.col("effective_from").alias("account_version"),
        "effective_from", "effective_to")
    cl = _versions(clients, versions).select(
        F.trim("client_id").alias("client_key"), "client_id", "last_name", "first_name",
        "patronymic", "passport_num", "passport_valid_to", "phone",
        F.col("effective_from").alias("client_version"), "effective_from", "effective_to")
    if not as_of:
        c, a, cl = (d.drop("effective_from", "effective_to") for d in (c, a, cl))
        prof = c.join(a, "account_key", "left").join(cl, "client_key", "left")
    else:
        c = _validity(c, "card_key", "c", placeholder=False)
        a = _validity(a, "account_key", "a", placeholder=True)
        cl = _validity(cl, "client_key", "l", placeholder=True)
        prof = _interval_join(_interval_join(c, a, "account_key", "c", "a", "ca"),
                              cl, "client_key", "ca", "l", "valid")
    if blacklist is not None:
        bl = blacklist.select("passport_num").where(F.col("passport_num").isNotNull()).distinct()
        prof = prof.join(bl.withColumn("in_blacklist", F.lit(True)), "passport_num", "left")
    else:
        prof = prof.withColumn("in_blacklist", F.lit(None).cast("boolean"))
    return prof.drop("account_key", "client_key")


def _in_interval(t: Column, prefix: str) -> Column:
    lo, hi = F.col(f"{prefix}_from"), F.col(f"{prefix}_until")
    return (lo.isNull() | (lo <= t)) & (hi.isNull() | (t < hi))


def enrich_transactions(fact: DataFrame, cards: DataFrame, accounts: DataFrame,
                        clients: DataFrame, terminals: DataFrame,
                        blacklist: DataFrame | None = None, versions: str = "all") -> DataFrame:
    """Every fact row with its card, account, client and terminal attributes (left joins:
    a transaction whose card is unknown keeps null client columns)."""
    prof = card_profile(cards, accounts, clients, blacklist, versions)
    tm = _versions(terminals, versions).select(
        F.col("terminal_id").alias("terminal_key"), "terminal_city",
        F.col("effective_from").alias("terminal_version"))
    f = fact.select("trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result",
                    "terminal")
    # a fact row without a card number, or without a terminal, matches nothing there: spread those over all tasks
    f = f.select("*", null_spread(["card_num"], ["trans_id", "trans_date", "terminal"]),
                 null_spread(["terminal"], ["trans_id", "trans_date", "card_num"]).alias("_no_terminal"))
    prof = prof.select("*", null_spread(["card_key"], ["card_num_dim"]))
    card_match = (F.trim(f.card_num) == prof.card_key) & (f[SPREAD] == prof[SPREAD])
    helpers = ("card_key", "terminal_key", SPREAD, "_no_terminal", "_no_key")

    def with_spread(t: DataFrame) -> DataFrame:
        return t.select("*", null_spread(["terminal_key"], ["terminal_city"]).alias("_no_key"))

    if versions != "as_of":
        tm = with_spread(tm)
        at_terminal = (f.terminal == tm.terminal_key) & (F.col("_no_terminal") == F.col("_no_key"))
        return f.join(prof, card_match, "left").join(tm, at_terminal, "left").drop(*helpers)
    tm = _validity(_versions(terminals, versions).select(
        F.col("terminal_id").alias("terminal_key"), "terminal_city",
        F.col("effective_from").alias("terminal_version"), "effective_from", "effective_to"),
        "terminal_key", "t", placeholder=False)
    tm, t = with_spread(tm), f.trans_date
    at_terminal = (f.terminal == tm.terminal_key) & (F.col("_no_terminal") == F.col("_no_key"))
    out = (f.join(prof, card_match & _in_interval(t, "valid"), "left")
            .join(tm, at_terminal & _in_interval(t, "t"), "left"))
    return out.drop("valid_from", "valid_until", "t_from", "t_until", *helpers)
