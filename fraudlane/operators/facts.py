"""Insert-only fact loads: typed transactions and the passport blacklist.

Both append the staged rows whose key the fact does not hold yet. The fact grows without
bound while a day's stage is small, so the existence test is turned around: the fact is
semi-joined to the stage's keys (the stage is the build side, broadcast by AQE when it
measures small; the fact is only scanned, never shuffled when broadcast applies), and the
stage is then anti-joined to that small set of hits. Same rows as ``stage ▷ fact``.
Duplicates inside one stage are kept (Q20) unless ``dedupe`` is set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import parse_amount, parse_entry_date, parse_trans_date
from ..schemas import FACT_BLACKLIST, FACT_TRANSACTIONS


def typed_transactions(stage: DataFrame) -> DataFrame:
    """text staging rows -> fact types (``timestamp(0)``, ``decimal(7,2)``)."""
    return stage.select(
        "trans_id", parse_trans_date("trans_date").alias("trans_date"), "card_num", "oper_type",
        parse_amount("amt").alias("amt"), "oper_result", "terminal")


def _not_in_fact(new: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    hits = fact.select(key).join(new.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")
    return new.join(hits, key, "left_anti")


def new_transactions(stage: DataFrame, fact: DataFrame, dedupe: bool = False) -> DataFrame:
    """T1/J1e: typed stage rows whose ``trans_id`` is not in the fact yet."""
    typed = typed_transactions(stage)
    if dedupe:
        typed = typed.dropDuplicates(["trans_id"])
    return _not_in_fact(typed, fact, "trans_id").select(*FACT_TRANSACTIONS.names)


def new_blacklist(stage: DataFrame, fact: DataFrame, dedupe: bool = False) -> DataFrame:
    """T2/J1f/F4: blacklist rows for passports not listed yet (the first ``entry_dt`` stays)."""
    typed = stage.select("passport_num", parse_entry_date("entry_dt").alias("entry_dt"))
    if dedupe:
        typed = typed.dropDuplicates(["passport_num"])
    return _not_in_fact(typed, fact, "passport_num").select(*FACT_BLACKLIST.names)
