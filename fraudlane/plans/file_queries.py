"""Registered queries of the daily drops and the insert-only fact loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parsing import business_date_from_name, parse_amount
from ..operators.facts import new_blacklist, new_transactions, typed_transactions
from ..schemas import ts_lit
from ..sources.bank_fixture import (blacklist_sheet, replay_source, terminals_sheet, transactions,
                                    transactions_text)
from ..sources.files import read_blacklist, read_terminal_keys, read_terminals, stage_blacklist, stage_terminals
from .queries import MORNING_CUTOFF, register
from .stream_queries import scratch_dir

TERMINALS_FILE = "terminals_10012024.csv"
BLACKLIST_FILE_NAME = "passport_blacklist_10012024.csv"
BLACKLIST_LISTED_BEFORE = "2024-01-10"


@register("parse_amount")
def q_parse_amount(spark, sf_dir):
    """decimal-comma text -> decimal(7,2)."""
    text = transactions_text(spark, sf_dir)
    return text.select("trans_id", F.col("amt").alias("amt_text"), parse_amount("amt").alias("amt"))


@register("parse_transactions")
def q_parse_transactions(spark, sf_dir):
    """the text file's rows typed as the fact (timestamp rounded to the second)."""
    return typed_transactions(transactions_text(spark, sf_dir))


@register("fact_transactions_new")
def q_fact_transactions_new(spark, sf_dir):
    """T1/J1e/K3: today's file re-sends the whole period; the fact already holds what
    earlier drops (before the cut-off) loaded; only the rest is appended."""
    fact = transactions(spark, sf_dir).where(F.col("trans_date") < ts_lit(MORNING_CUTOFF))
    return new_transactions(transactions_text(spark, sf_dir), fact)


@register("fact_blacklist_new")
def q_fact_blacklist_new(spark, sf_dir):
    """T2/J1f/F4: passports listed before 2024-01-10 are in the fact; the rest is new."""
    sheet = stage_blacklist(blacklist_sheet(spark, sf_dir))
    fact = sheet.where(F.col("entry_dt") < BLACKLIST_LISTED_BEFORE).select(
        "passport_num", F.col("entry_dt").cast("date").alias("entry_dt"))
    return new_blacklist(sheet, fact)


def _sheet_file(spark, sheet, name: str) -> str:
    """``sheet`` exported as a ``;`` file in a new folder of the shared scratch space, padding kept."""
    path = f"{scratch_dir(spark, 'sheets')}/{name}"
    (sheet.write.option("sep", ";").option("header", "true").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
    return path


@register("src_terminals")
def q_src_terminals(spark, sf_dir):
    """A sheet file read by position, its padded rows trimmed and stamped with the date in its name."""
    return stage_terminals(read_terminals(spark, _sheet_file(spark, terminals_sheet(spark, sf_dir), TERMINALS_FILE)))


@register("src_blacklist")
def q_src_blacklist(spark, sf_dir):
    """Rows of a blacklist sheet file as staged."""
    return stage_blacklist(read_blacklist(spark, _sheet_file(spark, blacklist_sheet(spark, sf_dir), BLACKLIST_FILE_NAME)))


@register("keys_terminals")
def q_keys_terminals(spark, sf_dir):
    """The trimmed keys alone of the day-2 sheet file, whose keys are padded."""
    sheet = replay_source(spark, sf_dir, "terminals", 2).withColumn("terminal_id", F.concat(F.lit(" "), "terminal_id", F.lit("  ")))
    return read_terminal_keys(spark, _sheet_file(spark, sheet, TERMINALS_FILE))


@register("business_date")
def q_business_date(spark, sf_dir):
    """Drop file names (one per order date) -> business date."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    names = orders.select("o_orderkey", F.concat(
        F.lit("transactions_"), F.date_format("o_orderdate", "ddMMyyyy"), F.lit(".txt")).alias("file_name"))
    return names.select("o_orderkey", "file_name", business_date_from_name("file_name").alias("business_date"))
