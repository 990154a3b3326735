"""Registered queries that go through real files: the transactions text drop read in
batch (S1/S2/S8) and the same drop ingested by the file stream with archiving (K6/S9).

The drop files are written by Spark (one folder per business day, named like the daily
file) under the session's shared checkpoint folder, in a fresh sub-folder per call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TRANSACTIONS_FILE
from ..session import ensure_checkpoint_dir
from ..sources.bank_fixture import transactions_text
from ..sources.files import read_transactions
from ..functions.parsing import business_date_from_name
from ..streaming.drop_ingest import ingest_drops
from .queries import register


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fraudlane-{purpose}-{uuid.uuid4().hex}"


def write_drops(spark: SparkSession, sf_dir: str, drop_dir: str) -> None:
    """One ``transactions_DDMMYYYY.txt`` folder per business day (``;``, header)."""
    text = transactions_text(spark, sf_dir)
    day = F.date_format(F.to_timestamp_ntz(F.col("trans_date")), "ddMMyyyy")
    (text.withColumn("drop_name", F.concat(F.lit("transactions_"), day, F.lit(".txt")))
         .repartition("drop_name", F.pmod(F.xxhash64("trans_id"), F.lit(4)))  # a day is several files, of several tasks
         .write.partitionBy("drop_name").option("sep", ";").option("header", "true").csv(drop_dir))


@register("src_transactions_csv")
def q_src_transactions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``;`` text files read by position with an all-text schema."""
    drop_dir = scratch_dir(spark, "drops")
    write_drops(spark, sf_dir, drop_dir)
    rows = read_transactions(spark, drop_dir)
    return rows.select(*TRANSACTIONS_FILE.names,
                       business_date_from_name(F.col("_metadata.file_path")).alias("business_date"))


@register("ingest_and_archive")
def q_ingest_and_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drop folder ingested once by a file stream that archives consumed files."""
    base = scratch_dir(spark, "ingest")
    write_drops(spark, sf_dir, f"{base}/drops")
    ingest_drops(spark, f"{base}/drops", f"{base}/staging", f"{base}/checkpoint",
                 archive_dir=f"{base}/archive")
    return spark.read.parquet(f"{base}/staging").select(*TRANSACTIONS_FILE.names, "business_date")


@register("ingest_archive_status")
def q_ingest_archive_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: per business day, the rows staged, the rows in archived files, and the rows still in the drop folder."""
    base = scratch_dir(spark, "ingest")
    write_drops(spark, sf_dir, f"{base}/drops")
    ingest_drops(spark, f"{base}/drops", f"{base}/staging", f"{base}/checkpoint", archive_dir=f"{base}/archive")
    staged = spark.read.parquet(f"{base}/staging").groupBy("business_date").agg(F.count(F.lit(1)).alias("n_staged"))

    def in_files(folder: str, name: str) -> DataFrame:
        files = (spark.read.schema(TRANSACTIONS_FILE).option("sep", ";").option("header", "true").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "part-*").csv(folder))
        day = business_date_from_name(F.col("_metadata.file_path"))
        return files.groupBy(day.alias("business_date")).agg(F.count(F.lit(1)).alias(name))

    return (staged.join(in_files(f"{base}/archive", "n_archived"), "business_date", "left")
            .join(in_files(f"{base}/drops", "n_left"), "business_date", "left")
            .select("business_date", "n_staged", F.coalesce("n_archived", F.lit(0)).alias("n_archived"), F.coalesce("n_left", F.lit(0)).alias("n_left")))
