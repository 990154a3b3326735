"""The corpus pipeline: from raw documents to training records in five stages.

1. quality: documents that the base rules or the divergence from their language reject go;
2. near_duplicates: of documents linked by shared five-word shingles (Jaccard 0.8 or more) one stays;
3. decontaminate: documents with a window of a benchmark item go;
4. mix: sources are sampled or repeated to their target weights, a row for each copy;
5. training_order: token records at their slots, written as raw shards and listed from them.

Each stage reads what its predecessor kept, as Parquet, and all but the last return the columns of
``documents``. Null, empty and very long texts, ties, repeated rows, empty tables and extra columns are
treated as the operators' docstrings say; an empty table passes through all stages as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlane.llm.common import materialise, shared_folder, table
from fraudlane.llm.decontaminate import clean_documents
from fraudlane.llm.divergence import quality as judge_quality
from fraudlane.llm.ngram_join import keep_one_of_each
from fraudlane.llm.pareto_mix import mix as mix_sources
from fraudlane.llm.tokenizer_files import END_TOKEN, rank_file
from fraudlane.llm.training_order import read_shards, write_training_order

USED = ("doc_id", "text", "lang", "source")


def aside(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns the operators don't use under names that can't clash with theirs."""
    return docs.select([F.col(f"`{c}`").alias(c if c in USED else f"_aside_{k}") for k, c in enumerate(docs.columns)])


def back(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, from a result over aside(docs)."""
    return kept.select([F.col(c if c in USED else f"_aside_{k}").alias(c) for k, c in enumerate(docs.columns)])


ORDER_KEY, RECORD_TOKENS, RECORDS_PER_SHARD = 20240229, 1024, 4096


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return back(judge_quality(aside(docs), source_col="source").where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return back(keep_one_of_each(aside(docs)), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return back(clean_documents(aside(docs), table(spark, sf_dir, "benchmark")), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mix_sources(aside(docs)).where("copies > 0")
    return back(mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs)


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per record, as read back from its shard file: slot, shard, place, n_tokens, the
    documents in it and the CRC of its bytes."""
    folder = shared_folder(spark, "training-shards")
    write_training_order(docs, rank_file(), END_TOKEN, RECORD_TOKENS, ORDER_KEY, RECORDS_PER_SHARD, folder)
    index = spark.read.parquet(f"{folder}/index")
    found = read_shards(spark, folder, RECORD_TOKENS).select("shard", "place", F.crc32("record").alias("record_crc32"))
    return index.join(found, ["shard", "place"]).select(
        "slot", "shard", "place", "n_tokens", F.col("docs.doc_id").alias("doc_ids"), "record_crc32")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("training_order", training_order)]
#: Tokenizing and hash functions beyond SQL's: tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read back as the next input."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
