"""Token counts through a digest cache.

Each text is known by the SHA-256 of its UTF-8 bytes and each tokenizer by the SHA-256 of its file.
The cache is a Parquet table (digest, tokenizer, n_tokens). A run joins the texts' digests to it,
encodes each distinct missing text once, appends the new counts, and joins the counts to all rows.

Normalisation must not change a count, and a byte-level tokenizer sees every byte; so the normal
form is the text itself with null read as empty.

Defined cases: null text counts as empty (0 bytes, 0 tokens); repeated rows and equal texts each
come back, encoded once; an empty table gives an empty result; other columns stay as they are
unless they clash with the added ``n_bytes`` and ``n_tokens``, which replace them.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .token_pieces import encoder

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def tokenizer_version(tokenizer_json: str) -> str:
    return hashlib.sha256(tokenizer_json.encode()).hexdigest()


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The stored counts of one tokenizer; runs that overlapped may have stored a digest twice."""
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
            .groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")))


def cache_exists(spark: SparkSession, cache: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _count(tokenizer_json, version: str):
    def run(batches):
        enc = encoder(tokenizer_json.value, version)
        for b in batches:
            n = [enc.count(t) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("_digest").cast(pa.binary()), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())],
                names=["digest", "tokenizer", "n_tokens"])
    return run


def fill_cache(texts: DataFrame, cache: str, tokenizer_json: str) -> None:
    """Encode the distinct texts of ``texts`` (_digest, _text) the cache lacks and append their counts."""
    spark = texts.sparkSession
    version = tokenizer_version(tokenizer_json)
    if cache_exists(spark, cache):
        known = read_cache(spark, cache, version).select(F.col("digest").alias("_digest"))
        texts = texts.join(known, "_digest", "left_anti")
    shipped = spark.sparkContext.broadcast(tokenizer_json)  # a vocabulary file, of fixed size
    (texts.dropDuplicates(["_digest"]).mapInArrow(_count(shipped, version), CACHE_SCHEMA)
     .write.mode("append").parquet(cache))


def token_counts(docs: DataFrame, cache: str, tokenizer_json: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens`` for its text; the cache at ``cache`` is brought up to date."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256)).alias("_digest")
    fill_cache(docs.select(digest, text.alias("_text")), cache, tokenizer_json)
    counts = read_cache(docs.sparkSession, cache, tokenizer_version(tokenizer_json))
    # the rows cross the join as one struct, so that no name of theirs meets the join's
    rest = [c for c in docs.columns if c not in ("n_bytes", "n_tokens")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("digest"))
    joined = rows.join(counts, "digest")
    return joined.select(*[F.col("row").getField(c).alias(c) for c in rest], "n_bytes", "n_tokens")
