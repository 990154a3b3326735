"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .chat_tree import prefix_tree, read_back
from .common import materialise, shared_folder, table
from .decontaminate import contamination
from .divergence import quality
from .hash_ring import ring_shards
from .licence_scan import CUE, scan_licences
from .ngram_join import jaccard_components
from .pareto_mix import mix
from .periodic_runs import periodic_runs
from .piece_bpe import encode_texts
from .registry import register
from .secret_ledger import scan_secrets, span_text
from .spelling_trie import variant_groups
from .token_cache import token_counts
from .tokenizer_files import END_TOKEN, piece_model, rank_file, tokenizer_json
from .training_order import read_training_order, write_training_order

TOKEN_LIMIT = 1024


@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document through a new digest cache in the shared folder."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = token_counts(docs, shared_folder(spark, "token-cache"), tokenizer_json())
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@register("op5_quality_divergence")
def op5_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base facts and the divergence verdict of every document, by references in which each source has one vote."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality(docs, source_col="source").drop("lang", "source", "text")


@register("op3_pareto_mix", oracle=oracles.PARETO_MIX)
def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1 with at most three copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@register("op4_ring_shards")
def op4_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 16 shards with tight quotas: row counts at most one apart."""
    dealt = ring_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


BASE_KINDS = ("assign", "access", "hex")


@register("op6_secret_ledger", oracle=oracles.SECRETS)
def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, scanned into a new ledger in the shared folder."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, shared_folder(spark, "secret-ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text("spans").alias("spans"))


@register("op2_decontaminate", oracle=oracles.DECONTAMINATE)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@register("op8_ngram_jaccard")
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a Jaccard similarity of 0.85 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs, width=4, percent=85).select("doc_id", "n_shingles", "component_id", "n_copies")


ORDER_KEY, RECORD_TOKENS, RECORDS_PER_SHARD = 20240229, 1024, 4096


@register("op1_training_order")
def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as records of 1,024 tokens, written as raw shards of 4,096 slots and read back from them in slot order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = shared_folder(spark, "training-shards")
    write_training_order(docs, rank_file(), END_TOKEN, RECORD_TOKENS, ORDER_KEY, RECORDS_PER_SHARD, folder)
    return read_training_order(spark, folder, RECORD_TOKENS)


@register("op7_chat_tree")
def op7_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, read back from the prefix tree's token stream."""
    told = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)], "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    stream, steps, members = prefix_tree(conversations, rank_file())
    found = read_back(materialise(stream, "chat-stream"), steps, members, rank_file())
    return found.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _paths(docs: DataFrame) -> DataFrame:
    """A file tree over the documents: one to three levels by id below their source. A document with a licence
    cue is a licence file of its directory."""
    level = F.pmod(F.col("doc_id"), F.lit(3))
    dirs = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.when(level > 0, F.floor(F.col("doc_id") / 4096).cast("string")),
                       F.when(level > 1, F.floor(F.col("doc_id") / 256).cast("string")))
    states = F.coalesce(F.col("text").rlike(CUE), F.lit(False))
    name = F.concat(F.when(states, F.lit("LICENSE.")).otherwise(F.lit("")), F.col("doc_id").cast("string"))
    return docs.withColumn("path", F.concat_ws("/", dirs, name))


@register("op10_licence_scan", oracle=oracles.LICENCES)
def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents as files of a tree: own ones, and those of the nearest directory above."""
    files = _paths(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("source")
    return scan_licences(files).drop("own_licences", "licences")  # the SQL states the single ones


LONG_RUN, ENGLISH_UPPER = r"[A-Za-zÀ-ÿ]{7,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _misspelt_words(docs: DataFrame) -> DataFrame:
    """(word, n): maximal letter runs, A-Z in lower case, one code point deleted where 31 divides the CRC of id and run; results of
    seven code points that come twice or more. Shorter runs can't become such words, so they aren't taken."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(LONG_RUN), F.lit(0))).alias("run"))
    ascii_only = F.octet_length("run") == F.char_length("run")  # there ``lower`` changes A-Z alone, and is much faster
    runs = runs.select("doc_id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", ENGLISH_UPPER, ENGLISH_UPPER.lower())).alias("run"))
    runs = runs.select("run", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run"))).alias("h"))
    at = F.pmod(F.col("h"), F.char_length("run").cast("long")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word")
    # the length is judged behind the sums: a filter before them moves below the projections and makes each word several times over
    counted = runs.select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max(F.char_length("word")).alias("size"))
    return counted.where("n >= 2 AND size >= 7").select("word", "n")


@register("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent words one edit away that they are variants of."""
    return variant_groups(_misspelt_words(table(spark, sf_dir, "documents").select("doc_id", "text")))


@register("op12_piece_encoding")
def op12_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with begin and end ids, held against the library, and decoded."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = encode_texts(docs, piece_model())
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")


WORDS_OF = r"[^\x20\x09-\x0D]+"


def _with_repeats(docs: DataFrame) -> DataFrame:
    """In a tenth of the documents, by the CRC of the id, the words from a place on repeat with a period; others stay."""
    words = F.regexp_extract_all("text", F.lit(WORDS_OF), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string"))
    dealt = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    dealt = dealt.select("doc_id", "text", "g", "words", F.when(n > 0, F.col("g") % n).cast("int").alias("a"))
    period = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, period), F.ceil((n - F.col("a")) / period).cast("int")))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), n - F.col("a"))), " ")
    return dealt.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least six words and four periods in every document, and the digest of its text without their repeats."""
    found = periodic_runs(_with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.expr("array_min(transform(runs, r -> struct(-r.length AS length, r.start AS start, r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed").select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.length")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
