"""Benchmark decontamination by a prefix-filtered set join over item-sized windows.

A benchmark item is cut into windows of ``window`` consecutive words (a shorter item is one window),
and a window into shingles of ``shingle`` words. A document contains a window if all of the window's
shingles stand there at consecutive places: containment 1, so the necessary prefix of a window, with
its shingles ordered by rarity in the documents, is its single rarest shingle. The steps:

1. hits: all places of the documents whose shingle some window has;
2. runs: hits at consecutive places, and only runs long enough for the shortest window (length bound);
3. candidates: places of a run that hold the rarest shingle of a window, where the window's start and
   end lie inside the run (positional bound);
4. verification: the run's shingles at these places equal the window's, word for word.

Words are the maximal runs of ASCII letters and digits and of characters beyond ASCII, with A-Z
lower-cased. Only DataFrame functions are used. The benchmark's shingles are broadcast only while
they are measured to be below BROADCAST_BYTES; beyond, the same joins shuffle.

Defined cases: null text has no words; documents or items without words hit nothing; a null item id
marks words like any other but is not among the item ids; repeated items and documents count alike,
each row of ``docs`` comes back once; equal windows of several items are joined once and
credited to all of them; empty tables on either side give no hits; columns named like the added
ones are replaced. Texts are used whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, named_back, set_apart

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 32 << 20
ADDED = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")


def words(text: Column) -> Column:
    """The words of a text. Only A-Z are lower-cased; for pure ASCII that is what lower() does."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, APART), "")


def shingles(w: Column, k: Column | int) -> Column:
    """The k-word shingles of a word array by place, as strings (a word has no blank); none if it is shorter."""
    k = F.lit(k) if isinstance(k, int) else k
    starts = F.when(F.size(w) >= k, F.sequence(F.lit(1), F.size(w) - k + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(w, i, k), " "))


def _triples(w: Column, k: int) -> Column:
    """As shingles(), for a fixed k and long texts: no array is built for each place."""
    head = F.slice(w, 1, F.greatest(F.size(w) - (k - 1), F.lit(0)))
    return F.transform(head, lambda x, i: F.concat_ws(" ", x, *[F.get(w, i + j) for j in range(1, k)]))


def item_windows(bench: DataFrame, window: int, shingle: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (win, k, n_win_words, parts), and which items have them (win, item_id)."""
    w = bench.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("len", F.least(F.lit(window), F.size("w")))
    w = w.select("item_id", "len", F.explode(shingles(F.col("w"), F.col("len"))).alias("win")).distinct()
    k = F.least(F.lit(shingle), F.col("len"))
    wins = w.select("win", "len").distinct().select(
        "win", k.alias("k"), F.col("len").alias("n_win_words"), shingles(F.split("win", " "), k).alias("parts"))
    return wins, w.select("win", "item_id")


def _small(df: DataFrame, size: Column) -> DataFrame:
    """``df`` marked for broadcast if its measured size is under the bound, else as it is."""
    measured = df.agg(F.sum(size + F.lit(32))).first()[0] or 0
    return F.broadcast(df) if measured < BROADCAST_BYTES else df


def window_hits(docs: DataFrame, bench: DataFrame, window: int = 10, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                item_id_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Verified occurrences (doc, doc_hash, win, start, end; places from 1, end exclusive) and (win, item_id)."""
    wins, items = item_windows(bench, window, shingle, item_id_col, item_text_col)
    wins, items = materialise(wins, "windows"), materialise(items, "window-items")
    vocabulary = wins.select("k", F.explode("parts").alias("part")).distinct()
    shortest = {r.k: r.m for r in wins.groupBy("k").agg(F.min(F.size("parts")).alias("m")).collect()}  # at most `shingle` rows

    source = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("doc_hash"),
                         words(F.col(text_col)).alias("w"))
    hits = None
    for k in sorted(shortest):
        known = vocabulary.where(F.col("k") == k).select("part")
        at = source.select("doc", "doc_hash", F.posexplode(_triples(F.col("w"), k)).alias("at", "part"))
        found = at.join(_small(known, F.octet_length("part")), "part", "left_semi").select("doc", "doc_hash", F.lit(k).alias("k"), "at", "part")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = source.where(F.lit(False)).select("doc", "doc_hash", F.lit(1).alias("k"), F.lit(0).alias("at"), F.lit("").alias("part"))
    hits = hits.dropDuplicates(["doc", "doc_hash", "k", "at"])  # rows that repeat an id and text are one document here

    in_doc = Window.partitionBy("doc", "doc_hash", "k").orderBy("at")
    runs = (hits.withColumn("run", F.col("at") - F.row_number().over(in_doc))
            .groupBy("doc", "doc_hash", "k", "run").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("r")))
    least = F.coalesce(*[F.when(F.col("k") == k, F.lit(m)) for k, m in shortest.items()], F.lit(1))
    runs = materialise(runs.where(F.size("r") >= least).select(
        "doc", "doc_hash", "k", "run", F.col("r")[0]["at"].alias("first"), F.col("r.part").alias("parts")), "runs")

    places = runs.select("doc", "doc_hash", "k", "run", F.size("parts").alias("n"), F.posexplode("parts").alias("at", "part"))
    rarity = places.groupBy("k", "part").agg(F.count(F.lit(1)).alias("n_places"))
    order = (wins.select("win", "k", F.posexplode("parts").alias("offset", "part"))
             .join(rarity, ["k", "part"], "left").groupBy("win").agg(F.min(F.struct(F.coalesce("n_places", F.lit(0)).alias("n"), "part", "offset")).alias("rare")))
    prefix = order.where("rare.n > 0").join(wins.select("win", "k", "n_win_words", F.col("parts").alias("win_parts")), "win").select(
        "win", "k", F.col("rare.part").alias("part"), F.col("rare.offset").alias("offset"), "n_win_words", "win_parts")
    prefix = materialise(prefix, "prefixes")
    narrow = _small(prefix.select("win", "k", "part", "offset", F.size("win_parts").alias("m")), F.octet_length("win") + F.octet_length("part"))
    start = F.col("at") - F.col("offset")
    candidates = (places.join(narrow, ["k", "part"]).where((start >= 0) & (start + F.col("m") <= F.col("n")))
                  .select("doc", "doc_hash", "k", "run", "win", start.alias("start")))
    same_doc = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in ("doc", "doc_hash", "k", "run")]
    held = runs.select(*[F.col(c).alias(f"r_{c}") for c in ("doc", "doc_hash", "k", "run")], "first", "parts")
    full = _small(prefix.select("win", "n_win_words", "win_parts"), F.octet_length("win") * 3)
    verified = (candidates.join(held, same_doc).join(full, "win")
                .where(F.slice("parts", F.col("start") + 1, F.size("win_parts")) == F.col("win_parts")))
    begin = F.col("first") + F.col("start") + 1
    return verified.select("doc", "doc_hash", "win", begin.alias("start"), (begin + F.col("n_win_words")).alias("end")), items


def contamination(docs: DataFrame, bench: DataFrame, window: int = 10, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit (words inside occurring windows), n_items, item_ids (sorted as
    strings) and contaminated."""
    docs, names = set_apart(docs)
    id_col, text_col = names[id_col], names[text_col]
    found, items = window_hits(docs, bench, window, shingle, id_col, text_col, item_id_col, item_text_col)
    found = materialise(found, "occurrences")
    spans = found.select("doc", "doc_hash", "start", "end").distinct()
    so_far = Window.partitionBy("doc", "doc_hash").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(so_far), F.col("start")))
    covered = spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("doc", "doc_hash").agg(F.sum("fresh").cast("long").alias("n_hit"))
    credited = (found.select("doc", "doc_hash", "win").distinct().join(items, "win").groupBy(F.col("doc").alias("d2"), F.col("doc_hash").alias("h2"))
                .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))
    result = covered.join(credited, F.col("doc").eqNullSafe(F.col("d2")) & (F.col("doc_hash") == F.col("h2"))).drop("d2", "h2")

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select("*", F.size(words(F.col(text_col))).cast("long").alias("n_words"), F.xxhash64(text).alias("_hash"))
    joined = rows.join(result, F.col(id_col).eqNullSafe(F.col("doc")) & (F.col("_hash") == F.col("doc_hash")), "left")
    found = joined.select(*names.values(), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                         F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                         F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                         (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
    return named_back(found, names, ADDED, ADDED)


def clean_documents(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a benchmark window, columns unchanged."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    docs, names = set_apart(docs)
    found, _ = window_hits(docs, bench, **options | {"id_col": names[id_col], "text_col": names[text_col]})
    bad = materialise(found.select("doc", "doc_hash").distinct(), "contaminated")
    text_hash = F.xxhash64(F.coalesce(F.col(names[text_col]), F.lit("")))
    clean = docs.join(bad, F.col(names[id_col]).eqNullSafe(F.col("doc")) & (text_hash == F.col("doc_hash")), "left_anti")
    return named_back(clean, names, ())
