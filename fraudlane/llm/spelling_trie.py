"""Spelling variant grouping: words one edit apart, found by the edges of a trie held as a table.

Two tries are one table: of the words and of the reversed words, each closed by an end mark. A node is the hash of its way and
prefix; its edges are symbols, each with a fingerprint of the rests of the words below it: the least and the most of their hashes, and which of
256 marks they set. Nodes with one edge are left out, as no word can be edited there. With no edit made a word stands on its own path, so those
states are known without a walk: one for each prefix from the half of the word on. There it meets the edges of its node and may be edited: a symbol of the trie
in place of its own (of a pair of words, the one with the lesser symbol does it), or one more. What is left of the word behind the edit
must then be a rest below that edge. Its hash is known too, so the fingerprint tells most edits that lead to no word, without a walk
down the edges; the others are spelt out and looked up among the words. An edit in a word's first half is one in the second half of the
reversed word, and a word with a symbol less is met by the state of the other; so each pair is found, while no state is made at the wide nodes near the root.
Hashes only tell what need not be looked up: two prefixes or rests with one hash cost a look-up, and neither make nor lose a pair.

Defined cases: null words and words of fewer than two code points are left out; repeated words count as one word with their summed n (null as
0); an empty table gives an empty result; columns beside word and n don't matter and don't come back. Words of any length, U+0003 not being in them
(it is the end mark; a word with it is an error).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

END = "\x03"
#: The marks of a fingerprint, 64 in each column.
MARKS = ("marks_0", "marks_1", "marks_2", "marks_3")
#: Words of one task where their states and edges are made, some twenty for each word.
WORDS_A_TASK = 50_000


def counted(words: DataFrame, word_col: str = "word", n_col: str = "n") -> DataFrame:
    """(word, n) with one row for each word of two code points or more."""
    rows = words.select(F.col(word_col).alias("word"), F.coalesce(F.col(n_col).cast("long"), F.lit(0)).alias("n"))
    ended = F.when(F.contains("word", F.lit(END)), F.raise_error(F.lit("a word holds the end mark"))).otherwise(F.col("word"))
    return rows.select(ended.alias("word"), "n").where(F.char_length("word") >= 2).groupBy("word").agg(F.sum("n").alias("n"))


def _both_ways(words: DataFrame) -> DataFrame:
    """(way, spelt, n): each word forward (0) and backward (1)."""
    ways = F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("word").alias("spelt")),
                             F.struct(F.lit(1).alias("way"), F.reverse("word").alias("spelt"))))
    return words.select(ways.alias("w"), "n").select("w.way", "w.spelt", "n")


def _node(depth) -> Column:
    return F.xxhash64("way", F.substring("spelt", F.lit(1), depth))


def _rest(position: Column) -> Column:
    """What follows the first ``position`` symbols."""
    return F.substring("spelt", position + 1, F.char_length("spelt"))


def _marks(rest: str) -> list[Column]:
    """For each of MARKS the bit that the hash in column ``rest`` sets: one bit in one of them."""
    bit = F.expr(f"shiftleft(1L, cast({rest} & 63 AS int))")
    return [F.when(F.expr(f"(shiftright({rest}, 6) & {len(MARKS) - 1}) = {k}"), bit).otherwise(F.lit(0)) for k in range(len(MARKS))]


def trie_branches(walks: DataFrame) -> DataFrame:
    """(node, edges): the nodes of both tries with two edges or more, from the shortest half of a word on; an edge is its symbol and
    the fingerprint (least, most, MARKS) of what follows the symbol in the words below."""
    size = F.char_length("spelt")
    # a word enters the trie by each of its prefixes; those before its half are needed where a shorter word stands
    shortest = walks.agg(F.coalesce(F.min(F.floor(size / 2)), F.lit(0)).cast("int")).first()[0]
    steps = walks.select("way", "spelt", F.explode(F.sequence(F.lit(shortest), size)).alias("depth"))
    symbol = F.when(F.col("depth") == size, F.lit(END)).otherwise(F.substring("spelt", F.col("depth") + 1, F.lit(1)))
    edges = steps.select(_node(F.col("depth")).alias("node"), symbol.alias("symbol"), F.xxhash64(_rest(F.col("depth") + 1)).alias("rest"))
    # numbers only, so that they are summed in place; a node has an edge for each symbol at most
    edges = edges.groupBy("node", "symbol").agg(F.min("rest").alias("least"), F.max("rest").alias("most"),
                                                *[F.bit_or(mark).alias(c) for c, mark in zip(MARKS, _marks("rest"))])
    return edges.groupBy("node").agg(F.collect_list(F.struct("symbol", "least", "most", *MARKS)).alias("edges")).where(F.size("edges") > 1)


def _below(rest: str) -> Column:
    """Whether the hash ``rest``, with its bits in columns named after it, may be that of a rest below the edge."""
    common = F.lit(0)
    for c in MARKS:
        common = common.bitwiseOR(F.col(c).bitwiseAND(F.col(f"{rest}_{c}")))
    return F.col(rest).between(F.col("least"), F.col("most")) & (common != 0)


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): all ordered pairs of words (word, n; see ``counted``) that differ by one inserted, deleted or
    replaced code point. ``words`` is read several times, so it had better be a written table."""
    walks = _both_ways(words.repartition(1 + words.count() // WORDS_A_TASK, "word"))
    size, position = F.char_length("spelt"), F.col("position")
    # the states without an edit, from the half of each word to its end
    exact = walks.select("way", "spelt", "n", F.explode(F.sequence(F.floor(size / 2).cast("int"), size)).alias("position"))
    exact = exact.select("way", "spelt", "n", "position", _node(position).alias("node"))
    own = F.substring("spelt", position + 1, F.lit(1))  # empty at the end
    met = exact.join(trie_branches(walks), "node").select("way", "spelt", "n", "position", "edges", own.alias("own"), F.xxhash64(_rest(position)).alias("kept"),
                                                          F.xxhash64(_rest(position + 1)).alias("skipped"))
    # hashes and bits are made once for a state, then held against each edge of its node
    met = met.select("*", *[mark.alias(f"{rest}_{c}") for rest in ("kept", "skipped") for c, mark in zip(MARKS, _marks(rest))])
    met = met.select("*", F.inline("edges")).where((F.col("symbol") != F.col("own")) & (F.col("symbol") != END))
    edited = lambda k: F.concat(F.substring("spelt", F.lit(1), position), "symbol", _rest(position + k))
    one_more, replaced = _below("kept"), (F.col("own") != "") & (F.col("symbol") > F.col("own")) & _below("skipped")
    made = F.when(one_more & replaced, F.array(edited(0), edited(1))).when(one_more, F.array(edited(0))).when(replaced, F.array(edited(1)))
    made = met.select("way", "spelt", "n", F.explode(made).alias("made"))
    forward = lambda c: F.when(F.col("way") == 0, F.col(c)).otherwise(F.reverse(F.col(c)))
    made = made.select(forward("spelt").alias("a"), F.col("n").alias("a_n"), forward("made").alias("b"))
    pairs = made.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    mirrored = pairs.select(F.explode(F.array(F.struct("a", "a_n", "b", "b_n"), F.struct(
        F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))).alias("p")).select("p.*")
    return mirrored.repartition("a").distinct()  # dealt by a, so that a count by a needs no other shuffle


def variant_groups(words: DataFrame, ratio: int = 10, word_col: str = "word", n_col: str = "n") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``words``: its form is the near word of largest n (of
    equals the first by code point) if that is at least ``ratio`` times its own; its root is the end of the chain of forms."""
    if ratio < 2:
        raise ValueError("a form must be more frequent than its variant")
    words = materialise(counted(words, word_col, n_col), "spelt-words")
    near = near_words(words).groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word"))).alias("best"))
    judged = words.join(near.withColumnRenamed("a", "word"), "word", "left")
    much = -F.col("best.n") >= ratio * F.col("n")
    judged = materialise(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(much, F.col("best.word")).alias("form"),
                                       F.when(much, -F.col("best.n")).alias("form_n")), "spelt-forms")
    # each step doubles the part of the chain that is known; n grows by the ratio on it, so it is short and has an end
    chain = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        chain = materialise(chain, "form-chain")
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if chain.join(onward, "root", "left_semi").isEmpty():
            break
        chain = chain.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return judged.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
