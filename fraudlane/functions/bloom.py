"""Bloom filters in plain columns: an array of 64-bit words, built by grouped ``bit_or``, tested by ``get`` and shifts.

The words are built on the executors and become one value of at most ``MOST_BITS`` bits through a scalar
subquery, whatever the number of ids; beyond the size it is meant for a filter only lets more rows pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 4
#: Bits for each id, and the bounds of a filter's size (8 MB at most).
BITS_PER_ID, LEAST_BITS, MOST_BITS = 16, 1 << 10, 1 << 26


def bits_for(n: int) -> int:
    """The filter size for n ids: a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, BITS_PER_ID * n - 1).bit_length()))


def _positions(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(bits).cast("long")) for k in range(PROBES)]


def filter_words(ids: DataFrame, key: str, bits: int) -> DataFrame:
    """(word, bits) of every word of the filter, zero words included; a null id sets nothing."""
    at = ids.where(F.col(key).isNotNull()).select(F.explode(F.array(*_positions(F.col(key), bits))).alias("at"))
    ones = at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, CAST(at & 63 AS INT))").alias("bits"))
    zeros = ids.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    return ones.unionByName(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def filter_value(ids: DataFrame, key: str, bits: int) -> Column:
    """The filter of ``ids`` as a scalar subquery: an array of its words in order."""
    words = filter_words(ids, key, bits).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    return words.select(F.col("words.bits").alias("filter")).scalar()


def may_hold(value: Column, key: str, bits: int) -> Column:
    """Whether the filter may hold the id (never false for one it holds); false for a null id."""
    tests = [F.get(value, F.shiftright(p, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))) != 0
             for p in _positions(F.col(key), bits)]
    return F.col(key).isNotNull() & reduce(lambda a, b: a & b, tests)
