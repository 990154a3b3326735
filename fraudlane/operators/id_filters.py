"""Persisted Bloom filters of a load's ids: which earlier loads may hold an id, without reading their facts.

Each load's filter lies beside its facts as rows of one segment: ``(segment, segments, words)``. An id belongs to
one segment by a hash and sets ``PROBES`` bits of its words. A segment is 8 KB whatever the load's size; larger loads
have more segments, so that building and testing are spread over all tasks and no filter is one value.

A filter never denies an id it holds. At 24 bits and 8 probes an id, one in about 25,000 strange ids looks known
to a load; such loads are read too, and the facts themselves decide. Null ids are in no filter and match nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES, BITS_PER_ID = 8, 24
SEGMENT_BITS = 1 << 16
SEGMENT_WORDS = SEGMENT_BITS // 64
FILTER_DDL = "segment long, segments long, words array<long>"


def segments_for(n_ids: int) -> int:
    """The number of segments for so many distinct ids: a power of two, so that loads of like size share it."""
    wanted = -(-n_ids * BITS_PER_ID // SEGMENT_BITS)
    return 1 << max(0, wanted - 1).bit_length()


def _segment(key: Column, segments: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(PROBES)), segments)


def _positions(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(SEGMENT_BITS).cast("long")) for k in range(PROBES)]


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), position.bitwiseAND(F.lit(63)).cast("int"))


def build_filter(ids: DataFrame, key: str) -> DataFrame:
    """The filter of the ids in FILTER_DDL, one row a segment; without ids one segment that holds nothing.

    The ids are counted first (read them from a written table)."""
    ids = ids.select(F.col(key).alias("id")).where("id IS NOT NULL")
    segments = segments_for(ids.distinct().count())
    own = _segment(F.col("id"), F.lit(segments).cast("long")).alias("segment")
    at = ids.select(own, F.explode(F.array(*_positions(F.col("id")))).alias("at"))
    ones = at.select("segment", F.shiftright("at", 6).alias("word"), _bit(F.col("at")).alias("bits"))
    every = ids.sparkSession.range(segments * SEGMENT_WORDS)
    zeros = every.select(F.floor(F.col("id") / SEGMENT_WORDS).alias("segment"), (F.col("id") % SEGMENT_WORDS).alias("word"),
                         F.lit(0).cast("long").alias("bits"))
    words = ones.unionByName(zeros).groupBy("segment", "word").agg(F.bit_or("bits").alias("bits"))
    whole = words.groupBy("segment").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"))
    return whole.select("segment", F.lit(segments).cast("long").alias("segments"), F.col("w.bits").alias("words"))


def _may_hold(words: Column, key: Column) -> Column:
    tests = [F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0 for p in _positions(key)]
    return reduce(lambda a, b: a & b, tests)


def possible_loads(ids: DataFrame, key: str, filters: DataFrame, sizes: list[int]) -> DataFrame:
    """(load_id, id) of every pair where the load's filter may hold the id. ``filters`` has FILTER_DDL and load_id,
    ``sizes`` are its distinct numbers of segments (at most one for each power of two).

    The filters meet the distinct ids by segment, and the test is part of the join, so that only the
    pairs that pass it become rows."""
    ids = ids.select(F.col(key).alias("id")).where("id IS NOT NULL").distinct()
    sized = ids.select("id", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("of"))
    sized = sized.select("id", "of", _segment(F.col("id"), F.col("of")).alias("at"))
    met = (F.col("of") == F.col("segments")) & (F.col("at") == F.col("segment")) & _may_hold(F.col("words"), F.col("id"))
    return sized.join(filters, met).select("load_id", "id")
