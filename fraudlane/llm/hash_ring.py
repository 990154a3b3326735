"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at ``vnodes`` places of a ring, and a row belongs to the first place clockwise
from its own hash (its arc). A shard holds at most its quota of rows. Rows that overflow a full
shard continue clockwise to the next place whose shard has room. The quotas differ by one row at
most and add up to the number of rows when ``slack`` is 0: then all shards come out full, that is,
with row counts at most one apart. With a positive slack a quota is that much above the mean, fewer
rows overflow, and fewer rows move when a shard joins.

Only the overflow plan is made in one place, from the number of rows in each arc: a table of
shards x vnodes numbers whatever the input's size. It says which run of ranks of an arc goes to
which shard, and from which slot on. No arc is ranked as a whole: the ring is cut into ``1 << cell_bits``
cells of equal width as well, a row has its place among the rows of its arc and cell, and the rows of the
arc's cells before are added to it, summed over one number for each cell. The hash covers id and text, so that neither
a hot source nor copies with their own ids nor rows without an id meet in one cell; only rows equal in both do.

Defined cases: null text has no bytes (size 1, CRC 0); null ids hash as a value of their own; rows
equal in id and text share a ring position and are dealt in turn like any others (they may part at
a shard's limit); an empty table gives an empty result; columns with the names of the added ones
are replaced, and any other name may be used. Results don't depend on partitioning.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, named_back, set_apart

ADDED = ("size", "text_crc32", "shard", "slot")
MASK = (1 << 64) - 1


def _mix64(x: int) -> int:
    """The splitmix64 finaliser: a 64-bit hash of a small number."""
    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def ring(shards: int, vnodes: int, seed: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node in ring order. A shard's places depend on its number
    only, so a further shard adds places and moves none."""
    return sorted((_mix64(_mix64(seed * 0x10001 + s) + v) - (1 << 63), s) for s in range(shards) for v in range(vnodes))


def quotas(rows: int, shards: int, slack: float) -> list[int]:
    total = max(rows, -int(-rows * (1 + slack) // 1))
    return [total // shards + (s < total % shards) for s in range(shards)]


def overflow_plan(counts: dict[int, int], owners: list[int], quota: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Runs (arc, first_rank, end_rank, shard, first_slot) that deal every row of every arc.

    First each arc, in ring order, fills its own shard. Then what is left goes on clockwise, one place
    at a time for all arcs alike; a shard with room takes it in ring order of the arcs it came from.
    """
    filled = [0] * len(quota)
    runs, left = [], []

    def take(arc: int, start: int, n: int, shard: int) -> int:
        got = min(n, quota[shard] - filled[shard])
        if got > 0:
            runs.append((arc, start, start + got, shard, filled[shard]))
            filled[shard] += got
        return max(got, 0)

    for arc in range(len(owners)):
        n = counts.get(arc, 0)
        got = take(arc, 0, n, owners[arc])
        if n > got:
            left.append((arc, got, n - got))
    step = 1
    while left and step <= len(owners):
        after = []
        for arc, start, n in left:
            got = take(arc, start, n, owners[(arc + step) % len(owners)])
            if n > got:
                after.append((arc, start + got, n - got))
        left, step = after, step + 1
    assert not left, "the quotas hold fewer rows than there are"
    return runs


def ring_position(id_col: str, text: Column) -> Column:
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), text)


def ring_shards(docs: DataFrame, shards: int = 16, vnodes: int = 64, slack: float = 0.0, seed: int = 1,
                id_col: str = "doc_id", text_col: str = "text", cell_bits: int = 16) -> DataFrame:
    """``docs`` without its text, with size, text_crc32, shard and slot (gapless from 0 in each shard).
    2 ** ``cell_bits`` cells bound the windows: 16 bits leave some 1.5 million rows to a cell at 10^11 rows."""
    docs, names = set_apart(docs)
    id_col, text_col = names[id_col], names[text_col]
    carried = dict.fromkeys([id_col, *(given for given in names.values() if given != text_col)])
    places = ring(shards, vnodes, seed)
    positions = np.array([p for p, _ in places], dtype=np.int64)
    text = F.coalesce(F.col(text_col), F.lit(""))

    @F.pandas_udf("int")
    def arc_of(position: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(positions, position.to_numpy(np.int64), side="left") % len(positions)).astype("int32")

    rows = docs.select(*carried, (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       ring_position(id_col, text).alias("_position"))
    rows = rows.withColumn("_arc", arc_of("_position")).withColumn("_cell", F.shiftright("_position", 64 - cell_bits))
    # an arc's positions rise with its cells, the one over the ring's end included: it is ranked from the least position on
    in_cell = Window.partitionBy("_arc", "_cell").orderBy("_position", F.col(id_col).cast("string"), "size", "text_crc32")
    rows = materialise(rows.withColumn("_place", F.row_number().over(in_cell).cast("long") - 1).drop("_position"), "ring-rows")
    cells = materialise(rows.groupBy("_arc", "_cell").agg(F.count(F.lit(1)).alias("n")), "ring-cells")
    counts = {r._arc: r.n for r in cells.groupBy("_arc").agg(F.sum("n").alias("n")).collect()}  # shards x vnodes at most
    runs = overflow_plan(counts, [s for _, s in places], quotas(sum(counts.values()), shards, slack))
    plan = docs.sparkSession.createDataFrame(runs, "_a int, _first long, _end long, shard int, _slot long")
    earlier = Window.partitionBy("_ca").orderBy("_cc").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select(F.col("_arc").alias("_ca"), F.col("_cell").alias("_cc"), "n").select(
        "_ca", "_cc", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))  # arcs + cells rows at most
    ranked = rows.join(F.broadcast(before), (F.col("_arc") == F.col("_ca")) & (F.col("_cell") == F.col("_cc")))
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_place"))
    dealt = ranked.join(F.broadcast(plan), (F.col("_arc") == F.col("_a")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")))
    dealt = dealt.select(*carried, "size", "text_crc32", "shard", (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot"))
    return named_back(dealt, {c: given for c, given in names.items() if given != text_col}, ADDED, ADDED)
