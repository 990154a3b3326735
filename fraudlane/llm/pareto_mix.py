"""Mixing sources to target weights by Pareto order sampling.

Targets are shares of all words by source weight; a target stops at ``max_copies`` times its
source's size and the excess is reshared by weight among the others until none is above. A source
with rate ``target / size`` takes ``floor(rate)`` certain whole copies of each document. For the
rest, each document has the inclusion odds of its fraction (document weights may make the fractions
unequal), and documents are ranked by random odds over inclusion odds (Pareto order). The sample
has a fixed size in words: ranked documents are taken while they fit into what the source still
needs; where a document doesn't fit, ``FILLS`` further passes go on in rank order with the documents left that are no larger
than the rest; at last one closing document is taken, the one whose words come nearest to the
rest, if that is nearer than none.

No source is sorted in one task. Ranks fall into ``BINS`` bins by value, words are summed by
(source, bin), a window over these sums finds the bin in which a source's need ends, and only
that bin's documents are ordered one by one.

All is DataFrame expressions; random numbers are hashes of (seed, document id, text), so reruns agree
and do not depend on partitioning.

Defined cases: null text has size 0 and takes 0 words; the null source is one more source, the last
in order; a source without words has target 0; rows equal in id, text and source draw equal numbers and are
taken or left together; document weights that are null or not above 0 count as 1; an empty table gives an
empty result; a clashing name among the added columns replaces the old column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, materialise, named_back, set_apart

BINS = 1 << 16
FILLS = 4
DECISIONS = "array<struct<limit: double, q: double, drawn: string>>"
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-blank characters; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\v\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANKS))).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_copies: int) -> DataFrame:
    """One row per source (source, source_size) -> its target; sources are few beside documents.

    Sources in the order of cap over weight: the first whose weighted share of what is left stays
    under its cap fixes the level at which all later ones are filled too.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int")).cast("double")
    s = sizes.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_copies).alias("cap"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
    left_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.select("*", (left / left_weight).alias("level"))
    s = s.select("*", (F.col("level") * F.col("weight") <= F.col("cap")).alias("open"))
    first = F.struct((F.col("cap") / F.col("weight")).alias("by_cap"), F.col("source").isNull().alias("last"), "source", "level")
    s = s.withColumn("fill", F.min(F.when(F.col("open"), first)).over(every)["level"])
    return s.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("fill") * F.col("weight")).alias("target"))


def _draw(id_col: str, text_col: str, source_col: str, weight_col: str | None, seed: int) -> list[Column]:
    """What a row is to the sampling: its source, size, random number, tie-break and weight."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.md5(text)))
    weight = F.when(F.col(weight_col) > 0, F.col(weight_col).cast("double")).otherwise(1.0) if weight_col else F.lit(1.0)
    return [F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size"), drawn.alias("_drawn"), weight.alias("_w")]


def _ranked(d: DataFrame, rates: DataFrame, max_copies: int) -> DataFrame:
    """Rows (_source, _drawn, _w) with their source's rates, certain copies, Pareto rank and its bin."""
    r = rates.select(F.col("source").alias("_rs"), "source_size", "target", "_rate")
    d = d.join(r, F.col("_source").eqNullSafe(F.col("_rs"))).drop("_rs")
    d = d.withColumn("_expected", F.least(F.lit(float(max_copies)), F.col("_rate") * F.col("_w")))
    d = d.withColumn("_sure", F.floor("_expected").cast("long"))
    p = F.col("_expected") - F.col("_sure")
    u = (F.conv(F.substring("_drawn", 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    d = d.withColumn("_q", F.when(p > 0, (u / (1 - u)) / (p / (1 - p))))
    return d.withColumn("_bin", F.floor(F.col("_q") / (1 + F.col("_q")) * BINS).cast("long"))


def _pass(units: DataFrame, state: DataFrame, first: bool) -> DataFrame:
    """One pass in rank order: per source the rest, and its decisions with this pass's: sizes up to
    ``limit`` and ranks up to (q, drawn) are taken."""
    met = units.join(state, F.col("_source").eqNullSafe(F.col("_state"))).where(~_taken() & F.col("_q").isNotNull())
    if not first:
        met = met.where(F.col("_size") <= F.col("_rest"))
    bins = met.groupBy("_source", "_bin").agg(F.sum("_words").alias("words"), F.first("_rest").alias("rest"))
    upto = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("after", F.sum("words").over(upto)).where(F.col("after") > F.col("rest"))
    edge = bins.groupBy(F.col("_source").alias("_es")).agg(F.min(F.struct(F.col("_bin").alias("bin"), (F.col("after") - F.col("words")).alias("before"))).alias("edge"))
    met = met.join(edge, F.col("_source").eqNullSafe(F.col("_es")), "left")
    whole = met.where(F.col("edge").isNull() | (F.col("_bin") < F.col("edge.bin"))).select("_source", "_q", "_drawn", "_words")
    along = Window.partitionBy("_source").orderBy("_q", "_drawn")  # its default frame counts equal rows together
    cut = met.where(F.col("_bin") == F.col("edge.bin")).withColumn("fits", F.col("edge.before") + F.sum("_words").over(along) <= F.col("_rest"))
    took = whole.unionByName(cut.where("fits").select("_source", "_q", "_drawn", "_words")).groupBy(F.col("_source").alias("_ts")).agg(
        F.max(F.struct("_q", "_drawn")).alias("last"), F.sum("_words").alias("used"))
    limit = F.lit(float("inf")) if first else F.col("_rest")
    decision = F.struct(limit.alias("limit"), F.col("last._q").alias("q"), F.col("last._drawn").alias("drawn"))
    after = state.join(took, F.col("_state").eqNullSafe(F.col("_ts")), "left").select(
        "_state", (F.col("_rest") - F.coalesce("used", F.lit(0))).alias("_rest"),
        F.when(F.col("last").isNull(), F.col("_decisions")).otherwise(F.concat("_decisions", F.array(decision))).alias("_decisions"))
    return materialise(after, "mix-pass")


def _cuts(units: DataFrame) -> DataFrame:
    """One row per source: its passes' decisions and the closing document."""
    state = units.groupBy(F.col("_source").alias("_state")).agg((F.first("target") - F.sum(F.col("_sure") * F.col("_words"))).alias("_rest"))
    state = materialise(state.withColumn("_decisions", F.array().cast(DECISIONS)), "mix-need")
    for k in range(1 + FILLS):
        state = _pass(units, state, first=k == 0)
    left = units.join(state, F.col("_source").eqNullSafe(F.col("_state"))).where(~_taken() & F.col("_q").isNotNull() & (F.col("_words") > 0))
    near = F.abs(F.col("_words") - F.col("_rest"))
    closing = (left.where(near < F.col("_rest")).groupBy(F.col("_source").alias("_ns"))
               .agg(F.min(F.struct(near.alias("near"), "_q", "_drawn")).alias("c")))
    return (state.join(closing, F.col("_state").eqNullSafe(F.col("_ns")), "left")
            .select(F.col("_state").alias("_cs"), "_decisions", F.col("c._drawn").alias("_closing")))


def _taken() -> Column:
    """Whether a pass has taken the row of the fractions' sample."""
    rank = F.struct(F.col("_q").alias("q"), F.col("_drawn").alias("drawn"))
    return F.col("_q").isNotNull() & F.coalesce(F.exists("_decisions", lambda x: (F.col("_size") <= x["limit"]) & (rank <= F.struct(x["q"].alias("q"), x["drawn"].alias("drawn")))), F.lit(False))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_copies: int = 3, seed: int = 1,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken = copies * size for each row.

    The ranking runs on one narrow row per distinct document (written once). What comes back to the
    documents is a few numbers per source, so the texts themselves are never shuffled for it.
    """
    docs, names = set_apart(docs)
    d = docs.select("*", *_draw(names[id_col], names[text_col], names[source_col], weight_col and names[weight_col], seed))
    units = materialise(d.groupBy("_source", "_drawn", "_w", "_size").agg(F.sum("_size").alias("_words")), "mix-units")
    mass = units.groupBy("_source").agg(F.sum("_words").alias("source_size"), F.sum(F.col("_words") * F.col("_w")).alias("_mass"))
    targets = source_targets(mass.select(F.col("_source").alias("source"), "source_size"), weights, max_copies)
    mass = mass.select(F.col("_source").alias("_ms"), "_mass")
    rates = materialise(targets.join(mass, F.col("source").eqNullSafe(F.col("_ms"))).select(
        "source", "source_size", "target", F.when(F.col("_mass") > 0, F.col("target") / F.col("_mass")).otherwise(0.0).alias("_rate")), "mix-rates")
    cuts = materialise(_cuts(materialise(_ranked(units, rates, max_copies), "mix-ranks")), "mix-cuts")
    d = _ranked(d, rates, max_copies).join(cuts, F.col("_source").eqNullSafe(F.col("_cs")), "left")
    closing = F.coalesce(F.col("_drawn") == F.col("_closing"), F.lit(False)) & ~_taken()
    copies = (F.col("_sure") + (_taken() | closing).cast("long")).alias("copies")
    dealt = d.select(*names.values(), F.col("_size").alias("size"), "source_size", "target", copies)
    return named_back(dealt.withColumn("taken", F.col("copies") * F.col("size")), names, ADDED, ADDED)
