"""N-gram Jaccard self-join by vertical partitioning.

A document's set holds the 64-bit hashes of its distinct n-word shingles (a shorter document's whole
word sequence is its only one). Two documents link when 100 * intersection >= percent * union. Documents with
equal sets are one class, and the join runs between classes.

The global n-gram order puts n-grams that one class alone has first, then the others by rarity.
It is cut into fragments by hash range; all segments of a range meet in one fragment, which counts its
n-grams' frequencies and, for each class, how many of its segment's n-grams are shared at all. The
fragments' counts are summed per class: a class whose shared n-grams can't reach the threshold links
with nothing, and only the rest, the near copies of something, goes on. For these,

* candidates share an n-gram of their prefixes (what a set may miss of another, plus one, in the
  global order; the smaller set of a pair may miss less), and their sizes and shared counts leave the
  threshold in reach;
* a pair's overlap is counted separately in each fragment of the order and summed per pair.

A group of near copies doesn't become all its pairs: first each prefix n-gram's documents are joined
with the one of them that has the fewest unshared n-grams, and then only candidates of different
components are. So no link between components is lost, and what lies inside one isn't listed.

The shingles travel as packed arrays, one row for each fragment of about a million n-grams, so
a shuffle holds about 8 bytes an n-gram. The number of fragments follows the number of n-grams.
An n-gram that many classes have adds one entry per class to its fragment.

Defined cases: null texts and texts without words have an empty set, size 0, and link with nothing;
equal texts always link; repeated rows are copies; rows with a null id take part, and a component
of such rows only has a null id; an empty table gives an empty result. Texts are used whole.
The hashes are 64 bits; a collision can only change an overlap by one, or join two classes with
a chance of about (number of classes)^2 / 2^65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import connected

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: N-grams a task packs at once, and n-grams meant for one fragment; both bound a task's memory.
PACK, FRAGMENT = 1 << 19, 1 << 20
#: Fragments of the order in which overlaps of pairs are counted.
PARTS = 4
ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    import xxhash

    words = (text or "").encode().translate(LOWER).split()  # A-Z only; bytes split at the six ASCII blanks
    if not words:
        return np.empty(0, dtype=np.uint64)
    n = len(words) - width + 1
    if n < 1:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], dtype=np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    key = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        key = (key ^ one[k:k + n]) * ODD
        key ^= key >> np.uint64(32)
    return np.unique(key)


def class_of(tokens: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def with_class(docs: DataFrame, width: int, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with _class (null for an empty set) and _n, the size of the set."""
    schema = docs.select(*keep).schema.add("_class", "long").add("_n", "long")

    def run(batches):
        for b in batches:
            sets = [shingle_set(t, width) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())],
                names=[*keep, "_class", "_n"])

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def _segments(fragments: int, width: int):
    """Texts to packed segments: for a pack of documents and a fragment, the classes with the number
    of n-grams of each, and the n-grams."""
    def pack(owned: dict[int, np.ndarray]):
        classes = np.fromiter(owned, dtype=np.int64, count=len(owned))
        tokens = np.concatenate(list(owned.values()))
        owner = np.repeat(np.arange(len(owned)), [len(t) for t in owned.values()])
        fragment = ((tokens >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.uint32)
        order = np.argsort(fragment, kind="stable")  # so the owners stay together in a fragment
        fragment, owner, tokens = fragment[order], owner[order], tokens[order]
        cuts = np.flatnonzero(np.diff(fragment)) + 1
        rows = []
        for a, z in zip([0, *cuts], [*cuts, len(tokens)]):
            who, start = np.unique(owner[a:z], return_index=True)
            sizes = np.diff([*start, z - a]).astype(np.uint32)
            rows.append((int(fragment[a]), classes[who].tobytes(), sizes.tobytes(), tokens[a:z].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                          names=["fragment", "classes", "sizes", "tokens"])

    def run(batches):
        owned: dict[int, np.ndarray] = {}
        held = 0
        for b in batches:
            for text in b.column("_text").to_pylist():
                s = shingle_set(text, width)
                if len(s) and (c := class_of(s)) not in owned:
                    owned[c] = s
                    held += len(s)
                if held >= PACK:
                    yield pack(owned)
                    owned, held = {}, 0
        if held:
            yield pack(owned)
    return run


def _count_fragment(buckets: int):
    """One fragment: frequencies, then for each class its unshared n-grams and its shared ones."""
    def run(t: pa.Table) -> pa.Table:
        col = lambda name, kind: [np.frombuffer(x, dtype=kind) for x in t.column(name).to_pylist()]
        owner = np.concatenate([np.repeat(c, s) for c, s in zip(col("classes", np.int64), col("sizes", np.uint32))])
        tokens = np.concatenate(col("tokens", np.uint64))
        pa.default_memory_pool().release_unused()  # what earlier fragments and stages of this worker have freed
        order = np.lexsort((owner, tokens))
        owner, tokens = owner[order], tokens[order]
        once = np.ones(len(tokens), dtype=bool)  # a class that several packs hold counts once
        once[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        owner, tokens = owner[once], tokens[once]
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        runs = np.diff([*first, len(tokens)])
        frequency = np.repeat(runs, runs).astype(np.uint32)
        order = np.lexsort((tokens, owner, owner.view(np.uint64) % np.uint64(buckets)))
        owner, tokens, frequency = owner[order], tokens[order], frequency[order]
        del order, once, first, runs
        shared = frequency > 1
        bucket = owner.view(np.uint64) % np.uint64(buckets)
        rows = []
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for a, z in zip([0, *cuts], [*cuts, len(tokens)]):
            start = np.flatnonzero(np.concatenate([[True], owner[a + 1:z] != owner[a:z - 1]]))
            sizes = np.diff([*start, z - a]).astype(np.uint32)
            kept = np.add.reduceat(shared[a:z].astype(np.uint32), start).astype(np.uint32)
            s = shared[a:z]
            rows.append((int(bucket[a]), owner[a:z][start].tobytes(), sizes.tobytes(), kept.tobytes(), tokens[a:z][s].tobytes(), frequency[a:z][s].tobytes()))
        kinds = (pa.int32(), *[pa.binary()] * 5)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "classes", "sizes", "kept", "tokens", "frequency"])
    return run


def _sum_classes(percent: int):
    """One bucket of classes: sums over the fragments, and the rows of those that may link."""
    def run(t: pa.Table) -> pa.Table:
        col = lambda name, kind: np.concatenate([np.frombuffer(x, dtype=kind) for x in t.column(name).to_pylist()])
        part, sizes, kept = col("classes", np.int64), col("sizes", np.uint32).astype(np.int64), col("kept", np.uint32).astype(np.int64)
        classes, at = np.unique(part, return_inverse=True)
        n = np.bincount(at, weights=sizes).astype(np.int64)
        m = np.bincount(at, weights=kept).astype(np.int64)
        need = -(-percent * n // 100)
        stays = m >= need
        owner = np.repeat(at, kept)
        tokens, frequency = col("tokens", np.uint64), col("frequency", np.uint32)
        mine = stays[owner]
        owner, tokens, frequency = owner[mine], tokens[mine], frequency[mine]
        order = np.lexsort((tokens, frequency, owner))
        ends = np.cumsum(m[stays])
        values = pa.array(tokens[order].view(np.int64))
        need_of_larger = -(-2 * percent * n // (100 + percent))
        return pa.Table.from_arrays(
            [pa.array(classes[stays]), pa.array(n[stays]), pa.array(m[stays]), pa.array((m - need + 1)[stays].astype(np.int32)),
             pa.array(np.maximum(m - need_of_larger + 1, 0)[stays].astype(np.int32)),
             pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)],
            names=["class", "n", "m", "prefix", "short_prefix", "tokens"])
    return run


def near_classes(docs: DataFrame, width: int, percent: int, n_grams: int, text_col: str) -> DataFrame:
    """(class, n, m, prefix, short_prefix, tokens) of the classes that may link: size, shared n-grams in the
    global order, and how many of these the prefix filter has to look at, for any partner and for
    partners that aren't smaller (these have to share more, so fewer n-grams can be missed)."""
    fragments = max(1, -(-n_grams // FRAGMENT))
    buckets = min(fragments, 256)
    segments = docs.select(F.col(text_col).alias("_text")).mapInArrow(
        _segments(fragments, width), "fragment int, classes binary, sizes binary, tokens binary")
    counted = segments.groupBy("fragment").applyInArrow(
        _count_fragment(buckets), "bucket int, classes binary, sizes binary, kept binary, tokens binary, frequency binary")
    return counted.groupBy("bucket").applyInArrow(_sum_classes(percent), "class long, n long, m long, prefix int, short_prefix int, tokens array<bigint>")


def _in_reach(percent: int):
    """Sizes n, shared counts m of a and b: the most they can overlap reaches the threshold."""
    most = F.least("a.m", "b.m")
    return 100 * most >= percent * (F.col("a.n") + F.col("b.n") - most)


def linked(pairs: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) that link: overlaps counted in each part of the order, then summed."""
    def of_part(k: int):  # by the hash's first two bits: PARTS equal ranges
        return F.filter("tokens", lambda x: F.shiftrightunsigned(x, 62) == k)

    cut = F.array(*map(of_part, range(PARTS)))
    pieces = near.select(F.col("class"), F.posexplode(cut).alias("part", "piece")).where(F.size("piece") > 0)
    a = pieces.select(F.col("class").alias("a"), "part", F.col("piece").alias("pa"))
    b = pieces.select(F.col("class").alias("b"), F.col("part").alias("part_b"), F.col("piece").alias("pb"))
    met = pairs.join(a, "a").join(b, (pairs["b"] == b["b"]) & (a["part"] == b["part_b"])).select(
        pairs["a"], pairs["b"], "na", "nb", F.size(F.array_intersect("pa", "pb")).alias("overlap"))
    summed = met.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("overlap").alias("overlap"))  # by a and b, so that they are distinct
    return summed.where(100 * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def _pairs(a: DataFrame, b: DataFrame, where, percent: int) -> DataFrame:
    return (a.alias("a").join(b.alias("b"), F.col("a.token") == F.col("b.token")).where(where & _in_reach(percent))
            .select(F.least("a.class", "b.class").alias("a"), F.greatest("a.class", "b.class").alias("b"),
                    F.when(F.col("a.class") < F.col("b.class"), F.col("a.n")).otherwise(F.col("b.n")).alias("na"),
                    F.when(F.col("a.class") < F.col("b.class"), F.col("b.n")).otherwise(F.col("a.n")).alias("nb")).distinct())


def class_components(near: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the classes that link with another class."""
    prefix = near.select("class", "n", "m", F.explode(F.slice("tokens", 1, F.col("prefix"))).alias("token"))
    hub = prefix.groupBy("token").agg(F.min(F.struct((F.col("n") - F.col("m")).alias("own"), "class", "n", "m")).alias("h"))
    hub = hub.select("token", "h.class", "h.n", "h.m")
    so_far = connected(linked(_pairs(prefix, hub, F.col("a.class") != F.col("b.class"), percent), near, percent))
    rooted = near.join(so_far.select(F.col("node").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    entries = lambda length: rooted.select("class", "n", "m", "root", F.explode(F.slice("tokens", 1, F.col(length))).alias("token"))
    smaller = F.struct("a.n", "a.m", "a.class") < F.struct("b.n", "b.m", "b.class")
    across = _pairs(entries("short_prefix"), entries("prefix"), smaller & (F.col("a.root") != F.col("b.root")), percent)
    second = linked(across, near, percent)
    second = materialise(second, "cross-links")
    if second.isEmpty():
        return so_far
    tied = so_far.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(second)
    return connected(tied)


def _members(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, _class, _n) of all rows, and (_class, _first, n_copies, root) of all classes with n-grams."""
    rows = materialise(with_class(docs, width, text_col, [id_col]), "shingle-sets")
    classes = rows.where("_n > 0").groupBy("_class").agg(F.min(id_col).alias("_first"), F.max("_n").alias("_n"), F.count(F.lit(1)).alias("n_copies"))
    n_grams = classes.agg(F.sum("_n")).first()[0] or 0
    near = materialise(near_classes(docs, width, percent, n_grams, text_col), "near-classes")
    roots = class_components(near, percent).withColumnRenamed("node", "_class")
    members = classes.drop("_n").join(roots, "_class", "left").withColumn("root", F.coalesce("root", "_class"))
    return rows, materialise(members, "members")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, _class, n_shingles, n_copies, component_id) for each row of ``docs``: its class of equal sets, the
    size of its set, the number of rows in its class, and the smallest id that links reach from it."""
    rows, members = _members(docs, width, percent, id_col, text_col)
    least = members.groupBy("root").agg(F.min("_first").alias("component_id"))
    of_class = members.join(least, "root").select(F.col("_class").alias("_c"), "n_copies", "component_id")
    joined = rows.join(of_class, F.col("_class") == F.col("_c"), "left")
    return joined.select(id_col, "_class", F.col("_n").alias("n_shingles"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
                         F.when(F.col("_class").isNull(), F.col(id_col)).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (null ids last); rows without words all stay."""
    _, members = _members(docs, width, percent, id_col, text_col)
    order = F.struct(F.col("_first").isNull().alias("no_id"), "_first", "_class")
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("_key")  # noqa: E731  so that null ids join
    chosen = members.groupBy("root").agg(F.min(order).alias("o")).select(F.col("o._class").alias("_class"), F.col("o._first").alias("_first"))
    chosen = materialise(chosen.select("_class", key("_first")), "chosen")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key(id_col), F.col(text_col).alias("_text_of"))
    classed = with_class(whole, width, "_text_of", ["_row", "_key"])
    kept = classed.join(chosen, ["_key", "_class"]).dropDuplicates(["_key", "_class"])
    return kept.select("_row.*").unionByName(classed.where(F.col("_class").isNull()).select("_row.*"))
