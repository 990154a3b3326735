"""Training-order materialisation: every token sequence at its global slot, in fixed-stride shards.

Texts become token ids (two bytes each, little endian), documents follow each other with an end
token between them, and the stream of each input partition is cut into records of ``length`` tokens.
The records are written once as a table, which numbers them densely from 0 to N - 1 (partition by
partition). A keyed Feistel network permutes the smallest power of four that holds N, and cycle-walking
(applying it again while the value is N or more) makes that a permutation of 0 to N - 1: the slot. It needs no
sort and no table, can be inverted, and gives any rank of any training job its records by arithmetic.

Slots are dealt to shards by range, ``per_shard`` consecutive slots each. A shard file is its records one
after another with a fixed stride (the record, then one line feed that the text sink writes), so slot
s is at byte (s % per_shard) * stride of shard s // per_shard, and a reader resumes anywhere.

Defined cases: null and empty texts have no tokens and appear in no record; repeated rows appear as
often as they come; a null id is carried as null; strings of special tokens in a text are ordinary text; the last
record of a partition is filled up with end tokens, beyond its n_tokens; an empty table has no records;
columns beside id and text don't matter. A long text runs over as many records as it needs.
Given the written table a slot never changes. Reruns agree as long as the input is read in the same partitions.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise, shared_folder

SEQUENCE = "part int, ordinal long, n_tokens int, docs array<struct<doc_id: long, first: int, n: int>>, record binary"
MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A keyed permutation of range(n) and its inverse, on arrays."""

    ROUNDS = 6

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.low = np.uint64((1 << int(self.half)) - 1)
        seeds = (np.arange(1, self.ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(key & MASK)
        self.keys = _mix(seeds)

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(np.asarray(x).astype(np.uint64))
        while (out := x >= self.n).any():
            x[out] = step(x[out])
        return x.astype(np.int64)

    def _forward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.low
        for k in self.keys:
            left, right = right, left ^ (_mix(right ^ k) & self.low)
        return (left << self.half) | right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.low
        for k in self.keys[::-1]:
            left, right = right ^ (_mix(left ^ k) & self.low), left
        return (left << self.half) | right

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self._forward)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self._backward)


_BPE: dict[int, object] = {}


def bpe(ranks_file: bytes):
    """The tokenizer of a rank file; one for each Python worker."""
    import public_tokenizers
    import tiktoken

    if (key := hash(ranks_file)) not in _BPE:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks_file.splitlines())}
        _BPE[key] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _BPE[key]


def _pairs(b: pa.RecordBatch, some: int = 256):
    """The rows of two columns as Python values, of a few rows at a time: a batch may hold many long texts."""
    for at in range(0, b.num_rows, some):
        part = b.slice(at, some)
        yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def _records(ranks, end: int, length: int):
    def run(batches):
        enc = bpe(ranks.value)
        part, ordinal = TaskContext.get().partitionId(), 0
        fill, docs, rows = np.full(length, end, dtype="<u2"), [], []
        at = 0

        def batch():
            cols = zip(*rows)
            kinds = [f.type for f in schema]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], schema=schema)

        schema = pa.schema([("part", pa.int32()), ("ordinal", pa.int64()), ("n_tokens", pa.int32()),
                            ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("first", pa.int32()), ("n", pa.int32())]))), ("record", pa.binary())])
        for b in batches:
            for doc_id, text in _pairs(b):
                if not text:
                    continue
                ids = np.array([*enc.encode_ordinary(text), end], dtype="<u2")
                while len(ids):
                    n = min(len(ids), length - at)
                    fill[at:at + n] = ids[:n]
                    docs.append({"doc_id": doc_id, "first": at, "n": n})
                    ids, at = ids[n:], at + n
                    if at == length:
                        rows.append((part, ordinal, at, docs, fill.tobytes()))
                        ordinal, at, docs = ordinal + 1, 0, []
                if len(rows) >= 1024:
                    yield batch()
                    rows = []
        if at:
            fill[at:] = end
            rows.append((part, ordinal, at, docs, fill.tobytes()))
        if rows:
            yield batch()
    return run


#: zstd's level for tokens that are written or shuffled: of the levels tried the last that still takes much less than the one before.
LEVEL = 5


def token_records(docs: DataFrame, ranks_file: bytes, end: int, length: int, id_col: str = "doc_id", text_col: str = "text",
                  path: str | None = None) -> DataFrame:
    """The written table of records (in a folder of its own, or in ``path``), see SEQUENCE; ``end`` is the id of the end token."""
    if end >= 1 << 16:
        raise ValueError("token ids are kept in two bytes")
    return materialise(_unwritten(docs, ranks_file, end, length, id_col, text_col), "token-records", level=LEVEL, path=path)


def _unwritten(docs: DataFrame, ranks_file: bytes, end: int, length: int, id_col: str, text_col: str) -> DataFrame:
    ranks = docs.sparkSession.sparkContext.broadcast(ranks_file)  # a vocabulary file, of fixed size
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return texts.mapInArrow(_records(ranks, end, length), SEQUENCE)


def _pack(records: bytes) -> bytes:
    return pa.Codec("zstd", LEVEL).compress(records, asbytes=True)


def _unpack(packed: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(packed, size, asbytes=True)


#: Records that a task gathers before it packs them in groups, some 8 MB of 1,024 tokens each.
GATHERED = 4096


def numbering(records: DataFrame) -> tuple[DataFrame, int]:
    """(_p, _offset): the number of each input partition's first record, written, and the number of all records."""
    counts = records.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(counts.select(F.col("part").alias("_p"), "n", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("_offset")), "offsets")
    return offsets.drop("n"), offsets.agg(F.sum("n")).first()[0] or 0


def _numbered(records: DataFrame, offsets: DataFrame) -> DataFrame:
    return records.join(F.broadcast(offsets), F.col("part") == F.col("_p"))  # a row for each input partition


def _tasks(records: DataFrame, shards: int) -> int:
    return min(shards, max(1, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4))


def in_training_order(records: DataFrame, key: int, per_shard: int, numbers: tuple[DataFrame, int] | None = None) -> DataFrame:
    """(slot, shard, place, n_tokens, docs, record): each shard whole in one partition, in the order of its slots."""
    offsets, n = numbers or numbering(records)
    shards = max(1, -(-n // per_shard))
    order = Permutation(n, key)

    @F.pandas_udf("long")
    def slot_of(index: pd.Series) -> pd.Series:
        return pd.Series(order.slot(index.to_numpy()))

    slot = slot_of(F.col("_offset") + F.col("ordinal"))
    carried = [c for c in ("n_tokens", "docs", "record") if c in records.columns]
    placed = _numbered(records, offsets).select(slot.alias("slot"), *carried)
    placed = placed.select("slot", F.floor(F.col("slot") / per_shard).cast("int").alias("shard"),
                           (F.col("slot") % per_shard).cast("int").alias("place"), *carried)
    tasks = _tasks(records, shards)
    deal = F.floor(F.col("shard").cast("long") * tasks / shards).cast("int")
    return placed.repartitionById(tasks, deal).sortWithinPartitions("shard", "slot")


def _fixed(data: bytes, size: int) -> pa.Array:
    """The records of ``size`` bytes that lie one after another in ``data``, without a copy."""
    n = len(data) // size
    ends = np.arange(0, (n + 1) * size, size, dtype="<i4")
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _matrix(records: pa.Array) -> np.ndarray:
    """The bytes of records of one size, a row each, without a copy."""
    ends = np.frombuffer(records.buffers()[1], "<i4")[records.offset:records.offset + len(records) + 1]
    return np.frombuffer(records.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(len(records), -1)


def pack_groups(order: Permutation, per_shard: int, tasks: int, gathered: int = GATHERED):
    """Of batches (index, record): (task, slots, packed), the gathered records of each task packed as one, in the order of their
    slots. Packed together they take a fifth less than one by one, and are fewer rows."""
    shards = max(1, -(-order.n // per_shard))

    def packed(parts: list) -> pa.RecordBatch:
        slot = order.slot(np.concatenate([index for index, _ in parts]))
        by_slot = np.argsort(slot)
        slot, raw = slot[by_slot].astype("<i8"), np.concatenate([records for _, records in parts])
        task = slot // per_shard * tasks // shards
        cuts = [0, *(np.flatnonzero(np.diff(task)) + 1).tolist(), len(task)]
        rows = [(int(task[a]), slot[a:b].tobytes(), _pack(raw[by_slot[a:b]].tobytes())) for a, b in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["task", "slots", "packed"])

    def run(batches):
        pa.default_memory_pool().release_unused()  # what earlier stages of this worker have freed
        parts, n = [], 0
        for b in batches:
            if b.num_rows:
                parts.append((b.column(0).to_numpy(zero_copy_only=False), _matrix(b.column(1))))
            if (n := n + b.num_rows) >= gathered:
                yield packed(parts)
                parts, n = [], 0
        if n:
            yield packed(parts)
    return run


def unpack_groups(size: int):
    """(slot, record) of all records of packed groups; ``size`` is the bytes of a record."""
    def run(batches):
        pa.default_memory_pool().release_unused()
        for b in batches:
            for slots, packed in _pairs(b, 1):
                slot = np.frombuffer(slots, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(slot), _fixed(_unpack(packed, len(slot) * size), size)], names=["slot", "record"])
    return run


def _raw_in_order(records: DataFrame, key: int, per_shard: int, size: int, numbers: tuple[DataFrame, int]) -> DataFrame:
    """(shard, record) as in_training_order has them, the records packed in groups while they cross the shuffle."""
    offsets, n = numbers
    tasks = _tasks(records, max(1, -(-n // per_shard)))
    indexed = _numbered(records, offsets).select((F.col("_offset") + F.col("ordinal")).alias("index"), "record")
    groups = indexed.mapInArrow(pack_groups(Permutation(n, key), per_shard, tasks), "task int, slots binary, packed binary")
    dealt = groups.repartitionById(tasks, F.col("task")).select("slots", "packed").mapInArrow(unpack_groups(size), "slot long, record binary")
    placed = dealt.select("slot", F.floor(F.col("slot") / per_shard).cast("int").alias("shard"), "record")
    return placed.sortWithinPartitions("shard", "slot").select("shard", "record")


def write_shards(ordered: DataFrame, folder: str) -> None:
    """Raw shard files folder/records/shard=k/part-* and their index folder/index (slot, shard, place, n_tokens, docs)."""
    as_text = ordered.select("shard", F.col("record").cast("string").alias("value"))
    as_text.write.partitionBy("shard").option("lineSep", "\n").text(f"{folder}/records")
    ordered.drop("record").write.parquet(f"{folder}/index")


def write_training_order(docs: DataFrame, ranks_file: bytes, end: int, length: int, key: int, per_shard: int, folder: str,
                         id_col: str = "doc_id", text_col: str = "text") -> None:
    """The files of write_shards for the records of ``docs``. Every text is encoded once: the written table of the records
    numbers them, and they are dealt from it. The table goes once the files are there."""
    spark = docs.sparkSession
    table = shared_folder(spark, "token-records")
    records = token_records(docs, ranks_file, end, length, id_col, text_col, table)
    numbers = numbering(records)
    in_training_order(records.drop("record"), key, per_shard, numbers).write.parquet(f"{folder}/index")
    ordered = _raw_in_order(records, key, per_shard, 2 * length, numbers)
    as_text = ordered.select("shard", F.col("record").cast("string").alias("value"))
    as_text.write.partitionBy("shard").option("lineSep", "\n").text(f"{folder}/records")
    discard(spark, table)


def read_training_order(spark: SparkSession, folder: str, length: int) -> DataFrame:
    """(slot, shard, place, n_tokens, docs, record) of all records, read back from the raw files by their stride, shard
    by shard in the order of their slots."""
    names = ["slot", "shard", "place", "n_tokens", "docs"]

    size = 2 * length

    def matched(index: pa.Table, found: pa.Table) -> pa.Table:
        index, found = index.sort_by("place"), found.sort_by("first")
        places = [place for first, n in zip(found["first"].to_pylist(), found["n"].to_pylist()) for place in range(first, first + n)]
        if index["place"].to_pylist() != places:
            raise ValueError("a shard file doesn't have the records of its index")
        parts = [_fixed(_unpack(p, n * size), size) for p, n in zip(found["packed"].to_pylist(), found["n"].to_pylist())]
        return index.select(names).append_column("record", pa.chunked_array(parts, pa.binary()))

    def packed(batches):
        for shard, first, records in _stretches(batches, length):
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([first], pa.int32()), pa.array([len(records)], pa.int32()),
                                              pa.array([_pack(records.tobytes())], pa.binary())], names=["shard", "first", "n", "packed"])

    index = spark.read.parquet(f"{folder}/index").select(names)
    found = _raw_files(spark, folder).mapInArrow(packed, "shard int, first int, n int, packed binary")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema.fields)
    return index.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(matched, f"{kinds}, record binary")


def _raw_files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{folder}/records")
    return files.select("path", "content")


def _stretches(batches, length: int):
    """(shard, place of the first, records as rows of bytes) of up to 1,024 consecutive records of the raw files, cut by their stride alone."""
    stride = 2 * length + 1
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content")):  # the files' bytes stay in the batch
            shard = int(path.rsplit("shard=", 1)[1].split("/", 1)[0])
            lines = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
            for at in range(0, len(lines), 1024):
                yield shard, at, lines[at:at + 1024, :-1]


def read_shards(spark: SparkSession, folder: str, length: int) -> DataFrame:
    """(shard, place, record) read back from the raw files by their stride alone."""
    def cut(batches):
        for shard, first, got in _stretches(batches, length):
            yield pa.RecordBatch.from_arrays([pa.array([shard] * len(got), pa.int32()), pa.array(range(first, first + len(got)), pa.int32()),
                                              _fixed(got.tobytes(), 2 * length)], names=["shard", "place", "record"])

    return _raw_files(spark, folder).mapInArrow(cut, "shard int, place int, record binary")
