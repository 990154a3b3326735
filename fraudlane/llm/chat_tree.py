"""Chat formatting as a prefix tree.

A turn is formatted as ``<turn role>``, line feed, the escaped text, ``</turn>``, line feed. Escaping is
reversible and leaves no ``<`` in a text, so no text can open or close a turn. Conversations that begin
with the same turns share these turns' nodes of a tree. The forest's nodes are emitted once each,
depth-first, into one stream of token ids. A node carries its place in the stream, the position id of its
first token (the tokens of its ancestors come before it, whatever lies between them in the stream), the stream
intervals of its ancestors, to which attention is open, and the range of its tokens under the loss:
the text of assistant turns.

Depth-first order without walking a tree: distinct conversations are ranked by the sequence of their
nodes' digests (a range-partitioned sort). All that share a prefix are then neighbours, and a node belongs
to the first of its conversations. Ordering nodes by (rank of that conversation, depth) is the
depth-first order. So neither a hot first turn nor a common conversation meets in one task: they are minima and
counts, and joins of narrow rows.

Defined cases: turns are ordered by turn, then role, then text, nulls first; repeated rows are turns
like any others; a null text is empty, a null role too; a row without a conversation id is a conversation of its own (equal
such rows form one), returned with a null id; an empty table gives empty results; further
columns are ignored. A conversation is held by one task at a time, whole.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .training_order import bpe

ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g", "\n": "\\n"}
PLAIN = {v[1]: k for k, v in ESCAPES.items()}
TURN = re.compile(r"<turn ([^<>\n]*)>\n([^<]*)</turn>\n")
LEARNED_ROLE = "assistant"
BLOCK = 4096


def escape(text: str, also: str = "") -> str:
    """Reversible; ``also`` names further characters to escape beside backslash and <."""
    return "".join(ESCAPES[c] if c in "\\<" + also else c for c in text) if any(c in text for c in "\\<" + also) else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: PLAIN[m[1]], text)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the escaped text, and what stands behind it."""
    return f"<turn {escape(role, '>' + chr(10))}>\n", escape(text), "</turn>\n"


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation; anything else in it is an error."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


CHATS = "conv_id long, chat binary, path binary, nodes array<binary>, roles array<string>, texts array<string>"


def _chats(batches):
    """Ordered turns to digests: a node is named by all turns up to it, a chat by its last node."""
    for b in batches:
        rows = []
        for conv_id, turns in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            roles = [t["role"] or "" for t in turns]
            texts = [t["text"] or "" for t in turns]
            nodes, last = [], b""
            for role, text in zip(roles, texts):
                r, t = role.encode(), text.encode()
                last = hashlib.blake2b(last + len(r).to_bytes(8, "big") + r + t, digest_size=16).digest()
                nodes.append(last)
            rows.append((conv_id, last, b"".join(n[:8] for n in nodes), nodes, roles, texts))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.string()), pa.list_(pa.string()))
        names = [f.split()[0] for f in CHATS.split(", ")]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _number(batches):
    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("chat"), pa.array([part] * len(b), pa.int32()), pa.array(range(at, at + len(b)), pa.int64())],
                                         names=["chat", "part", "ordinal"])
        at += len(b)


def ranked(chats: DataFrame) -> DataFrame:
    """(chat, rank): distinct conversations in the order of their paths, numbered from 0."""
    distinct = chats.select("chat", "path").dropDuplicates(["chat"])
    tasks = max(1, int(chats.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    numbered = materialise(distinct.repartitionByRange(tasks, "path", "chat").sortWithinPartitions("path", "chat")
                           .mapInArrow(_number, "chat binary, part int, ordinal long"), "ranked")
    counts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", F.coalesce(before, F.lit(0)).alias("offset"))  # a row for each task
    return numbered.join(F.broadcast(offsets), "part").select("chat", (F.col("offset") + F.col("ordinal")).alias("rank"))


def _tokens(ranks):
    def run(batches):
        enc = bpe(ranks.value)
        for b in batches:
            cols = {"n_tokens": [], "tokens": [], "loss_from": [], "loss_to": []}
            for role, text in zip(b.column("role").to_pylist(), b.column("text").to_pylist()):
                before, body, behind = map(enc.encode_ordinary, format_turn(role, text))  # apart, so that the loss has whole tokens
                learned = len(body) if role == LEARNED_ROLE else 0
                cols["n_tokens"].append(len(before) + len(body) + len(behind))
                cols["tokens"].append(np.array(before + body + behind, dtype="<u2").tobytes())
                cols["loss_from"].append(len(before))
                cols["loss_to"].append(len(before) + learned)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("rank"), b.column("depth"), *[pa.array(v, pa.binary() if k == "tokens" else pa.int32()) for k, v in cols.items()]],
                names=["node", "rank", "depth", *cols])
    return run


def _paths(batches):
    """Per conversation, in depth order: position ids and merged ancestor intervals of the nodes it owns."""
    for b in batches:
        rows = []
        for rank, path in zip(b.column("rank").to_pylist(), b.column("path").to_pylist()):
            position, intervals = 0, []
            for step in path:
                if step["owner"] == rank:
                    rows.append((step["node"], position, [{"start": a, "end": z} for a, z in intervals]))
                end = step["start"] + step["n"]
                if intervals and intervals[-1][1] == step["start"]:
                    intervals[-1] = (intervals[-1][0], end)
                else:
                    intervals.append((step["start"], end))
                position += step["n"]
        if rows:
            kinds = (pa.binary(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["node", "position", "ancestors"])


def prefix_tree(conversations: DataFrame, ranks_file: bytes) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stream, steps, members). stream: one row per node (start, n_tokens, tokens, position, ancestors, loss_from,
    loss_to, depth); steps: the nodes' starts along each distinct conversation (chat, depth, start); members: conv_id
    and its chat."""
    spark = conversations.sparkSession
    turn = F.struct(F.col("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    grouped = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id"), alone.alias("alone")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    chats = materialise(grouped.select("conv_id", "turns").mapInArrow(_chats, CHATS), "chats")
    order = materialise(ranked(chats), "chat-ranks")

    distinct = chats.select("chat", "nodes", "roles", "texts").dropDuplicates(["chat"]).join(order, "chat")
    turns = distinct.select("chat", "rank", F.posexplode(F.arrays_zip("nodes", "roles", "texts")).alias("depth", "t")).select(
        "chat", "rank", "depth", F.col("t.nodes").alias("node"), F.col("t.roles").alias("role"), F.col("t.texts").alias("text"))
    turns = materialise(turns, "turns")
    owners = turns.groupBy("node").agg(F.min("rank").alias("owner"))
    owned = turns.join(owners, "node").where(F.col("rank") == F.col("owner")).select("node", "rank", "depth", "role", "text")
    shipped = spark.sparkContext.broadcast(ranks_file)  # a vocabulary file, of fixed size
    nodes = materialise(owned.mapInArrow(_tokens(shipped), "node binary, rank long, depth int, n_tokens int, tokens binary, loss_from int, loss_to int"), "nodes")

    runs = nodes.groupBy("rank").agg(F.sum("n_tokens").alias("n")).withColumn("block", F.floor(F.col("rank") / BLOCK))
    blocks = runs.groupBy("block").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each BLOCK conversations
    blocks = blocks.select("block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    in_block = Window.partitionBy("block").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("so_far", F.coalesce(F.sum("n").over(in_block), F.lit(0))).join(blocks, "block").select("rank", (F.col("base") + F.col("so_far")).alias("run_start"))
    in_run = Window.partitionBy("rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    starts = nodes.select("node", "rank", "n_tokens", F.coalesce(F.sum("n_tokens").over(in_run), F.lit(0)).alias("within")).join(runs, "rank")
    starts = materialise(starts.select("node", F.col("rank").alias("owner"), F.col("n_tokens").cast("long").alias("n"), (F.col("run_start") + F.col("within")).alias("start")), "starts")

    steps = materialise(turns.select("chat", "rank", "depth", "node").join(starts, "node"), "steps")
    paths = steps.groupBy("chat", "rank").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "owner", "start", "n"))).alias("path"))
    placed = paths.select("rank", "path").mapInArrow(_paths, "node binary, position long, ancestors array<struct<start: long, end: long>>")
    stream = nodes.join(starts.select("node", "start"), "node").join(placed, "node").select(
        "start", "n_tokens", "tokens", "position", "ancestors", "loss_from", "loss_to", "depth")
    return stream, steps.select("chat", "depth", "start"), chats.select("conv_id", "chat")


READ = "chat binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(ranks):
    def run(batches):
        enc = bpe(ranks.value)
        for b in batches:
            rows = []
            for chat, path in zip(b.column("chat").to_pylist(), b.column("path").to_pylist()):
                formatted, learned = [], []
                for step in path:
                    ids = np.frombuffer(step["tokens"], dtype="<u2").tolist()
                    formatted.append(enc.decode(ids))
                    learned.append(unescape(enc.decode(ids[step["loss_from"]:step["loss_to"]])))
                formatted, learned = "".join(formatted), "".join(learned)
                turns = parse_turns(formatted)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((chat, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned),
                             hashlib.sha256(learned.encode()).hexdigest(), len(formatted)))
            kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in READ.split(", ")])
    return run


def read_back(stream: DataFrame, steps: DataFrame, members: DataFrame, ranks_file: bytes) -> DataFrame:
    """What the emitted tokens say about each conversation: decoded, parsed, unescaped."""
    shipped = stream.sparkSession.sparkContext.broadcast(ranks_file)
    token_rows = stream.select("start", "tokens", "loss_from", "loss_to")
    paths = steps.join(token_rows, "start").groupBy("chat").agg(F.sort_array(F.collect_list(F.struct("depth", "start", "tokens", "loss_from", "loss_to"))).alias("path"))
    return members.join(paths.mapInArrow(_read(shipped), READ), "chat").drop("chat")
