"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The text is escaped as the model says (a blank becomes U+2581, one is put before the text) and starts as
single characters. Every adjacent pair whose union is in the vocabulary stands on an agenda, ordered by
score and then by place from the left; the best pair is merged, the pairs of the merged symbol with its
neighbours join the agenda, and pairs one of whose symbols has changed since are passed over. What is left
becomes ids; characters the vocabulary lacks become byte pieces, or the unknown id where there are none.

No merge can cross a place whose two characters stand side by side in no piece. So a text is cut before
blanks that follow other characters and around characters outside the alphabet of longer pieces. Equal
cuts are encoded once, in a memo of bounded size. Both hold only where the vocabulary allows them, which is read from it.

``encode_texts`` works in Arrow batches, and holds every text's ids against the sentencepiece library in the same
batch (``agrees``). ``decode_texts`` turns ids back into text with the library or by the pieces themselves.

Defined cases: null text counts as empty, which gives the begin and end ids alone; repeated rows come back each;
an empty table gives an empty result; texts of any length are taken whole; U+2581 in a text can't be told from a
blank, as in the library; control strings such as "</s>" in a text are ordinary text; a null id is carried; columns
beside id and text don't matter and don't come back. Models that are not BPE, that normalise, trim blanks,
put them behind words, or have user-defined or unused pieces are refused with a ValueError.
"""

from __future__ import annotations

import heapq
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Cuts a worker remembers (the memo starts afresh beyond it), and the longest cut that is remembered.
MEMO, LONGEST = 1 << 20, 48
#: Symbols up to which the agenda is a plain list, and the order of a pair that is no piece.
SHORT, OFF = 32, float("inf")
#: Rows of a returned batch, and the characters that end one earlier.
ROWS_OUT, CHARS_OUT = 2048, 1 << 22

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _message(raw: bytes):
    """The (field number, value) pairs of a protocol buffer message, in their order."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        field, kind = key >> 3, key & 7
        if kind == 0:
            yield field, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield field, raw[at:at + size]
        at += size


class PieceModel:
    """A BPE model file's pieces and rules, with its own encoder and decoder."""

    def __init__(self, model: bytes):
        pieces, trainer, normaliser = [], {}, {}
        for field, value in _message(model):
            if field == 1:
                got = dict(_message(value))
                pieces.append((got[1].decode(), struct.unpack("<f", got.get(2, bytes(4)))[0], got.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_message(value))
            elif field == 3:
                normaliser = dict(_message(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("not a merge-type (BPE) vocabulary")
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1) or trainer.get(24, 0):
            raise ValueError("the model normalises texts, trims blanks or puts them behind words")
        kinds = {kind for _, _, kind in pieces}
        if kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("the vocabulary has user-defined or unused pieces")
        self.prefix = BLANK if normaliser.get(3, 1) else ""
        self.pieces = pieces
        self.ids = {p: k for k, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.order = {p: -score for p, score, kind in pieces if kind == NORMAL and len(p) > 1}
        self.bytes = {int(p[3:5], 16): k for k, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown = next(k for k, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.joined = {p[k:k + 2] for p in self.order for k in range(len(p) - 1)}
        self.marks = "".join(sorted({c for p in self.order for c in p if not c.isalnum()} - {BLANK}))
        self.memo: dict[str, bytes] = {}
        self.cut = self._cuts()

    def _cuts(self) -> re.Pattern:
        joining = {c for p in self.order for c in p} - {BLANK}
        inner = any(BLANK in p.lstrip(BLANK) for p in self.order)
        if inner or not joining:  # pieces hold blanks behind other characters: no cut before blanks
            joining |= {BLANK}
            letters = "".join(map(re.escape, sorted(joining)))
            return re.compile(f"[{letters}]+|[^{letters}]+")
        letters = "".join(map(re.escape, sorted(joining)))
        return re.compile(f"{BLANK}*[{letters}]+|{BLANK}+|[^{letters}{BLANK}]+")

    def merge(self, text: str) -> list[str]:
        """The symbols the agenda leaves of a (cut of a) text. A short agenda is a list searched for its best pair, a
        long one a heap."""
        symbols = list(text)
        n = len(symbols)
        if n < 2:
            return symbols
        if n <= SHORT:
            get = self.order.get
            agenda = [get(text[k:k + 2], OFF) for k in range(n - 1)]
            while agenda and (best := min(agenda)) < OFF:
                k = agenda.index(best)
                symbols[k] += symbols.pop(k + 1)
                agenda.pop(k)
                if k < len(agenda):
                    agenda[k] = get(symbols[k] + symbols[k + 1], OFF)
                if k:
                    agenda[k - 1] = get(symbols[k - 1] + symbols[k], OFF)
            return symbols
        order, before, after = self.order, list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(order[pair], k, k + 1, 2) for k in range(n - 1) if (pair := symbols[k] + symbols[k + 1]) in order]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue  # one of the two has been merged since
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = nxt = after[right]
            if nxt < n:
                before[nxt] = left
                if (pair := symbols[left] + symbols[nxt]) in order:
                    heapq.heappush(agenda, (order[pair], left, nxt, len(pair)))
            if (prev := before[left]) >= 0 and (pair := symbols[prev] + symbols[left]) in order:
                heapq.heappush(agenda, (order[pair], prev, left, len(pair)))
        return [s for s in symbols if s]

    def _parted(self, cut: str) -> bytes:
        """The ids of a cut; marks that end it are taken apart from it where no piece joins the two."""
        body = cut.rstrip(self.marks)
        if body and body != cut and body[-1] + cut[len(body)] not in self.joined:
            return self._known(body) + self._known(cut[len(body):])
        return self._ids(cut)

    def _known(self, cut: str) -> bytes:
        got = self.memo.get(cut)
        if got is None:
            got = self._ids(cut)
            if len(cut) <= LONGEST:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[cut] = got
        return got

    def _ids(self, cut: str) -> bytes:
        ids = []
        for symbol in self.merge(cut):
            known = self.ids.get(symbol)
            if known is not None:
                ids.append(known)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in symbol.encode())
            elif not ids or ids[-1] != self.unknown:  # unknown symbols side by side are one
                ids.append(self.unknown)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The ids of the whole text without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        escaped = self.prefix + text.replace(" ", BLANK)
        if not self.bytes:  # unknown symbols of neighbouring cuts would be one
            return self._ids(escaped)
        cuts, memo = self.cut.findall(escaped), self.memo
        out = [memo.get(cut) for cut in cuts]
        for k, got in enumerate(out):
            if got is None:
                cut = cuts[k]
                out[k] = got = memo.get(cut) or self._parted(cut)
                if len(cut) <= LONGEST:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[cut] = got
        return b"".join(out)

    def decode(self, ids) -> str:
        """The text of ids by their pieces: control ids are nothing, byte ids runs of UTF-8, and the blank that
        stands before the text goes."""
        out, raw = [], bytearray()

        def flush():
            if raw:
                out.append(raw.decode("utf-8", errors="replace"))
                raw.clear()

        for k in ids:
            piece, _, kind = self.pieces[k]
            if kind == BYTE:
                raw.append(int(piece[3:5], 16))
                continue
            flush()
            if kind == CONTROL:
                continue
            if kind == UNKNOWN:
                out.append(self.unknown_text)
                continue
            if self.prefix and not any(out):
                piece = piece.removeprefix(BLANK) if not out else piece
            out.append(piece.replace(BLANK, " "))
        flush()
        return "".join(out)


_MODELS: dict[int, tuple] = {}


def model_of(model: bytes):
    """(own model, library's processor) of a model file; one for each Python worker."""
    import sentencepiece

    if (key := hash(model)) not in _MODELS:
        _MODELS[key] = PieceModel(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    return _MODELS[key]


ENCODED = "doc_id long, n_tokens long, ids binary, agrees boolean, decoded string"


def _batches(model, begin: bool, end: bool):
    def run(batches):
        own, library = model_of(model.value)
        first = struct.pack("<I", own.begin) if begin else b""
        last = struct.pack("<I", own.end) if end else b""

        def rows(doc_ids, texts):
            distinct = {t: k for k, t in enumerate(dict.fromkeys(texts))}  # copies in a batch are encoded once
            packed = [first + own.encode(t) + last for t in distinct]
            ids = [np.frombuffer(p, dtype="<u4").tolist() for p in packed]
            agrees = list(map(list.__eq__, ids, library.encode(list(distinct), add_bos=begin, add_eos=end, num_threads=1)))
            decoded = library.decode(ids, num_threads=1)
            at = pa.array([distinct[t] for t in texts], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(map(len, ids), pa.int64()).take(at), pa.array(packed, pa.binary()).take(at),
                 pa.array(agrees, pa.bool_()).take(at), pa.array(decoded, pa.string()).take(at)], names=["doc_id", "n_tokens", "ids", "agrees", "decoded"])

        for b in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(doc_id)
                texts.append(text or "")
                size += len(text or "")
                if len(ids) >= ROWS_OUT or size >= CHARS_OUT:
                    yield rows(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield rows(ids, texts)
    return run


def encode_texts(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                 begin: bool = True, end: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, agrees, decoded) of every row: the agenda's ids, whether the library gives the same,
    and the library's text of them."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary file, of fixed size
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_batches(shipped, begin, end), ENCODED)


def decode_texts(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of packed ids, by the pieces alone; null ids give an empty text."""
    shipped = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own, _ = model_of(shipped.value)
        for b in batches:
            texts = [own.decode(np.frombuffer(p or b"", dtype="<u4").tolist()) for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")
