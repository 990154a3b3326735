"""Quality rules by distribution divergence.

Each document's histogram of character classes and its histogram of common words are compared with
language references by the Jensen-Shannon distance (square root of the divergence in bits, 0 to 1).
The references are not given: they follow the corpus. With a source column, each distinct text that is
long enough and passes the base rules teaches once, each source of a language weighs the same, and sources far
from the middle of all teach nothing, so that no source decides alone. Without one, the references are the sums
over all documents of a language that are long enough. A document is held against its nearest
reference; its own language label is not trusted. Short documents are guarded: a histogram of few
counts is far from every reference by chance alone, so a distance only counts from a minimum length.

Defined cases: null and empty texts have no words and fail the base rules; a table without any
document to learn from has no references, and then the base rules alone decide; a text of several sources
teaches for the first by code point, null sources are one source; a language that is not listed teaches no reference,
and its documents have no distances, as none speaks for them; a document without a language teaches none and is held
against all; repeated rows and ties are judged alike; an empty table gives an empty result. Texts are read whole, in memory that grows
with the largest text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, named_back, set_apart

#: Function words of the reference languages.
COMMON_WORDS = {
    "en": "the of and to in is that it for was on with as be by at from this are or an not have which a he you his they we",
    "de": "der die und den das von zu mit im dem des nicht ein eine auf für als ist sich auch in an es er sie aus bei nach wie war",
    "fr": "le la de les des et en un une que qui dans pour par sur au pas du est avec il elle ce ne se plus son sont aux ou",
    "es": "de la que el en y a los del las se las por un para con no una su al lo es como más o pero sus le ya este",
}
WORDS = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
#: Each word as written in a sentence, at its start, or in capitals.
WORD_BIN = {form.encode(): k for k, w in enumerate(WORDS) for form in (w, w.capitalize(), w.upper())}
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
#: Character classes, by UTF-8 byte: lower case, upper case, digits, blanks, sentence marks, symbols,
#: other marks, lead bytes beyond ASCII (one for each such character); trailing bytes count nowhere.
N_CLASSES, WHITE_CLASS, SYMBOL_CLASS = 8, 3, 5


def _byte_classes() -> np.ndarray:
    of = np.full(256, 6, dtype=np.uint8)
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", WHITE, ".,;:!?'\"-()", SYMBOLS)):
        of[[ord(c) for c in chars]] = k
    of[0xC0:] = 7
    of[0x80:0xC0] = N_CLASSES
    return of


BYTE_CLASS = _byte_classes()


@dataclass(frozen=True)
class Rules:
    """Base rules, the guards and the largest distances a kept document may have."""

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    class_guard_chars: int = 300
    word_guard_words: int = 150
    max_class_distance: float = 0.30
    max_word_distance: float = 0.29


def repeated_words(words: list[bytes], window: int) -> int:
    """Words inside windows of ``window`` words that occur twice or more, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    one = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + one[k:k + n]
    ranked = np.sort(key)
    if not (ranked[1:] == ranked[:-1]).any():
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter((first.setdefault(w, len(first)) for w in words), dtype=np.int64, count=len(words))
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order][1:] == key[order][:-1])
    a, b = order[same], order[same + 1]
    equal = np.ones(len(a), dtype=bool)
    for k in range(window):  # the keys only propose; the words themselves decide
        equal &= ids[a + k] == ids[b + k]
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    hit = np.unique(np.concatenate([a[equal], b[equal]]))
    edge[hit] += 1
    edge[hit + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def class_histogram(raw: bytes) -> np.ndarray:
    return np.bincount(BYTE_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]


def word_histogram(words: list[bytes]) -> np.ndarray:
    """Counts by common word, with all other words in the last bin."""
    bins = np.fromiter(map(WORD_BIN.get, words, repeat(len(WORDS))), dtype=np.int64, count=len(words))
    return np.bincount(bins, minlength=len(WORDS) + 1)


def base_facts(text: str, raw: bytes, words: list[bytes], classes: np.ndarray, rules: Rules) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and whether the base rules fail."""
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    repeat_words = repeated_words(words, rules.window)
    failed = len(words) < rules.min_words or 100 * repeat_words > rules.max_repeat_percent * len(words)
    return (len(words), len(text) - int(classes[WHITE_CLASS]), int(classes[SYMBOL_CLASS]), dup, repeat_words, failed)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms with counts."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def part(x):
        k = x > 0
        return float((x[k] * np.log2(x[k] / m[k])).sum())

    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


def _learn(rules: Rules):
    def run(batches):
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for lang, text in zip(b.column("_lang").to_pylist(), b.column("_text").to_pylist()):
                raw = text.encode()
                words = raw.split()
                if len(words) < max(rules.min_words, rules.word_guard_words):
                    continue
                got = class_histogram(raw), word_histogram(words)
                have = sums.setdefault(lang, (np.zeros(N_CLASSES, np.int64), np.zeros(len(WORDS) + 1, np.int64)))
                have[0][:] += got[0]
                have[1][:] += got[1]
        rows = [(lang, kind, k, int(n)) for lang, both in sums.items() for kind, h in enumerate(both) for k, n in enumerate(h) if n]
        if rows:
            yield pa.RecordBatch.from_pydict({c: [r[i] for r in rows] for i, c in enumerate(("lang", "kind", "bin", "n"))},
                                             schema=pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())]))
    return run


def references(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The references by listed language: sums over all their documents that are long enough. The tasks
    send counts by bin only, so at most languages x bins numbers reach the driver."""
    texts = docs.where(F.col(lang_col).isin(sorted(COMMON_WORDS)) & F.col(text_col).isNotNull())
    counts = (texts.select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
              .mapInArrow(_learn(rules), "lang string, kind int, bin int, n long")
              .groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n")).collect())
    found = {lang: (np.zeros(N_CLASSES, np.int64), np.zeros(len(WORDS) + 1, np.int64)) for lang in sorted({r.lang for r in counts})}
    for r in counts:
        found[r.lang][r.kind][r.bin] = r.n
    return found


def _teach(rules: Rules):
    """Language, source, digest and counts of the texts that teach."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("digest", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        for b in batches:
            rows = []
            for lang, source, text in zip(*(b.column(k).to_pylist() for k in range(3))):
                raw = text.encode()
                words = raw.split()
                if len(words) < max(rules.min_words, rules.word_guard_words):
                    continue
                of_classes = class_histogram(raw)
                if not base_facts(text, raw, words, of_classes, rules)[5]:
                    counts = np.concatenate([of_classes, word_histogram(words)]).astype("<i4").tobytes()
                    rows.append((lang, source, hashlib.sha256(raw).digest()[:16], counts))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


#: Histograms are summed as whole numbers of this many parts, so that the order of the sums doesn't matter.
PARTS = 10 ** 8
#: Python keeps the sums of so many sources before it sends them on.
SOURCES_HELD = 4096
#: A source teaches as far as this many times the median distance of all sources from their medians.
FAR = 2.0


def _parts(h: np.ndarray) -> np.ndarray:
    return np.round(h * (PARTS / h.sum())).astype(np.int64)


def _source_sums(batches):
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("bin", pa.int32()), ("n", pa.int64())])

    def sent(sums):
        rows = [(*key, k, int(n)) for key, h in sums.items() for k, n in enumerate(h) if n]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    sums: dict[tuple, np.ndarray] = {}
    for b in batches:
        for lang, source, counts in zip(*(b.column(k).to_pylist() for k in range(3))):
            h = np.frombuffer(counts, "<i4")
            both = np.concatenate([_parts(h[:N_CLASSES]), _parts(h[N_CLASSES:])])
            sums[lang, source] = sums.get((lang, source), 0) + both
            if len(sums) >= SOURCES_HELD:
                yield sent(sums)
                sums = {}
    if sums:
        yield sent(sums)


def _source_histograms(batches):
    schema = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("parts", pa.list_(pa.int64()))])
    for b in batches:
        rows = []
        for lang, bins in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            h = np.zeros(N_CLASSES + len(WORDS) + 1)
            for r in bins:
                h[r["bin"]] = r["n"]
            rows += [(lang, kind, _parts(part).tolist()) for kind, part in enumerate((h[:N_CLASSES], h[N_CLASSES:]))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _distances(middles):
    def run(batches):
        for b in batches:
            far = [distance(np.array(h), middles[lang, kind]) for lang, kind, h in zip(*(b.column(k).to_pylist() for k in range(3)))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(far, pa.float64())], names=[*b.schema.names, "far"])
    return run


def source_references(docs: DataFrame, rules: Rules, text_col: str, lang_col: str, source_col: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The references by listed language, with one vote for each source: the mean histogram of the sources
    near the bin-wise median of all. Languages x bins numbers reach the driver."""
    texts = docs.where(F.col(lang_col).isin(sorted(COMMON_WORDS)) & F.col(text_col).isNotNull())
    taught = texts.select(F.col(lang_col).alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    once = (taught.mapInArrow(_teach(rules), "lang string, source string, digest binary, counts binary")
            .groupBy("lang", "digest").agg(F.min("source").alias("source"), F.first("counts").alias("counts")))
    sums = (once.select("lang", "source", "counts").mapInArrow(_source_sums, "lang string, source string, bin int, n long")
            .groupBy("lang", "source", "bin").agg(F.sum(F.col("n").cast("decimal(38,0)")).cast("double").alias("n")))
    bins = sums.groupBy("lang", "source").agg(F.collect_list(F.struct("bin", "n")).alias("bins")).select("lang", "bins")
    each = materialise(bins.mapInArrow(_source_histograms, "lang string, kind int, parts array<bigint>"), "source-histograms")

    def histograms(rows: DataFrame, of_bin) -> dict[tuple, np.ndarray]:
        found: dict[tuple, np.ndarray] = {}
        for r in rows.select("lang", "kind", F.posexplode("parts")).groupBy("lang", "kind", "pos").agg(of_bin.alias("n")).collect():
            found.setdefault((r.lang, r.kind), np.zeros((N_CLASSES, len(WORDS) + 1)[r.kind]))[r.pos] = r.n
        return found

    middles = histograms(each, F.percentile_approx("col", 0.5, 10000))
    if not middles:
        return {}
    measured = each.mapInArrow(_distances(middles), "lang string, kind int, parts array<bigint>, far double")
    limits = measured.groupBy("lang", "kind").agg((FAR * F.percentile_approx("far", 0.5, 10000)).alias("limit"))
    near = measured.join(F.broadcast(limits), ["lang", "kind"]).where(F.col("far") <= F.col("limit"))
    found = histograms(near, F.sum(F.col("col").cast("decimal(38,0)")).cast("double"))
    return {lang: (found[lang, 0], found[lang, 1]) for lang in sorted({lang for lang, _ in found})}


FACTS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "base_failed boolean, class_distance double, word_distance double, kept boolean")


def judge(text: str | None, refs, rules: Rules) -> tuple:
    """The row of FACTS of one text. A distance that a guard leaves out is null."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # for bytes: exactly the six ASCII blanks
    of_classes = class_histogram(raw)
    facts = base_facts(text, raw, words, of_classes, rules)
    by_class = by_word = None
    if refs and not facts[5] and len(text) >= rules.class_guard_chars:
        by_class = min(distance(of_classes, r[0]) for r in refs)
        if len(words) >= rules.word_guard_words:
            of_words = word_histogram(words)
            by_word = min(distance(of_words, r[1]) for r in refs)
    kept = not facts[5] and (by_class or 0) <= rules.max_class_distance and (by_word or 0) <= rules.max_word_distance
    return (*facts, by_class, by_word, kept)


def quality(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang",
            source_col: str | None = None) -> DataFrame:
    """``docs`` with the columns of FACTS for each row; columns of the same names are replaced. With ``source_col``
    the references are those of source_references.

    A text whose language has no reference is judged by the base rules alone, as no reference speaks for it; one without a language is
    held against all. The texts pass through one Arrow stage with all columns of ``docs`` beside them; no text is shuffled.
    """
    refs = source_references(docs, rules, text_col, lang_col, source_col) if source_col else references(docs, rules, text_col, lang_col)
    names = [f.split()[0] for f in FACTS.split(", ")]
    kept = docs.drop(*names)
    at, of = kept.columns.index(text_col), kept.columns.index(lang_col)
    kept, given = set_apart(kept)  # a name with a dot can't enter an Arrow stage
    held = list(refs.values())
    from pyspark.sql.types import StructType

    schema = StructType(kept.schema.fields + StructType.fromDDL(FACTS).fields)
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]

    def run(batches):
        for b in batches:
            texts = zip(b.column(at).to_pylist(), b.column(of).to_pylist())
            rows = list(zip(*[judge(t, held if lang is None or lang in refs else (), rules) for t, lang in texts])) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(v, t) for v, t in zip(rows, types)]], names=[*b.schema.names, *names])

    return named_back(kept.mapInArrow(run, schema), given, (), tuple(names))
