"""Spelling variants, piece encoding and periodic runs against brute force, the sentencepiece library and odd input."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
import sentencepiece

from pyspark.sql import functions as F

from conftest import SF0001
from fraudlane.llm import queries, spelling_trie  # noqa: F401
from fraudlane.llm.common import materialise
from fraudlane.llm.periodic_runs import periodic_runs, runs_of
from fraudlane.llm.piece_bpe import PieceModel, decode_texts, encode_texts
from fraudlane.llm.registry import QUERIES
from fraudlane.llm.spelling_trie import near_words, variant_groups
from fraudlane.llm.tokenizer_files import piece_model

LOWER = {c: c + 32 for c in range(65, 91)}
EXTRA = "doc_id long, text string, ids string, n_words int, runs int, word string, n long, node int, way int, spelt string, only string, symbol int"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else (a[k + 1:] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1:])


def brute_groups(counts: dict, ratio: int = 10) -> set:
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-counts[x], x))
            if counts[best] >= ratio * counts[w]:
                form[w] = best
    rows = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return rows


def groups(df) -> set:
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variant_groups_of_the_documents(spark, texts):
    counts = collections.Counter()
    for doc_id, text in texts.items():
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    by_deletion = collections.defaultdict(set)  # only words that share a text with a code point less can be near
    for w in kept:
        for v in {w} | {w[:k] + w[k + 1:] for k in range(len(w))}:
            by_deletion[v].add(w)
    near = collections.defaultdict(set)
    for group in by_deletion.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and one_edit(a, b)}
    got = {r.word: r for r in QUERIES["op11_spelling_variants"](spark, SF0001).collect()}
    assert set(got) == set(kept)
    for w, n in kept.items():
        best = min(near[w], key=lambda x: (-kept[x], x), default=None)
        form = best if best and kept[best] >= 10 * n else None
        assert (got[w].n, got[w].n_near, got[w].form, got[w].form_n) == (n, len(near[w]), form, kept.get(form))
        root = w
        while got[root].form:
            root = got[root].form
        assert got[w].root == root
    assert sum(r.form is not None for r in got.values()) > 5


def test_misspelt_words_are_made_once(spark):
    """No filter repeats the making of a word, and only A-Z are lowered."""
    docs = spark.createDataFrame([(1, "ÀÉÎÕÜÝÞß Abcdefgh ABCDEFGH abcdefgi ÀÉÎÕÜÝÞß"), (2, None), (3, "Élevage abcdefgh ÉLEVAGE Abcdefgi")], "doc_id long, text string")
    made = queries._misspelt_words(docs)
    assert not [x for x in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and "crc32" in x]
    want = collections.Counter()
    for r in docs.where("text IS NOT NULL").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            want[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    assert {r.word: r.n for r in made.collect()} == {w: n for w, n in want.items() if n >= 2 and len(w) >= 7}


def test_near_words_of_a_dense_vocabulary(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(2, 7))) for _ in range(250)} | {"aa", "ab", "aaa", "aaaa", "a" * 40, "a" * 41, "\U0001F600a", "\U0001F600b"}
    counts = {w: rng.choice([1, 2, 5, 60, 700, 9000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {(r.a, r.b) for r in near_words(df).collect()} == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert groups(variant_groups(df)) == brute_groups(counts)
    assert groups(variant_groups(df, ratio=2)) == brute_groups(counts, 2)


def test_tables_written_do_not_grow_with_the_words(spark, monkeypatch):
    """The path that two words share behind an edit takes no rounds, whatever its length."""
    def written(side: str) -> int:
        tags = []
        monkeypatch.setattr(spelling_trie, "materialise", lambda df, tag: (tags.append(tag), materialise(df, tag))[1])
        counts = {side + mid + side + last: n for mid, n in (("or", 5), ("our", 900), ("ar", 70), ("er", 8)) for last in ("a", "bc", "bd")}
        assert groups(variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long"))) == brute_groups(counts)
        return len(tags)
    assert written("col") == written("colabcdéfghijklmnopq")


def test_equal_hashes_neither_make_nor_lose_a_pair(spark, monkeypatch):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(2, 6))) for _ in range(60)}
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    monkeypatch.setattr(spelling_trie, "_node", lambda depth: F.lit(7).cast("long"))
    got = [(r.a, r.b) for r in near_words(df).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_variant_groups_of_odd_words(spark):
    rows = [("colour", 50), ("colour", 50), ("color", 9), ("colr", 1), (None, 7), ("", 3), ("a", 2), ("nulln", None), ("nullns", 4)]
    df = spark.createDataFrame(rows, "word string, n long")
    want = brute_groups({"colour": 100, "color": 9, "colr": 1, "nulln": 0, "nullns": 4})
    assert groups(variant_groups(df)) == want  # one row for a repeated word; color -> colour, colr -> color only at a ratio of 9
    assert groups(variant_groups(df.limit(0))) == set()
    clashing = spark.createDataFrame([(1, "t", "i", 1, 2, "colour", 100, 3, 4, "s", "o", 5), (2, "t", "i", 1, 2, "color", 9, 3, 4, "s", "o", 5)], EXTRA)
    assert groups(variant_groups(clashing)) == brute_groups({"colour": 100, "color": 9})
    with pytest.raises(Exception, match="end mark"):
        variant_groups(spark.createDataFrame([("ab\x03cd", 1)], "word string, n long")).collect()
    with pytest.raises(ValueError):
        variant_groups(df, ratio=1)


def library():
    return sentencepiece.SentencePieceProcessor(model_proto=piece_model())


def test_own_encoder_and_decoder_equal_the_library():
    own, lib, rng = PieceModel(piece_model()), library(), random.Random(8)
    letters = [*" ▁ab\n\t\x00é日\U0001F600́​", "<s>", "</s>", "<0x41>", "the", "ing", "  ", ",###", "\r\n", "12"]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        ids = lib.encode(text)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids and own.decode(ids) == lib.decode(ids)
    for text in ("a" * 5000, "word" * 4000, "\n" * 999, " " * 1001, "é日" * 700):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == lib.encode(text)
    for _ in range(1500):
        ids = [rng.choice([0, 1, 2, 3, 70, 200, 231, 255, 29871, 259, rng.randrange(32000)]) for _ in range(rng.randint(0, 9))]
        assert own.decode(ids) == lib.decode(ids)


def test_short_and_long_agendas_agree(monkeypatch):
    model, rng = PieceModel(piece_model()), random.Random(2)
    cuts = ["▁" + "".join(rng.choice("etaoinsr,.") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    short = [model.merge(c) for c in cuts]
    monkeypatch.setattr("fraudlane.llm.piece_bpe.SHORT", 0)
    assert [model.merge(c) for c in cuts] == short


def test_piece_encoding_of_the_documents(spark, texts):
    lib = library()
    rows = QUERIES["op12_piece_encoding"](spark, SF0001).collect()
    assert len(rows) == len(texts) and all(r.agrees for r in rows)
    for r in rows:
        ids = lib.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


ODD = [None, "", " \n\t ", "one", "a a a a a a", "x </s> y", "\U0001F600 ß", "w " * 40_000]


def odd(spark):
    made = [(k, t, "i", 1, 2, "w", 3, 4, 5, "s", "o", 6) for k, t in enumerate(ODD)]
    return spark.createDataFrame(made + [made[4], (None, "no id") + made[0][2:]], EXTRA)


def test_piece_encoding_of_odd_texts(spark):
    lib, got = library(), encode_texts(odd(spark), piece_model()).collect()
    want = [(k, t or "") for k, t in enumerate(ODD)] + [(4, ODD[4]), (None, "no id")]
    assert [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got] == [(k, lib.encode(t, add_bos=True, add_eos=True)) for k, t in want]
    assert [r.n_tokens for r in got][:2] == [2, 2] and all(r.agrees for r in got)
    back = decode_texts(encode_texts(odd(spark), piece_model(), begin=False, end=False), piece_model()).collect()
    assert [(r.doc_id, r.text) for r in back] == want  # no U+2581 in them: an exact round trip
    assert encode_texts(odd(spark).limit(0), piece_model()).collect() == []


def test_other_models_are_refused():
    raw = piece_model()
    at = raw.rindex(b"identity") + len(b"identity")
    with pytest.raises(ValueError):  # add_dummy_prefix, remove_extra_whitespaces: trims blanks
        PieceModel(raw[:at] + raw[at:].replace(b"\x20\x00", b"\x20\x01", 1))


def brute_runs(words, least_words=6, least_exponent=4):
    """Each period's maximal stretches whose smallest period it is, as (start, length, period)."""
    found, n = set(), len(words)
    for q in range(1, n // least_exponent + 1):
        start = 0
        while start < n - q:
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            stretch = words[start:start + length]
            if end > start and length >= max(least_words, least_exponent * q) and not any(
                    stretch[:-d] == stretch[d:] for d in range(1, q)):
                found.add((start, length, q))
            start = max(end, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(1200):
        docs = []
        for _ in range(rng.randint(1, 4)):
            n = rng.choice([0, 1, 5, 6, 7, 12, 30, 60])
            words = [rng.choice("abcdefg"[:rng.choice([1, 2, 2, 3, 5])]) for _ in range(n)]
            if n > 3 and rng.random() < 0.6:
                a = rng.randrange(n)
                p = 1 + rng.randrange((n - a) // 3 + 1)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            docs.append(words)
        sizes = np.array([len(d) for d in docs])
        if not sizes.sum():
            continue
        keys = np.array([ord(w) for d in docs for w in d]) + (np.repeat(np.arange(len(docs)), sizes) << 32)
        ends = np.cumsum(sizes)
        least_words, exponent = rng.choice([2, 4, 6, 9]), rng.choice([2, 3, 4])
        got = runs_of(keys, np.repeat(ends, sizes), least_words, exponent)
        assert len(got) == len(set(got))
        for k, d in enumerate(docs):
            first = ends[k] - sizes[k]
            mine = sorted(((s - first, n, q) for s, n, q in got if keys[s] >> 32 == k), key=lambda r: (r[0], r[2]))
            assert mine == brute_runs(d, least_words, exponent)


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_periodic_runs_of_the_documents(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, SF0001).collect()}
    assert set(rows) == set(texts)
    for doc_id, text in texts.items():
        words, r = planted(doc_id, text), rows[doc_id]
        if len(words) > 1500 and zlib.crc32(str(doc_id).encode()) % 10:
            continue  # the brute force is quadratic: long texts only where a run is planted
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest()
    assert sum(r.n_runs for r in rows.values()) > 10


def test_runs_of_odd_texts(spark):
    got = periodic_runs(odd(spark)).collect()
    assert [r.doc_id for r in got] == [*range(len(ODD)), 4, None]
    assert [[tuple(x) for x in r.runs] for r in got] == [[], [], [], [], [(0, 6, 1)], [], [], [(0, 40_000, 1)], [(0, 6, 1)], []]
    assert [r.collapsed for r in got] == ["", "", "", "one", "a", "x </s> y", "\U0001F600 ß", "w", "a", "no id"]
    assert periodic_runs(odd(spark).limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(odd(spark), least_exponent=1)
