"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for each operator."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fraudlane.llm.common import shared_folder
from fraudlane.llm.chat_tree import prefix_tree, read_back
from fraudlane.llm.decontaminate import clean_documents, contamination
from fraudlane.llm.divergence import quality
from fraudlane.llm.hash_ring import ring_shards
from fraudlane.llm.licence_scan import scan_licences
from fraudlane.llm.ngram_join import jaccard_components, keep_one_of_each
from fraudlane.llm.pareto_mix import mix
from fraudlane.llm.secret_ledger import scan_secrets
from fraudlane.llm.token_cache import token_counts
from fraudlane.llm.tokenizer_files import END_TOKEN, rank_file, tokenizer_json
from fraudlane.llm.training_order import in_training_order, token_records

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, _class long, kept string"
LONG = " ".join(f"w{k % 977} token = \"abcdef{k:06d}\"" for k in range(20_000))
TEXTS = [None, "", " \n\t ", "one", "One two three", "ÄÖ ß x \U0001F600 end", "same words in the same order here " * 3, LONG]


def rows():
    made = [(k, t, "en" if k % 2 else None, f"s{k % 2}" if k % 3 else None, None, 1, 2, 3, "extra") for k, t in enumerate(TEXTS)]
    return made + [made[6], made[6], (100, TEXTS[6], "en", "s1", 5, 1, 2, 3, "x"), (None, "no id at all", None, None, None, None, None, None, None),
                   (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def bench(spark):
    return spark.createDataFrame([(1, "same words in the same order here same words in the"), (2, None), (3, ""), (4, "no id"), (None, "ONE two"), (1, "one two THREE")],
                                 "item_id long, text string")


def operators(spark):
    return {
        "op1": lambda d: in_training_order(token_records(d, rank_file(), END_TOKEN, 64), 3, 100),
        "op2": lambda d: contamination(d, bench(spark)),
        "op3": lambda d: mix(d),
        "op4": lambda d: ring_shards(d, shards=4, vnodes=8),
        "op5": lambda d: quality(d),
        "op6": lambda d: scan_secrets(d, shared_folder(spark, "t-ledger")),
        "op8": lambda d: jaccard_components(d, 4, 85),
        "op8-keep": lambda d: keep_one_of_each(d),
        "op9": lambda d: token_counts(d, shared_folder(spark, "t-cache"), tokenizer_json()),
        "op10": lambda d: scan_licences(d.withColumn("path", F.concat_ws("/", "source", F.col("doc_id").cast("string")))),
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op6", "op8", "op8-keep", "op9", "op10"])
def test_every_row_has_a_result_and_empty_tables_stay_empty(spark, docs, none, name):
    op = operators(spark)[name]
    got = op(docs).collect()
    if name not in ("op1", "op8-keep"):
        assert len(got) == len(rows())
    empty = op(none)
    assert empty.collect() == []
    assert empty.columns == op(docs).columns


#: Names that the operators, or their helpers, use for columns of their own.
INNER = ("doc doc_hash _hash win k at part run start end fresh d2 h2 w len _source _rate _cs _size _words _w _q _bin _sure _drawn _expected _decisions "
         "_closing digest spans _digest findings rules kind _position _arc _a _cell _ca _cc _before _place _rank _first _end _slot slot _title _said _found "
         "_dir _rooted _own _names _nd _nr _near _s _f _path statement n words row n_tokens n_bytes tokenizer _text Size LICENCE _given_1 a.b").split()


@pytest.mark.parametrize("name", ["op2", "op2-clean", "op3", "op4", "op5", "op6", "op8-keep", "op9", "op10"])
def test_columns_named_like_inner_ones_come_back(spark, name):
    given = spark.createDataFrame([(k, t, f"s{k % 2}", "en") for k, t in enumerate(TEXTS)], "doc_id long, text string, source string, lang string")
    given = given.select("*", *[F.concat(F.lit(c), "doc_id").alias(c) for c in INNER])
    op = {**operators(spark), "op2-clean": lambda d: clean_documents(d, bench(spark))}[name]
    got = op(given)
    made = {"op2": "n_words n_hit n_items item_ids contaminated", "op3": "size source_size target copies taken", "op4": "size text_crc32 shard slot",
            "op5": "n_words", "op6": "digest spans", "op9": "n_bytes n_tokens", "op10": "own_licence own_score licence inherited_from own_licences licences"}.get(name, "").split()
    back = [c for c in INNER if c.lower() not in made and c in got.columns]
    assert set(INNER) - set(back) <= {c for c in INNER if c.lower() in made}
    rows_ = got.select("doc_id", *[F.col(f"`{c}`") for c in back]).collect()
    assert rows_ and all(r[c] == f"{c}{r.doc_id}" for r in rows_ for c in back)


def test_sizes_and_counts_of_odd_texts(spark, docs):
    counts = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(docs.where("doc_id < 6"), shared_folder(spark, "t"), tokenizer_json()).collect()}
    assert counts[0] == counts[1] == (0, 0) and counts[5][0] == len(TEXTS[5].encode())
    sizes = {r.doc_id: r["size"] for r in mix(docs.where("doc_id < 8")).collect()}
    assert [sizes[k] for k in range(8)] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in TEXTS]


def brute_hits(text, items):
    """Words inside any occurrence of a window of ten consecutive item words."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit = split(text), set()
    for item in map(split, items):
        for i in range(max(1, len(item) - 9) if item else 0):
            window = item[i:i + 10]
            for at in range(len(words) - len(window) + 1):
                if words[at:at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
    return len(hit)


def test_contamination_of_odd_texts(spark, docs):
    got = {r.doc_id: r for r in contamination(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), bench(spark)).collect()}
    assert (got[4].n_words, got[4].n_hit, got[4].item_ids) == (3, 3, ["1"])  # "one two" is item null's: marked, not listed
    assert got[6].item_ids == ["1"] and got[6].n_hit == got[100].n_hit == brute_hits(TEXTS[6], [r.text for r in bench(spark).collect()])
    assert not got[0].contaminated and not got[3].contaminated and not got[7].contaminated
    null_id = [r for r in contamination(docs, bench(spark)).collect() if r.doc_id is None]
    assert sorted(r.n_hit for r in null_id) == [0, 2]


def test_benchmark_without_rows_or_words(spark, docs):
    for rows_ in ([], [(1, None)], [(1, "...")]):
        got = contamination(docs, spark.createDataFrame(rows_, "item_id long, text string")).collect()
        assert len(got) == len(rows()) and not any(r.contaminated for r in got)


def test_components_of_copies_and_empty_texts(spark, docs):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs, 4, 85).collect()]
    assert got.count((6, 7, 6)) == 3 and (100, 7, 6) in got
    assert {(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 4)} <= set(got)
    assert (None, 1, None) in got and (None, 0, None) in got
    kept = sorted((r.doc_id, r.text) for r in keep_one_of_each(docs).where("doc_id IS NOT NULL").collect() if r.doc_id in (6, 100))
    assert kept == [(6, TEXTS[6])]


def test_pipeline_stages_on_odd_rows(spark, docs, none, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, n: bench(s))
    for start, some in ((docs, True), (none, False)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, start, "")
            assert got.columns == start.columns, name
            kept = got.collect()
            assert {tuple(r) for r in kept} <= {tuple(r) for r in start.collect()}
            assert some or not kept
        last = corpus_pipeline.STAGES[-1][1](spark, start, "").collect()
        assert bool(last) == some and sorted(r.slot for r in last) == list(range(len(last)))


def test_conversations_with_odd_rows(spark):
    told = "a </turn>\n<turn user>\n \\l \\ <"
    given = [(1, 0, "user", told), (1, 1, "assistant", told), (2, 0, "user", told), (2, 0, "user", told), (3, None, None, None), (3, 0, "odd <role>\n", "x"),
             (None, 0, "user", "q"), (None, 0, "user", "q"), (None, 1, "user", "r")]
    talks = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").withColumn("chat", F.lit(1))
    stream, steps, members = prefix_tree(talks, rank_file())
    got = sorted(((r.conv_id or 0, r.n_turns, r.turns_sha256, r.loss_sha256) for r in read_back(stream, steps, members, rank_file()).collect()))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(0, 2, sha("user\nq\nuser\nq\n"), sha("")), (0, 1, sha("user\nr\n"), sha("")),
            (1, 2, sha(f"user\n{told}\nassistant\n{told}\n"), sha(told)), (2, 2, sha(f"user\n{told}\n" * 2), sha("")),
            (3, 2, sha("\n\nodd <role>\n\nx\n"), sha(""))]
    assert got == sorted(want)
    assert stream.count() == 8  # the first turn of 1 and 2 is one node
    empty = prefix_tree(talks.where("conv_id = 99"), rank_file())
    assert [t.count() for t in empty] == [0, 0, 0] and read_back(*empty, rank_file()).collect() == []


def test_near_copies_link_across_packs_and_fragments():
    """A pack and a fragment hold half a million and a million n-grams at most (twice that took 3,022 MB of an executor in the
    pipeline); cut into many packs and fragments, the segments still count every n-gram and class."""
    import pyarrow as pa

    from fraudlane.llm import ngram_join

    assert (ngram_join.PACK, ngram_join.FRAGMENT) == (1 << 19, 1 << 20)
    shared = [f"w{k}" for k in range(400)]
    texts = [" ".join(shared), " ".join([*shared, "x"]), " ".join(f"o{k}" for k in range(400))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["_text"])
    kept, ngram_join.PACK = ngram_join.PACK, 100
    try:
        segments = pa.Table.from_batches(list(ngram_join._segments(4, 5)([batch])))
    finally:
        ngram_join.PACK = kept
    found = {}
    for f in set(segments["fragment"].to_pylist()):
        counted = ngram_join._count_fragment(1)(segments.filter(pa.compute.equal(segments["fragment"], f)))
        for classes, sizes, m in zip(*(counted[c].to_pylist() for c in ("classes", "sizes", "kept"))):
            for c, n, k in zip(np.frombuffer(classes, np.int64), np.frombuffer(sizes, np.uint32), np.frombuffer(m, np.uint32)):
                was = found.get(int(c), (0, 0))
                found[int(c)] = (was[0] + int(n), was[1] + int(k))
    assert sorted(found.values()) == [(396, 0), (396, 396), (397, 396)]
