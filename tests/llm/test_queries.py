"""The registered queries against their SQL, or against brute force where SQL can't state them."""

import collections
import hashlib
import os
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF0001

sys.path.insert(0, os.path.join(ROOT, "tools"))
import corpus_pipeline  # noqa: E402
from check_oracles import norm  # noqa: E402
from fraudlane.llm import queries  # noqa: E402,F401
from fraudlane.llm.common import materialise  # noqa: E402
from fraudlane.llm.divergence import COMMON_WORDS, Rules, distance  # noqa: E402
from fraudlane.llm.registry import ORACLES, QUERIES  # noqa: E402
from fraudlane.llm.tokenizer_files import END_TOKEN, rank_file, tokenizer_json  # noqa: E402
from fraudlane.llm.training_order import Permutation, bpe, in_training_order, read_shards, token_records, write_shards  # noqa: E402

BLANK = r"[^\x20\x09-\x0D]+"
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_sql_parity(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = QUERIES[key](spark, SF0001)
    rows = sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)
    res = con.execute(ORACLES[key])
    names = [d[0] for d in res.description]
    at = [names.index(c) for c in df.columns]
    assert rows == sorted((tuple(norm(r[k]) for k in at) for r in res.fetchall()), key=repr)


def test_mix_reaches_the_targets(spark):
    sf = SF0001.replace("sf0.001", "sf0.01")  # some fifty documents a source: few enough for one to matter
    rows = QUERIES["op3_pareto_mix"](spark, sf).collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert r.taken in {k * r["size"] for k in range(4)}
        by[(r.source_size, r.target)].append(r.taken)
    for (size, target), taken in by.items():
        assert abs(sum(taken) - target) <= 0.01 * size + 50
    assert {tuple(r) for r in QUERIES["op3_pareto_mix"](spark, sf).collect()} == {tuple(r) for r in rows}


def test_permutation_is_a_bijection_with_an_inverse():
    for n in (1, 2, 3, 4, 5, 63, 64, 65, 1000, 4097):
        for key in (0, 7, 2**63 + 11):
            p = Permutation(n, key)
            slots = p.slot(np.arange(n))
            assert sorted(slots) == list(range(n)) and (p.index(slots) == np.arange(n)).all()
    assert (Permutation(1000, 1).slot(np.arange(1000)) != Permutation(1000, 2).slot(np.arange(1000))).any()


def test_training_order_round_trip(spark, docs, scratch):
    rows = QUERIES["op1_training_order"](spark, SF0001).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all((r.shard, r.place) == divmod(r.slot, queries.RECORDS_PER_SHARD) and len(r.record) == 2 * queries.RECORD_TOKENS for r in rows)
    records = token_records(spark.read.parquet(f"{SF0001}/documents.parquet"), rank_file(), END_TOKEN, 64)
    ordered = in_training_order(records, 5, 100)
    write_shards(ordered, f"{scratch}/out")
    back = {(r.shard, r.place): bytes(r.record) for r in read_shards(spark, f"{scratch}/out", 64).collect()}
    index = spark.read.parquet(f"{scratch}/out/index").collect()
    assert len(back) == len(index) == records.count()
    slot_of = Permutation(len(index), 5)
    at = {r.slot: r for r in index}
    tokens = collections.defaultdict(list)
    for k in range(len(index)):  # the records in their first order, found by arithmetic alone
        r = at[int(slot_of.slot(np.array([k]))[0])]
        ids = np.frombuffer(back[(r.slot // 100, r.slot % 100)], "<u2")
        for d in r.docs:
            tokens[d.doc_id].extend(ids[d.first:d.first + d.n].tolist())
    enc = bpe(rank_file())
    assert {k: enc.decode(v[:-1]) for k, v in tokens.items()} == {k: r.text for k, r in docs.items()}


def test_training_order_query_returns_what_its_files_hold(spark, monkeypatch, scratch):
    monkeypatch.setattr(queries, "shared_folder", lambda spark, tag: f"{scratch}/{tag}")
    rows = QUERIES["op1_training_order"](spark, SF0001).collect()
    raw = {(r.shard, r.place): bytes(r.record) for r in read_shards(spark, f"{scratch}/training-shards", queries.RECORD_TOKENS).collect()}
    assert rows and raw == {(r.shard, r.place): bytes(r.record) for r in rows}
    records = token_records(spark.read.parquet(f"{SF0001}/documents.parquet"), rank_file(), END_TOKEN, queries.RECORD_TOKENS)
    want = in_training_order(records, queries.ORDER_KEY, queries.RECORDS_PER_SHARD).collect()
    assert {r.slot: tuple(r) for r in rows} == {r.slot: tuple(r) for r in want} and [r.slot for r in rows] == sorted(r.slot for r in rows)


def test_records_cross_the_shuffle_in_packed_groups(spark):
    import pyarrow as pa
    from fraudlane.llm.training_order import _pack, pack_groups, unpack_groups
    records = token_records(spark.read.parquet(f"{SF0001}/documents.parquet"), rank_file(), END_TOKEN, 64)
    given = [bytes(r.record) for r in records.orderBy("part", "ordinal").collect()]
    order, batches = Permutation(len(given), 9), []
    for a in range(0, len(given), 300):
        batches.append(pa.RecordBatch.from_arrays([pa.array(range(a, min(a + 300, len(given))), pa.int64()), pa.array(given[a:a + 300], pa.binary())], names=["index", "record"]))
    groups = list(pack_groups(order, 50, 3, gathered=1000)(iter(batches)))
    assert all(g.num_rows <= 3 and g["task"].to_pylist() == sorted(g["task"].to_pylist()) for g in groups) and len(groups) == -(-len(given) // 1200)
    assert sum(len(p) for g in groups for p in g["packed"].to_pylist()) < 0.9 * sum(len(_pack(r)) for r in given)
    shards = -(-len(given) // 50)
    for g in groups:
        slots = [np.frombuffer(s, "<i8") for s in g["slots"].to_pylist()]
        assert all((s // 50 * 3 // shards == t).all() for s, t in zip(slots, g["task"].to_pylist()))
    back = [r for b in unpack_groups(128)(g.select(["slots", "packed"]) for g in groups) for r in zip(b["slot"].to_pylist(), b["record"].to_pylist())]
    assert dict(back) == {int(s): r for s, r in zip(order.slot(np.arange(len(given))), given)} and len(back) == len(given)


def test_training_order_leaves_its_shards_alone(spark, monkeypatch, scratch):
    """The table of the records is gone once the shards are written, and the records aren't packed one by one."""
    import os
    from fraudlane.llm import training_order
    for module in (queries, training_order):
        monkeypatch.setattr(module, "shared_folder", lambda spark, tag: f"{scratch}/{tag}")
    rows = QUERIES["op1_training_order"](spark, SF0001)
    assert "ArrowEvalPython" not in rows._jdf.queryExecution().executedPlan().toString()
    assert "token-records" not in os.listdir(scratch) and sorted(os.listdir(f"{scratch}/training-shards")) == ["index", "records"] and rows.count() > 0


def test_ring_shards_are_even_and_gapless(spark, docs):
    rows = QUERIES["op4_ring_shards"](spark, SF0001).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {
        k: (len(d.text.encode()) + 1, zlib.crc32(d.text.encode())) for k, d in docs.items()}
    shards = collections.defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    sizes = [len(shards[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in shards.values())


def test_ring_moves_little_when_a_shard_joins(spark):
    from fraudlane.llm.hash_ring import ring_shards
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    place = lambda n, slack: {r.doc_id: r.shard for r in ring_shards(docs, n, 64, slack).collect()}
    a, b = place(8, 4.0), place(9, 4.0)  # room enough: plain consistent hashing
    assert all(b[k] in (a[k], 8) for k in a) and any(b[k] == 8 for k in a)
    a, b = place(8, 0.25), place(9, 0.25)
    assert sum(a[k] != b[k] for k in a) < len(a) / 2


@pytest.mark.parametrize("slack, cell_bits", [(0.0, 16), (0.0, 3), (0.3, 16)])
def test_ring_against_rows_walked_one_by_one(spark, slack, cell_bits):
    from fraudlane.llm.hash_ring import quotas, ring, ring_position, ring_shards
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    shards, vnodes = 5, 6
    places, quota = ring(shards, vnodes, 1), quotas(docs.count(), shards, slack)
    arcs = [[] for _ in places]
    for at, doc_id in sorted((r.p, r.doc_id) for r in docs.select("doc_id", ring_position("doc_id", F.coalesce("text", F.lit(""))).alias("p")).collect()):
        arcs[next((k for k, (p, _) in enumerate(places) if p >= at), 0)].append(doc_id)
    held = [[] for _ in range(shards)]
    for step in range(len(places)):
        for k in range(len(places)):
            shard = places[(k + step) % len(places)][1]
            while arcs[k] and len(held[shard]) < quota[shard]:
                held[shard].append(arcs[k].pop(0))
    want = {doc_id: (s, slot) for s, ids in enumerate(held) for slot, doc_id in enumerate(ids)}
    got = {r.doc_id: (r.shard, r.slot) for r in ring_shards(docs, shards, vnodes, slack, cell_bits=cell_bits).collect()}
    assert got == want


def _words(text):
    return re.findall(BLANK, text)


def test_quality_facts_and_verdicts(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op5_quality_divergence"](spark, SF0001).collect()}
    rules, terms = Rules(), sorted({w for v in COMMON_WORDS.values() for w in v.split()})

    def classes(text):
        sets = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\v\f\r", ".,;:!?'\"-()", "#*$%&|<>"]
        return np.array([sum(c in s for c in text) for s in sets] + [sum(ord(c) < 128 and not any(c in s for s in sets) for c in text), sum(ord(c) > 127 for c in text)])

    def common(text):
        n = collections.Counter(_words(text))
        counts = [sum(n[f] for f in {w, w.capitalize(), w.upper()}) for w in terms]
        return np.array(counts + [sum(n.values()) - sum(counts)])

    def repeats(words):
        windows = collections.defaultdict(list)
        for i in range(len(words) - 7):
            windows[tuple(words[i:i + 8])].append(i)
        return {i + j for v in windows.values() if len(v) > 1 for i in v for j in range(8)}

    # every distinct text that passes teaches once, for its first source; each source near the middle has one vote
    teaches = {}
    for d in docs.values():
        words = _words(d.text)
        if len(words) >= rules.word_guard_words and 100 * len(repeats(words)) <= 30 * len(words):
            teaches[d.lang, d.text] = min(d.source, teaches.get((d.lang, d.text), d.source))
    sources = {}
    for (lang, text), source in teaches.items():
        for kind, h in enumerate((classes(text), common(text))):
            sources.setdefault((lang, kind), {}).setdefault(source, []).append(h / h.sum())
    refs = {}
    for (lang, kind), of in sources.items():
        votes = [np.sum(hs, axis=0) / len(hs) for hs in of.values()]
        middle = lambda values: np.sort(np.array(values), axis=0)[(len(values) - 1) // 2]
        far = [distance(v, middle(votes)) for v in votes]
        refs.setdefault(lang, {})[kind] = np.sum([v for v, f in zip(votes, far) if f <= 2 * middle(far)], axis=0)
    for k, d in docs.items():
        words, r = _words(d.text), got[k]
        repeated = repeats(words)
        lines = [x for x in d.text.split("\n") if _words(x)]
        failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), sum(d.text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated), failed)
        by_class = min(distance(classes(d.text), v[0]) for v in refs.values()) if not failed and len(d.text) >= rules.class_guard_chars else 0
        by_word = min(distance(common(d.text), v[1]) for v in refs.values()) if by_class and len(words) >= rules.word_guard_words else 0
        assert abs((r.class_distance or 0) - by_class) < 1e-6 and abs((r.word_distance or 0) - by_word) < 1e-6
        assert r.kept == (not failed and by_class <= rules.max_class_distance and by_word <= rules.max_word_distance)


def test_divergence_separates_the_labels(spark, docs):
    """Held-out labels: nothing was fitted to them but the thresholds' order of magnitude."""
    sf = SF0001.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in QUERIES["op5_quality_divergence"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    judged = [(got[r.doc_id].kept, r.quality) for r in labels if not got[r.doc_id].base_failed]
    good = [k for k, q in judged if q == 1]
    bad = [k for k, q in judged if q == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.25 * len(bad)


def test_hot_junk_source_teaches_nothing(spark):
    """A source of junk under one label holds a third of all rows, as copies, failing and passing texts."""
    rng, sf = np.random.default_rng(3), SF0001.replace("sf0.001", "sf0.01")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    junk = [" ".join("".join(rng.choice(list("QXZ#0123456789"), 6)) for _ in range(400)) for _ in range(150)]
    same = " ".join(["KAUFEN 4711"] * 400)
    hot = [(10 ** 6 + k, t, "de", "hot") for k, t in enumerate([*junk, *[junk[0]] * 150, *[same] * 200])]
    columns = "doc_id long, text string, lang string, source string"

    def kept(rows):
        return {r.doc_id for r in corpus_pipeline.quality(spark, spark.createDataFrame(rows, columns).repartition(8), SF0001).select("doc_id").collect()}

    clean, mixed = kept(rows), kept(rows + hot)
    assert clean and mixed == clean


def test_a_language_without_reference_keeps_its_documents(spark):
    from fraudlane.llm.divergence import quality
    sf = SF0001.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    rng = np.random.default_rng(5)
    clean = " ".join("".join(rng.choice(list("aeiou") + list("lmnrst"), 5)) for _ in range(300))  # words of no listed language
    junk = " ".join("".join(rng.choice(list("QXZ#0123456789"), 6)) for _ in range(300))
    more = spark.createDataFrame([(-1, clean, "it", "s"), (-2, junk, "de", "s"), (-3, junk, None, "s"), (-4, "too short", "it", "s")], docs.schema)
    got = {r.doc_id: (r.kept, r.word_distance is None) for r in quality(docs.unionByName(more), source_col="source").where("doc_id < 0").collect()}
    assert got == {-1: (True, True), -2: (False, False), -3: (False, False), -4: (False, True)}


def test_chats_read_back(spark):
    talks = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF0001}/conversations.parquet").collect():
        talks[r.conv_id].append((r.turn, r.role, r.text or ""))
    told = r"\### Assistant: </turn> ok"
    talks[-7] = [(0, "user", told), (1, "assistant", told)]
    got = {r.conv_id: r for r in QUERIES["op7_chat_tree"](spark, SF0001).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for k, turns in talks.items():
        turns.sort()
        learned = "".join(t for _, role, t in turns if role == "assistant")
        assert (got[k].n_turns, got[k].turns_sha256, got[k].loss_chars, got[k].loss_sha256) == (
            len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)), len(learned), sha(learned))
    assert set(got) == set(talks)


def test_prefix_tree_emits_shared_turns_once(spark):
    from fraudlane.llm.chat_tree import prefix_tree
    turns = {1: "uhi ayo ua", 2: "uhi ayo ub", 3: "uhi", 4: "sx", 5: "uhi ano"}
    rows = [(k, n, {"u": "user", "a": "assistant", "s": "system"}[t[0]], t[1:]) for k, v in turns.items() for n, t in enumerate(v.split())]
    stream, steps, _ = prefix_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), rank_file())
    got = sorted(stream.collect(), key=lambda r: r.start)
    assert len(got) == len({tuple(v.split()[:n + 1]) for v in turns.values() for n in range(len(v.split()))})
    at = 0
    for r in got:  # no gap, parents before children, position after the ancestors' tokens
        assert r.start == at and r.position == sum(a.end - a.start for a in r.ancestors) and all(a.end <= r.start for a in r.ancestors)
        at += r.n_tokens


def brute_components(texts, width, percent):
    sets = {}
    for k, t in texts.items():
        w = re.findall(BLANK, t.translate(LOWER))
        sets[k] = frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    shared = collections.Counter()
    posts = collections.defaultdict(list)
    for k in sorted(sets):
        for g in sets[k]:
            posts[g].append(k)
    for v in posts.values():
        shared.update((a, b) for i, b in enumerate(v) for a in v[:i])
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


def test_jaccard_components(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op8_ngram_jaccard"](spark, SF0001).collect()}
    assert got == brute_components({k: d.text for k, d in docs.items()}, 4, 85)


def test_jaccard_on_a_cloud_of_near_copies(spark):
    """Chains of small edits, ties at the threshold and many links inside one group."""
    import random

    from fraudlane.llm.ngram_join import jaccard_components
    rng, texts = random.Random(3), {}
    for family in range(4):
        base = [f"w{rng.randrange(400)}" for _ in range(60 + 40 * family)]
        for _ in range(60):
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
            if rng.random() < 0.3:
                words = words[:-rng.randrange(1, 12)]
            texts[len(texts)] = " ".join(words)
    for n in range(1, 30):
        texts[len(texts)] = " ".join(f"t{k}" for k in range(n))
    df = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    for width, percent in ((4, 85), (5, 80), (1, 50)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, width, percent).collect()}
        assert got == brute_components(texts, width, percent), (width, percent)


def test_stars_of_links_contract_in_few_rounds(spark, monkeypatch):
    """A hub's leaves go in the first round, whatever their hashes; chains of hubs, a path and a cycle come out as brute force has them."""
    from fraudlane.llm import components
    written = []
    monkeypatch.setattr(components, "materialise", lambda df, tag, **k: written.append(tag) or materialise(df, tag, **k))

    def rounds(pairs):
        written.clear()
        got = {r.node: r.root for r in components.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
        parent = {k: k for pair in pairs for k in pair}
        find = lambda k: k if parent[k] == k else find(parent[k])
        for a, b in pairs:
            parent[find(b)] = find(a)
        assert set(got) == set(parent) and len({(find(k), r) for k, r in got.items()}) == len(set(got.values())) == len(set(map(find, parent)))
        return written.count("points")

    assert rounds([(7, k) for k in range(10, 1500)]) == 1
    assert rounds([(h, 1000 * h + k) for h in range(1, 5) for k in range(200)] + [(1, 2), (2, 3), (3, 4), (4, 4)]) <= 3
    assert rounds([(k, k + 1) for k in range(300)] + [(k + 1, k) for k in range(1000, 1050)] + [(1050, 1000)]) <= 12


def test_token_counts_are_the_librarys(spark, docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(tokenizer_json())
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op9_token_counts"](spark, SF0001).collect()}
    for k, d in docs.items():
        n = len(t.encode(d.text, add_special_tokens=False).ids)
        assert got[k] == (len(d.text.encode()), n, n > 1024)


def test_pieces_encode_like_whole_texts():
    import random

    from tokenizers import Tokenizer

    from fraudlane.llm.token_pieces import PieceEncoder
    t, e = Tokenizer.from_str(tokenizer_json()), PieceEncoder(tokenizer_json())
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "don't", "'s", "1 2", "\u00e9", "\u00a0", "\u2003", "\x1c", "\x85", "<|endoftext|>", "\U0001F600", "$$", "\u3000x", "\r\n", "\u200b"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert np.frombuffer(e.encode(text), "<u2").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_cache_and_ledger_work_only_on_what_is_new(spark, scratch):
    from fraudlane.llm.secret_ledger import RULES, scan_secrets
    from fraudlane.llm.token_cache import token_counts
    old = spark.createDataFrame([(1, "one two"), (2, "token = abcdef1")], "doc_id long, text string")
    new = spark.createDataFrame([(3, "one two"), (4, "token = abcdef1"), (5, "three")], "doc_id long, text string")
    cache, ledger = f"{scratch}/cache", f"{scratch}/ledger"
    token_counts(old, cache, tokenizer_json()).collect()
    assert spark.read.parquet(cache).count() == 2
    counts = {r.doc_id: r.n_tokens for r in token_counts(new, cache, tokenizer_json()).collect()}
    assert spark.read.parquet(cache).count() == 3 and counts[3] == 2
    scan_secrets(old, ledger).collect()
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in scan_secrets(new, ledger).collect()}
    assert found == {3: [], 4: [("assign", 0, 15)], 5: []}
    assert spark.read.parquet(f"{ledger}/blobs").count() == 3 and spark.read.parquet(f"{ledger}/findings").count() == 1
    scan_secrets(new, ledger, RULES[:1]).collect()  # other rules: all three blobs once more
    assert spark.read.parquet(f"{ledger}/blobs").count() == 6


def test_nearest_directory_lends_its_licence(spark):
    from fraudlane.llm.licence_scan import scan_licences
    files = [("a/LICENSE", "Released under the MIT License."), ("a/x.c", "code"), ("a/b/COPYING", "Licensed under the Apache License, Version 2.0."),
             ("a/b/c/y.c", "code"), ("a/b/c/z.c", "x\nLicensed under CC BY-NC 4.0.\ny"), ("d/q.c", "code"), ("a/x.c", "code"), (None, "MIT License"), ("a/n.c", None),
             ("a/b/Copyright.c", "Copyright 2020 some company, all rights reserved")]
    got = sorted((r.path or "", r.licence, r.inherited_from) for r in scan_licences(spark.createDataFrame(files, "path string, text string")).collect())
    assert got == sorted([("a/LICENSE", "MIT", None), ("a/x.c", "MIT", "a"), ("a/x.c", "MIT", "a"), ("a/b/COPYING", "Apache-2.0", None),
                          ("a/b/c/y.c", "Apache-2.0", "a/b"), ("a/b/c/z.c", "CC-BY-NC-4.0", None), ("d/q.c", None, None), ("", "MIT", None), ("a/n.c", "MIT", "a"),
                          ("a/b/Copyright.c", "Apache-2.0", "a/b")])


HELD_OUT = {
    "MIT": ["SPDX-License-Identifier: MIT", "This project is released under the MIT license", "Licensed under the MIT license here",
            "Copyright (c) 2020 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software, to sublicense it"],
    "Apache-2.0": ["// SPDX-License-Identifier: Apache-2.0", '# Licensed under the Apache License, Version 2.0 (the "License"); you may not\n# use this file',
                   "                                 Apache License\n                           Version 2.0, January 2004"],
    "BSD-3-Clause": ["BSD 3-Clause License", "Copyright 2020\nRedistribution and use in source and binary forms, with or without modification\n3. Neither the name of the holder"],
    "BSD-2-Clause": ["Copyright 2020\nRedistribution and use in source and binary forms, with or without modification, are permitted"],
    "ISC": ["ISC License"],
    "GPL-3.0": ["This program is licensed under the GNU General Public License version 3", "GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n"
                "under version 3 of the GNU Affero General Public License into a single work", "SPDX-License-Identifier: GPL-3.0-or-later",
                "you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\nterms of version 3 of the GNU General Public License"],
    "GPL": ["GNU GENERAL PUBLIC LICENSE"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
    None: ["Copyright 2020 some company, all rights reserved", "The licence fee of the public house", "SPDX-FileCopyrightText: 2020 a summit", "We permit licensed plumbers"],
}


def test_held_out_licence_wordings(spark):
    from fraudlane.llm.licence_scan import scan_licences
    files = [(f"d{k}-{j}/{name}", t, want) for k, (want, texts) in enumerate(HELD_OUT.items()) for j, t in enumerate(texts) for name in ("LICENSE", "a.c")]
    got = scan_licences(spark.createDataFrame(files, "path string, text string, want string")).collect()
    assert len(got) == len(files) and [(r.path, r.own_licence, r.want) for r in got if r.own_licence != r.want] == []


def test_licence_forms_anywhere_and_without_a_cue(spark):
    from fraudlane.llm.licence_scan import scan_licences
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated files"
    long = "some plain words of a long text\n" * 400
    files = [("a/x.c", long + grant, "MIT"), ("b/x.c", grant + "\n" + long, "MIT"), ("c/x.c", long + "Distributed under the terms of the MIT", "MIT"),
             ("d/x.c", long + "This is free and unencumbered software released into the public domain.", "Unlicense"), ("e/x.c", long, None),
             ("f/x.c", long + "Redistribution and use in source\n   and binary forms are permitted", "BSD-2-Clause"), ("g/x.c", "CC-BY 4.0", "CC-BY-4.0"),
             ("h/x.c", "Permission to enter was granted to the apache, creative as ever; submit it under MITRE", None), ("i/x.c", "", None), ("j/x.c", None, None)]
    got = scan_licences(spark.createDataFrame(files, "path string, text string, want string")).collect()
    wrong = [(r.path, r.own_licence, r.want) for r in got if r.own_licence != r.want]
    assert len(got) == len(files) and wrong == []


def test_every_form_holds_what_the_gate_needs():
    """No wording of a form passes by the gate: each alternative, written out plainly, has one of its words."""
    from fraudlane.llm.licence_scan import FORMS, NEEDED
    for name, pattern in FORMS.items():
        for option in re.split(r" \| ", pattern):
            plain = re.sub(r"\(\?[:!][^()]*\|?[^()]*\)\??|\\|\?|\[cs\]", lambda m: "c" if m.group() == "[cs]" else "", f" {option} ")
            assert re.search(NEEDED, plain) or re.search(NEEDED, option.replace("[cs]", "c")), (name, option, plain)


def test_every_licence_of_a_directory_is_listed(spark):
    from fraudlane.llm.licence_scan import scan_licences
    files = [("a/LICENSE-MIT", "Released under the MIT License."), ("a/LICENSE-APACHE", "Licensed under the Apache License, Version 2.0."),
             ("a/b/x.c", "code"), ("a/y.c", "Released under the MIT License.\nLicensed under CC BY-NC 4.0."), ("c/z.c", "code")]
    got = {r.path: (r.own_licences, r.licences, r.licence) for r in scan_licences(spark.createDataFrame(files, "path string, text string")).collect()}
    both = ["Apache-2.0", "MIT"]
    assert got == {"a/LICENSE-MIT": (["MIT"], ["MIT"], "MIT"), "a/LICENSE-APACHE": (["Apache-2.0"], ["Apache-2.0"], "Apache-2.0"),
                   "a/b/x.c": ([], both, "MIT"), "a/y.c": (["CC-BY-NC-4.0", "MIT"], ["CC-BY-NC-4.0", "MIT"], "MIT"), "c/z.c": ([], [], None)}


def test_licence_at_the_top_of_a_tree(spark):
    from fraudlane.llm.licence_scan import scan_licences
    files = [("LICENSE", "Released under the MIT License."), ("src/a.c", "code"), ("src/lib/b.c", "code"), ("c.c", "code"), ("/x/d.c", "code"),
             ("/abs/e.c", "code"), ("/abs/LICENSE", "Released under the ISC License")]
    got = {r.path: (r.licence, r.inherited_from) for r in scan_licences(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got == {"LICENSE": ("MIT", None), "src/a.c": ("MIT", ""), "src/lib/b.c": ("MIT", ""), "c.c": ("MIT", ""), "/x/d.c": (None, None),
                   "/abs/e.c": ("ISC", "/abs"), "/abs/LICENSE": ("ISC", None)}
    rooted = [("/LICENSE", "Released under the MIT License."), ("/src/a.c", "code"), ("b.c", "code")]
    got = {r.path: r.licence for r in scan_licences(spark.createDataFrame(rooted, "path string, text string")).collect()}
    assert got == {"/LICENSE": "MIT", "/src/a.c": "MIT", "b.c": None}


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = materialise(stages["quality"](spark, docs, SF0001), "t")
    verdict = {r.doc_id: r.kept for r in QUERIES["op5_quality_divergence"](spark, SF0001).collect()}
    have = {r.doc_id: r for r in kept.collect()}
    assert set(have) == {k for k, v in verdict.items() if v}

    one = materialise(stages["near_duplicates"](spark, kept, SF0001), "t")
    groups = brute_components({k: r.text for k, r in have.items()}, 5, 80)
    have = {r.doc_id: r for r in one.collect()}
    assert sorted(r.doc_id for r in one.collect()) == sorted({root for _, root in groups.values()})

    clean = materialise(stages["decontaminate"](spark, one, SF0001), "t")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
    windows = {tuple(w[i:i + 10]) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect() for w in [split(r.text)] for i in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    dirty = {k for k, r in have.items() for w in [split(r.text)] if any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))}
    have = {r.doc_id: r for r in clean.collect()}
    assert dirty and not dirty & set(have) and set(have) | dirty == {root for _, root in groups.values()}

    mixed = materialise(stages["mix"](spark, clean, SF0001), "t")
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= set(have) and max(copies.values()) <= 3
    total, by = 0, collections.Counter()
    for k, r in have.items():
        total += len(_words(r.text))
    for k, n in copies.items():
        by[have[k].source] += n * len(_words(have[k].text))
    assert abs(sum(by.values()) - total) < 0.05 * total

    records = stages["training_order"](spark, mixed, SF0001).collect()
    assert sorted(r.slot for r in records) == list(range(len(records)))
    assert {d for r in records for d in r.doc_ids} == set(copies)
    assert corpus_pipeline.run(spark, SF0001).count() == len(records)


def test_pipeline_orders_records_in_packed_groups(spark, monkeypatch, scratch):
    """The last stage shares op1's writer: no record crosses a shuffle by itself, and the table of the records goes."""
    from fraudlane.llm import training_order
    for module in (corpus_pipeline, training_order):
        monkeypatch.setattr(module, "shared_folder", lambda spark, tag: f"{scratch}/{tag}")
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = corpus_pipeline.training_order(spark, docs, SF0001).collect()
    assert not os.path.exists(f"{scratch}/token-records") and sorted(os.listdir(f"{scratch}/training-shards")) == ["index", "records"]
    records = token_records(docs, rank_file(), END_TOKEN, corpus_pipeline.RECORD_TOKENS, path=f"{scratch}/again")
    want = in_training_order(records, corpus_pipeline.ORDER_KEY, corpus_pipeline.RECORDS_PER_SHARD).collect()
    assert {r.slot: tuple(r) for r in rows} == {
        r.slot: (r.slot, r.shard, r.place, r.n_tokens, [d.doc_id for d in r.docs], zlib.crc32(r.record)) for r in want} and len(rows) == len(want)
