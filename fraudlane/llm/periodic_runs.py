"""Periodic run detection: maximal stretches of words that repeat with a period, and the text without the repeats.

Each document's suffixes (of words) are ranked by prefix doubling, many documents at a time, and neighbours in that order
have the length of their common prefix (LCP). Kruskal's walk takes these links by descending LCP: a union-find unites the suffix
classes, and each class holds its positions in order. At a level L two positions that become neighbours in a class share
exactly L words; at a distance of L or less they seed a stretch with that distance as its period. If its first word
can't be extended to the left it is a run. Each run of at least two periods is found exactly once:
its first two period starts become neighbours at the level of its length less its period, as any position between
them would make the period shorter. A run of at least ``least_words`` words and ``least_exponent`` periods has a known
least LCP, where the walk ends; this loses nothing. Small classes go into the largest one and unions of a level are made together,
so that a position moves a logarithmic number of times.

Defined cases: words are runs of characters other than U+0020 and U+0009 to U+000D; null, empty and blank texts have no words,
no runs and an empty collapsed text; texts of any length are taken whole, in memory that grows with the words of the longest
one; repeated rows come back each; a null id is carried; an empty table gives an empty result; columns beside id and text
don't matter and don't come back.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words that are ranked together; a longer document is ranked alone.
CHUNK = 1 << 18


def suffix_levels(keys: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... keys, until no two are equal. ``keys`` differ between
    documents, and ``ends`` has the end of each position's document: a shorter suffix comes first."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    new = np.empty(n, dtype=bool)
    new[0] = True
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [rank], 1
    # a class of one keeps its rank; only the others are refined
    single = new & np.append(new[1:], True)
    left = np.sort(order[~single])
    while len(left):
        on = left + step
        inside = on < ends[left]
        second = np.where(inside, levels[-1][np.where(inside, on, 0)], -1).astype(np.int64)
        both = (levels[-1][left].astype(np.int64) << 32) + (second + 1)
        order = np.argsort(both, kind="stable")
        sorted_both, at = both[order], np.arange(len(left))
        new = np.empty(len(left), dtype=bool)
        new[0] = True
        new[1:] = sorted_both[1:] != sorted_both[:-1]
        old = sorted_both >> 32
        first_of_old = np.empty(len(left), dtype=bool)
        first_of_old[0] = True
        first_of_old[1:] = old[1:] != old[:-1]
        start_new = np.maximum.accumulate(np.where(new, at, 0))
        start_old = np.maximum.accumulate(np.where(first_of_old, at, 0))
        rank = levels[-1].copy()
        rank[left[order]] = old + (start_new - start_old)
        levels.append(rank)
        single = new & np.append(new[1:], True)
        left = np.sort(left[order[~single]])
        step *= 2
    return levels


def close_suffixes(keys: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in suffix order, LCP of each with the next), of those with an LCP of ``least`` or more with a neighbour."""
    levels = suffix_levels(keys, ends)
    known = min(len(levels) - 1, max(0, least.bit_length() - 1))  # shares 2 ** known words, at most least
    floor = levels[known]
    counts = np.bincount(floor, minlength=len(floor))
    alive = np.flatnonzero(counts[floor] > 1)
    order = alive[np.argsort(levels[-1][alive], kind="stable")]
    if len(order) < 2:
        return order[:0], order[:0]
    x, y = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(len(x), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank, inside = levels[k], (x < ends[order[:-1]]) & (y < ends[order[1:]])
        same = inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 0)])
        step = np.where(same, 1 << k, 0)
        lcp, x, y = lcp + step, x + step, y + step
    return order, lcp


def runs_of(keys: np.ndarray, ends: np.ndarray, least_words: int, least_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by Kruskal's walk over descending LCPs."""
    least = min(max(least_words - q, (least_exponent - 1) * q) for q in range(1, least_words + 1))
    order, lcp = close_suffixes(keys, ends, least)
    links = np.flatnonzero(lcp >= least)
    links = links[np.argsort(-lcp[links], kind="stable")]
    position, level_of = order.tolist(), lcp[links].tolist()
    links = links.tolist()
    parent, members, found = {}, {}, []
    word = keys.tolist() if links else []

    def root(node):
        while (up := parent.get(node, node)) != node:
            parent[node] = node = parent.get(up, up)
        return node

    def seed(p, q, level):
        period = q - p
        if period <= level and level + period >= max(least_words, least_exponent * period) and not (p and word[p - 1] == word[q - 1]):
            found.append((p, level + period, period))

    at = 0
    while at < len(links):
        level, moved = level_of[at], {}
        while at < len(links) and level_of[at] == level:
            a, b = root(links[at]), root(links[at] + 1)
            at += 1
            for node in (a, b):
                if node not in members:
                    members[node] = [position[node]]
            if len(members[a]) < len(members[b]):
                a, b = b, a
            parent[b] = a
            moved.setdefault(a, []).append(b)
            if b in moved:
                moved[a] += moved.pop(b)
        for a, joined in moved.items():
            base = members[a]
            if len(joined) == 1 and len(members[joined[0]]) == 1:  # the common case: one position joins a class
                p = members.pop(joined[0])[0]
                t = bisect_left(base, p)
                if t:
                    seed(base[t - 1], p, level)
                if t < len(base):
                    seed(p, base[t], level)
                base.insert(t, p)
                continue
            came = {p: k for k, b in enumerate(joined, 1) for p in members.pop(b)}
            if len(came) * 16 < len(base):
                for p in came:
                    insort(base, p)
            else:
                base = members[a] = sorted(base + list(came))
            for p, k in came.items():
                t = bisect_left(base, p)
                if t and came.get(base[t - 1], 0) != k:
                    seed(base[t - 1], p, level)
                if t + 1 < len(base) and base[t + 1] not in came:
                    seed(p, base[t + 1], level)
    return found


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that a run contains after its first period, with single blanks between them."""
    if not runs:
        return " ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int32)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return " ".join([w for w, g in zip(words, gone.tolist()) if not g])


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _find(least_words: int, least_exponent: int):
    def chunk(ids, docs):
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        ends_of = np.cumsum(sizes)
        number = defaultdict()
        number.default_factory = number.__len__
        runs = [[] for _ in docs]
        if sizes.sum() >= least_words:
            flat = np.fromiter((number[w] for d in docs for w in d), dtype=np.int64, count=int(sizes.sum()))
            keys = flat + (np.repeat(np.arange(len(docs), dtype=np.int64), sizes) << 32)
            starts = ends_of - sizes
            for start, length, period in runs_of(keys, np.repeat(ends_of, sizes), least_words, least_exponent):
                k = int(keys[start] >> 32)
                runs[k].append((start - int(starts[k]), length, period))
        for r in runs:
            r.sort(key=lambda run: (run[0], run[2]))
        as_dicts = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(as_dicts, RUNS),
             pa.array([collapse(d, r) for d, r in zip(docs, runs)], pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches):
        for b in batches:
            ids, docs, size = [], [], 0
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = WORD.findall(text) if text else []
                if ids and size + len(words) > CHUNK:
                    yield chunk(ids, docs)
                    ids, docs, size = [], [], 0
                ids.append(doc_id)
                docs.append(words)
                size += len(words)
            if ids:
                yield chunk(ids, docs)
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 6, least_exponent: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs by start and period, and its text without their repeats."""
    if least_exponent < 2 or least_words < 2:
        raise ValueError("runs have at least two words and two periods")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_find(least_words, least_exponent), FOUND)
