"""The Jaccard join inside large groups of near copies and under common lines: rows grow with the group, not its square."""

from __future__ import annotations

import random

from appmart.llm import ngram_jaccard


def _shingles(words, k):
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def _least_by_brute_force(sets, percent):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, x in enumerate(sets):
        for j in range(i):
            shared = len(x & sets[j])
            if 100 * shared >= percent * (len(x) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in range(len(sets))}


def test_outer_copies_of_a_large_group_do_not_meet_all_others(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    texts = []
    # Near copies with 1 to 18 words replaced: from the base's similarity down to a third of it, and below.
    for i in range(360):
        words = list(base)
        for at in rng.sample(range(150), 1 + i % 18):
            words[at] = f"x{rng.randrange(10 ** 9)}"
        texts.append(words)
    met, block_pairs = [], ngram_jaccard._block_pairs
    monkeypatch.setattr(ngram_jaccard, "_block_pairs", lambda *given: met.append(block_pairs(*given)) or met[-1])
    got = ngram_jaccard.similar_components(spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string"), 5, 80)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == _least_by_brute_force(
        [_shingles(w, 5) for w in texts], 80)
    assert met[0].count() < 2 * len(texts)


def test_blocks_are_opened_for_few_entries_that_cannot_meet(spark, monkeypatch):
    # One list: 500 sets of one owner and 500 of their own, all sizes, the shared entry too late for most.
    rng = random.Random(5)
    sizes = [(i, rng.randint(60, 240)) for i in range(1000)]
    rows = [(1, i, n, rng.randint(n // 9, n // 5)) for i, n in sizes]
    long = spark.createDataFrame(rows, "token long, nid long, n int, pos int")
    anchored = spark.createDataFrame([(i, -1) for i in range(500)], "nid long, anchor long")
    opened = []
    own = ngram_jaccard._opened_blocks

    def counted(entry, percent):
        found = own(entry, percent)
        opened.append(found.join(entry.select(*[entry[c].alias(f"x_{c}") for c in ngram_jaccard._BLOCK]),
                                 [f"x_{c}" for c in ngram_jaccard._BLOCK]).count())
        return found
    monkeypatch.setattr(ngram_jaccard, "_opened_blocks", counted)
    got = {(r["a"], r["b"]) for r in ngram_jaccard._block_pairs(long, anchored, 80).collect()}

    def needed(a, b):
        return -(-80 * (a + b) // 180)
    pairs = [(x, y) for k, x in enumerate(rows) for y in rows[:k] if x[1] >= 500
             and 100 * min(x[2], y[2]) >= 80 * max(x[2], y[2])]
    want = {frozenset((x[1], y[1])) for x, y in pairs if min(x[2] - x[3], y[2] - y[3]) >= needed(x[2], y[2])}
    assert {frozenset(p) for p in got} == want and want
    assert opened[0] < len(pairs) / 100
