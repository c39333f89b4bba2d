"""Periodic runs, whitening and nearest neighbours against brute force, on small fixtures with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from appmart.llm import nearest_neighbours, periodic_runs, queries, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


# --- periodic runs ----------------------------------------------------------------------------------------------

def _runs(words):
    """(start, length, period) of all runs, by trying every period at every place."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def _planted(words, doc_id):
    """The contract's words, one by one."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + math.floor((n - a) / (3 + g % 8))
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def _expected(doc_id, text):
    words = _planted((text or "").encode().split(), doc_id)
    runs = _runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = [None] * 4
    if runs:
        s, n, p = min(runs, key=lambda r: (-1000 * r[1] / r[2], r[0], r[2]))
        best = [s, n, p, 1000 * n // p]
    return (doc_id, len(runs), *best,
            hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


@pytest.mark.parametrize("places,long_run", [(10, 4), (1 << 19, 64)])
def test_runs_equal_brute_force(monkeypatch, places, long_run):
    monkeypatch.setattr(periodic_runs, "PLACES", places)
    monkeypatch.setattr(periodic_runs, "LONG_RUN", long_run)
    rng = random.Random(3)
    for _ in range(80):
        docs = []
        for _ in range(rng.randint(1, 6)):
            n, kinds = rng.choice([0, 1, 3, 7, 30, 100, 300]), rng.choice([1, 2, 3, 20])
            d = [rng.randrange(kinds) for _ in range(n)]
            if n > 4 and rng.random() < .5:
                s, p = rng.randrange(n), rng.randint(1, n // 4)
                d = d[:s] + [d[s + (i - s) % p] if s + p <= n else d[i] for i in range(s, n)]
            docs.append((d[:4] * 3 + [9]) * 6 if rng.random() < .2 else d)
        first = np.cumsum([0] + [len(d) for d in docs])
        doc, start, length, period = periodic_runs.find_runs(np.array(sum(docs, []), dtype=np.int64), first)
        got = [[(int(a), int(b), int(c)) for k, a, b, c in zip(doc, start, length, period) if k == i]
               for i in range(len(docs))]
        assert [sorted(g) for g in got] == [_runs(d) for d in docs]


def test_grammar_extensions_equal_comparing_words():
    rng = np.random.default_rng(4)
    for kinds in (1, 2, 30):
        text = np.concatenate([[0], rng.integers(0, kinds, 400) + 2, [1]])
        text[200:300] = text[50:150]
        levels = periodic_runs.recompress(text, 2)
        x, y = rng.integers(1, 401, 500), rng.integers(1, 401, 500)
        x, y = x[x != y], y[x != y]

        def reach(a, b, step):
            n = 0
            while text[a] == text[b]:
                a, b, n = a + step, b + step, n + 1
            return n
        assert periodic_runs.extensions(levels, x, y).tolist() == [reach(a, b, 1) for a, b in zip(x, y)]
        back, last = [v.mirrored() for v in levels], len(text) - 1
        assert periodic_runs.extensions(back, last - x, last - y).tolist() == [reach(a, b, -1) for a, b in zip(x, y)]


def test_grammar_of_one_word_is_small():
    levels = periodic_runs.recompress(np.concatenate([[0], np.full(100_000, 2), [1]]), 2)
    assert len(levels) == 2 and len(levels[-1].symbols) == 3


def test_run_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(6)
    line = " ".join(rng.choice("abcdefgh") for _ in range(9))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "one"), (5, "A a A a A a A a"), (6, "a\x1ca \x85 ü ü ü ü ü ü"),
            (None, "y y y y y y z"), (7, "x " * 30_000), (8, "\n".join([line] * 7)), (8, "\n".join([line] * 7)), (-9, line)]
    rows += [(i, " ".join(rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(1, 90)))) for i in range(20, 140)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows],
                                 "doc_id long, text string, d string, runs string, n_words long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"),
                          ("period", "bigint"), ("exponent_milli", "bigint"), ("runs_sha256", "string"),
                          ("collapsed_sha256", "string")]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted([_expected(*r) for r in rows], key=key)


def test_run_operator_gives_spans_and_words(spark):
    docs = spark.createDataFrame([("k", "p q p q p q p q r")], "id string, body string")
    row = periodic_runs.periodic_runs(docs, ["id"], "body").first()
    assert (row["d"]["id"], row["n_words"], [tuple(r) for r in row["runs"]], row["collapsed"]) == (
        "k", 9, [(0, 8, 2)], "p q r")
    assert periodic_runs.periodic_runs(docs.limit(0), ["id"], "body").collect() == []


# --- whitening --------------------------------------------------------------------------------------------------

def _odd_vectors(rng, n, d):
    rows = [(i, [float(x) for x in rng.standard_normal(d) * np.linspace(1, 3, d)], 0) for i in range(n)]
    rows += [(1, rows[1][1], 0), (None, rows[2][1], 1), (5000, None, 1), (5001, [None] * d, 1), (5002, [], 1),
             (5003, [float("nan")] + [1.0] * (d - 1), 1), (5004, [float("inf")] + [1.0] * (d - 1), 1),
             (5005, [1.0, 2.0], 1), (5006, [0.0] * d, 1), (5007, [-0.015625] * d, 1)]
    return rows


def _check_whitening(got, kept, components):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in kept], dtype=object)
    n, d = x.shape
    off = n * x - x.sum(axis=0)
    c = off.astype(float) / n
    v = c.T @ c / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == n * components
    assert set(got["n"]) == {n} and sorted(set(got["component"])) == list(range(1, components + 1))
    assert sorted(got[got["component"] == 1]["deviation"]) == sorted(int(s) for s in (off * off).sum(axis=1))
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-10
    for k in range(1, components + 1):
        part = got[got["component"] == k]
        assert np.allclose(part["explained"], values[k - 1] / np.trace(v), rtol=1e-10)
        want = np.sort(c @ vectors[:, k - 1] / math.sqrt(values[k - 1]))
        have = np.sort(part["whitened"].to_numpy())
        assert min(np.abs(have - want).max(), np.abs(have + want[::-1]).max()) < 1e-8


def test_whitening_equals_dense_eigenvectors(spark, tmp_path):
    rows = _odd_vectors(np.random.default_rng(0), 300, 70)
    table = spark.createDataFrame(rows, VECTORS).withColumn("x", F.lit("x")).withColumn("d", F.lit(1)).withColumn(
        "component", F.lit(2))
    table.repartition(40).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_embedding_whitening(spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kept = [v for _, v, _ in rows if v and len(v) == 70 and all(c is not None and math.isfinite(c) for c in v)]
    _check_whitening(got.toPandas(), kept, 32)


def test_block_smaller_than_the_space_is_certified(spark):
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(np.random.default_rng(2).standard_normal((900, 90)))]
    stored = whitening.whole_vectors(spark.createDataFrame(rows, VECTORS), "embedding", ["vec_id"])
    fit = whitening.Fit(stored, 32, 16)
    assert fit.vectors.shape == (90, 32) and fit.residual <= whitening.TOLERANCE and fit.rounds > 1
    assert np.abs(fit.vectors.T @ fit.vectors - np.eye(32)).max() < 1e-12


def test_tree_of_partial_sums(spark):
    rows = spark.range(0, 1000, 1, 100)
    assert rows.rdd.getNumPartitions() > whitening.FAN
    total = whitening.tree_reduce(rows, lambda bs: sum(sum(b.column(0).to_pylist()) for b in bs), lambda a, b: a + b)
    assert total == 499_500


@pytest.mark.parametrize("rank", [1, 3])
def test_directions_without_variance_are_left_out(spark, rank):
    rng = np.random.default_rng(5)
    base = np.zeros((rank, 60))
    base[np.arange(rank), np.arange(rank)] = 1.0
    rows = [(i, [float(x) for x in (rng.integers(-40, 40, rank) / 64) @ base], 0) for i in range(200)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).select("d.vec_id", "*").toPandas()
    _check_whitening(got, [v for _, v, _ in rows], rank)


def test_whitening_without_variance_rows_or_small_numbers(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert run([]) == [] and run([(1, None, 0)]) == [] and run([(1, [1.0, 2.0], 0)]) == []
    assert run([(i, [1.0, 2.0], 0) for i in range(5)]) == []
    # Numbers beyond 64 bits: exact centring still, a deviation beyond 64 bits is null.
    far = run([(1, [1e15, 0.0], 0), (2, [-1e15, 1e14], 0), (3, [0.0, 0.0], 0)])
    assert len(far) == 6 and {r["deviation"] for r in far if r["d"]["vec_id"] == 1} == {None}
    assert far[0]["identity_error"] < 1e-6


# --- nearest neighbours -----------------------------------------------------------------------------------------

def _neighbours(rows, key, top=10):
    """Every query row's nearest rows by comparing it with all."""
    valid = [(i, np.array([np.float32(c) for c in v], dtype=float)) for i, v in rows]
    x = np.array([v for _, v in valid])
    out = []
    for at, (i, v) in enumerate(valid):
        if i % key == 0:
            score = np.sqrt(((x - v) ** 2).sum(axis=1))
            order = sorted((s, valid[j][0]) for j, s in enumerate(score) if j != at)[:top]
            out.append((i, [(r + 1, j, s) for r, (s, j) in enumerate(order)]))
    return out


def _found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


def test_few_lists_are_exact_with_ties_copies_and_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(7)
    points = rng.integers(0, 3, (250, 6)).astype(float)
    points[60:160] = points[60]  # a hundred copies, two queries among them
    points[points.sum(axis=1) == 0, 0] = 1.0
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(points)]
    odd = [(600, None), (700, [0.0] * 6), (800, [1.0, 2.0]), (900, [float("nan")] * 6), (1000, [None] + [1.0] * 5),
           (None, [1.0] * 6), (1100, []), (1200, [float("inf")] * 6)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], VECTORS)
    table.withColumn("v", F.lit(1)).withColumn("rid", F.lit(2)).withColumn("id", F.lit(3)).write.parquet(
        f"{tmp_path}/embeddings.parquet")
    got = queries.op13_nearest_neighbours(spark, str(tmp_path))
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    want = dict(_neighbours(rows, 100))
    found = _found(got)
    assert found.keys() == want.keys()
    for q in want:
        assert [x[:2] for x in found[q]] == [x[:2] for x in want[q]]
        assert np.allclose([x[2] for x in found[q]], [x[2] for x in want[q]], rtol=1e-14)


@pytest.mark.parametrize("block", [512, 16])
def test_recall_over_many_lists(spark, monkeypatch, block):
    monkeypatch.setattr(nearest_neighbours, "BLOCK", block)
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 16)) * 3
    points = centres[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 16))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(points)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    found = _found(nearest_neighbours.search(table, F.col("vec_id") % 50 == 0, list_entries=24))
    want = dict(_neighbours(rows, 50))
    assert found.keys() == want.keys() and all(len(v) == 10 for v in found.values())
    hits = sum(len({x[1] for x in found[q]} & {x[1] for x in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    as_float = {i: np.array([np.float32(c) for c in v], dtype=float) for i, v in rows}
    for q, hits in found.items():
        assert all(math.isclose(s, np.linalg.norm(as_float[q] - as_float[j]), rel_tol=1e-13) for _, j, s in hits)


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    found = _found(nearest_neighbours.search(table, F.col("vec_id") % 100 == 0, list_entries=32))
    want = dict(_neighbours(rows, 100))
    assert sum(len({x[1] for x in found[q]} & {x[1] for x in v}) for q, v in want.items()) >= 9 * len(want)


def test_lists_are_balanced_and_boundary_vectors_have_copies():
    sample = np.random.default_rng(9).standard_normal((1000, 8))
    lists = nearest_neighbours.Lists(sample, 30)
    row, own, nearest = lists.assign(sample)
    assert len(lists.centroids) == 30 and nearest.sum() == 1000 and len(row) > 1000
    far = ((sample[:, None] - lists.centroids) ** 2).sum(axis=2)
    # The graph finds the nearest centroid nearly always.
    assert (own[nearest] == far.argmin(axis=1)).mean() > 0.98


def test_repeated_rows_small_and_empty_tables(spark):
    def run(rows):
        return sorted(map(tuple, nearest_neighbours.search(spark.createDataFrame(rows, VECTORS),
                                                           F.col("vec_id") % 100 == 0).collect()))
    assert run([]) == [] and run([(0, None, 0)]) == [] and run([(0, [1.0, 0.0], 0)]) == []
    # A repeated row is its twin's neighbour; fewer candidates than ten are all returned.
    assert run([(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (5, [1.0, 2.0], 0)]) == [
        (0, 1, 0, 0.0), (0, 1, 0, 0.0), (0, 2, 5, 2.0), (0, 2, 5, 2.0)]
