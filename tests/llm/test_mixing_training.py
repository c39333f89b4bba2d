"""Mixing: the vocabulary against brute force, what comes to the driver, and what the query does to labelled documents."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from appmart.llm import mixing, queries

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def _domain(row):
    return 2 if row["toxic"] == 1 else 1 if row["quality"] == 0 else 0


def _vocabulary_by_brute_force(docs, labels):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sample = [(_domain(r), texts[r["doc_id"]]) for r in labels.collect() if r["doc_id"] in texts]
    words = [(k, {int(w) for w in d}) for (k, _), (_, d, _) in zip(sample, mixing._documents(pa.array([t for _, t in sample])))]
    sizes = Counter(k for k, _ in words)
    seen = {k: Counter(w for j, d in words if j == k for w in d) for k in sizes}
    score = {}
    for w in set().union(*(d for _, d in words)):
        rates = [seen[k][w] / sizes[k] for k in sorted(sizes)]
        mean = sum(rates) / len(rates)
        score[w] = (max(rates) - min(rates)) / np.sqrt(mean * (1 - mean) + 1e-3)
    return score


def test_vocabulary_equals_brute_force(tables):
    model = mixing.train(*tables)
    score = _vocabulary_by_brute_force(*tables)
    chosen = [int(w) for w in model.vocabulary]
    assert len(chosen) == len(set(chosen)) == mixing.VOCABULARY and chosen == sorted(chosen)
    edge = sorted(score.values(), reverse=True)[mixing.VOCABULARY - 1]
    assert min(score[w] for w in chosen) >= edge - 1e-12


def test_rows_of_the_sample_that_reach_the_driver_do_not_grow_with_texts_or_repeats(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(mixing, "SAMPLE_PER_DOMAIN", 3)
    monkeypatch.setattr(mixing, "fit", lambda y, has, shape, vocabulary, prior: taken.append((y, has, shape, vocabulary)))
    words = " ".join(f"w{n}" for n in range(5000))
    rows = [(i % 12, f"{words} x{i}", None, None, None) for i in range(40)] + [(None, "y", None, None, None)]
    docs = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(0, 0, 0), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    mixing.train(docs, labels)
    y, has, shape, vocabulary = taken[0]
    assert Counter(y.tolist()) == {0: 3, 1: 3}
    assert has.shape == (6, len(vocabulary)) and len(vocabulary) == mixing.VOCABULARY and shape.shape == (6, mixing.SHAPES)


def test_query_drops_toxic_documents_and_keeps_clean_ones(spark, tables):
    docs, labels = tables
    got = {r["doc_id"]: r for r in queries.op9_mixing(spark, SF).collect()}
    assert got.keys() == {r["doc_id"] for r in docs.select("doc_id").collect()}
    by = {0: [], 1: [], 2: []}
    for r in labels.collect():
        if r["doc_id"] in got:
            by[_domain(r)].append(got[r["doc_id"]])
    assert by[2] and sum(r["copies"] == 0 for r in by[2]) >= 0.9 * len(by[2])
    assert sum(r["copies"] > 0 for r in by[0]) >= 0.9 * len(by[0])
    for r in got.values():
        assert abs(sum(r[f"p_{d}"] for d in mixing.DOMAINS) - 1) < 1e-9 and r["rate"] >= 0
        assert int(r["rate"]) <= r["copies"] <= int(r["rate"]) + 1


def test_posteriors_on_documents_left_out_of_training(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = F.col("doc_id") % 3 == 0
    model = mixing.train(docs, labels.filter(~out))
    held = {r["doc_id"]: _domain(r) for r in labels.filter(out).collect()}
    rows = mixing.posteriors(docs.filter(out), model, ["doc_id"]).select("d.doc_id", "p0", "p1", "p2").collect()
    toxic = [r["p2"] for r in rows if held.get(r["doc_id"]) == 2]
    clean = [r["p2"] for r in rows if held.get(r["doc_id"]) == 0]
    # Measured: 0.73 of 147 toxic documents; a guard against getting worse, not a claim.
    assert len(toxic) > 100 and np.mean(np.array(toxic) > 0.5) >= 0.68 and np.mean(np.array(clean) < 0.5) >= 0.95


def test_training_without_words_or_labels(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None)], DOC)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.train(docs, none) is None and mixing.train(docs.limit(0), none) is None
    blank = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    model = mixing.train(docs, blank)
    assert len(model.vocabulary) == 0
    rows = mixing.mix(docs, blank, keep=["doc_id"]).collect()
    assert len(rows) == 2 and all(r["tokens"] == 0 for r in rows)
