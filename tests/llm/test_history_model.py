"""op6's factors follow the history and its tables the corpus."""

from __future__ import annotations

import numpy as np

from appmart.llm import lm_score


def test_history_tells_words_of_one_class_apart(spark):
    # 400 equally frequent words, each followed by one other: a class has 27 of them, a share about two.
    rng = np.random.default_rng(3)
    after = np.roll(order := rng.permutation(400), -1)[np.argsort(order)]
    texts = []
    for start in rng.integers(0, 400, 3000):
        row = [int(start)]
        while len(row) < 100:
            row.append(int(after[row[-1]]))
        texts.append(" ".join(f"w{x}" for x in row))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    found = lm_score.score(docs).filter("held_out").selectExpr("sum(score) / sum(n_tokens)").first()[0]
    # Without history in the class a word has at most one 27th.
    assert found > -1.2


def test_probabilities_of_all_outcomes_add_up_to_one():
    known = lm_score.Classes(np.array([900, 500, 500, 90] + [20] * 30 + [3] * 200))
    buckets = lm_score.table_size(0)
    weights = np.random.default_rng(1).normal(size=(lm_score._weight_rows(buckets), lm_score.CLASSES)).astype(np.float32)
    leaves, place = np.unique(known.cls * lm_score.CLASSES + known.share, return_index=True)
    for history in (5, 77):
        hashed = np.full((lm_score.TABLES, len(leaves)), history, dtype=np.uint64)
        assert abs(np.exp(lm_score.log_history(weights, hashed, place, known, buckets)).sum() - 1) < 1e-5


def test_tables_grow_with_the_corpus():
    sizes = [lm_score.table_size(1 << k) for k in (10, 23, 24, 25, 60)]
    assert sizes[1] < sizes[2] < sizes[3] <= sizes[4] == lm_score.MAX_BUCKETS
    assert sizes[0] == lm_score.MIN_BUCKETS > 4096
