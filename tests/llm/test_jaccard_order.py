"""op1: the order of a set costs what the set costs."""

from __future__ import annotations

import time

import numpy as np

from appmart.llm import ngram_jaccard


def test_order_of_a_set_does_not_read_the_whole_list_of_common_ones():
    rng = np.random.default_rng(2)
    common = np.unique(rng.integers(0, 1 << 62, 2_000_000, dtype=np.uint64))
    weight = rng.integers(3, 20, len(common)).astype(np.int8)
    level = dict(zip(common[:5000].tolist(), weight[:5000].tolist()))
    sets = [np.unique(np.concatenate([rng.integers(0, 1 << 64, 200, dtype=np.uint64), rng.choice(common[:5000], 60)]))
            for _ in range(200)]
    began = time.process_time()
    found = [ngram_jaccard._in_order(s, common, weight, 40) for s in sets]
    assert time.process_time() - began < 1
    for s, (first, rare) in zip(sets, found):
        # Draws outside the given 5,000 are not among the common ones but for a chance of one in a million.
        assert first.tolist() == sorted(s.tolist(), key=lambda x: (x >> 62, level.get(x, 0), x))[:40]
        assert rare == sum(x < 1 << 62 and x not in level for x in s.tolist())
