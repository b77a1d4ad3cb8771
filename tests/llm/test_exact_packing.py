"""The boundaries of long documents are the best for their real lengths."""
import itertools
import random

import numpy as np

from sitewise.llm import packing


def _least(lengths, k):
    tops = sorted(set(lengths))
    return min(sum(min(b for b in (*c, tops[-1]) if b >= x) - x for x in lengths) for r in range(k) for c in itertools.combinations(tops[:-1], r))


def test_long_lengths_are_not_merged(docs_of):
    rng = random.Random(7)
    for _ in range(3):
        lengths = [rng.randint(3000, 3060) for _ in range(40)]  # some 16 words to a bin of 128 an octave
        rows = packing.pack(docs_of(["w " * n for n in lengths]), n_buckets=3).collect()
        assert sum(r["padding"] for r in rows) == _least(lengths, 3)


def test_hull_equals_plain_search():
    rng = random.Random(8)
    for _ in range(30):
        lengths = [rng.randint(1, 5000) for _ in range(rng.randint(1, 14))] * rng.randint(1, 3) + [rng.randint(1, 5000)] * 9
        v, n = np.unique(lengths, return_counts=True)
        for k in (1, 2, 4, 20):
            b = np.array(packing.best_boundaries(v, n, v * n, k))
            assert sum(n * (b[np.searchsorted(b, v)] - v)) == _least(lengths, k)
