"""Recall of the Jaccard join's candidates, measured near the threshold against its formula."""

import numpy as np
import pytest

from barsmith.llm import minhash_forest as J


def measured(similarity, pairs=400, size=400, seed=3):
    """Share of random pairs of that similarity that share the prefix of some tree."""
    rnd = np.random.default_rng(seed)
    depth, met = J.prefix_depth(), 0
    other = round(size * (1 - similarity) / (2 * similarity))
    for _ in range(pairs):
        both, a, b = (rnd.integers(0, 2**63, n).astype(np.uint64) for n in (size, other, other))
        sig = [np.array([((s * m) >> np.uint64(32)).min() for m in J._MULTIPLIERS]).reshape(J.TREES, J.DEPTH)[:, :depth]
               for s in (np.append(both, a), np.append(both, b))]
        met += (sig[0] == sig[1]).all(1).any()
    return met / pairs


@pytest.mark.parametrize("similarity", [0.80, 0.82, 0.85])
def test_measured_recall_follows_the_formula(similarity):
    want = 1 - (1 - similarity ** J.prefix_depth()) ** J.TREES
    assert want >= J.RECALL and measured(similarity) >= 0.99


def test_pairs_far_below_rarely_meet():
    assert measured(0.3) < 0.2
