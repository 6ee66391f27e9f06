"""Candidate matches are all verified, however many a piece has."""

import numpy as np
import pytest

from clickweir.llm.decontaminate import choose_prefixes, find_windows, item_windows
from clickweir.llm.words import find_words


@pytest.mark.parametrize("n", [0, 1, (1 << 18) - 1, 1 << 18, (1 << 18) + 1, 1 << 19])
@pytest.mark.parametrize("items", [["word"], ["word", "Word word"]])
def test_matches_at_the_edge_of_a_slice(n, items):
    windows = item_windows([(str(i), t) for i, t in enumerate(items)])
    index = choose_prefixes(windows, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    raw = np.frombuffer(b"word " * n, np.uint8)
    _, _, hashes, counts = find_words(raw, np.array([0, len(raw)]))
    at, which = find_windows(hashes, counts, index)
    want = sum(max(0, n - k) for k in range(len(items)))
    assert len(at) == want and len(set(zip(at.tolist(), which.tolist()))) == want
