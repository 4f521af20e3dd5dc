"""Windows are named by interior symbols: the same name for equal windows, wherever they lie, and for no others."""

import numpy as np
import pytest

from tallyward.llm import substrings


@pytest.mark.parametrize("letters", [1, 2, 3, 8, 1000])
def test_names_tell_windows_apart(letters):
    rng = np.random.default_rng(letters)
    codes = rng.integers(1, 1 << 63, letters, dtype=np.uint64)
    for width in (2, 5, 20):
        size = rng.integers(0, 120, 30)
        text = [rng.integers(0, letters, n) for n in size]
        shared = rng.integers(0, letters, 60)
        text += [np.concatenate([rng.integers(0, letters, rng.integers(0, 9)), shared[i : i + 45], rng.integers(0, letters, rng.integers(0, 9))]) for i in range(0, 15, 3)]
        first = np.concatenate([[0], np.cumsum([len(x) for x in text])])
        words = np.concatenate(text)
        h = codes[words]
        start, _ = substrings.inner_starts(first, width)
        names = substrings.window_keys(h, first, substrings.symbols_of(h, first), start, width)
        windows = [tuple(words[i : i + width].tolist()) for i in start]
        assert len(set(zip(windows, names.tolist(), strict=True))) == len(set(windows)) == len(set(names.tolist()))


def test_long_windows_have_interior_symbols():
    rng = np.random.default_rng(1)
    h = rng.integers(1, 1 << 63, 5000, dtype=np.uint64)
    first = np.array([0, 5000])
    s = substrings.symbols_of(h, first)
    start, _ = substrings.inner_starts(first, 20)
    low, high = np.searchsorted(s.left, start, "left"), np.searchsorted(s.right, start + 20, "right")
    assert (high > low).all() and (high - low).mean() > 3 and len(s.name) < 0.7 * len(h)
