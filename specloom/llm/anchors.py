"""Minimizers: positions chosen by content, so that equal stretches choose alike.

Of each window of `window` consecutive run hashes the smallest is an anchor (the leftmost
of equals). Two equal stretches of window + width - 1 units share an anchor at the same place.
"""

from __future__ import annotations

import numpy as np


#: Runs of one piece: their positions take the low 24 bits of a packed number.
LIMIT = 1 << 24


def _minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """The position of the smallest hash of each window, in at most `LIMIT` runs."""
    low = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    have = 1
    while have < window:
        step = min(have, window - have)
        if len(low) <= step:
            low = low[:0]
            break
        low = np.minimum(low[:-step], low[step:])
        have += step
    return (low & np.uint64(0xFFFFFF)).astype(np.int64)


def window_minima(hashes: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """For each window start: the position of the window's smallest hash.

    `hashes` are a text's run hashes one after the other, text i at first[i]:first[i+1]; the
    result has max(0, n - window + 1) entries a text. Hashes are compared on their high 40 bits.
    """
    # pieces overlap by a window less one run, so each window lies in one piece
    step = LIMIT - window + 1
    low = np.concatenate([_minima(hashes[at : at + LIMIT], window) + at for at in range(0, max(len(hashes) - window + 1, 1), step)])
    size = np.diff(first)
    runs = np.maximum(size - window + 1, 0)
    begin = np.r_[0, np.cumsum(runs)]
    starts = np.repeat(first[:-1] - begin[:-1], runs) + np.arange(begin[-1])
    return low[starts]
