"""Word spans and plain spacing of whole texts, over Arrow buffers."""

from __future__ import annotations

import numpy as np


def collapsed(buf: np.ndarray, offs: np.ndarray, space: np.ndarray):
    """(bytes, offsets) with every run of ``space`` bytes inside a row as one
    blank, so that consecutive words are their bytes joined by one blank."""
    blank = space[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = ~blank[1:] | ~blank[:-1]
    keep[offs[:-1][offs[:-1] < len(buf)]] = True
    at = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    return np.where(blank[keep], np.uint8(32), buf[keep]), at[offs]


def spans(buf: np.ndarray, offs: np.ndarray, gap: np.ndarray):
    """(starts, ends, row_ptr): maximal runs of bytes outside ``gap``; those of
    row i are row_ptr[i]:row_ptr[i + 1]."""
    n = len(buf)
    out = gap[buf]
    first, last = np.ones(n + 1, bool), np.ones(n + 1, bool)
    first[1:], last[:n] = out, out
    first[offs] = last[offs] = True
    starts = np.flatnonzero(~out & first[:n])
    return starts, np.flatnonzero(~out & last[1:]) + 1, np.searchsorted(starts, offs)
