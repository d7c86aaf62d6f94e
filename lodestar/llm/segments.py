"""Encoding whole texts through repeated segments.

A tokenizer that never joins bytes across certain boundaries gives the same
ids for a text as for its segments, one after the other.  A batch's distinct
segments are encoded once, kept in a bounded store, and gathered back with
array operations, so the cost follows the distinct segments.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from lodestar.llm.textnum import ragged_take, span_hashes

MAX_STORED = 400_000          # segments kept between batches, per worker, unless the caller says otherwise
_U = np.uint64


def cut(buf: np.ndarray, offs: np.ndarray, joined: np.ndarray, drop: np.ndarray | None = None):
    """(starts, ends) of segments: cuts at row starts and between adjacent
    bytes a, b with joined[256 * a + b] false; ``drop`` marks bytes left out."""
    n = len(buf)
    new = np.ones(n + 1, bool)
    if n > 1:
        new[1:n] = ~joined[(buf[:-1].astype(np.uint16) << 8) | buf[1:]]
    new[offs] = True
    starts = np.flatnonzero(new[:n])
    ends = np.append(starts[1:], n) if len(starts) else starts
    if drop is not None and len(starts):
        keep = ~drop[buf[starts]]
        starts, ends = starts[keep], ends[keep]
    return starts, ends


class SegmentEncoder:
    """Ids of whole texts from ids of their distinct segments."""

    def __init__(self, joined: np.ndarray, encode: Callable[[list[bytes]], list[list[int]]],
                 drop: np.ndarray | None = None, fold: np.ndarray | None = None, most: int = MAX_STORED):
        self.joined, self.encode, self.drop, self.fold, self.most = joined, encode, drop, fold, most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.ptr, self.ids = np.zeros(0, _U), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _store(self, keys, ptr, ids) -> None:
        keys = np.concatenate([self.keys, keys])
        ptr = np.concatenate([self.ptr, ptr[1:] + self.ptr[-1]])
        ids = np.concatenate([self.ids, ids])
        order = np.argsort(keys, kind="stable")
        self.ids, self.ptr = ragged_take(ptr, ids, order)
        self.keys = keys[order]

    def __call__(self, buf: np.ndarray, offs: np.ndarray):
        """(ids, ptr): ids of all rows and where each row's ids start."""
        if self.fold is not None:
            buf = self.fold[buf]
        starts, ends = cut(buf, offs, self.joined, self.drop)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        keys, first, at = np.unique(span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self._clear()
        known = np.searchsorted(self.keys, keys)
        fresh = np.ones(len(keys), bool)
        inside = known < len(self.keys)
        fresh[inside] = self.keys[known[inside]] != keys[inside]
        fresh = np.flatnonzero(fresh)
        if len(fresh):
            raw = buf.tobytes()
            got = self.encode([raw[starts[i]:ends[i]] for i in first[fresh]])
            ptr = np.zeros(len(got) + 1, np.int64)
            np.cumsum([len(g) for g in got], out=ptr[1:])
            self._store(keys[fresh], ptr, np.fromiter((i for g in got for i in g), np.uint32, ptr[-1]))
            known = np.searchsorted(self.keys, keys)
        ids, ptr = ragged_take(self.ptr, self.ids, known[at])
        return ids, ptr[np.searchsorted(starts, offs)]
