"""Vectorised text helpers used inside tasks (numpy over Arrow buffers).

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  A word gets a
64-bit hash from a polynomial prefix sum over its bytes, and a window of
words gets one from a prefix sum over word hashes, so every rolling window
costs a few array operations and no Python loop.  All helpers take whole
texts; memory stays bounded because callers walk a batch in chunks
(``doc_chunks``) and ``words`` walks a chunk in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18                    # bytes (or words) hashed at a time
_U = np.uint64
_BASE_BYTES, _BASE_WORDS = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_TABLE = np.random.RandomState(20240611).randint(0, 2**63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_POWERS: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(base: np.uint64) -> np.ndarray:
    got = _POWERS.get(int(base))
    if got is None:
        got = np.full(PIECE + 1, base, _U)
        got[0] = 1
        got = _POWERS[int(base)] = np.cumprod(got, dtype=_U)
    return got


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def doc_chunks(offs: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) holding at most ``max_bytes`` of text, or one row."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + max_bytes, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def _piece_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, origin: int) -> np.ndarray:
    p = _powers(_BASE_BYTES)
    s = np.zeros(len(buf) + 1, _U)
    np.cumsum(_TABLE[buf] * p[:len(buf)], out=s[1:])
    return mix((s[ends - origin] - s[starts - origin]) * p[PIECE - (starts - origin)])


def words(buf: np.ndarray, offs: np.ndarray, lower: bool = False):
    """(starts, ends, hashes, doc_ptr): byte spans and hashes of all words;
    words of row i are doc_ptr[i]:doc_ptr[i + 1]."""
    if lower:
        buf = LOWER[buf]
    n = len(buf)
    space = IS_SPACE[buf]
    before = np.ones(n + 1, bool)
    before[1:] = space
    before[offs] = True
    starts = np.flatnonzero(~space & before[:n])
    after = np.ones(n + 1, bool)
    after[:n] = space
    after[offs] = True
    ends = np.flatnonzero(~space & after[1:]) + 1
    return starts, ends, span_hashes(buf, starts, ends), np.searchsorted(starts, offs)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ascending, disjoint byte spans; equal bytes give equal hashes."""
    out = np.zeros(len(starts), _U)
    i, m = 0, len(starts)
    while i < m:
        j = int(np.searchsorted(ends, starts[i] + PIECE, side="right"))
        if j == i:        # one span longer than a piece
            digest = hashlib.blake2b(buf[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
            out[i] = np.frombuffer(digest, _U)[0]
            i += 1
            continue
        out[i:j] = _piece_hashes(buf[starts[i]:ends[j - 1]], starts[i:j], ends[i:j], int(starts[i]))
        i = j
    return out


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words (row ends ignored:
    callers keep the positions whose run stays inside a row)."""
    m = len(hashes) - width + 1
    if m <= 0:
        return np.zeros(0, _U)
    p, out = _powers(_BASE_WORDS), np.empty(m, _U)
    step = PIECE - width
    for a in range(0, m, step):
        b = min(m, a + step)
        part = hashes[a:b + width - 1]
        s = np.zeros(len(part) + 1, _U)
        np.cumsum(part * p[:len(part)], out=s[1:])
        i = np.arange(b - a)
        out[a:b] = mix((s[i + width] - s[i]) * p[PIECE - i])
    return out


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole short word sequence, as ``windows`` would give it."""
    return windows(hashes, len(hashes))[0]


def inside(doc_ptr: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(word positions whose window of ``width`` stays in its row, their row)."""
    counts = np.diff(doc_ptr)
    row = np.repeat(np.arange(len(counts)), counts)
    pos = np.arange(len(row)) + doc_ptr[0]
    ok = pos + width <= doc_ptr[1:][row]
    return pos[ok], row[ok]


def ragged_take(ptr: np.ndarray, values: np.ndarray, pick: np.ndarray):
    """(values, ptr) of the rows ``pick`` of a ragged array."""
    size = (ptr[1:] - ptr[:-1])[pick]
    out_ptr = np.zeros(len(pick) + 1, np.int64)
    np.cumsum(size, out=out_ptr[1:])
    at = np.arange(out_ptr[-1]) + np.repeat(ptr[:-1][pick] - out_ptr[:-1], size)
    return values[at], out_ptr
