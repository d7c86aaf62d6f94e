"""Benchmark decontamination by spaced-seed hashing.

A mask such as ``1010010111`` hashes the words at its ones and ignores the
others, so a copied passage still matches where words were replaced.  The
three masks are chosen so that every window of 13 words with any two words
replaced holds an untouched seed (tests enumerate all 78 cases).  An item
shorter than the window has masks of its own length besides, enough of them
to leave one untouched by any substitutions that the check accepts
(``cover``; tests enumerate lengths 10 to 12): no overlap that the check below
accepts is missed.

The benchmark is a query set: it is read in blocks of at most
``BLOCK_BYTES`` of text, and each block is matched against all documents in
one pass, inside the tasks that scan them; nothing is shuffled for a block.
Every rolling seed of every whole text is looked up; around each hit the
passage is laid beside the item on the hit's diagonal and compared word by
word.  A document is contaminated by an item when ``window`` consecutive
item words (or all of a shorter item's) are matched by at least
``least_share`` of them in place.

Words are runs of letters, digits and non-ASCII bytes, lower-cased (A-Z).

Defined cases: null or empty texts are clean; an item with fewer than
``min_words`` words is too short to tell a leak from chance and matches
nothing; one between that and the seed span must occur whole and unchanged;
null item ids stay null in the list; repeated documents are judged each;
empty tables give clean or empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, documents, stored, table
from lodestar.llm.textnum import LOWER, doc_chunks, inside, mix, text_buffer, windows, words

MASKS = ("1010010111", "1100101011", "1101011001")
WINDOW, LEAST_SHARE, MIN_WORDS = 13, 0.8, 8
BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 4 << 20
FILTER_BITS = 22
LAID = 1 << 20                # words laid beside items at once
_U = np.uint64

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def _words(buf: np.ndarray, offs: np.ndarray):
    """(hashes, doc_ptr) of lower-cased words without punctuation."""
    _, _, h, ptr = words(np.where(_WORD[buf], LOWER[buf], np.uint8(32)), offs)
    return h, ptr


def spaced(h: np.ndarray, mask: str, number: int) -> np.ndarray:
    """Seed hash at every position of a word-hash array."""
    m = len(h) - len(mask) + 1
    out = np.full(max(m, 0), number + 1, _U)
    for at, used in enumerate(mask):
        if used == "1" and m > 0:
            out = out * _U(0x9E3779B97F4A7C15) + h[at:at + m]
    return mix(out)


@lru_cache(maxsize=None)
def cover(size: int, most: int) -> tuple[str, ...]:
    """Masks of ``size`` words, with as many ones as ``MASKS`` have where that
    can be, such that any ``most`` replaced words leave one of them untouched."""
    blanks = [frozenset(b) for b in combinations(range(size), max(most, size - MASKS[0].count("1")))]
    left, out = {frozenset(c) for c in combinations(range(size), most)}, []
    while left:
        best = max(blanks, key=lambda b: sum(c <= b for c in left))
        left = {c for c in left if not c <= best}
        out.append("".join("0" if j in best else "1" for j in range(size)))
    return tuple(out)


def accepted(size: int, least_share: float) -> int:
    """Most replaced words of ``size`` that the check accepts."""
    return max(n for n in range(size + 1) if n == 0 or size - n >= least_share * size)


class Block:
    """Seeds of some benchmark items, ready to be looked up."""

    def __init__(self, ids: list, texts: list[str], min_words: int, window: int = WINDOW, least_share: float = LEAST_SHARE):
        buf, offs = text_buffer(pa.array(texts, pa.large_string()))
        self.h, self.ptr = _words(buf, offs)
        self.ids, n = ids, np.diff(self.ptr)
        span = max(map(len, MASKS))
        self.whole = sorted({int(x) for x in n if min_words <= x < span})
        self.seeds = []                       # (word count or mask, keys, word position, item)
        for number, mask in enumerate(MASKS):
            pos, item = inside(self.ptr, len(mask))
            long = n[item] >= span
            self._add(mask, spaced(self.h, mask, number)[pos[long]], pos[long], item[long])
        for size in sorted({int(x) for x in n if span <= x < min(window, WINDOW)}):
            item = np.flatnonzero(n == size)
            for mask in cover(size, accepted(size, least_share)):
                self._add(mask, spaced(self.h, mask, len(self.seeds))[self.ptr[item]], self.ptr[item], item)
        for size in self.whole:
            item = np.flatnonzero(n == size)
            self._add(size, windows(self.h, size)[self.ptr[item]], self.ptr[item], item)

    def _add(self, what, keys, pos, item) -> None:
        order = np.argsort(keys, kind="stable")
        maybe = np.zeros(1 << FILTER_BITS, bool)
        maybe[keys >> _U(64 - FILTER_BITS)] = True
        self.seeds.append((what, keys[order], pos[order], item[order], np.packbits(maybe, bitorder="little")))

    def hits(self, h: np.ndarray, ptr: np.ndarray):
        """(document, diagonal start in words, item) of all hits, distinct."""
        found = []
        for number, (what, keys, at, item, maybe) in enumerate(self.seeds):
            width = len(what) if isinstance(what, str) else what
            seed = spaced(h, what, number) if isinstance(what, str) else windows(h, what)
            slot = seed >> _U(64 - FILTER_BITS)
            pos = np.flatnonzero((maybe[slot >> _U(3)] >> (slot & _U(7)).astype(np.uint8)) & 1)
            lo = np.searchsorted(keys, seed[pos])
            n = np.searchsorted(keys, seed[pos], side="right") - lo
            pos, lo, n = pos[n > 0], lo[n > 0], n[n > 0]
            doc = np.searchsorted(ptr, pos, side="right") - 1
            ok = pos + width <= ptr[doc + 1]
            pos, lo, n, doc = pos[ok], lo[ok], n[ok], doc[ok]
            if not len(pos):
                continue
            e = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            found.append(np.stack([np.repeat(doc, n), np.repeat(pos, n) - (at[e] - self.ptr[item[e]]), item[e]], 1))
        found = np.concatenate([np.zeros((0, 3), np.int64), *found])
        found = found[np.lexsort(found.T)]
        return found[np.append(True, (found[1:] != found[:-1]).any(axis=1))[:len(found)]]

    def overlaps(self, h, ptr, found: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(best matched words, words compared) along the diagonal of each hit."""
        doc, start, item = found.T
        first, length = self.ptr[item], np.diff(self.ptr)[item]
        lo, hi = np.maximum(start, ptr[doc]), np.minimum(start + length, ptr[doc + 1])
        size, best = np.minimum(window, length), np.zeros(len(found), np.int64)
        able = np.flatnonzero(hi - lo >= size)
        ends, a = np.append(0, np.cumsum((hi - lo)[able])), 0
        while a < len(able):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + LAID, side="right")) - 1)
            pick, n = able[a:b], np.diff(ends[a:b + 1])
            at = np.arange(n.sum()) - np.repeat(ends[a:b] - ends[a], n)
            same = h[np.repeat(lo[pick], n) + at] == self.h[np.repeat((first + lo - start)[pick], n) + at]
            same = np.append(0, np.cumsum(same))
            width = np.repeat(size[pick], n)
            begin = np.flatnonzero(at + width <= np.repeat(n, n))          # windows inside the overlap
            whole = n - size[pick] + 1
            best[pick] = np.maximum.reduceat(same[begin + width[begin]] - same[begin], np.cumsum(whole) - whole)
            a = b
        return best, size


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, *limits) -> Iterator[Block]:
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).toLocalIterator():
        if texts and size + len(r.t) > BLOCK_BYTES:
            yield Block(ids, texts, *limits)
            ids, texts, size = [], [], 0
        ids.append(r.i)
        texts.append(r.t)
        size += len(r.t)
    yield Block(ids, texts, *limits)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE,
                  min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(row, contaminated, n_items, best_share, items): ``row`` holds the input
    row as a struct, so no column of it can clash with the others."""
    bounded_batches(docs.sparkSession)
    span = max(map(len, MASKS))
    cur = docs.select(F.struct("*").alias("row"), F.lit(0.0).alias("best_share"), F.array().cast("array<long>").alias("items"))
    schema = cur.schema
    number = docs.columns.index(text_col)
    for turn, block in enumerate(_blocks(benchmark, item_col, item_text, min_words, window, least_share)):
        shared = docs.sparkSession.sparkContext.broadcast(block)     # at most BLOCK_BYTES of text

        def run(batches, shared=shared):
            block = shared.value
            for batch in batches:
                buf, offs = text_buffer(batch.column(0).field(number))
                share = batch.column(1).to_numpy(zero_copy_only=False).copy()
                items = [set(x) for x in batch.column(2).to_pylist()]
                for a, b in doc_chunks(offs, CHUNK_BYTES):
                    h, ptr = _words(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                    found = block.hits(h, ptr)
                    got, size = block.overlaps(h, ptr, found, window)
                    leak = got >= np.where(np.diff(block.ptr)[found[:, 2]] < span, size, least_share * size)
                    np.maximum.at(share, a + found[leak, 0], got[leak] / size[leak])
                    for doc, item in found[leak][:, [0, 2]].tolist():
                        items[a + doc].add(block.ids[item])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(share),
                     pa.array([sorted(x, key=lambda i: (i is None, i)) for x in items], pa.list_(pa.int64()))],
                    ["row", "best_share", "items"])

        if turn:              # one stored pass a block
            cur = stored(cur, "op5-block")
        cur = cur.mapInArrow(run, schema)
    return cur.select("row", (F.size("items") > 0).alias("contaminated"), F.size("items").cast("long").alias("n_items"),
                      "best_share", "items")


def query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "contaminated", "n_items", "best_share", "items")
