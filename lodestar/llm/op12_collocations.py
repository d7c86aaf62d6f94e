"""Phrase collocations counted in HAT-tries.

Each task counts the phrases of its rows in one trie a language: containers of
hashed phrases under a shallow trie over the ids of their first two words.
A container starts as the whole trie and is burst in two at a word id when it
outgrows ``BURST`` entries; a word's subtree becomes a container, then several.
Phrases are added as columns, a chunk's distinct ones at a time.  When a
task holds ``MOST_ENTRIES`` phrases, its largest subtrees are spilled whole,
each as a sorted run; at the end the rest follows.  The
runs are written to the shared folder, dealt to prefix partitions (ranges of
the phrases' lexicographic order, so a subtree that is too large for one
partition is split at a longer prefix) and merged there by summing.

A phrase can only be frequent where all its parts are.  Words are counted
first, then word pairs of frequent words, then the longer phrases that run
through frequent pairs only.  What is frequent travels to the tasks as a
bitmap of fixed size (``FILTER_BITS``); a false hit costs time and never a
count, so all counts of frequent phrases are exact.

Scores are integers from exact decimal arithmetic.  Pieces, words, phrases and
the score follow the query's contract; ``floor(1000 * a * n / (l * r))`` is
taken at the cut with the lowest value, ties to the shortest first part.

Defined cases: null, empty or blank texts have no words; null languages
count as ``und``; repeated rows count each; a language without candidates has no
rows; ties rank by score, frequency, then the phrase's bytes; long texts go
through in chunks of whole rows; an empty table gives an empty result; other
columns are ignored.  Inside a task a word or phrase is known by a 64-bit
hash; between tasks by its text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, documents, stored
from lodestar.llm.normal import collapsed, spans
from lodestar.llm.textnum import LOWER, doc_chunks, mix, span_hashes, text_buffer, windows
from lodestar.sources.scratch import scratch

LEAST, TOP, MOST_WORDS, SCALE, COVERED = 100, 2000, 5, 1000, 100
BURST, MOST_ENTRIES, BATCH = 32_768, 1_000_000, 50_000
CHUNK_BYTES = 4 << 20
FILTER_BITS = 26
_U = np.uint64

_GAP = np.zeros(256, bool)
_GAP[[9, 32]] = True
_CUT = np.zeros(256, bool)
_CUT[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True


class _Box:
    """A container: phrases under a range of paths, known by key."""

    def __init__(self, *columns):
        self.parts = [columns] if columns else []
        self.size = len(columns[0]) if columns else 0
        self.settled = self.size

    def add(self, *columns) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])

    def settle(self):
        """(path, key, count, text) of distinct phrases, by path."""
        if len(self.parts) > 1:
            path, key, count = (np.concatenate([p[c] for p in self.parts]) for c in range(3))
            _, first, at = np.unique(key, return_index=True, return_inverse=True)
            total = np.zeros(len(first), np.int64)
            np.add.at(total, at, count)
            order = np.argsort(path[first], kind="stable")
            pick = first[order]
            text = pa.concat_arrays([p[3] for p in self.parts]).take(pa.array(pick))
            self.parts = [(path[pick], key[pick], total[order], text)]
        self.size = self.settled = len(self.parts[0][0]) if self.parts else 0
        return self.parts[0] if self.parts else None


class HatTrie:
    """Counts of phrases (words joined by one blank).

    A path holds the ids of a phrase's first two words (32 bits each); every
    container has the phrases of a range of paths.  A container that outgrows
    ``burst`` entries is burst at its middle path, so a subtree that is still
    one container holds many first words and a large one is a word of its own,
    or some of that word's successors."""

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.lows, self.boxes = np.zeros(1, _U), [_Box()]

    @property
    def size(self) -> int:
        return sum(b.size for b in self.boxes)

    def add(self, path: np.ndarray, key: np.ndarray, count: np.ndarray, text: pa.Array) -> None:
        """Count phrases given by ascending path."""
        cut = np.append(np.searchsorted(path, self.lows), len(path))
        for box, i, j in zip(list(self.boxes), cut[:-1], cut[1:]):
            if j > i:
                box.add(path[i:j], key[i:j], count[i:j], text.slice(i, j - i))
                if box.size > max(self.burst, 2 * box.settled):
                    box.settle()
                    while box.size > self.burst:
                        box = self._burst(box)
                        if box is None:
                            break

    def _burst(self, box: _Box):
        """The upper half of a container as one of its own; None if its phrases have one path."""
        path, key, count, text = box.settle()
        at = int(np.searchsorted(path, path[len(path) // 2]))
        at = at or int(np.searchsorted(path, path[0], side="right"))
        if at == len(path):
            return None
        number = self.boxes.index(box) + 1
        upper = _Box(path[at:], key[at:], count[at:], text.slice(at))
        box.parts = [(path[:at], key[:at], count[:at], text.slice(0, at))]
        box.size = box.settled = at
        self.lows = np.insert(self.lows, number, path[at])
        self.boxes.insert(number, upper)
        return max(box, upper, key=lambda b: b.size)

    def spill(self, keep: int):
        """(text, count) runs in order of the text: whole containers, the
        largest first, until no more than ``keep`` entries are left."""
        for box in sorted(self.boxes, key=lambda b: -b.size):
            if self.size <= keep:
                break
            got = box.settle()
            if got is not None:
                order = pc.sort_indices(got[3])
                yield got[3].take(order), got[2][order.to_numpy()]
            box.parts, box.size, box.settled = [], 0, 0


def _texts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as strings."""
    size = ends - starts
    offs = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offs[1:])
    data = buf[np.arange(offs[-1]) + np.repeat(starts - offs[:-1], size)]
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offs), pa.py_buffer(data)])


def _salts(langs: list[str]) -> np.ndarray:
    """A number of each language that its phrases' hashes are salted with."""
    buf, offs = text_buffer(pa.array(langs, pa.large_string()))
    out = np.zeros(len(langs), _U)
    full = np.flatnonzero(np.diff(offs))
    out[full] = span_hashes(buf, offs[:-1][full], offs[1:][full])
    return mix(out + _U(0x9E3779B97F4A7C15))


class _Chunk:
    """Words and pieces of some rows."""

    def __init__(self, buf, offs, salts):
        self.buf, offs = buf, offs = collapsed(LOWER[buf], offs, _GAP)
        self.starts, self.ends, ptr = spans(buf, offs, _GAP | _CUT)
        self.h = span_hashes(buf, self.starts, self.ends)
        self.row = np.repeat(np.arange(len(offs) - 1), np.diff(ptr))
        self.salt = salts[self.row]
        m = len(self.starts)
        self.joined = np.zeros(max(m - 1, 0), bool)        # word i + 1 follows word i in its piece
        if m > 1:
            self.joined = (self.row[1:] == self.row[:-1]) & (self.starts[1:] - self.ends[:-1] == 1) & (buf[self.ends[:-1]] == 32)

    def keys(self, n: int) -> np.ndarray:
        """Salted hash of the ``n`` words from each word on."""
        h = windows(self.h, n)
        return mix(h ^ self.salt[:len(h)])


    def path(self, at: np.ndarray, n: int) -> np.ndarray:
        """Ids of the first two words of the phrases at ``at``."""
        first = self.h[at] >> _U(32) << _U(32)
        return first | self.h[at + 1] >> _U(32) if n > 1 else first


def _possible(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = keys >> _U(64 - FILTER_BITS)
    return (bitmap[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


def _wanted(chunk: _Chunk, sizes: range, bitmap):
    """(n, positions) of the phrases to count: all words; pairs of words in the
    bitmap; longer phrases whose every pair is."""
    if 1 in sizes:
        yield 1, np.arange(len(chunk.h))
        return
    run = chunk.joined.copy()
    if 2 in sizes:
        good = _possible(chunk.keys(1), bitmap)
        run &= good[1:] & good[:-1]
        yield 2, np.flatnonzero(run)
        return
    run[run] = _possible(chunk.keys(2)[run], bitmap)
    through = run
    for n in sizes:
        through = through[:len(run) - n + 2] & run[n - 2:]
        yield n, np.flatnonzero(through)


RUN_DDL = "lang string, phrase string, n long"


def sorted_runs(docs: DataFrame, sizes: range, bitmap: bytes | None, most: int = MOST_ENTRIES) -> DataFrame:
    """(lang, phrase, n): the runs spilled by all tasks for phrases of ``sizes`` words."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)      # FILTER_BITS at most

    def run(batches):
        tries: dict[str, HatTrie] = {}
        bits = None if shared.value is None else np.frombuffer(shared.value, np.uint8)

        def out(lang, runs):
            for text, count in runs:
                for a in range(0, len(text), BATCH):
                    part = text.slice(a, BATCH)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), part.cast(pa.string()), pa.array(count[a:a + BATCH])], ["lang", "phrase", "n"])

        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            langs, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            salts = _salts(langs)[code]
            buf, offs = text_buffer(batch.column(0))
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                chunk = _Chunk(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a], salts[a:b])
                for n, pos in _wanted(chunk, sizes, bits):
                    key, first, count = np.unique(chunk.keys(n)[pos], return_index=True, return_counts=True)
                    at = pos[first]
                    path, lang = chunk.path(at, n), code[a:b][chunk.row[at]]
                    order = np.lexsort((path, lang))
                    at, path, key, count, lang = at[order], path[order], key[order], count[order], lang[order]
                    text = _texts(chunk.buf, chunk.starts[at], chunk.ends[at + n - 1])
                    for i in np.unique(lang).tolist():
                        x, y = np.searchsorted(lang, [i, i + 1])
                        trie = tries.setdefault(langs[i], HatTrie())
                        trie.add(path[x:y], key[x:y], count[x:y], text.slice(x, y - x))
                    while sum(t.size for t in tries.values()) > most:
                        top = max(tries, key=lambda x: tries[x].size)
                        yield from out(top, tries[top].spill(tries[top].size // 2))
        for lang, trie in tries.items():
            yield from out(lang, trie.spill(0))

    return docs.mapInArrow(run, RUN_DDL)


def merged(runs: DataFrame, name: str, least: int = 1) -> DataFrame:
    """(lang, phrase, n): the runs' totals of at least ``least``, merged in
    prefix partitions and stored; the runs are dropped then."""
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with scratch(runs.sparkSession):
        kept = stored(runs, f"op12-runs-{name}", compression="zstd")
        total = (kept.repartitionByRange(parts, "lang", "phrase").sortWithinPartitions("lang", "phrase")
                 .groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))
        return stored(total, f"op12-counts-{name}", keep=True)


def bitmap_of(frequent: DataFrame, n: int) -> bytes:
    """Bits of the phrases of ``n`` words: a number of bytes fixed by ``FILTER_BITS``."""
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            starts, ends, ptr = spans(buf, offs, _GAP)
            key = mix(windows(span_hashes(buf, starts, ends), n)[ptr[:-1]] ^ _salts(batch.column(0).to_pylist())) if len(starts) else np.zeros(0, _U)
            yield pa.RecordBatch.from_arrays([pa.array((key >> _U(64 - FILTER_BITS)).astype(np.int64))], ["slot"])

    slots = frequent.select("lang", "phrase").mapInArrow(run, "slot long").select((F.col("slot") + 1).alias("slot"))
    rows = (slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    out = bytearray((1 << FILTER_BITS) // 8)
    for r in rows:
        at = (r.bucket - 1) * len(r.bits)
        out[at:at + len(r.bits)] = r.bits
    return bytes(out)


def phrase_counts(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS,
                  text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of every phrase of up to ``most_words`` words
    with f >= least, (lang, n) words of each language)."""
    bounded_batches(docs.sparkSession)
    src = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                      F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    words = merged(sorted_runs(src, range(1, 2), None), "1")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often, parts = words.filter(F.col("n") >= least), []
    for size, sizes in enumerate((range(2, 3), range(3, most_words + 1)), 1):
        parts.append(often)
        bits = bitmap_of(often, size)
        often = merged(sorted_runs(src, sizes, bits), str(sizes[0]), least)
    counts = parts[0].unionByName(parts[1]).unionByName(often)
    return stored(counts.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("size"), F.col("n").alias("f")), "op12-counts"), totals


def scored(counts: DataFrame, totals: DataFrame, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one covers."""
    cand = counts.filter("size > 1").withColumnRenamed("f", "a")
    word = F.split("phrase", " ")
    part = lambda begin, size: F.array_join(F.slice(F.col("w"), begin, size), " ")
    inner = (cand.filter("size > 2").withColumn("w", word)
             .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
             .select("lang", part(F.col("i"), F.col("m")).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    free = cand.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (exact("longer") * covered < exact("a") * 100)).select("lang", "phrase", "size", "a")
    side = lambda x: counts.select("lang", F.col("phrase").alias(f"{x}_phrase"), F.col("f").alias(x))
    cuts = (free.withColumn("w", word).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("l_phrase"),
                    part(F.col("k") + 1, F.col("size") - F.col("k")).alias("r_phrase"))
            .join(side("l"), ["lang", "l_phrase"]).join(side("r"), ["lang", "r_phrase"]).join(totals, "lang")
            .withColumns({"x_top": exact("a") * exact("n") * F.lit(SCALE).cast("decimal(5,0)"), "x_low": exact("l") * exact("r")})
            .withColumn("score", F.expr("x_top div x_low")))
    return (cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("low"))
            .select("lang", "phrase", "low.a", "low.l", "low.r", "low.n", "low.score"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top``."""
    counts, totals = phrase_counts(docs, least, text_col=text_col, lang_col=lang_col)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each salt's share, then the first of those: no window holds a whole language
    salts = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    some = (scored(counts, totals).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
            .withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top))
    return (some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
            .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


ORACLE = r"""
WITH piece AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t
        FROM documents) s)
, gram AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
        SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (
            SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS k FROM piece) x WHERE len(w) >= k) y)
, f AS (SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 100)
, total AS (SELECT lang, count(*) AS n FROM gram WHERE k = 1 GROUP BY lang)
, cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1)
, inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM (
        SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM (
            SELECT lang, w, a, k, unnest(range(2, k)) AS m FROM cand) x) y GROUP BY ALL)
, free AS (SELECT c.* FROM cand c LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a)
, cut AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS c FROM free)
, val AS (SELECT cut.lang, cut.phrase, cut.a, cut.c, l.f AS l, r.f AS r, t.n,
              CAST((1000::HUGEINT * cut.a * t.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
          FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(cut.w[1:cut.c], ' ')
          JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(cut.w[cut.c + 1:], ' ')
          JOIN total t ON t.lang = cut.lang)
, low AS (SELECT * FROM val QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM low QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
