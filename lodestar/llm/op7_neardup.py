"""MinHash near-dedup by a multi-index Hamming join on b-bit signatures.

A document's set holds its distinct word shingles.  Its signature has
``chunks * width`` b-bit minhash symbols, cut into ``chunks`` chunks of
``width`` symbols.  By pigeonhole, two signatures that differ in at most
``2 * chunks - 1`` symbols agree up to one error in some chunk; enumerating
the allowed error (one symbol left out of each chunk in turn) turns "one
error at most" into equality of a key, so an equi-join on
``chunks * width`` keys finds *every* pair under the signature distance.
``plan_signature`` picks the chunks so that a pair exactly at the similarity
threshold exceeds that distance with a chance below 1e-5.

Work stays linear in the size of a group:

* documents with equal sets form a class first; only its representative
  (smallest doc_id) goes on; where a doc_id stands for several classes, all
  but one go on under a hash of (doc_id, set), so its texts stay apart;
* round 1 links each bucket's members to the bucket's smallest member only,
  the links are confirmed on full sets, and components are formed;
* round 2 takes buckets that still hold several components.  A bucket is
  split into blocks of about ``BLOCK_ROWS`` members (fewer of long texts), each
  pair of blocks goes to a task of its own, and members outside the bucket's
  leading component are compared there with members of other components, on
  long signatures (``LONG`` symbols) and, where those allow the threshold at
  ``LONG_SIGMAS`` standard deviations, on full sets.  What comes out are links
  between components, less than one for each of the block's members, however
  many of its pairs are near or all but near.

Every candidate must pass the signature distance (round 1) or the long
signature (round 2), and the size ratio, then an exact intersection of the
full shingle sets.  No bucket or candidate is capped.

Defined cases: null or empty text (or no words) has an empty set, size 0,
and is its own component; a null doc_id is never linked; repeated rows form
one class; of different texts under one doc_id each has the component of its
own text, and one class of a component is kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, components, documents, possible, stored
from lodestar.llm.textnum import doc_chunks, inside, mix, sequence_hash, text_buffer, windows, words

MISS = 1e-5
MOST_KEYS = 60             # keys a document that wider chunks may cost
LONG, LONG_SIGMAS = 1024, 5.0
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1 << 21       # of a block, about
CHUNK_BYTES = 2 << 20
SET_KEY = ["n", "f1", "f2"]
_U = np.uint64


def plan_signature(threshold: float, miss: float = MISS) -> tuple[int, int]:
    """(chunks, symbols per chunk) such that a pair at the threshold differs
    in 2 * chunks symbols or more with a chance of at most ``miss``
    (thresholds from 0.65 up; each chunk then expects under two errors)."""
    if not 0.65 <= threshold <= 1:
        raise ValueError("signature plans cover thresholds from 0.65 to 1")

    def tail(n: int, least: int, p: float) -> float:
        return sum(math.comb(n, k) * p**k * (1 - p)**(n - k) for k in range(least, n + 1))
    def least_chunks(width: int) -> int:
        chunks = 4
        while tail(chunks * width, 2 * chunks, 1 - threshold) > miss:
            chunks += 1
        return chunks

    # keys of four symbols where they are cheap, else of three
    wide = least_chunks(5)
    return (wide, 5) if wide * 5 <= MOST_KEYS else (least_chunks(4), 4)


def shingle_sets(buf, offs, k: int):
    """(ptr, hashes): sorted distinct shingle hashes of every row."""
    _, _, h, ptr = words(buf, offs, lower=True)
    win = windows(h, k)
    pos, row = inside(ptr, k)
    counts = np.diff(ptr)
    values, rows = win[pos], row
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        values = np.concatenate([values, np.array([sequence_hash(h[ptr[i]:ptr[i + 1]]) for i in short], _U)])
        rows = np.concatenate([rows, short])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[new], rows[new]
    return np.searchsorted(rows, np.arange(len(offs))), values


def _signature(values, ptr, n_symbols: int) -> np.ndarray:
    """uint16 symbols, one row per non-empty set."""
    rng = np.random.RandomState(77)
    mul = rng.randint(1, 2**31, n_symbols, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    add = rng.randint(0, 2**31, n_symbols, dtype=np.int64).astype(np.uint32)
    low, high = (values >> _U(32)).astype(np.uint32), values.astype(np.uint32)
    out = np.empty((len(ptr) - 1, n_symbols), np.uint16)
    for s in range(n_symbols):
        least = np.minimum.reduceat((low * mul[s] + add[s]) ^ (high >> np.uint32(s % 16)), ptr[:-1])
        out[:, s] = (mix(least.astype(_U)) >> _U(48)).astype(np.uint16)
    return out


def _fingerprints(values, at):
    """The two halves of a set's fingerprint, for sets starting ``at``."""
    return (np.add.reduceat(mix(values ^ _U(0x5851F42D4C957F2D)), at), np.add.reduceat(mix(values ^ _U(0x14057B7EF767814F)), at))


def text_hash(text):
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def signatures(docs: DataFrame, k: int, threshold: float, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, n, f1, f2, sig, text_hash): set size, 128-bit set fingerprint, signature."""
    chunks, width = plan_signature(threshold)

    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                ptr, v = shingle_sets(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a], k)
                n = np.diff(ptr)
                full = np.flatnonzero(n > 0)
                f1, f2, sig = np.zeros(b - a, _U), np.zeros(b - a, _U), [b""] * (b - a)
                if len(full):
                    at = ptr[full]
                    f1[full], f2[full] = _fingerprints(v, at)
                    for i, s in zip(full, _signature(v, np.append(at, len(v)), chunks * width)):
                        sig[i] = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(f1.view(np.int64)),
                     pa.array(f2.view(np.int64)), pa.array(sig, pa.binary()), batch.column(2).slice(a, b - a)],
                    ["doc_id", "n", "f1", "f2", "sig", "text_hash"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_hash(F.col(text_col)).alias("text_hash"))
    return src.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, sig binary, text_hash long")


def _keys(reps: DataFrame, chunks: int, width: int) -> DataFrame:
    """(key, at, rep): one key for each chunk and left-out symbol, numbered."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rep = batch.column(0)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, chunks, width)
            for c in range(chunks):
                for out in range(width):
                    key = np.full(len(rep), c * width + out + 1, _U)
                    for s in range(width):
                        if s != out:
                            key = mix(key * _U(0x9E3779B97F4A7C15) + sig[:, c, s].astype(_U))
                    at = np.full(len(rep), c * width + out, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(at), rep], ["key", "at", "rep"])
    return reps.select("rep", "sig").mapInArrow(run, "key long, at int, rep long")


def _close(pairs: DataFrame, reps: DataFrame, threshold: float, distance: int) -> DataFrame:
    """Pairs (a, b) within the signature distance and the size ratio."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sa = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            sb = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            ok = (sa != sb).sum(axis=1) <= distance
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))

    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"s_{x}"))
    percent = int(round(threshold * 100))
    both = (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent))
    return both.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _similar(x, y, percent: int) -> bool:
    """Whether two full sorted sets satisfy 100 * intersection >= percent * union."""
    x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
    at = np.searchsorted(x, y)
    both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose full sets satisfy 100 * intersection >= percent * union."""
    percent = int(round(threshold * 100))

    def run(batches):
        for batch in batches:
            ok = [_similar(x.as_buffer(), y.as_buffer(), percent) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda x: sets.select(F.col("rep").alias(x), F.col("set").alias(f"set_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, ids: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(rep, set, n, long): full sorted sets and long signatures of the classes
    ``ids`` (rep, doc_id, n, f1, f2), made where the texts are scanned; texts
    never cross a shuffle."""
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                ptr, v = shingle_sets(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a], k)
                n, longs = np.diff(ptr), [b""] * (b - a)
                full = np.flatnonzero(n > 0)
                f1, f2 = np.zeros(b - a, _U), np.zeros(b - a, _U)
                if len(full):
                    f1[full], f2[full] = _fingerprints(v, ptr[full])
                    for i, x in zip(full, _signature(v, np.append(ptr[full], len(v)), LONG).astype(np.uint8)):
                        longs[i] = x.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([v[i:j].tobytes() for i, j in zip(ptr[:-1], ptr[1:])], pa.binary()),
                     pa.array(n, pa.int64()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(longs, pa.binary())],
                    ["doc_id", "set", "n", "f1", "f2", "long"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kept = possible(src, F.col("doc_id"), ids, F.col("doc_id")).filter("_maybe").select("doc_id", "text")
    return (kept.mapInArrow(run, "doc_id long, set binary, n long, f1 long, f2 long, long binary")
            .join(ids, ["doc_id", *SET_KEY]).select("rep", "set", "n", "long"))


def _block_links(blocks: DataFrame, threshold: float, chunks: int, width: int) -> DataFrame:
    """Links (a, b) between components, found within each (key, i, j) group;
    rows come sorted by group.

    Pairs of different components whose long signatures allow the threshold are
    compared on full sets here, the closest first, and a link merges its two
    components for the rest of the group: what comes out is a forest over the
    group's components, never its pairs.  A pair is compared under the first key
    it shares, not under all of them."""
    percent = int(round(threshold * 100))
    p = 1 - threshold
    most = LONG * p + LONG_SIGMAS * math.sqrt(LONG * p * (1 - p))
    names = ["key", "i", "j", "at", "rep", "comp", "lead", "block", "n", "sig", "long", "set"]

    def first_key(x, ys):
        """Number of the first key that ``x`` shares with each of ``ys``."""
        off = (ys != x).reshape(len(ys), chunks, width)
        wrong = off.sum(axis=2)
        c = (wrong <= 1).argmax(axis=1)
        one = np.arange(len(ys))
        return c * width + np.where(wrong[one, c] == 1, off[one, c].argmax(axis=1), 0)

    def links(g):
        comp, n, block = g["comp"], g["n"], g["block"]
        now, out = comp.copy(), []
        for x in np.flatnonzero(comp != g["lead"]):
            ok = (now != now[x]) & (np.minimum(n, n[x]) * 100 >= np.maximum(n, n[x]) * percent)
            ok &= (block != block[x]) | (g["i"][0] == g["j"][0])
            y = np.flatnonzero(ok)
            y = y[(comp[y] == g["lead"][x]) | (x < y)]
            apart = (g["long"][y] != g["long"][x]).sum(axis=1)
            y, apart = y[apart <= most], apart[apart <= most]
            first = first_key(g["sig"][x], g["sig"][y]) == g["at"][x]
            for z in y[first][np.argsort(apart[first], kind="stable")]:
                if now[z] != now[x] and _similar(g["set"][x], g["set"][z], percent):
                    out.append((comp[x], comp[z]))
                    now[now == now[z]] = now[x]
        return out

    def emit(found):
        if found:
            ab = np.array(found, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            g = {c: batch.column(k).to_numpy(zero_copy_only=False) for k, c in enumerate(names[:-3])}
            g["sig"] = np.frombuffer(b"".join(batch.column(9).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            g["long"] = np.frombuffer(b"".join(batch.column(10).to_pylist()), np.uint8).reshape(batch.num_rows, LONG)
            g["set"] = np.array(batch.column(11).to_pylist(), object)
            if held is not None:
                g = {c: np.concatenate([held[c], g[c]]) for c in names}
            new = (g["key"][1:] != g["key"][:-1]) | (g["i"][1:] != g["i"][:-1]) | (g["j"][1:] != g["j"][:-1])
            cut = np.flatnonzero(new) + 1
            yield from emit([x for s, e in zip(np.append(0, cut[:-1]), cut) for x in links({c: g[c][s:e] for c in names})])
            last = cut[-1] if len(cut) else 0
            held = {c: g[c][last:] for c in names}
        if held is not None:
            yield from emit(links(held))

    return blocks.select(*names).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, threshold: float = 0.8,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) of every row;
    (doc_id, text_hash) names the row where a doc_id has several texts."""
    bounded_batches(docs.sparkSession)
    chunks, width = plan_signature(threshold)
    distance = 2 * chunks - 1
    marks = stored(signatures(docs, k, threshold, id_col, text_col), "op7-marks")
    reps = stored(marks.filter("n > 0 and doc_id is not null").groupBy(SET_KEY)
                  .agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
                  .withColumn("rep", F.col("doc_id")), "op7-reps")
    several = (reps.groupBy("doc_id").agg(F.min(F.struct(*SET_KEY)).alias("main"), F.count(F.lit(1)).alias("size"))
               .filter("size > 1").select("doc_id", "main"))
    if not several.isEmpty():
        other = F.col("main").isNotNull() & (F.struct(*SET_KEY) != F.col("main"))
        reps = stored(reps.join(several, "doc_id", "left").withColumn(
            "rep", F.when(other, F.xxhash64("doc_id", *SET_KEY)).otherwise(F.col("doc_id"))).drop("main"), "op7-reps")
    classes = reps.select("rep", "doc_id", *SET_KEY)
    keys = _keys(reps, chunks, width)
    shared = keys.groupBy("key").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = stored(keys.join(shared.select("key", "first"), "key"), "op7-buckets")
    star = buckets.filter("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    near = stored(_close(star, reps, threshold, distance), "op7-near")
    wanted = stored(classes.join(buckets.select("rep").distinct(), "rep", "left_semi"), "op7-wanted")
    sets = stored(_sets(docs, wanted, k, id_col, text_col), "op7-sets")
    edges = stored(_confirmed(near, sets, threshold), "op7-edges")
    comp = components(edges)
    # round 2: buckets that still hold several components beside their first
    # member, whose pairs are settled
    held = (buckets.filter("rep <> first").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
            .select("key", "at", "rep", F.coalesce("component", "rep").alias("comp")))
    parts = held.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("size"))
    lead = (parts.groupBy("key").agg(F.max(F.struct("size", "comp")).alias("top"), F.count(F.lit(1)).alias("parts"))
            .filter("parts > 1").select("key", F.col("top.comp").alias("lead")))
    unsettled = stored(held.join(lead, "key").join(wanted.select("rep", "n"), "rep"), "op7-unsettled")
    split = unsettled.groupBy("key").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / F.lit(float(BLOCK_ROWS)), F.sum("n") / F.lit(float(BLOCK_SHINGLES)))).cast("int").alias("nb"))
    block = F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int")
    blocks = (unsettled.drop("n").join(split, "key").withColumn("block", block)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
              .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "at", "rep", "comp", "lead", "block").join(sets.join(reps.select("rep", "sig"), "rep"), "rep")
              .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    more = stored(_block_links(blocks, threshold, chunks, width), "op7-links")
    stars = comp.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    comp = components(stars.unionByName(more))
    comp = comp.join(classes, F.col("node") == F.col("rep")).select("rep", "component", F.struct("doc_id", *SET_KEY).alias("own"))
    lead = comp.groupBy("component").agg(F.min("own").alias("lead"))
    linked = comp.join(lead, "component").select("rep", F.col("lead.doc_id").alias("component"), (F.col("own") == F.col("lead")).alias("leads"))
    final = classes.join(linked, "rep", "left").select(
        *SET_KEY, F.coalesce("component", "doc_id").alias("component"), F.coalesce("leads", F.lit(True)).alias("leads"))
    placed = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return (marks.select("doc_id", *SET_KEY, "text_hash").join(final, SET_KEY, "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(placed, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.when(placed, F.col("leads") & (F.col("doc_id") == F.col("component"))).otherwise(True).alias("kept"), "text_hash"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), k=3, threshold=0.85).drop("text_hash")


ORACLE = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents)
, g AS (SELECT DISTINCT doc_id, s FROM (
            SELECT doc_id, array_to_string(w[i:i + 2], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3) t
            UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) IN (1, 2)) u)
, n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)
, pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
           FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2)
, link AS (SELECT x, y FROM pair JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
           WHERE 100 * shared >= 85 * (nx.n + ny.n - shared))
, reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y)
, comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, comp.c AS component_id, d.doc_id = comp.c AS kept
FROM d JOIN comp ON comp.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
