"""Substring dedup with fixed-block anchors.

Every document is cut into non-overlapping reference blocks of ``block``
words (its anchors).  A window of ``window`` words contains an aligned block
of each document that holds it when ``2 * block - 1 <= window``, so probing
the anchor index with every rolling block finds every repeated window.

1. *Probe.*  Each task hashes the rolling blocks of its documents, settles
   what it can see itself, and sends the rest, packed, to the bucket of the
   block hash.  A block found in several documents of one task and anchored
   there is settled locally and sent once, so a passage that a third of all
   rows share costs one entry a task, not one a row.
2. *Hits.*  A bucket reports the positions whose block is an anchor and
   occurs in at least two documents.
3. *Extend.*  A hit is extended to the windows around it: their whole word
   sequences are hashed (96 bits) and matched; again a task settles its own
   repeats first and sends one entry a window with its smallest doc_id.
   Neighbouring matched windows merge into maximal exact repeats.
4. *Remove.*  A word goes if some window over it also starts in a document
   with a smaller doc_id.

In a bucket, 32 bits of hash are enough for step 2 because buckets hold a
bounded number of entries at any input size and a false hit only adds
windows that step 3 rejects.  Buckets follow the input size; a task's entries
travel as one row per bucket, so rows hold fewer entries as buckets multiply
(``CHUNK_BYTES`` may rise with them where executors have the memory).

Defined cases: null text has no words; a null doc_id neither removes nor
loses words; rows that repeat a doc_id are told apart by their text and never
remove words from each other; texts under ``window`` words stay whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import documents, text_bytes
from lodestar.llm.textnum import doc_chunks, inside, mix, span_hashes, text_buffer, windows, words

WINDOW, BLOCK = 13, 7
CHUNK_BYTES = 6 << 20          # text hashed together in a task
BUCKET_BYTES = 8 << 20         # text whose entries share a bucket
_U = np.uint64
_SALT = _U(0xA24BAED4963EE407)
KEY = np.dtype([("a", "<u8"), ("b", "<u4")])      # 96 bits of a window


def _tags(buf, offs) -> np.ndarray:
    """32 bits of each text, to tell rows with the same doc_id apart."""
    out, full = np.zeros(len(offs) - 1, _U), np.flatnonzero(np.diff(offs) > 0)
    out[full] = span_hashes(buf, offs[:-1][full], offs[1:][full])
    return (out >> _U(33)).astype(np.int64)


def _groups(key: np.ndarray):
    """(order, group of each ordered entry, starts) of equal keys."""
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def _split(target: np.ndarray, parts: int):
    """(part, entries of the part in input order) for each part that has any."""
    order = np.argsort(target, kind="stable")
    cut = np.searchsorted(target[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cut)):
        yield int(p), order[cut[p]:cut[p + 1]]


def _part_of_doc(ids: np.ndarray, parts: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(_U)) % _U(parts)).astype(np.int64)


_ZSTD: list = []


def _squeeze(a: np.ndarray) -> bytes:
    """Bytes of an array, by byte planes, through zstandard."""
    if not _ZSTD:
        _ZSTD.extend([zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()])
    a = np.ascontiguousarray(a)
    return _ZSTD[0].compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _spread(raw: bytes, kind) -> np.ndarray:
    if not _ZSTD:
        _squeeze(np.zeros(0, np.uint8))
    planes = np.frombuffer(_ZSTD[1].decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).reshape(-1).view(kind)


COLUMNS = ["part", "docs", "tags", "counts", "pos", "key", "flags"]
PACKED = "part int, " + ", ".join(f"{c} binary" for c in COLUMNS[1:])


def _pack(part: int, ids, tags, doc, pos, key, flag, several) -> dict:
    """Entries (sorted by document and position) as one row: a document table
    with entry counts, then position steps, keys and two flags an entry."""
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    d = doc[first]
    step = pos.astype(np.int64)
    step[1:] = np.where(new[1:], step[1:], step[1:] - step[:-1])
    return {"part": part, "docs": _squeeze(np.diff(ids[d], prepend=0)), "tags": tags[d].astype(np.uint32).tobytes(),
            "counts": _squeeze(np.diff(np.append(first, len(doc))).astype(np.uint32)), "pos": _squeeze(step.astype(np.uint32)),
            "key": key.tobytes(), "flags": _squeeze(np.packbits(np.concatenate([flag, several])))}


def _unpack(rows: pd.DataFrame, key_type):
    """(ids, tags, pos, key, flag, several) of all entries in ``rows``."""
    out = []
    for r in rows.itertuples(index=False):
        n, step = _spread(r.counts, np.uint32).astype(np.int64), _spread(r.pos, np.uint32).astype(np.int64)
        run = np.cumsum(step)
        first = np.cumsum(n) - n
        flags = np.unpackbits(_spread(r.flags, np.uint8), count=2 * len(step)).astype(bool)
        out.append((np.repeat(np.cumsum(_spread(r.docs, np.int64)), n), np.repeat(np.frombuffer(r.tags, np.uint32), n),
                    run - np.repeat(run[first] - step[first], n), np.frombuffer(r.key, key_type), flags[:len(step)], flags[len(step):]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _batch(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("part", pa.int32())] + [(c, pa.binary()) for c in COLUMNS[1:]])
    return pa.RecordBatch.from_pylist(rows, schema)


def _probe(window: int, block: int, buckets: int, parts: int):
    """Rolling blocks to buckets (part >= 0) and local hits (part < 0: the
    document part -1 - part)."""
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            ids_all = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                part_buf, part_offs, ids = buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a], ids_all[a:b]
                _, _, h, ptr = words(part_buf, part_offs)
                pos, row = inside(ptr, block)
                long = (np.diff(ptr) >= window)[row]
                pos, row = pos[long], row[long]
                if not len(pos):
                    continue
                tags = _tags(part_buf, part_offs)
                key, at = windows(h, block)[pos], pos - ptr[row]
                anchor = at % block == 0
                order, group, starts = _groups(key)
                r = ids[row][order]
                several = (np.maximum.reduceat(r, starts) != np.minimum.reduceat(r, starts))
                anchored = np.logical_or.reduceat(anchor[order], starts)
                settled = np.zeros(len(key), bool)
                settled[order] = (several & anchored)[group]
                leader = np.zeros(len(key), bool)
                leader[order[starts[several & anchored]]] = True
                send = np.flatnonzero(~settled | leader)
                flag = anchor | leader            # is an anchor somewhere; a leader also stands for several documents
                out = []
                target = ((key[send] >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
                low = key.astype(np.uint32)
                for p, e in _split(target, buckets):
                    e = send[e]
                    out.append(_pack(p, ids, tags, row[e], at[e], low[e], flag[e], leader[e]))
                hit = np.flatnonzero(settled)
                for p, e in _split(_part_of_doc(ids[row[hit]], parts), parts):
                    e = hit[e]
                    out.append(_pack(-1 - p, ids, tags, row[e], at[e], low[:0], flag[e], leader[e]))
                yield _batch(out)
    return run


def _passed(pdf: pd.DataFrame) -> pd.DataFrame | None:
    """Rows a task settled itself (part < 0), addressed to their documents."""
    if pdf["part"].iat[0] >= 0:
        return None
    return pdf.assign(part=-1 - pdf["part"])[COLUMNS]


def _bucket_hits(parts: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if (own := _passed(pdf)) is not None:
            return own
        ids, tags, pos, key, flag, several = _unpack(pdf, np.uint32)
        order, group, starts = _groups(key)
        r = ids[order]
        several = (np.maximum.reduceat(r, starts) != np.minimum.reduceat(r, starts)) | np.logical_or.reduceat(several[order], starts)
        good = several & np.logical_or.reduceat(flag[order], starts)
        hit = np.sort(order[good[group]])
        return pd.DataFrame(_route(ids[hit], tags[hit], pos[hit], parts), columns=COLUMNS)
    return run


def _route(ids, tags, at, parts) -> list[dict]:
    """Positions to the parts of their documents."""
    out, order = [], np.lexsort((at, tags, ids))
    ids, tags, at = ids[order], tags[order], at[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
    doc, first = np.cumsum(new) - 1, np.flatnonzero(new)
    for p, e in _split(_part_of_doc(ids, parts), parts):
        none = np.zeros(len(e), bool)
        out.append(_pack(p, ids[first], tags[first], doc[e], at[e], np.zeros(0, np.uint32), none, none))
    return out


def _positions(pdf: pd.DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Positions by (doc_id, tag)."""
    if not len(pdf):
        return {}
    ids, tags, pos = _unpack(pdf, np.uint32)[:3]
    order = np.lexsort((pos, tags, ids))
    ids, tags, pos = ids[order], tags[order], pos[order]
    cut = np.flatnonzero((np.diff(ids) != 0) | (np.diff(tags.astype(np.int64)) != 0)) + 1
    return {(int(ids[s]), int(tags[s])): pos[s:e] for s, e in zip(np.append(0, cut), np.append(cut, len(ids)))}


def _extend(window: int, block: int, buckets: int, parts: int):
    """Windows around hits to buckets; windows settled in the task as covered."""
    def run(hits: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        found = _positions(hits)
        out: list[dict] = []
        for ids, known, buf, offs in _texts(docs) if found else ():
            tags = _tags(buf, offs)
            _, _, h, ptr = words(buf, offs)
            near = np.zeros(len(h) + 1, np.int32)
            for i in np.flatnonzero(known):
                at = found.get((int(ids[i]), int(tags[i])))
                if at is not None:          # the window starts that contain the hit
                    np.add.at(near, ptr[i] + np.maximum(at - (window - block), 0), 1)
                    np.add.at(near, ptr[i] + at + 1, -1)
            pos, row = inside(ptr, window)
            cand = np.cumsum(near[:-1])[pos] > 0
            pos, row = pos[cand], row[cand]
            if not len(pos):
                continue
            k1 = windows(h, window)[pos]
            k2 = (windows(mix(h ^ _SALT), window)[pos] >> _U(32)).astype(np.uint32)
            at, r = pos - ptr[row], ids[row]
            order, group, starts = _equal(k1, k2, r)
            covered = np.zeros(len(pos), bool)
            covered[order] = r[order] > r[order[starts]][group]
            hit = np.flatnonzero(covered)
            out += [x | {"part": -1 - x["part"]} for x in
                    _route(r[hit], tags[row[hit]].astype(np.uint32), at[hit], parts)]
            send = np.flatnonzero(~covered)
            target = ((k1[send] >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
            key = np.empty(len(k1), KEY)
            key["a"], key["b"] = k1, k2
            for p, e in _split(target, buckets):
                e, none = send[e], np.zeros(len(e), bool)
                out.append(_pack(p, ids, tags, row[e], at[e], key[e], none, none))
        return pd.DataFrame(out, columns=COLUMNS)
    return run


def _equal(k1, k2, ids):
    """(order, group of each ordered entry, starts) of equal 96-bit keys, each
    group by ascending doc_id."""
    order = np.lexsort((ids, k2, k1))
    new = np.ones(len(order), bool)
    new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def _bucket_covered(parts: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if (own := _passed(pdf)) is not None:
            return own
        ids, tags, pos, key, _, _ = _unpack(pdf, KEY)
        order, group, starts = _equal(key["a"], key["b"], ids)
        least = ids[order[starts]][group]
        hit = order[ids[order] > least]
        return pd.DataFrame(_route(ids[hit], tags[hit], pos[hit], parts), columns=COLUMNS)
    return run


RESULT = "doc_id long, known boolean, n_words long, n_removed long, kept_text string"


def _remove(window: int):
    def run(covered: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        found, rows = _positions(covered), []
        for ids, known, buf, offs in _texts(docs):
            tags, raw = _tags(buf, offs), buf.tobytes()
            for i in range(len(ids)):
                w = raw[offs[i]:offs[i + 1]].split()
                at = found.get((int(ids[i]), int(tags[i]))) if known[i] else None
                keep = w
                if at is not None:
                    gone = np.zeros(len(w) + 1, np.int32)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                    keep = [x for x, g in zip(w, np.cumsum(gone[:-1])) if not g]
                rows.append((ids[i], known[i], len(w), len(w) - len(keep), b" ".join(keep).decode()))
        return pd.DataFrame(rows, columns=["doc_id", "known", "n_words", "n_removed", "kept_text"])
    return run


DEALT = "part int, ids binary, known binary, sizes binary, text binary"


def _deal(parts: int):
    """Documents to parts: one compressed row per part and chunk of a task."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            buf, offs = text_buffer(batch.column(2))
            ids, known = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                rows = []
                for p, e in _split(_part_of_doc(ids[a:b], parts), parts):
                    e = e + a
                    rows.append({"part": p, "ids": _squeeze(ids[e].astype(np.int64)), "known": _squeeze(known[e].astype(np.uint8)),
                                 "sizes": _squeeze(offs[e + 1] - offs[e]),
                                 "text": packer.compress(b"".join(buf[offs[i]:offs[i + 1]].tobytes() for i in e))})
                yield pa.RecordBatch.from_pylist(rows, pa.schema(
                    [("part", pa.int32())] + [(c, pa.binary()) for c in ("ids", "known", "sizes", "text")]))
    return run


def _texts(docs: pd.DataFrame):
    """(ids, known, buffer, offsets) of the dealt rows, joined up to about two
    chunks of text, so that work is done on long arrays."""
    unpack, held, size = zstandard.ZstdDecompressor(), [], 0

    def joined():
        ids, known, sizes, text = zip(*held)
        return (np.concatenate(ids), np.concatenate(known), np.frombuffer(b"".join(text), np.uint8),
                np.append(0, np.cumsum(np.concatenate(sizes))))

    for r in docs.itertuples(index=False):
        held.append((_spread(r.ids, np.int64), _spread(r.known, np.uint8).astype(bool), _spread(r.sizes, np.int64),
                     unpack.decompress(r.text)))
        size += len(held[-1][3])
        if size >= 2 * CHUNK_BYTES:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def remove_repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row."""
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole aligned block: 2 * block - 1 <= window")
    buckets = parts = max(8, -(-text_bytes(docs, text_col) // BUCKET_BYTES))
    key = F.col(id_col).cast("long")
    base = docs.select(F.coalesce(key, F.lit(0)).alias("doc_id"), key.isNotNull().alias("known"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sent = base.filter("known").select("doc_id", "text").mapInArrow(_probe(window, block, buckets, parts), PACKED)
    hits = sent.groupBy("part").applyInPandas(_bucket_hits(parts), PACKED)
    # documents dealt to parts once; both steps below read the same exchange
    dealt = base.mapInArrow(_deal(parts), DEALT).groupBy("part")
    matched = hits.groupBy("part").cogroup(dealt).applyInPandas(_extend(window, block, buckets, parts), PACKED)
    covered = matched.groupBy("part").applyInPandas(_bucket_covered(parts), PACKED)
    return (covered.groupBy("part").cogroup(dealt).applyInPandas(_remove(window), RESULT)
            .select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "n_words", "n_removed", "kept_text"))


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
, win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13) t)
, first AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g)
, gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (
              SELECT win.doc_id, unnest(range(win.i, win.i + 13)) AS p
              FROM win JOIN first ON win.g = first.g AND first.m < win.doc_id) t GROUP BY doc_id)
, word AS (SELECT d.doc_id, d.w[i] AS x, i, list_contains(coalesce(ps, []), i) AS cut
           FROM (SELECT d.doc_id, d.w, gone.ps, unnest(range(1, len(d.w) + 1)) AS i
                 FROM d LEFT JOIN gone ON gone.doc_id = d.doc_id) d)
, kept AS (SELECT doc_id, count(*) FILTER (WHERE cut) AS n, string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT cut) AS t
           FROM word GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
