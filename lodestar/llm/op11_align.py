"""Cross-tokenizer alignment on Arrow tables.

Every text is encoded by a byte-level tokenizer (A) and a piece tokenizer (B).
In a task, a chunk's tokens are flat Arrow arrays: ``list_flatten`` and
``list_parent_indices`` give ids and their rows, token byte lengths are summed
up per row (a cumulative sum less its value at the row's start), and an Acero
hash join on (row, byte end) finds the offsets where tokens of both end.
Each match is a link, and the matches cut the tokens into groups.

``Table.group_by`` counts the chunk's links per id pair; Spark adds the
partial counts of all chunks, marks the pairs with the highest count of
their B id, and sends each chunk's distinct pairs their count and mark.  A chunk
holds a pair once, so a pair has as many rows as there are chunks at most, and
no link and no text is shuffled.

Both tokenizers encode a chunk's distinct segments once (``segments``): A's
pre-tokenizer always cuts before white space that follows something else and
between ASCII letters and punctuation (not after an apostrophe), and no piece
of B holds certain bytes side by side.  Texts with other white space or
control characters go through both libraries whole.

Defined cases: null and empty texts, and texts whose joined token bytes differ
from space + text in A or B (U+2581, for one), have no tokens: zeros and an
empty digest; a text's rows are aligned each, repeated or not; links count in
every row; equal counts of a B id are all its highest; a null doc_id stays
null; a text is aligned in one task whatever its length, in memory in proportion
to it; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, documents, stored
from lodestar.llm.segments import SegmentEncoder
from lodestar.llm.textnum import IS_SPACE, doc_chunks, text_buffer

CHUNK_BYTES = 2 << 20
BAD = np.uint32(0xFFFFFFFF)            # in place of ids whose bytes differ from the segment
# texts for the libraries as a whole: white space and controls that the cuts don't know
_RARE = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f]|\xc2[\x80-\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81[\x9f-\xaf]|\xe3\x80\x80|\xef\xbb\xbf|\xef\xbf")


def _byte_of() -> dict[str, int]:
    """The byte that each character of the byte-level alphabet stands for:
    printable ones stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """Ids of tokenizer A and the byte length of each."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        byte = _byte_of()
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.raw = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.raw[i] = bytes(byte[c] for c in token)
        self.length = np.array([len(r) for r in self.raw], np.int64)
        self.segments = SegmentEncoder(self._joined(), self._encode)

    @staticmethod
    def _joined() -> np.ndarray:
        """Byte pairs that a token may hold side by side."""
        kind = np.zeros(256, np.uint8)                  # 0: never cut beside it
        kind[33:127] = 1                                # punctuation
        kind[48:58] = 2
        kind[65:91] = kind[97:123] = 3
        space = np.zeros(256, bool)
        space[np.flatnonzero(IS_SPACE)] = True
        a, b = np.repeat(np.arange(256), 256), np.tile(np.arange(256), 256)
        split = (kind[a] != kind[b]) & (kind[a] > 0) & (kind[b] > 0) & (a != ord("'"))
        return ~(split | ~space[a] & space[b])

    def _encode(self, parts: list[bytes]) -> list[list[int]]:
        return _checked(parts, [e.ids for e in self.tok.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)], self.raw)

    def whole(self, text: bytes) -> list[int]:
        return self._encode([text])[0]


class PieceTokens:
    """Ids of tokenizer B (which puts a space before a text) and their byte lengths."""

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.raw, pieces = [], []
        for i in range(self.sp.get_piece_size()):
            piece = self.sp.id_to_piece(i)
            if self.sp.is_byte(i):
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.raw.append(piece.replace("▁", " ").encode())
                pieces.append(self.raw[-1])
        self.length = np.array([len(r) for r in self.raw], np.int64)
        joined = np.zeros(65536, bool)
        for piece in pieces:
            b = np.frombuffer(piece, np.uint8)
            joined[(b[:-1].astype(np.uint16) << 8) | b[1:]] = True
        pair = joined.reshape(256, 256)
        pair[:, 0x80:0xC0] = True                       # never inside a character
        # a segment without a leading space is encoded behind a byte that joins with nothing
        free = [b for b in range(1, 128) if not pair[b].any() or not pair[b, :128].any() and not pair[b, 0xC0:].any()]
        self.guard = next((bytes([b]) for b in free if not pair[32, b] and b != 32), None)
        if self.guard is None:
            raise ValueError("the model joins every byte with another")
        self.guard_ids = len(self.sp.encode(self.guard.decode()))
        self.segments = SegmentEncoder(joined, self._encode)

    def _encode(self, parts: list[bytes]) -> list[list[int]]:
        own = [p.startswith(b" ") for p in parts]
        texts = [p[1:].decode() if o else (self.guard + p).decode() for p, o in zip(parts, own)]
        ids = self.sp.encode(texts, num_threads=1)
        return _checked(parts, [(i if i or not o else self._space()) if o else i[self.guard_ids:] for i, o in zip(ids, own)], self.raw)

    def _space(self) -> list[int]:
        return self.sp.encode(self.guard.decode())[:1]

    def whole(self, text: bytes) -> list[int]:
        return _checked([text], [self.sp.encode(text[1:].decode(), num_threads=1)], self.raw)[0]


def _checked(parts, ids, raw):
    """The ids, or ``BAD`` where their bytes aren't the part's."""
    return [i if b"".join([raw[x] for x in i]) == p else [BAD] for p, i in zip(parts, ids)]


_TOKENS: dict[tuple, object] = {}


def tokens(kind: type, path: str):
    if (kind, path) not in _TOKENS:
        _TOKENS[kind, path] = kind(path)
    return _TOKENS[kind, path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encode_rows(t, buf: np.ndarray, offs: np.ndarray):
    """(ids, ptr) of all rows; rows with rare characters by the library whole."""
    ids, ptr = t.segments(buf, offs)
    raw = buf.tobytes()
    rare = sorted({int(np.searchsorted(offs, m.start(), side="right")) - 1 for m in _RARE.finditer(raw)})
    if not rare:
        return ids, ptr
    rows = np.split(ids, ptr[1:-1])
    for i in rare:
        rows[i] = np.array(t.whole(raw[offs[i]:offs[i + 1]]), np.uint32)
    size = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=size[1:])
    return np.concatenate(rows), size


def token_table(ids: np.ndarray, ptr: np.ndarray, length: np.ndarray, name: str) -> pa.Table:
    """(row, end, name): each token's row, the byte where it ends in it, and its id."""
    lists = pa.LargeListArray.from_arrays(pa.array(ptr, pa.int64()), pa.array(ids, pa.uint32()))
    flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    size = pc.take(pa.array(length), flat)
    upto = pc.cumulative_sum(size)
    before = np.append(0, upto.to_numpy())[ptr[:-1]]
    end = pc.subtract(upto, pc.take(pa.array(before), row))
    return pa.table({"row": row, "end": end, name: flat})


def align(a: pa.Table, b: pa.Table) -> pa.Table:
    """(row, end, a, b): the links, in order."""
    found = a.join(b, ["row", "end"], join_type="inner", use_threads=False)
    return found.sort_by([("row", "ascending"), ("end", "ascending")])


def _sides(t: pa.Table, name: str, key: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Each group's ids of one tokenizer as text, joined by commas."""
    last = np.searchsorted(key, cuts, side="right")
    ids = pc.cast(t[name].combine_chunks(), pa.string())
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, last), pa.int32()), ids), ",")


def group_digests(a: pa.Table, b: pa.Table, links: pa.Table, n_rows: int):
    """(n_groups, digest) of every row."""
    def key(t):
        return (t["row"].to_numpy() << 40) | t["end"].to_numpy()

    cuts = key(links)                          # ascending
    cuts = cuts[np.append(True, cuts[1:] != cuts[:-1])] if len(cuts) else cuts
    row = cuts >> 40
    text = pc.binary_join_element_wise(_sides(a, "a", key(a), cuts), _sides(b, "b", key(b), cuts), "|")
    ptr = np.searchsorted(row, np.arange(n_rows + 1))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), text), ";").cast(pa.binary())
    n = np.diff(ptr)
    return n, ["" if not k else hashlib.sha256(x.as_buffer()).hexdigest() for k, x in zip(n, joined)]


CHUNK_DDL = ("part int, seq int, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
             "n_links array<long>, digest array<string>, links binary, pairs array<long>, counts array<long>")


def _chunk(ids: pa.Array, buf, offs, ta, tb, part: int, seq: int) -> pa.RecordBatch:
    n = len(offs) - 1
    (ia, qa), (ib, qb) = encode_rows(ta, buf, offs), encode_rows(tb, buf, offs)
    good = np.ones(n, bool)
    for x, ptr in ((ia, qa), (ib, qb)):
        good[np.searchsorted(ptr, np.flatnonzero(x == BAD), side="right") - 1] = False
    (ia, qa), (ib, qb) = _only(ia, qa, good), _only(ib, qb, good)
    a, b = token_table(ia, qa, ta.length, "a"), token_table(ib, qb, tb.length, "b")
    links = align(a, b)
    n_groups, digest = group_digests(a, b, links, n)
    pair = pc.add(pc.shift_left(links["a"].cast(pa.int64()), 32), links["b"].cast(pa.int64()))
    counted = pa.table({"pair": pair, "row": links["row"]}).group_by("pair", use_threads=False).aggregate([("row", "count")])
    at = pc.index_in(pair, value_set=counted["pair"].combine_chunks())
    n_links = np.bincount(links["row"].to_numpy(), minlength=n)
    one = lambda x, kind: pa.array([x], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
         one(np.diff(qa), pa.int64()), one(np.diff(qb), pa.int64()), one(n_groups, pa.int64()), one(n_links, pa.int64()),
         one(digest, pa.string()), pa.array([zstandard.compress(at.to_numpy().astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)], pa.binary()),
         one(counted["pair"].to_numpy(), pa.int64()), one(counted["row_count"].to_numpy(), pa.int64())],
        [c.split()[0] for c in CHUNK_DDL.split(", ")])


def _only(ids: np.ndarray, ptr: np.ndarray, good: np.ndarray):
    """The ragged rows, those not ``good`` empty."""
    size = np.diff(ptr)
    keep = np.repeat(good, size)
    return ids[keep], np.append(0, np.cumsum(np.where(good, size, 0)))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a chunk of documents: their counts and digests, the links as
    indices into the chunk's distinct pairs, and those pairs' counts."""
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ta, tb = tokens(ByteTokens, path_a), tokens(PieceTokens, path_b)
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                yield _chunk(batch.column(0).slice(a, b - a), buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a], ta, tb, part, seq)
                seq += 1
                pa.default_memory_pool().release_unused()

    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.when(text == "", text).otherwise(F.concat(F.lit(" "), text)).alias("text"))
    return src.mapInArrow(run, CHUNK_DDL)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, count, best): the corpus's links of each id pair, and whether no
    pair of its B id has more."""
    total = (chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
             .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("count")))
    total = stored(total, "op11-pairs").withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    top = total.groupBy("b").agg(F.max("count").alias("top"))
    return total.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def _finish(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            r = {c: batch.column(c)[i].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "digest", "found")}
            pos, n_links = r["found"].field("pos").to_numpy(), r["n_links"].to_numpy()
            packed = np.frombuffer(zstandard.decompress(batch.column("links")[i].as_py()), np.uint8)
            link = np.ascontiguousarray(packed.reshape(4, -1).T).view("<u4").ravel()       # planes of bytes
            row = np.repeat(np.arange(len(n_links)), n_links)
            sums = []
            for name in ("best", "count"):
                of = np.zeros(len(pos), np.int64)
                of[pos] = r["found"].field(name).to_numpy(zero_copy_only=False)
                out = np.zeros(len(n_links), np.int64)
                np.add.at(out, row, of[link])
                sums.append(out)
            yield pa.RecordBatch.from_arrays(
                [*(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *map(pa.array, sums), r["digest"]],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


OUT_DDL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    chunks = stored(aligned(docs, path_a, path_b, id_col, text_col), "op11-chunks")
    marks = stored(pair_counts(chunks), "op11-marks")
    found = (chunks.select("part", "seq", F.posexplode("pairs").alias("pos", "pair")).join(marks, "pair")
             .groupBy("part", "seq").agg(F.collect_list(F.struct("pos", "count", "best")).alias("found")))
    rows = chunks.drop("pairs", "counts").join(found, ["part", "seq"], "left").withColumn(
        "found", F.coalesce("found", F.array().cast(found.schema["found"].dataType)))
    return rows.mapInArrow(_finish, OUT_DDL)


def query(spark, sf_dir: str) -> DataFrame:
    return alignment(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
