"""Token ids in a binary shard format with one shared zstandard dictionary.

Format (one folder):

* ``dictionary``: one row (dict_hash, dict_bytes, id_bytes, end_id).  The
  dictionary is trained on serialized id arrays of a bounded sample
  (about ``SAMPLE_DOCS`` documents, drawn by a hash; those over
  ``SAMPLE_BYTES`` are left out); its hash is the SHA-256 of its bytes.
* ``shards``: one row per shard, in ascending doc_id order of (part, seq):
  first_id, last_id, n_docs, n_tokens, dict_hash, index, payload.  The payload
  holds one zstandard frame per document; the index holds per document
  the doc_id (int64), the end of its frame (uint64), its id count
  (uint64) and whether its doc_id is known (uint8).  A single short document
  is read by its shard's id range, its index entry and its one frame.

Ids are stored as unsigned little-endian 16 bits when the vocabulary allows
it, else 32.  Spark writes the folder, so a lost executor's shards are
written again and only committed files are seen.

Documents are range-partitioned and sorted by doc_id (null first, equal ids
by text hash); a part streams through one task, one shard in memory at a
time.  Starts are the sums of the parts before, the shards before in the
part, and the documents before in the shard; only one row per part meets in
one place.

Encoding calls the tokenizers library on distinct segments.  The
pre-tokenizer separates letters, single digits and other characters and
drops white space, so a cut between two different ASCII classes never falls
inside one of its pieces (an apostrophe and any other byte never get a cut).
Texts that hold a special token's spelling go to the library whole.

Defined cases: null and empty texts hold the end id alone; repeated rows are
stored each; an empty table gives an empty folder and result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestar.llm.common import documents, text_bytes
from lodestar.llm.segments import SegmentEncoder
from lodestar.llm.textnum import IS_SPACE, LOWER, doc_chunks, text_buffer
from lodestar.session import shared_dir

END_ID = 2
SAMPLE_DOCS, SAMPLE_BYTES, DICT_BYTES = 1000, 64 << 10, 64 << 10
CHUNK_BYTES = 4 << 20
STORED, JOINED = 1_500_000, 512  # segments remembered per worker (some 40 MB), segments to one call of the tokenizer
SHARD_BYTES = 4 << 20
PART_BYTES = 32 << 20
LEVEL = 1


def _joined() -> np.ndarray:
    """Byte pairs that may belong to one piece of the pre-tokenizer."""
    kind = np.zeros(256, np.uint8)                     # 0: never cut beside it
    kind[33:127] = 3
    kind[48:58] = 2
    kind[97:123] = 1
    kind[65:91] = 1
    kind[ord("'")] = 0
    kind[np.flatnonzero(IS_SPACE)] = 4
    a, b = np.repeat(kind, 256), np.tile(kind, 256)
    split = ((a != b) | (a == 2)) & (a > 0) & (b > 0) | (a == 4) & (b != 4) | (b == 4) & (a != 4)
    return ~split


class WordEncoder:
    """Ids of whole texts by the tokenizers library (a file of public_tokenizers)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.segments = SegmentEncoder(_joined(), self._encode, drop=IS_SPACE, fold=LOWER, most=STORED)

    def _encode(self, parts: list[bytes]) -> list[list[int]]:
        """Ids of every segment.  White space parts pieces and has no ids, so many
        segments go to the library as one text, and an id belongs to the segment
        in which its characters begin."""
        texts = [p.decode() for p in parts]
        groups = [texts[i:i + JOINED] for i in range(0, len(texts), JOINED)]
        out = []
        for group, got in zip(groups, self.tok.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            ends = np.cumsum([len(t) + 1 for t in group])
            cuts = np.searchsorted([a for a, _ in got.offsets], ends).tolist()
            ids = got.ids
            out += [ids[a:b] for a, b in zip([0, *cuts], cuts)]
        return out

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        ids, ptr = self.segments(buf, offs)
        out = [ids[a:b] for a, b in zip(ptr[:-1], ptr[1:])]
        raw = buf.tobytes()
        for special in self.special:
            at = raw.find(special)
            while at >= 0:
                i = int(np.searchsorted(offs, at, side="right")) - 1
                text = raw[offs[i]:offs[i + 1]].decode()
                out[i] = np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)
                at = raw.find(special, at + 1)
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _id_type(path: str) -> type:
    from tokenizers import Tokenizer
    return np.uint16 if Tokenizer.from_file(path).get_vocab_size() <= 65536 else np.uint32


def train_dictionary(docs: DataFrame, path: str, kind: type, end_id: int) -> bytes:
    """Dictionary bytes (empty when the sample is too small to train on)."""
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column(0))
            ids = encoder(path)(buf, offs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.append(i, end_id).astype(kind).tobytes() for i in ids], pa.binary())], ["ids"])

    # drawn by a hash against the number of rows: no sort, no texts gathered in one task
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = docs.filter((F.octet_length("text") <= SAMPLE_BYTES) & (share * docs.count() < SAMPLE_DOCS)).select("text")
    ids = [r.ids for r in sample.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, ids).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_ids(docs: DataFrame, out: str, path: str, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the folder ``out``."""
    spark, kind = docs.sparkSession, _id_type(path)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    raw = train_dictionary(base, path, kind, end_id)
    dict_hash = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(raw), kind().itemsize, end_id)],
                          "dict_hash string, dict_bytes binary, id_bytes int, end_id int").coalesce(1).write.parquet(f"{out}/dictionary")
    shared = spark.sparkContext.broadcast(raw)      # at most DICT_BYTES

    def run(batches):
        part = TaskContext.get().partitionId()
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value))
        seq, ids, known, counts, frames, size = 0, [], [], [], [], 0

        def shard():
            ends = np.cumsum([len(f) for f in frames])
            index = b"".join([np.array(ids, "<i8").tobytes(), ends.astype("<u8").tobytes(),
                              np.array(counts, "<u8").tobytes(), np.array(known, np.uint8).tobytes()])
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "first_id": ids[0], "last_id": ids[-1], "n_docs": len(ids),
                "n_tokens": int(sum(counts)), "dict_hash": dict_hash, "index": index, "payload": b"".join(frames)}], _schema())

        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            keys = batch.column(0)
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                for i, got in enumerate(encoder(path)(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]), a):
                    frame = packer.compress(np.append(got, end_id).astype(kind).tobytes())
                    if frames and size + len(frame) > SHARD_BYTES:
                        yield shard()
                        seq, ids, known, counts, frames, size = seq + 1, [], [], [], [], 0
                    key = keys[i].as_py()
                    ids.append(key or 0)
                    known.append(key is not None)
                    counts.append(len(got) + 1)
                    frames.append(frame)
                    size += len(frame)
        if frames:
            yield shard()

    parts = max(1, -(-text_bytes(base) // PART_BYTES))
    (base.repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
     .mapInArrow(run, SHARD_DDL).write.option("compression", "none").parquet(f"{out}/shards"))


SHARD_DDL = ("part int, seq int, first_id long, last_id long, n_docs long, n_tokens long, "
             "dict_hash string, index binary, payload binary")


def _schema() -> pa.Schema:
    of = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(x.split()[0], of[x.split()[1]]) for x in SHARD_DDL.split(", ")])


def _dictionary_row(spark: SparkSession, out: str):
    return spark.read.parquet(f"{out}/dictionary").first()


def _entries(index: bytes, n: int):
    a = np.frombuffer(index, "<i8", n)
    ends = np.frombuffer(index, "<u8", n, 8 * n).astype(np.int64)
    counts = np.frombuffer(index, "<u8", n, 16 * n).astype(np.int64)
    return a, ends, counts, np.frombuffer(index, np.uint8, n, 24 * n).astype(bool)


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the folder."""
    head = _dictionary_row(spark, out)
    raw, kind, dict_hash = spark.sparkContext.broadcast(bytes(head.dict_bytes)), f"<u{head.id_bytes}", head.dict_hash
    shards = spark.read.schema(SHARD_DDL).parquet(f"{out}/shards")
    sizes = shards.select("part", "seq", "n_tokens")
    parts = (sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before_part")))
    starts = (sizes.withColumn("before", F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq")) - F.col("n_tokens"))
              .join(parts, "part").select("part", "seq", (F.col("before") + F.col("before_part")).alias("start")))

    def run(batches):
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(raw.value))
        for batch in batches:
            for r in batch.to_pylist():
                if r["dict_hash"] != dict_hash:
                    raise ValueError("a shard was written with another dictionary")
                ids, ends, counts, known = _entries(r["index"], r["n_docs"])
                begin = np.append(0, ends[:-1])
                crc = []
                for a, b, n in zip(begin, ends, counts):
                    got = np.frombuffer(unpack.decompress(r["payload"][a:b]), kind)
                    if len(got) != n:
                        raise ValueError("a frame does not hold the ids its index states")
                    crc.append(zlib.crc32(got.astype("<u4").tobytes()))
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, r["part"], np.int32)), pa.array(np.full(n, r["seq"], np.int32)),
                     pa.array(ids, pa.int64(), mask=~known), pa.array(np.cumsum(counts) - counts),
                     pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"])

    # decoded where the shard is read: only narrow rows meet the starts
    rows = shards.select("part", "seq", "n_docs", "dict_hash", "index", "payload").mapInArrow(
        run, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, out: str, doc_id: int) -> list[int] | None:
    """Ids of one document: one index lookup and one frame."""
    head = _dictionary_row(spark, out)
    found = (spark.read.schema(SHARD_DDL).parquet(f"{out}/shards")
             .filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).orderBy("part", "seq"))
    for r in found.toLocalIterator():
        ids, ends, _, known = _entries(bytes(r["index"]), r.n_docs)
        at = np.flatnonzero((ids == doc_id) & known)
        if len(at):
            i = int(at[0])
            unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(bytes(head.dict_bytes)))
            frame = bytes(r.payload[0 if i == 0 else int(ends[i - 1]):int(ends[i])])
            return np.frombuffer(unpack.decompress(frame), f"<u{head.id_bytes}").tolist()
    return None


def query(spark, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, f"op3-ids-{uuid.uuid4().hex[:12]}")
    write_ids(documents(spark, sf_dir), out, tokenizer_path())
    return read_ids(spark, out)
