"""SentencePiece encoding and decoding by a streaming Viterbi search.

The pieces and scores come from a SentencePiece model file; the best-scoring
segmentation of the text is found left to right.  A position's best score
depends on the last ``longest`` positions only, so those are the surviving
ends; whenever the backpointer paths of all of them meet in one boundary, the
ids before it are final and leave the window.  A text of any length needs
memory for the window alone.

Two adjacent bytes that no piece holds side by side are such a boundary
whatever the scores are, as every path must stop there.  Texts are cut there
first (``segments.cut``), so the search runs once per distinct segment of a
batch and its ids are gathered back for every place the segment occurs.

Ties: of paths with equal scores the one with the longer last piece wins, at
every position.  Characters without a piece fall back to their UTF-8 byte
pieces at a score below all pieces.

Decoding joins the pieces, turns the space mark U+2581 into a space and drops
the space put before the text; U+2581 in a text counts as a space.

Defined cases: null and empty texts have no ids and decode to an empty text;
rows are encoded one by one, repeated or not; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, documents
from lodestar.llm.segments import SegmentEncoder
from lodestar.llm.textnum import doc_chunks, ragged_take, text_buffer

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CHUNK_BYTES = 2 << 20


class Pieces:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte_id, self.score, self.raw = {}, {}, [b""] * n
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.raw[i] = bytes([int(piece[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                piece = piece.replace(SPACE, " ")
                self.score[piece] = (sp.get_score(i), i)
                self.raw[i] = piece.encode()
        if len(self.byte_id) < 256:
            raise ValueError("the model has no byte pieces to fall back to")
        self.longest = max(map(len, self.score))
        self.unknown = min(s for s, _ in self.score.values()) - UNKNOWN_PENALTY
        joined = np.zeros(65536, bool)
        for piece in self.score:
            b = np.frombuffer(piece.encode(), np.uint8)
            joined[(b[:-1].astype(np.uint16) << 8) | b[1:]] = True
        joined.reshape(256, 256)[:, 0x80:0xC0] = True          # never inside a character
        self.segments = SegmentEncoder(joined, lambda parts: [list(self.stream([p.decode()])) for p in parts])
        self.raw_ptr = np.zeros(n + 1, np.int64)
        np.cumsum([len(r) for r in self.raw], out=self.raw_ptr[1:])
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)

    def stream(self, parts: Iterable[str]) -> Iterator[int]:
        """Ids of a text that arrives in parts."""
        get, longest = self.score.get, self.longest
        text, best, back, ids = "", [0.0], [0], [()]     # window: nodes since the last commit
        for part in parts:
            for char in part:
                text += char
                end = len(text)
                top, start, chosen = -1e300, end - 1, None
                for s in range(max(0, end - longest), end):
                    found = get(text[s:end])
                    if found is not None and best[s] + found[0] > top:
                        top, start, chosen = best[s] + found[0], s, (found[1],)
                if get(char) is None and best[end - 1] + self.unknown > top:
                    top, start = best[end - 1] + self.unknown, end - 1
                    chosen = tuple(self.byte_id[b] for b in char.encode())
                best.append(top)
                back.append(start)
                ids.append(chosen)
                if end >= 2 * longest and end % longest == 0:
                    done = self._meeting(back, end)
                    if done:
                        yield from self._path(back, ids, done)
                        base = best[done]
                        text, best = text[done:], [b - base for b in best[done:]]
                        back, ids = [max(0, b - done) for b in back[done:]], ids[done:]
        yield from self._path(back, ids, len(text))

    def _meeting(self, back: list[int], end: int) -> int:
        """The last boundary that the paths of all surviving ends share."""
        live = set(range(max(0, end - self.longest + 1), end + 1))
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(back[last])
        return live.pop()

    @staticmethod
    def _path(back, ids, end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(ids[end])
            end = back[end]
        return [i for piece in reversed(out) for i in piece]

    def encode(self, buf: np.ndarray, offs: np.ndarray):
        """(ids, ptr) of texts that already carry the space before them."""
        return self.segments(buf, offs)

    def decode(self, ids: np.ndarray, ptr: np.ndarray) -> list[str]:
        """Texts of id rows, without the space before them."""
        raw, at = ragged_take(self.raw_ptr, self.raw_bytes, ids.astype(np.int64))
        raw, cut = raw.tobytes(), at[ptr]
        return [raw[a + (raw[a:a + 1] == b" "):b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:])]


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): ids of every whole text, as unsigned 32-bit
    little-endian binary."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        p = pieces(path)
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                ids, ptr = p.encode(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                rows = [ids[i:j].astype("<u4").tobytes() for i, j in zip(ptr[:-1], ptr[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, pa.binary())], ["doc_id", "ids"])

    return _prefixed(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def _prefixed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.when(text == "", text).otherwise(F.concat(F.lit(" "), text)).alias("text"))


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, text) from (doc_id, ids)."""
    def run(batches):
        p = pieces(path)
        for batch in batches:
            rows = [x.as_py() or b"" for x in batch.column(1)]
            ptr = np.zeros(len(rows) + 1, np.int64)
            np.cumsum([len(r) // 4 for r in rows], out=ptr[1:])
            texts = p.decode(np.frombuffer(b"".join(rows), "<u4"), ptr)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ptr)), pa.array([zlib.crc32(r) for r in rows], pa.int64()),
                 pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_crc32", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, text string")


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, decoded_sha256, n_chars): digests of the
    ids and of the text decoded from them, for every row.

    Equals ``decoded(encoded(docs))`` with its text digested, in one step: each
    task has one worker with one model, and neither ids nor texts go back."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        p = pieces(path)
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                ids, ptr = p.encode(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                crc = [zlib.crc32(ids[i:j].astype("<u4").tobytes()) for i, j in zip(ptr[:-1], ptr[1:])]
                texts = p.decode(ids, ptr)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(ptr), pa.int64()), pa.array(crc, pa.int64()),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "n_chars"])

    return _prefixed(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return encode_and_decode(documents(spark, sf_dir), model_path())
