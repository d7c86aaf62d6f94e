"""Language identification by hierarchical discrimination.

A linear model on hashed byte n-grams first picks the language family; within
a family, one linear support vector machine per pair of languages votes, ties
broken by summed margins.  Families are the fixed table below; a language it
doesn't list forms a family of its own.

Features are relative frequencies of letter n-grams (1 to 3 bytes, words
padded by a space, A-Z lower-cased, everything that isn't a letter counted as
a space).  A prediction is a mean of weights over all positions of the whole
text, so it needs no per-document vector and no shuffle.

Models are fitted on a bounded sample: about ``PER_LANGUAGE`` documents of
each language with texts of at most ``SAMPLE_BYTES`` bytes, or, where a language
has longer ones only, about ``PER_LONG`` of these; taken only from documents
whose crc32(doc_id as text) mod 3 is not 1 and whose lang is known.
Scoring covers every row and broadcasts only the weights.

Defined cases: null text, or text without a letter (Unicode category L, one
test for fitting and scoring; numbers such as Roman numeral signs aren't
letters), gives ``und`` with score 0; in a tie of families the first by name
wins, in one of languages the last by name; a null doc_id is not held out and not learned from; with one learned
language every other text gets it with score 1, with none ``und``; repeated
rows are scored each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, documents
from lodestar.llm.sparse import Rows, descend, sigmoid
from lodestar.llm.textnum import LOWER, text_buffer

# Language families (ISO 639-1 codes).
FAMILIES = {
    "germanic": "af da de en fy is lb nl no sv",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

DIM_BITS = 16
PER_LANGUAGE, SAMPLE_BYTES, PER_LONG = 800, 32 << 10, 50
SCALE, PENALTY, STEPS, RATE = 30.0, 1e-4, 120, 0.3
CHUNK_BYTES = 2 << 20
SLOTS = 1 << 14                # n-grams whose weights are gathered at once
UNKNOWN = "und"

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[65:91] = LOWER[65:91]
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, f"only:{lang}")


def ngrams(buf: np.ndarray) -> list[np.ndarray]:
    """Slots of the 1-, 2- and 3-grams that start at each byte; runs of
    non-letters collapse into the single space before a word."""
    b = _LETTERS[buf]
    keep = b != 32
    keep[1:] |= b[:-1] != 32
    b = b[keep].astype(np.uint32)
    out, key = [], np.zeros(len(b), np.uint32)
    for size in range(1, 4):
        if len(b) < size:
            break
        key = key[:len(b) - size + 1] * np.uint32(257) + b[size - 1:] + np.uint32(1)
        mixed = (key + np.uint32(size * 7919)) * np.uint32(2654435761)
        out.append(((mixed ^ (mixed >> np.uint32(15))) * np.uint32(2246822519) >> np.uint32(32 - DIM_BITS)).astype(np.int64))
    return out


def _frequencies(buf: np.ndarray):
    """(slots, scaled relative frequencies) of one text."""
    slots = np.concatenate([np.zeros(0, np.int64), *ngrams(buf)])
    col, n = np.unique(slots, return_counts=True)
    return col, SCALE * n / max(1, n.sum())


def has_letter(text="text"):
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _svm(rows: Rows, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss; classes weigh the same."""
    weight = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum()))

    def grad(p):
        slack = np.maximum(0, 1 - y * (rows.dot(p[:-1]) + p[-1]))
        r = -weight * y * slack
        return np.append(rows.back(r) + PENALTY * p[:-1], r.sum())

    p = descend(grad, np.zeros(rows.dim + 1), STEPS, RATE)
    return p[:-1], p[-1]


class Model:
    """Family weights (one against the rest) and pair weights, stacked."""

    def __init__(self, rows: Rows, langs: np.ndarray):
        self.langs = sorted({str(x) for x in langs})
        families = np.array([family_of(str(x)) for x in langs])
        self.families = sorted({str(x) for x in families})
        fits = []
        if len(self.families) > 1:
            fits += [_svm(rows, np.where(families == f, 1.0, -1.0)) for f in self.families]
        self.pairs = []
        for f in self.families:
            own = [x for x in self.langs if family_of(x) == f]
            for i, a in enumerate(own):
                for b in own[i + 1:]:
                    pick = np.flatnonzero((langs == a) | (langs == b))
                    fits.append(_svm(rows.take(pick), np.where(langs[pick] == a, 1.0, -1.0)))
                    self.pairs.append((a, b))
        self.w = np.zeros((rows.dim, len(fits)), np.float32)      # one line of memory per slot
        for k, (w, _) in enumerate(fits):
            self.w[:, k] = w * SCALE
        self.bias = np.array([b for _, b in fits])

    def margins(self, buf: np.ndarray) -> np.ndarray:
        """Margins of every fitted model for one whole text, by pieces."""
        total, n = np.zeros(self.w.shape[1]), 0
        for a in range(0, len(buf), CHUNK_BYTES):
            # two bytes of overlap: no n-gram is lost at a piece's end
            for slots in ngrams(buf[a:a + CHUNK_BYTES + 2]):
                for i in range(0, len(slots), SLOTS):
                    total += self.w[slots[i:i + SLOTS]].sum(axis=0, dtype=np.float64)
                n += len(slots)
        return total / max(1, n) + self.bias

    def predict(self, margins: np.ndarray) -> tuple[str, float]:
        score, family, at = 1.0, self.families[0], 0
        if len(self.families) > 1:
            at = len(self.families)
            best = int(np.argmax(margins[:at]))
            family, score = self.families[best], float(sigmoid(2 * margins[best]))
        own = [x for x in self.langs if family_of(x) == family]
        votes = {x: [0, 0.0] for x in own}
        for (a, b), m in zip(self.pairs, margins[at:]):
            if a in votes:
                votes[a if m > 0 else b][0] += 1
                votes[a][1] += m
                votes[b][1] -= m
        lang = max(own, key=lambda x: (votes[x][0], votes[x][1], x))
        if len(own) > 1:
            score *= float(sigmoid(2 * votes[lang][1] / (len(own) - 1)))
        return lang, score


def sample(known: DataFrame) -> DataFrame:
    """The rows to learn from; one grouped count, no sort, the same on a retry."""
    short = F.octet_length("text") <= SAMPLE_BYTES
    sizes = known.groupBy("lang").agg(F.count_if(short).alias("_short"), F.count(F.lit(1)).alias("_all"))
    share = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    pick = F.when(F.col("_short") > 0, short & (share * F.col("_short") < PER_LANGUAGE)).otherwise(share * F.col("_all") < PER_LONG)
    return known.join(F.broadcast(sizes), "lang").filter(pick)


def fit(docs: DataFrame) -> Model | None:
    """Model from the bounded sample of documents that aren't held out."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column(0))
            got = [_frequencies(buf[a:b]) for a, b in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.astype(np.int32).tobytes() for c, _ in got], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for _, v in got], pa.binary()), batch.column(1)], ["col", "val", "lang"])

    known = docs.select("doc_id", "text", "lang").filter(
        "lang is not null and doc_id is not null and text is not null").filter(~held_out()).filter(has_letter())
    got = (sample(known).orderBy("doc_id").select("text", "lang")
           .mapInArrow(run, "col binary, val binary, lang string").toPandas())
    if not len(got):
        return None
    rows = Rows([np.frombuffer(c, np.int32) for c in got["col"]],
                [np.frombuffer(v, np.float32).astype(float) for v in got["val"]], 1 << DIM_BITS)
    return Model(rows, got["lang"].to_numpy(str))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    bounded_batches(docs.sparkSession)

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            buf, offs = text_buffer(batch.column(2))
            pred, score = [], []
            for a, b, letters in zip(offs[:-1], offs[1:], batch.column(3).to_pylist()):
                lang, s = model.predict(model.margins(buf[a:b])) if model and letters else (UNKNOWN, 0.0)
                pred.append(lang)
                score.append(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text", has_letter().alias("letters")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, fit(docs))
