"""Toxicity severity by cumulative-link ordinal regression.

P(grade <= k | x) = sigmoid(threshold_k - w . x): one weight vector shared by
all ordered thresholds, and the expected severity is the sum over k >= 1 of
P(grade >= k).  Thresholds are kept in order by fitting their positive
increments.

The labels are binary (toxic 0/1), so grades are derived: 0 for not toxic;
toxic documents are split at the median density of indicative words (words
whose smoothed log odds for the toxic label exceed ``INDICATIVE``) into
grade 1 (below the median) and grade 2.  A document is rejected when its
expected severity reaches a bound set on the same sample (``reject_from``).

Features are presences of hashed lower-cased words and of their first four
and five bytes, in ``DIM`` slots; only slots that go with the toxic label
beyond chance (a likelihood-ratio test over all slots) keep a weight, so long clean texts
gather no noise.  The model is fitted on a bounded sample of labelled
documents: about ``PER_CLASS`` per label with texts of at most
``SAMPLE_BYTES`` bytes.  Scoring covers all rows and whole
texts in one scan without a shuffle; only the weights (``DIM`` floats) are
broadcast.

Defined cases: null or empty text (no word) has severity 0 and is kept; rows
without a label are scored like any other; a null label is not used for
fitting; without labels of both kinds nothing can be learned and every
severity is 0; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import bounded_batches, documents, table
from lodestar.llm.op5_decontaminate import _WORD
from lodestar.llm.sparse import Rows, descend, sigmoid, stratified
from lodestar.llm.textnum import LOWER, doc_chunks, mix, span_hashes, text_buffer, words

DIM = 1 << 19
PER_CLASS, SAMPLE_BYTES = 3000, 64 << 10
INDICATIVE = 3.0
FALSE_COST = 3.0          # a false alarm weighs as much as so many misses
CHANCE = 0.05             # expected slots that pass the test by chance
CLEAN_SHARE = 0.7         # weight of grade 0 in the fit; the other grades share the rest
PENALTY, STEPS, RATE = 3e-4, 200, 0.1
CHUNK_BYTES = 2 << 20
_U = np.uint64


def features(buf: np.ndarray, offs: np.ndarray):
    """(ptr, slots, words): sorted distinct feature slots of every row, with
    the word count of each row."""
    clean = np.where(_WORD[buf], LOWER[buf], np.uint8(32))
    starts, ends, h, ptr = words(clean, offs)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(ptr))
    rows, keys = [row], [h]
    for size in (4, 5):
        long = ends - starts > size
        rows.append(row[long])
        keys.append(mix(span_hashes(clean, starts[long], starts[long] + size) + _U(size)))
    slot = np.concatenate(rows).astype(_U) * _U(DIM) + (np.concatenate(keys) >> _U(64 - 19))
    slot.sort()
    new = np.ones(len(slot), bool)
    new[1:] = slot[1:] != slot[:-1]
    slot = slot[new]
    at = np.searchsorted(slot, np.arange(len(offs)).astype(_U) * _U(DIM))
    return at, (slot & _U(DIM - 1)).astype(np.int64), np.diff(ptr)


def _sampled(docs: DataFrame, labels: DataFrame):
    """(Rows, toxic, word counts) of the bounded labelled sample."""
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column(0))
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                at, slot, n = features(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([slot[i:j].astype(np.int32).tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary()),
                     batch.column(1).slice(a, b - a), pa.array(n, pa.int64())], ["slots", "toxic", "n"])

    chosen = stratified(labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")),
                        "doc_id", "toxic", PER_CLASS)
    got = (docs.select("doc_id", "text").filter(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(chosen), "doc_id")
           .orderBy("doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
           .mapInArrow(run, "slots binary, toxic int, n long").toPandas())
    cols = [np.frombuffer(s, np.int32) for s in got["slots"]]
    return Rows(cols, [np.ones(len(c)) for c in cols], DIM), got["toxic"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


def derive_grades(rows: Rows, toxic: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ordered grades 0, 1, 2 from the binary label and word densities."""
    odds = (np.log((rows.back((toxic == 1) * 1.0) + 0.5) / max(1, (toxic == 1).sum()))
            - np.log((rows.back((toxic == 0) * 1.0) + 0.5) / max(1, (toxic == 0).sum())))
    density = rows.dot((odds > INDICATIVE) * 1.0) / np.maximum(counts, 1)
    return np.where(toxic == 1, 1 + (density >= np.median(density[toxic == 1])), 0)


def informative(rows: Rows, toxic: np.ndarray) -> np.ndarray:
    """Slots whose presence goes with the toxic label beyond chance: by the
    likelihood-ratio statistic of presence against the label."""
    a, b = rows.back((toxic == 1) * 1.0), rows.back((toxic == 0) * 1.0)
    pa_, pb = (toxic == 1).mean(), (toxic == 0).mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        g2 = 2 * (np.where(a > 0, a * np.log(a / ((a + b) * pa_)), 0) + np.where(b > 0, b * np.log(b / ((a + b) * pb)), 0))
    chance = 2 * np.log(max(1, ((a + b) > 0).sum()) / CHANCE)      # over all slots seen
    return (g2 >= chance) & (a * pb > b * pa_)


def fit_ordinal(rows: Rows, grade: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ordered thresholds) by maximum likelihood with an L2 penalty."""
    share = np.append(CLEAN_SHARE, np.full(grades - 1, (1 - CLEAN_SHARE) / (grades - 1)))
    weight = (share / np.maximum(np.bincount(grade, minlength=grades), 1))[grade]
    weight = weight / weight.sum()
    cuts = grades - 1
    one = np.arange(rows.n)

    def grad(p):
        w, t = p[:rows.dim], np.cumsum(np.append(p[rows.dim], np.exp(p[rows.dim + 1:])))
        cum = np.ones((rows.n, grades + 1))
        cum[:, 0] = 0
        cum[:, 1:grades] = sigmoid(t[None, :] - rows.dot(w)[:, None])
        chance = np.maximum(cum[one, grade + 1] - cum[one, grade], 1e-9)
        slope = cum * (1 - cum)                       # zero at both ends
        up, low = weight * slope[one, grade + 1] / chance, weight * slope[one, grade] / chance
        d_t = np.zeros(cuts)
        for k in range(cuts):                         # threshold k bounds grades k and k + 1
            d_t[k] = -up[grade == k].sum() + low[grade == k + 1].sum()
        tail = np.cumsum(d_t[::-1])[::-1]
        out = np.zeros_like(p)
        out[:rows.dim] = rows.back(up - low) + PENALTY * w
        out[rows.dim] = tail[0]
        out[rows.dim + 1:] = tail[1:] * np.exp(p[rows.dim + 1:])
        return out

    p = descend(grad, np.zeros(rows.dim + cuts), STEPS, RATE)
    return p[:rows.dim], np.cumsum(np.append(p[rows.dim], np.exp(p[rows.dim + 1:])))


def expected(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    return sigmoid(scores[:, None] - thresholds[None, :]).sum(axis=1)


def reject_from(value: np.ndarray, toxic: np.ndarray) -> float:
    """The severity from which to reject: where recall less ``FALSE_COST``
    times the false-alarm share is highest on the sample, in the middle of
    the gap below the lowest severity rejected there."""
    order = np.argsort(-value, kind="stable")
    v, y = value[order], toxic[order]
    gain = np.cumsum(y == 1) / max(1, (y == 1).sum()) - FALSE_COST * np.cumsum(y == 0) / max(1, (y == 0).sum())
    gain[:-1][v[1:] == v[:-1]] = -np.inf            # equal severities are decided alike
    best = int(np.argmax(gain))
    if gain[best] <= 0:                             # nothing tells the labels apart
        return float("inf")
    return float((v[best] + (v[best + 1] if best + 1 < len(v) else 0.0)) / 2)


def fit(docs: DataFrame, labels: DataFrame):
    """(weights as float32, thresholds, reject), or None without both labels."""
    rows, toxic, counts = _sampled(docs, labels)
    if not ((toxic == 1).any() and (toxic == 0).any()):
        return None
    kept = rows.only(informative(rows, toxic))
    w, t = fit_ordinal(kept, derive_grades(rows, toxic, counts), 3)
    return w.astype(np.float32), t, reject_from(expected(kept.dot(w), t), toxic)


def severity(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """(row, severity, grade, toxic): ``row`` holds the input row as a struct,
    so no column of it can clash with the others."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.struct("*").alias("row"))
    number = docs.columns.index(text_col)

    def run(batches):
        model = shared.value
        for batch in batches:
            buf, offs = text_buffer(batch.column(0).field(number))
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                value, grade, reject = np.zeros(b - a), np.zeros(b - a, np.int64), np.inf
                if model is not None:
                    w, t, reject = model
                    at, slot, n = features(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                    score = np.add.reduceat(np.append(w[slot], np.float32(0)).astype(np.float64), at[:-1])
                    score[at[1:] == at[:-1]] = 0
                    value = np.where(n > 0, expected(score, t), 0.0)
                    grade = np.where(n > 0, (score[:, None] > t[None, :]).sum(axis=1), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(value), pa.array(grade), pa.array((value >= reject) & (value > 0))],
                    ["row", "severity", "grade", "toxic"])

    added = T.StructType().add("severity", "double").add("grade", "long").add("toxic", "boolean")
    return src.mapInArrow(run, T.StructType(src.schema.fields + added.fields))


def query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = severity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select("row.doc_id", "severity", "grade", "toxic")
