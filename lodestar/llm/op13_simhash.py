"""SimHash near-dedup by a segment-popcount embedding.

A document's fingerprint has 64 bits; a bit is 1 where more than half of its
word shingles (repeats counted) have it in their XXH64.  Two documents are
linked at ``distance`` differing bits or fewer.

Each 2-bit segment of a fingerprint is mapped to its number of ones, which
gives a point on a grid of 32 coordinates from 0 to 2.  The Manhattan distance of
two points never exceeds the Hamming distance of their fingerprints.  So
of the two halves of the points (16 coordinates each) one is within
``distance // 2`` = 2, and on the grid two points within 2 share a cell of
the cells within 1 of each: every fingerprint is sent to its own and the
neighbouring cells of both halves (51 on average), and an equi-join on the
cell is a range join that misses no pair.  All other pairs of a cell fall to
the exact test.

Equal fingerprints form one class before that, so copies never meet in a
cell.  A cell's members are walked breadth-first: each member is compared once
with those not reached yet, and a reached member is linked to the first of
its walk.  Thus a cell of m members gives at most m - 1 links with the
same components as all its pairs.  A cell that may hold more than
``BLOCK_ROWS`` members is dealt by hash into blocks, each pair of blocks to a
task of its own; no cell is capped.

Defined cases: null, empty or blank texts have the fingerprint 0 and are
linked like any other; fewer words than ``k`` are hashed as one shingle; a
half of the shingles exactly gives bit 0; a row with a null doc_id has
a fingerprint and a null component and links nothing; repeated rows have the
component of their fingerprint, also where one doc_id has several texts;
ties can't arise, as the component is the smallest doc_id; a text of any
length is hashed ``CHUNK_WORDS`` shingles at a time; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, components, documents, possible, stored
from lodestar.llm.normal import collapsed, spans
from lodestar.llm.textnum import IS_SPACE, LOWER, doc_chunks, inside, text_buffer

K, SEED, DISTANCE = 4, 42, 4
CHUNK_BYTES, CHUNK_WORDS = 1 << 20, 1 << 16
BLOCK_ROWS = 16384
FIELDS = 16                    # 2-bit segments in a half
_U = np.uint64
# the eight bits of a byte as eight byte-wide counters in one number
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(_U).ravel()


def _ones(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    total = np.zeros(64, np.int64)
    for a in range(0, len(h), 255):                 # a lane holds 255 at most
        total += _LANES[h[a:a + 255].view(np.uint8).reshape(-1, 8)].sum(axis=0).view(np.uint8)
    return total


def text_fingerprints(buf: np.ndarray, offs: np.ndarray, k: int = K, seed: int = SEED) -> np.ndarray:
    """Fingerprints of the rows of a text buffer."""
    buf, offs = collapsed(LOWER[buf], offs, IS_SPACE)
    starts, ends, ptr = spans(buf, offs, IS_SPACE)
    raw, digest = buf.tobytes(), xxhash.xxh64_intdigest
    pos, _ = inside(ptr, k)
    first = np.searchsorted(pos, ptr)
    out = np.zeros(len(offs) - 1, _U)
    for i in np.flatnonzero(np.diff(ptr)):
        p = pos[first[i]:first[i + 1]]
        a, b = (starts[p], ends[p + k - 1]) if len(p) else (starts[ptr[i]:ptr[i] + 1], ends[ptr[i + 1] - 1:ptr[i + 1]])
        total = np.zeros(64, np.int64)
        for c in range(0, len(a), CHUNK_WORDS):
            part = zip(a[c:c + CHUNK_WORDS].tolist(), b[c:c + CHUNK_WORDS].tolist())
            total += _ones(np.array([digest(raw[x:y], seed) for x, y in part], _U))
        out[i] = np.packbits(2 * total > len(a), bitorder="little").view(_U)[0]
    return out


def fingerprints(docs: DataFrame, k: int = K, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a long."""
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for a, b in doc_chunks(offs, CHUNK_BYTES):
                fp = text_fingerprints(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a], k, seed)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _points(fp):
    """The two halves of the popcount point, two bits a coordinate, tagged."""
    odd = F.lit(0x55555555)
    for half in (0, 1):
        bits = F.shiftrightunsigned(fp, 32 * half)
        yield half << 2 * FIELDS, bits.bitwiseAND(odd) + F.shiftrightunsigned(bits, 1).bitwiseAND(odd)


def own_cells(rows: DataFrame) -> DataFrame:
    """(fp, cell): each point's own cell of both halves."""
    return rows.select("fp", F.explode(F.array(*[c + F.lit(tag) for tag, c in _points(F.col("fp"))])).alias("cell"))


def near_cells(cells: DataFrame) -> DataFrame:
    """``cells`` with ``near``: the cell and those one step away on the grid."""
    near = [F.col("cell")]
    for s in range(FIELDS):
        field, step = F.shiftright("cell", 2 * s).bitwiseAND(F.lit(3)), F.lit(1 << 2 * s)
        near += [F.when(field < 2, F.col("cell") + step), F.when(field > 0, F.col("cell") - step)]
    return cells.withColumn("near", F.explode(F.array(*near))).filter("near is not null")


def crowded(own: DataFrame, block_rows: int) -> DataFrame:
    """(cell, nb): cells that may hold more than ``block_rows`` members, with
    the blocks to deal them to.  Such a cell has a neighbour among the own
    cells with a share of them; all other neighbours add less than that share."""
    share = max(1, block_rows // (2 * FIELDS + 1))
    full = own.groupBy("cell").count().filter(F.col("count") > share)
    return (near_cells(full).groupBy(F.col("near").alias("cell")).agg(F.sum("count").alias("sum"))
            .select("cell", F.ceil((F.col("sum") + F.lit(block_rows)) / F.lit(float(block_rows))).cast("int").alias("nb")))


def _walk(fp: np.ndarray, distance: int) -> np.ndarray:
    """Links (first of the walk, reached) of one cell."""
    out, left = [], fp
    while len(left) > 1:
        first, left = left[0], left[1:]
        queue = [first]
        while queue and len(left):
            hit = np.bitwise_count(left ^ queue.pop()) <= distance
            if hit.any():
                got, left = left[hit], left[~hit]
                queue.extend(got)
                out.append(np.stack([np.full(len(got), first), got], 1))
    return np.concatenate(out) if out else np.zeros((0, 2), _U)


def _links(fp: np.ndarray, cut: np.ndarray, distance: int, small: int = 8) -> np.ndarray:
    """Links of all cells; cell i holds fp[cut[i]:cut[i + 1]]."""
    size = np.diff(cut)
    number = np.repeat(np.arange(len(size)), size)
    few = (size <= small)[number]
    out = []
    for lag in range(1, small):
        ok = few[lag:] & (number[lag:] == number[:-lag])
        ok[ok] = np.bitwise_count(fp[lag:][ok] ^ fp[:-lag][ok]) <= distance
        out.append(np.stack([fp[:-lag][ok], fp[lag:][ok]], 1))
    out += [_walk(fp[cut[i]:cut[i + 1]], distance) for i in np.flatnonzero(size > small)]
    return np.concatenate(out)


def linked(reps: DataFrame, distance: int = DISTANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``reps`` (fp, rep)
    whose components are those of all pairs within ``distance`` bits."""
    if not 2 <= distance <= 5:
        raise ValueError("the cells one step away cover distances from 2 to 5")
    own = own_cells(reps)
    sent = near_cells(own).select("fp", F.col("near").alias("cell"))
    full = stored(crowded(own, block_rows), "op13-crowded")
    i, j = F.lit(0).alias("i"), F.lit(0).alias("j")
    if full.isEmpty():
        dealt = sent.select("cell", i, j, "fp")
    else:
        sent = possible(sent, F.col("cell"), full, F.col("cell"))
        block = F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int")
        many = (sent.filter("_maybe").join(full, "cell", "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
                .withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
                .select("cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "fp"))
        dealt = sent.filter("not _maybe").select("cell", i, j, "fp").unionByName(many)

    def run(batches):
        held = None
        for batch in batches:
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            if not len(rows[0]):
                continue
            new = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]) | (rows[2][1:] != rows[2][:-1])) + 1
            last = new[-1] if len(new) else 0
            yield from _pairs(_links(rows[3][:last].view(_U), np.append(0, new), distance))
            held = [x[last:] for x in rows]
        if held is not None and len(held[0]):
            yield from _pairs(_links(held[3].view(_U), np.array([0, len(held[0])]), distance))

    return (dealt.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
            .mapInArrow(run, "a long, b long").distinct())


def _pairs(found: np.ndarray):
    if len(found):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in found.T], ["a", "b"])


def near_duplicates(docs: DataFrame, k: int = K, distance: int = DISTANCE, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    bounded_batches(docs.sparkSession)
    marks = stored(fingerprints(docs, k, seed, id_col, text_col), "op13-marks")
    reps = stored(marks.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "op13-reps")
    pairs = stored(linked(reps, distance), "op13-links")
    # a node is (smallest doc_id, fp): the smallest node of a component holds its id
    node = lambda x: reps.select(F.col("fp").alias(x), F.struct("rep", "fp").alias(f"n_{x}"))
    edges = pairs.join(node("a"), "a").join(node("b"), "b").select(F.col("n_a").alias("a"), F.col("n_b").alias("b"))
    found = components(edges).select(F.col("node.fp").alias("fp"), F.col("component.rep").alias("least"))
    ids = reps.join(found, "fp", "left").select("fp", F.coalesce("least", "rep").alias("component"))
    return marks.join(ids, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
