import hashlib
import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from lodestar.llm import op6_exact, op7_neardup, op8_substring
from lodestar.llm.common import components, without
from conftest import SF_SMALL
from llm import brute


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("extra", [False, True])
def test_exact_groups(spark, extra):
    rows = brute.edge_rows(SF_SMALL)
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    key = lambda i: -1 if i is None else i
    want = Counter()
    for i, t, *_ in rows:
        g = groups[t or ""]
        keep = max(g, key=key)
        want[(i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert rows_of(op6_exact.exact_groups(brute.frame(spark, rows, extra), digest_all=True)) == want


def test_exact_reads_survivors_only(spark):
    rows = [(i, f"{'a' * 80}{i}", None, None, None) for i in range(50)] + [(100 + i, "b" * (i + 1), None, None, None) for i in range(9)]
    got = op6_exact.exact_groups(brute.frame(spark, rows)).collect()
    # single lengths are never read in full; a tiny bitmap only reads more
    assert all(r.text_sha256 is None for r in got if r.doc_id >= 100 and r.doc_id != 100)
    tiny = op6_exact.exact_groups(brute.frame(spark, rows), bitmap_bits=4).select("doc_id", "keep_id", "kept")
    assert rows_of(tiny) == Counter((r.doc_id, r.keep_id, r.kept) for r in got)


@pytest.mark.parametrize("k,threshold", [(3, 0.85), (5, 0.8)])
def test_near_duplicates(spark, k, threshold):
    rows = brute.edge_rows(SF_SMALL)
    base = rows[3][1].split()
    for i in range(40):                       # a family of near copies, some beyond the threshold
        w = base[:]
        for j in range(i % 14):
            w[(7 * i + 11 * j) % len(w)] = f"new{i}x{j}"
        rows.append((2000 + i, " ".join(w), None, None, None))
    known = dict((i, t) for i, t, *_ in rows if i is not None)
    want = brute.near_components(known.items(), k, round(threshold * 100))
    got = op7_neardup.near_duplicates(brute.frame(spark, rows, True), k, threshold).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_a_large_group_about_the_threshold_gives_links_not_pairs(spark, monkeypatch):
    """Texts of one group, most pairs just below the threshold: the second round
    hands on links between components, not the group's pairs."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        text = list(base)
        for at in rng.sample(range(300), 4):
            text[at] = f"x{i}_{at}"
        rows.append((i, " ".join(text), None, None, None))
    rows += [(200 + i, f"{rows[i][1]} more", None, None, None) for i in range(10)]
    handed = {}
    keep = op7_neardup.stored

    def counted(df, name, **options):
        out = keep(df, name, **options)
        handed[name] = out.count()
        return out

    monkeypatch.setattr(op7_neardup, "stored", counted)
    got = op7_neardup.near_duplicates(brute.frame(spark, rows, True), 5, 0.8).collect()
    want = brute.near_components([r[:2] for r in rows], 5, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert 1 < len({c for _, c in want.values()}) < len(rows)
    second = sum(n for name, n in handed.items() if name in ("op7-near2", "op7-links"))
    assert 0 < second < 2 * len(rows), handed


def test_signature_plan():
    for t in (0.7, 0.8, 0.85, 0.95):
        chunks, width = op7_neardup.plan_signature(t)
        assert chunks >= 4 and width in (4, 5)
    with pytest.raises(ValueError):
        op7_neardup.plan_signature(0.3)


@pytest.mark.parametrize("extra", [False, True])
def test_remove_repeats(spark, extra, monkeypatch):
    monkeypatch.setattr(op8_substring, "BUCKET_BYTES", 40_000)       # many buckets and chunks
    monkeypatch.setattr(op8_substring, "CHUNK_BYTES", 30_000)
    rows = brute.edge_rows(SF_SMALL)
    got = op8_substring.remove_repeats(brute.frame(spark, rows, extra)).collect()
    got = Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got)
    assert got == Counter(brute.removed([(i, t) for i, t, *_ in rows]))


def test_blocks_must_fit_the_window(spark):
    with pytest.raises(ValueError):
        op8_substring.remove_repeats(brute.frame(spark, []), window=13, block=8)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


@pytest.mark.parametrize("run", [op6_exact.exact_groups, op7_neardup.near_duplicates, op8_substring.remove_repeats])
def test_empty_tables(spark, run):
    assert run(brute.frame(spark, [])).count() == 0


def test_one_id_with_several_texts(spark):
    texts = [" ".join(f"{name}{j}" for j in range(60)) for name in "abcdef"]
    near = [t.replace("30", "other") for t in texts]
    rows = [(3, texts[0]), (4, texts[1]), (7, near[0]), (7, near[1]), (7, texts[2]),      # 7: near copies of 3 and 4, and a text of its own
            (8, texts[3]), (8, near[3]), (8, near[3]),                                    # 8: near copies under one id
            (2, texts[4]), (2, texts[5]), (9, near[4]), (9, near[5].upper())]
    docs = brute.frame(spark, [(*r, "en", "s", 1) for r in rows], True)
    got = op7_neardup.near_duplicates(docs, 5, 0.8)
    comp = Counter((r.doc_id, r.component_id, r.kept) for r in got.collect())
    one = comp.pop((8, 8, True))
    assert comp.pop((8, 8, False)) + one == 3 and one in (1, 2)                           # all rows of one class
    assert comp == Counter([(3, 3, True), (4, 4, True), (7, 3, False), (7, 4, False), (7, 7, True),
                            (2, 2, True), (2, 2, True), (9, 2, False), (9, 2, False)])
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, None).collect()]
    assert sorted(x for x in left if x[0] != 8) == sorted([rows[0], rows[1], rows[4], rows[8], rows[9]])
    assert len({x for x in left if x[0] == 8}) == 1


@pytest.mark.parametrize("bits", [1, 64, 1 << 23])
@pytest.mark.parametrize("others", [False, True])
def test_without(spark, bits, others):
    """Bitmaps of any size, with mistaken keys, and null and repeated keys."""
    rows = spark.createDataFrame([(i % 300 if i % 11 else None, f"t{i}") for i in range(900)], "k int, t string")
    members = spark.createDataFrame([(i,) for i in range(0, 300, 3)], "m int")
    stay = rows.select(F.col("k").alias("o")).filter("o % 3 <> 0 or o is null")
    got = without(rows, F.col("k"), members, F.col("m"), *((stay, F.col("o")) if others else ()), bits=bits)
    want = Counter((r.k, r.t) for r in rows.collect() if r.k is None or r.k % 3)
    assert Counter((r.k, r.t) for r in got.collect()) == want
    empty = without(rows.limit(0), F.col("k"), members, F.col("m"), stay, F.col("o"), bits=bits)
    assert empty.count() == 0
    none = without(rows, F.col("k"), members.limit(0), F.col("m"), stay, F.col("o"), bits=bits)
    assert none.count() == 900
