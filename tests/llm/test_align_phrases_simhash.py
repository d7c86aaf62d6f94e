"""Operators 11, 12 and 13 against plain versions, and their edge cases."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from lodestar.llm import op11_align, op12_collocations, op13_simhash

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
EDGE = [None, "", " ", "\n", "one", "Two Words", "a  b  c", "x▁y", "it's 'sun' <|endoftext|> <s> \n\n  end  ",
        "''s ('tis) 12'34 a'b ('s", "日本語 text🙂 é à b", "a\x00b \x1c c", "tab\t\tx\r\n y", "nb  　 sp  end", "same text here now", "same text here now",
        "long " * 30_000, "w" * 70_000]


def frame(spark, texts, lang="en"):
    """Rows with null ids and columns whose names the operators use themselves."""
    rows = [(i, t, lang, "x", 1) for i, t in enumerate(texts)] + [(None, "null id row here", None, "y", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, fp string, pair int")


def key(row):
    return [(x is None, str(x)) for x in row]


def plain_fingerprint(text):
    w = WORDS.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    parts = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, fps, distance=4):
    fps, least = np.array(fps, np.uint64), list(ids)
    near = [np.flatnonzero(np.bitwise_count(fps ^ f) <= distance) for f in fps]
    changed = True
    while changed:
        changed = False
        for i, n in enumerate(near):
            m = min([least[i], *(least[j] for j in n)])
            changed |= m != least[i]
            least[i] = m
    return least


def test_simhash_is_the_plain_one(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    want = zip([r.doc_id for r in rows], [f"{f:016x}" for f in fps], smallest_reachable([r.doc_id for r in rows], fps))
    assert sorted(map(tuple, op13_simhash.near_duplicates(docs).collect())) == sorted(want)


def test_simhash_edges(spark):
    got = op13_simhash.near_duplicates(frame(spark, EDGE)).collect()
    assert len(got) == len(EDGE) + 1
    known = {r.doc_id: r for r in got}
    assert all(known[i].fingerprint == "0" * 16 and known[i].component_id == 0 for i in range(4))
    assert known[None].component_id is None and known[None].fingerprint == f"{plain_fingerprint('null id row here'):016x}"
    assert known[14].component_id == known[15].component_id == 14
    assert all(known[i].fingerprint == f"{plain_fingerprint(t):016x}" for i, t in enumerate(EDGE))
    assert op13_simhash.near_duplicates(frame(spark, EDGE).limit(0)).count() == 0


@pytest.mark.parametrize("block_rows", [16384, 64])
def test_simhash_cells_find_all_links(spark, block_rows):
    """Families of fingerprints around a centre and at the limit; small blocks
    deal every cell to many tasks."""
    rng = random.Random(5)
    fps = {0, 2**64 - 1}
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(30):
            fp = centre
            for b in rng.sample(range(64), rng.randint(0, 7)):
                fp ^= 1 << b
            fps.add(fp)
    fps = sorted(fps)
    reps = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)), i) for i, f in enumerate(fps)], "fp long, rep long")
    links = op13_simhash.linked(reps, 4, block_rows).collect()
    at = {int(np.uint64(f).astype(np.int64)): i for i, f in enumerate(fps)}
    least = list(range(len(fps)))
    for _ in range(len(fps)):
        before = list(least)
        for r in links:
            a, b = at[r.a], at[r.b]
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    assert least == smallest_reachable(range(len(fps)), fps)
    assert (op13_simhash.crowded(op13_simhash.own_cells(reps), block_rows).count() > 0) == (block_rows == 64)


def test_walk_gives_a_forest():
    fp = np.array([0, 1, 3, 7, 15, 31, 63, 127, 2**40, 2**63], np.uint64)
    links = op13_simhash._walk(fp, 4)
    assert len(links) == 9 and set(links[:, 0]) == {0}                # 0 reaches all, 2**63 and 2**40 by one bit
    assert len(op13_simhash._walk(np.array([0, 2**20 - 1], np.uint64), 4)) == 0


def test_simhash_half_gives_zero_and_counts_repeats():
    assert op13_simhash._ones(np.array([3] * 600 + [1] * 300, np.uint64))[:3].tolist() == [900, 600, 0]


def plain_alignment(rows, ta, tb):
    per, total = [], Counter()
    for doc_id, text in rows:
        text, a, b = text or "", [], []
        if text:
            a = [(i, ta.raw[i]) for i in ta.tok.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, tb.raw[i]) for i in tb.sp.encode(text)]
        if any(b"".join(r for _, r in x) != (" " + text).encode() for x in (a, b)):
            a = b = []
        ends = []
        for x in (a, b):
            at, out = 0, {}
            for i, r in x:
                at += len(r)
                out[at] = i
            ends.append(out)
        common = sorted(ends[0].keys() & ends[1].keys())
        links = [(ends[0][e], ends[1][e]) for e in common]
        total.update(links)
        groups = [("|".join(",".join(str(i) for e, i in x.items() if lo < e <= hi) for x in ends))
                  for lo, hi in zip([0, *common], common)]
        per.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = Counter()
    for (_, y), n in total.items():
        best[y] = max(best[y], n)
    return [(d, na, nb, len(x), len(x), sum(total[p] == best[p[1]] for p in x), sum(total[p] for p in x), s) for d, na, nb, x, s in per]


PATHS = [op11_align.tokenizer_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def test_alignment_is_the_plain_one(spark):
    edge = frame(spark, [t for t in EDGE if t is None or len(t) < 1000]).select((op11_align.F.col("doc_id") + 10**6).alias("doc_id"), "text")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(60).unionByName(edge)
    ta, tb = op11_align.tokens(op11_align.ByteTokens, PATHS[0]), op11_align.tokens(op11_align.PieceTokens, PATHS[1])
    want = plain_alignment([tuple(r) for r in docs.collect()], ta, tb)
    got = op11_align.alignment(docs, *PATHS).collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_alignment_edges(spark):
    got = {r.doc_id: r for r in op11_align.alignment(frame(spark, EDGE), *PATHS).collect()}
    assert len(got) == len(EDGE) + 1
    for i in (0, 1, 7):                       # null, empty, U+2581
        assert tuple(got[i])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert got[14][1:] == got[15][1:]
    assert got[16].n_groups > 29_000 and got[17].n_groups >= 1
    assert op11_align.alignment(frame(spark, EDGE).limit(0), *PATHS).count() == 0


def test_segments_give_the_libraries_ids():
    """Random texts of every cut class, through segments and whole."""
    rng = random.Random(9)
    atoms = [*"aZ09'\"(),.-_ \t\n\r", "é", "à", " ", " ", "　", "日", "🙂", "'s", "'ll", "  ", "word", " the", "\x00", "\x1f", "▁"]
    texts = [" " + "".join(rng.choices(atoms, k=rng.randint(1, 40))) for _ in range(3000)]
    raw = [t.encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))
    for kind, path in zip((op11_align.ByteTokens, op11_align.PieceTokens), PATHS):
        t = op11_align.tokens(kind, path)
        ids, ptr = op11_align.encode_rows(t, buf, offs)
        for r, i, j in zip(raw, ptr[:-1], ptr[1:]):
            want, got = t.whole(r), ids[i:j].tolist()
            assert got == want or (int(op11_align.BAD) in want and int(op11_align.BAD) in got), r


def phrase_table(seed=3):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(["the", "of", "Red", "fox", "ran", "x1", "Été"], k=rng.randint(0, 60))) for _ in range(400)]
    texts += ["In the Beginning was  the\tword; and so on"] * 150 + ["a b c d e f. a b c d e f\x0bg"] * 120 + [None, "", " , ,", "solo"]
    return [(i, t, rng.choice(["en", "fr", None])) for i, t in enumerate(texts)]


def test_collocations_against_sql(spark):
    rows = phrase_table()
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, lang string, n int, phrase string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    got = op12_collocations.collocations(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(op12_collocations.ORACLE).fetchall()) and got
    assert op12_collocations.collocations(docs.limit(0)).count() == 0


def test_small_tries_spill_and_give_the_same_counts(spark):
    docs = spark.createDataFrame(phrase_table(), "doc_id long, text string, lang string").fillna("und", ["lang"]).select("text", "lang")
    one = op12_collocations.sorted_runs(docs, range(1, 2), None)
    total = lambda x: sorted(map(tuple, x.groupBy("lang", "phrase").sum("n").collect()))
    want, rows = total(one), one.count()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        many = op12_collocations.sorted_runs(docs, range(1, 2), None, most=5)
        assert total(many) == want and many.count() > rows
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_trie_bursts_and_spills_sorted_whole_subtrees():
    trie, rng, want = op12_collocations.HatTrie(burst=40), random.Random(1), Counter()
    for _ in range(60):
        phrases = sorted({" ".join(rng.choices("abcdefgh", k=rng.randint(1, 4))) for _ in range(50)})
        keys = np.array([xxhash.xxh64_intdigest(p) for p in phrases], np.uint64)
        path = np.array([int.from_bytes((p.replace(" ", "") + "  ")[:2].encode()) for p in phrases], np.uint64)
        order = np.argsort(path, kind="stable")
        trie.add(path[order], keys[order], np.full(len(order), 2), op12_collocations.pa.array(phrases, op12_collocations.pa.large_string()).take(
            op12_collocations.pa.array(order)))
        want.update({p: 2 for p in phrases})
    assert len(trie.boxes) > 8 and (np.diff(trie.lows) > 0).all()
    got, runs = Counter(), 0
    for keep in (trie.size // 2, 0):
        for text, count in trie.spill(keep):
            text = text.to_pylist()
            assert text == sorted(text)
            got.update(dict(zip(text, count.tolist())))
            runs += len(text)
    assert got == want and runs == len(want) and trie.size == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 90_000_000_000_000_000
    counts = spark.createDataFrame([("en", "p", 1, big - 7), ("en", "q", 1, big - 11), ("en", "p q", 2, big - 13)],
                                   "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", big)], "lang string, n long")
    (row,) = op12_collocations.scored(counts, totals).collect()
    assert row.score == 1000 * (big - 13) * big // ((big - 7) * (big - 11))
