"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = SCHEMA + ", row string, part int, kept boolean, toxic boolean, rep long, sha string, id long, _id long"


def sample(folder: str, n: int = 90) -> list[tuple]:
    t = pq.read_table(f"{folder}/documents.parquet").slice(0, n).to_pydict()
    return list(zip(t["doc_id"], t["text"], t["lang"], t["source"], t["n_chars"]))


def edge_rows(folder: str) -> list[tuple]:
    """Ordinary rows with nulls, empty and very long texts, ties and repeats."""
    rows = sample(folder)
    text = rows[3][1]
    words = text.split()
    changed = words[:]
    changed[5] = "replaced"
    row = lambda i, t, lang="en": (i, t, lang, None, None)
    return rows + [
        row(1000, None), row(1001, ""), row(1002, " \n\t "), row(1003, "one"), row(1004, "one"),
        row(1005, "two words"), row(1006, text), row(1007, text), row(1007, text), row(1008, " ".join(changed)),
        row(1009, (text + "\n") * 60), row(1010, "word " * 60_000), row(1011, "x" * 300_000),
        row(1012, "ÀÉ ß… 漢字 😀 don't <|endoftext|> ▁ 12,34   end", None), row(1013, "123 456 !!!"),
        row(None, text), row(None, None), row(1014, "ONE"), row(1015, " ".join(words[10:40]) + " tail of its own " + " ".join(words[50:90])),
    ]


def frame(spark, rows, extra: bool = False):
    if extra:
        return spark.createDataFrame([(*r, "r", 1, True, False, 5, "s", 9, 7) for r in rows], EXTRA)
    return spark.createDataFrame(rows, SCHEMA)


def words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return WORD.findall(text)


def shingles(text, k):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def near_components(rows, k, percent):
    """{doc_id: (set size, component)} of rows with distinct, known ids."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for g in sets[i] for j in index[g])
        for g in sets[i]:
            index[g].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def removed(rows, window=13):
    """[(doc_id, words, words removed, hash of the rest)] of every row."""
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for j in range(len(w) - window + 1):
            first.setdefault(tuple(w[j:j + window]), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j:j + window])] < i:
                gone[j:j + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def viterbi(text, score, longest, unknown):
    """Best segmentation of a whole text; ties go to the longer last piece."""
    best, back = [0.0], [0]
    for end in range(1, len(text) + 1):
        top, at = -1e300, end - 1
        for s in range(max(0, end - longest), end):
            v = score.get(text[s:end])
            if v is not None and best[s] + v > top:
                top, at = best[s] + v, s
        if text[end - 1] not in score and best[end - 1] + unknown > top:
            top, at = best[end - 1] + unknown, end - 1
        best.append(top)
        back.append(at)
    out, end = [], len(text)
    while end:
        out.append(text[back[end]:end])
        end = back[end]
    return out[::-1]


def leaks(text, item, window=13, share=0.8):
    """Whether ``window`` consecutive item words stand in the text in place,
    up to the allowed substitutions, on any diagonal."""
    cut = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    d, q = cut(text), cut(item)
    size = min(window, len(q))
    need = size if len(q) < 10 else share * size
    if len(q) < 8:
        return False
    for start in range(-len(q), len(d)):
        same = [0 <= start + j < len(d) and d[start + j] == q[j] for j in range(len(q))]
        lo, hi = max(0, -start), min(len(q), len(d) - start)
        if any(sum(same[j:j + size]) >= need for j in range(lo, hi - size + 1)):
            return True
    return False
