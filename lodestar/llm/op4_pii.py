"""Personal data by bootstrapped contextual extraction.

1. *Seeds.*  Emails, IP addresses, payment cards and phone numbers are found
   by fixed expressions in every whole text (leftmost, non-overlapping per
   kind; a match that fails its check is dropped and not tried again).
2. *Patterns.*  A seed, or any other token that looks like an identifier
   (``MIN_DIGITS`` digits or an ``@``), is an instance; the words before it
   (one and two of them, and a ``key=`` or ``key:`` glued to it) are its
   lexical patterns.
3. *Graph.*  Spark scores the pattern-instance graph ``ROUNDS`` times: a
   pattern scores the mean of its distinct instances, damped by ``PRIOR``;
   an instance scores its best pattern; seeds stay at 1.
4. *Discovery.*  An identifier-like token after a pattern with a score of
   ``LEAST_SCORE`` and ``LEAST_SUPPORT`` distinct instances becomes a span of
   kind ``ctx``, unless it overlaps a base span.  Base spans always stay.

The texts are scanned once.  What goes on are rows without text (spans and
pattern-instance pairs, a few per document), stored in the shared folder;
edges are grouped with map-side combining, scores move by equi-joins on the
distinct edges, and no list of patterns or instances reaches the driver.

Defined cases: null text counts as empty; rows are judged one by one, so
repeated rows and null ids keep their own result; an empty table gives an
empty result; other columns are ignored.  Offsets are code points, the end
exclusive.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, documents, stored

KINDS = ("email", "ip", "card", "phone", "ctx")
ROUNDS, PRIOR, LEAST_SCORE, LEAST_SUPPORT, MIN_DIGITS = 3, 2.0, 0.6, 5, 3
PATTERN_CHARS = 48             # longer words are no lexical cue

# The base expressions.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")
_KEYED = re.compile(r"([^\s=:]{2,}[=:])(.+)", re.S)
_EDGE = "\"'`.,;!?()[]{}<>*#&%$"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local@domain, found from each @: the local part is the run
    of its characters before the @, back to the end of the match before."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, in order."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _patterns(text: str, start: int) -> list[str]:
    """The one and two words before ``start`` in its line of words."""
    left = text[max(0, start - 2 * PATTERN_CHARS):start].split()[-2:]
    left = [w.lower() for w in left]
    return [f"w1:{left[-1]}"] + [f"w2:{' '.join(left)}"] * (len(left) == 2) if left else []


def _overlaps(base: list[tuple[int, int, int]], i: int, start: int, end: int) -> bool:
    """Whether a base span from number ``i`` on overlaps [start, end)."""
    while i < len(base) and base[i][0] < end:
        if base[i][2] > start:
            return True
        i += 1
    return False


def instances(text: str, base: list[tuple[int, int, int]]):
    """(start, end, instance, seed, patterns) of seeds and look-alikes."""
    out = [(s, e, text[s:e].lower(), True, _patterns(text, s)) for s, _, e in base]
    if "@" in text or _DIGIT.search(text):
        i = 0
        for m in _TOKEN.finditer(text):
            token = m.group()
            if "@" not in token and sum(map(str.isdigit, token)) < MIN_DIGITS:
                continue
            s = m.start() + len(token) - len(token.lstrip(_EDGE))
            e = m.end() - (len(token) - len(token.rstrip(_EDGE)))
            while i < len(base) and base[i][2] <= s:
                i += 1
            if s >= e or _overlaps(base, i, s, e):
                continue
            found = _patterns(text, m.start())
            keyed = _KEYED.fullmatch(text, s, e)
            if keyed:
                value = keyed.group(2).lstrip(_EDGE)
                found, s = [f"key:{keyed.group(1).lower()[:PATTERN_CHARS]}"], e - len(value)
            if s < e:
                out.append((s, e, text[s:e].lower(), False, found))
    return out


_FOUND = ("doc_id long, base array<struct<s:long,k:int,e:long>>, base_sha256 string, "
          "seen array<struct<s:long,e:long,instance:string,seed:boolean,patterns:array<string>>>")


def _scan(batches):
    span = pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())])
    seen_type = pa.struct([("s", pa.int64()), ("e", pa.int64()), ("instance", pa.string()), ("seed", pa.bool_()),
                           ("patterns", pa.list_(pa.string()))])
    for batch in batches:
        base, sha, seen = [], [], []
        for t in batch.column(1):
            text = t.as_py() or ""
            b = base_spans(text)
            base.append([{"s": s, "k": k, "e": e} for s, k, e in b])
            sha.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in b).encode()).hexdigest())
            seen.append([{"s": s, "e": e, "instance": i, "seed": seed, "patterns": p}
                         for s, e, i, seed, p in instances(text, b) if p])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(base, pa.list_(span)), pa.array(sha, pa.string()), pa.array(seen, pa.list_(seen_type))],
            ["doc_id", "base", "base_sha256", "seen"])


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, score, support) from distinct (pattern, instance, seed) edges."""
    known = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    scored = known.select("instance", F.col("seed").cast("double").alias("s"))
    pairs = edges.select("pattern", "instance")
    for i in range(rounds):
        patterns = pairs.join(scored, "instance").groupBy("pattern").agg(
            (F.sum("s") / (F.count(F.lit(1)) + PRIOR)).alias("score"), F.count(F.lit(1)).alias("support"))
        patterns = stored(patterns, "op4-patterns")
        if i + 1 < rounds:
            strong = patterns.filter(F.col("support") >= LEAST_SUPPORT).select("pattern", "score")
            best = pairs.join(strong, "pattern").groupBy("instance").agg(F.max("score").alias("best"))
            scored = known.join(best, "instance", "left").select(
                "instance", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("s"))
    return patterns


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, base_sha256, added): spans as arrays of (s, k, e)."""
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = stored(src.mapInArrow(_scan, _FOUND).withColumn("row", F.monotonically_increasing_id()), "op4-found")
    seen = found.select("row", F.explode("seen").alias("x")).select("row", "x.*")
    edges = stored(seen.select(F.explode("patterns").alias("pattern"), "instance", "seed")
                   .groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "op4-edges")
    good = score_patterns(edges).filter((F.col("score") >= LEAST_SCORE) & (F.col("support") >= LEAST_SUPPORT))
    added = (seen.filter("not seed").select("row", "s", "e", F.explode("patterns").alias("pattern"))
             .join(good.select("pattern"), "pattern", "left_semi").select("row", "s", "e").distinct()
             .groupBy("row").agg(F.collect_list(F.struct("s", F.lit(KINDS.index("ctx")).alias("k"), "e")).alias("added")))
    empty = F.array().cast("array<struct<s:bigint,k:int,e:bigint>>")
    return found.join(added, "row", "left").select("doc_id", "base", "base_sha256", F.coalesce("added", empty).alias("added"))


def query(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(F.array_sort(F.concat("base", "added")), lambda x: F.concat(
        F.element_at(names, x["k"] + 1), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")))
    count = lambda kind: F.size(F.filter("base", lambda x: x["k"] == KINDS.index(kind))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:4]], "base_sha256",
                        F.concat_ws(",", text).alias("spans"))
