"""License scan by conditional compression.

1. *Candidates.*  Every line of every whole text that holds a cue word
   belongs to a candidate block; adjoining such lines form one block.  Each cue
   is judged with ``REACH`` words on both sides, wherever lines break.  Of the
   templates only those whose name and version words all stand there, and
   enough of whose words do to be confirmed, go on: an exact bound.
2. *Rank.*  These words are compressed by themselves and with each such
   template as a raw zstandard dictionary.  What the template takes off the
   size, as a share, ranks the templates: the more of the wording it explains,
   the smaller the result.
3. *Confirm.*  The ranked templates are laid beside the words one by one, in
   rank order; those within ``NEAR_SHARE`` of the best reduction compete and
   the fewest differing words win; where none of them is confirmed, the next
   ones do.  The winner counts when at least ``LEAST_MATCH`` of its words stand
   there in order, the words added between them are few (``FREE_WORDS``, or the
   share that may be missing), and no name or version word is missing or added:
   such a word means another license (Affero, Lesser, NC, ND, SA, version 1).
   A denied notice ("not released under ...") is none.  An SPDX line must be
   whole.  The words missing and added are returned as the exact differences
   in wording.
4. *Go on.*  The winner's stretch is taken out and the words before and after
   it are ranked and confirmed anew until nothing is confirmed: a text holds as
   many notices as stand in it, however close.

Everything happens in the scan; nothing is shuffled and only the templates
(a fixed list) travel to the tasks.

Defined cases: null and empty texts have no block; rows are judged one by
one, repeated or not; ties between templates go to the fewest differences,
then the name; an empty table gives an empty result; other columns are
ignored; a license outside the templates has no name rather than a similar
one.  Spans run from a notice's first to its last word that stands in the
template, with the punctuation after it; offsets are code points, the end
exclusive.
"""

from __future__ import annotations

import difflib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import bounded_batches, documents

# Notices of common licenses.
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the " \
       "following conditions are met"
_BSD_2 = _BSD + ": Redistributions of source code must retain the above copyright notice, this list of conditions and the " \
                "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of " \
                "conditions and the following disclaimer in the documentation and/or other materials provided with the " \
                "distribution."
_BSD_ADS = " All advertising materials mentioning features or use of this software must display the following acknowledgement"
_BSD_NAMES = " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote " \
             "products derived from this software without specific prior written permission."
TEMPLATES = {
    "0bsd-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                   "hereby granted.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                       "Affero General Public License as published by the Free Software Foundation, either version 3 of "
                       "the License, or (at your option) any later version.",
    "apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License.",
    "artistic-2.0": "Licensed under the Artistic License, Version 2.0.",
    "bsd": _BSD,
    "bsd-2-clause": "Released under the BSD 2-Clause License.",
    "bsd-2-clause-notice": _BSD_2,
    "bsd-3-clause": "Released under the BSD 3-Clause License.",
    "bsd-3-clause-notice": _BSD_2 + _BSD_NAMES,
    "bsd-4-clause-notice": _BSD_2 + _BSD_ADS + _BSD_NAMES,
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "cc0-1.0": "To the extent possible under law, the author has dedicated all copyright to the public domain.",
    "epl-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
               "v1.0.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
               "2.0.",
    "gpl-1.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation; either version 1, or (at your "
                      "option) any later version.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation; either version 2 of the "
                      "License, or (at your option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the "
                      "License, or (at your option) any later version.",
    "isc": "Released under the ISC License.",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-2.0-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                       "Library General Public License as published by the Free Software Foundation; either version 2 of "
                       "the License, or (at your option) any later version.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                       "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                       "the License, or (at your option) any later version.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-3.0-notice": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                       "Lesser General Public License as published by the Free Software Foundation, either version 3 of "
                       "the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files",
    "mpl-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-notice": "This is free and unencumbered software released into the public domain.",
    "zlib": "Released under the zlib License.",
    "zlib-notice": "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
                   "and to alter it and redistribute it freely",
}
_CC_WORDS = {"by": "Attribution", "nc": "NonCommercial", "nd": "NoDerivatives", "sa": "ShareAlike"}
_CC_SCOPE = {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
CC_KINDS = ("by", "by-nc", "by-nc-nd", "by-nc-sa", "by-nd", "by-sa")
for _kind in CC_KINDS:
    for _version, _scope in _CC_SCOPE.items():
        _long = "-".join(_CC_WORDS[x] for x in _kind.split("-"))
        TEMPLATES[f"cc-{_kind}-{_version}"] = f"Licensed under CC {_kind.upper()} {_version}."
        TEMPLATES[f"cc-{_kind}-{_version}-notice"] = (
            f"This work is licensed under a Creative Commons {_long} {_version} {_scope} License.")
# Identifiers of the SPDX list.
SPDX = ("0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 "
        "CC0-1.0 CDDL-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 "
        "GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only "
        "LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 Unlicense Zlib")
TEMPLATES |= {f"{x.lower()}-spdx": f"SPDX-License-Identifier: {x}"
              for x in (*SPDX.split(), *(f"CC-{k.upper()}-{v}" for k in CC_KINDS for v in _CC_SCOPE))}
# Words that name a license (versions count besides), words that deny one.
NAMES = frozenset("0bsd affero agpl apache artistic attribution boost bsd bsl cc cc0 cddl creative eclipse epl eupl gnu gpl isc lesser "
                  "lgpl mit mozilla mpl nc nd noderivatives noderivs noncommercial sa sharealike spdx unlicense zlib "
                  "advertising endorse".split()) | {"gnu library"}
DENIALS = frozenset("not never nor isn wasn aren than except unlike".split())
CUES = ("licen", "copyright", "permission", "redistribut", "warrant", "public domain", "unencumbered", "creative commons", "cc by", "cc0")

LEAST_MATCH, NEAR_SHARE, FREE_WORDS = 0.8, 0.15, 4
LEVEL = 19
STORED = 20_000              # distinct cue lines with the words around remembered per worker

_WORDS = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")
_VERSION = re.compile(r"v?(\d+(?:\.\d+)*?)(?:\.0)*")
_STOP = re.compile(r"[.;!?](?:\s|$)")


def keys(words: list[str]) -> list[str]:
    """What makes lower-cased words the same: a version is its number ("v3",
    "3.0", or "3" after "version" or before "clause"), and the GNU Library
    license isn't any library."""
    out = list(words)
    for i, w in enumerate(words):
        if w[0] in "v0123456789":
            m = _VERSION.fullmatch(w)
            if m and (w[0] == "v" or "." in w or words[i - 1:i] in (["version"], ["v"]) or words[i + 1:i + 2] == ["clause"]):
                out[i] = "#" + m[1]
        elif w == "library" and words[i - 1:i] == ["gnu"]:
            out[i] = "gnu library"
    return out


def names(key: str) -> bool:
    return key in NAMES or key[0] == "#"


_COMPRESS: dict[str | None, zstandard.ZstdCompressor] = {}
_TEMPLATE_WORDS = {k: _WORDS.findall(t.lower()) for k, t in TEMPLATES.items()}
_KEYS = {k: keys(w) for k, w in _TEMPLATE_WORDS.items()}
_COUNTS = {k: Counter(w) for k, w in _KEYS.items()}
_NAMED = {k: frozenset(filter(names, w)) for k, w in _KEYS.items()}
# words of a template that must stand in order
_LEAST = {k: len(w) if k.endswith("-spdx") else math.ceil(LEAST_MATCH * len(w)) for k, w in _KEYS.items()}
# the longest stretch that a template may fill around a cue
REACH = math.ceil((2 - LEAST_MATCH) * max(map(len, _KEYS.values())))


def _size(block: bytes, name: str | None) -> int:
    if name not in _COMPRESS:
        data = None if name is None else zstandard.ZstdCompressionDict(
            TEMPLATES[name].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        _COMPRESS[name] = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False)
    return len(_COMPRESS[name].compress(block))


def aligned(template: list[str], words: list[str]):
    """((template place, word place) of the words in order, start, end of the
    stretch), or None without a common word."""
    runs = [r for r in difflib.SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks() if r.size]
    best = None
    for i in range(len(runs)):             # a far word that happens to agree isn't part of the stretch
        same = 0
        for j in range(i, len(runs)):
            same += runs[j].size
            start, end = runs[i].b, runs[j].b + runs[j].size
            cost = end - start - 3 * same  # words missing and added against words in order
            if best is None or (cost, -same) < best[:2]:
                best = cost, -same, i, j, start, end
    if best is None:
        return None
    _, _, i, j, start, end = best
    return [(r.a + k, r.b + k) for r in runs[i:j + 1] for k in range(r.size)], start, end


def _possible(found: Counter) -> list[str]:
    """Templates that could be confirmed among words with these counts."""
    have = found.keys()
    return [t for t, named in _NAMED.items() if named <= have
            and sum(min(n, found[w]) for w, n in _COUNTS[t].items()) >= _LEAST[t]]


def _denied(raw: str, spans: list[tuple[int, int]], words: list[str], start: int) -> bool:
    """A denial among the three words before, in the same sentence."""
    return any(words[i] in DENIALS and not _STOP.search(raw, spans[i][1], spans[start][0]) for i in range(max(0, start - 3), start))


def _confirmed(name: str, raw: str, spans, words, found):
    """(missing, added, words in order, start, end) of the template's first
    stretch that counts, or None.  ``found``: the keys of ``words``."""
    template, least = _KEYS[name], _LEAST[name]
    spare = 0 if name.endswith("-spdx") else max(FREE_WORDS, len(template) - least)
    left = [(0, len(words))]
    while left:
        a, b = left.pop()
        match = aligned(template, found[a:b]) if b - a >= least else None
        if match is None or len(match[0]) < least:
            continue
        pairs, start, end = [(t, w + a) for t, w in match[0]], match[1] + a, match[2] + a
        lost = sorted(set(range(len(template))) - {t for t, _ in pairs})
        new = sorted(set(range(start, end)) - {w for _, w in pairs})
        x, y = spans[start][0], spans[end - 1][1]
        part = raw[x - 1:x] == "-" or (raw[y:y + 1] == "-" and end < len(words) and spans[end][0] == y + 1)
        part = part or any(raw[spans[i][1]:spans[i + 1][0]] == "-" and (names(found[i]) or names(found[i + 1]))
                           for w in new for i in (w - 1, w))        # "MIT-0" isn't MIT
        if (len(new) <= spare and not part and not any(names(template[t]) for t in lost)
                and not any(names(found[w]) or found[w] in DENIALS for w in new) and not _denied(raw, spans, words, start)):
            spelt = [(t, w) for t, w in pairs if _TEMPLATE_WORDS[name][t] != words[w]]     # "v3" for "3"
            return ([_TEMPLATE_WORDS[name][t] for t in sorted([*lost, *(t for t, _ in spelt)])],
                    [words[w] for w in sorted([*new, *(w for _, w in spelt)])], len(pairs), start, end)
        left += [(end, b), (a, start)]     # another license, or denied: it may stand elsewhere
    return None


@lru_cache(maxsize=STORED)
def _winner(raw: str):
    """(license, missing, added, start, end) of the best confirmed notice among
    the words of ``raw``, or None."""
    spans = [m.span() for m in _WORDS.finditer(raw)]
    words = [raw[a:b].lower() for a, b in spans]
    found = keys(words)
    able = _possible(Counter(found))
    if not able:
        return None
    data = raw.encode()
    plain = _size(data, None)
    best, won = None, []
    for share, name in sorted(((plain - _size(data, t)) / plain, t) for t in able)[::-1]:
        if best is None or share < best - NEAR_SHARE:
            if won:
                break
            best = share                   # nothing confirmed so far: the next ones compete
        match = _confirmed(name, raw, spans, words, found)
        if match:
            missing, added, same, start, end = match
            # a longer notice explains more words, so matched words count against differences
            won.append((len(missing) + len(added) - same, name, missing, added, start, end))
    return min(won)[1:] if won else None


def _reduction(stretch: str, name: str) -> float:
    plain = _size(stretch.encode(), None)
    return (plain - _size(stretch.encode(), name)) / plain


def classify(block: str):
    """(license, reduction, missing, added) of a block, or None."""
    won = _winner(block)
    return won and (won[0], _reduction(block, won[0]), *won[1:3])


def notices(text: str) -> tuple[int, list[tuple]]:
    """(number of blocks, [(start, end, license, reduction, missing, added)])."""
    lines = cue_lines(text)
    if not lines:
        return 0, []
    spans = [m.span() for m in _WORDS.finditer(text)]
    starts, ends = [a for a, _ in spans], [b for _, b in spans]
    out, done = [], 0                      # words before ``done`` belong to a notice already
    for _, _, a, b in lines:
        lo, hi = max(bisect_right(ends, a), done), bisect_left(starts, b)
        if lo >= hi:
            continue
        pieces = [(max(lo - REACH, done), min(hi + REACH, len(spans)))]
        while pieces:
            p, q = pieces.pop()
            if p >= q or q <= lo or p >= hi:
                continue                   # no word of the cue is left
            won = _winner(text[starts[p]:ends[q - 1]])
            if won is None:
                continue
            name, missing, added, first, last = won
            first, last = first + p, last + p
            pieces += [(last, q), (p, first)]
            if last <= lo or first >= hi:
                continue                   # a notice elsewhere comes up with its own cue
            done = max(done, last)
            x, y = starts[first], ends[last - 1]
            while y < len(text) and not text[y].isalnum() and not text[y].isspace():
                y += 1
            out.append((x, y, name, _reduction(text[x:y], name), missing, added))
    return len(merged(lines)), sorted(out)


def cue_lines(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, from, to) of every cue: its line and its own place."""
    low = text.lower()
    at = sorted({(i, i + len(cue)) for cue in CUES for i in _all(low, cue)})
    if not at:
        return []
    if len(low) != len(text):              # a letter changed its length: look again, place by place
        at = sorted({m.span() for cue in CUES for m in re.finditer(re.escape(cue), text, re.I)})
    out: list[tuple[int, int, int, int]] = []
    start = end = -1
    for i, j in at:
        if out and i < out[-1][3]:
            continue
        if i >= end:
            end = text.find("\n", i)
            start, end = text.rfind("\n", 0, i) + 1, len(text) if end < 0 else end
        out.append((start, end, i, j))
    return out


def merged(lines) -> list[tuple[int, int]]:
    """Adjoining (or the same) lines as one block."""
    out: list[list[int]] = []
    for start, end, *_ in lines:
        if out and start <= out[-1][1] + 1:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of candidate blocks."""
    return merged(cue_lines(text))


def _all(text: str, cue: str):
    i = text.find(cue)
    while i >= 0:
        yield i
        i = text.find(cue, i + 1)


_FOUND = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("reduction", pa.float64()),
                    ("missing", pa.list_(pa.string())), ("added", pa.list_(pa.string()))])
_FOUND_NAMES = [f.name for f in _FOUND]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_blocks, found): confirmed notices of every row, with span,
    license, size reduction and differences in wording."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            n, found = [], []
            for t in batch.column(1):
                held, rows = notices(t.as_py() or "")
                n.append(held)
                found.append([dict(zip(_FOUND_NAMES, x)) for x in rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(found, pa.list_(_FOUND))],
                                             ["doc_id", "n_blocks", "found"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_blocks long, found array<struct<start:long,end:long,license:string,reduction:double,"
             "missing:array<string>,added:array<string>>>")


def query(spark, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    named = lambda f: F.concat_ws(",", F.transform("found", f))
    return found.select(
        "doc_id", "n_blocks", F.size("found").cast("long").alias("n_licenses"),
        named(lambda x: x["license"]).alias("licenses"),
        named(lambda x: F.concat(x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))).alias("spans"),
        named(lambda x: F.concat_ws(" ", F.transform(x["missing"], lambda w: F.concat(F.lit("-"), w)),
                                    F.transform(x["added"], lambda w: F.concat(F.lit("+"), w)))).alias("differences"))
