import hashlib
import re
import textwrap
import uuid
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import op2_license, op3_token_ids, op4_pii, op5_decontaminate, op9_sentencepiece
from lodestar.llm.textnum import inside, text_buffer, windows, words
from lodestar.session import shared_dir
from conftest import SF_SMALL
from llm import brute

PATH, MODEL = op3_token_ids.tokenizer_path(), op9_sentencepiece.model_path()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té漢\x0b", max_size=20), max_size=6))
def test_words_and_windows(texts):
    buf, offs = text_buffer(pa.array(texts, pa.string()))
    starts, ends, h, ptr = words(buf, offs)
    raw = buf.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(ptr[:-1], ptr[1:])]
    assert got == [brute.words(t) for t in texts]
    flat = [w for g in got for w in g]
    assert [h[i] == h[0] for i in range(len(flat))] == [w == flat[0] for w in flat]
    win = windows(h, 2)
    pos, row = inside(ptr, 2)
    pairs = [(flat[p], flat[p + 1]) for p in pos]
    assert len({int(win[p]) for p in pos}) == len(set(pairs))


TEXTS = ["Don't WE'LL x's 12,345 a…!b 'tis `` ''s <|endoftext|> y<|startoftext|>", "", "É é ß…\x1cx\x00y ΣΑΣ, ΣΑΣ.",
         "it's,'s 's's !'s '!s a'", " a　b 你好world123４５", "İİ ﬁ é a' ́", "x" * 5000]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aBc's 1,.!<|>\n"), st.characters(blacklist_categories=["Cs"])), max_size=40))
def test_word_ids_equal_the_library(text):
    enc = op3_token_ids.encoder(PATH)
    got = enc(*text_buffer(pa.array([text, "between", text])))
    assert got[0].tolist() == got[2].tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_id_files(spark, monkeypatch):
    monkeypatch.setattr(op3_token_ids, "SHARD_BYTES", 3000)
    monkeypatch.setattr(op3_token_ids, "PART_BYTES", 200_000)
    rows = [(*r[:1], t, *r[2:]) for r, t in zip(brute.sample(SF_SMALL), TEXTS)] + brute.edge_rows(SF_SMALL)[20:]
    out = shared_dir(spark, f"ids-{uuid.uuid4().hex}")
    op3_token_ids.write_ids(brute.frame(spark, rows, True), out, PATH)
    got = op3_token_ids.read_ids(spark, out).collect()
    lib = op3_token_ids.encoder(PATH).tok
    want, each = Counter(), {}
    for i, t, *_ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [op3_token_ids.END_ID]
        want[(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        each[i] = ids
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0                                              # starts follow ascending doc_id, null first
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    for i in (rows[0][0], 1012, 1001):
        assert op3_token_ids.read_document(spark, out, i) == each[i]
    assert op3_token_ids.read_document(spark, out, 10**9) is None


def test_id_files_of_nothing(spark):
    out = shared_dir(spark, f"ids-{uuid.uuid4().hex}")
    op3_token_ids.write_ids(brute.frame(spark, []), out, PATH)
    assert op3_token_ids.read_ids(spark, out).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("the and ing  \n"), st.characters(blacklist_categories=["Cs"], blacklist_characters="▁")), max_size=60))
def test_streaming_viterbi_equals_the_full_search(text):
    p = op9_sentencepiece.pieces(MODEL)
    score = {k: s for k, (s, _) in p.score.items()}
    pieces = brute.viterbi(" " + text, score, p.longest, p.unknown)
    want = [i for x in pieces for i in ([p.score[x][1]] if x in p.score else [p.byte_id[b] for b in x.encode()])]
    assert list(p.stream([" ", text])) == want
    ids, ptr = p.encode(*text_buffer(pa.array([" " + text, " x", " " + text])))
    assert ids[ptr[0]:ptr[1]].tolist() == ids[ptr[2]:ptr[3]].tolist() == want
    assert p.decode(ids, ptr) == [text, "x", text]


def test_stream_keeps_a_bounded_window():
    p = op9_sentencepiece.pieces(MODEL)
    held, given_ = [], 0

    def parts():
        nonlocal given_
        for _ in range(3000):
            given_ += 10
            yield "abcdefghij"
            held.append(given_ - done)

    done = 0
    for i in p.stream(parts()):
        done += len(p.raw[i].decode())
    assert done == 30_000 and max(held) < 40 * p.longest


def test_sentencepiece_round_trip(spark):
    rows = brute.edge_rows(SF_SMALL)
    got = op9_sentencepiece.decoded(op9_sentencepiece.encoded(brute.frame(spark, rows, True), MODEL), MODEL).collect()
    want = Counter((i, (t or "").replace("▁", " ")) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.text) for r in got) == want
    at_once = op9_sentencepiece.encode_and_decode(brute.frame(spark, rows, True), MODEL).collect()
    assert Counter(tuple(r) for r in at_once) == Counter(
        (r.doc_id, r.n_tokens, r.ids_crc32, hashlib.sha256(r.text.encode()).hexdigest(), len(r.text)) for r in got)
    assert op9_sentencepiece.encode_and_decode(brute.frame(spark, []), MODEL).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@1-+ 2(%é", max_size=40))
def test_base_matching(text):
    assert op4_pii.emails(text) == [m.span() for m in EMAIL.finditer(text)]
    assert [m.span() for m in op4_pii._IP.finditer(text)] == [m.span() for m in IP.finditer(text)]


def test_base_spans():
    text = "mail a.b@c.org, ip 10.0.0.255 or 10.0.0.256; card 4111 1111 1111 1111 not 4111 1111 1111 1112; +1 (415) 555-2671 +1"
    got = [(op4_pii.KINDS[k], text[s:e]) for s, k, e in op4_pii.base_spans(text)]
    assert got == [("email", "a.b@c.org"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (415) 555-2671")]
    assert op4_pii.base_spans("9" * 200_000) == [] and op4_pii.base_spans("a" * 200_000 + "@") == []


def test_contexts_find_unseen_identifiers(spark):
    rows = [(5000 + i, f"please write to user{i}@mail{i}.example.org today", "en", "s", 1) for i in range(12)]
    rows += [(5100 + i, f"Ask and write to agent-{i}-{4000 + i} now", "en", "s", 1) for i in range(3)]
    rows += [(5200 + i, f"the price is {5000 + i} coins", "en", "s", 1) for i in range(9)]
    rows += brute.edge_rows(SF_SMALL)
    got = op4_pii.find_personal_data(brute.frame(spark, rows, True)).collect()
    assert len(got) == len(rows)
    text = dict((r[0], r[1]) for r in rows)
    added = {r.doc_id: [text[r.doc_id][x.s:x.e] for x in r.added] for r in got if r.doc_id is not None}
    for i in range(3):
        assert added[5100 + i] == [f"agent-{i}-{4000 + i}"]
    assert all(added[5200 + i] == [] for i in range(9)) and all(added[5000 + i] == [] for i in range(12))
    for r in got:
        if r.doc_id is not None:
            assert [(x.s, x.k, x.e) for x in r.base] == op4_pii.base_spans(text[r.doc_id] or "")
    assert op4_pii.find_personal_data(brute.frame(spark, [])).count() == 0


def test_masks_cover_two_substitutions():
    n = op5_decontaminate.WINDOW
    for a in range(n):
        for b in range(a + 1, n):
            assert any(not ({a - s, b - s} & {j for j, c in enumerate(m) if c == "1"})
                       for m in op5_decontaminate.MASKS for s in range(n - len(m) + 1)), (a, b)


def test_contamination(spark, monkeypatch):
    rows = brute.edge_rows(SF_SMALL)
    source = rows[20][1].split()
    items = [(0, " ".join(source[5:35])), (1, " ".join(source[40:49])), (2, "too short"), (3, None), (None, " ".join(source[60:80]))]
    swap = source[5:35]
    for j in (3, 9, 16, 22, 28):
        swap[j] = "other"
    rows += [(3000, "lead " + " ".join(swap).upper() + "!", None, None, None),
             (3001, " ".join(source[5:16]) + " and now something else", None, None, None),
             (3002, "say " + " ".join(source[40:49]), None, None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter((i, tuple(sorted((k for k, q in items if brute.leaks(t, q)), key=lambda k: (k is None, k or 0)))) for i, t, *_ in rows)
    for size in (1 << 20, 120):                       # one block, then several
        monkeypatch.setattr(op5_decontaminate, "BLOCK_BYTES", size)
        got = op5_decontaminate.contamination(brute.frame(spark, rows, True), bench).collect()
        assert Counter((r.row.doc_id, tuple(r["items"])) for r in got) == want
        assert all(r.contaminated == bool(r["items"]) for r in got)
    assert op5_decontaminate.contamination(brute.frame(spark, []), bench).count() == 0
    none = op5_decontaminate.contamination(brute.frame(spark, rows), bench.limit(0)).filter("contaminated").count()
    assert none == 0


def test_licenses(spark):
    rows = brute.edge_rows(SF_SMALL) + [
        (4000, "text\nThis work is licensed under the GNU General Public License, version 3.\nmore", "en", None, 1),
        (4001, "Released under MIT License, as is", "en", None, 1),
        (4002, "a driving license is needed", "en", None, 1),
        (4003, "long line. " * 400 + "Licensed under CC BY-NC 4.0. " + "more text. " * 400, "en", None, 1)]
    got = {r.doc_id: r for r in op2_license.scan(brute.frame(spark, rows, True)).collect()}
    found = {i: [(x.license, list(x.missing), list(x.added)) for x in got[i].found] for i in (4000, 4001, 4002, 4003)}
    assert found == {4000: [("gpl-3.0", [], [])], 4001: [("mit", ["the"], [])], 4002: [], 4003: [("cc-by-nc-4.0", [], [])]}
    text = dict((r[0], r[1]) for r in rows)
    for name, notice in op2_license.TEMPLATES.items():        # plain search for the exact notices
        for i, t in text.items():
            if i is not None and t and notice in t:
                assert any(x.license.split("-notice")[0] == name.split("-notice")[0] for x in got[i].found), (i, name)
    assert op2_license.scan(brute.frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(op2_license.TEMPLATES))
def test_every_template_wins_on_its_own_wording(name):
    won, share, missing, added = op2_license.classify(op2_license.TEMPLATES[name])
    assert (won, missing, added) == (name, [], []) and share > 0.3


@pytest.mark.parametrize("name", sorted(op2_license.TEMPLATES))
@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_templates_are_found(name, mark):
    notice = "\n".join(textwrap.wrap(op2_license.TEMPLATES[name], 72, initial_indent=mark, subsequent_indent=mark))
    text = f"first words of a file\n\nsome {'other words ' * 30}\n{notice}\nand {'more of them ' * 30}"
    for t in (notice, text):
        _, [(start, end, won, share, missing, added)] = op2_license.notices(t)
        assert (won, missing, added) == (name, [], []) and share > 0.3
        assert t[start:end] == notice[len(mark):]


def test_whole_license_headers():
    mit = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
    bsd = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
"""
    for text, name in ((mit, "mit-notice"), (bsd, "bsd")):
        assert [(x[2], x[4], x[5]) for x in op2_license.notices(text)[1]] == [(name, [], [])]
    # words that agree but lie apart are no notice
    far = "It was released in May " + "and some words " * 8 + "\nunder the " + "other words " * 8 + "\nof a driving license\n"
    assert op2_license.notices(far)[1] == []


NAMES = sorted(op2_license.TEMPLATES)


@pytest.mark.parametrize("between", ["\n", " ", "\n\n", " or, at your choice,\n"])
def test_two_notices_side_by_side(between):
    for a, b in [("mit", "apache-2.0"), ("apache-2.0", "mit"), ("mit", "mit"), ("gpl-2.0", "gpl-3.0"), ("cc-by-4.0", "cc-by-nc-4.0"),
                 ("bsd", "mit-notice"), ("gpl-2.0-notice", "lgpl-3.0-notice")]:
        text = op2_license.TEMPLATES[a] + between + op2_license.TEMPLATES[b]
        got = op2_license.notices(text)[1]
        assert [(x[2], x[4], x[5]) for x in got] == [(a, [], []), (b, [], [])], (a, b)
        assert [text[x[0]:x[1]].rstrip(",") for x in got] == [op2_license.TEMPLATES[a], op2_license.TEMPLATES[b]]


@pytest.mark.parametrize("between", ["\n", " ", "\n* "])
def test_a_list_of_licenses(spark, between):
    text = between.join(op2_license.TEMPLATES[k] for k in NAMES * 3)
    got = op2_license.scan(brute.frame(spark, [(1, text, "en", None, 1)])).collect()[0]
    assert [x.license for x in got.found] == NAMES * 3


def test_a_license_header_is_one_notice():
    gpl = op2_license.TEMPLATES["gpl-2.0-notice"] + """

This program is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with
this program; if not, see <https://www.gnu.org/licenses/>.
"""
    apache = op2_license.TEMPLATES["apache-2.0-notice"] + """
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
    for text, name in ((gpl, "gpl-2.0-notice"), (apache, "apache-2.0-notice")):
        assert [x[2] for x in op2_license.notices(text)[1]] == [name]


@pytest.mark.parametrize("size", [10, 11, 12])
def test_masks_of_short_items_cover_every_accepted_substitution(size):
    most = op5_decontaminate.accepted(size, op5_decontaminate.LEAST_SHARE)
    assert most == 2
    masks = op5_decontaminate.cover(size, most)
    assert all(len(m) == size and m.count("1") == op5_decontaminate.MASKS[0].count("1") for m in masks)
    for n in range(most + 1):
        for gone in combinations(range(size), n):
            assert any(all(m[j] == "0" for j in gone) for m in masks), gone


def test_short_items_with_replaced_words(spark):
    items = [(n, " ".join(f"item{n}x{j}" for j in range(n))) for n in (10, 11, 12)]
    rows = []
    for n, q in items:
        for gone in [c for most in range(4) for c in combinations(range(n), most)]:
            text = " ".join("other" if j in gone else w for j, w in enumerate(q.split()))
            rows.append((len(rows), text if len(gone) % 2 else f"before it {text} and after", None, None, None))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.row.doc_id: list(r["items"]) for r in op5_decontaminate.contamination(brute.frame(spark, rows), bench).collect()}
    want = {i: [k for k, q in items if brute.leaks(t, q)] for i, t, *_ in rows}
    assert got == want and sum(map(len, want.values())) == sum(1 + n + n * (n - 1) // 2 for n in (10, 11, 12))


_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
        "the Free Software Foundation, either {} of the License, or (at your option) any later version.")
LOOK_ALIKES = [
    (_GNU.format("Affero General Public License", "version 3"), "agpl-3.0-notice"),
    (_GNU.format("General Public License", "version 3"), "gpl-3.0-notice"),
    (_GNU.format("General Public License", "version 3.0"), "gpl-3.0-notice"),
    (_GNU.format("General Public License", "version 4"), None),
    (_GNU.format("Lesser General Public License", "version 3"), "lgpl-3.0-notice"),
    (_GNU.format("Library General Public License", "version 2"), "lgpl-2.0-notice"),
    (_GNU.format("General Public License", "version 2"), "gpl-2.0-notice"),
    (_GNU.format("General Public License", "version 1"), "gpl-1.0-notice"),
    ("This work is licensed under the GNU General Public License v3.", "gpl-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "agpl-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "lgpl-2.1"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "lgpl-3.0"),
    ("Licensed under CC BY 4.0.", "cc-by-4.0"),
    ("Licensed under CC BY 3.0.", "cc-by-3.0"),
    ("Licensed under CC BY 5.0.", None),
    ("Licensed under CC BY-ND 4.0.", "cc-by-nd-4.0"),
    ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc-sa-4.0"),
    ("Licensed under CC BY-NC-ND 2.5.", "cc-by-nc-nd-2.5"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by-4.0-notice"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "cc-by-sa-3.0-notice"),
    ("Released under the MIT License.", "mit"),
    ("Released under the terms of the MIT License.", "mit"),
    ("This code is not released under the MIT License.", None),
    ("Released under a license other than the MIT License.", None),
    ("Released under the MIT-0 License.", None),
    ("Released under the ISC License.", "isc"),
    ("Released under the zlib License.", "zlib"),
    ("Released under the BSD 2-Clause License.", "bsd-2-clause"),
    ("Released under the BSD 3-Clause License.", "bsd-3-clause"),
    ("Released under the BSD 4-Clause License.", None),
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("Licensed under the Apache License 2.0.", "apache-2.0"),
    ("Licensed under the Apache License, Version 1.1.", "apache-1.1"),
    ("Licensed under the Apache License, Version 1.0.", None),
    ("SPDX-License-Identifier: MIT", "mit-spdx"),
    ("SPDX-License-Identifier: MIT-0", "mit-0-spdx"),
    ("SPDX-License-Identifier: MIT-Modern-Variant", None),
    ("SPDX-License-Identifier: GPL-2.0", "gpl-2.0-spdx"),
    ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0-only-spdx"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1-or-later-spdx"),
    ("SPDX-License-Identifier: BSD-1-Clause", None),
    ("This is free and unencumbered software released into the public domain.", "unlicense-notice"),
]


@pytest.mark.parametrize("text, name", LOOK_ALIKES)
def test_name_and_version_words_decide(text, name):
    filler = "some other words of a file " * 20
    for t in (text, f"{filler}\n{text}\n{filler}", f"{filler}. {text} {filler}"):
        assert [x[2] for x in op2_license.notices(t)[1]] == [name] * (name is not None)


def test_a_similar_notice_beside_the_right_one():
    affero, plain = LOOK_ALIKES[0][0], LOOK_ALIKES[1][0]
    for a, b in ((affero, plain), (plain, affero)):
        got = [x[2] for x in op2_license.notices(f"{a}\n{b}")[1]]
        assert got == ["agpl-3.0-notice", "gpl-3.0-notice"][::1 if a == affero else -1]
    assert [x[2] for x in op2_license.notices("Never released under the MIT License. Released under the MIT License.")[1]] == ["mit"]


def test_clauses_tell_bsd_licenses_apart():
    two, three, four = (op2_license.TEMPLATES[f"bsd-{n}-clause-notice"] for n in (2, 3, 4))
    for text, name in ((two, "bsd-2-clause-notice"), (three, "bsd-3-clause-notice"), (four, "bsd-4-clause-notice")):
        held = "Copyright (c) 2020, Some One\nAll rights reserved.\n\n" + text.replace("disclaimer. ", "disclaimer.\n2. ", 1)
        assert [x[2] for x in op2_license.notices(held)[1]] == [name]


def test_line_breaks_and_line_length_change_nothing():
    """The same words on one very long line, or one on each line."""
    words = ("plain words here " * 300 + "Released under the new terms of the MIT License and " + "others follow " * 300).split()
    wide, tall = " ".join(words), "\n".join(words)
    assert [x[2:] for x in op2_license.notices(wide)[1]][0][0] == [x[2:] for x in op2_license.notices(tall)[1]][0][0] == "mit"
    assert op2_license.notices(wide)[0] == 1


def test_joined_segments_encode_like_whole_texts():
    enc = op3_token_ids.WordEncoder(op3_token_ids.tokenizer_path())
    texts = ["ÀÉ ß… 漢字 😀 don't ▁ 12,34   end", "e\u0301 \u0301x a\xa0b \ufb01 ½ ²", "İstanbul ǅ \ufeff x", "a\x00b \x01 c\x7fd \x85 e",
             "한국어 가", "'s ' '' n't", "ـــ مرحبا नमस्ते ไทย", "\u3000全角\u3000", "", " "] + [t for _, t, *_ in brute.sample(SF_SMALL) if t]
    buf, offs = text_buffer(pa.array(texts))
    for t, got in zip(texts, enc(buf, offs)):
        assert list(got) == enc.tok.encode(t, add_special_tokens=False).ids
    parts = [t.split()[0].encode() for t in texts if t.strip()] * 40             # more than one call's worth
    assert len(parts) > op3_token_ids.JOINED
    assert enc._encode(parts) == [enc.tok.encode(p.decode(), add_special_tokens=False).ids for p in parts]


def test_a_line_that_many_items_and_documents_share(spark, monkeypatch):
    monkeypatch.setattr(op5_decontaminate, "LAID", 500)           # many slices
    line = " ".join(f"shared{j}" for j in range(13)).split()
    worn = [w if j not in (2, 9) else "other" for j, w in enumerate(line)]
    items = [(i, " ".join([f"a{i}x{j}" for j in range(i % 7)] + line + [f"b{i}x{j}" for j in range(i % 5)])) for i in range(40)]
    rows = [(i, " ".join([f"d{i}x{j}" for j in range(i % 9)] + (line, worn, line[:10], line + ["more"] + line)[i % 4]), None, None, None)
            for i in range(24)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.row.doc_id: list(r["items"]) for r in op5_decontaminate.contamination(brute.frame(spark, rows), bench).collect()}
    assert got == {i: [k for k, q in items if brute.leaks(t, q)] for i, t, *_ in rows} and sum(map(len, got.values())) >= 18 * 40
