"""Row-local operators and extraction, against brute force."""

import hashlib
import random
import re
import textwrap

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from colloquy.llm import bpe, licences, pii_bootstrap, preference, quality_rules

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", " ", "\n\n", "a", "a a a a a a a a a a a a", "é" * 300, "=" * 5000, "x y\n" * 40, "人 人\x0bz\x0c\r"]


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.tokenizer_at(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(tokenizer):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={})


def random_texts(tokenizer, n):
    rng, tokens = random.Random(7), list(tokenizer.ranks)
    for i in range(n):
        kind = i % 5
        size = rng.randrange(250)
        if kind == 0:
            yield "".join(rng.choice("ab ") for _ in range(size))
        elif kind == 1:
            yield rng.choice("a -=é\n\t人") * size
        elif kind == 2:
            yield "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x4E00, 0x5000), rng.randrange(0x1F600, 0x1F650)])) for _ in range(size))
        elif kind == 3:
            yield b"".join(rng.choice(tokens) for _ in range(size // 5)).decode("utf-8", "replace")
        else:
            yield "".join(rng.choice("etaoinshr") for _ in range(size))


def test_tokens_equal_the_library(tokenizer, library):
    for text in random_texts(tokenizer, 1500):
        ids = tokenizer.encode(text)
        assert ids == library.encode_ordinary(text)
        assert tokenizer.decode(ids) == text.encode()


def test_join_of_any_cut_equals_the_whole(tokenizer):
    rng = random.Random(8)
    for _ in range(300):
        data = "".join(rng.choice("etaonsh") for _ in range(rng.randrange(2, 120))).encode()
        cut = rng.randrange(1, len(data))
        sides = [bpe.unpack(x).astype(np.int64) for x in tokenizer.reduce([data[:cut], data[cut:]])]
        ids, size = tokenizer.joined(np.concatenate(sides), np.array([len(x) for x in sides]))
        assert [tokenizer.tokens[i] for i in ids.tolist()] == tokenizer.merge(data) and size.tolist() == [len(ids)]


def test_pieces_of_all_lengths_go_up_the_tree_together(tokenizer, library):
    rng = random.Random(12)
    pieces = ["".join(rng.choice("etaonshé人") for _ in range(n)).encode() for n in [*range(1, 130), 700, 5000]]
    pieces += [b"=" * 4096, b"ab" * 3000, b"=" * 64]
    rng.shuffle(pieces)
    before = tokenizer.joins
    got = [bpe.unpack(x).tolist() for x in tokenizer.reduce(pieces)]
    assert got == [[tokenizer.ranks[t] for t in tokenizer.merge(p)] for p in pieces]
    leaves = 0
    for p in pieces:
        n = 1
        while n * bpe.LEAF < len(p):
            n *= 2
        leaves += n
    assert tokenizer.joins - before == leaves - len(pieces)
    assert tokenizer.reduce([]) == []


def test_given_texts_are_joined(library):
    tokenizer = bpe.Tokenizer(bpe.load_ranks(PATH), public_tokenizers.PATTERN)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    packed = tokenizer.encode_packed([t or "" for t in texts])
    assert [bpe.unpack(x).tolist() for x in packed] == [library.encode_ordinary(t or "") for t in texts]
    assert tokenizer.joins > 1_000


def test_memory_is_bounded_by_bytes(monkeypatch, library):
    tokenizer = bpe.Tokenizer(bpe.load_ranks(PATH), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "REMEMBERED", 10_000)
    for i in range(6):
        text = f"{i}" + "q" * 9_000 + " zq" * 50
        assert tokenizer.encode(text) == library.encode_ordinary(text)
        assert tokenizer._held < 10_000 + 50_000 and len(tokenizer._known) < 30


def test_decoding_concatenates_any_number_of_ids(tokenizer):
    ids = list(range(256)) * 5
    for n in (0, 1, 63, 64, 65, 128, 129, 1000, 1280):
        assert tokenizer.decode(ids[:n]) == b"".join(tokenizer.tokens[i] for i in ids[:n])
    with pytest.raises(KeyError):
        tokenizer.decode([len(tokenizer.ranks) + 7])


def test_bpe_over_a_table(documents, library):
    texts = [*ODD, "Long " * 30_000, "twin", "twin"]
    docs = documents(texts).withColumn("ids", F.lit("clash"))
    rows = {r.doc_id: r for r in bpe.digests(docs, PATH, public_tokenizers.PATTERN, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bpe.encode(docs, PATH, public_tokenizers.PATTERN, ["doc_id"])
    back = {r.doc_id: r.text for r in bpe.decode(encoded, PATH, public_tokenizers.PATTERN, ["doc_id"]).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    assert bpe.digests(documents([]), PATH, public_tokenizers.PATTERN, ["doc_id"]).count() == 0


def slow_measures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(covered),
    }


def test_quality_measures(documents):
    rng = random.Random(9)
    texts = [*ODD, "a b c d e f g h " * 3 + "end"]
    texts += [" ".join(rng.choice("ab\n|é") for _ in range(rng.randrange(60))) for _ in range(60)]
    docs = documents(texts).withColumn("n_words", F.lit("clash"))
    for r in quality_rules.judged(docs, ["doc_id"]).collect():
        slow = slow_measures(texts[r.doc_id])
        assert {k: r[k] for k in slow} == slow
        failed = slow["n_words"] < 20 or 100 * slow["n_repeat_words"] > 30 * slow["n_words"]
        assert r.base_failed == failed and not (failed and r.kept)
    assert quality_rules.judged(documents([]), ["doc_id"]).count() == 0


def test_stop_words_of_known_languages_only(documents):
    texts = [" ".join(f"slowo{i}{x}" for x in "abcdefghijklmnopqrstuvwxyz") for i in range(4)]
    docs = documents(texts).withColumn("lang", F.expr("element_at(array('en', 'pl', null, 'de'), int(doc_id) + 1)"))
    kept = lambda **more: [r.kept for r in quality_rules.judged(docs, ["doc_id"], **more).orderBy("doc_id").collect()]
    assert kept(lang=F.col("lang")) == [False, True, True, False]
    assert kept() == [False] * 4


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits[::-1])]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(BASE).index(s[0])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(10)
    bits = ["a", "b.c", "@", "@x.y", "1", "25", "256", ".", "4111111111111111", "+1", " (555) ", "-", " ", "é", "0", "+"]
    for _ in range(6000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(16)))
        assert pii_bootstrap.base_spans(text) == slow_spans(text), text
    assert pii_bootstrap.base_spans("0" * 6000 + ".1.2.3") == [("ip", 0, 6006)]
    assert pii_bootstrap.base_spans("a" * 200_000 + "@") == []


def test_contexts_find_unseen_identifiers(documents):
    seeds = [f"so my phone is +1 202 555 01{i:02d} okay" for i in range(12)]
    plain = [f"the total of {10_000 + i} units" for i in range(12)]
    texts = [*seeds, *plain, "so my phone is 5550199 okay", None, "", "x " * 50_000, seeds[0]]
    rows = {r.doc_id: r for r in pii_bootstrap.marked(documents(texts).withColumn("base", F.lit(1)), ["doc_id"]).collect()}
    assert [tuple(s) for s in rows[24].found] == [("phone", 15, 22)]
    assert not any(rows[i].found for i in rows if i != 24)
    assert [tuple(s) for s in rows[0].base] == slow_spans(texts[0])
    masked = {r.doc_id: r.text for r in pii_bootstrap.masked(documents(texts)).collect()}
    assert masked[24] == "so my phone is [PHONE] okay" and masked[25] is None and masked[12] == plain[0]
    assert pii_bootstrap.marked(documents([]), ["doc_id"]).count() == 0


def test_contexts_find_numbers_in_groups(documents):
    seeds = [f"so my phone is +1 202 555 01{i:02d} okay" for i in range(60)]
    numbers = ["202 555 0123", "(202) 555-0124", "202.555.0125", "202-555-0126", "[202] 555 0127"]
    texts = [*seeds, *[f"so my phone is {n}, okay" for n in numbers], "so my phone is (202 555 0128) okay"]
    texts += ["so my phone is 2025 550 129, 17 of May", "in 1999 202 555 0130 calls"]
    masked = {r.doc_id: r.text for r in pii_bootstrap.masked(documents(texts)).collect()}
    assert [masked[i] for i in range(60, 65)] == ["so my phone is [PHONE], okay"] * 5
    assert masked[65] == "so my phone is ([PHONE]) okay" and masked[66] == "so my phone is [PHONE], 17 of May"
    assert masked[67] == texts[67]
    found = {r.doc_id: r.found for r in pii_bootstrap.marked(documents(texts), ["doc_id"]).collect()}
    assert all(len(found[i]) == 1 for i in range(60, 67))


def test_patterns_are_trusted_until_none_is_new(spark):
    rows = [("phone", f"s{i}", ["a _"]) for i in range(30)] + [(None, f"u{i}", ["a _"]) for i in range(12)]
    for step in range(5):
        rows += [(None, f"x{step}-{i}", [p]) for i in range(8) for p in (f"{'abcdef'[step]} _", f"{'bcdefg'[step]} _")]
    rows += [("card", f"c{i}", ["mixed _"]) for i in range(4)] + [("ip", f"i{i}", ["mixed _"]) for i in range(4)]
    rows += [("card", f"few{i}", ["common _"]) for i in range(3)] + [(None, f"n{i}", ["common _"]) for i in range(300)]
    rows += [("ip", f"t{i}", ["year _"]) for i in range(4)]
    rows += [(None, f"200{i}", [p]) for i in range(4) for p in ("year _", "in _", "since _", "until _")]
    table = spark.createDataFrame(rows, "kind string, entity string, patterns array<string>")
    trusted = {(r.pattern, r.kind) for r in pii_bootstrap.pattern_worth(table).collect()}
    assert trusted == {(f"{c} _", "phone") for c in "abcdef"}
    assert ("d _", "phone") not in {(r.pattern, r.kind) for r in pii_bootstrap.pattern_worth(table, rounds=2).collect()}


def test_numbers_are_whole_and_linear():
    of = lambda t: [t[a:b] for a, b in pii_bootstrap._numbers(t, pii_bootstrap.base_spans(t))]
    assert of("x 4111 1111-1111 1112. 20 more") == ["4111 1111-1111 1112"]
    assert of("A12 345 678b 90 12") == ["90 12"] and of("12 3") == []
    assert of("call 202 555 0123 192.168.1.1 or 77 88 99") == ["202 555 0123", "77 88 99"]
    assert of("1.1" * 50_000 + "x") == [] and of("12 " * 50_000) == [] and of("(" * 100_000 + "1") == []


def test_mask_joins_overlapping_spans():
    assert pii_bootstrap.mask("ab12cd", [("card", 2, 4), ("ip", 1, 3)]) == "a[IP]cd"


def test_licence_rules(documents):
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
    texts = [
        "Text here.\nReleased under the MIT License.\nMore text.",
        "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License,\nversion 3.",
        "He was licensed under the new law.",
        apache.replace('");', '").\nNow').replace("you may", "You may"),
        None, "", "license " * 40_000, "Released under the MIT License.", "Released under the MIT License.",
    ]
    rows = {r.doc_id: r for r in licences.scanned(documents(texts).withColumn("matches", F.lit(0)), ["doc_id"]).collect()}
    assert [list(rows[i].licences) for i in range(4)] == [["MIT"], ["Apache-2.0", "CC-BY-NC-4.0"], ["GPL-3.0"], []]
    m = rows[0].matches[0]
    assert texts[0][m.start : m.end] == "Released under the MIT License."
    assert [r.sentence_ids for r in (rows[5], rows[6], rows[7])] == [[], [], []]
    assert len(rows) == len(texts) and licences.scanned(documents([]), ["doc_id"]).count() == 0


def test_the_longest_rule_in_order_takes_its_sentences():
    of = licences.Recogniser({"a": ["one two"], "b": ["three"]}, [licences.LicenceRule("AB", ("a", "b")), licences.LicenceRule("A", ("a",))])
    ids, matches, names = of("One, two. Three. One two.\n\nNone.")
    assert ids == ["a", "b", "a"] and [m[0] for m in matches] == ["AB", "A"] and names == ["A", "AB"]


NOTICES = {
    "MIT": """Copyright (c) 2020 Ann Author

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "BSD-3-Clause": """Copyright (c) 2020, Ann Author. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All-Rights-Reserved": "Copyright 2020 Ann Author. All rights reserved.",
}
NOTICES["BSD-2-Clause"] = NOTICES["BSD-3-Clause"].split("\n\n3.")[0]
FREE = """This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version.

This {} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
for licence, what, kind, version, ends in [
    ("GPL-3.0-or-later", "program", "", "3", ":,"), ("GPL-2.0-or-later", "program", "", "2", ";;"),
    ("AGPL-3.0-or-later", "program", "Affero ", "3", ":,"), ("LGPL-2.1-or-later", "library", "Lesser ", "2.1", ";;"),
    ("LGPL-3.0-or-later", "library", "Lesser ", "3", ";;"),
]:
    NOTICES[licence] = FREE.format(what, ends[0], kind, ends[1], version, what)


def slow_known(of, sentences, text):
    """All spans between two places where a sentence may end, the first and longest known ones."""
    places = [(0, 0)]
    for i, c in enumerate(text):
        after = re.match(r"[\"'”’)\]]*", text[i + 1 :])[0]
        if c in ".!?:;" and text[i + 1 + len(after) : i + 2 + len(after)].isspace():
            places.append((i + 1 + len(after), i + 1 + len(after)))
        elif c == "\n":
            line = text[i + 1 :].split("\n")[0].strip()
            if (not line and "\n" in text[i + 1 :]) or (line and not "a" <= line[0] <= "z"):
                places.append((i, i + 1))
    places.append((len(text), len(text)))
    ids = {s: i for i, all_ in sentences.items() for s in all_}
    out, at = [], 0
    for i, (_, start) in enumerate(places):
        for stop, _ in places[: i : -1]:
            whole = text[start:stop]
            words = licences.normalise(whole)
            if start < at or words not in ids or any(
                licences.normalise(text[start:s]) == words for s, _ in places[i + 1 :] if s < stop
            ) or any(start < s <= stop and licences.normalise(text[s:stop]) == words for _, s in places):
                continue
            out.append((ids[words], start + len(whole) - len(whole.lstrip()), stop))
            at = stop
            break
    return out


def wrapped(text, width, leader):
    paragraphs = [textwrap.wrap(p, width, break_long_words=False) for p in text.split("\n\n")]
    return "\n".join((leader + x).rstrip() for i, p in enumerate(paragraphs) for x in ([""] if i else []) + p)


@pytest.mark.parametrize("licence", sorted(NOTICES))
def test_notices_as_they_are_printed(licence):
    of = licences.Recogniser()
    for leader in ("", "# ", " * ", "// ", "-- "):
        for width in (10_000, 79, 60, 37):
            text = "Some words first.\n\n" + wrapped(NOTICES[licence], width, leader) + "\n\nAnd more words."
            ids, matches, names = of(text)
            assert names == [licence] and len(matches) == 1, (leader, width, ids)
            assert of.known(text) == slow_known(of, licences.SENTENCES, text)


def test_known_sentences_equal_brute_force():
    sentences = {"a": ["x y"], "b": ["x y z"], "c": ["z"], "d": ["y z x"]}
    of, rng = licences.Recogniser(sentences, []), random.Random(11)
    for _ in range(4000):
        text = "".join(rng.choice(["x", "y", "z", "X", " ", " ", ". ", "; ", "\n", "\n# ", "\n\n", '."', "é"]) for _ in range(rng.randrange(14)))
        assert of.known(text) == slow_known(of, sentences, text), text


def test_preference_prompts_once(spark):
    said = [(1, 0, "user", "q"), (1, 1, "assistant", "x"), (1, 2, "user", "more"), (1, 3, "assistant", "good"), (1, 4, "user", "ty")]
    said += [(2, 0, "user", "r"), (2, 1, "assistant", "bad"), (3, 0, "user", "alone"), (None, 0, "user", "lost"), (1, None, "user", "lost")]
    said += [(4, 0, None, None), (4, 1, "assistant", None), (1, 0, "user", "q")]
    table = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    rows = {(r.pair, r.part): r for r in preference.formatted(preference.with_other_answers(preference.turns(table))).collect()}
    say = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert rows[1, "prompt"].text == say("user", "q") + say("assistant", "x") + say("user", "more")
    assert rows[1, "rejected"].text == say("assistant", "bad")
    chosen = rows[1, "chosen"]
    assert chosen.text == say("assistant", "good") + say("user", "ty") and rows[1, "prompt"].mask == []
    assert [chosen.text[m.start : m.end] for m in chosen.mask] == ["good<|im_end|>"]
    assert (3, "prompt") not in rows and (4, "chosen") not in rows
    assert rows[4, "prompt"].text == say("user", "") + say("assistant", "")
    assert preference.formatted(preference.with_other_answers(preference.turns(table.limit(0)))).count() == 0


def test_ids_of_any_type_with_both_sides_given(spark):
    say = lambda text: spark.createDataFrame(
        [("a", 0, "user", "q"), ("a", 1, "assistant", text)], "conv_id string, turn long, role string, text string"
    )
    chosen, rejected = preference.turns(say("yes")), preference.turns(say("no"))
    rows = {(r.pair, r.part): r.text for r in preference.formatted(preference.paired(chosen, rejected)).collect()}
    assert set(rows) == {("a", "prompt"), ("a", "chosen"), ("a", "rejected")} and "no" in rows["a", "rejected"]
    with pytest.raises(TypeError, match="paired"):
        preference.with_other_answers(chosen)


def test_long_conversations_come_in_chunks(spark):
    turns = spark.range(50).selectExpr("1L as pair", "id as turn", "struct('assistant' as role, cast(id as string) as text) as chosen")
    pairs = turns.withColumn("rejected", F.when(F.col("turn") < 20, F.col("chosen")))
    rows = preference.formatted(pairs, chunk=8).collect()
    assert sorted((r.part, r.chunk, r.n_turns) for r in rows) == [
        ("chosen", 2, 4), ("chosen", 3, 8), ("chosen", 4, 8), ("chosen", 5, 8), ("chosen", 6, 2),
        ("prompt", 0, 8), ("prompt", 1, 8), ("prompt", 2, 4),
    ]
    for r in rows:
        assert [r.text[m.start : m.end][-10:] for m in r.mask] == ["<|im_end|>"] * (r.n_turns if r.part != "prompt" else 0)
