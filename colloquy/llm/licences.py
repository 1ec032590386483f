"""Licence recognition by sentence rules.

Sentences are normalised and looked up in a table of known licence sentences, whatever line breaks, comment
leaders and marks stand inside them; the sequence of identifiers of a text is then matched against ordered rules, each a licence and the identifiers that
must follow one another.
"""

import re
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm.batches import map_rows

#: Known sentences (normalised as by ``normalise``) by identifier.
SENTENCES = {
    "mit-name": ["released under the mit license", "licensed under the mit license", "mit license", "the mit license mit"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "apache-name": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "apache license version 2 0"],
    "apache-terms": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at"],
    "apache-basis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "gpl3-name": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "gnu general public license version 3"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "ccbync-name": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "ccby-name": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-names": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "gpl2-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl2-only": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2 of the license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation"],
    "lgpl21-free": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"],
    "lgpl3-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "lgpl-hope": ["this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "agpl3-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "mpl2-terms": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "unlicense-name": ["this is free and unencumbered software released into the public domain"],
    "ccbysa-name": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "ccbynd-name": ["licensed under cc by nd 4 0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"],
    "all-rights": ["all rights reserved"],
}


@dataclass(frozen=True)
class LicenceRule:
    licence: str
    sequence: tuple[str, ...]


#: Tried in this order at every sentence; the first that fits takes its sentences.
RULES = [
    LicenceRule("MIT", ("mit-name", "all-rights", "mit-grant", "mit-notice", "as-is")),
    LicenceRule("MIT", ("all-rights", "mit-grant", "mit-notice", "as-is")),
    LicenceRule("BSD-3-Clause", ("all-rights", "bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    LicenceRule("BSD-2-Clause", ("all-rights", "bsd-grant", "bsd-source", "bsd-binary")),
    LicenceRule("MIT", ("mit-name", "mit-grant", "mit-notice", "as-is")),
    LicenceRule("MIT", ("mit-grant", "mit-notice", "as-is")),
    LicenceRule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    LicenceRule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    LicenceRule("Apache-2.0", ("apache-name", "apache-terms", "apache-copy", "apache-basis")),
    LicenceRule("Apache-2.0", ("apache-name", "apache-terms")),
    LicenceRule("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    LicenceRule("GPL-3.0-or-later", ("gpl-free",)),
    LicenceRule("GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    LicenceRule("GPL-2.0-or-later", ("gpl2-free",)),
    LicenceRule("GPL-2.0", ("gpl2-only", "gpl-hope")),
    LicenceRule("GPL-2.0", ("gpl2-only",)),
    LicenceRule("LGPL-2.1-or-later", ("lgpl21-free", "lgpl-hope")),
    LicenceRule("LGPL-2.1-or-later", ("lgpl21-free",)),
    LicenceRule("LGPL-3.0-or-later", ("lgpl3-free", "lgpl-hope")),
    LicenceRule("LGPL-3.0-or-later", ("lgpl3-free", "gpl-hope")),
    LicenceRule("LGPL-3.0-or-later", ("lgpl3-free",)),
    LicenceRule("AGPL-3.0-or-later", ("agpl3-free", "gpl-hope")),
    LicenceRule("AGPL-3.0-or-later", ("agpl3-free",)),
    LicenceRule("MPL-2.0", ("mpl2-terms",)),
    LicenceRule("ISC", ("isc-grant",)),
    LicenceRule("Unlicense", ("unlicense-name",)),
    LicenceRule("MIT", ("mit-name",)),
    LicenceRule("MIT", ("mit-grant",)),
    LicenceRule("Apache-2.0", ("apache-name",)),
    LicenceRule("GPL-3.0", ("gpl3-name",)),
    LicenceRule("CC-BY-NC-4.0", ("ccbync-name",)),
    LicenceRule("CC-BY-4.0", ("ccby-name",)),
    LicenceRule("CC-BY-SA-4.0", ("ccbysa-name",)),
    LicenceRule("CC-BY-ND-4.0", ("ccbynd-name",)),
    LicenceRule("All-Rights-Reserved", ("all-rights",)),
]

MATCH = T.StructType(
    [
        T.StructField("licence", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]
)
SCAN = T.StructType(
    [
        T.StructField("sentence_ids", T.ArrayType(T.StringType())),
        T.StructField("matches", T.ArrayType(MATCH)),
        T.StructField("licences", T.ArrayType(T.StringType())),
    ]
)

#: A sentence may end, and the next begin, at a mark before a space or at a line break that ends a paragraph or
#: comes before anything but a small letter.  A known sentence may also run over such places, so wrapped lines,
#: comment leaders, capitals and colons inside it do not cut it.
_ENDS = re.compile(r"""[.!?:;]["'”’)\]]*(?=\s)|\n(?=[^\S\n]*[^a-z\s]|[^\S\n]*\n)""")
_WORD = re.compile(r"[A-Za-z0-9]+")
_OTHER = re.compile(r"[^a-z0-9]+")


def normalise(sentence: str) -> str:
    """Lower case; everything but a-z and 0-9 is one space."""
    return _OTHER.sub(" ", sentence.lower()).strip()


class Recogniser:
    def __init__(self, sentences: dict[str, list[str]] = SENTENCES, rules: list[LicenceRule] = RULES):
        #: The known sentences as a tree of words; the identifier is under the empty word.
        self.tree: dict = {}
        #: Every known sentence has one of these words, so a text without them has none.
        self.anchors: list[str] = []
        known = {normalise(s): i for i, all_ in sentences.items() for s in all_}
        for s in sorted(filter(None, known), key=lambda s: len(s.split())):
            at = self.tree
            for w in s.split():
                at = at.setdefault(w, {})
            at[""] = known[s]
            if not set(s.split()) & set(self.anchors):
                self.anchors.append(max(s.split(), key=len))
        self.rules = rules

    def known(self, text: str) -> list[tuple[str, int, int]]:
        """Identifier, start and end of the known sentences, in order; of overlapping ones the first,
        of those with one start the longest."""
        low = text.lower()
        if not any(a in low for a in self.anchors):
            return []
        found, under_way, at = [], [], 0
        words = ((m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text))
        for word, start, end in chain(words, [(None, len(text), len(text))]):
            plain = text[at:start] == " "
            stops = [] if plain else [m.span() for m in _ENDS.finditer(text, at, min(start + 1, len(text)))]
            if word is None and not stops:
                stops = [(len(text), len(text))]
            if stops:
                a, b = stops[0]
                stop = a if text[a:b] == "\n" else b
                found += [(begun, -stop, tree[""]) for tree, begun in under_way if "" in tree]
            under_way = [(tree[word], begun) for tree, begun in under_way if word in tree]
            if (stops or at == 0) and word in self.tree:
                begun = stops[-1][1] if stops else 0
                begun += len(text[begun : start]) - len(text[begun : start].lstrip())
                under_way.append((self.tree[word], begun))
            at = end
        out = []
        for start, end, i in sorted(found):
            if not out or start >= out[-1][2]:
                out.append((i, start, -end))
        return out

    def __call__(self, text: str | None) -> tuple:
        known = self.known(text or "")
        ids, matches, at = [i for i, _, _ in known], [], 0
        while at < len(known):
            for rule in self.rules:
                n = len(rule.sequence)
                if tuple(ids[at : at + n]) == rule.sequence:
                    matches.append((rule.licence, known[at][1], known[at + n - 1][2]))
                    at += n
                    break
            else:
                at += 1
        return ids, matches, sorted({m[0] for m in matches})


def scanned(
    df: DataFrame, keep: list[str], text: str = "text", sentences: dict[str, list[str]] = SENTENCES,
    rules: list[LicenceRule] = RULES,
) -> DataFrame:
    """``keep`` columns, ``sentence_ids``, ``matches`` (licence, start, end in code points) and
    ``licences`` (each once, sorted), one row per row.

    Null and empty texts have none; other columns are dropped.  Known sentences count as following
    one another whatever stands between them.  Row-local: no shuffle."""

    def make():
        of = Recogniser(sentences, rules)
        return lambda x: [of(x)]

    return map_rows(df, text, keep, SCAN, make)
