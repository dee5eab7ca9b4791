"""Licence recognition by sentences and rules.

A text's sentences are normalised and mapped to identifiers of known licence sentences; the sequence
of identifiers is then matched against ordered rules, each a licence and the identifiers it consists
of. Known sentences that no rule uses are reported as such.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import pieces, utf8

BATCH_BYTES = 16 << 20

# Patterns of normalised sentences (lower case, runs of other characters as one space)
# of public licence texts, each with its identifier. A pattern must match the whole sentence.
SENTENCES: list[tuple[str, str]] = [
    ("copyright", r"copyright( c)?( \d{4})+.*"),
    ("all-rights", r"all rights reserved"),
    ("mit-ref", r"(released|licensed|distributed|available) under the (terms of the )?mit licen[sc]e"),
    ("mit-title", r"(the )?mit licen[sc]e( mit)?"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this "
                  r"software and associated documentation files the software to deal in the software "
                  r"without restriction .*"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all "
                   r"copies or substantial portions of the software"),
    ("as-is-mit", r"the software is provided as is without warranty of any kind express or implied .*"),
    ("liability-mit", r"in no event shall the (authors|copyright holders).* be liable for any claim "
                      r"damages or other liability .*"),
    ("apache2-ref", r"(this .* is )?(licensed|released|distributed) under the apache licen[sc]e version "
                    r"2 0( the licen[sc]e)?"),
    ("apache2-title", r"apache licen[sc]e( version 2 0.*)?"),
    ("apache2-comply", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache2-copy", r"you may obtain a copy of the licen[sc]e at.*"),
    ("apache2-as-is", r"unless required by applicable law or agreed to in writing software distributed "
                      r"under the licen[sc]e is distributed on an as is basis .*"),
    ("apache2-see", r"see the licen[sc]e for the specific language governing permissions and "
                    r"limitations under the licen[sc]e"),
    ("gpl3-ref", r"(this .* is )?(licensed|released|distributed) under the gnu general public licen[sc]e "
                 r"version 3( or later)?( 0)?"),
    ("gpl2-ref", r"(this .* is )?(licensed|released|distributed) under the gnu general public licen[sc]e "
                 r"version 2( or later)?( 0)?"),
    ("free-software", r"(.* )?is free software"),
    ("gpl-terms", r"you can redistribute it and or modify it under the terms of the gnu general public "
                  r"licen[sc]e as published by the free software foundation"),
    ("lgpl-terms", r"you can redistribute it and or modify it under the terms of the gnu (lesser|library) "
                   r"general public licen[sc]e as published by the free software foundation"),
    ("agpl-terms", r"you can redistribute it and or modify it under the terms of the gnu affero general "
                   r"public licen[sc]e as published by the free software foundation"),
    ("either-2", r"either version 2 of the licen[sc]e or at your option any later version"),
    ("either-2.1", r"either version 2 1 of the licen[sc]e or at your option any later version"),
    ("either-3", r"either version 3 of the licen[sc]e or at your option any later version"),
    ("gpl2-later", r"you can redistribute it and or modify it under the terms of the gnu general public "
                   r"licen[sc]e as published by the free software foundation either version 2 of the "
                   r"licen[sc]e or at your option any later version"),
    ("gpl3-later", r"you can redistribute it and or modify it under the terms of the gnu general public "
                   r"licen[sc]e as published by the free software foundation either version 3 of the "
                   r"licen[sc]e or at your option any later version"),
    ("lgpl-later", r"you can redistribute it and or modify it under the terms of the gnu (lesser|library) "
                   r"general public licen[sc]e as published by the free software foundation either version "
                   r"2 1 of the licen[sc]e or at your option any later version"),
    ("lgpl3-later", r"you can redistribute it and or modify it under the terms of the gnu lesser general "
                    r"public licen[sc]e as published by the free software foundation either version 3 of "
                    r"the licen[sc]e or at your option any later version"),
    ("agpl-later", r"you can redistribute it and or modify it under the terms of the gnu affero general "
                   r"public licen[sc]e as published by the free software foundation either version 3 of "
                   r"the licen[sc]e or at your option any later version"),
    ("gpl2-only", r"you can redistribute it and or modify it under the terms of the gnu general public "
                  r"licen[sc]e version 2( only)? as published by the free software foundation"),
    ("gpl-implied", r"without even the implied warranty of .*"),
    ("lgpl-ref", r"(this .* is )?(licensed|released|distributed) under the (gnu )?(lgpl|lesser general "
                 r"public licen[sc]e)( version| v)? ?2 1( or later)?"),
    ("lgpl3-ref", r"(this .* is )?(licensed|released|distributed) under the (gnu )?(lgpl|lesser general "
                  r"public licen[sc]e)( version| v)? ?3( 0)?( or later)?"),
    ("agpl3-ref", r"(this .* is )?(licensed|released|distributed) under the (gnu )?(agpl|affero general "
                  r"public licen[sc]e)( version| v)? ?3( 0)?( or later)?"),
    ("lgpl-copy", r"you should have received a copy of the gnu (lesser|library) general public licen[sc]e .*"),
    ("agpl-copy", r"you should have received a copy of the gnu affero general public licen[sc]e .*"),
    ("mpl2-ref", r"this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0"),
    ("mpl2-copy", r"if a copy of the mpl was not distributed with this file you can obtain one at .*"),
    ("mpl2-short", r"(this .* is )?(licensed|released|distributed) under the (mozilla public licen[sc]e|mpl)"
                   r"( version| v)? ?2 0"),
    ("unlicense-free", r"this is free and unencumbered software released into the public domain"),
    ("unlicense-anyone", r"anyone is free to copy modify publish use compile sell or distribute this "
                         r"software .*"),
    ("unlicense-ref", r"(this .* is )?(licensed|released|distributed) under the unlicense"),
    ("cc0-ref", r"(this .* is )?(licensed|released|distributed|dedicated to the public domain) under "
                r"(a |the )?(creative commons )?(cc0|cc zero)( 1 0)?( universal)?( licen[sc]e| public domain "
                r"dedication)?"),
    ("cc0-waiver", r"to the extent possible under law .* (has|have) waived all copyright and related or "
                   r"neighbou?ring rights to .*"),
    ("cc-by-sa-4-ref", r"(this .* is )?(licensed|released|distributed) under (a |the )?(creative commons |"
                       r"cc )(by sa|attribution share ?alike)( 4 0)( international)?( licen[sc]e)?"),
    ("spdx-mit", r"spdx licen[sc]e identifier mit"),
    ("spdx-apache2", r"spdx licen[sc]e identifier apache 2 0"),
    ("spdx-gpl2", r"spdx licen[sc]e identifier gpl 2 0( only)?"),
    ("spdx-gpl2-later", r"spdx licen[sc]e identifier gpl 2 0 or later"),
    ("spdx-gpl3", r"spdx licen[sc]e identifier gpl 3 0( only)?"),
    ("spdx-gpl3-later", r"spdx licen[sc]e identifier gpl 3 0 or later"),
    ("spdx-lgpl21-later", r"spdx licen[sc]e identifier lgpl 2 1 or later"),
    ("spdx-lgpl21", r"spdx licen[sc]e identifier lgpl 2 1( only)?"),
    ("spdx-lgpl3-later", r"spdx licen[sc]e identifier lgpl 3 0 or later"),
    ("spdx-agpl3-later", r"spdx licen[sc]e identifier agpl 3 0 or later"),
    ("spdx-mpl2", r"spdx licen[sc]e identifier mpl 2 0"),
    ("spdx-bsd2", r"spdx licen[sc]e identifier bsd 2 clause"),
    ("spdx-bsd3", r"spdx licen[sc]e identifier bsd 3 clause"),
    ("spdx-isc", r"spdx licen[sc]e identifier isc"),
    ("spdx-cc0", r"spdx licen[sc]e identifier cc0 1 0"),
    ("spdx-unlicense", r"spdx licen[sc]e identifier unlicense"),
    ("gpl-warranty", r"(this program|this file|.*) is distributed in the hope that it will be useful but "
                     r"without any warranty( .*)?"),
    ("gpl-copy", r"you should have received a copy of the gnu general public licen[sc]e .*"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are "
                  r"permitted provided that the following conditions are met"),
    ("bsd-source", r"(\d )?redistributions of source code must retain the above copyright notice .*"),
    ("bsd-binary", r"(\d )?redistributions in binary form must reproduce the above copyright notice .*"),
    ("bsd-names", r"(\d )?neither the name of .* may be used to endorse or promote products derived from "
                  r"this software without specific prior written permission"),
    ("bsd-as-is", r"this software is provided by the .* as is and any express or implied warranties .*"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose with "
                  r"or without fee is hereby granted provided that the above copyright notice and this "
                  r"permission notice appear in all copies"),
    ("cc-by-nc-4-ref", r"(this .* is )?(licensed|released|distributed) under (a |the )?(creative commons |"
                       r"cc )(by nc|attribution noncommercial)( 4 0)( international)?( licen[sc]e)?"),
    ("cc-by-4-ref", r"(this .* is )?(licensed|released|distributed) under (a |the )?(creative commons |"
                    r"cc )(by|attribution)( 4 0)( international)?( licen[sc]e)?"),
]

# Licences and the sentence identifiers they consist of, in order; the first rule that
# fits at a place is taken, so longer ones stand before their parts.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit-grant", "mit-notice", "as-is-mit", "liability-mit")),
    ("MIT", ("mit-grant", "mit-notice", "as-is-mit")),
    ("Apache-2.0", ("apache2-ref", "apache2-comply", "apache2-copy", "apache2-as-is", "apache2-see")),
    ("Apache-2.0", ("apache2-ref", "apache2-comply", "apache2-copy")),
    ("GPL-2.0-or-later", ("free-software", "gpl2-later")),
    ("GPL-2.0-or-later", ("free-software", "gpl-terms", "either-2")),
    ("GPL-3.0-or-later", ("free-software", "gpl3-later")),
    ("GPL-3.0-or-later", ("free-software", "gpl-terms", "either-3")),
    ("GPL-2.0", ("free-software", "gpl2-only")),
    ("LGPL-2.1-or-later", ("free-software", "lgpl-later")),
    ("LGPL-2.1-or-later", ("free-software", "lgpl-terms", "either-2.1")),
    ("LGPL-3.0-or-later", ("free-software", "lgpl3-later")),
    ("LGPL-3.0-or-later", ("free-software", "lgpl-terms", "either-3")),
    ("AGPL-3.0-or-later", ("free-software", "agpl-later")),
    ("AGPL-3.0-or-later", ("free-software", "agpl-terms", "either-3")),
    ("MPL-2.0", ("mpl2-ref", "mpl2-copy")),
    ("Unlicense", ("unlicense-free", "unlicense-anyone")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("ISC", ("isc-grant",)),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-title",)),
    ("Apache-2.0", ("apache2-ref",)),
    ("Apache-2.0", ("apache2-title",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("GPL-2.0", ("gpl2-ref",)),
    ("LGPL-2.1", ("lgpl-ref",)),
    ("LGPL-3.0", ("lgpl3-ref",)),
    ("AGPL-3.0", ("agpl3-ref",)),
    ("MPL-2.0", ("mpl2-ref",)),
    ("MPL-2.0", ("mpl2-short",)),
    ("Unlicense", ("unlicense-free",)),
    ("Unlicense", ("unlicense-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("CC0-1.0", ("cc0-waiver",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-ref",)),
    ("MIT", ("spdx-mit",)),
    ("Apache-2.0", ("spdx-apache2",)),
    ("GPL-2.0", ("spdx-gpl2",)),
    ("GPL-2.0-or-later", ("spdx-gpl2-later",)),
    ("GPL-3.0", ("spdx-gpl3",)),
    ("GPL-3.0-or-later", ("spdx-gpl3-later",)),
    ("LGPL-2.1", ("spdx-lgpl21",)),
    ("LGPL-2.1-or-later", ("spdx-lgpl21-later",)),
    ("LGPL-3.0-or-later", ("spdx-lgpl3-later",)),
    ("AGPL-3.0-or-later", ("spdx-agpl3-later",)),
    ("MPL-2.0", ("spdx-mpl2",)),
    ("BSD-2-Clause", ("spdx-bsd2",)),
    ("BSD-3-Clause", ("spdx-bsd3",)),
    ("ISC", ("spdx-isc",)),
    ("CC0-1.0", ("spdx-cc0",)),
    ("Unlicense", ("spdx-unlicense",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-ref",)),
    ("CC-BY-4.0", ("cc-by-4-ref",)),
]

# Every known sentence has one of these, so a text without any needs no further look.
HINT = re.compile(rb"licen[sc]e|copyright|permission|redistribut|free software|warrant|all\s+rights|"
                  rb"liable|under\s|mozilla|mpl was|public domain|free to copy|waived", re.IGNORECASE)
# Rules name identifiers; these may stand between the sentences of one licence or behind them.
FILLERS = {"copyright", "all-rights", "gpl-warranty", "gpl-implied", "gpl-copy", "lgpl-copy", "agpl-copy"}
# Not behind "Identifier:" and "v.", which stand within a sentence of licences.
SENTENCE_END = re.compile(r"(?<=[.!?;:])(?<!dentifier:)(?<! v\.)\s+")
# How a known sentence over several lines can begin, besides with any words, as before "is free software":
# those are tried from the beginning of a sentence only, which finds them all the same.
HEAD = re.compile(
    r"copyright |all rights|(this .* is )?(released|licen[sc]ed|distributed|available|dedicated) |(the )?mit licen|"
    r"permission |the above copyright|the software is|in no event|this .* is |apache licen|you (may|should) |"
    r"unless required|see the licen|redistribution|\d |neither the name|this (software|source|is free)|if a copy of|"
    r"anyone is free|to the extent possible|spdx licen")
HEAD_WORDS = 6      # words of a line and those after it that are held against HEAD
OTHER = re.compile(r"[^a-z0-9]+")
PARAGRAPH = re.compile(r"\n\s*\n")


def normalise(sentence: str) -> str:
    return OTHER.sub(" ", sentence.lower()).strip()


def sentence_ids(text: str, known: Sequence[tuple[str, re.Pattern]]) -> list[str]:
    """Identifiers of the known sentences of a text, in order.

    A sentence may stand in one line or run over the lines of a paragraph; lines are looked at first,
    and the lines that a longer sentence spans are not looked at again. Lines are joined where a sentence
    begins or its first words are those of a known one, so a paragraph of many lines without a stop is
    not joined again from each of its lines.
    """
    found: list[str] = []
    for paragraph in PARAGRAPH.split(text):
        lines = [s for line in paragraph.split("\n") for s in SENTENCE_END.split(line)]
        pieces_ = [normalise(s) for s in lines]
        ends = [s.rstrip()[-1:] in ".!?;:" and bool(s.strip()) for s in lines]
        last_of = list(range(len(lines)))
        for at in range(len(lines) - 2, -1, -1):
            last_of[at] = at if ends[at] else last_of[at + 1]
        at, begins = 0, True
        while at < len(pieces_):
            last = last_of[at]
            name, taken = _known(pieces_[at], known), at
            if not name and last > at and pieces_[at] and (begins or HEAD.match(_head(pieces_, at, last))):
                name, taken = _known(" ".join(p for p in pieces_[at:last + 1] if p), known), last
            if name:
                found.append(name)
            begins = bool(name) or ends[at] or (begins and not pieces_[at])
            at = taken + 1 if name else at + 1
    return found


def _head(pieces_: list[str], at: int, last: int) -> str:
    """The first words from a line on, as far as its sentence goes."""
    words: list[str] = []
    while at <= last and len(words) < HEAD_WORDS:
        words += pieces_[at].split()
        at += 1
    return " ".join(words[:HEAD_WORDS]) + " "


def _known(sentence: str, known: Sequence[tuple[str, re.Pattern]]) -> str | None:
    if not sentence:
        return None
    for name, pattern in known:
        if pattern.fullmatch(sentence):
            return name
    return None


def apply_rules(ids: Sequence[str], rules: Sequence[tuple[str, tuple[str, ...]]]) -> tuple:
    """(licences, unused): licences in order of appearance, and identifiers that no rule took."""
    licences, unused, at = [], [], 0
    body = [i for i in ids if i not in FILLERS]
    while at < len(body):
        for licence, want in rules:
            if tuple(body[at:at + len(want)]) == want:
                licences.append(licence)
                at += len(want)
                break
        else:
            unused.append(body[at])
            at += 1
    return licences, unused


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  sentences: Sequence[tuple[str, str]] = tuple(SENTENCES),
                  rules: Sequence[tuple[str, tuple[str, ...]]] = tuple(RULES)) -> DataFrame:
    """(id, sentences, licences, unused): one row per input row, as arrays of strings.

    `sentences` are the identifiers found in order, `licences` the distinct licences of the rules that
    fit, sorted, `unused` known sentences outside any rule. A null or empty text has none. Repeated
    rows are scanned alike, ids may be null, other columns are not read, an empty table gives no rows.
    Whole texts are read. With own `sentences` the look for hints is left out.
    """
    hinted = list(sentences) == SENTENCES
    table, order = list(sentences), list(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(name, re.compile(pattern)) for name, pattern in table]
        for batch in pieces(batches, BATCH_BYTES):
            ids, licences, unused = [], [], []
            for text in batch.column(1):
                value = text.as_py()
                names = [] if hinted and not HINT.search(value) else sentence_ids(
                    value.decode("utf-8", "replace"), known)
                fits, rest = apply_rules(names, order)
                ids.append(names)
                licences.append(sorted(set(fits)))
                unused.append(rest)
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, strings), pa.array(licences, strings),
                 pa.array(unused, strings)], ["id", "sentences", "licences", "unused"])

    rows = docs.select(F.col(id_col).alias("id"), utf8(F.col(text_col)).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, sentences array<string>, licences array<string>, "
                                "unused array<string>")
