import re

import pytest

from ledgersift.llm.licence_rules import (
    HINT, RULES, SENTENCES, apply_rules, normalise, scan_licences, sentence_ids)

MIT = """MIT License

Copyright (c) 2019 Some Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use it.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING MERCHANTABILITY.
"""

TEXTS = [
    ("Text.\nReleased under the MIT License.", ["mit-ref"], ["MIT"], []),
    ("no full stop\nLicensed under the Apache License, Version 2.0.", ["apache2-ref"], ["Apache-2.0"], []),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl3-ref"], ["GPL-3.0"], []),
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4-ref"], ["CC-BY-NC-4.0"], []),
    ("Copyright 2020 X. All rights reserved.", ["copyright", "all-rights"], [], []),
    (MIT, ["mit-title", "copyright", "mit-grant", "mit-notice", "as-is-mit"], ["MIT"], []),
    ("Our license to operate was under review.", [], [], []),
    ("You may obtain a copy of the License at http://x.", ["apache2-copy"], [], ["apache2-copy"]),
    ("Released under\nthe MIT license.", ["mit-ref"], ["MIT"], []),
    (None, [], [], []), ("", [], [], [])]


@pytest.mark.parametrize("text,ids,licences,unused", TEXTS)
def test_sentences_and_rules(text, ids, licences, unused):
    known = [(name, re.compile(p)) for name, p in SENTENCES]
    found = sentence_ids(text or "", known)
    assert found == ids
    got = apply_rules(found, RULES)
    assert (sorted(set(got[0])), got[1]) == (licences, unused)


def test_whole_table(spark, make_docs, edges):
    rows = [(i, t[0], "a") for i, t in enumerate(TEXTS)]
    got = {r.id: (list(r.sentences), list(r.licences), list(r.unused))
           for r in scan_licences(make_docs(rows)).collect()}
    assert got == {i: tuple(t[1:]) for i, t in enumerate(TEXTS)}
    docs = make_docs(edges)
    assert all(not r.licences for r in scan_licences(docs).collect())
    assert scan_licences(docs).count() == len(edges) and scan_licences(docs.limit(0)).count() == 0


def test_sentence_at_the_end_of_a_long_text(make_docs):
    text = "word and more words. " * 50_000 + "\nReleased under the MIT License."
    assert scan_licences(make_docs([(1, text, "a")])).first().licences == ["MIT"]


def test_every_known_sentence_has_a_hint():
    """The look for hints leaves no known sentence out: it fits each pattern's fixed words."""
    for name, pattern in SENTENCES:
        plain = pattern.replace("licen[sc]e", "license")
        assert HINT.search(re.sub(r"[()|?*+.\\]", " ", plain).encode()), name


def test_longer_rules_come_first():
    for k, (_, want) in enumerate(RULES):
        for _, earlier in RULES[:k]:
            assert want[:len(earlier)] != earlier or len(earlier) >= len(want)


def test_normalise():
    assert normalise("  The  MIT-License, v. 2.0! ") == "the mit license v 2 0"


GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU {name}General Public License as published by
the Free Software Foundation; either version {version} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY.
"""


@pytest.mark.parametrize("text,licence", [
    (GPL.format(name="", version="2"), "GPL-2.0-or-later"),
    (GPL.format(name="", version="3"), "GPL-3.0-or-later"),
    (GPL.format(name="Lesser ", version="2.1"), "LGPL-2.1-or-later"),
    (GPL.format(name="Lesser ", version="3"), "LGPL-3.0-or-later"),
    (GPL.format(name="Affero ", version="3"), "AGPL-3.0-or-later"),
    ("Released under the GNU LGPL v2.1", "LGPL-2.1"), ("Licensed under the AGPL v3.0.", "AGPL-3.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the "
     "MPL was not distributed with this\nfile, You can obtain one at https://example.org/MPL/2.0/.", "MPL-2.0"),
    ("SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"),
    ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("// SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("Licensed under CC0 1.0 Universal.", "CC0-1.0"),
    ("To the extent possible under law, Some Person has waived all copyright and\nrelated or neighboring rights to "
     "this work.", "CC0-1.0"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("A heading without a stop\nLicensed under the\nApache License, Version 2.0.", "Apache-2.0"),
    ("first line\nsecond line\nThe Tool is free software; you can\nredistribute it", None)])
def test_further_licences(make_docs, text, licence):
    known = [(name, re.compile(p)) for name, p in SENTENCES]
    got = set(apply_rules(sentence_ids(text, known), RULES)[0])
    assert got == ({licence} if licence else set())
    if licence:
        assert HINT.search(text.encode())


def test_long_paragraph_without_stops_is_linear():
    """Twice the lines are about twice the work, and a licence at its end is still found."""
    import time
    known = [(name, re.compile(p)) for name, p in SENTENCES]
    took = []
    for lines in (2000, 8000):
        text = "\n".join(f"under the words {i} of this license line" for i in range(lines))
        text += "\nReleased under\nthe MIT license."
        start = time.process_time()
        assert sentence_ids(text, known) == ["mit-ref"]
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0]
