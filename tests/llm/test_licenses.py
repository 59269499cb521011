import random
import re
from re import _parser as regex_parser

import pytest

from affinis.llm import license_scan


def samples(pattern, rng, n=12):
    """Some strings that the pattern matches; every alternative and both sides of every option come up."""

    def draw(parts):
        out = []
        for op, arg in parts:
            name = str(op)
            if name == "LITERAL":
                out.append(chr(arg))
            elif name == "IN":
                kind, value = rng.choice(arg)
                out.append(chr(value if str(kind) == "LITERAL" else rng.randint(*value)))
            elif name == "BRANCH":
                out.append(draw(rng.choice(arg[1])))
            elif name == "SUBPATTERN":
                out.append(draw(arg[-1]))
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                low, high, inner = arg
                out.extend(draw(inner) for _ in range(rng.randint(low, min(high, low + 3))))
            else:
                assert name in ("ASSERT", "ASSERT_NOT"), name
        return "".join(out)

    tree = regex_parser.parse(pattern)
    return sorted({draw(tree) for _ in range(n)})


@pytest.fixture(scope="module")
def matches():
    rng, out = random.Random(3), []
    for place, rule in enumerate(license_scan.signatures()):
        found = samples(rule.pattern, rng)
        assert found and all(re.search(rule.pattern, f" {t} ") for t in found)
        out += [(place, t) for t in found]
    return out


def test_matches_of_every_rule_pass_the_document_gate(matches):
    for _, text in matches:
        for form in (text, text.title(), text.upper().replace(" ", ",\n-")):
            assert re.search(license_scan.GATE, form), form
            assert any(w in form.lower() for w in license_scan.QUICK), form


def test_gates_of_rules_let_every_match_through(documents, matches):
    patterns = [re.compile(r.pattern) for r in license_scan.signatures()]
    texts = sorted({t for _, t in matches})
    want = {(n, place) for n, t in enumerate(texts) for place, p in enumerate(patterns) if p.search(f" {t} ")}
    found = license_scan.detect(documents(list(enumerate(texts)))).collect()
    assert {(r.doc_id, d.place) for r in found for d in r.found} == want


@pytest.mark.parametrize(
    "text, labels",
    [
        ("licensed under the GPL v2", ["gpl-2"]),
        ("Licensed under LGPL v3.", ["lgpl-3"]),
        ("AGPL v3 license", ["agpl-3"]),
        ("released under the GPL2", ["gpl-2"]),
        ("licensed under the GNU GPL v2", ["gpl-2"]),
        ("available under the GPL 2", ["gpl-2"]),
        ("Available under the Unlicense", ["unlicense"]),
        ("a FreeBSD license", ["bsd-2-clause"]),
    ],
)
def test_forms_of_names(documents, text, labels):
    assert license_scan.scan_licenses(documents([(1, text)])).first().labels == labels


@pytest.mark.parametrize(
    "text, label",
    [
        ("Released under the GPL 3", "gpl-3"),
        ("distributed under BSD 3 clause", "bsd-3-clause"),
        ("under the terms of Apache 2.0", "apache-2"),
        ("released under Creative Commons Attribution 4.0", "cc-by"),
    ],
)
def test_sentences_without_the_word(documents, text, label):
    row = license_scan.scan_licenses(documents([(1, f"The code. {text}, and more.")])).first()
    assert row.labels == [label] and row.score == 0.95


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: * Neither the name of the Example Project nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission."""


@pytest.mark.parametrize(
    "text, labels",
    [
        (MIT_TEXT, ["mit"]),
        (BSD_TEXT, ["bsd", "bsd-3-clause"]),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", ["gpl-3"]),
        ("GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007", ["gpl-3"]),
        ("subject to the terms of the Mozilla Public License, v. 2.0.", ["mpl-2"]),
        ("Eclipse Public License - v 2.0", ["epl-2"]),
        ("Boost Software License - Version 1.0", ["boost-1"]),
        ("GPL-3.0-or-later", ["gpl-3"]),
        ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["cc-by-sa"]),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0)", ["apache-2", "mit"]),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", ["classpath-exception", "gpl-2"]),
        ("SPDX-License-Identifier: MIT-0", ["mit-0"]),
        ("SPDX-License-Identifier: BSD-2-Clause AND (ISC OR GPL-2.0-or-later)", ["bsd-2-clause", "gpl-2", "isc"]),
        ("SPDX-License-Identifier: MIT\nApache-2.0 is something else", ["mit"]),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ["mpl-2"]),
        ("Licensed under the Apache License, Version 2.0", ["apache-2"]),
        ("released into the public domain", ["public-domain"]),
        ("a permission slip, a copyright lawyer and the public domain of hearts", []),
    ],
)
def test_texts_notices_and_expressions(documents, text, labels):
    row = license_scan.scan_licenses(documents([(1, f"x {text} y")])).first()
    assert row.labels == labels and (row.score > 0) == bool(labels)


def test_there_are_hundreds_of_signatures():
    rules = license_scan.signatures()
    assert len({r.pattern for r in rules}) > 400 and len({r.label for r in rules}) > 80
