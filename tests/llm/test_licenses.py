"""Licence scan against the Dice coefficient of every window."""

import random
import re

import pytest

from gaugeline.llm import licenses

MIT = licenses.TEMPLATES["MIT"][1]
APACHE = licenses.TEMPLATES["Apache-2.0"][0]


def words(text):
    return re.findall(r"[a-z0-9\x80-\xff]+", text.lower())


def dice(a, b):
    a, b = ({*zip(x, x[1:])} for x in (a, b))
    return 2 * len(a & b) / (len(a) + len(b))


def brute(text, templates, similar):
    """Whether some window of a template's size matches, and the best coefficient."""
    found = {}
    tokens = words(text)
    for name, texts in templates.items():
        for template in map(words, texts):
            size = min(len(template), len(tokens))
            for at in range(len(tokens) - size + 1):
                if size >= 2:
                    found[name] = max(found.get(name, 0), dice(tokens[at : at + size], template))
    return {name: value for name, value in found.items() if value >= similar}


@pytest.mark.parametrize("seed", range(25))
def test_windows_match_brute_force(seed):
    rng = random.Random(seed)
    templates = {"one": ["alpha beta gamma delta epsilon zeta eta theta"], "two": ["red green blue red green"]}
    vocabulary = words(" ".join(t for x in templates.values() for t in x)) + ["x", "y"]
    tokens = []
    for _ in range(6):
        part = words(rng.choice(rng.choice(list(templates.values()))))
        if rng.random() < 0.7:
            part[rng.randrange(len(part))] = rng.choice(vocabulary)
        tokens += part + rng.choices(vocabulary, k=rng.randrange(4))
    text = " ".join(tokens[: rng.choice([3, 7, 40])])
    got = licenses.Scanner(templates, 0.7).matches(text.encode())
    want = brute(text, templates, 0.7)
    # overlapping matches of other licences give way, the best one stays
    assert {m[0] for m in got} <= set(want)
    assert bool(got) == bool(want)
    if want:
        assert max(m[3] for m in got) == pytest.approx(max(want.values()))
    spans = [(m[1], m[1] + m[2]) for m in got]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_notices_inside_texts():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    text = f"some code\n\n{MIT.upper()}\nmore\n{APACHE} the end".encode()
    (one, first, size, value), (two, *_rest) = scanner.matches(text)
    assert (one, first, size, value) == ("MIT", 2, len(words(MIT)), 1.0) and two == "Apache-2.0"
    changed = MIT.replace("free of charge", "at no cost").encode()
    assert scanner.matches(changed)[0][0] == "MIT" and scanner.matches(changed)[0][3] < 1
    assert [m[0] for m in scanner.matches(b"Licensed under CC BY-NC 4.0.")] == ["CC-BY-NC-4.0"]
    assert [m[0] for m in scanner.matches(b"Licensed under CC BY 4.0.")] == ["CC-BY-4.0"]


def test_siblings_are_told_apart():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    header = (
        "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General "
        "Public License as published by the Free Software Foundation; either version {} of the License, or (at "
        "your option) any later version."
    )
    for licence, what, kind, version in (
        ("GPL-2.0", "program", "", "2"), ("GPL-3.0", "program", "", "3"), ("LGPL-2.0", "library", "Library ", "2"),
        ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-3.0", "program", "Lesser ", "3"),
        ("AGPL-3.0", "program", "Affero ", "3"),
    ):
        text = f"a b {header.format(what, kind, version)} c d"
        assert [m[0] for m in scanner.matches(text.encode())] == [licence]
        text = f"This work is licensed under the GNU {kind}General Public License, version {version}."
        assert [m[0] for m in scanner.matches(text.encode())] == [licence]
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            assert [m[0] for m in scanner.matches(f"x y {text} z".encode())] == [name]
    two, three = (licenses.TEMPLATES[f"BSD-{n}-Clause"][0] for n in (2, 3))
    for text, name, other in ((two, "BSD-2-Clause", "BSD-3-Clause"), (three, "BSD-3-Clause", "BSD-2-Clause")):
        changed = text.replace("copyright notice", "copyright note", 1).replace("HOLDERS AND CONTRIBUTORS", "OWNERS")
        changed += " IN NO EVENT SHALL THE OWNERS BE LIABLE"
        got = {m[0] for m in scanner.matches(changed.encode())}
        assert name in got and other not in got


def test_versions_without_a_template_are_not_their_siblings():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    header = (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General "
        "Public License as published by the Free Software Foundation; either version {} of the License, or (at "
        "your option) any later version."
    )
    for text, want in (
        ("Licensed under CC BY 3.0.", None), ("Licensed under CC BY-SA 3.0.", None),  # too short to be similar
        (header.format("", "1"), "GPL"), (header.format("Affero ", "1"), "AGPL"),
        ("Licensed under the Apache License, Version 1.1.", None),
        ("This program and the accompanying materials are made available under the terms of the Eclipse Public "
         "License 3.0 which is available at https://www.eclipse.org/legal/epl-3.0", "EPL"),
        ("This work is licensed under a Creative Commons Attribution 3.0 International License.", "CC-BY"),
    ):
        got = [m[0] for m in scanner.matches(f"x y {text} z".encode())]
        assert got == ([want + licenses.UNKNOWN] if want else []), (text, got)
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            assert [m[0] for m in scanner.matches(f"in 2024 {text} 17 days".encode())] == [name]


def test_clean_texts_match_nothing():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for text in (None, b"", b"mit", b"the license", b"this work is licensed to nobody in particular at all"):
        assert scanner.matches(text) == []
    with pytest.raises(ValueError, match="two words"):
        licenses.Scanner({"x": ["one"]})


def test_odd_rows(spark, docs, clashing):
    rows = docs((1, None), (2, ""), (None, APACHE), (3, "word " * 300_000 + APACHE), (4, APACHE), (4, APACHE))
    frame = clashing(rows, "licences")
    got = licenses.scan(frame)
    assert got.columns == [*frame.columns, "licences_"]
    by = [(r.doc_id, [(m.licence, m.first_word) for m in r.licences_]) for r in got.collect()]
    assert by == [
        (1, []), (2, []), (None, [("Apache-2.0", 0)]), (3, [("Apache-2.0", 300_000)]),
        (4, [("Apache-2.0", 0)]), (4, [("Apache-2.0", 0)]),
    ]
    assert licenses.scan(frame.limit(0)).count() == 0
