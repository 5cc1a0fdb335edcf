"""Licence notices in texts, found by the Dice coefficient of word bigrams.

Texts and templates are lower-cased and cut into words of letters and digits. A template of m words
is compared with every window of m words of a text (with the whole text, if that is shorter):
Dice = 2 |A and B| / (|A| + |B|) over the sets of bigrams A and B.

Since |A and B| is at most the smaller set, Dice >= t needs |A and B| >= t |B| / (2 - t), and
sizes within t / (2 - t) of each other. Texts with fewer bigrams than that bound, or with fewer
that the template knows, are never compared with it; within a text, running sums of known bigrams
leave the windows that can pass. Only these get the exact coefficient.

Of overlapping matches the most similar stays, then the longest, then the first.

Versions and variants are told apart by single words, which similarity hardly weighs. Words with digits and
the words of VARIANTS have to stand in the window behind the words that they stand behind in the template. If others
do, or none does, the text is of a version or variant without a template, and the match is reported
as the licence's name without its version, with UNKNOWN.

Defined cases: null and empty texts and those of one word match nothing. A template of fewer than
two words is an error. Repeated notices are separate matches. Equal rows get equal results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeline.llm.common import appended

SIMILAR = 0.8
UNKNOWN = "-unknown-version"
#: Words that tell variants of a licence apart, beside those with digits.
VARIANTS = frozenset(
    b"affero lesser library nc nd sa noncommercial noderivatives noderivs sharealike".split()
)
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")

# Wording of public licence notices.
_BSD_LINE = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:"
)
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
)
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.0": [
        "This work is licensed under the GNU Library General Public License, version 2.",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Library General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    # the line that the BSD licences share, which does not tell which of them it is
    "BSD": [_BSD_LINE],
    "BSD-2-Clause": [
        f"{_BSD_LINE} {_BSD_TWO} {_BSD_END}",
        f"{_BSD_TWO} {_BSD_END}",
    ],
    "BSD-3-Clause": [
        f"{_BSD_LINE} {_BSD_TWO} 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without "
        f"specific prior written permission. {_BSD_END}",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International "
        "License.",
    ],
    "CC-BY-NC-SA-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
        "International License.",
    ],
    "CC-BY-NC-ND-4.0": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
        "International License.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    ],
    "EPL-1.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License v1.0 which accompanies this distribution, and is available at "
        "http://www.eclipse.org/legal/epl-v10.html",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ],
}


def normal_words(text: bytes | None) -> list[bytes]:
    return _WORD.findall((text or b"").lower())


def _tells(word: bytes) -> bool:
    return word in VARIANTS or any(48 <= c <= 57 for c in word)


def telling(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    """The words that tell versions and variants apart, each with the word before."""
    return {(a, b) for a, b in zip(words, words[1:]) if _tells(b)}


@dataclass
class Template:
    licence: str
    words: int
    #: distinct bigrams
    bigrams: int
    #: known bigrams that a match needs
    least: float
    #: bigrams that tell the version and variant
    telling: set[tuple[bytes, bytes]]

    def name(self, window: list[bytes]) -> str:
        """The licence, or that its version or variant has no template."""
        if not self.telling:
            return self.licence
        places = {a for a, _ in self.telling}
        found = {(a, b) for a, b in telling(window) if a in places}
        if found and found <= self.telling:
            return self.licence
        return re.sub(r"-[0-9][0-9.]*$", "", self.licence) + UNKNOWN


class Scanner:
    """The templates, and per bigram of their vocabulary the templates that have it."""

    def __init__(self, templates: dict[str, list[str]], similar: float = SIMILAR):
        self.similar = similar
        cut = [
            (licence, normal_words(text.encode()))
            for licence, texts in templates.items()
            for text in texts
        ]
        vocabulary = sorted({w for _, words in cut for w in words})
        self.numbers = {w: i for i, w in enumerate(vocabulary, 1)}
        self.width = len(vocabulary) + 1
        self.having = np.zeros((self.width**2, len(cut)), bool)
        self.templates = []
        for k, (licence, words) in enumerate(cut):
            if len(words) < 2:
                raise ValueError(f"a template of {licence} has fewer than two words")
            bigrams = set(self._bigrams([self.numbers[w] for w in words]).tolist())
            self.having[list(bigrams), k] = True
            least = similar * len(bigrams) / (2 - similar)
            self.templates.append(
                Template(licence, len(words), len(bigrams), least, telling(words))
            )
        self.any = self.having.any(axis=1)

    def _bigrams(self, numbers) -> np.ndarray:
        numbers = np.asarray(numbers, np.int64)
        return numbers[:-1] * self.width + numbers[1:]

    def matches(self, text: bytes | None) -> list[tuple[str, int, int, float]]:
        """(licence, first word, words, Dice) of each match, by first word."""
        words = normal_words(text)
        if len(words) < 2:
            return []
        numbers = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))
        bigrams = self._bigrams(numbers)
        places = np.flatnonzero(self.any[bigrams])
        if len(places) == 0:
            return []
        having = self.having[bigrams[places]]
        found = []
        for k in np.flatnonzero(having.sum(axis=0) >= [t.least for t in self.templates]):
            template = self.templates[k]
            window = min(template.words, len(words))
            if window - 1 < template.least:
                continue
            known = np.zeros(len(bigrams) + 1, np.int64)
            known[places[having[:, k]] + 1] = 1
            known = np.cumsum(known)
            inside = known[window - 1 :] - known[: len(known) - window + 1]
            for start in np.flatnonzero(inside >= template.least).tolist():
                dice = self._dice(words, numbers, start, window, int(k))
                if dice >= self.similar:
                    name = template.name(words[start : start + window])
                    found.append((dice, window, start, name))
        found.sort(key=lambda f: (-f[0], -f[1], f[2], f[3]))
        kept: list[tuple[str, int, int, float]] = []
        taken = np.zeros(len(words), bool)
        for dice, window, start, licence in found:
            if not taken[start : start + window].any():
                taken[start : start + window] = True
                kept.append((licence, start, window, dice))
        return sorted(kept, key=lambda m: m[1])

    def _dice(self, words, numbers, start: int, window: int, k: int) -> float:
        part = words[start : start + window]
        size = len(set(zip(part, part[1:])))
        inside = np.unique(self._bigrams(numbers[start : start + window]))
        return 2 * int(self.having[inside, k].sum()) / (size + self.templates[k].bigrams)


def scan(
    docs: DataFrame,
    text: str = "text",
    templates: dict[str, list[str]] | None = None,
    similar: float = SIMILAR,
) -> DataFrame:
    """`docs` with `licences`, an array of (licence, first_word, words, dice)."""
    scanner = Scanner(TEMPLATES if templates is None else templates, similar)
    match = "struct<licence:string,first_word:int,words:int,dice:double>"
    (name,), schema = appended(docs, {"licences": f"array<{match}>"})
    at = docs.columns.index(text)
    kind = pa.list_(
        pa.struct(
            [
                ("licence", pa.string()),
                ("first_word", pa.int32()),
                ("words", pa.int32()),
                ("dice", pa.float64()),
            ]
        )
    )

    def run(batches):
        for batch in batches:
            found = [
                [
                    dict(zip(("licence", "first_word", "words", "dice"), m))
                    for m in scanner.matches(value.as_py())
                ]
                for value in batch.column(at).cast(pa.large_binary())
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, schema)
