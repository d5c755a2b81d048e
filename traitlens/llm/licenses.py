"""Licence scan (operator 8): normalised text against licence templates by Dice coefficient over word bigrams.

Texts and templates are lower-cased and reduced to words of letters, digits and dots inside numbers ("licence" is read as
"license", 2.0 as 2).  Spans compared with the templates are each line, each block of lines between blank lines, the whole
text, and the spans of a template's length that its bigrams vote for (a licence inside a longer paragraph, or laid out over
lines).  A template of ``m`` bigrams can reach the least coefficient ``t`` only against spans of ``m * t / (2 - t)`` to
``m * (2 - t) / t`` bigrams, so other templates are not compared.

Licences and their variants often differ by a word or a number.  Between the first and the last bigram that a span shares with a
template it must hold the same version numbers and the same of the ``VARIANTS`` as the template; numbers that only count
clauses are left out.

Every word of a text is under one licence: of overlapping spans the one that shares most bigrams with its template goes
first, then the larger coefficient, then the name; spans that do not overlap all count.

Templates are fixed texts of the library (a few kilobytes), not data.  A unit must hold one of ``KEY_WORDS`` to count as
a licence statement (every template does); others are not compared.

Defined results: null, empty and word-less texts match nothing; every input row gives one row, repeated rows included;
equal coefficients are resolved by the template's name.  Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Notices by which works are commonly put under a licence, and openings of the licences' texts.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_NAMES = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public "
    "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later "
    "version."
)
_GNU_OLD = (
    "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as "
    "published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
)
TEMPLATES: dict[str, list[str]] = {
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "LGPL-2.0": [
        "This work is licensed under the GNU Library General Public License, version 2.",
        _GNU_OLD.format("library", "Library ", "2"),
        _GNU_OLD.format("program", "Library ", "2"),
        "SPDX-License-Identifier: LGPL-2.0",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        _GNU.format("Affero", "3"),
        "SPDX-License-Identifier: AGPL-3.0",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        _GNU.format("Lesser", "2.1"),
        _GNU_OLD.format("library", "Lesser ", "2.1"),
        "SPDX-License-Identifier: LGPL-2.1",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        _GNU.format("Lesser", "3"),
        "SPDX-License-Identifier: LGPL-3.0",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        _BSD,
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        _BSD + _BSD_NAMES,
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is licensed under CC0 1.0 Universal.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        _GNU_OLD.format("program", "", "2"),
        "SPDX-License-Identifier: GPL-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
        "SPDX-License-Identifier: GPL-3.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
    ],
}
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
for _code, _long in _CC.items():
    TEMPLATES[f"CC-{_code}-4.0"] = [
        f"Licensed under CC {_code} 4.0.",
        f"This work is licensed under a Creative Commons {_long} 4.0 International License.",
        f"Creative Commons {_long} 4.0 International License",
        f"SPDX-License-Identifier: CC-{_code}-4.0",
    ]
# Words that tell licences apart: the family, and the variant within it.
VARIANTS = {"mit", "apache", "bsd", "gpl", "lgpl", "agpl", "mpl", "mozilla", "boost", "bsl", "gnu", "cc", "cc0", "affero", "lesser", "noncommercial", "noderivatives", "noderivs", "sharealike", "nc", "nd", "sa"}
KEY_WORDS = re.compile(r"licen[sc]e|redistribut|permission|copyright|unencumbered|rights\s+reserved|creative\s+commons", re.IGNORECASE)

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


_SPELLING = {"licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing"}
_NUMBER = re.compile(r"[0-9]+(?:\.[0-9]+)*")


def normalise(text: str) -> list[str]:
    return [_SPELLING.get(w, w[:-2] if w.endswith(".0") else w) for w in _WORD.findall(text.lower())]


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:])) if len(words) > 1 else {(w, "") for w in words}


def dice(x: set, y: set) -> float:
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words = name, normalise(text)
        self.grams = bigrams(self.words)
        self.at = {g: i for i, g in reversed(list(enumerate(zip(self.words, self.words[1:]))))}
        self.counts_clauses = {"1", "2"} <= set(self.words)
        self.marks = self._marks(self.words)

    def bounds(self, t: float) -> tuple[float, float]:
        return len(self.grams) * t / (2 - t), len(self.grams) * (2 - t) / t

    def _marks(self, words: list[str]) -> set[str]:
        return {w for w in words if w in VARIANTS or not self.counts_clauses and _NUMBER.fullmatch(w)}

    def compare(self, words: list[str]) -> tuple[int, float]:
        """Shared bigrams and coefficient of a span's words; (0, 0) where its version or variant is another."""
        grams = bigrams(words)
        shared = len(grams & self.grams)
        if not shared:
            return 0, 0.0
        hits = [i for i, g in enumerate(zip(words, words[1:])) if g in self.grams] or [0]
        if self._marks(words[hits[0] : hits[-1] + 2]) != self.marks:
            return 0, 0.0
        return shared, 2 * shared / (len(grams) + len(self.grams))


_ALL = [Template(name, text) for name, texts in sorted(TEMPLATES.items()) for text in texts]
assert all(KEY_WORDS.search(text) for texts in TEMPLATES.values() for text in texts)


def _units(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The text's words, and the spans of its lines, blocks and whole that hold a key word, where they have words."""
    words: list[str] = []
    spans: dict[tuple[int, int], None] = {}
    block, key_in_block, key_in_text = 0, False, False
    for line in [*text.split("\n"), ""]:
        start = len(words)
        words += normalise(line)
        if KEY_WORDS.search(line):
            key_in_block = key_in_text = True
            spans[start, len(words)] = None
        if not line.strip():
            if key_in_block:
                spans[block, start] = None
            block, key_in_block = len(words), False
    if key_in_text:
        spans[0, len(words)] = None
    return words, [s for s in spans if s[0] < s[1]]


def scan(text: str, threshold: float = THRESHOLD) -> list[tuple[str, float]]:
    """``(licence, best coefficient)`` of every licence at or above the threshold, best first."""
    words, units = _units(text)
    if not units:
        return []
    places = defaultdict(list)
    for i, g in enumerate(zip(words, words[1:])):
        places[g].append(i)
    sized = [(len(bigrams(words[a:b])), a, b) for a, b in units]
    found: list[tuple[int, float, str, int, int]] = []
    for template in _ALL:
        low, high = template.bounds(threshold)
        size = len(template.words)
        votes = Counter(i - at for g, at in template.at.items() for i in places.get(g, ()))
        spans = {(max(0, o), min(o + size, len(words))) for o, n in votes.items() if n >= low / 2 and o + size > 0}
        spans.update((a, b) for n, a, b in sized if low <= n <= high)
        for start, end in spans:
            shared, value = template.compare(words[start:end])
            if value >= threshold:
                found.append((-shared, -value, template.name, start, end))
    best: dict[str, float] = {}
    taken = bytearray(len(words))
    for _, value, name, start, end in sorted(found):
        if not any(taken[start:end]):
            taken[start:end] = b"\1" * (end - start)
            best[name] = max(-value, best.get(name, 0.0))
    return sorted(best.items(), key=lambda x: (-x[1], x[0]))


_SCHEMA = "doc_id long, licences array<string>, dice array<double>"


def _scanner(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = pc.fill_null(pc.match_substring_regex(batch["text"], KEY_WORDS.pattern, ignore_case=True), False)
            at = pc.indices_nonzero(some).to_pylist()
            found: list[list[tuple[str, float]]] = [[] for _ in range(len(batch))]
            for i, text in zip(at, batch["text"].filter(some).to_pylist()):
                found[i] = scan(text, threshold)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([[n for n, _ in f] for f in found], pa.list_(pa.string())),
                    pa.array([[d for _, d in f] for f in found], pa.list_(pa.float64())),
                ],
                names=["doc_id", "licences", "dice"],
            )

    return run


def licence_scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, best licence and its coefficient (null without one), all licences found."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = source.mapInArrow(_scanner(threshold), _SCHEMA)
    return found.select(
        "doc_id",
        F.get("licences", F.lit(0)).alias("licence"),
        F.get("dice", F.lit(0)).alias("dice"),
        F.size("licences").cast("long").alias("n_licences"),
        F.array_join("licences", ",").alias("licences"),
    )
