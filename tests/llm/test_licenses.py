from __future__ import annotations

import random

from traitlens.llm import licenses


def test_size_bounds_never_prune_a_match():
    for t in (0.5, 0.8, 0.95):
        for m in range(1, 60):
            low, high = m * t / (2 - t), m * (2 - t) / t
            for n in range(1, 150):
                if 2 * min(m, n) / (m + n) >= t:  # the largest coefficient sizes m and n allow
                    assert low - 1e-9 <= n <= high + 1e-9


def brute(text):
    """Licences of a text: every unit and every span of a template's length, one bigram in place, against every template."""
    words, units = licenses._units(text)
    found = []
    for t in licenses._ALL:
        size = len(t.words)
        for start, end in {*units, *((max(0, o), min(o + size, len(words))) for o in {i - j for i in range(len(words) - 1) for j in range(size - 1) if words[i : i + 2] == t.words[j : j + 2]})}:
            grams = licenses.bigrams(words[start:end])
            shared = len(grams & t.grams)
            value = 2 * shared / (len(grams) + len(t.grams))
            if shared and value >= licenses.THRESHOLD and t.compare(words[start:end])[0]:
                found.append((-shared, -value, t.name, start, end))
    names, taken = set(), set()
    for _, _, name, start, end in sorted(found):
        if taken.isdisjoint(range(start, end)):
            taken.update(range(start, end))
            names.add(name)
    return names


def test_spans_match_brute_force():
    rng = random.Random(1)
    short = [t for t in licenses._ALL if len(t.words) <= 14]
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 3)):
            words = rng.choice(short).words[:]
            if rng.random() < 0.3:
                words[rng.randrange(len(words))] = "zzz"
            filler = [f"f{rng.randrange(9)}" for _ in range(rng.randrange(0, 6))]
            parts += [" ".join(filler), " ".join(words).upper()]
        text = rng.choice(["\n", " ", "\n\n"]).join(parts)
        if licenses.KEY_WORDS.search(text):
            assert {n for n, _ in licenses.scan(text)} == brute(text), text


def test_planted_templates_are_found_in_documents(spark):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(2)
    for text in docs[:60]:
        t = rng.choice(licenses._ALL)
        lines = text.split("\n")
        lines.insert(rng.randrange(len(lines) + 1), " ".join(t.words).upper())
        got = dict(licenses.scan("\n".join(lines)))
        assert got.get(t.name, 0) == 1.0


def test_relatives_that_differ_by_a_word_are_told_apart():
    one = lambda text: [n for n, _ in licenses.scan(text)]
    gpl2 = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.")
    assert one(gpl2) == ["GPL-2.0"] and one(gpl2.replace("version 2 ", "version 3 ")) == ["GPL-3.0"]
    assert one(gpl2.replace("GNU General", "GNU Lesser General").replace("version 2 ", "version 2.1 ")) == ["LGPL-2.1"]
    assert one(gpl2.replace("GNU General", "GNU Library General")) == ["LGPL-2.0"]
    assert one("Creative Commons Attribution-NoDerivatives 4.0 International License") == ["CC-BY-ND-4.0"]
    for code, long in licenses._CC.items():
        assert one(f"Licensed under CC {code} 4.0.") == [f"CC-{code}-4.0"]
        assert one(f"some words\nThis work is licensed under a Creative Commons {long} 4.0 International Licence. more") == [f"CC-{code}-4.0"]
    assert one("Licensed under CC BY-NC-SA 4.0") == ["CC-BY-NC-SA-4.0"] and one("Licensed under CC BY 2.0.") == []
    assert one("Distributed under the Boost Software License, Version 1.0.") == ["BSL-1.0"]
    for text in ("Released under the MIT licence.", "licensed under the MIT License", "The MIT License (MIT)\n\nCopyright (c) 2020 A"):
        assert one(text) == ["MIT"]
    clauses = [licenses._BSD.split(" 1. ")[0], "1. " + licenses._BSD.split(" 1. ")[1].split(" 2. ")[0], "2. " + licenses._BSD.split(" 2. ")[1], licenses._BSD_NAMES.strip()]
    assert one("\n\n".join(clauses)) == ["BSD-3-Clause"] and one("\n\n".join(clauses[:3])) == ["BSD-2-Clause"]
    assert one("\n".join(c.replace(", ", ",\n") for c in clauses)) == ["BSD-3-Clause"]


def test_many_notices_take_time_in_proportion():
    import time

    def seconds(n):
        text = "\n".join(["Licensed under the Apache License, Version 2.0.", "Released under the MIT License."] * (n // 2))
        started = time.process_time()
        assert dict(licenses.scan(text)) == {"Apache-2.0": 1.0, "MIT": 1.0}
        return time.process_time() - started

    seconds(100)
    first, second = seconds(4_000), seconds(16_000)
    assert second < 8 * first + 0.5 and second < 20


def test_found_inside_long_paragraphs_and_not_in_plain_text():
    text = "alpha beta gamma delta " * 30 + "Released under the MIT License. " + "more words follow " * 30
    assert licenses.scan(text) == [("MIT", 1.0)]
    assert licenses.scan("a licence plate and the permission to park were discussed at length in the meeting") == []


def test_rows_nulls_and_clashing_columns(spark, make_docs):
    rows = [(1, "Licensed under the Apache License, Version 2.0."), (2, None), (3, ""), (1, "Released under the MIT License."), (None, "plain"), (4, "x " * 200_000 + "\nReleased under the MIT License.")]
    got = sorted(((r.doc_id, r.licence, r.n_licences) for r in licenses.licence_scan(make_docs(rows)).collect()), key=str)
    assert got == sorted([(1, "Apache-2.0", 1), (2, None, 0), (3, None, 0), (1, "MIT", 1), (None, None, 0), (4, "MIT", 1)], key=str)
    assert licenses.licence_scan(make_docs([]).limit(0)).collect() == []


def test_dual_notices_in_one_line_and_near_relatives():
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    assert licenses.scan(f"{apache} {mit}") == [("Apache-2.0", 1.0), ("MIT", 1.0)]
    assert licenses.scan(f"{licenses.TEMPLATES['Apache-2.0'][1]} {mit}") == [("Apache-2.0", 1.0), ("MIT", 1.0)]
    for name in ("AGPL-3.0", "LGPL-2.1", "LGPL-3.0", "GPL-3.0"):
        assert licenses.scan(licenses.TEMPLATES[name][1])[0] == (name, 1.0) and len(licenses.scan(licenses.TEMPLATES[name][1])) == 1
    for name, text in (("BSD-2-Clause", licenses._BSD), ("BSD-3-Clause", licenses._BSD + licenses._BSD_NAMES)):
        words = text.split()
        wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
        assert [n for n, _ in licenses.scan(f"Copyright A B\n\n{wrapped}\n\nplain words")] == [name]
