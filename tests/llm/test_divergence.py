from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from traitlens.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, count long, value long, part string, v long, n long, total long, e int"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "x", 7, 7, "x", 7, 7, 7, 7) for i, r in enumerate(rows)], SCHEMA)


def brute(rows, min_docs=3, top=200):
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    docs, count, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for w in words(text):
            count[lang, source, w] += 1
        for w in set(words(text)):
            docs[lang, w] += 1
    kept = defaultdict(list)
    for (lang, w), n in docs.items():
        if n >= min_docs:
            kept[lang].append(w)
    c = lambda lang, w, source: sum(count[lang, s, w] for x, s in groups if x == lang) if source is None else count[lang, source, w]

    def share(lang, source):
        total = sum(c(lang, w, source) for w in kept[lang]) + len(kept[lang])
        return {w: 1 + 1_000_000_000 * (c(lang, w, source) + 1) // total for w in kept[lang]}

    out = set()
    p = {g: share(*g) for g in groups}
    for lang, source in groups:
        q, whole = p[lang, source], share(lang, None)
        pair = [(sum((q[w] - r[w]) ** 2 // r[w] for w in kept[lang]), s) for (x, s), r in p.items() if x == lang and s != source]
        term = [((q[w] - whole[w]) ** 2 // whole[w], w) for w in kept[lang] if count[lang, source, w] and q[w] > whole[w]]
        for part, items in (("pair", pair), ("term", term)):
            for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1):
                if part == "pair" or rank <= top:
                    out.add((lang, source, part, item, value, rank))
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_brute_force(spark):
    rng = random.Random(11)
    bits = ["a", "B", "b", "cé", "É", "日本", "x1y", "d-e", "f", "😀", "\x00", "z\tq"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = []
    for _ in range(160):
        weights = [1 / (1 + i) for i in range(len(bits))]
        rows.append((" ".join(rng.choices(bits, weights, k=rng.randrange(0, 60))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", "z", None])))
    rows += [(None, "fr", "s1"), ("", "fr", "s2"), ("once", "it", "s1"), ("solo solo", "pt", "s1")] + [("solo solo", "pt", "s1")] * 3
    rows += [("hot words here " * 50, "en", "s1")] * 40
    assert result(divergence.audit(frame(spark, rows))) == brute(rows)
    assert result(divergence.audit(frame(spark, rows), min_docs=1, top_terms=3)) == brute(rows, 1, 3)


def test_blocks_are_added_up(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(" ".join("".join(rng.choices("abc", k=3)) for _ in range(40)), "en", f"s{rng.randrange(4)}") for _ in range(60)]
    monkeypatch.setattr(divergence, "BLOCK", 5)
    assert result(divergence.audit(frame(spark, rows))) == brute(rows)


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([0, 5, 9_300_000_000, 4_000_000_000_000_000], np.int64)
    total = 4_100_000_000_000_000
    assert divergence.shares(counts, total).tolist() == [1 + 1_000_000_000 * (int(c) + 1) // total for c in counts]
    assert divergence.shares(counts[:2], 9).tolist() == [1 + 1_000_000_000 // 9, 1 + 6_000_000_000 // 9]


def test_long_text_and_empty_table(spark):
    rows = [("lorem ipsum dolor " * 60_000, "en", "s1"), ("ipsum lorem", "en", "s2"), ("lorem", "en", "s2"), ("ipsum", "en", "s3")]
    assert result(divergence.audit(frame(spark, rows))) == brute(rows)
    assert divergence.audit(frame(spark, rows).limit(0)).collect() == []


def test_counts_of_a_task_are_added_up_before_they_are_dealt(monkeypatch):
    rng = random.Random(2)
    rows = [(rng.choice("de"), rng.choice("xyz"), " ".join(rng.choices("abcdefgh", k=30))) for _ in range(400)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), r)) for r in rows[a : a + 50]]) for a in range(0, 400, 50)]
    for waiting in (1 << 20, 100, 60, 1):
        monkeypatch.setattr(divergence, "WAITING", waiting)
        found = [tuple(r.values()) for b in divergence._count(iter(batches)) for r in b.to_pylist()]
        count, docs = Counter(), Counter()
        for lang, source, term, n, d in found:
            count[lang, source, term] += n
            docs[lang, source, term] += d
        assert count == Counter((a, b, w) for a, b, t in rows for w in t.split())
        assert docs == Counter((a, b, w) for a, b, t in rows for w in set(t.split()))
        if waiting >= 100:  # 48 terms of groups
            assert len(found) == len(count) == 48


def test_terms_are_dealt_once_for_both_groupings(spark):
    rows = [("red fox", "en", "s1"), ("red hen", "en", "s2")] * 4
    plan = divergence.term_counts(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
