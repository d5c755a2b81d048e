from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from traitlens.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        k = min(13, len(w))
        for a in range(len(w) - k + 1) if w else ():
            windows.setdefault(tuple(w[a : a + k]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                own = windows.get(tuple(w[a : a + k]))
                if own:
                    hit |= set(range(a, a + k))
                    found |= own
        ids = ",".join(sorted(str(f) for f in found if f is not None))
        n_items = len([f for f in found if f is not None])
        out.append((i, len(w), len(hit), n_items, hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, make_docs, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.verdicts(make_docs(docs), bench).collect()
    return sorted([tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in rows], key=str)


def test_random_overlaps_match_brute_force(spark, make_docs):
    rng = random.Random(5)
    vocabulary = ["ab", "é", "c1", "D", "ef"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 4, 12, 13, 14, 30, 60]))) for i in range(25)] + [(3, text(20)), (None, text(15)), (99, None)]
    docs = []
    for i in range(60):
        parts = [text(rng.randrange(0, 40))]
        if i % 2:
            source = words(rng.choice(items)[1])
            a = rng.randrange(0, len(source) + 1)
            parts += [" ".join(source[a : a + rng.randrange(5, 30)]), text(rng.randrange(0, 200))]
        docs.append((i, ", ".join(parts)))
    docs += [(7, "AB é"), (None, "ab c1 d"), (100, None), (101, ""), (101, "")]
    assert run(spark, make_docs, docs, items) == brute(docs, items)


def test_long_words_and_spans_only_exact_matches_count(spark, make_docs):
    item = " ".join(f"w{i}" for i in range(40))
    near = item.replace("w13", "x").replace("w26", "y")  # every run is 12 or 13 words
    docs = [(1, item), (2, near), (3, " ".join(f"w{i}" for i in range(12))), (4, "z " * 50_000 + item)]
    assert run(spark, make_docs, docs, [(1, item)]) == brute(docs, [(1, item)])


def test_empty_tables(spark, make_docs):
    assert run(spark, make_docs, [(1, "a b")], []) == brute([(1, "a b")], [])
    assert decontaminate.verdicts(make_docs([]).limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


def test_every_window_keeps_one_fingerprint():
    grams = np.random.default_rng(1).integers(0, 5, 200).astype(np.uint64)
    kept = set(decontaminate.winnow(grams, np.ones(200 - decontaminate.SPAN + 1, bool)).tolist())
    assert all(kept & set(range(a, a + decontaminate.SPAN)) for a in range(200 - decontaminate.SPAN + 1))
