from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from traitlens.llm import mixing, toxicity


def remainder(i):
    return zlib.crc32(str(i).encode()) % 5


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def test_base_scores_match_brute_force_and_the_model_beats_them(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    counts = Counter(t for i, text in rows if remainder(i) != 1 for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in mixing.score(docs).collect()}
    for i, text in rows:
        r, own = got[i], tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(i) == 1, len(own), sum(counts[t] > 0 for t in own), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    learnt = [r for r in got.values() if not r.held_out]
    assert sum(r.score for r in learnt) > sum(r.base_score for r in learnt)


def test_spelling_is_a_distribution_that_learning_improves():
    import pyarrow as pa

    speller = mixing.Speller.empty()
    words = pa.array(["banana", "bandana", "cabana", "anagram", "ban", "can", "canal"] * 3)
    before = speller.cost(words).sum()
    slots, bit, _ = mixing._bits(words)
    for i in range(len(mixing.CONTEXTS)):
        for b, table in ((0, speller.zeros), (1, speller.ones)):
            for s in slots[i][bit == b]:
                table[i, s] += 1
    speller.learn(slots, bit)
    assert speller.cost(words).sum() > before
    # all bytes after one another share the probability of the first byte's node tree
    first = [bytes([b]).decode("latin-1") for b in range(33, 127)]
    assert sum(10.0**c for c in speller.cost(pa.array(first))) < 1


def test_scoring_edge_cases(spark, make_docs):
    rows = [(1, None), (2, ""), (2, ""), (None, "some words here"), (3, "w " * 100_000), (4, "unseen")] + [(i, f"common words {i}") for i in range(10, 40)]
    got = mixing.score(make_docs(rows)).collect()
    assert len(got) == len(rows) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {1}
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert mixing.score(make_docs([]).limit(0)).collect() == []


def toxic_corpus(n=700):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["an", "be", "co", "di", "er", "fa", "go"]) for _ in range(rng.choice([1, 2, 3])))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(30, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = "zorgl" + word()  # a stem, never the same word twice
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxic_stems_are_learnt_and_held_out_rows_are_not_used(spark, make_docs):
    docs, labels = toxic_corpus()
    frame = spark.createDataFrame([(i, 1, t, "x") for i, t in labels], "doc_id long, quality int, toxic int, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(make_docs(docs), frame).collect()}
    assert all(got[i].held_out == (remainder(i) == 0) for i, _ in docs)
    held = [(got[i], t) for i, t in labels if remainder(i) == 0]
    assert sum(r.predicted == t for r, t in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    flipped = spark.createDataFrame([(i, 1, 1 - t if remainder(i) == 0 else t, "x") for i, t in labels], frame.schema)
    again = {r.doc_id: r.score for r in toxicity.toxicity(make_docs(docs), flipped).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_toxicity_edge_cases(spark, make_docs):
    rows = [(1, None), (2, ""), (2, ""), (None, "x y"), (3, "w " * 100_000)]
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(make_docs(rows), empty).collect()
    assert len(got) == 5 and {r.predicted for r in got} == {0}
    nulls = spark.createDataFrame([(None, 1), (1, None), (2, 1), (3, 0), (3, 1)], "doc_id long, toxic int")
    assert len(toxicity.toxicity(make_docs(rows), nulls).collect()) == 5
    assert toxicity.toxicity(make_docs([]).limit(0), nulls).collect() == []


def test_held_out_accuracy_on_given_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.95
    toxic = [r.predicted for r in rows if r.toxic]
    assert sum(toxic) / len(toxic) >= 0.7


def brute_kneser_ney(rows):
    """Per class the log-likelihood of a word, from plain dictionaries of byte strings."""

    def events(word):
        text = b" " + word.encode() + b" "
        return [[(text[max(at - order + 1, 0) : at + 1]) for order in toxicity.ORDERS] for at in range(1, len(text))]

    level = {}
    for k, word, n in rows:
        for e in events(word):
            level.setdefault((k, e[0]), [0, e])[0] += n
    tables = []
    for i in range(len(toxicity.ORDERS)):
        if i:
            longer, level = level, {}
            for (k, _), (_, e) in longer.items():
                level.setdefault((k if i < toxicity.OWN else 0, e[i]), [0, e])[0] += 1
        of = [max(1, sum(n == m for n, _ in level.values())) for m in (1, 2, 3, 4)]
        y = of[0] / (of[0] + 2 * of[1])
        raw = [1 - 2 * y * of[1] / of[0], 2 - 3 * y * of[2] / of[1], 3 - 4 * y * of[3] / of[2]]
        d = [min(max(x, 0.3), j + 0.98) for j, x in enumerate(raw)]
        total, removed = {}, {}
        for (k, e), (n, _) in level.items():
            total[k, e[:-1]] = total.get((k, e[:-1]), 0) + n
            removed[k, e[:-1]] = removed.get((k, e[:-1]), 0) + d[min(n, 3) - 1]
        tables.append(({key: n - d[min(n, 3) - 1] for key, (n, _) in level.items()}, total, removed))

    def logs(k, word):
        out = 0.0
        for e in events(word):
            p = 1 / 256
            for i in reversed(range(len(tables))):
                count, total, removed = tables[i]
                c = k if i < toxicity.OWN else 0
                if (c, e[i][:-1]) in total:
                    p = count.get((c, e[i]), 0) / total[c, e[i][:-1]] + removed[c, e[i][:-1]] / total[c, e[i][:-1]] * p
            out += math.log(max(p, 1e-12))
        return out

    return logs


def test_word_likelihoods_equal_brute_force_kneser_ney(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["an", "be", "é", "di", "er", "x"]) for _ in range(rng.randrange(1, 7)))
    rows = [(k, w, rng.randrange(1, 5)) for k in (0, 1) for w in {word() for _ in range(60)}]
    model = toxicity.estimate(spark.createDataFrame(rows, "k long, word string, n long"))
    logs = brute_kneser_ney(rows)
    words = [w for _, w, _ in rows[:40]] + [word() for _ in range(20)] + ["never", "zz"]
    got = model.word_differences(pa.array(words))
    expected = [logs(1, w) - logs(0, w) for w in words]
    assert max(abs(a - b) for a, b in zip(got, expected)) < 2e-3


def test_a_shared_doc_id_gives_one_calibration_row(spark, make_docs):
    docs, labels = toxic_corpus(300)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    once = toxicity.train(make_docs(docs), frame).weights
    often = toxicity.train(make_docs(docs + [d for d in docs if remainder(d[0]) == 1] * 5), frame).weights
    assert abs(once - often).max() < 1e-6


def test_the_model_beats_the_base_on_held_out_rows(spark):
    """On sf0.1; on the 200 documents of sf0.001 it does not (README)."""
    rows = mixing.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").selectExpr("sum(score) / sum(n_tokens) as model", "sum(base_score) / sum(n_tokens) as base").first()
    assert rows.model > rows.base


def test_the_mixer_learns_from_every_token_and_the_word_before_it(spark, make_docs):
    texts = ["red fox red fox red fox", "red fox", None, "", "Blue  whale\nred fox"]
    speller = mixing.train_speller(make_docs(list(enumerate(texts))))
    counts = Counter()
    for text in texts:
        words = [t.encode() for t in tokens(text)[:-1]]
        hashed = [mixing.Words(pa.array([w.decode()]), mixing.NON_SPACE, lower=True).hashes()[0] for w in words]
        for word, before in zip(words, [0, *hashed]):
            slots, bit, _ = mixing._bits(pa.array([word.decode()]), mixing.np.array([before], "uint64"))
            counts.update((i, int(s), int(b)) for i in range(len(mixing.CONTEXTS)) for s, b in zip(slots[i], bit))
    found = {(i, int(s), b): table[i, s] for b, table in ((0, speller.zeros), (1, speller.ones)) for i, s in zip(*table.nonzero())}
    assert found == counts
    before = mixing.Words(pa.array(["red blue"]), mixing.NON_SPACE, lower=True).hashes()
    after_red, after_blue = speller.cost(pa.array(["fox", "fox"]), before)
    assert after_red > after_blue


def test_token_costs_match_a_plain_mixer(spark, make_docs):
    """Bit by bit, in plain Python, from the learnt counters, weights and map."""
    speller = mixing.train_speller(make_docs([(i, f"some words here and {i * 7} more words there") for i in range(60)]))
    words = ["words", "there", "unheard"]
    before = mixing.np.array([0, 12345, 678], "uint64")
    slots, bit, first = mixing._bits(pa.array(words), before)
    plain = []
    for a, b in zip(first[:-1], first[1:]):
        total = 0.0
        for at in range(a, b):
            pairs = [(speller.zeros[i, slots[i, at]], speller.ones[i, slots[i, at]]) for i in range(len(mixing.CONTEXTS))]
            known = [z + o > 0 for z, o in pairs]
            gate = sum(known)
            z = sum(w * math.log((o + 0.2) / (n + 0.2)) for w, (n, o), k in zip(speller.weights[gate], pairs, known) if k)
            z = min(max(z, -8), 8)
            place = (z + 8) * (mixing.REFINE - 1) / 16
            low = min(int(place), mixing.REFINE - 2)
            mapped = speller.refine[gate, low] * (1 - place + low) + speller.refine[gate, low + 1] * (place - low)
            p = min(max((1 / (1 + math.exp(-z)) + mapped) / 2, 1e-6), 1 - 1e-6)
            total += math.log10(p if bit[at] else 1 - p)
        plain.append(total)
    assert speller.cost(pa.array(words), before) == pytest.approx(plain, rel=1e-4)


def some_words(n, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["an", "b", "é", "日", "x1", "\x00"]) for _ in range(rng.randrange(1, 6))) for _ in range(n)]
    hashed = mixing.np.array([zlib.crc32(w.encode()) for w in words], "uint64")
    return pa.array(words), mixing._befores(hashed, mixing.np.array([0, 5, 5, n // 2]))


def test_bits_counted_by_half_bytes_equal_counted_bits():
    words, before = some_words(800)
    tally = mixing._Tally()
    for a in (0, 300):
        tally.count(mixing._Spelt(words[a : a + 300] if a == 0 else words[a:], before[:300] if a == 0 else before[a:]))
        tally.settle()
    slots, bit, _ = mixing._bits(words, before)
    for own, found in zip(slots, tally.table):
        assert (mixing.np.bincount(own * 2 + bit, minlength=2 * mixing.SLOTS) == found).all()


def test_learning_from_words_equals_learning_from_their_bits():
    words, before = some_words(1500)
    slots, bit, first = mixing._bits(words, before)
    plain, fast = mixing.Speller.empty(), mixing.Speller.empty()
    for i, own in enumerate(slots):
        plain.zeros[i] = fast.zeros[i] = mixing.np.bincount(own[bit == 0], minlength=mixing.SLOTS)
        plain.ones[i] = fast.ones[i] = mixing.np.bincount(own[bit == 1], minlength=mixing.SLOTS)
    for a in range(0, len(words), mixing.WORDS):
        part = slice(first[a], first[min(a + mixing.WORDS, len(words))])
        plain.learn(slots[:, part], bit[part])
    assert fast.learn_words(words, before, fast.logits(out=True), mixing._Desk()) == len(bit)
    assert abs(plain.weights - fast.weights).max() < 1e-6 and abs(plain.refine - fast.refine).max() < 1e-9
    assert abs(plain.weights - mixing.Speller.empty().weights).max() > 1e-3


def test_distinct_values_whatever_place_they_meet_in():
    rng = mixing.np.random.default_rng(4)
    for values in (rng.integers(0, 50, 4000), rng.integers(0, 1 << 60, 3000), mixing.np.zeros(9), mixing.np.arange(1), mixing.np.arange(0)):
        values = values.astype("uint64")
        one, which = mixing.distinct(values)
        assert (values[one][which] == values).all() and len(one) == len(set(values.tolist())) and (mixing.np.diff(one) > 0).all()


def a_block(texts):
    """The rows of a block of op9 as its scorer gets them, and its words with their counts."""
    np, block = mixing.np, mixing._Block()
    words = mixing.Words(pa.array(texts), mixing.NON_SPACE, lower=True)
    hashed = words.hashes()
    keys, first = np.unique(hashed, return_index=True)
    size = pa.array([len(x) for x in texts], pa.int64())
    block.rows = [pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([False] * len(texts)), size], names=["doc_id", "held_out", "n_bytes"])]
    block.counts, block.learn, block.hashes, block.words = [words.count], [np.ones(len(texts), bool)], [hashed], [(keys, words.strings(first))]
    rows = pa.Table.from_batches(list(block.batches(0, 0)))
    named = rows.filter(pa.compute.is_valid(rows["word"]))
    counted = pa.table({"block": named["block"], "at": named["at"], "c": named["learnt"], "mine": named["learnt"]})
    return rows.rename_columns(["part" if c == "block" else "place" if c == "at" else c for c in rows.column_names]), counted, words, hashed


def a_scorer(words, hashed):
    speller, table = mixing.Speller.empty(), mixing.np.tile([50.0, 40.0, 10.0, 5.0], (mixing.CLASSES, 1))
    tally = mixing._Tally()
    few = mixing.np.arange(min(len(hashed), 5000))
    tally.count(mixing._Spelt(words.strings(few), mixing._befores(hashed, words.first[:-1])[few]))
    tally.settle()
    speller.zeros[:], speller.ones[:] = tally.table[:, 0::2], tally.table[:, 1::2]

    class Model:
        value = speller.logits(), speller.weights, speller.refine

    return mixing._scorer(mixing.Totals(1000, 500, 10, 100, table), Model)


def test_scoring_a_block_takes_few_bytes_a_token():
    """op9's blocks of two million tokens took more than an executor's memory, two at a time (finding of round 3)."""
    rng = mixing.np.random.default_rng(11)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 2048) % 3000) for _ in range(256)]
    rows, counted, words, hashed = a_block(texts)
    run, n = a_scorer(words, hashed), len(hashed)
    del words, hashed
    tracemalloc.start()
    try:
        assert run(rows, counted).num_rows == len(texts)
        assert tracemalloc.get_traced_memory()[1] < 110 * n
    finally:
        tracemalloc.stop()


def test_scores_of_a_block_do_not_depend_on_what_is_done_at_once(monkeypatch):
    rng = mixing.np.random.default_rng(12)
    texts = ["", "one", *(" ".join(f"w{x}" for x in rng.zipf(1.4, n) % 90) for n in (5, 300, 1, 40, 900)), "", " \n", "one one two"]
    rows, counted, words, hashed = a_block(texts)
    run = a_scorer(words, hashed)
    whole = run(rows, counted).to_pandas()
    for mixed, at_once in ((1, 7), (64, 1), (350, 100)):
        monkeypatch.setattr(mixing, "MIXED", mixed)
        monkeypatch.setattr(mixing, "COUNTED", at_once)
        found = run(rows, counted).to_pandas()
        assert found["doc_id"].tolist() == whole["doc_id"].tolist() and found["n_known"].tolist() == whole["n_known"].tolist()
        for column in ("score", "base_score", "bits_per_byte"):
            assert found[column].tolist() == pytest.approx(whole[column].tolist(), rel=1e-6)
    assert whole["n_tokens"].tolist() == [len(x.split()) + 1 for x in texts]


def test_costs_where_few_contexts_are_known_equal_those_of_every_bit():
    words, before = some_words(900, seed=8)
    speller = mixing.Speller.empty()
    slots, bit, first = mixing._bits(words[:40], before[:40])
    for i, own in enumerate(slots):
        speller.zeros[i], speller.ones[i] = (mixing.np.bincount(own[bit == b], minlength=mixing.SLOTS) for b in (0, 1))
    rng = mixing.np.random.default_rng(2)
    speller.weights += rng.normal(0, 0.1, speller.weights.shape)
    speller.refine += rng.uniform(0, 1e-3, speller.refine.shape) * (1 - speller.refine)
    slots, bit, first = mixing._bits(words, before)
    inputs = mixing.np.stack([x[at] for x, at in zip(speller.logits().astype(float), slots)])
    gate = (inputs != 0).sum(axis=0)
    assert len(set(gate.tolist())) > 3
    z = mixing.np.clip((speller.weights[gate].T * inputs).sum(axis=0), -8, 8)
    place = (z + 8) * (mixing.REFINE - 1) / 16
    low = mixing.np.minimum(place.astype(int), mixing.REFINE - 2)
    mapped = speller.refine[gate, low] * (1 - place + low) + speller.refine[gate, low + 1] * (place - low)
    p = (1 / (1 + mixing.np.exp(-z)) + mapped) / 2
    plain = mixing.np.add.reduceat(mixing.np.log10(mixing.np.where(bit == 1, p, 1 - p)), first[:-1])
    assert speller.cost(words, before) == pytest.approx(plain, rel=1e-4)
