from __future__ import annotations

import collections
import random
import re

import pyarrow.parquet as pq
import zstandard

from traitlens.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def texts():
    rng = random.Random(1)
    out = [None, "", " \n\t", "one", "a b c d e f g h i j", "x " * 30, "é日😀 # * < > |\n\né日😀 # * < > |\r\n", "a\x0bb\x0cc\x1cd e f g h i j k l"]
    for _ in range(60):
        vocabulary = ["a", "b#", "ç", "d\n", "e\t", "|", "<f>"] if rng.random() < 0.5 else [f"w{i}" for i in range(40)]
        out.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 80))))
    return out + ["long words " * 60_000]


def test_base_counts_match_brute_force(spark, make_docs):
    rows = list(enumerate(texts())) + [(None, "a b"), (3, "again"), (3, "again")]
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.measure(make_docs(rows)).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert quality.measure(make_docs([]).limit(0)).collect() == []


def test_compression_rejects_repetition_and_noise_and_keeps_prose(spark, make_docs):
    rng = random.Random(2)
    syllables = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "io", "ou", "er", "en")]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.choice([1, 1, 2, 3, 4])))
    prose = " ".join(word() + rng.choice(["", "", ",", "."]) for _ in range(900))
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(60)) for _ in range(100))
    pattern = " ".join(f"item {i} costs {i} and ships in {i} days" for i in range(400))
    got = {r.doc_id: r for r in quality.measure(make_docs([(1, prose), (2, noise), (3, pattern)])).collect()}
    assert got[1].kept and not got[2].kept and not got[3].kept
    assert not got[2].base_failed and not got[3].base_failed  # only compression tells
    assert sorted(r.doc_id for r in quality.passing(make_docs([(1, prose), (2, noise), (None, None), (4, "")])).collect()) == [1]


def test_passing_keeps_rows_and_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = {r.doc_id for r in quality.measure(docs).where("kept").collect()}
    good = quality.passing(docs)
    assert good.columns == docs.columns
    assert sorted(map(tuple, good.collect())) == sorted(tuple(r) for r in docs.collect() if r.doc_id in kept)


def test_ratio_is_that_of_the_whole_text():
    codec = zstandard.ZstdCompressor(level=quality.LEVEL, write_checksum=False, write_content_size=False)
    raw = ("abc def " * 5000 + "tail").encode()
    ratio, odd, ok = quality.compression(raw, codec)
    assert ratio == len(raw) / len(codec.compress(raw)) and odd == 1.0 and not ok


def clean_texts():
    """Per language, the distinct texts of sf0.1 that pass, as one text."""
    codec = zstandard.ZstdCompressor(level=quality.LEVEL, write_checksum=False, write_content_size=False)
    seen, out = set(), collections.defaultdict(list)
    for row in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text", "lang"]).to_pylist():
        words = (row["text"] or "").split()
        grams = {hash(tuple(words[i : i + 8])) for i in range(len(words) - 7)}
        if len(words) < 50 or len(grams & seen) > 0.05 * len(grams) or not quality.compression(row["text"].encode(), codec)[2]:
            continue
        seen |= grams
        out[row["lang"]].append(row["text"])
    return {lang: "\n".join(texts) for lang, texts in out.items()}


def test_long_clean_texts_pass_whatever_their_length(spark, make_docs):
    codec = zstandard.ZstdCompressor(level=quality.LEVEL, write_checksum=False, write_content_size=False)
    whole = clean_texts()
    assert whole.keys() == {"en", "de", "es", "fr"} and min(len(t) for t in whole.values()) > 1_500_000
    for lang, text in whole.items():
        raw = text.encode()
        for size in (70_000, 131_072, 262_144, 524_288, 700_000, 1 << 20, len(raw)):
            ratio, odd, good = quality.compression(raw[:size], codec)
            high = next(b for limit, _, b in quality.BANDS if min(size, len(raw)) <= limit)
            assert good and odd < 0.05 and ratio < high - 0.15, (lang, size, ratio)
    assert {r.doc_id for r in quality.measure(make_docs(list(enumerate(whole.values())))).where("kept").collect()} == {0, 1, 2, 3}
    passage = whole["en"][:40_000]
    assert not quality.compression((passage * 60).encode(), codec)[2]  # every chunk is ordinary, the whole repeats itself
