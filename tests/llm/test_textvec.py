from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from traitlens.llm import superminhash
from traitlens.llm.decontaminate import winnow
from traitlens.llm.linking import shingle_sets
from traitlens.llm.textvec import ALNUM, NON_SPACE, Words, mix, powers, slices

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from(list("aB é\n\t\x0b日😀1!_ ")), max_size=30)), max_size=6)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    array = pa.array(texts, pa.string())
    for table, pattern in ((NON_SPACE, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = Words(array, table, lower=True)
        got = words.strings(np.arange(len(words.start))).to_pylist()
        expected = [re.findall(pattern, lower(t)) for t in texts]
        assert got == [w for ws in expected for w in ws]
        assert words.count.tolist() == [len(ws) for ws in expected]
        hashes = words.hashes().tolist()
        assert len(set(zip(got, hashes))) == len(set(got)) == len(set(hashes))


def test_slices_cover_all_rows_and_never_cut_a_text():
    array = pa.array(["a" * n for n in (5, 0, 1000, 3, 3)] + [None], pa.string())
    parts = list(slices(array, 8))
    assert parts[0][0] == 0 and parts[-1][1] == 6 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert list(slices(pa.array([], pa.string()))) == []


def test_signatures_estimate_jaccard_and_stop_early_without_change():
    rng = np.random.default_rng(1)
    common, x, y = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 100, 100))
    sets = [np.concatenate([common, x]), np.concatenate([common, y]), common[:3], np.zeros(0, np.uint64)]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    sig = superminhash.signatures(np.concatenate(sets), first)
    assert abs((sig[0] == sig[1]).mean() - 0.75) < 0.12
    assert (sig[3] == 0xFFFFFFFF).all() and (sig[2] < 0xFFFFFFFF).all()
    again = superminhash.signatures(np.concatenate([sets[0], sets[0]]), np.array([0, 1400]))  # repeats change nothing
    assert (again[0] == sig[0]).all()


def test_positions_are_permutations():
    keys = np.random.default_rng(2).integers(0, 1 << 63, 50, dtype=np.uint64)
    seen = np.stack([superminhash._position(keys, r) for r in range(superminhash.M)])
    assert all(sorted(seen[:, i].tolist()) == list(range(superminhash.M)) for i in range(50))


def test_short_texts_are_one_shingle():
    sets = shingle_sets(pa.array(["a b", "A  b", "a b c", "", None, "a b c d e", "a b c d e f", "a b a b a b a b a b"]))
    assert [len(s) for s in sets] == [1, 1, 1, 0, 0, 1, 2, 2]
    assert sets[0][0] == sets[1][0] != sets[2][0]


def test_grams_and_winnowing_match_plain_loops():
    rng = np.random.default_rng(4)
    words = Words(pa.array(["a"]), NON_SPACE, lower=True)
    for n, k in ((0, 3), (1, 1), (5, 9), (300, 26)):
        x = rng.integers(0, 40, n).astype(np.uint64)
        plain = np.zeros(n, np.uint64)
        for j in range(min(k, n)):
            plain[: n - j] += x[j:] * powers(k + 2)[0][j + 1]
        assert (words.grams(x, k) == mix(plain)).all()
        whole = rng.random(max(0, n - k + 1)) < 0.8
        kept = {i + max(range(k), key=lambda j: (-int(x[i + j]), j)) for i in np.flatnonzero(whole)}
        assert winnow(x, whole, k).tolist() == sorted(kept)


def test_shingle_sets_are_sorted_and_distinct():
    sets = shingle_sets(pa.array(["a b c d e f a b c d e f a b c d e", "a b", ""]))
    assert [len(s) for s in sets] == [6, 1, 0] and all((np.diff(s.astype(object)) > 0).all() for s in sets)
