from __future__ import annotations

import struct

import public_tokenizers
import pytest
import sentencepiece

from traitlens.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
EDGES = ["a  b", "  lead ", "tab\tx\r\n", "é ﬁ ½ 日本語 😀", "▁x", "<s> </s> <unk> <0x41>", "\x00z", "a" * 5000, "ab" * 300 + " ", " ", "\n\n   \n", "x ", "x  ", "  "]


def test_parity_with_the_model_on_given_texts_and_edges(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(EDGES)] + [(20_000, None), (20_001, ""), (20_001, ""), (None, "x"), (20_002, "word " * 50_000)]
    reference = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = pieces.encode(make_docs(rows), PATH)
    by_id: dict = {}
    for r in got.collect():
        by_id.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        for r in by_id[i]:
            assert r.ids == (None if text is None else reference.encode(text))
            assert r.n_tokens == (None if text is None else len(r.ids))
            assert r.round_trip is (None if text is None else "▁" not in text)
    assert sum(map(len, by_id.values())) == len(rows)
    back = {r.doc_id: r.text for r in pieces.decode(got.where("doc_id < 20000"), PATH).collect()}
    assert all(back[i] == reference.decode(reference.encode(t)) for i, t in rows if i is not None and i < 20_000)
    assert pieces.encode(make_docs([]).limit(0), PATH).collect() == []


def field(number, kind, value):
    if kind == 2:
        return bytes([number << 3 | 2, len(value)]) + value
    return bytes([number << 3 | kind]) + value


def unigram_model():
    """A hand-written unigram model with byte fallback."""
    vocabulary = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    vocabulary += [(p, s, 1) for p, s in [("▁", -2.0), ("a", -3.0), ("b", -3.5), ("ab", -4.0), ("▁a", -4.2), ("▁ab", -5.0), ("ba", -5.5), ("▁aba", -6.5), ("c", -4.5), ("é", -6.0)]]
    data = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in vocabulary)
    trainer = field(3, 0, b"\x01") + bytes([35 << 3 & 0x7F | 0x80, 35 >> 4, 1])  # model_type unigram, byte_fallback
    return data + field(2, 2, trainer) + field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01"))


def test_unigram_models_are_rebuilt_with_their_scores():
    data = unigram_model()
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = pieces.read_model(data)
    assert model.kind == pieces.UNIGRAM and not model.trim_spaces and model.dummy_prefix and pieces.separable(model)
    tokenizer = pieces.build(model)
    for text in ["ab", "aba ab", "abab  c", "é x😀", "cab abc b a", "a" * 20]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == reference.encode(text)
        assert tokenizer.decode(ids, skip_special_tokens=False) == reference.decode(ids)


def test_suffix_models_are_refused():
    with pytest.raises(ValueError):
        pieces.read_model(field(2, 2, bytes([24 << 3 & 0x7F | 0x80, 24 >> 4, 1])))
