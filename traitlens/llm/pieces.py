"""SentencePiece encoding and decoding (operator 5) on the ``tokenizers`` library.

The model protobuf is read by a small wire-format reader and rebuilt as a ``tokenizers`` pipeline: the normaliser
(precompiled character map, extra white space, dummy prefix), the metaspace marker U+2581, byte fallback, and the model
itself: unigram pieces with their scores, or byte-pair merges ordered by the pieces' scores.

Texts are cut before each run of spaces.  When no piece joins a character with a marker after it and the normaliser only
adds the dummy prefix (both are read from the model; else whole texts are encoded), no token crosses such a cut, so each
distinct chunk of a batch is encoded and decoded once and the texts' ids are put together from the chunks'.  Equal chunks
are found by hash and compared byte by byte.

Defined results: a null text has null ids, an empty text has none; every input row gives one row.  ``round_trip`` is
whether decoding the ids gives the text back (null for a null text); a text that holds the marker itself, or that the
normaliser changes, does not.  Other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textvec import range_hashes, slices

MARK = "▁"
THREADS = 2
BATCH_BYTES = 2 << 20  # more text in a batch saves encoding chunks again, at about 50 bytes of memory a byte
PART = 1 << 17  # chunks hashed at a time
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(field number, value)`` of a protobuf message; fixed-width and nested values as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind} is not used by model files")
        yield tag >> 3, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unk_id: int = 0
    char_map: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True
    suffix: bool = False


def read_model(data: bytes) -> Model:
    """Pieces, trainer and normaliser settings of a model file."""
    model = Model()
    for number, value in wire_fields(data):
        if number == 1:
            part = dict(wire_fields(value))
            score = float(np.frombuffer(part.get(2, b"\0\0\0\0"), "<f4")[0])
            model.pieces.append((part.get(1, b"").decode(), score, part.get(3, NORMAL)))
        elif number == 2:
            part = dict(wire_fields(value))
            model.kind, model.unk_id, model.suffix = part.get(3, UNIGRAM), part.get(40, 0), bool(part.get(24, 0))
        elif number == 3:
            part = dict(wire_fields(value))
            model.char_map = part.get(2, b"")
            model.dummy_prefix = bool(part.get(3, 1))
            model.trim_spaces = bool(part.get(4, 1))
            model.escape_spaces = bool(part.get(5, 1))
    if model.kind not in (UNIGRAM, BPE) or model.suffix or not model.escape_spaces:
        raise ValueError("only unigram and merge models with a prefix marker are supported")
    return model


def merges_of(model: Model) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best-scored result first (ties: by the halves' ids)."""
    ids = {piece: i for i, (piece, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, i in ids.items():
        score = model.pieces[i][1]
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-score, ids[left], ids[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def separable(model: Model) -> bool:
    """Whether no piece holds a marker after another character, so that no token crosses the start of a run of markers."""
    return not any(MARK in piece.lstrip(MARK) for piece, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))


def build(model: Model, chunks: bool = False):
    """The ``tokenizers`` pipeline that encodes and decodes like the model; ``chunks``: pieces of text that hold
    markers for their spaces already, so nothing is normalised, added or removed."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    by_bytes = any(kind == BYTE for *_, kind in model.pieces)
    steps = []
    if model.char_map:
        steps.append(normalizers.Precompiled(model.char_map))
    if model.trim_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix and not chunks:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    if model.kind == UNIGRAM:
        # Pieces of other types never come out of an encoding, so their scores are put below every other.
        low = min((s for _, s, kind in model.pieces if kind == NORMAL), default=0.0) - 1e6
        scored = [(p, s if kind in (NORMAL, USER_DEFINED) else low) for p, s, kind in model.pieces]
        tokenizer = Tokenizer(models.Unigram(scored, model.unk_id, by_bytes))
    else:
        vocabulary = {piece: i for i, (piece, *_) in enumerate(model.pieces)}
        unknown = model.pieces[model.unk_id][0]
        tokenizer = Tokenizer(models.BPE(vocabulary, merges_of(model), unk_token=unknown, fuse_unk=True, byte_fallback=by_bytes))
        if separable(model) and not chunks:
            tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    if not chunks:
        tokenizer.normalizer = normalizers.Sequence(steps)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(back + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix and not chunks else []))
    return tokenizer


@functools.lru_cache(maxsize=2)
def _cached(data: bytes):
    """``(whether chunks are encoded, tokenizer)``."""
    model = read_model(data)
    chunks = separable(model) and model.dummy_prefix and not model.char_map and not model.trim_spaces
    return chunks, build(model, chunks)


def _lists(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and offsets."""
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return np.fromiter(itertools.chain.from_iterable(parts), np.int32, int(bounds[-1])), bounds


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions ``start[i] .. start[i] + size[i] - 1`` one after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def _by_text(tokenizer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat ids, offsets and round trips of non-null texts, each text encoded as a whole."""
    values = texts.to_pylist()
    parts = [e.ids if v else [] for v, e in zip(values, tokenizer.encode_batch_fast(values, add_special_tokens=False))]
    back = tokenizer.decode_batch(parts, skip_special_tokens=False)
    return *_lists(parts), np.array([b == v for b, v in zip(back, values)], bool)


def _whole(tokenizer):
    """A copy of a chunk tokenizer that adds and removes the dummy prefix."""
    from tokenizers import Tokenizer, decoders, normalizers

    copy = Tokenizer.from_str(tokenizer.to_str())
    copy.normalizer = normalizers.Sequence([normalizers.Prepend(MARK), normalizers.Replace(" ", MARK)])
    copy.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), decoders.Strip(" ", 1, 0)])
    return copy


def _by_chunk(tokenizer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same from the distinct chunks of the batch."""
    n = len(texts)
    texts = texts.cast(pa.large_string())
    space = pa.scalar(" ", pa.large_string())
    joined = pc.binary_join_element_wise(space, pc.replace_substring(texts, MARK, " "), pa.scalar("", pa.large_string()))
    off = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + n + 1]
    buf = np.frombuffer(joined.buffers()[2], np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    first = buf == 0x20
    first[1:] &= buf[:-1] != 0x20
    first[off[:-1]] = True  # a text starts a chunk even after another text's last space
    start = np.flatnonzero(first)
    size = np.diff(np.concatenate([start, [len(buf)]]))
    # Hashing and comparing go through the chunks in parts, so that memory stays a few bytes per byte of text.
    parts = [slice(i, i + PART) for i in range(0, len(start), PART)]
    key = np.concatenate([range_hashes(buf[start[q][0] : start[q][-1] + size[q][-1]], start[q] - start[q][0], start[q] - start[q][0] + size[q]) for q in parts])
    _, chosen, which = np.unique(key, return_index=True, return_inverse=True)
    equal = bool((size == size[chosen][which]).all()) and all(
        np.array_equal(buf[_ranges(start[chosen][which[q]], size[q])], buf[start[q][0] : start[q][-1] + size[q][-1]]) for q in parts
    )
    if not equal:  # two different chunks with one hash
        one = [_by_chunk(tokenizer, texts.slice(i, 1)) for i in range(n)] if n > 1 else [_by_text(_whole(tokenizer), texts)]
        sizes = np.concatenate([[0], np.cumsum([len(o[0]) for o in one])])
        return np.concatenate([o[0] for o in one]), sizes, np.concatenate([o[2] for o in one])
    width = size[chosen]
    data = buf[_ranges(start[chosen], width)]
    chunks = pa.LargeStringArray.from_buffers(len(chosen), pa.py_buffer(np.concatenate([[0], np.cumsum(width)])), pa.py_buffer(data))
    encoded = [e.ids for e in tokenizer.encode_batch_fast(pc.replace_substring(chunks, " ", MARK).to_pylist(), add_special_tokens=False)]
    good = pc.equal(pa.array(tokenizer.decode_batch(encoded, skip_special_tokens=False), pa.large_string()), chunks).to_numpy(zero_copy_only=False)
    flat, bounds = _lists(encoded)
    empty = np.diff(off) == 1
    tokens = np.diff(bounds)[which]
    tokens[np.searchsorted(start, off[:-1][empty])] = 0  # an empty text has no dummy prefix
    ids = flat[_ranges(bounds[:-1][which], tokens)]
    of = np.searchsorted(start, off)
    total = np.concatenate([[0], np.cumsum(tokens)])[of]
    bad = np.concatenate([[0], np.cumsum(~good[which])])[of]
    marked = pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False)
    return ids, total, (np.diff(bad) == 0) & ~marked | empty


_SCHEMA = "doc_id long, ids array<int>, n_tokens long, ids_sha256 string, round_trip boolean"


def _encoder(model, threads: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        chunks, tokenizer = _cached(model.value)
        for batch in batches:
            for low, high in slices(batch["text"], BATCH_BYTES):
                texts = batch["text"].slice(low, high - low)
                null = texts.is_null()
                ids, bounds, same = (_by_chunk if chunks else _by_text)(tokenizer, texts.fill_null(""))
                digests = [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                nothing = pa.scalar(None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(low, high - low).cast(pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids), mask=null),
                        pc.if_else(null, nothing.cast(pa.int64()), pa.array(np.diff(bounds))),
                        pc.if_else(null, nothing.cast(pa.string()), pa.array(digests, pa.string())),
                        pc.if_else(null, nothing.cast(pa.bool_()), pa.array(same)),
                    ],
                    names=["doc_id", "ids", "n_tokens", "ids_sha256", "round_trip"],
                )

    return encode


def encode(docs: DataFrame, model_path: str, threads: int = THREADS) -> DataFrame:
    """Token ids of every text: ``(doc_id, ids, n_tokens, ids_sha256, round_trip)``.

    ``ids_sha256`` is the digest of the ids as little-endian 32-bit numbers.  The model file (about half a megabyte) is
    read on the driver and broadcast.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_encoder(model, threads), _SCHEMA)


def _decoder(model, threads: int):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        tokenizer = build(read_model(model.value))
        for batch in batches:
            ids = batch["ids"].to_pylist()
            texts = iter(tokenizer.decode_batch([i for i in ids if i is not None], skip_special_tokens=False))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([None if i is None else next(texts) for i in ids], pa.string())], names=["doc_id", "text"]
            )

    return decode


def decode(encoded: DataFrame, model_path: str, threads: int = THREADS) -> DataFrame:
    """Texts of ``(doc_id, ids)``: ``(doc_id, text)``; null ids give a null text."""
    with open(model_path, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(_decoder(model, threads), "doc_id long, text string")
