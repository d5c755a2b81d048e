"""SuperMinHash signatures of hashed sets, vectorised over the elements of many sets.

Every element ranks the ``M`` signature positions by its own pseudo-random permutation; position ``p`` keeps the least
``rank + random fraction`` any element gives it.  The ranks of one element are all different, so its values are
negatively correlated over positions and the estimate varies less than with independent minima.  Ranks are handled in
rising order for all elements at once; a set stops as soon as its largest kept value is below the next rank, since no
later rank could lower any position (large sets stop after a round or two).
"""

from __future__ import annotations

import numpy as np

from .textvec import U64, mix

M = 128
_FRACTION_BITS = 25
_EMPTY = np.uint32(0xFFFFFFFF)


def _position(keys: np.ndarray, rank: int) -> np.ndarray:
    """Position that each element puts at ``rank``: a keyed bijection of 0..127."""
    k = keys.astype(np.uint32)
    x = (np.uint32(rank) * ((k & 127) | 1) + ((k >> 7) & 127)) & 127
    x ^= x >> 3
    x = (x * (((k >> 14) & 127) | 1) + ((k >> 21) & 127)) & 127
    return x ^ (x >> 4)


def signatures(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``uint32[n, M]`` signatures of the sets ``keys[first[i]:first[i+1]]`` (repeats allowed; empty sets stay at the maximum)."""
    n = len(first) - 1
    sig = np.full((n, M), _EMPTY, np.uint32)
    flat = sig.ravel()
    owner = np.repeat(np.arange(n), np.diff(first))
    for rank in range(M):
        value = (mix(keys + U64((rank + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> U64(64 - _FRACTION_BITS)).astype(np.uint32)
        np.minimum.at(flat, owner * M + _position(keys, rank), value | np.uint32(rank << _FRACTION_BITS))
        if rank + 1 < M:
            going = (sig.max(axis=1) >= np.uint32((rank + 1) << _FRACTION_BITS))[owner]
            if not going.any():
                break
            keys, owner = keys[going], owner[going]
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """``uint64[n, M / rows]`` hash of each band of ``rows`` positions, with the band's number mixed in."""
    bands = sig.reshape(len(sig), -1, rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64) * U64(0xD6E8FEB86659FD93), bands.shape[:2]).copy()
    for j in range(rows):
        out = mix(out + bands[:, :, j] * U64(0x9E3779B97F4A7C15) + U64(j + 1))
    return out
