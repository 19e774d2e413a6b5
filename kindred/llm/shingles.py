"""Shingle sets as sorted 64-bit hashes, and circulant MinHash signatures of them."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from kindred.llm.arrow import word_codes

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
_UNIVERSE_BITS = 22


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit integers that scatters them (splitmix64's finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: of `width` words, A-Z in lower case.

    A text with fewer words is one shingle, with none it is the empty set.
    """
    names, codes, offsets = word_codes(pc.ascii_lower(texts))
    word = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in names), np.uint64, len(names))[codes]
    n = max(len(word) - width + 1, 0)
    power, whole = 1, np.zeros(n, np.uint64)
    for k in range(width):
        whole += word[k : k + n] * np.uint64(power)
        power = power * (_STEP | 1) % (1 << 64)
    whole, out = mixed(whole), []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            short = xxhash.xxh3_64_intdigest(word[a:b].tobytes(), seed=b - a)
            out.append(np.array([short], np.uint64))
        else:
            out.append(word[:0])
    return out


def bands_for(similarity: float, rows: int = 4, miss: float = 1e-7) -> int:
    """Bands of `rows` coordinates each, so that a pair as similar as this is missed with probability `miss` at most."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


@lru_cache(maxsize=4)
def _shifts(k: int) -> np.ndarray:
    """Row p holds pi[p], pi[p - 1], ... pi[p - k + 1] (circular) in some fixed order: the k shifts of one permutation, as a view."""
    pi = np.random.default_rng(2021).permutation(1 << _UNIVERSE_BITS).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi[len(pi) - k + 1 :], pi]), k)


def signature(shingles: np.ndarray, k: int) -> np.ndarray:
    """k MinHash coordinates of a non-empty set from two permutations.

    The first one (a bijection of the hashes, of which the leading bits count)
    gives each shingle its place; the second is a table.  Coordinate i is the
    table's least value over the places, all shifted by i around the circle.
    """
    table, out = _shifts(k), None
    places = (mixed(shingles + np.uint64(_STEP)) >> np.uint64(64 - _UNIVERSE_BITS)).astype(np.int64)
    for i in range(0, len(places), 4096):
        low = table[places[i : i + 4096]].min(axis=0)
        out = low if out is None else np.minimum(out, low)
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of a signature."""
    x = sig.reshape(bands, -1).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(x.shape[1]):
        key = mixed(key + np.uint64(_STEP) * (x[:, j] + np.uint64(1)))
    return key.view(np.int64)
