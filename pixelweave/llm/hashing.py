"""Vectorised 64-bit hashes of byte spans, words and shingles.

A span is read eight bytes a step; each step mixes them into what the steps before gave, so that no algebra of the bytes
(as in polynomials modulo a power of two) makes different spans meet. All results hold up to collisions of 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np

BASE = 0x9E3779B97F4A7C15
U = np.uint64
#: Spans above this go through BLAKE2b whole: steps over few spans cost more there.
LONG_SPAN = 512
#: Masks of the first k bytes of a step.
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def byte_values(seed: int) -> np.ndarray:
    """256 fixed random-looking values."""
    return mix((np.arange(1, 257, dtype=U) * U(BASE)) ^ U(seed))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of spans [start, end) of one byte array."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    steps = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    size = (ends - starts).astype(np.int64)
    out = mix(size.astype(U) * U(BASE) + U(seed))
    wide = np.flatnonzero(size > LONG_SPAN)
    if len(wide):
        raw, key = padded.data, (seed + 1).to_bytes(8, "little")
        out[wide] = [int.from_bytes(hashlib.blake2b(raw[a:b], digest_size=8, key=key).digest(), "little") for a, b in zip(starts[wide].tolist(), ends[wide].tolist(), strict=True)]
        k = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    else:
        k = np.flatnonzero(size > 0)
    at, left = starts[k], size[k]
    while len(k):
        out[k] = mix(out[k] ^ (steps[at] & MASKS[np.minimum(left, 8)]))
        more = left > 8
        k, at, left = k[more], at[more] + 8, left[more] - 8
    return out


WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of other bytes than white space, within a document) and each document's first word."""
    own = ~WHITE[data]
    first, last = own.copy(), own.copy()
    first[1:] &= ~own[:-1]
    last[:-1] &= ~own[1:]
    edge = offs[(offs > 0) & (offs < len(data))]
    first[edge] = own[edge]
    last[edge - 1] = own[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


STEPS = mix(np.arange(101, 106, dtype=U)) | U(1)


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """For each document the distinct hashes of its k-word shingles, A-Z lowered; with fewer words, of all of them."""
    starts, ends, at = words(data, offs)
    one = span_hashes(LOWER[data], starts, ends)
    grams = np.zeros(max(0, len(one) - k + 1), U)
    for j in range(k):
        grams += one[j : j + len(grams)] * STEPS[j]
    grams = mix(grams)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            short = U(b - a)
            for x in one[a:b]:
                short = mix(np.array([short ^ x]) * U(BASE))[0]
            out.append(np.array([short], U))
        else:
            out.append(np.zeros(0, U))
    return out


def set_digest(grams: np.ndarray, salt: int = 0xA0761D6478BD642F) -> int:
    """One value for equal sets: signed 64 bits, never 0 but for the empty set."""
    if not len(grams):
        return 0
    d = mix(np.array([mix(grams ^ U(salt)).sum(dtype=U) + U(len(grams))]))
    return int(d.view(np.int64)[0]) or 1
