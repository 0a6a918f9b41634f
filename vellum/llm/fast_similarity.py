"""Fast similarity sketching of shingle sets (NumPy, whole batches).

A set's sketch has ``t`` coordinates. In round i of the first t rounds every
element is thrown into a hashed bin with the value (i, hashed fraction); in
round t + j every element is thrown into bin j. A coordinate keeps the least
value it has seen. The first t rounds fill nearly all bins of a set with more
than a few elements at once, the second t rounds fill whatever is left, so
every coordinate is filled; a set is done as soon as all its bins are, which
takes O(|A| + t log t) expected time. Two sets agree in a coordinate with
probability equal to their Jaccard similarity, and the number of agreeing
coordinates is as concentrated as for independent MinHashes.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
# Odd 64-bit multipliers of a published finaliser, and of the byte hash (fixed values).
MIX_A, MIX_B = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
STEP, BASE = _U(0x9E3779B97F4A7C15), _U(0x2D358DCCAA6C78A5)
UNSEEN = np.iinfo(np.uint64).max

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> _U(30))) * MIX_A
    x = (x ^ (x >> _U(27))) * MIX_B
    return x ^ (x >> _U(31))


def seed(i: int) -> np.ndarray:
    """The i-th seed, as an array of one (arrays wrap silently)."""
    return mix(np.array([i], np.uint64) * STEP)


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a UTF-8 text (words are runs without
    ASCII white space; A-Z count as a-z). A word's hash depends on its bytes
    alone: the bytes of a word go into eight-byte lanes that are mixed in
    order, all words at once."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    # the eight bytes from every position, little-endian
    lanes = np.lib.stride_tricks.sliding_window_view(padded, 8)
    h = mix(length.astype(np.uint64) + STEP)
    live = np.arange(len(start))
    offset = 0
    while len(live):
        take = np.minimum(length[live] - offset, 8)
        lane = np.ascontiguousarray(lanes[start[live] + offset]).view("<u8").ravel()
        lane = np.where(take < 8, lane & ((_U(1) << (take.astype(np.uint64) * _U(8) % _U(64))) - _U(1)), lane)
        h[live] = mix((h[live] ^ lane) * BASE + STEP)
        offset += 8
        live = live[length[live] > offset]
    return h


def shingle_hashes(raw: bytes, size: int = 5) -> np.ndarray:
    """The distinct ``size``-word shingles of a text as sorted 64-bit hashes;
    a shorter text is one shingle, a text without words has none."""
    words = word_hashes(raw)
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    h = np.zeros(n - size + 1, np.uint64) + seed(size)
    for k in range(size):
        h = mix((h ^ words[k:n - size + 1 + k]) * BASE + STEP)
    return np.unique(h)


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """The sketches of many non-empty sets: an array of len(sets) x t."""
    out = np.full((len(sets), t), UNSEEN, np.uint64)
    if not sets:
        return out
    flat = out.reshape(-1)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for i in range(2 * t):
        h = mix(values ^ seed(i + 1))
        if i < t:
            bins = (((h >> _U(32)) * _U(t)) >> _U(32)).astype(np.int64)
        else:
            bins = i - t
        value = (_U(i) << _U(48)) | (mix(h) >> _U(16))
        np.minimum.at(flat, owner * t + bins, value)
        todo = (out == UNSEEN).any(axis=1)
        if not todo.any():
            break
        if not todo.all():
            live = todo[owner]
            values, owner = values[live], owner[live]
    return out


def bands(sketch: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """A hash for each band of ``rows`` coordinates: len(sets) x n_bands."""
    h = np.zeros((len(sketch), n_bands), np.uint64) + mix(np.arange(1, n_bands + 1, dtype=np.uint64))
    for k in range(rows):
        h = mix((h ^ sketch[:, k:n_bands * rows:rows]) * BASE + STEP)
    return h


def common(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
