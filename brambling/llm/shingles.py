"""Word n-grams of many texts at once, as 64-bit hashes in numpy.

Texts are lower-cased in A-Z and cut at the six ASCII white-space characters; all of that is seen in the
UTF-8 bytes, so a batch is one byte array.  A word's hash is a polynomial over random letters, mixed; an
n-gram's hash is a mixed sum of its words' hashes times odd constants.  A text with fewer words than n has
one n-gram, the whole of it; a text without words has none.  Two different n-grams share a hash with
probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20_240_601)
_LETTER = _RNG.integers(0, 2**64, 256, np.uint64) | np.uint64(1)
_ODD = _RNG.integers(0, 2**64, 64, np.uint64) | np.uint64(1)
_BASE, _STEP = int(_ODD[62]), int(_ODD[63])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all of it."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _word_hashes(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, byte position) of every word; ``begins`` are the positions at which texts begin."""
    blank = _SPACE[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    edge[1:] = blank[:-1]
    edge[begins[begins < len(data)]] = True
    starts = np.flatnonzero(edge & ~blank)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    inside = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    inside[blank] = 0
    value = _LETTER[_LOWER[data]] * _powers(_BASE, int(inside.max()) + 1)[inside]
    value[blank] = 0
    return mix(np.add.reduceat(value, starts)), starts


def _slices(array: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    size = np.cumsum(pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(array):
        upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES, "right"))
        upto = min(max(upto, at + 1), len(array))
        yield at, array.slice(at, upto - at)
        at = upto


def shingles(texts: pa.Array, n: int = 5) -> Iterator[tuple[int, np.ndarray, int]]:
    """(row, sorted distinct n-gram hashes, hash of the whole word sequence) of each text with a word."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    for row, part in _slices(texts):
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        if not len(data):
            continue
        word, at = _word_hashes(data, (offsets[:-1] - offsets[0]).astype(np.int64))
        if not len(word):
            continue
        owner = np.searchsorted(offsets - offsets[0], at, "right") - 1
        rows, first, count = np.unique(owner, return_index=True, return_counts=True)
        gram = np.zeros(max(len(word) - n + 1, 0), np.uint64)
        for k in range(n):
            gram += word[k:len(word) - n + 1 + k] * _ODD[k]
        gram = mix(gram)
        place = np.arange(len(word)) - np.repeat(first, count)
        whole = mix(np.add.reduceat(word * _powers(_STEP, int(count.max()))[place], first) + count.astype(np.uint64))
        for r, lo, c, h in zip(rows.tolist(), first.tolist(), count.tolist(), whole.tolist()):
            yield row + r, np.unique(gram[lo:lo + c - n + 1]) if c >= n else mix(np.array([h], np.uint64)), h
