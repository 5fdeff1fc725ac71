"""Words and hashes of whole batches of texts, as arrays. Used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are handled at a time; a single longer text is handled alone.
CHUNK_BYTES = 1 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Letters, digits, and every byte of a character outside ASCII.
IS_WORD = (((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90))
           | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


class Words(NamedTuple):
    """Words of consecutive texts; word j of text i is at ``first[i] + j``."""

    hashes: np.ndarray   # one per word, of the word in lower case
    starts: np.ndarray   # byte at which it starts, within ``lower``
    ends: np.ndarray
    first: np.ndarray    # index of the first word of each text, and the number of words
    lower: np.ndarray    # the bytes of the texts, A-Z in lower case
    bounds: np.ndarray   # byte at which each text starts, and the number of bytes


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            grown = np.full(n, base, np.uint64)
            grown[0] = 1
            _powers[i] = np.multiply.accumulate(grown)
    return _powers[0][:n], _powers[1][:n]


def _sums(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the given stretches, by prefix sums over blocks of them."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
        piece = lower[base:int(ends[to - 1])]
        power, inverse = _power(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s])
        at = to
    return out


def words(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray = IS_WORD) -> Words:
    """Words of the texts ``data[bounds[i]:bounds[i + 1]]`` and their hashes."""
    lower = LOWER[data]
    inside = is_word[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    if len(before):
        before[0] = False
    edge = bounds[:-1][bounds[:-1] < len(data)]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(after):
        after[-1] = False
    edge = bounds[1:][bounds[1:] > 0] - 1
    after[edge] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(_sums(lower, starts, ends), starts, ends,
                 np.searchsorted(starts, bounds), lower, bounds)


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``first row, bytes, bounds`` of runs of texts of about ``size`` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive words; runs over the ends of texts are included."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[j:j + n]
    return mix(out)


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """The 64 bits of each hash as a row of 0 and 1, least significant first."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")


def packed(bits: np.ndarray) -> np.ndarray:
    """The reverse of ``bits_of``."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes, the smallest node reachable by the links ``a - b``."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root
