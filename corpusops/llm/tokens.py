"""Word hashes of many texts at once, straight from Arrow's UTF-8 buffers.

White space and A-Z are ASCII, so splitting and lower-casing bytes gives the same words as on code
points. A word's 64-bit hash is a polynomial over a random byte table, taken for all words of a block
from one running sum, then mixed. No Python string is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_RNG = np.random.default_rng(20240601)
_FOLDED = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_FOLDED[65:91] = _FOLDED[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_P = 0x9E3779B97F4A7C15 | 1
_Q = pow(_P, -1, 1 << 64)
_POWERS = {}

M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(33))) * M1
    h = (h ^ (h >> np.uint64(33))) * M2
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, BLOCK), base, dtype=np.uint64)
        out[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(out)
    return have[:n]


def _block(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in ``data``; texts begin at ``begins``."""
    is_word = ~_SPACE[data]
    before = np.empty_like(is_word)
    before[0], before[1:] = False, is_word[:-1]
    after = np.empty_like(is_word)
    after[-1], after[:-1] = False, is_word[1:]
    inner = begins[(begins > 0) & (begins < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    ends = np.flatnonzero(is_word & ~after) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_FOLDED[data] * _powers(_P, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * _powers(_Q, len(data))[starts]), starts


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string column; null texts are empty."""
    column = column.fill_null("") if column.null_count else column
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per group of texts: index of its first text, the word hashes (uint64), and bounds (texts + 1) into them.

    A group has about BLOCK bytes of whole texts; a longer text is a group of its own, hashed in pieces
    that end at white space, so working memory does not depend on its length.
    """
    offsets, data = text_buffers(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1)
        s, e = offsets[i], offsets[j]
        if e - s > BLOCK:
            pieces, at = [], s
            while at < e:
                to = min(at + BLOCK, e)
                while to < e and not _SPACE[data[to]]:
                    gap = np.flatnonzero(_SPACE[data[to:min(to + BLOCK, e)]])
                    to = to + gap[0] if len(gap) else min(to + BLOCK, e)
                pieces.append(_block(data[at:to], np.zeros(0, np.int64))[0])
                at = to
            found = np.concatenate(pieces)
            yield i, found, np.array([0, len(found)])
        elif e > s:
            found, starts = _block(data[s:e], offsets[i:j] - s)
            yield i, found, np.searchsorted(starts, offsets[i:j + 1] - s)
        else:
            yield i, np.zeros(0, np.uint64), np.zeros(j - i + 1, np.int64)
        i = j


_MULTIPLIERS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5),
                np.uint64(0x85EBCA77C2B2AE63)]


def sequence_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of words at the same index of several arrays, in order."""
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for i, c in enumerate(columns):
        out = mix(out * _MULTIPLIERS[i % len(_MULTIPLIERS)] + c)
    return out


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles; the whole sequence if it is shorter."""
    for _, hashes, bounds in word_hashes(column):
        grams = sequence_hash([hashes[i:len(hashes) - width + 1 + i] for i in range(width)]) if len(hashes) >= width else hashes[:0]
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if e - s >= width:
                yield np.unique(grams[s:e - width + 1])
            elif e > s:
                yield sequence_hash([hashes[i:i + 1] for i in range(s, e)])
            else:
                yield hashes[:0]
