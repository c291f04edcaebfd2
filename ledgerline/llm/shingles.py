"""Word shingles of many texts at once, in numpy over their UTF-8 bytes.

A word is a run of digits, letters (A-Z as a-z) and bytes from 0x80 on. A
shingle is the 64-bit hash of five consecutive words; a text of fewer, but not
none, has one shingle of all its words.
"""

from __future__ import annotations

import numpy as np

from ledgerline.llm.common import mix64

SIZE = 5
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64), 0x9E3779B97F4A7C15)
_PLACE = mix64(np.arange(1, 65, dtype=np.uint64), 0xC2B2AE3D27D4EB4F) | np.uint64(1)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and offsets of the texts' words."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    low = _LOWER[data]
    inside = _WORD[low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]  # a text starts a word of its own
    starts = np.flatnonzero(first)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    word_of = np.cumsum(first)[at] - 1
    with np.errstate(over="ignore"):
        value = _LETTER[low[at]] * _PLACE[(at - starts[word_of]) & 63]
        cuts = np.searchsorted(at, starts)
        hashes = mix64(np.add.reduceat(value, cuts))
    return hashes, np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, how often each occurs,
    and offsets of the texts."""
    w, at = words(data, offsets)
    n = len(at) - 1
    with np.errstate(over="ignore"):
        if len(w) >= size:
            s = np.zeros(len(w) - size + 1, np.uint64)
            for j in range(size):
                s = s + w[j:len(w) - size + 1 + j] * _PLACE[j]
            s = mix64(s)
        else:
            s = np.zeros(0, np.uint64)
        count = np.diff(at)
        per = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
        out_at = np.concatenate([np.zeros(1, np.int64), np.cumsum(per)])
        out = np.zeros(out_at[-1], np.uint64)
        for k in range(n):
            a, b = out_at[k], out_at[k + 1]
            if count[k] >= size:
                out[a:b] = s[at[k]:at[k] + b - a]
                out[a:b].sort()
            elif count[k]:
                own = w[at[k]:at[k + 1]]
                out[a] = mix64((own * _PLACE[:len(own)]).sum(keepdims=True, dtype=np.uint64), int(len(own)))[0]
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    edges = out_at[:-1][out_at[:-1] < len(out)]
    new[edges] = True
    keep = np.flatnonzero(new)
    times = np.diff(np.append(keep, len(out)))
    return out[keep], times, np.searchsorted(keep, out_at)
