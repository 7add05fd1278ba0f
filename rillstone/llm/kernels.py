"""Vectorised text kernels: rolling hashes, winnowing, words and shingles over many texts at once."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240607)
BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_RNG.integers(1 << 62, 1 << 63)) | 1
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """The hash of each q-byte string of data, by doubling."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, width, out, have = BYTE_CODES[data], 1, None, 0
    rest = q
    while True:
        if rest & 1:
            if out is None:
                out, have = power, width
            else:
                m = len(power) - have
                out = power[:m] * np.uint64(pow(BASE, have, 1 << 64)) + out[width : width + m]
                have += width
        rest >>= 1
        if not rest:
            return mix(out[:n])
        power = power[: len(power) - width] * np.uint64(pow(BASE, width, 1 << 64)) + power[width:]
        width *= 2


def leftmost_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of w values the place of the leftmost value that is least in its upper 32 bits."""
    value, width = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), 1
    while 2 * width <= w:
        value = np.minimum(value[:-width], value[width:])
        width *= 2
    if width < w:
        value = np.minimum(value[: width - w], value[w - width :])
    return (value & np.uint64(0xFFFFFFFF)).astype(np.int64)


def blocks(starts: np.ndarray, size: int = 1 << 15):
    """Runs (i, j) of whole texts of about size bytes: small enough for arrays that stay in the cache."""
    i, n = 0, len(starts) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = j


def _anchors(data: np.ndarray, starts: np.ndarray, n: int, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Winnowed anchors: (text number, anchor, first window, last window, gram hash).

    Every n-byte window of a text has one anchor, the leftmost q-gram with the least hash in it;
    equal windows have equal anchors at equal places.  Windows of one anchor are consecutive.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < n:
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    h = gram_hashes(data, q)
    place = leftmost_minimum(h, n - q + 1)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(place)]
    valid = np.arange(len(place)) + n <= starts[text + 1]
    at = np.flatnonzero(valid)
    if not len(at):
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    place, text = place[at], text[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return text[first], place[first], at[first], at[last], h[place[first]]


def anchors(data: np.ndarray, starts: np.ndarray, n: int, q: int) -> tuple[np.ndarray, ...]:
    """_anchors over all texts, a block of texts at a time."""
    parts = []
    for i, j in blocks(starts):
        text, *places, h = _anchors(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], n, q)
        parts.append((text + i, *(p + starts[i] for p in places), h))
    if not parts:
        return tuple(np.zeros(0, np.uint64 if k == 4 else np.int64) for k in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word (a run of bytes other than ASCII white space, A-Z lower-cased) and its text's number."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ink = ~SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    begin = ink.copy()
    begin[1:] &= ~ink[:-1] | cut[1:-1]
    first = np.flatnonzero(begin)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    stop = ink.copy()
    stop[:-1] &= ~ink[1:] | cut[1:-1]
    length = np.flatnonzero(stop) + 1 - first
    # white space adds nothing to a word's sum; each byte counts by its place in its word
    number = np.cumsum(begin) - 1
    inside = np.arange(len(data)) - first[np.maximum(number, 0)]
    code = mix(BYTE_CODES[LOWER[data]] + inside.astype(np.uint64) * np.uint64(BASE))
    code[~ink] = 0
    total = np.add.reduceat(code, first)
    return mix(total + length.astype(np.uint64)), np.searchsorted(starts, first, "right") - 1


def _shingles(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted by (text, hash), and their texts' numbers.

    A text of fewer than width words, but at least one, has its whole sequence as one shingle.
    """
    h, text = words(data, starts)
    if not len(h):
        return h, text
    count = np.bincount(text, minlength=len(starts) - 1)
    total = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for k in range(width):
        total += mix(h[k : k + len(total)] + np.uint64(k + 1)) * np.uint64(2 * k + 1)
    whole = text[: len(total)] == text[width - 1 :] if len(total) else np.zeros(0, bool)
    total, owner = mix(total)[whole], text[: len(whole)][whole]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.concatenate([[0], np.cumsum(count)])[short]
        extra = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            extra[has] += mix(h[first[has] + k] + np.uint64(k + 1)) * np.uint64(2 * k + 1)
        total = np.concatenate([total, mix(extra + np.uint64(width))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((total, owner))
    total, owner = total[order], owner[order]
    keep = np.ones(len(total), bool)
    keep[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    return total[keep], owner[keep]


def shingles(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """_shingles over all texts, a block of texts at a time."""
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for i, j in blocks(starts):
        h, text = _shingles(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], width)
        parts.append((h, text + i))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
