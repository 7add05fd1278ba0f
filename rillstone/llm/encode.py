"""Fast use of a tokenizers file inside tasks: each distinct word of a block is looked up once.

Results equal the library's own.  A text is cut where no token reaches across: for vocabularies
that keep a leading space at single spaces and newlines between ink, for those that drop white
space at every space and newline.  Texts with other white space go to the library whole.  Words
are told apart by a 64-bit hash.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np

from rillstone.llm.kernels import blocks

#: Bytes of known words kept per worker, with about WORD_COST for each beside its ids; beyond that the cache starts anew.
CACHE_BYTES = 150_000_000
WORD_COST = 180
#: Texts with a longer word go to the library whole.
LONG_WORD = 1000

_RNG = np.random.default_rng(77)
_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = _RNG.integers(1, 1 << 63, LONG_WORD + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_odd_space = re.compile(rb"\xc2[\x85\xa0]|\xe1(\x9a\x80|\xa0\x8e)|\xe2\x80[\x80-\x8d\xa8\xa9\xaf]|\xe2\x81[\x9f\xa0]|\xe3\x80\x80|\xef\xbb\xbf")
_ODD = np.zeros(256, np.uint8)
_ODD[[0, 9, 11, 12, 13, 28, 29, 30, 31]] = 1
_ODD[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = 2
_loaded: dict[str, "WordEncoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class BlockEncoder:
    """Encodes many texts at once: cuts them into words, looks up each distinct word, joins the ids."""

    cache_bytes = CACHE_BYTES

    def __init__(self):
        self.known: dict[int, bytes] = {}
        self.held = 0

    def whole(self, text: str) -> bytes:
        """The ids of a whole text."""
        raise NotImplementedError

    def _words(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the words of texts start and stop, and their hashes."""
        raise NotImplementedError

    def _lookup(self, words: list[bytes], opens: list[bool]) -> list[bytes]:
        """The ids of words; opens tells which begin a text."""
        raise NotImplementedError

    def _long_or_odd(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which texts must be encoded whole."""
        raise NotImplementedError

    def _block(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of texts without odd space, one after another, and how many each has."""
        n = len(starts) - 1
        parts = []
        for i, j in blocks(starts):
            a = starts[i]
            first, stop, sums = self._words(data[a : starts[j]], starts[i : j + 1] - a) if starts[j] > a else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
            parts.append((first + a, stop + a, sums))
        first, stop, sums = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
        if not len(first):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        new = np.ones(len(sums), bool)
        new[1:] = sums[1:] != sums[:-1]
        distinct, where = sums[new].tolist(), order[new]
        number = np.empty(len(sums), np.int64)
        number[order] = np.cumsum(new) - 1
        known = self.known
        ids = list(map(known.get, distinct))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            a, b = first[where[missing]], stop[where[missing]]
            opens = (starts[np.searchsorted(starts, a)] == a).tolist()
            for i, found in zip(missing, self._lookup([data[i:j].tobytes() for i, j in zip(a.tolist(), b.tolist(), strict=True)], opens), strict=True):
                ids[i] = known[distinct[i]] = found
                self.held += WORD_COST + len(found)
        if self.held > self.cache_bytes:
            self.known, self.held = {}, 0
        size = np.array(list(map(len, ids))) // 4
        flat, begin_of = np.frombuffer(b"".join(ids), np.uint32), np.cumsum(size) - size
        count = size[number]
        ends = np.cumsum(count)
        out = flat[np.repeat(begin_of[number] - (ends - count), count) + np.arange(ends[-1])]
        per_text = np.diff(np.concatenate([[0], ends])[np.searchsorted(first, starts)])
        return out, per_text

    def __call__(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts on end as unsigned 32-bit integers, and the n + 1 places where texts start."""
        parts, counts = [], []
        odd = self._long_or_odd(data, starts)
        edges = np.flatnonzero(np.diff(np.concatenate([[True], odd, [True]]).astype(int)))
        runs = sorted({0, len(odd), *edges.tolist()})
        for a, b in zip(runs[:-1], runs[1:], strict=True):
            if odd[a]:
                for i in range(a, b):
                    ids = np.frombuffer(self.whole(data[starts[i] : starts[i + 1]].tobytes().decode()), np.uint32)
                    parts.append(ids)
                    counts.append(np.array([len(ids)]))
                continue
            for i, j in blocks(starts[a : b + 1], 1 << 20):
                ids, per_text = self._block(data[starts[a + i] : starts[a + j]], starts[a + i : a + j + 1] - starts[a + i])
                parts.append(ids)
                counts.append(per_text)
        counts = np.concatenate([np.zeros(1, np.int64), *counts])
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.cumsum(counts)

class WordEncoder(BlockEncoder):
    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        probe = [self.whole(x) for x in ("a b\nc d", "a", " b", "\n", "c", " d", "b", "d")]
        self.drops_space = probe[0] == probe[1] + probe[6] + probe[4] + probe[7]
        self.keeps_space = not self.drops_space and probe[0] == b"".join(probe[1:6])
        self.letters = _byte_letters()
        self.lowers = self.whole("AB") == self.whole("ab")
        self.direct = all(self.short(w) == self.whole(w) for w in ("ab", "Straße", "naïve.", "foo,") + ((" ab", " Été") if self.keeps_space else ()))

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, text: str) -> bytes:
        """One pre-token, straight through the merges."""
        if text.isascii():
            shown = "Ġ" + text[1:] if text[0] == " " else text
        else:
            shown = text.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def short(self, word: str) -> bytes | None:
        """ids of a word of letters, perhaps with marks after it; None for other words."""
        space, ink = (" ", word[1:]) if word[0] == " " else ("", word)
        if ink.isalpha():
            letters, marks = ink, ""
        else:
            letters = ink.rstrip(".,;:!?|-)(][\"")
            marks = ink[len(letters) :]
            if not letters.isalpha():
                return None
        if self.lowers and not letters.isascii():
            if "Σ" in letters or "İ" in letters or not unicodedata.is_normalized("NFC", letters):
                return None
        if self.lowers:
            letters = letters.lower()
        return self.piece(space + letters) + (self.piece(marks) if marks else b"")

    def _lookup(self, words: list[bytes], opens: list[bool]) -> list[bytes]:
        return [self.word(w.rstrip(b" \n") if self.drops_space else w) for w in words]

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        out = self.short(text) if self.direct else None
        return self.whole(text) if out is None else out

    def _words(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the words of texts without odd space start and stop, and their hashes."""
        gap = (data == 32) | (data == 10)
        begin = np.zeros(len(data) + 1, bool)
        begin[starts] = True
        begin = begin[:-1]
        if self.drops_space:
            begin[1:] |= gap[:-1]
            begin &= ~gap
        else:
            begin |= gap
            begin[1:] |= data[:-1] == 10
        first = np.flatnonzero(begin)
        if not len(first):
            return first, first, np.zeros(0, np.uint64)
        stop = np.append(first[1:], len(data))
        inside = np.arange(len(data)) - np.repeat(first, stop - first) if first[0] == 0 else np.arange(len(data)) - first[np.maximum(np.cumsum(begin) - 1, 0)]
        code = _CODES[data] * _PLACES[np.minimum(inside, LONG_WORD)]
        if self.drops_space:
            code[gap] = 0
        sums = np.add.reduceat(code, first)
        return first, stop, sums ^ (sums >> np.uint64(31))

    def _long_or_odd(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which texts must go to the library whole."""
        odd = np.zeros(len(starts) - 1, bool)
        if not (self.keeps_space or self.drops_space):
            odd[:] = True
            return odd
        gap = (data == 32) | (data == 10)
        edge = gap.copy()
        edge[starts[:-1][starts[:-1] < len(data)]] = True
        edges = np.append(np.flatnonzero(edge), len(data))
        wide = np.flatnonzero(np.diff(edges) > LONG_WORD)
        odd[np.searchsorted(starts, edges[wide], "right") - 1] = True
        if self.keeps_space:
            flags = _ODD[data]
            odd[np.searchsorted(starts, np.flatnonzero(flags == 1), "right") - 1] = True
            twice = np.flatnonzero(gap[1:] & gap[:-1])
            odd[np.searchsorted(starts, twice, "right") - 1] = True
            if (flags == 2).any():
                raw = data.tobytes()
                places = [m.start() for m in _odd_space.finditer(raw)]
                odd[np.searchsorted(starts, np.array(places, np.int64), "right") - 1] = True
            full = np.flatnonzero(np.diff(starts))
            odd[full] |= gap[starts[full]] | gap[starts[full + 1] - 1]
        return odd

def encoder(path: str) -> WordEncoder:
    """The encoder of a tokenizers file, loaded once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]
