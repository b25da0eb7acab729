"""Hashes of the words of many texts at once.

A word's hash is a polynomial in its bytes, got for all words of a block from running sums: the
sum at the word's end less that at its start, divided by the power at its start (odd numbers have
inverses modulo 2**64). Each byte stands for a random 64-bit number, and the result is mixed, so
that the chance that two given words share a hash is about 2**-64.
"""

from __future__ import annotations

from typing import Iterable, Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BLOCK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of a sequence of hashes, which depends on their order."""
    out = parts[0]
    for k, part in enumerate(parts[1:], 1):
        out = mix(out + np.uint64((2 * k + 1) * _BASE & (1 << 64) - 1)) + part
    return mix(out)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """``classes`` gives for each byte 0 for a separator or the class of word it can be in."""

    def __init__(self, classes: np.ndarray, lower: bool = True):
        self.classes = classes
        self.numbers = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        if lower:
            self.numbers[65:91] = self.numbers[97:123]
        self.up, self.down = _powers(_BASE, BLOCK + 1), _powers(_INVERSE, BLOCK + 1)

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word of a block."""
        raw = np.frombuffer(data, np.uint8)
        if len(raw) >= len(self.up):
            self.up, self.down = _powers(_BASE, len(raw) + 1), _powers(_INVERSE, len(raw) + 1)
        kind = self.classes[raw]
        edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        starts = np.concatenate(([0], edge)) if len(raw) else edge
        ends = np.concatenate((edge, [len(raw)])) if len(raw) else edge
        word = kind[starts] > 0
        starts, ends = starts[word], ends[word]
        sums = np.empty(len(raw) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.numbers[raw] * self.up[:len(raw)], out=sums[1:])
        return starts, mix((sums[ends] - sums[starts]) * self.down[starts])

    def document(self, data: bytes) -> np.ndarray:
        """Word hashes of one text of any length, a block at a time."""
        out, start = [], 0
        while len(data) - start > BLOCK:
            cut = start + BLOCK
            while cut > start and self.classes[data[cut]] and self.classes[data[cut]] == self.classes[data[cut - 1]]:
                cut -= 1
            if cut == start:  # one word fills the block
                cut = start + BLOCK
                while cut < len(data) and self.classes[data[cut]] == self.classes[data[cut - 1]]:
                    cut += 1
            out.append(self.words(data[start:cut])[1])
            start = cut
        out.append(self.words(data[start:])[1])
        return np.concatenate(out)

    def documents(self, rows: Iterable[tuple]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """Rows of (key, text bytes) in groups: the keys, where each one's words begin (and the
        last end), and the word hashes."""
        keys, parts, size = [], [], 0
        for key, data in rows:
            if len(data) >= BLOCK // 2:
                hashes = self.document(data)
                yield [key], np.array([0, len(hashes)]), hashes
                continue
            if size + len(data) + 1 > BLOCK:
                yield self._group(keys, parts)
                keys, parts, size = [], [], 0
            keys.append(key)
            parts.append(data)
            size += len(data) + 1
        if keys:
            yield self._group(keys, parts)

    def _group(self, keys: list, parts: list) -> tuple[list, np.ndarray, np.ndarray]:
        starts, hashes = self.words(b"\n".join(parts))
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        return keys, np.searchsorted(starts, begins), hashes


def classes_of(**sets: bytes) -> np.ndarray:
    """A class table: bytes named first are class 1 and so on; the rest are separators."""
    table = np.zeros(256, np.uint8)
    for cls, members in enumerate(sets.values(), 1):
        table[list(members)] = cls
    return table


def blank_separated() -> np.ndarray:
    """Words are runs without ``[\\x20\\x09-\\x0D]``."""
    return classes_of(word=bytes(b for b in range(256) if b != 0x20 and not 9 <= b <= 13))


def words_and_marks() -> np.ndarray:
    """Words of letters, digits and non-ASCII bytes, and runs of other marks, without white space."""
    word = bytes(b for b in range(256) if b >= 128 or chr(b).isalnum())
    return classes_of(word=word, mark=bytes(b for b in range(33, 127) if b not in word))
