"""Vectorised splitting of UTF-8 texts into words and hashing of word n-grams.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; every other byte,
all of non-ASCII UTF-8 included, belongs to words.  Work is done for a slice of
texts at a time, so memory follows the slice (see :func:`slices`) and the single
longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_WORD = np.ones(256, bool)
_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """Powers of an odd base, by place in the word; kept for the longest word met."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 256), np.uint64(0xD6E8FEB86659FD93))
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


class Words:
    """The words of a list of texts.

    ``hash`` has 64 bits a word, ``start`` and ``end`` are byte places in ``data``
    (each word is followed there by a white-space byte), and words ``first[d]`` to
    ``first[d + 1]`` are those of text ``d``.  Null texts have no words.
    """

    def __init__(self, texts: list[str | None], lower: bool = False):
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        if lower:
            data = _LOWER[data]
        inside = _WORD[data]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.data, self.start, self.end = data, edge[0::2], edge[1::2]
        size = self.end - self.start
        if len(size):
            byte = data[inside]
            begin = np.cumsum(size) - size
            place = np.arange(len(byte)) - np.repeat(begin, size)
            self.hash = mix(np.add.reduceat(_BYTE[byte] * _power(int(size.max()))[place], begin) + size.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)
        bound = np.cumsum([0] + [len(p) + 1 for p in parts])
        self.bound = bound
        self.first = np.searchsorted(self.start, bound)
        self.doc = np.repeat(np.arange(len(parts)), np.diff(self.first))

    def grams(self, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word windows and the place of each one's first word; no window crosses texts.

        Windows are put together from halves: those of 2, 4, 8 ... words, and of these the powers of two in n.
        """
        count = len(self.hash) - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        power, size, total, done = self.hash ^ np.uint64(seed), 1, None, 0
        while True:
            if n & size:
                part = power[done : done + count]
                total, done = part if total is None else _join(total, part), done + size
            if done == n:
                break
            power, size = _join(power[: len(power) - size], power[size:]), 2 * size
        at = np.flatnonzero(self.doc[:count] == self.doc[n - 1 :])
        return total[at], at

    def whole(self) -> np.ndarray:
        """A hash of each text's sequence of words; 0 for texts without words."""
        at = np.arange(len(self.hash)) - self.first[self.doc]
        out = np.zeros(len(self.first) - 1, np.uint64)
        full = np.flatnonzero(np.diff(self.first))
        if len(full):
            out[full] = mix(np.add.reduceat(mix(self.hash + mix(at.astype(np.uint64) + np.uint64(1))), self.first[full]) + np.diff(self.first)[full].astype(np.uint64))
        return out

    def joined(self, keep: np.ndarray) -> list[bytes]:
        """The kept words of each text, joined by one space."""
        edge = np.zeros(len(self.data) + 2, np.int8)
        start, end = self.start[keep], self.end[keep]
        edge[start] += 1
        edge[end + 1] -= 1
        data = self.data.copy()
        data[end] = 0x20
        out = data[np.cumsum(edge[: len(data)], dtype=np.int8) > 0].tobytes()
        size = np.bincount(self.doc[keep], (end - start + 1), len(self.first) - 1).astype(np.int64)
        stop = np.cumsum(size)
        return [out[a : b - 1] if b > a else b"" for a, b in zip(stop - size, stop, strict=True)]


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _MUL + b)


def slices(ids, texts, most: int = 1_000_000) -> Iterator[tuple[list, list]]:
    """Cut a batch into lists of ids and texts of about ``most`` characters; a longer text comes alone."""
    some, held, size = [], [], 0
    for i, t in zip(ids, texts, strict=True):
        n = len(t) if t else 0
        if some and size + n > most:
            yield some, held
            some, held, size = [], [], 0
        some.append(i)
        held.append(t)
        size += n
    if some:
        yield some, held
