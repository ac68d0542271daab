"""Sum-of-squares online packing of tokenised documents into windows of a fixed number of tokens.

A window's fill is its level; ``counts[h]`` is the number of open windows at level h.  A document goes to the level
that makes the sum of the squared counts least; a level array is all the state.  Documents may be cut: whole windows come off a long
one first, and when too many windows are open, or at a task's end, the emptiest open windows are cut up to fill the
fullest.  What is left at the very end is cut into windows whose lengths are powers of two, so nothing is padded.

Each task packs its own documents in the order in which they come, so a task that is run again does the same.

Defined cases: null and blank texts are the end token alone; rows with one id are packed as often as
they stand; a null id stays null; very long texts are read whole; other columns of any name are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import slices

SCHEMA = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordTokens:
    """Token ids of texts by a tokenizer that never joins across white space; ids of words are remembered."""

    MARK = "\x01"

    def __init__(self, path: str, remember: int = 1_200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.remember = Tokenizer.from_file(path), remember
        self.mark, = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.begin, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word among the known; new ones are encoded."""
        if len(self.known) > self.remember:
            self._forget()
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            new = list(dict.fromkeys(words[i] for i in missing))
            size, ids = self._encoded(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.ids = np.concatenate([self.ids, ids])
            at[missing] = [self.known[words[i]] for i in missing]
        return at

    def _encoded(self, words: list[bytes], together: int = 2000) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids.  Words are encoded many at a time, with a mark between them."""
        texts = [w.decode("utf-8", "replace") for w in words]
        parts = [texts[a : a + together] for a in range(0, len(texts), together)]
        sizes, ids = [], []
        for part, made in zip(parts, self.tokenizer.encode_batch_fast([f" {self.MARK} ".join(p) for p in parts], add_special_tokens=False), strict=True):
            found = np.array(made.ids, "<u4")
            mark = np.flatnonzero(found == self.mark)
            if len(mark) == len(part) - 1:
                sizes.append(np.diff(np.concatenate([[-1], mark, [len(found)]])) - 1)
                ids.append(np.delete(found, mark))
            else:  # some word holds the mark itself
                alone = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in part]
                sizes.append(np.array([len(x) for x in alone], np.int64))
                ids.append(np.array([t for x in alone for t in x], "<u4"))
        return np.concatenate(sizes), np.concatenate(ids)

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        """The ids of each text, then ``end``."""
        split = [(t or "").encode("utf-8", "replace").split() for t in texts]
        words = [w for s in split for w in s]
        at = self._find(words)
        size, begin = self.size[at], self.begin[at]
        stop = np.cumsum(size)
        flat = self.ids[np.repeat(begin - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]
        bound = np.concatenate([[0], stop])[np.cumsum([0] + [len(s) for s in split])]
        return [np.append(flat[a:b], np.uint32(end)) for a, b in zip(bound[:-1], bound[1:], strict=True)]


class SumOfSquares:
    """Open windows by level; ``add`` and ``finish`` give closed ones as lists of pieces (document, start, ids)."""

    def __init__(self, window: int, most_open: int = 256):
        self.window, self.most_open = window, most_open
        self.counts = np.zeros(window + 1, np.int64)
        self.levels: dict[int, list[list]] = {}
        self.open = 0

    def _put(self, level: int, pieces: list) -> None:
        self.levels.setdefault(level, []).append(pieces)
        self.counts[level] += 1
        self.open += 1

    def _take(self, level: int) -> list:
        pieces = self.levels[level].pop()
        if not self.levels[level]:
            del self.levels[level]
        self.counts[level] -= 1
        self.open -= 1
        return pieces

    def _best(self, size: int) -> int:
        """The level (0: a new window) whose choice makes the sum of squares least; of equals the fullest."""
        level = np.fromiter((h for h in self.levels if h + size <= self.window), np.int64)
        level = np.append(0, np.sort(level))
        after = np.where(level + size < self.window, 2 * self.counts[level + size] + 1, 0)
        cost = after - np.where(level > 0, 2 * self.counts[level] - 1, 0)
        return int(level[len(cost) - 1 - np.argmin(cost[::-1])])

    def add(self, doc, ids: np.ndarray) -> Iterator[list]:
        whole = len(ids) // self.window * self.window
        for a in range(0, whole, self.window):
            yield [(doc, a, ids[a : a + self.window])]
        rest = len(ids) - whole
        if rest:
            level = self._best(rest)
            pieces = self._take(level) if level else []
            pieces.append((doc, whole, ids[whole:]))
            if level + rest == self.window:
                yield pieces
            else:
                self._put(level + rest, pieces)
            while self.open > self.most_open:
                yield from self._fill()

    def _fill(self) -> Iterator[list]:
        """Fill the fullest windows from the emptiest, cutting its pieces."""
        low = min(self.levels)
        source = self._take(low)
        while source and self.open:
            high = max(self.levels)
            target, need = self._take(high), self.window - high
            while need and source:
                doc, start, ids = source.pop()
                target.append((doc, start, ids[:need]))
                if len(ids) > need:
                    source.append((doc, start + need, ids[need:]))
                need -= len(target[-1][2])
            if need:
                self._put(self.window - need, target)
            else:
                yield target
        if source:
            self._put(sum(len(x[2]) for x in source), source)

    def finish(self) -> Iterator[list]:
        while self.open > 1:
            yield from self._fill()
        for level in list(self.levels):
            source = self._take(level)
            while level:
                size = 1 << (level.bit_length() - 1)
                level -= size
                pieces = []
                while size:
                    doc, start, ids = source.pop(0)
                    pieces.append((doc, start, ids[:size]))
                    if len(ids) > size:
                        source.insert(0, (doc, start + size, ids[size:]))
                    size -= len(pieces[-1][2])
                yield pieces


@lru_cache(2)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def packed(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 4096, end: int = 2) -> DataFrame:
    """A row per piece: which ids of a document (``ids``: little-endian unsigned 32-bit) stand where in which sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer, number = _tokens(tokenizer), SumOfSquares(window), TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def close(pieces: list) -> None:
            nonlocal number
            offset = 0
            for (doc, total), start, ids in pieces:
                rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, number, offset))
                offset += len(ids)
            number += 1

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 7
            rows.clear()
            kinds = [pa.binary() if k == 3 else pa.int64() for k in range(7)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for b in batches:
            for ids, texts in slices(b["id"].to_pylist(), (x.as_py() for x in b["text"])):
                for doc, tokens in zip(ids, words.encode(texts, end), strict=True):
                    for pieces in packer.add((doc, len(tokens)), tokens):
                        close(pieces)
                yield batch()
        for pieces in packer.finish():
            close(pieces)
        yield batch()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
