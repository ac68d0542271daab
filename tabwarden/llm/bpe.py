"""Byte-level BPE: texts to token ids and back, as a tokenizer file of the ``tokenizers`` library says.

Texts are cut at special tokens and then into words by the file's usual pattern.  Words that are not remembered are encoded
together: their symbols lie in one flat array, and in each round every word merges its pair of lowest rank, which is found by a
binary search over the sorted keys of all pairs.  Long words (over ``LONG`` bytes) share a flat array too, but go through the
ranks that occur in rising order and touch only the places of one rank, so a word of a million bytes is no million rounds.  Both give
what one merge after another gives, because a pair that holds a merged symbol always ranks after the merge that made it; a file
where this does not hold is refused.  Decoding gathers the tokens' bytes.

Defined cases: null and empty texts have no ids; bytes that are not UTF-8 are read as U+FFFD, one for each maximal part; the strings of special
tokens become their ids and come back as these strings; ids without a token give nothing; null lists of ids give the empty text and null
ids in a list give nothing; texts of any length are encoded whole; repeated rows are rows; other columns stay, and one with the
result's name gives way; an empty table stays empty.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import slices

#: Words of the pattern that byte-level tokenizers of this kind share.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes from which a word's merges go by rank over all words together.
LONG = 64
_NONE = np.int64(1) << np.int64(40)  # the rank of what is no pair


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: its own, or for blanks and controls one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, sorted pair keys with their ranks, and the ids of remembered words."""

    def __init__(self, path: str, remember: int = 250_000, remember_chars: int = 3_000_000):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, letters = told["model"], byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items()}
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        tokens |= {i: t.encode() for t, i in special.items()}
        size = max(tokens) + 1
        parts = [tokens.get(i, b"") for i in range(size)]
        self.bytes, self.size = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
        self.begin = np.cumsum(self.size) - self.size
        self.first = np.array([model["vocab"][c] for c in letters])
        self._pairs(model)
        self.special = special
        self.at_special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.words, self.path, self.remember, self.remember_chars = regex.compile(PATTERN), path, remember, remember_chars
        self._forget()

    def _pairs(self, model: dict) -> None:
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (np.array([vocab[x] for x in side], np.int64) for side in zip(*((a, b, a + b) for a, b in pairs), strict=True))
        rank = np.arange(len(pairs))
        maker = np.full(max(vocab.values()) + 1, -1)
        maker[made] = rank
        if (maker[made] != rank).any() or (maker[left] >= rank).any() or (maker[right] >= rank).any():
            raise ValueError("a merge comes before the one that makes its symbol, or two merges make one token")
        key = left << 32 | right
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], rank[order], made[np.argsort(rank)]

    def _forget(self) -> None:
        self.known: dict[str, int] = {s: k for k, s in enumerate(self.special)}
        self.ids = np.fromiter(self.special.values(), np.int32, len(self.special))
        self.at, self.count, self.chars = np.arange(len(self.special)), np.ones(len(self.special), np.int64), 0

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, found by binary search; _NONE where there is no merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], _NONE)

    def _rounds(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the lowest pair of every word, round by round; words without a pair leave."""
        out = []
        rank = self._ranks(symbol, np.append(symbol[1:], 0))
        while len(symbol):
            start = np.flatnonzero(np.diff(word, prepend=-1))
            rank[np.append(start[1:], len(word)) - 1] = _NONE
            low = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.append(start, len(word))))
            done = low == _NONE
            if done.any():
                out.append((symbol[done], word[done]))
                symbol, word, rank, low = symbol[~done], word[~done], rank[~done], low[~done]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == low)
            hit = hit[_alternate(np.diff(hit, prepend=-2) != 1)]
            symbol[hit] = self.made[rank[hit]]
            stay = np.ones(len(symbol), bool)
            stay[hit + 1] = False
            hit = np.cumsum(stay)[hit] - 1
            symbol, word, rank = symbol[stay], word[stay], rank[stay]
            fresh = np.unique(np.concatenate([hit, hit[hit > 0] - 1]))
            fresh = fresh[fresh + 1 < len(symbol)]
            rank[fresh] = np.where(word[fresh] == word[fresh + 1], self._ranks(symbol[fresh], symbol[fresh + 1]), _NONE)
        symbol, word = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (symbol, word)
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def _by_rank(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for long words: the lowest rank of all words comes next, at all of its places."""
        n = len(symbol)
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        rank = np.full(n + 1, _NONE)
        heap, places = [], {}

        def find(at: np.ndarray) -> None:
            right = after[at]
            there = right < n
            inside = at[there][word[at[there]] == word[right[there]]]
            rank[at] = _NONE
            rank[inside] = self._ranks(symbol[inside], symbol[after[inside]])
            at = inside[rank[inside] < _NONE]
            at = at[np.argsort(rank[at], kind="stable")]
            cut = np.flatnonzero(np.diff(rank[at], prepend=-1))
            for r, own in zip(rank[at[cut]].tolist(), np.split(at, cut[1:]), strict=True) if len(at) else ():
                if r not in places:
                    heapq.heappush(heap, r)
                places.setdefault(r, []).append(own)

        find(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            at = at[_alternate(np.append(True, after[at[:-1]] != at[1:]))]
            gone, symbol[at] = after[at], self.made[r]
            alive[gone], rank[gone] = False, _NONE
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at][inner]] = at[inner]
            find(np.unique(np.concatenate([at, before[at][before[at] >= 0]])))
        return symbol[alive], word[alive]

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids."""
        parts = [w.encode("utf-8") for w in words]
        symbol = self.first[np.frombuffer(b"".join(parts), np.uint8)]
        size = np.array([len(p) for p in parts])
        word, long = np.repeat(np.arange(len(parts)), size), np.repeat(size > LONG, size)
        made = [self._rounds(symbol[~long], word[~long]), self._by_rank(symbol[long], word[long])]
        ids, word = (np.concatenate(x) for x in zip(*made, strict=True))
        return np.bincount(word, minlength=len(words)), ids[np.argsort(word, kind="stable")].astype(np.int32)

    def _split(self, text: str, odd: set[str]) -> list[str]:
        """The words of a text without special tokens."""
        if odd and not odd.isdisjoint(text):  # letters of a later Unicode than the tokenizer's: its own splitter says
            return [text[a:b] for _, (a, b) in _splitter().pre_tokenize_str(text)]
        return self.words.findall(text)

    def _cut(self, text: str | None, odd: set[str]) -> list[str]:
        if not text:
            return []
        if not self.at_special or not self.at_special.search(text):
            return self._split(text, odd)
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += [*self._split(text[at : m.start()], odd), m.group()]
            at = m.end()
        return out + self._split(text[at:], odd)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(bounds, ids): text k has ids[bounds[k]:bounds[k + 1]]."""
        if len(self.known) > self.remember or self.chars > self.remember_chars:
            self._forget()
        letters = set().union(*(t for t in texts if t and not t.isascii()))
        odd = {c for c in letters if unicodedata.category(c) == "Cn"}
        cut = [self._cut(t, odd) for t in texts]
        words = [w for c in cut for w in c]
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            new = list(dict.fromkeys(words[i] for i in missing))
            count, ids = self._encoded(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(count) - count])
            self.count, self.ids = np.concatenate([self.count, count]), np.concatenate([self.ids, ids])
            self.chars += sum(map(len, new))
            at[missing] = [self.known[words[i]] for i in missing]
        count = self.count[at]
        bounds = np.append(0, np.cumsum(count))
        flat = self.ids[_runs(self.at[at], count)]
        return bounds[np.cumsum([0, *map(len, cut)])], flat

    def decode(self, bounds: np.ndarray, ids: np.ndarray) -> list[str]:
        """The text of each list of ids."""
        size = np.where((ids >= 0) & (ids < len(self.size)), self.size[np.clip(ids, 0, len(self.size) - 1)], 0)
        data = self.bytes[_runs(self.begin[np.clip(ids, 0, len(self.size) - 1)], size)].tobytes()
        stop = np.append(0, np.cumsum(size))[bounds].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(stop[:-1], stop[1:], strict=True)]


def _alternate(first: np.ndarray) -> np.ndarray:
    """Of runs that begin where ``first`` is true, the elements at even places: overlapping pairs merge from the left."""
    place = np.arange(len(first))
    return (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of all runs, one after another."""
    stop = np.cumsum(size)
    return np.repeat(begin - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)


@lru_cache(2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(1)
def _splitter():
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import pre_tokenizers

    return pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


def _replaced(df: DataFrame, old: str, new: str, kind: T.DataType) -> tuple[list[str], T.StructType]:
    """Columns that stay, and the schema of these with the new one at the end."""
    stay = [f for f in df.schema.fields if f.name not in (old, new)]
    return [f.name for f in stay], T.StructType([*stay, T.StructField(new, kind)])


def _last(df: DataFrame, stay: list[str], name: str, change: Callable[[Column], Column]) -> DataFrame:
    """The columns that stay and then the changed one; their names are places, as tasks take no names with dots."""
    quoted = [F.col(f"`{c.replace('`', '``')}`") for c in [*stay, name]]
    return df.select(*[c.alias(f"c{k}") for k, c in enumerate([*quoted[:-1], change(quoted[-1])])])


def encoded(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each text in the place of the text; ``tokenizer`` is a file that executors can open."""
    stay, schema = _replaced(docs, text_col, ids_col, T.ArrayType(T.IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(tokenizer)
        for b in batches:
            texts, begin = b.column(b.num_columns - 1), 0
            for held, own in slices(repeat(None, b.num_rows), (x.as_py() for x in texts)):
                bounds, ids = vocabulary.encode([t.decode("utf-8", "replace") if t else None for t in own])
                made = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(c.slice(begin, len(held)) for c in b.columns[:-1]), made], names=schema.names)
                begin += len(held)

    return _last(docs, stay, text_col, lambda c: c.cast("binary")).mapInArrow(run, schema)


def _parts(size: np.ndarray, most: int = 250_000) -> Iterator[tuple[int, int]]:
    """Ranges of at most 500 rows that have about ``most`` ids together; a longer row comes alone."""
    stop, at = np.cumsum(size), 0
    while at < len(size):
        end = int(np.searchsorted(stop, stop[at] - size[at] + most, "right"))
        end = min(max(end, at + 1), at + 500)
        yield at, end
        at = end


def decoded(tokens: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``tokens`` with the text of each list of ids in the place of the ids."""
    stay, schema = _replaced(tokens, ids_col, text_col, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(tokenizer)
        for b in batches:
            size = pc.fill_null(pc.list_value_length(b.column(b.num_columns - 1)), 0).to_numpy()
            for at, stop in _parts(size):
                part = b.slice(at, stop - at)
                ids = part.column(b.num_columns - 1).fill_null([])
                flat, bounds = ids.flatten(), ids.offsets.to_numpy() - ids.offsets[0].as_py()
                texts = vocabulary.decode(bounds, flat.to_numpy(zero_copy_only=False).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    known = lambda c: F.filter(c, lambda i: i.isNotNull() & (i >= 0)).cast("array<int>")
    return _last(tokens, stay, ids_col, known).mapInArrow(run, schema)
