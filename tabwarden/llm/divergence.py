"""How far the sources of a language differ in what they say: divergences of smoothed term shares, in whole numbers.

A term is a run of ASCII letters and non-ASCII bytes, with only A-Z lower-cased.  A table of 256 entries finds the bounds of all terms
of many texts in one buffer; slices are grouped by xxhash and each is compared with its group's first byte by byte, so that a
collision makes a group of its own.  Tasks count a few megabytes of text at a time, and Spark adds up by language, source and term.  A
term counts for a language where at least ``least_docs`` of its documents have it.

Divergences are sums over terms, so the terms of a language are dealt out by hash into blocks of about ``BLOCK`` counts, and sources into
tiles of about ``TILE``; a task has one block for one pair of tiles.  There the counts are a CSR matrix of sources by terms;
columns are laid out a stretch at a time, with the smoothed share of absent terms in the gaps, and each source is compared
with all later ones at once, summed by reduceat.  The blocks' sums and their ten best terms a source are added up by Spark.

Defined cases: null text, lang and source are empty; a language without terms that count has pairs of value 0; groups without
terms take part; repeated rows count as often as they stand; very long texts are read whole; other columns of any name are ignored; an
empty table gives no rows.  Counts have to stay under 9 * 10^15 for a language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .words import slices

#: Counts of a block, and sources of a tile, about.
BLOCK, TILE = 250_000, 200
#: Columns that are laid out at a time, and cells of one comparison.
_STRETCH, _CELLS = 8192, 1_000_000
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    stop = np.cumsum(size)
    return np.repeat(begin - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)


def _differs(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, at_once: int = 100_000) -> np.ndarray:
    """Whether the slices of ``size`` bytes that start at a and at b are unequal."""
    out = np.zeros(len(a), bool)
    for k in range(0, len(a), at_once):
        n = size[k : k + at_once]
        unequal = data[_runs(a[k : k + at_once], n)] != data[_runs(b[k : k + at_once], n)]
        out[k : k + at_once] = np.logical_or.reduceat(unequal, np.cumsum(n) - n)
    return out


def terms_of(parts: list[bytes], digest: Callable[[bytes], int] = xxhash.xxh3_64_intdigest) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(text, code) of every term of the texts in order, and the distinct terms by code."""
    data = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
    edge = np.flatnonzero(np.diff(_LETTER[data].view(np.int8), prepend=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    text = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), start, "right")
    if not len(start):
        return text, np.zeros(0, np.int64), []
    buffer, size = data.tobytes(), end - start
    digests = np.fromiter((digest(buffer[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(start))
    _, first, code = np.unique(digests, return_index=True, return_inverse=True)
    own = first[code]
    wrong = size != size[own]
    right = np.flatnonzero(~wrong)
    wrong[right] = _differs(data, start[right], start[own[right]], size[right])
    terms = [buffer[start[k] : end[k]] for k in first]
    more: dict[bytes, int] = {}
    for k in np.flatnonzero(wrong).tolist():  # other terms of the same hash
        code[k] = more.setdefault(buffer[start[k] : end[k]], len(terms) + len(more))
    return text, code, terms + list(more)


def counted(group: np.ndarray, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(group, occurrences, documents, term) of the texts, a row for each group and term."""
    text, code, terms = terms_of(parts)
    many = max(len(terms), 1)
    pair, n = np.unique(text * many + code, return_counts=True)
    key, at = np.unique(group[pair // many] * many + pair % many, return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, at, n)
    return key // many, total, np.bincount(at, minlength=len(key)), [terms[k] for k in (key % many).tolist()]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n, docs); the row of each group without a term says that it occurs."""
    for b in batches:
        groups = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        for own, parts in slices(groups, (x.as_py() for x in b.column(2)), 2_000_000):
            names: dict[tuple, int] = {}
            group = np.array([names.setdefault(g, len(names)) for g in own])
            at, n, docs, terms = counted(group, parts)
            langs, sources = (pa.array(x, pa.binary()) for x in zip(*names, strict=True))
            at, zero = np.append(at, range(len(names))), np.zeros(len(names), np.int64)
            columns = [langs.take(pa.array(at)), sources.take(pa.array(at)), pa.array([*terms, *[None] * len(names)], pa.binary()), pa.array(np.append(n, zero)), pa.array(np.append(docs, zero))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / (total + 2 * terms)), by long division so that no product leaves 64 bits."""
    rest, whole = count + 2, total + 2 * terms
    out = np.zeros(np.broadcast(count, total).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def pair_sums(row: np.ndarray, column: np.ndarray, share: np.ndarray, absent: np.ndarray, columns: int, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(a, others, sums) for each row a of ``first`` and the rows of ``second`` (if both are the same rows: those after a).

    (row, column, share) are the cells of a matrix; where there is none, a row has its ``absent`` share.
    """
    order = np.lexsort((column, row))
    row, column, share = row[order], column[order], share[order]
    indptr = np.searchsorted(row, np.arange(len(absent) + 1))
    alike = np.array_equal(first, second)
    others = {a: second[second > a] if alike else second for a in first.tolist()}
    sums = {a: np.zeros(len(o), np.int64) for a, o in others.items()}

    def laid(rows: np.ndarray, low: int, high: int) -> np.ndarray:
        out = np.repeat(absent[rows][:, None], high - low, 1)
        for k, r in enumerate(rows.tolist()):
            a, b = indptr[r] + np.searchsorted(column[indptr[r] : indptr[r + 1]], (low, high))
            out[k, column[a:b] - low] = share[a:b]
        return out

    for low in range(0, columns, _STRETCH):
        high = min(low + _STRETCH, columns)
        own, step = laid(first, low, high), max(1, _CELLS // (high - low))
        facing = own if alike else laid(second, low, high)
        for k, a in enumerate(first.tolist()):
            theirs = facing[k + 1 :] if alike else facing
            for at in range(0, len(theirs), step):
                cells = _gaps(theirs[at : at + step], own[k])
                sums[a][at : at + step] += np.add.reduceat(cells.ravel(), np.arange(len(cells)) * (high - low))
    for a, o in others.items():
        yield a, o, sums[a]


def _audit(most: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """What a block of terms says for one pair of tiles: sums by pair of sources and each source's best terms."""

    def run(key: tuple, cells: pa.Table, groups: pa.Table) -> pa.Table:
        tile, other = key[2].as_py(), key[3].as_py()
        groups = groups.sort_by("of_source")  # so that all blocks name the sources of a pair in one order
        names = groups["of_source"].to_pylist()
        at = {s: k for k, s in enumerate(names)}
        total, tiles = groups["of_total"].to_numpy(), groups["of_tile"].to_numpy()
        terms, lang_total = groups["of_terms"][0].as_py(), groups["of_lang_total"][0].as_py()
        known = cells["term"].combine_chunks().dictionary_encode()
        words, column = known.dictionary.to_pylist(), known.indices.to_numpy()
        row, n = np.array([at[s] for s in cells["source"].to_pylist()], np.int64), cells["n"].to_numpy()
        absent = shares(np.zeros(len(names), np.int64), total, terms) if terms else np.ones(len(names), np.int64)
        share = shares(n, total[row], terms)
        # terms that no source of these tiles has are in no block: the first block adds all terms, and each takes off its own
        unseen = (terms if key[1].as_py() == 0 else 0) - len(words)
        out = []
        first, second = np.flatnonzero(tiles == tile), np.flatnonzero(tiles == other)
        for a, others, sums in pair_sums(row, column, share, absent, len(words), first, second):
            neither = _gaps(absent[others], absent[a]) * unseen
            out.append(("pair", np.full(len(others), a), [names[k] for k in others.tolist()], sums + neither))
        if tile == other and len(row):
            value = _gaps(share, (q := shares(cells["lang_n"].to_numpy(), np.int64(lang_total), terms)))
            place = np.empty(len(words), np.int64)
            place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
            high = np.flatnonzero(share > q)
            high = high[np.lexsort((place[column[high]], -value[high], row[high]))]
            begin = np.searchsorted(row[high], row[high])
            high = high[np.arange(len(high)) - begin < most]
            out.append(("term", row[high], [words[k] for k in column[high].tolist()], value[high]))
        rows = sum(len(x[1]) for x in out)
        source = [names[k] for x in out for k in x[1].tolist()]
        columns = [
            pa.array([key[0].as_py()] * rows, pa.binary()),
            pa.array([x[0] for x in out for _ in range(len(x[1]))], pa.string()),
            pa.array(source, pa.binary()),
            pa.array([i for x in out for i in x[2]], pa.binary()),
            pa.array(np.concatenate([x[3] for x in out]) if out else [], pa.int64()),
        ]
        return pa.Table.from_arrays(columns, names=["lang", "part", "source", "item", "value"])

    return run


def source_divergences(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 10, most: int = 10, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair`` compares a source with each other one of its language, part ``term`` has the at most ``most`` terms that set it
    apart from its language.  Ranks go by falling value, then by item.
    """
    read = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("binary"), F.lit(b"")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    rows = read.mapInArrow(_count_terms, "lang binary, source binary, term binary, n long, docs long")
    counts = rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")  # a row a source
    seen = counts.withColumns({"lang_docs": F.sum("docs").over(whole), "lang_n": F.sum("n").over(whole), "once": (F.min("source").over(whole) == F.col("source")) & F.col("term").isNotNull()})
    kept = written(seen.where((F.col("lang_docs") >= least_docs) | F.col("term").isNull()).drop("docs", "lang_docs"), "terms", compression="zstd")

    langs = kept.groupBy("lang").agg(
        F.count_if("once").alias("terms"),
        F.sum("n").alias("lang_total"),
        F.greatest(F.lit(1), F.ceil(F.count("term") / block)).cast("int").alias("blocks"),
        F.ceil(F.count_if(F.col("term").isNull()) / tile).cast("int").alias("tiles"),
    )
    own = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    # a source's rows go to the pairs of its tile with each tile
    facing = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda k: F.struct(F.least("tile", k).alias("i"), F.greatest("tile", k).alias("j")))
    cells = kept.where("term IS NOT NULL").join(langs.select("lang", "blocks", "tiles"), "lang").withColumns({"tile": own, "block": F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")})
    cells = cells.select("lang", "block", F.inline(facing), "source", "term", "n", "lang_n")
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang").withColumn("tile", own)
    groups = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).select("lang", "block", F.inline(facing), "source", "total", "tile", "terms", "lang_total")

    keys = ["lang", "block", "i", "j"]
    groups = groups.toDF(*[f"of_{c}" for c in groups.columns])  # columns of one table on both sides need two names
    made = cells.groupBy(*keys).cogroup(groups.groupBy(*[f"of_{k}" for k in keys])).applyInArrow(_audit(most), "lang binary, part string, source binary, item binary, value long")
    sums = made.groupBy("lang", "part", "source", "item").agg(F.sum("value").alias("value"))
    there, back = F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))
    both = sums.select("lang", "part", "value", F.inline(F.when(F.col("part") == "pair", F.array(there, back)).otherwise(F.array(there))))
    ranked = both.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    ranked = ranked.where((F.col("part") == "pair") | (F.col("rank") <= most))
    return ranked.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "part", "item")], "value", "rank")
