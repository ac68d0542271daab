"""Vector codes: each part of a vector becomes the index of its nearest codebook entry, in whole numbers.

Components become floor(scale * x).  Codebooks come from Lloyd's rounds with Hamerly's bounds: a row keeps, for each part, an upper
bound of the distance to its entry and a lower bound of the distance to the second nearest.  When entries move, the upper bound
grows by what its entry moved and the lower one shrinks by the most that any other moved.  Only where the upper bound is not strictly below
the lower one, first with the exact distance in its place, are all entries scanned, in exact arithmetic; of equally near
entries the lowest index wins, and a strict bound leaves no room for an equal one.  Bounds are rounded outwards.

Each round reads one table and writes the next, vectors and bounds together, so nothing is shuffled; a lost executor's tasks run
again on the table before.  Sums for new entries are at most parts x entries rows, which is all that the driver sees.

Defined cases: vectors that are null or empty, hold nulls or non-finite components, or are of another length than the vector of the smallest id are
left out; rows without an id come last in the order that starts the codebooks, rows of one id by their vectors; fewer rows than entries
make a smaller codebook; an empty table has no rows and empty codebooks; components for which a squared distance would not fit
into a long raise; a length that the parts do not divide raises; other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, written

_UP, _DOWN = np.float64(np.inf), np.float64(-np.inf)


def _root(square: np.ndarray, to: np.float64) -> np.ndarray:
    """The square root, rounded upwards or downwards."""
    return np.nextafter(np.sqrt(np.nextafter(square.astype(np.float64), to)), to)


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-numbered rows and entries (int64)."""
    most = (np.abs(x).max(initial=0) + np.abs(book).max(initial=0)).astype(object)
    if x.shape[1] * int(most) ** 2 < 2**52:  # products of floats are exact whole numbers then
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    out = np.empty((len(x), len(book)), np.int64)
    for k, entry in enumerate(book):
        out[:, k] = ((x - entry) ** 2).sum(1)
    return out


def scanned(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest entry, upper bound, lower bound to the second nearest) by a scan of all entries."""
    d = distances(x, book)
    near = d.argmin(1)
    first = d[np.arange(len(d)), near]
    if len(book) > 1:
        second = _root(np.maximum(np.partition(d, 1, 1)[:, 1], 0), _DOWN)
    else:
        second = np.full(len(d), np.inf)
    return near, _root(first, _UP), second


def moves(old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: what it moved at most, and the most that any other moved."""
    own = np.where((old == new).all(1), 0.0, _root(((new - old) ** 2).sum(1), _UP))
    order = np.argsort(own)
    other = np.full(len(own), own[order[-1]])
    other[order[-1]] = own[order[-2]] if len(own) > 1 else 0.0
    return own, other


def reassigned(x, near, upper, lower, book, moved) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Entries and bounds after the entries have moved, and how many rows had to be scanned."""
    own, other = moved
    upper = np.where(own[near] > 0, np.nextafter(upper + own[near], _UP), upper)
    lower = np.where(other[near] > 0, np.nextafter(lower - other[near], _DOWN), lower)
    near = near.copy()
    open_ = np.flatnonzero(~(upper < lower))
    upper[open_] = _root(((x[open_] - book[near[open_]]) ** 2).sum(1), _UP)
    open_ = open_[~(upper[open_] < lower[open_])]
    if len(open_):
        near[open_], upper[open_], lower[open_] = scanned(x[open_], book)
    return near, upper, lower, len(open_)


@dataclass(frozen=True)
class Codebooks:
    """``entries``: whole numbers by part, entry and position within the part."""

    entries: np.ndarray

    def written_out(self) -> str:
        return ",".join(map(str, self.entries.ravel().tolist()))


@dataclass(frozen=True)
class _Step:
    """What a round's tasks need: codebooks, and how they moved since the bounds were made (None in the first round)."""

    books: np.ndarray
    moved: list | None
    final: bool

    def of(self, x: np.ndarray, near, upper, lower) -> tuple[np.ndarray, ...]:
        parts, width = self.books.shape[0], self.books.shape[2]
        made = []
        for p in range(parts):
            own = x[:, p * width : (p + 1) * width]
            if self.moved is None:
                made.append(scanned(own, self.books[p]))
            else:
                made.append(reassigned(own, near[:, p], upper[:, p], lower[:, p], self.books[p], self.moved[p])[:3])
        near, upper, lower = (np.stack(m, 1) for m in zip(*made, strict=True))
        error = np.zeros(len(x), np.int64)
        if self.final:
            for p in range(parts):
                error += ((x[:, p * width : (p + 1) * width] - self.books[p][near[:, p]]) ** 2).sum(1)
        return near, upper, lower, error


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    bounds = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.ascontiguousarray(values).ravel(), kind))


def _assigned(rows: DataFrame, n_keep: int, step: _Step, batch: int = 2000) -> DataFrame:
    """The next table of bounds, or at the end codes and errors; the first ``n_keep`` columns stay."""
    parts, dim = step.books.shape[0], step.books.shape[0] * step.books.shape[2]
    first = step.moved is None
    stay = list(rows.schema.fields[:n_keep])
    bounds = [T.StructField("upper", T.ArrayType(T.DoubleType(), False)), T.StructField("lower", T.ArrayType(T.DoubleType(), False))]
    near_field = T.StructField("near", T.ArrayType(T.IntegerType(), False))
    tail = [near_field, T.StructField("error", T.LongType())] if step.final else [T.StructField("v", T.ArrayType(T.IntegerType(), False)), near_field, *bounds]
    schema = T.StructType([*stay, *tail])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                b = whole.slice(at, batch)
                x = _lists(b.column(n_keep), dim).astype(np.int64)
                old = (None, None, None) if first else tuple(_lists(b.column(n_keep + k), parts) for k in (1, 2, 3))
                near, upper, lower, error = step.of(x, *old)
                own = [_listed(near.astype(np.int32), pa.int32()), pa.array(error)]
                if not step.final:
                    own = [b.column(n_keep), own[0], _listed(upper, pa.float64()), _listed(lower, pa.float64())]
                yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], *own], names=schema.names)

    return rows.mapInArrow(run, schema)


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floor of the mean of their parts; entries that no part has stay."""
    parts, _, width = books.shape
    each = F.array(*[F.struct(F.lit(p).alias("part"), F.col("near")[p].alias("entry"), F.slice("v", p * width + 1, width).alias("x")) for p in range(parts)])
    sums = rows.select(F.inline(each)).groupBy("part", "entry").agg(F.count("*").alias("n"), *[F.sum(F.col("x")[k]).alias(f"s{k}") for k in range(width)])
    new = books.copy()
    for r in sums.toLocalIterator():  # at most parts x entries
        new[r[0], r[1]] = [s // r[2] for s in r[3:]]
    return new


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of all components, or null if the vector or a component is null or not finite."""
    x = F.transform(vector, lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return F.when(good, F.transform(x, lambda c: F.floor(c * scale)))


def compressed(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = (), parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024
) -> tuple[DataFrame, Codebooks]:
    """(id, kept columns..., near, error) of every vector that counts, and the codebooks.

    ``near`` has the entry of each part, ``error`` the squared distances summed over parts.  The rows are a table in the shared folder.
    """
    names = [id_col, *keep]
    rows = vectors.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)], whole_numbers(F.col(f"`{vector_col}`"), scale).alias("v")).where("size(v) > 0")
    ordered = rows.orderBy(F.col("k0").asc_nulls_last(), "v").select("v")
    first = ordered.limit(entries).collect()  # at most as many as entries
    dim = len(first[0]["v"]) if first else 0
    if any(len(r["v"]) != dim for r in first):
        first = ordered.where(F.size("v") == dim).limit(entries).collect()
    if dim % parts:
        raise ValueError(f"{dim} components are not {parts} equal parts")
    width = dim // parts
    first = [r["v"] for r in first]
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("near", T.ArrayType(T.IntegerType(), False)), T.StructField("error", T.LongType())])
    if not first:
        none = vectors.sparkSession.createDataFrame([], schema)
        return none.toDF("id", *keep, "near", "error"), Codebooks(np.zeros((parts, 0, width), np.int64))
    most = int((2**60 / dim) ** 0.5) // 2
    fits = F.forall("v", lambda x: F.abs(x) <= most)
    told = F.raise_error(F.lit(f"a component is over {most / scale}, and its squared distances do not fit into a long")).cast("array<int>")
    rows = rows.where(F.size("v") == dim).withColumn("v", F.when(fits, F.transform("v", lambda x: x.cast("int"))).otherwise(told))
    if max(map(abs, (x for v in first for x in v))) > most:
        raise ValueError(f"a component is over {most / scale}, and its squared distances do not fit into a long")
    books = np.array(first, np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    moved = None
    for _ in range(rounds):
        table = written(_assigned(rows, len(names), _Step(books, moved, False)), "bounds", compression="zstd")
        new = _moved(table, books)
        moved, books = [moves(a, b) for a, b in zip(books, new, strict=True)], new
        if hasattr(rows, "_written"):
            discard(rows)
        rows = table
    made = written(_assigned(rows, len(names), _Step(books, moved, True)), "codes", compression="zstd")
    if hasattr(rows, "_written"):
        discard(rows)
    return made.toDF("id", *keep, "near", "error"), Codebooks(books)
