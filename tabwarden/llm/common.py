"""What the operators of this folder share: the shared folder, written tables, native array helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete, scratch

#: A run of the bytes that separate words, as a character class of Java and of SQL.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def new_path(spark: SparkSession, name: str) -> str:
    """A new name in the folder that driver and executors share."""
    return scratch(spark, name)


#: Where tables of :func:`written` lie, until :func:`discard` or :func:`discard_all`.
_PATHS: set[str] = set()


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, which cuts its lineage; its shuffle files go when it is written."""
    spark = df.sparkSession
    path, key = new_path(spark, name), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(key, before)
    made = spark.read.schema(df.schema).parquet(path)
    _PATHS.add(path)
    made._written = path
    return made


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`written` that nothing reads any more."""
    path = getattr(table, "_written", None)
    if path:
        delete(table.sparkSession, path)
        _PATHS.discard(path)


def tables() -> frozenset[str]:
    """The tables of :func:`written` that are there now."""
    return frozenset(_PATHS)


def discard_since(spark: SparkSession, before: frozenset[str], *keep: DataFrame) -> None:
    """Delete the tables written since ``before``, but for these."""
    for path in _PATHS - before - {getattr(t, "_written", None) for t in keep}:
        delete(spark, path)
        _PATHS.discard(path)


def discard_all(spark: SparkSession) -> None:
    """Delete all tables that this process has written for the operators; results that were not saved elsewhere go with them."""
    for path in list(_PATHS):
        delete(spark, path)
    _PATHS.clear()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once a row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def starts_of(lengths: Column, chunk: int = 256) -> Column:
    """For an array of lengths, where each piece starts (from 0).

    Sums run within chunks and over chunks, so that no array is copied once for each of its elements.
    """

    def within(part: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(part, zero, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def chunked(a: Column) -> Column:
        count = F.ceil(F.size(a) / F.lit(chunk)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(a, i * chunk + 1, F.lit(chunk)))
        total = lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda s, n: s + n)
        return let(parts, lambda ps: let(within(F.transform(ps, total), F.lit(0).cast("bigint")), lambda at: F.flatten(F.transform(ps, lambda p, i: within(p, at[i])))))

    longs = F.transform(lengths, lambda n: n.cast("bigint"))
    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(let(longs, chunked))


def pieces(text: Column, spans: Column, block: int = 64) -> Column:
    """The text of each span (start, end; code points) of an array in order and without overlaps.

    The text is cut in parts of ``block`` spans first, and each part in pieces, so that no piece is looked for from the
    text's begin.
    """
    cut = lambda t, a, b: F.substring(t, (a + 1).cast("int"), (b - a).cast("int"))

    def part(all_: Column, k: Column) -> Column:
        own = F.slice(all_, k * block + 1, F.lit(block))
        first = own[0]["start"]
        return let(cut(text, first, F.element_at(own, -1)["end"]), lambda t: F.transform(own, lambda s: cut(t, s["start"] - first, s["end"] - first)))

    def whole(all_: Column) -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(0), F.ceil(F.size(all_) / F.lit(block)).cast("int") - 1), lambda k: part(all_, k)))

    return F.when(F.coalesce(F.size(spans), F.lit(0)) <= 0, F.array().cast("array<string>")).otherwise(let(spans, whole))
