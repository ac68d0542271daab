"""Column helpers with the missing-value semantics that the operators share: missing, NaN and junk are one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What counts as a number in text; Spark's cast alone would also take '4D' and '1f'.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def numeric(df: DataFrame, name: str) -> Column:
    """The column as double; junk text and NaN are null."""
    c = F.col(name)
    if is_text(df, name):
        return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))
    kind = df.schema[name].dataType
    return F.when(~F.isnan(c), c.cast("double")) if isinstance(kind, (T.DoubleType, T.FloatType)) else c.cast("double")


def finite(x: Column) -> Column:
    """``x``, or null where it is NaN or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def not_below_zero(x: Column) -> Column:
    """Negative values become 0; missing ones stay missing (greatest() would fill them)."""
    return F.when(x < 0, F.lit(0)).otherwise(x)


def ratio(a: Column, b: Column) -> Column:
    """a / b, missing where b is 0."""
    return a / F.nullif(b, F.lit(0.0))


def period_name(ts: Column, size: str = "month") -> Column:
    """``2015-08``, ``2015Q3`` or ``2015``."""
    if size == "month":
        return F.date_format(ts, "yyyy-MM")
    if size == "quarter":
        return F.concat(F.year(ts).cast("string"), F.lit("Q"), F.quarter(ts).cast("string"))
    if size == "year":
        return F.year(ts).cast("string")
    raise ValueError(f"unknown period size {size!r}: month, quarter or year")


def interpret_psi(x: Column) -> Column:
    return F.when(finite(x).isNull(), "unknown").when(x < 0.10, "stable").when(x < 0.25, "moderate").otherwise("significant")


#: Names of batch files: a prefix, a period, an ending.
BATCH_FILE = r"^(.*?)(\d{4}(?:-\d{2}|Q[1-4])?)\.[a-z]+$"


def batch_prefix(name: Column) -> Column:
    """The prefix in a batch file's name; empty where it is no such name."""
    return F.regexp_extract(name, BATCH_FILE, 1)


def batch_period(name: Column) -> Column:
    """The period in a batch file's name; null where it is no such name."""
    return F.nullif(F.regexp_extract(name, BATCH_FILE, 2), F.lit(""))


def json_text(df: DataFrame, columns: list[str]) -> Column:
    """JSON of the columns; NaN and infinity become null."""
    real = lambda c: isinstance(df.schema[c].dataType, T.DoubleType | T.FloatType)
    return F.to_json(F.struct(*[(finite(F.col(c)) if real(c) else F.col(c)).alias(c) for c in columns]), {"ignoreNullFields": "false"})
