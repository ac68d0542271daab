"""Ranks, exact quantiles and places in an order, without a task that sorts a whole column.

Values are counted first, so that a frequent value is one row.  Each value has a bucket that grows with it, by arithmetic on the value
alone; sums of buckets, whose number is bounded, are added up, and a bucket is sorted alone.
Quantiles and largest gaps need the values of a few buckets only.  It is one lazy plan over one scan: all parts read the shuffle that counts.

:func:`numbered` places rows by several columns.  Spark deals rows out by cut points over all of them, and over a last number of chance,
so that equal rows are split too; what is dealt out is a table in the shared folder, so that counts and rows agree whenever tasks run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, written

#: Buckets of numbers between 0 and 1; larger ones have more, by the eighth root.
BUCKETS = 1 << 14


def _bucket(buckets: int) -> Column:
    """A whole number that never falls as ``value`` grows.

    Eighth roots part numbers up to 10^16, whatever their size; a linear scale parts those up to 2^63, such as hashes; a
    64th root parts what is beyond.  Products, and roots that are square roots, are rounded to the nearest, so each step keeps the order,
    and so does the sum.  A column has about 4 million buckets at most, and about 100,000 if its numbers are under 10^6.
    """
    eighth = "sqrt(sqrt(sqrt(abs(value))))"
    size = f"floor(least({eighth}, 100D) * {buckets}) + floor(least(sqrt(sqrt(sqrt({eighth}))), 65536D) * 16)"
    linear = "floor(greatest(least(value, 9.2e18D), -9.2e18D) / 1.4e14D)"
    whole = f"{linear} + CASE WHEN value < 0 THEN -({size}) ELSE {size} END"
    return F.expr(f"CASE WHEN value IS NULL THEN {-(1 << 40)}L WHEN isnan(value) THEN {1 << 40}L ELSE {whole} END")


def counted_by_value(rows: DataFrame, weights: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(column, value, weights..., _bucket) of rows (column, value, weights...): a row per distinct value."""
    counts = rows.groupBy("column", "value").agg(*[F.sum(w).alias(w) for w in weights])
    return counts.withColumn("_bucket", _bucket(buckets))


def _sums(at: DataFrame, weights: list[str]) -> DataFrame:
    """(column, _bucket, weights..., before_*, total_*) by bucket."""
    per = at.groupBy("column", "_bucket").agg(*[F.expr(f"sum({w}) AS {w}") for w in weights])
    before = "coalesce(sum({0}) OVER (PARTITION BY column ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before_{0}"
    return per.selectExpr("*", *[before.format(w) for w in weights], *[f"sum({w}) OVER (PARTITION BY column) AS total_{w}" for w in weights])


def _placed(at: DataFrame, per: DataFrame, weights: list[str], few: bool = False) -> DataFrame:
    """The values of the buckets in ``per`` with all sums; few of them are dealt out by column alone."""
    both = at.join(per.drop(*weights), ["column", "_bucket"])
    both = both.repartition("column") if few else both
    smaller = "before_{0} + coalesce(sum({0}) OVER (PARTITION BY column, _bucket ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before_{0}"
    return both.selectExpr("column", "value", *weights, *[smaller.format(w) for w in weights], *[f"total_{w}" for w in weights])


def ranked(rows: DataFrame, weights: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(column, value, weights..., before_*, total_*) of rows (column, value, weights...): a row per distinct value.

    ``before_w`` is the sum of weight w over the column's smaller values, ``total_w`` over all of its values.
    """
    at = counted_by_value(rows, weights, buckets)
    return _placed(at, _sums(at, weights), weights)


def ranked_where(at: DataFrame, weights: list[str], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """:func:`ranked` rows of values from :func:`counted_by_value` in those buckets that ``keep`` leaves of the buckets' sums.

    It should leave a number of buckets that does not grow with the values: they are broadcast, and only their values are sorted.
    """
    return _placed(at, F.broadcast(keep(_sums(at, weights))), weights, few=True)


def holds_places(quantiles: Iterable[float], weight: str = "n") -> str:
    """SQL: whether a bucket holds a value that one of the quantiles needs."""
    inside = "{at} >= before_{w} AND {at} < before_{w} + {w}"
    places = [f"{end}((total_{weight} - 1) * {q}D)" for q in quantiles for end in ("floor", "ceil")]
    return " OR ".join(f"({inside.format(at=at, w=weight)})" for at in dict.fromkeys(places))


def near_quantiles(at: DataFrame, quantiles: Iterable[float], weight: str = "n") -> DataFrame:
    """The rows of :func:`ranked` that these quantiles need, at most a few buckets a column."""
    return ranked_where(at, [weight], lambda per: per.where(holds_places(quantiles, weight)))


def near_quantiles_read(df: DataFrame, columns: list[Column], quantiles: Iterable[float]) -> DataFrame:
    """:func:`near_quantiles` of the columns' present values, with a column's place as its name, by reading ``df`` twice.

    No shuffle holds all distinct values: the first reading counts buckets, the second one counts the values of those few that are needed.
    """
    pairs = [F.struct(F.lit(i).alias("column"), c.alias("value")) for i, c in enumerate(columns)]
    all_of = df.select(F.inline(F.array(*pairs))).where("value IS NOT NULL").select("column", "value", _bucket(BUCKETS).alias("_bucket"))
    counts = all_of.groupBy("column", "_bucket").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    table = written(counts, "buckets")
    try:
        per = _sums(table, ["n"]).where(holds_places(quantiles)).join(table.drop("n"), ["column", "_bucket"]).collect()  # a few buckets a column
    finally:
        discard(df.sparkSession, table)
    inside = []
    for i, c in enumerate(columns):
        wanted = F.lit(False)
        for r in per:
            wanted = wanted | c.between(r.low, r.high) if r.column == i else wanted
        inside.append(F.when(wanted, pairs[i]))
    near = df.select(F.inline(F.array_compact(F.array(*inside)))).groupBy("column", "value").agg(F.count("*").alias("n")).withColumn("_bucket", _bucket(BUCKETS))
    few = df.sparkSession.createDataFrame([(r.column, r._bucket, r.n, r.before_n, r.total_n) for r in per], "column int, _bucket long, n long, before_n long, total_n long")
    return _placed(near, F.broadcast(few), ["n"], few=True)


def quantile(q: float, weight: str = "n") -> Column:
    """An aggregate over rows of :func:`ranked`: the exact quantile, interpolated between neighbours; null without rows."""
    place = f"((total_{weight} - 1) * {float(q)}D)"
    at = f"max(CASE WHEN {weight} > 0 AND before_{weight} <= {{k}}{place} AND {{k}}{place} < before_{weight} + {weight} THEN value END)"
    low, high = at.format(k="floor"), at.format(k="ceil")
    return F.expr(f"CASE WHEN {low} = {high} THEN {low} ELSE {low} + ({high} - {low}) * max({place} - floor{place}) END")


def counted(values: DataFrame) -> DataFrame:
    """:func:`counted_by_value` of (column, value) rows, each of weight n = 1."""
    return counted_by_value(values.select("column", "value", F.lit(1).cast("long").alias("n")), ["n"])


def first_share(df: DataFrame, key: str, order: list[str], share: float, flag: str) -> DataFrame:
    """``df`` with a flag on the first ``round(n * share)`` of the n rows of each key in the order of the columns; keys of one row have none.

    The first column is a number, spread well.  Its buckets are counted, only the bucket that the last flagged row lies in is
    sorted, and rows are compared with that row: none is moved.  Rows that are equal in the order are on one side, so the order should name all
    that tells rows apart.
    """
    last = last_of_share(df, key, order, share)
    made = df.withColumn("_share_whole", F.struct(*[F.col(f"`{c}`") for c in order])).join(F.broadcast(last), F.col(f"`{key}`").eqNullSafe(F.col("_share_key")), "left")
    return made.withColumn(flag, F.coalesce(F.col("_share_whole") <= F.col("_share_last"), F.lit(False))).drop("_share_whole", "_share_key", "_share_last")


def last_of_share(df: DataFrame, key: str, order: list[str], share: float) -> DataFrame:
    """(_share_key, _share_last) of the keys that :func:`first_share` flags rows of: the last such row's columns of the order, as a struct."""
    whole = F.struct(*[F.col(f"`{c}`") for c in order])
    at = df.select(F.col(f"`{key}`").alias("column"), F.col(f"`{order[0]}`").cast("double").alias("value"), whole.alias("_share_row")).select("column", "_share_row", _bucket(BUCKETS).alias("_bucket"))
    per = _sums(at.groupBy("column", "_bucket").agg(F.count("*").alias("n")), ["n"])
    left = F.round(F.col("total_n") * share).cast("long") - F.col("before_n")
    cut = per.withColumn("_share_left", left).where("total_n >= 2 AND _share_left > 0 AND _share_left <= n")
    cut = cut.select(F.col("column").alias("_share_key"), F.col("_bucket").alias("_share_in"), "_share_left")
    inside = at.join(F.broadcast(cut), F.col("column").eqNullSafe(F.col("_share_key")) & (F.col("_bucket") == F.col("_share_in")))  # a bucket a key
    return inside.withColumn("_share_place", F.row_number().over(Window.partitionBy("_share_key").orderBy("_share_row"))).where("_share_place = _share_left").select("_share_key", F.col("_share_row").alias("_share_last"))


def numbered(df: DataFrame, key: str, order: list[str], ranges: int | None = None) -> DataFrame:
    """``df`` with place (from 0) and total: each row's place among those of its key, in the order of the columns, and their number.

    Rows that are equal in the order go by a hash of the whole row, so only equal rows are interchangeable.
    """
    ties = {"_hash": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), "_chance": F.rand(7)}
    by = [F.col(f"`{c}`") for c in (key, *order)] + [F.col(c) for c in ties]
    dealt = df.withColumns(ties)
    dealt = dealt.repartitionByRange(ranges, *by) if ranges else dealt.repartitionByRange(*by)
    table = written(dealt.sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()).drop(*ties), "numbered")
    part = F.shiftright("_id", 33)
    per = table.groupBy(F.col(f"`{key}`").alias("_key"), part.alias("_p")).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    whole = Window.partitionBy("_key")
    earlier = F.coalesce(F.sum("_n").over(whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.select("_key", "_p", (earlier - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("total"))
    # a key's rows of a range stand together, so a row's place is its number with one shift
    made = table.join(per, F.col(f"`{key}`").eqNullSafe(F.col("_key")) & (part == F.col("_p")))
    return made.withColumn("place", F.col("_id") + F.col("_shift")).drop("_id", "_p", "_key", "_shift")
