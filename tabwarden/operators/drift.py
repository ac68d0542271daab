"""Drift of a batch against a reference: PSI, KS, label shift and unseen categories, for all columns in one pass.

Numeric values are stacked as (column, value), so that one plan serves any number of columns.  A reference holds at most
``LIMIT`` values a column and batch of its window, thinned evenly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite, interpret_psi, numeric
from .ranks import counted_by_value, holds_places, numbered, quantile, ranked_where

LIMIT = 20_000


def stacked_values(df: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """(more..., column, value) of all present finite values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), finite(numeric(df, c)).alias("value")) for c in columns if c in df.columns])
    return df.select(*more, F.inline(pairs)).where("value IS NOT NULL")


def _psi_term(a: Column, e: Column) -> Column:
    return (a - e) * F.log(a / e)


def compared(reference: DataFrame, actual: DataFrame) -> DataFrame:
    """The stacked values of both sides counted by value, with weights e (expected) and a (actual)."""
    side = lambda df, e, a: df.select("column", "value", F.lit(e).cast("long").alias("e"), F.lit(a).cast("long").alias("a"))
    return counted_by_value(side(reference, 1, 0).unionByName(side(actual, 0, 1)), ["e", "a"])


def _share(x: Column, side: str) -> Column:
    return x / F.nullif(F.col(f"total_{side}"), F.lit(0))


def _telling(both: DataFrame, bins: int | None, gap: bool, medians: bool = False) -> DataFrame:
    """The ranked values that edges, medians and the largest gap need; of each column those of the first bucket at least."""

    def keep(per: DataFrame) -> DataFrame:
        wanted = ["before_e = 0 AND before_a = 0"]
        if bins:
            wanted.append(holds_places([i / bins for i in range(bins + 1)], "e"))
        if medians:
            wanted += [holds_places([0.5], "e"), holds_places([0.5], "a")]
        if gap:
            # within a bucket the gap differs from that at its ends by its larger share at most
            gaps = "abs(({0}) / nullif(total_e, 0) - ({1}) / nullif(total_a, 0))"
            ends = f"greatest({gaps.format('before_e', 'before_a')}, {gaps.format('before_e + e', 'before_a + a')})"
            per = per.selectExpr("*", f"{ends} AS _ends", f"max({ends}) OVER (PARTITION BY column) AS _best")
            wanted.append("coalesce(_ends + greatest(e / nullif(total_e, 0), a / nullif(total_a, 0)) >= _best - 1e-9, false)")
        return per.where(" OR ".join(f"({w})" for w in wanted)).drop("_ends", "_best")

    return ranked_where(both, ["e", "a"], keep)


def _edges(bins: int) -> Column:
    """The reference's quantiles, each once."""
    return F.array_distinct(F.array_compact(F.array(*[quantile(i / bins, "e") for i in range(bins + 1)])))


def _largest_gap() -> Column:
    share = lambda x: _share(F.col(f"before_{x}") + F.col(x), x)
    return F.coalesce(F.max(F.abs(share("e") - share("a"))), F.lit(float("nan")))


def _psi(both: DataFrame, edges: DataFrame, eps: float) -> DataFrame:
    """(column, psi) of compared values and each column's edges, of which the outer ones are open."""
    inner = F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 2, F.lit(0)))
    binned = both.join(F.broadcast(edges.select("column", "edges")), "column").withColumn("bin", F.size(F.filter(inner, lambda x: F.col("value") >= x)))
    counts = binned.groupBy("column", "bin").agg(F.sum("e").alias("e"), F.sum("a").alias("a"), F.first(F.size("edges")).alias("k"))
    column = Window.partitionBy("column")  # a row a bin
    counts = counts.withColumns({"te": F.sum("e").over(column), "ta": F.sum("a").over(column)})
    share = lambda x, t: F.greatest(F.col(x) / F.nullif(F.col(t), F.lit(0)), F.lit(eps))
    made = counts.withColumn("term", _psi_term(share("a", "ta"), share("e", "te"))).groupBy("column").agg(F.sum("term").alias("psi"), F.max("k").alias("k"), F.max("ta").alias("ta"))
    return made.select("column", F.when((F.col("k") >= 3) & (F.col("ta") > 0), F.col("psi")).otherwise(F.lit(float("nan"))).alias("psi"))


def psi_numeric(reference: DataFrame, actual: DataFrame, bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """(column, psi) of stacked values: bins are the reference's quantiles, the outer ones open; NaN with under two bins."""
    both = compared(reference, actual)
    return _psi(both, _telling(both, bins, False).groupBy("column").agg(_edges(bins).alias("edges")), eps)


def ks_statistic(reference: DataFrame, actual: DataFrame) -> DataFrame:
    """(column, ks): the largest difference of the two empirical distribution functions."""
    return _telling(compared(reference, actual), None, True).groupBy("column").agg(_largest_gap().alias("ks"))


def binary_psi(reference_rate: Column, actual_rate: Column, eps: float = 1e-6) -> Column:
    """PSI of two buckets; shares are clipped and then sum to one again."""
    def shares(rate: Column) -> tuple[Column, Column]:
        up, down = F.greatest(rate, F.lit(eps)), F.greatest(1 - rate, F.lit(eps))
        return up / (up + down), down / (up + down)

    (eu, ed), (au, ad) = shares(reference_rate), shares(actual_rate)
    return _psi_term(au, eu) + _psi_term(ad, ed)


def category_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, share) of present values, as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns if c in df.columns])
    counts = df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("column"))).drop("n")


def psi_categorical(reference: DataFrame, actual: DataFrame, rare: float = 0.01, eps: float = 1e-4) -> DataFrame:
    """(column, psi) of shares: values rare on both sides are one group; NaN where all are rare."""
    both = reference.select("column", "value", F.col("share").alias("e")).join(actual.select("column", "value", F.col("share").alias("a")), ["column", "value"], "full_outer")
    both = both.na.fill(0.0, ["e", "a"])
    total = lambda x: F.coalesce(F.nullif(F.sum(x).over(Window.partitionBy("column")), F.lit(0.0)), F.lit(1.0))
    both = both.withColumns({"e": F.col("e") / total("e"), "a": F.col("a") / total("a")})
    few = (F.col("e") < rare) & (F.col("a") < rare)
    groups = both.groupBy("column", F.when(~few, F.col("value")).alias("group")).agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    # the rare group takes part even if empty
    groups = groups.unionByName(groups.select("column").distinct().withColumns({"group": F.lit(None).cast("string"), "e": F.lit(0.0), "a": F.lit(0.0)})).groupBy("column", "group").agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    clipped = groups.withColumns({x: F.greatest(F.col(x), F.lit(eps)) for x in ("e", "a")})
    one = lambda x: F.col(x) / F.sum(x).over(Window.partitionBy("column"))
    terms = clipped.withColumns({"e": one("e"), "a": one("a")})
    made = terms.groupBy("column").agg(F.sum(_psi_term(F.col("a"), F.col("e"))).alias("psi"), F.count("group").alias("n"))
    return made.select("column", F.when(F.col("n") > 0, F.col("psi")).otherwise(F.lit(float("nan"))).alias("psi"))


def new_categories(reference: DataFrame, actual: DataFrame, most: int = 8) -> DataFrame:
    """(column, n_new, share, examples) of values without a share in the reference.

    Values are counted by an aggregate; the first ones are found by ranks that every task cuts before the shuffle.
    """
    unseen = actual.join(reference.select("column", "value"), ["column", "value"], "left_anti")
    told = unseen.groupBy("column").agg(F.count("*").alias("n_new"), F.sum("share").alias("share"))
    first = unseen.select("column", "value").withColumn("r", F.row_number().over(Window.partitionBy("column").orderBy("value"))).where(F.col("r") <= most)
    shown = first.groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("value")), "|").alias("examples"))
    return told.join(shown, "column")


def thinned(values: DataFrame, order: list[str], extend: bool = False, limit: int = LIMIT) -> DataFrame:
    """(column, seq, value): every k-th value in the given order, so that about ``limit`` are left a column.

    The value is the last key of the order, so that equal places have equal values and a retry keeps the same ones.
    Setting takes k = n // limit + 1 beyond the limit, extending k = max(n // limit, 1).
    """
    n = F.col("total")
    step = F.when(n > limit, F.greatest(F.floor(n / limit), F.lit(1)) if extend else F.floor(n / limit) + 1).otherwise(1)
    return numbered(values, "column", [*order, "value"]).where(F.col("place") % step == 0).select("column", F.col("place").alias("seq"), "value")


@dataclass
class Reference:
    """What batches are compared with; each part is a small table."""

    numeric: DataFrame
    categorical: DataFrame
    target_rate: float | None = None

    def save(self, path: str) -> None:
        self.numeric.write.mode("overwrite").parquet(f"{path}/numeric")
        self.categorical.write.mode("overwrite").parquet(f"{path}/categorical")
        self.numeric.sparkSession.createDataFrame([(self.target_rate,)], "rate double").write.mode("overwrite").parquet(f"{path}/target")

    @classmethod
    def load(cls, spark, path: str) -> Reference:
        return cls(spark.read.parquet(f"{path}/numeric"), spark.read.parquet(f"{path}/categorical"), spark.read.parquet(f"{path}/target").first()[0])


def set_reference(df: DataFrame, numeric_columns: list[str], categorical_columns: list[str], target: str | None, order: list[str]) -> Reference:
    rate = df.agg(F.avg((F.col(target) == 1).cast("int"))).first()[0] if target and target in df.columns else None
    values = stacked_values(df, numeric_columns, *[F.col(c).alias(f"_{c}") for c in order])
    return Reference(thinned(values, [f"_{c}" for c in order]), category_shares(df, categorical_columns), rate)


def extend_reference(ref: Reference, df: DataFrame, order: list[str], window: int = 12, limit: int = LIMIT) -> Reference:
    """Append a batch's values and keep the last ``limit * window``; shares are averaged over the sides that have a value.

    The target's rate stays that of the first batch.
    """
    names = [r[0] for r in ref.numeric.select("column").distinct().collect()]
    kinds = [r[0] for r in ref.categorical.select("column").distinct().collect()]
    new = thinned(stacked_values(df, names, *[F.col(c).alias(f"_{c}") for c in order]), [f"_{c}" for c in order], extend=True, limit=limit)
    last = ref.numeric.groupBy("column").agg((F.max("seq") + 1).alias("base"))
    moved = new.join(F.broadcast(last), "column", "left").select("column", (F.col("seq") + F.coalesce("base", F.lit(0))).alias("seq"), "value")
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("seq")))
    kept = ref.numeric.unionByName(moved).withColumn("r", rank).where(F.col("r") <= limit * window).drop("r")
    shares = ref.categorical.unionByName(category_shares(df, kinds)).groupBy("column", "value").agg(F.avg("share").alias("share"))
    return Reference(kept, shares, ref.target_rate)


@dataclass(frozen=True)
class Thresholds:
    psi_warn: float = 0.10
    psi_alert: float = 0.25
    ks_warn: float = 0.20
    new_category_share_warn: float = 0.01


@dataclass
class DriftReport:
    status: str
    max_psi: float
    max_ks: float
    numeric: list[dict] = field(default_factory=list)
    categorical: list[dict] = field(default_factory=list)
    target: dict = field(default_factory=dict)


def numeric_drift(ref: DataFrame, actual: DataFrame, bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """(column, psi, ks, level, reference_median, actual_median) of the reference's columns; values are ranked once."""
    both = compared(ref, actual)
    median = lambda x: F.round(quantile(0.5, x), 4)
    each = _telling(both, bins, True, True).groupBy("column").agg(_edges(bins).alias("edges"), _largest_gap().alias("ks"), median("e").alias("reference_median"), median("a").alias("actual_median"), F.max("total_e").alias("te"))
    made = each.join(_psi(both, each, eps), "column").where("te > 0")
    return made.select("column", "psi", "ks", interpret_psi(F.col("psi")).alias("level"), "reference_median", "actual_median")


def status_of(worst_psi: Column, worst_ks: Column, t: Thresholds = Thresholds()) -> Column:
    return F.when(worst_psi >= t.psi_alert, "alert").when((worst_psi >= t.psi_warn) | (worst_ks >= t.ks_warn), "warn").otherwise("ok")


def check(ref: Reference | None, df: DataFrame, target: str | None, t: Thresholds = Thresholds(), categorical_psi: bool = False, max_categorical: int = 12) -> DriftReport:
    """The whole check of a batch; what comes back has a row a column."""
    if ref is None:
        return DriftReport("unknown", float("nan"), float("nan"))
    columns = [r[0] for r in ref.numeric.select("column").distinct().collect()]
    kinds = sorted(r[0] for r in ref.categorical.select("column").distinct().collect())
    rows = [r.asDict() for r in numeric_drift(ref.numeric, stacked_values(df, columns)).orderBy("column").collect()]
    shares = category_shares(df, kinds)
    cats = {r["column"]: r.asDict() for r in new_categories(ref.categorical, shares).collect()}
    for c in cats.values():
        c["level"] = "warn" if c["share"] > t.new_category_share_warn else "ok"
    if categorical_psi:
        few = F.col("column").isin(kinds[:max_categorical])
        for r in psi_categorical(ref.categorical.where(few), shares.where(few)).collect():
            cats.setdefault(r["column"], {"column": r["column"]})["psi"] = r["psi"]
    good = lambda k: [r[k] for r in rows if r[k] is not None and r[k] == r[k]]
    psi, ks, label = max([0.0, *good("psi")]), max([0.0, *good("ks")]), {}
    if ref.target_rate is not None and target and target in df.columns:
        row = df.agg(F.coalesce(F.avg((F.col(target) == 1).cast("int")), F.lit(0.0)).alias("rate")).select("rate", binary_psi(F.lit(ref.target_rate), F.col("rate")).alias("psi")).first()
        label = {"psi": row["psi"], "reference_rate": ref.target_rate, "actual_rate": row["rate"], "relative_change": round((row["rate"] / ref.target_rate - 1) * 100, 1) if ref.target_rate else None}
        psi = max(psi, row["psi"])
    status = "alert" if psi >= t.psi_alert else "warn" if psi >= t.psi_warn or ks >= t.ks_warn else "ok"
    return DriftReport(status, psi, ks, rows, list(cats.values()), label)
