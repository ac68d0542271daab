"""Profiles of columns, for reading before anything is trained."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import numeric
from .ranks import counted_by_value, near_quantiles, quantile

QUANTILES = {"q01": 0.01, "q25": 0.25, "median": 0.5, "q75": 0.75, "q99": 0.99}


def profile_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column: counts and shares of missing, junk and zero values, and the distribution; the skewness is that of samples.

    Values are counted once by value, and all else follows from these counts: moments about the mean, and quantiles.
    """
    kind = lambda c: F.when(F.col(c).isNull(), "missing").when(numeric(df, c).isNull(), "junk").otherwise("number")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), numeric(df, c).alias("value"), kind(c).alias("kind")) for c in columns])
    rows = df.select(F.inline(pairs))
    one = lambda of: F.when(F.col("kind") == of, 1).otherwise(0).cast("long").alias(of)
    at = counted_by_value(rows.select("column", "value", one("number"), one("missing"), one("junk")), ["number", "missing", "junk"])
    numbers = at.where("number > 0")
    n, x = F.col("number"), F.col("value")
    told = at.groupBy("column").agg(
        F.sum(F.col("number") + F.col("missing") + F.col("junk")).alias("rows"), F.sum("missing").alias("missing"), F.sum("junk").alias("non_numeric"), F.sum("number").alias("n"),
        F.coalesce(F.sum(F.when(x == 0, n)), F.lit(0)).alias("zeros"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("n_unique"), (F.sum(n * x) / F.nullif(F.sum("number"), F.lit(0))).alias("mean"),
    )
    about = numbers.join(F.broadcast(told.select("column", "mean")), "column")  # a row a column
    power = lambda k: F.sum(n * F.pow(x - F.col("mean"), F.lit(k))).alias(f"m{k}")
    moments = about.groupBy("column").agg(power(2), power(3))
    near = near_quantiles(numbers.select("column", "value", F.col("number").alias("n"), "_bucket"), QUANTILES.values())
    placed = near.groupBy("column").agg(*[quantile(q).alias(name) for name, q in QUANTILES.items()])
    total = F.col("n").cast("double")
    spread = F.nullif(F.col("m2") / total, F.lit(0.0))
    made = told.join(moments, "column", "left").join(placed, "column", "left").withColumns({
        "missing_ratio": F.col("missing") / F.col("rows"), "zeros_ratio": F.col("zeros") / F.col("rows"), "std": F.when(total > 1, F.sqrt(F.col("m2") / (total - 1))),
        "skew": F.when(total > 2, F.col("m3") / total / F.pow(spread, F.lit(1.5)) * F.sqrt(total * (total - 1)) / (total - 2)),
    })
    shown = ["column", "missing", "missing_ratio", "non_numeric", "zeros", "zeros_ratio", "min", "max", "mean", "std", "skew", "n_unique", *QUANTILES]
    return made.select(*shown, (F.col("skew") > 2).alias("heavy_tailed"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) of all present values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))


def profile_categorical(df: DataFrame, columns: list[str], top: int = 5, rare: float = 0.01) -> DataFrame:
    """A row per column: missing, distinct values, the most frequent ones, and how many values and rows are rare."""
    from .rules import stacked

    base = stacked(df, "column", {c: {"missing": F.count_if(F.col(c).isNull()), "rows": F.count("*")} for c in columns})
    counts = value_counts(df, columns)
    # ranks beyond the top are cut before the shuffle
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))).where(F.col("rank") <= top)
    shown = ranked.groupBy("column").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "value", "n"))), lambda x: F.concat(x["value"], F.lit("="), x["n"].cast("string"))), "|").alias("top"))
    bound = F.greatest(F.floor(F.col("rows") * rare), F.lit(1))
    made = counts.join(F.broadcast(base.select("column", "rows")), "column").groupBy("column").agg(
        F.count("*").alias("n_unique"), F.count_if(F.col("n") <= bound).alias("rare_values"), F.coalesce(F.sum(F.when(F.col("n") <= bound, F.col("n"))), F.lit(0)).alias("rare_rows"), (F.max("n") / F.max("rows")).alias("top_share"),
    )
    return base.join(made, "column", "left").join(shown, "column", "left").drop("rows")


def profile_target(df: DataFrame, target: str) -> DataFrame:
    """Positives, negatives, the rate of positives and the imbalance."""
    up, down = F.count_if(F.col(target) == 1), F.count_if(F.col(target) != 1)
    return df.agg(up.alias("positive"), down.alias("negative"), F.round(up / F.nullif(up + down, F.lit(0)), 6).alias("rate"), F.round(down / F.nullif(up, F.lit(0)), 6).alias("imbalance"))


def case_conflicts(df: DataFrame, columns: list[str], most: int = 10) -> DataFrame:
    """(column, folded, spellings, n): values that differ only in case; the first ``most`` of each column."""
    distinct = value_counts(df, columns)
    groups = distinct.groupBy("column", F.lower("value").alias("folded")).agg(F.array_join(F.sort_array(F.collect_list("value")), "|").alias("spellings"), F.count("*").alias("n")).where("n > 1")
    return groups.withColumn("_r", F.row_number().over(Window.partitionBy("column").orderBy("folded"))).where(F.col("_r") <= most).drop("_r")


def profile_frame(df: DataFrame, numeric_columns: list[str], categorical_columns: list[str], target: str | None = None) -> dict[str, DataFrame]:
    """The whole profile of a table as small tables by name; columns and a target that are not there are left out."""
    numbers, kinds = [c for c in numeric_columns if c in df.columns], [c for c in categorical_columns if c in df.columns]
    out = {}
    if numbers:
        out["numeric"] = profile_numeric(df, numbers)
    if kinds:
        out |= {"categorical": profile_categorical(df, kinds), "case_conflicts": case_conflicts(df, kinds)}
    if target and target in df.columns:
        out["target"] = profile_target(df, target)
    return out
