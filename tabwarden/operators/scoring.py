"""Metrics of scored rows, thresholds, ranges and weights - each one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite, numeric
from .ranks import counted, first_share, near_quantiles, quantile, ranked


def confusion(df: DataFrame, label: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 (0 where undefined), accuracy and both positive rates."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    n = df.groupBy(*(by or [])).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    c = {k: F.col(k) for k in ("tp", "fp", "fn", "tn")}
    total = c["tp"] + c["fp"] + c["fn"] + c["tn"]
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return n.withColumns({
        "precision": share(c["tp"], c["tp"] + c["fp"]), "recall": share(c["tp"], c["tp"] + c["fn"]), "f1": share(2 * c["tp"], 2 * c["tp"] + c["fp"] + c["fn"]),
        "accuracy": share(c["tp"] + c["tn"], total), "predicted_positive_rate": share(c["tp"] + c["fp"], total), "actual_positive_rate": share(c["tp"] + c["fn"], total),
    })


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """(roc_auc): the rank sum with ties averaged; null where a class is absent.  Equal scores are counted together first."""
    up = (F.col(label) == 1).cast("long")
    at = ranked(df.select(F.lit("").alias("column"), F.col(score).cast("double").alias("value"), up.alias("up"), (1 - up).alias("down")), ["up", "down"])
    won = (F.col("before_down") + F.col("down") / 2) * F.col("up")
    return at.agg((F.sum(won) / F.nullif(F.sum("up") * F.sum("down"), F.lit(0))).alias("roc_auc"))


def class_weights(df: DataFrame, label: str, mode: str = "balanced") -> DataFrame:
    """(label, n, weight): n / (2 * count), its root, or 1."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    balanced = F.sum("n").over(Window.partitionBy()) / (2 * F.col("n"))
    weight = {"balanced": balanced, "sqrt": F.sqrt(balanced), "none": F.lit(1.0)}[mode]
    return counts.withColumn("weight", weight)


def choose_threshold(df: DataFrame, probability: str, target_rate: float, default: float = 0.5) -> DataFrame:
    """One row: the probability that the wanted share of rows reaches, and what it achieves."""
    p = df.select(F.lit("").alias("column"), finite(F.col(probability).cast("double")).alias("value")).where("value IS NOT NULL")
    at = counted(p)
    known = 0 < target_rate < 1
    cut = quantile(1.0 - target_rate) if known else F.lit(None).cast("double")
    near = near_quantiles(at, [0.5, *([1.0 - target_rate] if known else [])])
    found = near.agg(F.coalesce(cut, F.lit(default)).alias("cut"), quantile(0.5).alias("mid"))
    share = lambda of: F.sum(F.when(of, F.col("n")).otherwise(0)) / F.sum("n")
    made = at.join(F.broadcast(found)).agg(F.first("cut").alias("cut"), share(F.col("value") >= F.col("cut")).alias("achieved"), share(F.col("value") >= 0.5).alias("half"), F.first("mid").alias("mid"), F.count("*").alias("n_distinct"))
    return made.select(
        F.round(F.coalesce("cut", F.lit(default)), 6).alias("threshold"), F.lit(round(float(target_rate), 6)).alias("target_rate"), F.round("achieved", 6).alias("achieved_rate"), F.round("half", 6).alias("raw_rate_at_half"),
        F.round("mid", 6).alias("median_probability"), "n_distinct", F.coalesce(F.col("achieved") > min(1.0, target_rate * 1.5), F.lit(False)).alias("ties_limit_calibration"),
    )


def tukey_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, low, high): three interquartile ranges around the quartiles, within the values; quantiles where the range is 0."""
    from .drift import stacked_values

    q = {"a": 0.005, "q1": 0.25, "q3": 0.75, "b": 0.995}
    near = near_quantiles(counted(stacked_values(df, columns)), [0.0, *q.values(), 1.0])
    made = near.groupBy("column").agg(*[quantile(x).alias(name) for name, x in q.items()], F.min("value").alias("lo"), F.max("value").alias("hi"))
    iqr = F.col("q3") - F.col("q1")
    low = F.when(iqr > 0, F.greatest(F.col("q1") - 3 * iqr, F.col("lo"))).otherwise(F.col("a"))
    high = F.when(iqr > 0, F.least(F.col("q3") + 3 * iqr, F.col("hi"))).otherwise(F.col("b"))
    return made.select("column", low.alias("low"), high.alias("high"))


def outliers(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> Column:
    """How many values of a row lie outside their column's range."""
    out = F.lit(0)
    for c, (low, high) in ranges.items():
        if c in df.columns:
            x = numeric(df, c)
            out = out + F.coalesce(((x < low) | (x > high)).cast("int"), F.lit(0))
    return out


def count_outliers(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """(outliers, rows, ratio): offending values, summed over columns; the ratio to rows can exceed 1."""
    return df.agg(F.coalesce(F.sum(outliers(df, ranges)), F.lit(0)).alias("outliers"), F.count("*").alias("rows")).withColumn("ratio", F.col("outliers") / F.nullif(F.col("rows"), F.lit(0)))


def stratified_split(df: DataFrame, label: str, order: list[Column], validation: float = 0.2) -> DataFrame:
    """``df`` with is_validation: in each class the first rows in the given (hashed) order; a class with one row has none.

    Rows that are equal as a whole are all on one side.
    """
    names = [f"_order{i}" for i in range(len(order))]
    return first_share(df.withColumns(dict(zip(names, order, strict=True))), label, names, validation, "is_validation").drop(*names)
