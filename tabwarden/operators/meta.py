"""What accumulated runs tell: influence of settings and conditions, dynamics, winners, calibration.

A runs table has (batch_idx, model, metrics..., settings...), a row per model and batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_GROUP = 3


def observations(manifests: DataFrame) -> DataFrame:
    """Manifests (batch_idx, metrics: map<model, struct>, hyperparameters: map<model, map>) as a row per model."""
    each = manifests.select("*", F.explode(F.map_entries("metrics")).alias("m")).select("batch_idx", F.col("m.key").alias("model"), "m.value.*", F.col("hyperparameters")[F.col("m.key")].alias("settings"), *[c for c in manifests.columns if c not in ("batch_idx", "metrics", "hyperparameters")])
    return each


def stats(x: Column | str) -> list[Column]:
    """n, mean, median, min, max and standard deviation (0 for one value)."""
    return [F.count(x).alias("n"), F.round(F.avg(x), 6).alias("mean"), F.round(F.percentile(x, F.lit(0.5)), 6).alias("median"), F.min(x).alias("min"), F.max(x).alias("max"), F.round(F.coalesce(F.stddev_samp(x), F.lit(0.0)), 6).alias("std")]


def spearman(df: DataFrame, x: str, y: str, by: list[str] | None = None, least: int = 3) -> DataFrame:
    """(by..., n, rho): null under ``least`` pairs or where a side is constant; four decimals."""
    by = by or []
    df = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    for c in ("x", "y"):  # ranks, averaged over ties
        place = F.row_number().over(Window.partitionBy(*by).orderBy(c))
        df = df.withColumn(f"_{c}", place).withColumn(f"r{c}", F.avg(f"_{c}").over(Window.partitionBy(*by, c)))
    varied = (F.min("rx") < F.max("rx")) & (F.min("ry") < F.max("ry"))
    made = df.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.covar_pop("rx", "ry") / F.nullif(F.stddev_pop("rx") * F.stddev_pop("ry"), F.lit(0.0)), 4).alias("rho"), varied.alias("varied"))
    return made.withColumn("rho", F.when((F.col("n") >= least) & F.col("varied"), F.col("rho"))).drop("varied")


def feature_influence(runs: DataFrame, setting: str, metric: str = "f1") -> DataFrame:
    """(model, n_values, best, worst, spread, verdict): settings are compared within a model only."""
    groups = runs.where(F.col(setting).isNotNull() & F.col(metric).isNotNull()).groupBy("model", F.col(setting).cast("string").alias("value")).agg(F.count("*").alias("n"), F.avg(metric).alias("mean"))
    made = groups.groupBy("model").agg(
        F.count("*").alias("n_values"), F.max_by("value", F.struct("mean", "value")).alias("best"), F.min_by("value", F.struct("mean", "value")).alias("worst"),
        F.round(F.max("mean") - F.min("mean"), 6).alias("spread"), F.min("n").alias("least"),
    )
    verdict = F.when(F.col("n_values") < 2, "constant").when(F.col("least") < MIN_GROUP, "insufficient").otherwise("varied")
    return made.select("model", "n_values", "best", "worst", "spread", verdict.alias("verdict"))


def rank_settings(runs: DataFrame, settings: list[str], metric: str = "f1") -> DataFrame:
    """(rank, setting, spread, n_values, verdict): settings by the largest spread within a model, all in one pass.

    Settings that vary in no model come last, in order of their names.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("setting"), F.col(c).cast("string").alias("value")) for c in settings])
    long = runs.where(F.col(metric).isNotNull()).select("model", F.col(metric).alias("_m"), F.inline(pairs)).where("value IS NOT NULL")
    means = long.groupBy("model", "setting", "value").agg(F.count("*").alias("n"), F.avg("_m").alias("mean"))
    each = means.groupBy("model", "setting").agg(F.count("*").alias("k"), F.min("n").alias("least"), (F.max("mean") - F.min("mean")).alias("spread"))
    made = each.groupBy("setting").agg(F.round(F.max("spread"), 6).alias("spread"), F.max("k").alias("n_values"), F.bool_or((F.col("k") > 1) & (F.col("least") >= MIN_GROUP)).alias("varied"))
    verdict = F.when(F.col("n_values") < 2, "constant").when(F.col("varied"), "varied").otherwise("insufficient")
    rank = F.row_number().over(Window.orderBy(F.desc("spread"), "setting"))  # a row a setting
    return made.select(rank.cast("long").alias("rank"), "setting", "spread", "n_values", verdict.alias("verdict"))


def roll_up(rows: DataFrame, key: str, count: str = "violations", total: str = "rows") -> DataFrame:
    """(key, count, batches, mean_ratio) of rows by batch: the sum, in how many batches there were any, and the mean share."""
    ratio = F.avg(F.col(count) / F.nullif(F.col(total), F.lit(0)))
    return rows.groupBy(key).agg(F.sum(count).alias(count), F.count_if(F.col(count) > 0).alias("batches"), ratio.alias("mean_ratio"))


def overall_verdict(runs: DataFrame, setting: str, metric: str = "f1") -> str:
    """no_data, constant, confounded (values differ between models only), insufficient or varied."""
    per = feature_influence(runs, setting, metric).collect()
    if not per:
        return "no_data"
    if any(r["verdict"] == "varied" for r in per):
        return "varied"
    if any(r["n_values"] > 1 for r in per):
        return "insufficient"
    return "constant" if len({r["best"] for r in per}) == 1 else "confounded"


def condition_influence(runs: DataFrame, conditions: list[str], metric: str = "f1", least: int = 8) -> DataFrame:
    """(model, condition, n, rho) of all defined correlations, strongest first in each model."""
    pairs = F.array(*[F.struct(F.lit(c).alias("condition"), F.col(c).cast("double").alias("value")) for c in conditions])
    long = runs.select("model", F.col(metric).alias("_m"), F.inline(pairs))
    return spearman(long, "value", "_m", ["model", "condition"], least).where("rho IS NOT NULL")


def trends(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """(by..., n, head, tail, trend) over batch_idx: the first against the last quarter."""
    per = Window.partitionBy(*by)
    at = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("v"), F.row_number().over(per.orderBy("batch_idx")).alias("i"), F.count("*").over(per).alias("n"))
    quarter = F.greatest(F.floor(F.col("n") / 4), F.lit(1))
    made = at.groupBy(*by).agg(F.max("n").alias("n"), F.avg(F.when(F.col("i") <= quarter, F.col("v"))).alias("head"), F.avg(F.when(F.col("i") > F.col("n") - quarter, F.col("v"))).alias("tail"))
    change = F.col("tail") - F.col("head")
    trend = F.when(F.col("n") < 8, "not enough").when(F.abs(change) / F.greatest(F.abs("head"), F.lit(1e-9)) < 0.10, "stable").when(change > 0, "rising").otherwise("falling")
    return made.withColumn("trend", trend)


def dynamics(runs: DataFrame, metric: str = "f1") -> DataFrame:
    """A row per model: statistics, first, last and best value, the best one's batch, trend."""
    own = runs.where(F.col(metric).isNotNull())
    made = own.groupBy("model").agg(*stats(metric), F.min_by(metric, "batch_idx").alias("first"), F.max_by(metric, "batch_idx").alias("last"), F.min_by("batch_idx", F.struct(-F.col(metric), "batch_idx")).alias("best_batch"))
    return made.join(trends(own, metric, ["model"]).select("model", "trend"), "model")


def winners(runs: DataFrame, order: list[str], metric: str = "f1") -> DataFrame:
    """(batch_idx, model, value): the best model of each batch; of equals the first in the declared order."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("model"))
    rank = F.row_number().over(Window.partitionBy("batch_idx").orderBy(F.desc(metric), place))
    return runs.where(F.col(metric).isNotNull()).withColumn("_r", rank).where("_r = 1").select("batch_idx", "model", F.col(metric).alias("value"))


def calibration(runs: DataFrame) -> DataFrame:
    """(model, n, predicted, actual, ratio) of mean positive rates; batches without positives are left out."""
    made = runs.where("actual_positive_rate > 0").groupBy("model").agg(F.count("*").alias("n"), F.round(F.avg("predicted_positive_rate"), 6).alias("predicted"), F.round(F.avg("actual_positive_rate"), 6).alias("actual"))
    return made.withColumn("ratio", F.round(F.col("predicted") / F.col("actual"), 4))


def consensus(importances: DataFrame, top: int = 15) -> DataFrame:
    """(feature, models): in how many models a feature (model, feature, weight) is among the strongest."""
    rank = F.row_number().over(Window.partitionBy("model").orderBy(F.desc(F.abs("weight")), "feature"))
    return importances.withColumn("_r", rank).where(F.col("_r") <= top).groupBy("feature").agg(F.count("*").alias("models")).orderBy(F.desc("models"), "feature")
