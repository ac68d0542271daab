"""What training reads, keeps and sends at size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwarden import session
from tabwarden.operators import perceptron, preparation, ranks
from tabwarden.operators.preparation import Preparation
from tabwarden.plans import training

from .test_training import table


def test_medians_by_two_readings_equal_those_of_all_counts(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 4999 / 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 2 - 5.5).alias("b"), F.lit(None).cast("double").alias("c"), F.exp(F.col("id") % 40).alias("d"))
    got = preparation.Statistics(df).medians(["a", "b", "c", "d"])
    assert got == {c: df.agg(F.expr(f"percentile({c}, 0.5)")).first()[0] for c in ("a", "b", "d")}


def test_fitting_keeps_no_table_of_all_values(spark, monkeypatch):
    monkeypatch.setattr(preparation, "counted", lambda *a: pytest.fail("all distinct values are counted"))
    assert Preparation(["x"], ["c"]).fit(table(spark, 300)).fill["x"] > 0


def test_training_keeps_no_rows_in_spark(spark):
    """Rows are a table of their own while training lasts; no cache or shuffle holds them, and nothing is left."""
    caches = spark.sparkContext._jsc.getPersistentRDDs().size()
    out = training.train_batch(table(spark, 2000), ["x"], ["c"], "y", [F.col("i")], names=["lr", "mlp"], models={"mlp": {"layers": [3], "max_iter": 2}})
    assert not [t for t in session._TABLES if "/batch-" in t or "/scores-" in t or "/buckets-" in t] and spark.sparkContext._jsc.getPersistentRDDs().size() == caches
    assert out.rows == 1600 and out.train.count() == 1600 and set(out.train.columns) == {"i", "x", "c", "y"}


def test_coded_rows_are_the_features(spark):
    df = table(spark, 300).withColumn("d", F.lit("only"))
    for top in (None, 5):
        made = Preparation(["x"], ["c", "d"], top_k=top).fit(df)
        odd = df.select("x", "c", "d").unionByName(spark.createDataFrame([(None, "?", "other"), (0.5, None, None)], "x double, c string, d string"))
        want = np.array([r.features.toArray() for r in made.transform(odd, []).collect()])
        got = perceptron.expanded(np.array([r.features for r in made.coded(odd, []).collect()]), made.hot)
        assert np.array_equal(got, want)


def test_runs_of_equal_rows_are_kept_once():
    r = np.random.default_rng(1)
    hot = np.zeros((1000, 12))
    hot[np.arange(1000), np.arange(1000) // 100] = 1
    made = perceptron.Block.of(np.hstack([r.normal(size=(1000, 2)), hot]))
    assert made.columns.tolist() == [0, 1] and made.place.shape == (1, 10) and len(made.start) == 10


def test_shuffles_of_a_written_table_go(spark):
    with session.shuffles_deleted(spark):
        assert spark.conf.get(session._CLEANUP) == "true"
    assert spark.conf.get(session._CLEANUP) == "false" and ranks.near_quantiles_read(spark.range(9), [F.col("id").cast("double")], [0.5]).first()["value"] == 4


def test_a_written_table_is_read_in_small_splits_without_a_shuffle(spark):
    kept = session.written(spark.range(400_000).select("id", F.rand(3).alias("x")).coalesce(1), "splits", row_group=1 << 18)
    small = session.in_splits(kept, 1 << 18)
    assert small.rdd.getNumPartitions() >= 8 > 1 and "Exchange" not in small._jdf.queryExecution().executedPlan().toString()
    assert max(small.groupBy(F.spark_partition_id()).count().select("count").collect())[0] < 200_000
    assert small.agg(F.sum("id")).first()[0] == sum(range(400_000)) and small.sparkSession.conf.get("spark.sql.shuffle.partitions") == "4"
    session.discard(spark, kept)
    assert kept.sparkSession.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 18)
