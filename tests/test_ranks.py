"""Ranks and places in few and in many ranges, against sorting."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwarden.operators import ranks, scoring

ROWS = "column string, value double"


def values():
    r = random.Random(8)
    out = [("a", r.gauss(0, 1)) for _ in range(700)] + [("b", float(r.randrange(5))) for _ in range(500)] + [("c", 3.0)]
    return out + [("d", x) for x in (-math.inf, -0.0, 0.0, 1e300, math.inf, 2.0, 2.0)]


@pytest.mark.parametrize("buckets", [1, 50, ranks.BUCKETS])
def test_ranks_and_quantiles(spark, buckets):
    rows = values()
    at = ranks.ranked(spark.createDataFrame(rows, ROWS).withColumn("n", F.lit(1).cast("long")), ["n"], buckets)
    got = {(r.column, r.value): (r.n, r.before_n, r.total_n) for r in at.collect()}
    for column in "abcd":
        own = [v for c, v in rows if c == column]
        assert {v: got[column, v] for v in own} == {v: (own.count(v), sum(x < v for x in own), len(own)) for v in own}
    made = {r.column: r for r in at.groupBy("column").agg(*[ranks.quantile(q).alias(f"q{int(q * 100)}") for q in (0.0, 0.25, 0.5, 0.99, 1.0)]).collect()}
    for column in "abc":
        own = [v for c, v in rows if c == column]
        for q in (0, 25, 50, 99, 100):
            assert math.isclose(made[column][f"q{q}"], np.quantile(own, q / 100), abs_tol=1e-12)


@pytest.mark.parametrize("ranges", [None, 7])
@pytest.mark.parametrize("order", [["x", "i"], ["s", "i"], ["t", "i"]])
def test_places(spark, ranges, order):
    r = random.Random(2)
    names = ["", "a", "ab", "b", "é", "zz", None]
    rows = [(r.choice(["p", "q", None]), r.choice([None, 1.5, -2.0, 7.0, float(r.randrange(90))]), r.choice(names) if i % 3 else f"k{r.randrange(50)}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, x double, s string, i int").withColumn("t", F.timestamp_seconds(F.col("x") * 1000))
    got = ranks.numbered(df, "key", order, ranges).collect()
    assert len(got) == 400 and {tuple(x[:4]) for x in got} == set(rows)
    for key in ("p", "q", None):
        own = [x for x in got if x.key == key]
        first = lambda x: (x[order[0]] is not None, x[order[0]].encode() if isinstance(x[order[0]], str) else x[order[0]] or 0, x.i)
        want = sorted(own, key=lambda x: first(x) if x[order[0]] is not None else (False, b"" if order[0] == "s" else 0, x.i))
        if order[0] == "t":
            want = sorted(own, key=lambda x: (x.t is not None, x.x or 0, x.i))
        assert [x.i for x in sorted(own, key=lambda x: x.place)] == [x.i for x in want] and {x.total for x in own} == {len(own)}
        assert sorted(x.place for x in own) == list(range(len(own)))


def test_quantiles_of_few_buckets_and_first_shares(spark):
    rows = values()
    at = ranks.near_quantiles(ranks.counted(spark.createDataFrame(rows, ROWS)), [0.0, 0.3, 0.5, 1.0])
    assert at.count() < 60  # of over 700
    made = {r.column: r for r in at.groupBy("column").agg(*[ranks.quantile(q).alias(f"q{int(q * 100)}") for q in (0.0, 0.3, 0.5, 1.0)]).collect()}
    for column in "abc":
        own = [v for c, v in rows if c == column]
        for q in (0, 30, 50, 100):
            assert math.isclose(made[column][f"q{q}"], np.quantile(own, q / 100), abs_tol=1e-12)
    r = random.Random(3)
    keyed = [(r.choice(["p", "q", None]), r.randrange(30), r.randrange(5), i) for i in range(500)] + [("one", 1, 1, 1)]
    got = ranks.first_share(spark.createDataFrame(keyed, "key string, a int, `b` int, i int"), "key", ["a", "b", "i"], 0.3, "first").collect()
    assert len(got) == len(keyed)
    for key in ("p", "q", None, "one"):
        own = sorted((x.a, x.b, x.i, x.first) for x in got if x.key == key)
        want = math.floor(len(own) * 0.3 + 0.5) if len(own) > 1 else 0
        assert [x[3] for x in own] == [True] * want + [False] * (len(own) - want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ROWS)
    assert ranks.first_share(none, "column", ["value"], 0.2, "f").count() == 0
    assert ranks.counted(none).count() == 0 and ranks.numbered(none, "column", ["value"]).count() == 0
    assert scoring.roc_auc(spark.createDataFrame([], "y int, s double"), "y", "s").first()[0] is None
    got = scoring.choose_threshold(spark.createDataFrame([], "p double"), "p", 0.05).first()
    assert (got.threshold, got.n_distinct, got.ties_limit_calibration) == (0.5, 0, False)
