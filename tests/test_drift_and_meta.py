import math
import random

import numpy as np
import pytest

from tabwarden.operators import drift, meta, preparation, scoring


def stack(spark, values, name="A"):
    return spark.createDataFrame([(name, float(v)) for v in values], "column string, value double")


def psi(expected, actual, bins=10, eps=1e-6):
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, bins + 1)))
    if len(edges) < 3:
        return math.nan
    edges[0], edges[-1] = -np.inf, np.inf
    e, a = (np.clip(np.histogram(x, edges)[0] / len(x), eps, None) for x in (expected, actual))
    return float(np.sum((a - e) * np.log(a / e)))


def ks(a, b):
    at = np.sort(np.concatenate([a, b]))
    return float(np.max(np.abs(np.searchsorted(np.sort(a), at, "right") / len(a) - np.searchsorted(np.sort(b), at, "right") / len(b))))


@pytest.mark.parametrize("shift", [0.0, 0.3, 2.0])
def test_psi_and_ks_match_numpy(spark, shift):
    r = np.random.default_rng(1)
    a, b = r.normal(0, 1, 2000), r.normal(shift, 1, 1500).round(1)
    x, y = stack(spark, a), stack(spark, b)
    assert abs(drift.psi_numeric(x, y).first().psi - psi(a, b)) < 1e-9
    assert abs(drift.ks_statistic(x, y).first().ks - ks(a, b)) < 1e-12


def test_psi_of_few_values_is_unknown(spark):
    two = [0.0] * 900 + [1.0] * 100
    assert math.isnan(drift.psi_numeric(stack(spark, [5.0] * 50), stack(spark, [5.0])).first().psi)
    assert math.isnan(drift.psi_numeric(stack(spark, two), stack(spark, two)).first().psi) == math.isnan(psi(two, two))


def test_monitor(spark, tmp_path):
    r = random.Random(0)
    frame = lambda mean, cats: spark.createDataFrame([(i, r.gauss(mean, 1), r.choice(cats), i % 5 == 0) for i in range(500)], "i long, A double, B string, y boolean").selectExpr("i", "A", "B", "int(y) AS T")
    first = frame(10, ["x", "y"])
    ref = drift.set_reference(first, ["A"], ["B"], "T", ["i"])
    assert drift.check(ref, first, "T").status == "ok" and drift.check(None, first, "T").status == "unknown"
    report = drift.check(ref, frame(50, ["x", "z"]), "T", categorical_psi=True)
    assert report.status == "alert" and report.categorical[0]["examples"] == "z" and report.categorical[0]["level"] == "warn" and report.categorical[0]["psi"] > 1
    for _ in range(3):
        ref = drift.extend_reference(ref, frame(10, ["x"]), ["i"], window=2, limit=300)
    assert ref.numeric.count() == 600 and abs(ref.target_rate - 0.2) < 1e-12
    ref.save(str(tmp_path / "r"))
    again = drift.Reference.load(spark, str(tmp_path / "r"))
    assert again.numeric.count() == 600 and again.target_rate == ref.target_rate
    shares = {x.value: x.share for x in again.categorical.collect()}
    assert shares["x"] > 0.9 and 0.4 < shares["y"] < 0.6  # an absent side is not averaged as zero


def test_thinning_strides(spark):
    values = stack(spark, range(1000)).selectExpr("*", "value AS _o")
    assert drift.thinned(values, ["_o"], limit=300).count() == 250 and drift.thinned(values, ["_o"], extend=True, limit=300).count() == 334 and drift.thinned(values, ["_o"], limit=1000).count() == 1000


def test_spearman_with_ties_and_without_variation(spark):
    rows = [(1, 2), (2, 2), (2, 5), (4, 9), (5, 1), (None, 3)]
    df = spark.createDataFrame(rows, "x int, y int")

    def ranks(v):
        return [sum(o < x for o in v) + (sum(o == x for o in v) + 1) / 2 for x in v]

    a, b = zip(*[r for r in rows if r[0] is not None])
    assert meta.spearman(df, "x", "y").first().rho == round(float(np.corrcoef(ranks(a), ranks(b))[0, 1]), 4)
    assert meta.spearman(spark.createDataFrame([(1, 2), (1, 3), (1, 4)], "x int, y int"), "x", "y").first().rho is None
    assert meta.spearman(df.limit(2), "x", "y").first().rho is None


def test_influence_verdicts(spark):
    rows = [(i, "lr", 0.1 if i < 4 else 0.3, "scratch" if i < 4 else "partial") for i in range(8)] + [(i, "dt", 0.2, "scratch") for i in range(8)]
    df = spark.createDataFrame(rows, "batch_idx int, model string, f1 double, mode string")
    got = {r.model: r for r in meta.feature_influence(df, "mode").collect()}
    assert (got["lr"].verdict, got["lr"].best, got["lr"].spread, got["dt"].verdict) == ("varied", "partial", 0.2, "constant")
    assert meta.overall_verdict(df, "mode") == "varied" and meta.overall_verdict(df.where("f1 > 5"), "mode") == "no_data"
    assert meta.overall_verdict(df.where("model = 'dt' OR mode = 'partial'"), "mode") == "confounded"
    assert {r.model: r.trend for r in meta.trends(df, "f1", ["model"]).collect()} == {"lr": "rising", "dt": "stable"}
    assert meta.trends(df.where("batch_idx < 5"), "f1", ["model"]).first().trend == "not enough"
    assert [r.model for r in meta.winners(df, ["dt", "lr"]).orderBy("batch_idx").collect()] == ["dt"] * 4 + ["lr"] * 4


def test_observations_of_manifests(spark):
    df = spark.createDataFrame([(0, {"lr": {"f1": 0.5}}, {"lr": {"C": "1"}}, 10)], "batch_idx int, metrics map<string,struct<f1:double>>, hyperparameters map<string,map<string,string>>, rows int")
    assert meta.observations(df).first().asDict() == {"batch_idx": 0, "model": "lr", "f1": 0.5, "settings": {"C": "1"}, "rows": 10}


def test_thresholds(spark):
    p = spark.createDataFrame([(float(x),) for x in np.linspace(0.01, 0.99, 1000)] + [(float("nan"),), (None,), (float("inf"),)], "p double")
    got = scoring.choose_threshold(p, "p", 0.05).first()
    assert got.achieved_rate == 0.05 and not got.ties_limit_calibration and got.n_distinct == 1000
    assert scoring.choose_threshold(p.where("p > 5 AND p < 6"), "p", 0.05).first().threshold == 0.5
    tied = spark.createDataFrame([(0.7,)] * 9 + [(0.1,)], "p double")
    assert scoring.choose_threshold(tied, "p", 0.1).first().ties_limit_calibration


def test_ranges_and_auc(spark):
    df = spark.createDataFrame([(5.0,)] * 99 + [(1e6,)], "x double")
    r = scoring.tukey_ranges(df, ["x"]).first()
    assert r.low == 5.0 and r.high > 5.0
    ties = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert scoring.roc_auc(ties, "y", "s").first()[0] == 0.875 and scoring.roc_auc(ties.where("y = 1"), "y", "s").first()[0] is None


def test_preparation_round_trip(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "a"), (3.0, None), (1.0, "c")], "x double, c string")
    p = preparation.Preparation(["x"], ["c"], "median", "standard").fit(df)
    assert p.fill == {"x": 2.0} and p.text_fill == {"c": "a"} and p.categories == {"c": ["a", "b", "c"]}
    v = p.transform(spark.createDataFrame([(2.0, "zz")], "x double, c string"), []).first()[0]
    assert v.toArray().tolist() == [0.0, 0.0, 0.0, 0.0]
    assert preparation.Preparation.from_json(p.to_json()).fingerprint() == p.fingerprint()
    assert preparation.Preparation(["x"], [], scaler="standard").fit(df.where("x = 3")).scale == {"x": 1.0}
    k = preparation.Preparation([], ["c"], top_k=2).fit(df)
    assert k.categories == {"c": ["a"]} and k.feature_names() == ["c_a", "c___INFREQUENT__"]
    assert [(r.value, r.n) for r in p.unknown(spark.createDataFrame([(1.0, "q"), (1.0, "q"), (1.0, None)], "x double, c string")).collect()] == [("q", 2)]
    with pytest.raises(ValueError):
        preparation.Preparation([], [], imputer="nope")
