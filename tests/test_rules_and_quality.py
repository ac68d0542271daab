import math
import random

import pytest
from pyspark.sql import functions as F

from tabwarden.functions.columns import not_below_zero, numeric
from tabwarden.functions.dates import parse_datetime
from tabwarden.operators import association, features, profile, quality
from tabwarden.operators.rules import Rule, RuleSet, clean_by_rules, evaluate_rules, predicate

from .fixtures import RULES, fleet


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([("1", 1.0), ("4D", float("nan")), (None, None), (" 2e1 ", -3.0), ("1f", 0.0), ("inf", 5.0)], "t string, x double")


OPS = [
    ("notna", "t", None, "110111"), ("isna", "t", None, "001000"), ("positive", "x", None, "100001"), ("non_negative", "x", None, "100011"), ("positive", "t", None, "100100"),
    ("eq", "t", 20, "000100"), ("eq", "t", "4D", "010000"), ("ne", "t", 20, "111011"), ("ge", "x", 1, "100001"), ("gt", "x", 1, "000001"), ("le", "x", 0, "000110"), ("lt", "x", 0, "000100"),
    ("in", "t", ["1", "1f"], "100010"), ("in", "x", ["1"], "000000"), ("not_in", "t", ["1"], "011111"), ("between", "x", [0, 1], "100010"), ("not_between", "x", [0, 1], "011101"),
]


@pytest.mark.parametrize("op,column,value,want", OPS)
def test_operators_and_missing_values(odd, op, column, value, want):
    got = odd.select(predicate(odd, column, op, value).alias("p")).collect()
    assert "".join(str(int(r.p)) for r in got) == want


def test_unknown_operator_and_column(odd):
    with pytest.raises(ValueError):
        predicate(odd, "x", "like")
    with pytest.raises(KeyError):
        predicate(odd, "nope", "notna")


def test_numbers_and_clipping(odd):
    assert [r.n for r in odd.select(numeric(odd, "t").alias("n")).collect()] == [1.0, None, None, 20.0, None, None]
    assert [r.n for r in odd.select(not_below_zero(numeric(odd, "x")).alias("n")).collect()] == [1.0, None, None, 0.0, 0.0, 5.0]


def test_rules_on_a_fleet(spark):
    df, rules = fleet(spark), RuleSet.from_config(RULES)
    got = {r.rule: (r.violations, r.rows, r.ratio) for r in evaluate_rules(df, rules.rules).collect()}
    assert got == {"year_in_range": (1, 8, 0.125), "taxi_seats": (2, 8, 0.25), "premium_positive": (1, 8, 0.125), "known_sex": (1, 8, 0.125)}
    assert [r.name for r in rules.warn_rules] == ["known_sex"] and len(rules.error_rules) == 3
    out, report = clean_by_rules(df, rules.rules, 0.3)
    assert out.count() == 4 and report.dropped == {"year_in_range": 1, "taxi_seats": 2, "premium_positive": 1} and not report.skipped
    out, report = clean_by_rules(df, rules.rules, 0.2)  # two of the seven that the first rule leaves
    assert out.count() == 6 and report.dropped == {"year_in_range": 1, "premium_positive": 1} and report.skipped == {"taxi_seats": 2 / 7}
    c = quality.completeness(df, ["PROD_YEAR", "SEATS_NUM", "SEX", "PREMIUM"]).first()
    assert (c.max_column, c.max_column_ratio, c.n_columns, c.max_row_ratio, c.total_missing_ratio) == ("SEATS_NUM", 3 / 8, 4, 0.5, 5 / 32)
    v = {r.rule: (r.checked, r.violations) for r in quality.validity(df, rules.rules).collect()}
    assert v == {"year_in_range": (7, 1), "taxi_seats": (4, 2), "premium_positive": (8, 1), "known_sex": (7, 1)}
    assert rules.missing(["PREMIUM", "USAGE"]) == ["year_in_range", "taxi_seats", "known_sex"]
    assert [r.describe() for r in rules.rules[1:]] == ["SEATS_NUM > 3 when USAGE == Taxi", "PREMIUM > 0", "SEX in (0, 1, 2)"]


def test_cleaning_reconciles_and_is_sequential(spark):
    df = spark.createDataFrame([(None, None, 1.0), (1.0, -1.0, 1.0), (1.0, -1.0, 1.0), (1.0, 2.0, -5.0), (3.0, 2.0, 1.0), (4.0, None, 2.0)], "a double, b double, c double")
    rules = RuleSet([Rule("b", "b", "ge", 0), Rule("c", "c", "ge", 0), Rule("z", "zz", "ge", 0)])
    out, r = quality.clean(df, ["a", "b"], rules, 0.5, 0.3)
    assert (r.rows_in, r.sparse_rows, r.duplicates, r.dropped_by_rule, r.rows_out) == (6, 1, 1, {"b": 1}, 3)
    assert r.rows_in - r.sparse_rows - r.duplicates - sum(r.dropped_by_rule.values()) == r.rows_out == out.count()
    assert r.missing_columns == ["z"] and r.skipped_by_rule == {"c": 1 / 3}


def test_dynamic_rules_hide_small_antecedents(spark):
    df = spark.createDataFrame([("A", "x")] * 30 + [("A", "y")] * 10 + [("B", "y")] * 5 + [(None, "y")] * 31, "m string, t string")
    pair = lambda m: {"label": str(m), "antecedents": [{"column": "m", "value": m}], "consequents": [{"column": "t", "value": "x"}]}
    got = {r.rule: r for r in quality.dynamic_rules(df, [pair("A"), pair("B"), pair("C"), pair(quality.MISSING), {"label": "gone", "antecedents": [{"column": "no", "value": "1"}], "consequents": []}]).collect()}
    assert got["A"].violation_ratio == 0.25 and got["B"].violation_ratio is None and got["B"].raw_violation_ratio == 1.0
    assert got["C"].antecedent_rows == 0 and got["C"].raw_violation_ratio is None and got[quality.MISSING].antecedent_rows == 31 and got["gone"].antecedent_rows == 0


def test_date_format_is_chosen_for_the_whole_column(spark):
    df = spark.createDataFrame([("08-AUG-15",), ("2015-08-09",), ("09-Aug-15",), ("junk",), (None,), ("10-sep-15",)], "d string")
    assert [str(r.t)[:10] for r in df.select(parse_datetime(df, "d", "%d-%b-%y").alias("t")).collect()] == ["2015-08-08", "None", "2015-08-09", "None", "None", "2015-09-10"]
    iso = spark.createDataFrame([("2015-08-09",), ("2015-08-09T10:00:00",), ("x",)], "d string")
    assert iso.select(F.count(parse_datetime(iso, "d", "%d-%b-%y"))).first()[0] == 2
    mixed = spark.createDataFrame([("01/02/2015",), ("20150203",), ("x",), ("y",), ("z",)], "d string")
    assert mixed.select(F.count(parse_datetime(mixed, "d", "%d-%b-%y"))).first()[0] == 2
    t = quality.timeliness(df, "d", "%d-%b-%y").first()
    assert (t.span_days, t.max_gap_days, t.unparsed) == (33, 32, 3)
    assert not quality.timeliness(df, "nope").first().available


def test_profiles(spark):
    n = {r.column: r for r in profile.profile_numeric(fleet(spark), ["SEATS_NUM", "PREMIUM"]).collect()}
    assert (n["SEATS_NUM"].missing, n["SEATS_NUM"].zeros, n["SEATS_NUM"].zeros_ratio, n["SEATS_NUM"].median) == (3, 1, 1 / 8, 3.0)
    assert (n["PREMIUM"].missing, n["PREMIUM"].n_unique, n["PREMIUM"].max) == (0, 8, 310.0)
    skewed = spark.createDataFrame([(float(x),) for x in [1, 1, 2, 50]], "v double")
    m, k = 13.5, 4
    want = math.sqrt(k * (k - 1)) / (k - 2) * (sum((x - m) ** 3 for x in [1, 1, 2, 50]) / k) / (sum((x - m) ** 2 for x in [1, 1, 2, 50]) / k) ** 1.5
    assert abs(profile.profile_numeric(skewed, ["v"]).first().skew - want) < 1e-12
    conflicts = profile.case_conflicts(spark.createDataFrame([("Own",), ("own",), ("x",), (None,)], "u string"), ["u"]).collect()
    assert [(c.folded, c.spellings) for c in conflicts] == [("own", "Own|own")]


def test_association(spark, tmp_path):
    import random

    r = random.Random(7)
    rows = []
    for _ in range(2000):
        make = r.choices(["ISUZU", "BAJAJ", "TOYOTA"], [0.45, 0.3, 0.25])[0]
        kind = {"ISUZU": ["Truck"] * 85 + ["Bus"] * 15, "BAJAJ": ["Motor-cycle"] * 90 + ["Bus"] * 10, "TOYOTA": ["Bus"] * 50 + ["Motor-cycle"] * 30 + ["Truck"] * 20}[make]
        rows.append((make, r.choice(kind), "1202" if r.random() < 0.7 else "1201"))
    df = spark.createDataFrame(rows, "MAKE string, TYPE string, INSR string")
    found = association.mine_rules(df, ["MAKE", "TYPE", "INSR"], n_rules=50).collect()
    lifts = [x.lift for x in found]
    assert lifts == sorted(lifts, reverse=True) and min(lifts) >= 1.2 and any(x.label == "MAKE=ISUZU → TYPE=Truck" for x in found)
    deep = association.mine_rules(df, ["MAKE", "TYPE", "INSR"], max_len=3, n_rules=500).collect()
    grown = association.mine_rules(df, ["MAKE", "TYPE", "INSR"], max_len=3, n_rules=500, algorithm="fpgrowth").collect()
    assert {x.label for x in deep} == {x.label for x in grown} and any(len(x.antecedents) == 2 for x in deep)
    usual = association.mine_rules(df, ["MAKE", "TYPE", "INSR"], min_lift=0.0, min_confidence=0.0, n_rules=500, exclude_majority_consequent=True).collect()
    assert usual and not any(c.value in ("1202", "ISUZU") for x in usual for c in x.consequents)
    none = association.mine_rules(df, ["MAKE"], min_support=0.99)
    assert association.save_rules(none, str(tmp_path / "r.json")) == [] and association.load_rules(str(tmp_path / "r.json")) == [] and association.load_rules(str(tmp_path / "no")) is None


def test_features_skip_and_never_overwrite(spark):
    df = spark.createDataFrame([("08-AUG-15", "2010", 10.0, 0.0), ("08-AUG-15", "4D", None, 5.0)], "INSR_BEGIN string, PROD_YEAR string, INSURED_VALUE double, PREMIUM double").withColumn("POLICY_MONTH", F.lit(99))
    out, new = features.engineer(df, fmt="%d-%b-%y")
    r = out.collect()
    assert r[0].POLICY_MONTH == 99 and "POLICY_MONTH" not in new and "IS_CAPACITY_MISSING" not in new
    assert r[0].VEHICLE_AGE == 5.0 and r[1].VEHICLE_AGE is None and r[0].VALUE_TO_PREMIUM is None and r[1].IS_INSURED_VALUE_ZERO == 0.0


def test_apriori_needs_no_broadcast(spark):
    r = random.Random(6)
    rows = [(r.choice("aab"), r.choice(["x", "y", None]), r.choice("pq"), r.choice("mno")) for _ in range(400)]
    df = spark.createDataFrame(rows, "A string, B string, C string, D string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        want = {str(x.items_): x.n for x in association.itemsets(df, list("ABCD"), 0.06, 4).withColumnRenamed("items", "items_").collect()}
        got = {str(x.items_): x.n for x in association.apriori_itemsets(df, list("ABCD"), 0.06, 4).withColumnRenamed("items", "items_").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want and any(len(k.split("column")) == 4 for k in got) and any(n < 0.1 * 400 for n in got.values())


def test_fpgrowth_reads_rows_of_equal_values_once(spark, monkeypatch):
    r = random.Random(9)
    rows = [(r.choice("aab"), r.choice(["x=1", "y", None]), r.choice("pq"), r.choice("mno")) for _ in range(700)]
    df = spark.createDataFrame(rows, "A string, B string, C string, D string")
    kept, write = [], association.written
    monkeypatch.setattr(association, "written", lambda df, name: kept.append(write(df, name)) or kept[-1])
    for least, longest in ((0.06, 4), (0.01, 3), (0.1, 2), (1.0, 2)):
        want = {str(x.items_): (x.n, x.rows, x.support) for x in association.itemsets(df, list("ABCD"), least, longest).withColumnRenamed("items", "items_").collect()}
        got = {str(x.items_): (x.n, x.rows, x.support) for x in association.fpgrowth_itemsets(df, list("ABCD"), least, longest).withColumnRenamed("items", "items_").collect()}
        assert got == want
    assert kept and all(k.count() <= 2 * 3 * 2 * 3 for k in kept)
    assert association.fpgrowth_itemsets(df.limit(0), list("ABCD"), 0.1, 2).count() == 0
