"""The catalogue: each query over the test tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.columns import NUMBER, batch_period, interpret_psi, json_text, period_name
from .functions.dates import parse_datetime
from .operators import association, drift, features, meta, preparation, profile, quality, ranks, rules, scoring
from .operators.rules import Condition, Rule, RuleSet
from .session import scratch
from .sources import batches, files
from .sources.policy import CATEGORICAL, FEATURES, NUMERIC, POLICY_SQL, policy
from .streaming.state import RunState

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query; its SQL may use the table policy."""
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            body = sql.strip()
            ORACLES[f.__name__] = f"WITH {POLICY_SQL}{',' if body[:5].upper() == 'WITH ' else ''} {body[5:] if body[:5].upper() == 'WITH ' else body}" if "policy" in body else body
        return f

    return add


RULES = RuleSet([
    Rule("premium_non_negative", "PREMIUM", "ge", 0),
    Rule("value_non_negative", "INSURED_VALUE", "ge", 0),
    Rule("seats_at_least_one", "SEATS_NUM", "ge", 1),
    Rule("cargo_capacity_required", "CARRYING_CAPACITY", "gt", 0, Condition("TYPE_VEHICLE", "in", ["ECONOMY", "LARGE"]), "violation"),
    Rule("effective_year_known", "EFFECTIVE_YR", "between", [1960, 2005]),
    Rule("make_present", "MAKE", "notna", severity="warn"),
])

_NUM = f"CASE WHEN regexp_matches(EFFECTIVE_YR, '{NUMBER}') THEN try_cast(EFFECTIVE_YR AS DOUBLE) END"
_BAD = {
    "premium_non_negative": "PREMIUM < 0", "value_non_negative": "INSURED_VALUE < 0", "seats_at_least_one": "SEATS_NUM < 1",
    "cargo_capacity_required": "TYPE_VEHICLE IN ('ECONOMY', 'LARGE') AND NOT coalesce(CARRYING_CAPACITY > 0, false)",
    "effective_year_known": f"EFFECTIVE_YR IS NOT NULL AND NOT coalesce({_NUM} BETWEEN 1960 AND 2005, false)", "make_present": "MAKE IS NULL",
}


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


_OPS = [
    ("notna", "CARRYING_CAPACITY", None, "CARRYING_CAPACITY IS NOT NULL"), ("isna", "CARRYING_CAPACITY", None, "CARRYING_CAPACITY IS NULL"), ("positive", "CARRYING_CAPACITY", None, "coalesce(CARRYING_CAPACITY > 0, false)"),
    ("non_negative", "EFFECTIVE_YR", None, f"coalesce({_NUM} >= 0, false)"), ("eq", "EFFECTIVE_YR", 1990, f"coalesce({_NUM} = 1990, false)"), ("ne", "CARRYING_CAPACITY", 0, "coalesce(CARRYING_CAPACITY <> 0, true)"),
    ("ge", "PREMIUM", 1000, "coalesce(PREMIUM >= 1000, false)"), ("gt", "SEATS_NUM", 4, "SEATS_NUM > 4"), ("le", "PREMIUM", 1000, "coalesce(PREMIUM <= 1000, false)"), ("lt", "SEATS_NUM", 4, "SEATS_NUM < 4"),
    ("in", "MAKE", ["Brand#1", "brand#11"], "MAKE IN ('Brand#1', 'brand#11')"), ("not_in", "MAKE", ["Brand#1"], "MAKE NOT IN ('Brand#1')"), ("between", "CARRYING_CAPACITY", [500, 2000], "coalesce(CARRYING_CAPACITY BETWEEN 500 AND 2000, false)"),
    ("not_between", "EFFECTIVE_YR", [1970, 1990], f"coalesce({_NUM} NOT BETWEEN 1970 AND 1990, true)"),
]


@query(_union(f"SELECT '{op}' AS op, count(*) FILTER ({sql}) AS holds, count(*) AS rows FROM policy" for op, _, _, sql in _OPS))
def rule_ops_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir)
    return rules.stacked(df, "op", {op: {"holds": F.count_if(rules.predicate(df, c, op, v)), "rows": F.count("*")} for op, c, v, _ in _OPS})


@query(_union(f"SELECT strftime(INSR_BEGIN, '%Y-%m') AS period, '{r}' AS rule, count(*) FILTER ({sql}) AS violations, count(*) AS rows, round(count(*) FILTER ({sql}) / count(*), 9) AS ratio FROM policy GROUP BY 1" for r, sql in _BAD.items()))
def rule_violations_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir).withColumn("period", period_name(F.col("INSR_BEGIN")))
    return rules.evaluate_rules(df, RULES.rules, ["period"]).withColumn("ratio", F.round("ratio", 9))


_ALL_COLUMNS = "ORDER_KEY, LINE, INSURED_VALUE, PREMIUM, SEATS_NUM, CARRYING_CAPACITY, EFFECTIVE_YR, TYPE_VEHICLE, MAKE"


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir).selectExpr(*_ALL_COLUMNS.split(", "))
    return df.unionByName(df.where("ORDER_KEY % 7 = 0"))


_CLEAN = ["premium_non_negative", "seats_at_least_one", "cargo_capacity_required"]
_clean_steps, _last = [], "d2"
for _i, _r in enumerate(_CLEAN):
    _clean_steps.append(f"m{_i} AS (SELECT count(*) AS n, count(*) FILTER ({_BAD[_r]}) AS b FROM {_last}), r{_i} AS (SELECT * FROM {_last} WHERE (SELECT b > 0.2 * n FROM m{_i}) OR NOT coalesce(({_BAD[_r]}), false))")
    _last = f"r{_i}"


@query(f"""WITH d0 AS (SELECT {_ALL_COLUMNS} FROM policy UNION ALL SELECT {_ALL_COLUMNS} FROM policy WHERE ORDER_KEY % 7 = 0),
d1 AS (SELECT * FROM d0 WHERE ((INSURED_VALUE IS NULL)::INT + (PREMIUM IS NULL)::INT + (CARRYING_CAPACITY IS NULL)::INT) / 3 <= 0.5), d2 AS (SELECT DISTINCT * FROM d1), {', '.join(_clean_steps)}
SELECT 'rows_in' AS step, count(*) AS rows FROM d0 UNION ALL SELECT 'sparse_rows', (SELECT count(*) FROM d0) - (SELECT count(*) FROM d1) UNION ALL SELECT 'duplicates', (SELECT count(*) FROM d1) - (SELECT count(*) FROM d2)
{''.join(f" UNION ALL SELECT 'rule:{r}', b FROM m{i} WHERE b <= 0.2 * n" for i, r in enumerate(_CLEAN))} UNION ALL SELECT 'rows_out', count(*) FROM {_last}""")
def clean_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    only = RuleSet([r for r in RULES.rules if r.name in _CLEAN])
    _, report = quality.clean(_dirty(spark, sf_dir), ["INSURED_VALUE", "PREMIUM", "CARRYING_CAPACITY"], only, 0.5, 0.2)
    return spark.createDataFrame(report.steps(), "step string, rows long")


@query(f"SELECT count(*) AS rows, sum(LINE)::BIGINT AS lines FROM (SELECT DISTINCT * FROM (SELECT {_ALL_COLUMNS} FROM policy UNION ALL SELECT {_ALL_COLUMNS} FROM policy WHERE ORDER_KEY % 7 = 0))")
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedupe(_dirty(spark, sf_dir)).agg(F.count("*").alias("rows"), F.sum("LINE").alias("lines"))


_NULLS = [f"sum(({c} IS NULL)::INT)" for c in FEATURES]
_ROW_NULLS = "(" + " + ".join(f"({c} IS NULL)::INT" for c in FEATURES) + ")"


@query(f"""WITH c AS (SELECT count(*) AS n, [{', '.join(_NULLS)}] AS each, max({_ROW_NULLS}) AS worst FROM policy)
SELECT round(list_sum(each) / (n * 10), 9) AS total_missing_ratio, round(list_max(each) / n, 9) AS max_column_ratio, [{', '.join(f"'{c}'" for c in FEATURES)}][list_position(each, list_max(each))] AS max_column,
round(worst / 10, 9) AS max_row_ratio, round(list_sum(each) / (n * 10), 9) AS mean_row_ratio, 10 AS n_columns FROM c""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = quality.completeness(policy(spark, sf_dir), FEATURES)
    return made.withColumns({c: F.round(c, 9) for c in made.columns if c.endswith("ratio")})


_PRESENT = {"premium_non_negative": "PREMIUM IS NOT NULL", "value_non_negative": "INSURED_VALUE IS NOT NULL", "seats_at_least_one": "SEATS_NUM IS NOT NULL", "cargo_capacity_required": "TYPE_VEHICLE IN ('ECONOMY', 'LARGE')", "effective_year_known": "EFFECTIVE_YR IS NOT NULL", "make_present": "true"}


@query(_union(f"SELECT '{r}' AS rule, count(*) FILTER ({_PRESENT[r]}) AS checked, count(*) FILTER ({sql}) AS violations, round(count(*) FILTER ({sql}) / nullif(count(*) FILTER ({_PRESENT[r]}), 0), 9) AS ratio FROM policy" for r, sql in _BAD.items()))
def validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validity(policy(spark, sf_dir), RULES.rules).withColumn("ratio", F.round("ratio", 9))


@query(f"""SELECT 'EFFECTIVE_YR' AS "column", count(EFFECTIVE_YR) AS checked, count(*) FILTER ({_NUM} IS NULL) AS non_numeric, round(count(*) FILTER ({_NUM} IS NULL) / count(EFFECTIVE_YR), 9) AS ratio,
(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT EFFECTIVE_YR AS v FROM policy WHERE {_NUM} IS NULL ORDER BY v LIMIT 5)) AS examples FROM policy""")
def type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.type_check(policy(spark, sf_dir), [*NUMERIC, "EFFECTIVE_YR"]).withColumn("ratio", F.round("ratio", 9))


@query("""WITH t AS (SELECT DISTINCT INSR_BEGIN AS t FROM policy), g AS (SELECT max(date_diff('hour', p, t) // 24) AS gap FROM (SELECT t, lag(t) OVER (ORDER BY t) AS p FROM t))
SELECT true AS available, strftime(min(t), '%Y-%m-%d') AS min_date, strftime(max(t), '%Y-%m-%d') AS max_date, date_diff('day', min(t), max(t)) AS span_days, count(*) AS n_unique, max(gap) AS max_gap_days, 0 AS unparsed FROM t, g""")
def timeliness_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.timeliness(policy(spark, sf_dir), "INSR_BEGIN")


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


_PROFILED = {"INSURED_VALUE": "INSURED_VALUE", "PREMIUM": "PREMIUM", "CARRYING_CAPACITY": "CARRYING_CAPACITY", "EFFECTIVE_YR": _NUM}


@query(_union(f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing, round(count(*) FILTER ({c} IS NULL) / count(*), 4) AS missing_ratio, count(*) FILTER ({c} IS NOT NULL AND ({x}) IS NULL) AS non_numeric, count(*) FILTER (({x}) = 0) AS zeros,
round(count(*) FILTER (({x}) = 0) / count(*), 4) AS zeros_ratio, count(DISTINCT ({x})) AS n_unique, round(min({x}), 4) AS min, round(max({x}), 4) AS max, round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std, round(skewness({x}), 4) AS skew,
{', '.join(f"round(quantile_cont({x}, {q}), 4) AS {n}" for n, q in profile.QUANTILES.items())}, skewness({x}) > 2 AS heavy_tailed FROM policy""" for c, x in _PROFILED.items()))
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(profile.profile_numeric(policy(spark, sf_dir), list(_PROFILED)), 4)


_KINDS = ["MAKE", "TYPE_VEHICLE", "USAGE"]


@query("WITH v AS (" + _union(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM policy WHERE {c} IS NOT NULL GROUP BY 2" for c in _KINDS) + """), t AS (SELECT count(*) AS rows FROM policy),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank, greatest(floor(rows * 0.01), 1) AS bound, rows FROM v, t)
SELECT "column", 0 AS missing, count(*) AS n_unique, count(*) FILTER (n <= bound) AS rare_values, coalesce(sum(n) FILTER (n <= bound), 0)::BIGINT AS rare_rows, string_agg(value || '=' || n, '|' ORDER BY rank) FILTER (rank <= 5) AS top, round(max(n) / max(rows), 6) AS top_share FROM r GROUP BY 1""")
def profile_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(profile.profile_categorical(policy(spark, sf_dir), _KINDS))


@query("SELECT sum(HAS_CLAIM)::BIGINT AS positive, count(*) - sum(HAS_CLAIM)::BIGINT AS negative, round(avg(HAS_CLAIM), 6) AS rate, round((count(*) - sum(HAS_CLAIM)) / sum(HAS_CLAIM), 6) AS imbalance FROM policy")
def profile_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_target(policy(spark, sf_dir), "HAS_CLAIM")


@query("""SELECT 'MAKE' AS "column", lower(MAKE) AS folded, string_agg(DISTINCT MAKE, '|' ORDER BY MAKE) AS spellings, count(DISTINCT MAKE) AS n FROM policy GROUP BY 2 HAVING count(DISTINCT MAKE) > 1""")
def case_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.case_conflicts(policy(spark, sf_dir), ["MAKE", "TYPE_VEHICLE"])


_MINED = ["SEX", "INSR_TYPE", "TYPE_VEHICLE", "USAGE"]
_VALUE = "coalesce({c}, '__MISSING__')"
_SINGLES = _union(f"SELECT '{c}={{}}' AS k, '{c}' AS c, {c} AS v, count(*) AS n FROM policy GROUP BY 3".replace("'" + c + "={}'", f"'{c}=' || {c}") for c in _MINED)
_PAIRS = _union(f"SELECT '{a}' AS c1, {a} AS v1, '{b}' AS c2, {b} AS v2, count(*) AS n FROM policy GROUP BY 2, 4" for i, a in enumerate(_MINED) for b in _MINED[i + 1 :])
_RULES_CTE = f"""WITH s AS ({_SINGLES}), p AS ({_PAIRS}), t AS (SELECT count(*) AS rows FROM policy), f AS (SELECT * FROM p, t WHERE n / rows >= 0.01),
d AS (SELECT c1 AS ac, v1 AS av, c2 AS cc, v2 AS cv, n, rows FROM f UNION ALL SELECT c2, v2, c1, v1, n, rows FROM f),
r AS (SELECT ac || '=' || av || ' → ' || cc || '=' || cv AS label, cc, cv, d.n / rows AS support, d.n / a.n AS confidence, d.n / a.n * rows / b.n AS lift FROM d JOIN s a ON a.c = ac AND a.v = av JOIN s b ON b.c = cc AND b.v = cv)"""


@query(_RULES_CTE.replace("r AS (SELECT", "unused AS (SELECT", 1) + " SELECT c1 || '=' || v1 || '|' || c2 || '=' || v2 AS items, n, round(n / rows, 9) AS support FROM f")
def assoc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = association.itemsets(policy(spark, sf_dir), _MINED, 0.01).where(F.size("items") == 2)
    return sets.select(F.array_join(F.transform("items", lambda x: F.concat(x["column"], F.lit("="), x["value"])), "|").alias("items"), "n", F.round("support", 9).alias("support"))


def _rules(spark: SparkSession, sf_dir: str, majority: bool = False, **how) -> DataFrame:
    return association.mine_rules(policy(spark, sf_dir), _MINED, 0.01, 0.1, 1.0, n_rules=5, exclude_majority_consequent=majority, **how)


def _shown(df: DataFrame) -> DataFrame:
    return df.select("label", *[F.round(c, 9).alias(c) for c in ("support", "confidence", "lift")])


_SHOWN = "label, round(support, 9) AS support, round(confidence, 9) AS confidence, round(lift, 9) AS lift"


@query(f"{_RULES_CTE} SELECT {_SHOWN} FROM r WHERE confidence >= 0.1 AND r.lift >= 1.0 ORDER BY r.lift DESC, r.confidence DESC, r.support DESC, label LIMIT 5")
def assoc_rules_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_rules(spark, sf_dir))


@query(f"{_RULES_CTE}, u AS (SELECT c AS uc, arg_min(v, (-n, v)) AS uv FROM s GROUP BY 1) SELECT {_SHOWN} FROM r ANTI JOIN u ON cc = uc AND cv = uv WHERE confidence >= 0.1 AND r.lift >= 1.0 ORDER BY r.lift DESC, r.confidence DESC, r.support DESC, label LIMIT 5")
def assoc_majority_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_rules(spark, sf_dir, majority=True))


@query(f"{_RULES_CTE} SELECT count(*) AS n_rules, round(max(lift), 9) AS max_lift, round(avg(lift), 9) AS mean_lift, round(avg(confidence), 9) AS mean_confidence, round(avg(support), 9) AS mean_support FROM (SELECT * FROM r WHERE confidence >= 0.1 AND lift >= 1.0 ORDER BY lift DESC, confidence DESC, support DESC, label LIMIT 5)")
def assoc_rule_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(association.rule_statistics(_rules(spark, sf_dir)), 9)


@query(f"{_RULES_CTE} SELECT {_SHOWN} FROM r WHERE confidence >= 0.1 AND r.lift >= 1.0 ORDER BY r.lift DESC, r.confidence DESC, r.support DESC, label LIMIT 5")
def assoc_apriori(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_rules(spark, sf_dir, algorithm="apriori"))


@query(f"{_RULES_CTE} SELECT {_SHOWN} FROM r WHERE confidence >= 0.1 AND r.lift >= 1.0 ORDER BY r.lift DESC, r.confidence DESC, r.support DESC, label LIMIT 5")
def assoc_fpgrowth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_rules(spark, sf_dir, algorithm="fpgrowth"))


#: Mined rules as a file would hold them.
MINED_RULES = [
    {"label": "TYPE_VEHICLE=PROMO → USAGE=O", "antecedents": [{"column": "TYPE_VEHICLE", "value": "PROMO"}], "consequents": [{"column": "USAGE", "value": "O"}]},
    {"label": "SEX=1 ∧ INSR_TYPE=1202 → USAGE=F", "antecedents": [{"column": "SEX", "value": "1"}, {"column": "INSR_TYPE", "value": "1202"}], "consequents": [{"column": "USAGE", "value": "F"}]},
    {"label": "MAKE=none → USAGE=F", "antecedents": [{"column": "MAKE", "value": "none"}], "consequents": [{"column": "USAGE", "value": "F"}]},
]
_DYNAMIC = [("TYPE_VEHICLE = 'PROMO'", "USAGE = 'O'"), ("SEX = '1' AND INSR_TYPE = '1202'", "USAGE = 'F'"), ("MAKE = 'none'", "USAGE = 'F'")]


@query(_union(f"SELECT '{r['label']}' AS rule, count(*) FILTER ({a}) AS antecedent_rows, count(*) FILTER ({a} AND NOT ({c})) AS violations, CASE WHEN count(*) FILTER ({a}) >= 30 THEN round(count(*) FILTER ({a} AND NOT ({c})) / count(*) FILTER ({a}), 9) END AS violation_ratio, round(count(*) FILTER ({a} AND NOT ({c})) / nullif(count(*) FILTER ({a}), 0), 9) AS raw_violation_ratio, round(count(*) FILTER ({a}) / count(*), 9) AS support FROM policy" for r, (a, c) in zip(MINED_RULES, _DYNAMIC)))
def dynamic_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(quality.dynamic_rules(policy(spark, sf_dir), MINED_RULES), 9)


# Drift: batches before 1998 are the reference, those from 2000 the batch.
_REF, _ACT = "INSR_BEGIN < TIMESTAMP '1998-01-01'", "INSR_BEGIN >= TIMESTAMP '2000-01-01'"
_DRIFT = ["INSURED_VALUE", "PREMIUM", "CARRYING_CAPACITY", "SEATS_NUM"]


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df = policy(spark, sf_dir).withColumns({"PREMIUM": F.expr(f"CASE WHEN {_ACT.replace('TIMESTAMP ', 'TIMESTAMP_NTZ ')} THEN PREMIUM * 1.4 ELSE PREMIUM END")})
    return df.where(_REF.replace("TIMESTAMP ", "TIMESTAMP_NTZ ")), df.where(_ACT.replace("TIMESTAMP ", "TIMESTAMP_NTZ "))


def _stack_sql(where: str) -> str:
    return _union(f"SELECT '{c}' AS \"column\", CAST({'PREMIUM * 1.4' if c == 'PREMIUM' and where == _ACT else c} AS DOUBLE) AS value FROM policy WHERE {where} AND {c} IS NOT NULL" for c in _DRIFT)


_PSI_CTE = f"""WITH e AS ({_stack_sql(_REF)}), a AS ({_stack_sql(_ACT)}),
q AS (SELECT "column" AS c, list_distinct(quantile_cont(value, [{', '.join(str(i / 10) for i in range(11))}])) AS edges FROM e GROUP BY 1),
q2 AS (SELECT c, list_sort(edges)[2:-2] AS inner_edges, len(edges) AS k FROM q),
b AS (SELECT "column", side, len(list_filter(inner_edges, lambda x: value >= x)) AS bin, k FROM (SELECT *, 0 AS side FROM e UNION ALL SELECT *, 1 FROM a) JOIN q2 ON c = "column"),
n AS (SELECT "column", bin, count(*) FILTER (side = 0) AS e, count(*) FILTER (side = 1) AS a, max(k) AS k FROM b GROUP BY 1, 2),
s AS (SELECT *, greatest(e / sum(e) OVER (PARTITION BY "column"), 1e-6) AS es, greatest(a / sum(a) OVER (PARTITION BY "column"), 1e-6) AS sa FROM n),
psi AS (SELECT "column", CASE WHEN max(k) >= 3 THEN sum((sa - es) * ln(sa / es)) ELSE 'nan'::DOUBLE END AS psi FROM s GROUP BY 1),
u AS (SELECT "column", value, sum(e) AS e, sum(a) AS a FROM (SELECT *, 1 AS e, 0 AS a FROM e UNION ALL SELECT *, 0, 1 FROM a) GROUP BY 1, 2),
w AS (SELECT "column", abs(sum(e) OVER (PARTITION BY "column" ORDER BY value) / sum(e) OVER (PARTITION BY "column") - sum(a) OVER (PARTITION BY "column" ORDER BY value) / sum(a) OVER (PARTITION BY "column")) AS d FROM u),
ks AS (SELECT "column", max(d) AS ks FROM w GROUP BY 1)"""
_LEVEL = "CASE WHEN isnan(psi) THEN 'unknown' WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'significant' END"


@query(f"""{_PSI_CTE} SELECT "column", round(psi, 6) AS psi, {_LEVEL} AS level FROM psi""")
def psi_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, act = (drift.stacked_values(x, _DRIFT) for x in _sides(spark, sf_dir))
    return drift.psi_numeric(ref, act).select("column", F.round("psi", 6).alias("psi"), interpret_psi(F.col("psi")).alias("level"))


@query(f"""{_PSI_CTE} SELECT "column", round(ks, 9) AS ks FROM ks""")
def ks_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, act = (drift.stacked_values(x, _DRIFT) for x in _sides(spark, sf_dir))
    return _round(drift.ks_statistic(ref, act), 9)


@query(f"""{_PSI_CTE}, m AS (SELECT "column", round(quantile_cont(value, 0.5), 4) AS reference_median FROM e GROUP BY 1), m2 AS (SELECT "column", round(quantile_cont(value, 0.5), 4) AS actual_median FROM a GROUP BY 1),
lr AS (SELECT avg(HAS_CLAIM) AS e FROM policy WHERE {_REF}), la AS (SELECT avg(HAS_CLAIM) AS a FROM policy WHERE {_ACT}), lab AS (SELECT (a - e) * ln(a / e) + ((1 - a) - (1 - e)) * ln((1 - a) / (1 - e)) AS lp FROM lr, la),
x AS (SELECT greatest(max(psi) FILTER (NOT isnan(psi)), any_value(lp)) AS p, max(ks) AS k FROM psi JOIN ks USING ("column"), lab)
SELECT "column", round(psi, 6) AS psi, round(ks, 6) AS ks, {_LEVEL} AS level, reference_median, actual_median, CASE WHEN p >= 0.25 THEN 'alert' WHEN p >= 0.10 OR k >= 0.20 THEN 'warn' ELSE 'ok' END AS status,
(SELECT round(lp, 6) FROM lab) AS target_psi FROM psi JOIN ks USING ("column") JOIN m USING ("column") JOIN m2 USING ("column"), x""")
def drift_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monitor's check of a batch against a reference that holds all earlier values."""
    first, batch = _sides(spark, sf_dir)
    rate = first.agg(F.avg("HAS_CLAIM")).first()[0]
    ref = drift.Reference(drift.stacked_values(first, _DRIFT), drift.category_shares(first, ["USAGE"]), rate)
    report = drift.check(ref, batch, "HAS_CLAIM")
    rows = [(*[r[c] for c in ("column", "psi", "ks", "level", "reference_median", "actual_median")], report.status, report.target["psi"]) for r in report.numeric]
    return _round(spark.createDataFrame(rows, "column string, psi double, ks double, level string, reference_median double, actual_median double, status string, target_psi double"))


_RATE = "(SELECT avg(HAS_CLAIM) FROM policy WHERE {})"


@query(f"""WITH r AS (SELECT {_RATE.format(_REF)} AS e, {_RATE.format(_ACT)} * 0.5 AS a)
SELECT round(e, 9) AS reference_rate, round(a, 9) AS actual_rate, round((a - e) * ln(a / e) + ((1 - a) - (1 - e)) * ln((1 - a) / (1 - e)), 9) AS psi FROM r""")
def psi_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, act = _sides(spark, sf_dir)
    both = ref.agg(F.avg("HAS_CLAIM").alias("reference_rate")).join(F.broadcast(act.agg((F.avg("HAS_CLAIM") * 0.5).alias("actual_rate"))))
    return _round(both.withColumn("psi", drift.binary_psi(F.col("reference_rate"), F.col("actual_rate"))), 9)


_SHIFTED = ("MAKE", "TYPE_VEHICLE")
_ACT_MAKE = "CASE WHEN LINE % 3 = 0 THEN concat('new', SEATS_NUM) ELSE MAKE END"


def _shares_sql(where: str, make: str) -> str:
    each = _union(f"SELECT '{c}' AS \"column\", CAST({make if c == 'MAKE' else c} AS VARCHAR) AS value FROM policy WHERE {where}" for c in _SHIFTED)
    return f'SELECT "column", value, count(*) / sum(count(*)) OVER (PARTITION BY "column") AS share FROM ({each}) WHERE value IS NOT NULL GROUP BY 1, 2'


def _shares(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ref, act = _sides(spark, sf_dir)
    return drift.category_shares(ref, list(_SHIFTED)), drift.category_shares(act.withColumn("MAKE", F.expr(_ACT_MAKE)), list(_SHIFTED))


_SHARE_CTE = f"WITH r AS ({_shares_sql(_REF, 'MAKE')}), c AS ({_shares_sql(_ACT, _ACT_MAKE)})"


@query(f"""{_SHARE_CTE}, j AS (SELECT "column", value, coalesce(r.share, 0) AS e, coalesce(c.share, 0) AS a FROM r FULL JOIN c USING ("column", value)),
g AS (SELECT "column", CASE WHEN e < 0.01 AND a < 0.01 THEN NULL ELSE value END AS grp, sum(e) AS e, sum(a) AS a FROM (SELECT * FROM j UNION ALL SELECT DISTINCT "column", NULL, 0.0, 0.0 FROM j) GROUP BY 1, 2),
k AS (SELECT "column", greatest(e, 1e-4) AS e, greatest(a, 1e-4) AS a FROM g), o AS (SELECT "column", e / sum(e) OVER (PARTITION BY "column") AS e, a / sum(a) OVER (PARTITION BY "column") AS a FROM k)
SELECT "column", round(sum((a - e) * ln(a / e)), 6) AS psi FROM o GROUP BY 1""")
def psi_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(drift.psi_categorical(*_shares(spark, sf_dir)))


@query(f"""{_SHARE_CTE}, x AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) AS n FROM c ANTI JOIN r USING ("column", value))
SELECT "column", count(*) AS n_new, round(sum(share), 9) AS share, string_agg(value, '|' ORDER BY value) FILTER (n <= 8) AS examples FROM x GROUP BY 1""")
def new_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(drift.new_categories(*_shares(spark, sf_dir)), 9)


_ORDER = ["ORDER_KEY", "LINE", "PREMIUM"]
_LIMIT, _WINDOW = drift.LIMIT, 12
_MIDDLE = "INSR_BEGIN >= TIMESTAMP '1998-01-01' AND INSR_BEGIN < TIMESTAMP '2000-01-01'"


def _thin_sql(where: str, extend: bool) -> str:
    """Every k-th value of all numeric columns in the stated order."""
    each = _union(f"SELECT '{c}' AS \"column\", ORDER_KEY, LINE, PREMIUM, CAST({c} AS DOUBLE) AS value FROM policy WHERE {where} AND {c} IS NOT NULL" for c in _DRIFT)
    k = f"greatest(n // {_LIMIT}, 1)" if extend else f"n // {_LIMIT} + 1"
    places = f'SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY ORDER_KEY, LINE, PREMIUM NULLS FIRST, value) - 1 AS seq, count(*) OVER (PARTITION BY "column") AS n FROM ({each})'
    return f'SELECT "column", seq, value FROM ({places}) WHERE seq % CASE WHEN n > {_LIMIT} THEN {k} ELSE 1 END = 0'


_KEPT = 'SELECT "column", count(*) AS n, min(seq) AS first, max(seq) AS last, round(sum(value), 2) AS total'


def _kept(values: DataFrame) -> DataFrame:
    return values.groupBy("column").agg(F.count("*").alias("n"), F.min("seq").alias("first"), F.max("seq").alias("last"), F.round(F.sum("value"), 2).alias("total"))


def _first_reference(spark: SparkSession, sf_dir: str) -> drift.Reference:
    first = policy(spark, sf_dir).where(_REF.replace("TIMESTAMP ", "TIMESTAMP_NTZ "))
    return drift.set_reference(first, _DRIFT, list(_SHIFTED), None, _ORDER)


def _extended(spark: SparkSession, sf_dir: str, window: int = _WINDOW) -> drift.Reference:
    batch = policy(spark, sf_dir).where(_MIDDLE.replace("TIMESTAMP ", "TIMESTAMP_NTZ ")).withColumn("MAKE", F.expr(_ACT_MAKE))
    return drift.extend_reference(_first_reference(spark, sf_dir), batch, _ORDER, window)


@query(f'{_KEPT} FROM ({_thin_sql(_REF, False)}) GROUP BY 1')
def drift_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thinned reference: every k-th value in a stated order."""
    return _kept(_first_reference(spark, sf_dir).numeric)


def _extended_sql(window: int) -> str:
    return f"""WITH r AS ({_thin_sql(_REF, False)}), x AS ({_thin_sql(_MIDDLE, True)}), b AS (
  SELECT * FROM r UNION ALL SELECT x."column", x.seq + l.base, x.value FROM x JOIN (SELECT "column", max(seq) + 1 AS base FROM r GROUP BY 1) l USING ("column")
), k AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY seq DESC) AS i FROM b) {_KEPT} FROM k WHERE i <= {_LIMIT * window} GROUP BY 1"""


@query(_extended_sql(_WINDOW))
def drift_reference_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling reference after one more batch: the newest values within the window."""
    return _kept(_extended(spark, sf_dir).numeric)


@query(_extended_sql(1))
def drift_reference_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a window of one batch, so that the oldest values go."""
    return _kept(_extended(spark, sf_dir, 1).numeric)


@query(f"""WITH r AS ({_shares_sql(_REF, 'MAKE')}), c AS ({_shares_sql(_MIDDLE, _ACT_MAKE)})
SELECT "column", value, round(CASE WHEN r.share IS NULL THEN c.share WHEN c.share IS NULL THEN r.share ELSE (r.share + c.share) / 2 END, 9) AS share FROM r FULL JOIN c USING ("column", value)""")
def drift_reference_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categorical side of the extended reference: the mean over the sides that have a value."""
    return _round(_extended(spark, sf_dir).categorical, 9)


_DERIVED = {
    "VEHICLE_AGE": "greatest(year(INSR_BEGIN) - PROD_YEAR, 0)", "POLICY_MONTH": "month(INSR_BEGIN)", "POLICY_QUARTER": "quarter(INSR_BEGIN)", "POLICY_YEAR": "year(INSR_BEGIN)", "POLICY_DAY_OF_YEAR": "dayofyear(INSR_BEGIN)",
    "POLICY_DURATION_DAYS": "greatest(date_diff('day', INSR_BEGIN, INSR_END), 0)", "VALUE_TO_PREMIUM": "INSURED_VALUE / nullif(PREMIUM, 0)", "IS_INSURED_VALUE_ZERO": "coalesce(INSURED_VALUE = 0, false)::INT", "IS_CAPACITY_MISSING": "(CARRYING_CAPACITY IS NULL)::INT",
    "LOG1P_INSURED_VALUE": "ln(1 + INSURED_VALUE)", "LOG1P_PREMIUM": "ln(1 + PREMIUM)", "LOG1P_CARRYING_CAPACITY": "ln(1 + CARRYING_CAPACITY)",
}


@query(_union(f"SELECT '{c}' AS feature, count({x}) AS present, round(avg(CAST({x} AS DOUBLE)), 3) AS mean, round(max(CAST({x} AS DOUBLE)), 2) AS largest FROM policy" for c, x in _DERIVED.items()))
def features_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir)
    made, new = features.engineer(df)
    return rules.stacked(made, "feature", {c: {"present": F.count(c), "mean": F.round(F.avg(F.col(c).cast("double")), 3), "largest": F.round(F.max(F.col(c).cast("double")), 2)} for c in new})


@query("SELECT strftime(INSR_BEGIN, '%Y-%m') AS month, year(INSR_BEGIN) || 'Q' || quarter(INSR_BEGIN) AS quarter, CAST(year(INSR_BEGIN) AS VARCHAR) AS year, count(*) AS rows FROM policy WHERE INSR_BEGIN IS NOT NULL GROUP BY 1, 2, 3")
def period_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir).select("INSR_BEGIN")
    for size in ("month", "quarter", "year"):
        df = batches.split_by_period(df, "INSR_BEGIN", None, size).withColumnRenamed("period", size)
    return df.groupBy("month", "quarter", "year").agg(F.count("*").alias("rows"))


@query("SELECT batch_idx, count(*) AS rows FROM (SELECT year(o_orderdate) - (SELECT min(year(o_orderdate)) FROM orders) AS batch_idx FROM orders) WHERE batch_idx > (SELECT max(year(o_orderdate)) - min(year(o_orderdate)) - 3 FROM orders) GROUP BY 1")
def latest_n_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last three parts of a training store of yearly batches; a repeated batch adds nothing."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.year("o_orderdate").alias("year"))
    store, years = batches.TrainingStore(spark, scratch(spark, "store")), sorted(r[0] for r in orders.distinct().collect())
    for year in [*years, years[-1]]:
        store.append(year - years[0], orders.where(F.col("year") == year))
    return store.load(3).groupBy(F.col("batch_idx").cast("long").alias("batch_idx")).agg(F.count("*").alias("rows"))


def _order_table(spark: SparkSession, sf_dir: str) -> str:
    """Orders as a table partitioned by month."""
    table = scratch(spark, "batches")
    batches.write_periods(batches.split_by_period(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate"), "o_orderdate", None), table)
    return table


@query("SELECT count(DISTINCT p) AS batches, min(p) AS first, max(p) AS last, sum(n)::BIGINT AS rows FROM (SELECT strftime(o_orderdate, '%Y-%m') AS p, count(*) AS n FROM orders GROUP BY 1)")
def collector_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = batches.Collector(spark, _order_table(spark, sf_dir), ["o_orderkey"], "o_orderdate").describe()
    return spark.createDataFrame([(made["batches"], made["first"], made["last"], made["rows"])], "batches long, first string, last string, rows long")


@query("SELECT p AS period, 'period=' || p AS folder FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS p FROM orders)")
def collector_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periods that a collector finds, and their folders."""
    found = batches.Collector(spark, _order_table(spark, sf_dir), [], "o_orderdate").batch_paths()
    return spark.createDataFrame([(p, path.rpartition("/")[2]) for p, path in found.items()], "period string, folder string")


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS rows FROM orders WHERE strftime(o_orderdate, '%Y-%m') NOT IN (SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem WHERE l_orderkey % 3 = 0 AND year(l_shipdate) > 1997) GROUP BY 1""")
def unprocessed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered periods that the run's state has not processed, each read from its own partition."""
    table, state = _order_table(spark, sf_dir), RunState(None)
    state.init_batches(batches.periods(spark, table), "orders")
    done = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_orderkey % 3 = 0 AND year(l_shipdate) > 1997").select(period_name(F.col("l_shipdate"))).distinct().collect()
    for (name,) in done:  # a row a period
        if name in state.batches:
            state.mark_processed(name)
    rest = spark.read.parquet(table).withColumn("period", F.col("period").cast("string")).where(F.col("period").isin(state.remaining))
    return rest.groupBy("period").agg(F.count("*").alias("rows"))


@query("""WITH p AS (SELECT strftime(o_orderdate, '%Y-%m') AS period FROM orders) SELECT source, period, count(*) AS rows FROM p, (VALUES ('again'), ('orders')) AS s(source) GROUP BY 1, 2""")
def merged_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources, and a broken one that is left out, as one table partitioned by period."""
    found = batches.sources_from_config({"sources": [{"name": n, "path": f"{sf_dir}/{file}.parquet", "prefix": f"{n}_"} for n, file in (("orders", "orders"), ("again", "orders"), ("broken", "none"))]})
    table = scratch(spark, "merged")
    batches.split_sources(spark, found, table, "o_orderdate", None, required=["o_orderkey"])
    return spark.read.parquet(table).groupBy("source", F.col("period").cast("string").alias("period")).agg(F.count("*").alias("rows"))


@query("SELECT 'orders_' AS prefix, max(strftime(o_orderdate, '%Y-%m')) AS period, 'orders_' || max(strftime(o_orderdate, '%Y-%m')) || '.csv' AS name FROM orders UNION ALL SELECT 'parts_', max(strftime(o_orderdate, '%Y')), 'parts_' || max(strftime(o_orderdate, '%Y')) || '.csv' FROM orders")
def latest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last file of each prefix by its name."""
    at = F.col("o_orderdate")
    names = F.array(F.concat(F.lit("orders_"), period_name(at), F.lit(".csv")), F.concat(F.lit("parts_"), period_name(at, "year"), F.lit(".csv")), F.lit("notes.txt"))
    return files.latest_by_name(spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.explode(names).alias("name")))


@query("""WITH t AS (SELECT strftime(o_orderdate, '%d-%b-%y') AS s, o_orderdate AS d FROM orders) SELECT count(*) AS rows, count(*) AS parsed, count(DISTINCT d) AS days, strftime(min(d), '%Y-%m-%d') AS first FROM t""")
def date_format_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as ``08-AUG-15``: the configured format is chosen for the whole column."""
    text = spark.read.parquet(f"{sf_dir}/orders.parquet").where("year(o_orderdate) < 2070").select(F.upper(F.date_format("o_orderdate", "dd-MMM-yy")).alias("s"), "o_orderdate")
    df = text.select(F.col("s"), F.when(F.year("o_orderdate") < 2000, 100).otherwise(0).alias("century"))
    at = parse_datetime(df, "s", "%d-%b-%y")
    shifted = F.add_months(at, -12 * F.col("century"))
    return df.agg(F.count("*").alias("rows"), F.count(at).alias("parsed"), F.count_distinct(shifted).alias("days"), F.date_format(F.min(shifted), "yyyy-MM-dd").alias("first"))


@query("""SELECT p_partkey, round(ln(p_retailprice), 9) AS log, round(sqrt(p_retailprice), 9) AS root, CASE WHEN p_size < 0 THEN 0 ELSE p_size END AS clipped, round(p_retailprice / nullif(p_size - 10, 0), 9) AS ratio, split_part(p_brand || '=x=y', '=', 1) AS head, lower(p_brand) AS folded,
(1960 + p_size) || '-0' || (1 + p_size % 9) AS name, substr(sha256(p_name), 1, 16) AS digest, p_size > 5 AS flag, list_sort(list_distinct([p_size, 5, 5]))[1] AS least, array_to_string([p_brand, p_type], ' ∧ ') AS label FROM part""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select(
        "p_partkey", F.round(F.log("p_retailprice"), 9).alias("log"), F.round(F.sqrt("p_retailprice"), 9).alias("root"), F.when(F.col("p_size") < 0, 0).otherwise(F.col("p_size")).alias("clipped"), F.round(F.col("p_retailprice") / F.nullif(F.col("p_size") - 10, F.lit(0)), 9).alias("ratio"),
        F.split(F.concat("p_brand", F.lit("=x=y")), "=", 2)[0].alias("head"), F.lower("p_brand").alias("folded"), batch_period(F.concat(F.lit("batch_"), (1960 + F.col("p_size")).cast("string"), F.lit("-0"), (1 + F.col("p_size") % 9).cast("string"), F.lit(".csv"))).alias("name"), F.substring(F.sha2("p_name", 256), 1, 16).alias("digest"), (F.col("p_size") > 5).alias("flag"),
        F.array_sort(F.array_distinct(F.array("p_size", F.lit(5), F.lit(5))))[0].alias("least"), F.array_join(F.array("p_brand", "p_type"), " ∧ ").alias("label"),
    )


@query("""SELECT l_returnflag AS flag, '{"share":' || CASE WHEN count(*) FILTER (l_tax > 1) = 0 THEN 'null' ELSE '1' END || ',"rows":' || count(*) || '}' AS json FROM lineitem GROUP BY 1""")
def json_without_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.when(F.count_if(F.col("l_tax") > 1) == 0, F.lit(float("nan"))).otherwise(F.lit(1.0))
    made = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(F.col("l_returnflag").alias("flag")).agg(share.alias("share"), F.count("*").alias("rows"))
    return made.select("flag", json_text(made, ["share", "rows"]).alias("json"))


# Runs: four made-up models score every month; their metrics are the runs that the meta queries read.
_MODELS = ["lr", "dt", "rf", "mlp"]


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir).select(F.trunc("INSR_BEGIN", "month").alias("m"), "HAS_CLAIM", "SCORE", "PREMIUM")
    each = F.array(*[F.struct(F.lit(n).alias("model"), (F.col("SCORE") < 0.1 * (k + 1)).cast("int").alias("p")) for k, n in enumerate(_MODELS)])
    made = scoring.confusion(df.select("m", "HAS_CLAIM", F.inline(each)), "HAS_CLAIM", "p", ["m", "model"])
    made = made.withColumn("batch_idx", F.dense_rank().over(Window.partitionBy("model").orderBy("m")) - 1)
    return made.select("batch_idx", "model", F.round("f1", 9).alias("f1"), "predicted_positive_rate", "actual_positive_rate", (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("rows_used"), F.when(F.col("batch_idx") < 40, "scratch").otherwise("partial_fit").alias("mode"))


_RUNS_CTE = "WITH s AS (" + _union(f"SELECT date_trunc('month', INSR_BEGIN) AS m, '{n}' AS model, HAS_CLAIM = 1 AS y, SCORE < {0.1 * (k + 1)!r} AS p FROM policy" for k, n in enumerate(_MODELS)) + """),
c AS (SELECT m, model, count(*) FILTER (y AND p) AS tp, count(*) FILTER (NOT y AND p) AS fp, count(*) FILTER (y AND NOT p) AS fn, count(*) AS n FROM s GROUP BY 1, 2),
runs AS (SELECT dense_rank() OVER (PARTITION BY model ORDER BY m) - 1 AS batch_idx, model, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1, (tp + fp) / n AS predicted, (tp + fn) / n AS actual, n AS rows_used FROM c),
runs2 AS (SELECT *, CASE WHEN batch_idx < 40 THEN 'scratch' ELSE 'partial_fit' END AS mode FROM runs)"""
_RANKS = """x AS (SELECT {by}, avg(rx) OVER (PARTITION BY {by}, a) AS rx, avg(ry) OVER (PARTITION BY {by}, b) AS ry FROM (SELECT {by}, a, b, row_number() OVER (PARTITION BY {by} ORDER BY a) AS rx, row_number() OVER (PARTITION BY {by} ORDER BY b) AS ry FROM v))"""


@query(f"{_RUNS_CTE}, v AS (SELECT model, actual AS a, f1 AS b FROM runs), {_RANKS.format(by='model')} SELECT model, count(*) AS n, round(corr(rx, ry), 4) AS rho FROM x GROUP BY 1")
def spearman_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.spearman(_runs(spark, sf_dir), "actual_positive_rate", "f1", ["model"])


@query(f"{_RUNS_CTE}, v AS (SELECT model, 'rows_used' AS condition, rows_used AS a, f1 AS b FROM runs UNION ALL SELECT model, 'positive_rate', actual, f1 FROM runs), {_RANKS.format(by='model, condition')} SELECT model, condition, count(*) AS n, round(corr(rx, ry), 4) AS rho FROM x GROUP BY 1, 2")
def condition_influence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.condition_influence(_runs(spark, sf_dir).withColumn("positive_rate", F.col("actual_positive_rate")), ["rows_used", "positive_rate"])


@query(f"""{_RUNS_CTE}, g AS (SELECT model, mode AS v, count(*) AS n, avg(f1) AS mean FROM runs2 GROUP BY 1, 2) SELECT model, count(*) AS n_values, arg_max(v, (mean, v)) AS best, arg_min(v, (mean, v)) AS worst, round(max(mean) - min(mean), 6) AS spread,
CASE WHEN count(*) < 2 THEN 'constant' WHEN min(n) < 3 THEN 'insufficient' ELSE 'varied' END AS verdict FROM g GROUP BY 1""")
def group_influence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.feature_influence(_runs(spark, sf_dir), "mode")


_TREND = """t AS (SELECT model, f1, row_number() OVER (PARTITION BY model ORDER BY batch_idx) AS i, count(*) OVER (PARTITION BY model) AS n FROM runs),
h AS (SELECT model, max(n) AS n, avg(f1) FILTER (i <= greatest(n // 4, 1)) AS head, avg(f1) FILTER (i > n - greatest(n // 4, 1)) AS tail FROM t GROUP BY 1),
trend AS (SELECT *, CASE WHEN n < 8 THEN 'not enough' WHEN abs(tail - head) / greatest(abs(head), 1e-9) < 0.10 THEN 'stable' WHEN tail > head THEN 'rising' ELSE 'falling' END AS trend FROM h)"""


@query(f"""{_RUNS_CTE}, l AS (SELECT model, f1, 'mode' AS setting, mode AS value FROM runs2 UNION ALL SELECT model, f1, 'half', CAST(batch_idx % 2 AS VARCHAR) FROM runs UNION ALL SELECT model, f1, 'same', 'x' FROM runs),
g AS (SELECT model, setting, value, count(*) AS n, avg(f1) AS mean FROM l GROUP BY 1, 2, 3), e AS (SELECT model, setting, count(*) AS k, min(n) AS least, max(mean) - min(mean) AS spread FROM g GROUP BY 1, 2),
z AS (SELECT setting, round(max(spread), 6) AS spread, max(k) AS n_values, bool_or(k > 1 AND least >= 3) AS varied FROM e GROUP BY 1)
SELECT row_number() OVER (ORDER BY spread DESC, setting) AS rank, setting, spread, n_values, CASE WHEN n_values < 2 THEN 'constant' WHEN varied THEN 'varied' ELSE 'insufficient' END AS verdict FROM z""")
def settings_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir).withColumns({"half": F.col("batch_idx") % 2, "same": F.lit("x")})
    return meta.rank_settings(runs, ["mode", "half", "same"])


@query(f"{_RUNS_CTE} SELECT batch_idx, model, f1, CAST(batch_idx % 3 AS VARCHAR) AS setting FROM runs")
def manifest_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests with a map of metrics and one of settings by model, taken apart into a row a model."""
    each = _runs(spark, sf_dir).select("batch_idx", "model", F.struct("f1").alias("m"), F.create_map(F.lit("setting"), (F.col("batch_idx") % 3).cast("string")).alias("s"))
    maps = [F.map_from_entries(F.collect_list(F.struct("model", c))).alias(name) for c, name in (("m", "metrics"), ("s", "hyperparameters"))]
    return meta.observations(each.groupBy("batch_idx").agg(*maps)).select("batch_idx", "model", "f1", F.col("settings")["setting"].alias("setting"))


@query(f"{_RUNS_CTE}, {_TREND} SELECT model, n, round(head, 9) AS head, round(tail, 9) AS tail, trend FROM trend")
def trend_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(meta.trends(_runs(spark, sf_dir), "f1", ["model"]), 9)


@query(f"""{_RUNS_CTE}, {_TREND} SELECT model, count(*) AS n, round(avg(f1), 6) AS mean, round(quantile_cont(f1, 0.5), 6) AS median, round(min(f1), 6) AS min, round(max(f1), 6) AS max, round(coalesce(stddev_samp(f1), 0), 6) AS std, round(arg_min(f1, batch_idx), 6) AS first, round(arg_max(f1, batch_idx), 6) AS last,
arg_min(batch_idx, (-f1, batch_idx)) AS best_batch, any_value(trend) AS trend FROM runs JOIN (SELECT model, trend FROM trend) USING (model) GROUP BY 1""")
def dynamics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(meta.dynamics(_runs(spark, sf_dir)))


@query(f"{_RUNS_CTE} SELECT batch_idx, arg_min(model, (-f1, list_position(['lr', 'dt', 'rf', 'mlp'], model))) AS model, max(f1) AS value FROM runs GROUP BY 1")
def winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.winners(_runs(spark, sf_dir), _MODELS)


@query(f"{_RUNS_CTE} SELECT model, count(*) AS n, round(avg(predicted), 6) AS predicted, round(avg(actual), 6) AS actual, round(round(avg(predicted), 6) / round(avg(actual), 6), 4) AS ratio FROM runs WHERE actual > 0 GROUP BY 1")
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.calibration(_runs(spark, sf_dir))


@query("""WITH w AS (SELECT p_type AS model, p_brand AS feature, sum(p_retailprice) AS weight FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY abs(weight) DESC, feature) AS n FROM w) SELECT feature, count(*) AS models FROM r WHERE n <= 15 GROUP BY 1""")
def consensus_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = spark.read.parquet(f"{sf_dir}/part.parquet").groupBy(F.col("p_type").alias("model"), F.col("p_brand").alias("feature")).agg(F.sum("p_retailprice").alias("weight"))
    return meta.consensus(weights)


@query(f"""WITH m AS ({_union(f"SELECT strftime(INSR_BEGIN, '%Y-%m') AS period, '{r}' AS rule, count(*) FILTER ({sql}) AS violations, count(*) AS rows FROM policy GROUP BY 1" for r, sql in _BAD.items())})
SELECT rule, sum(violations)::BIGINT AS violations, count(*) FILTER (violations > 0) AS batches, round(avg(violations / rows), 9) AS mean_ratio FROM m GROUP BY 1""")
def report_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(meta.roll_up(rule_violations_by_month(spark, sf_dir), "rule"), 9)


_PREDICTED = "SCORE < 0.25"


@query(f"""WITH c AS (SELECT count(*) FILTER (HAS_CLAIM = 1 AND {_PREDICTED}) AS tp, count(*) FILTER (HAS_CLAIM = 0 AND {_PREDICTED}) AS fp, count(*) FILTER (HAS_CLAIM = 1 AND NOT {_PREDICTED}) AS fn, count(*) FILTER (HAS_CLAIM = 0 AND NOT {_PREDICTED}) AS tn FROM policy)
SELECT *, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round((tp + fp) / (tp + fp + fn + tn), 9) AS predicted_positive_rate, round((tp + fn) / (tp + fp + fn + tn), 9) AS actual_positive_rate FROM c""")
def confusion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(scoring.confusion(policy(spark, sf_dir).withColumn("p", F.expr(f"CAST({_PREDICTED} AS INT)")), "HAS_CLAIM", "p"), 9)


@query("""WITH r AS (SELECT HAS_CLAIM, avg(rn) OVER (PARTITION BY SCORE) AS r FROM (SELECT HAS_CLAIM, SCORE, row_number() OVER (ORDER BY SCORE) AS rn FROM policy)), n AS (SELECT sum(HAS_CLAIM) AS p, count(*) AS n FROM policy)
SELECT round((sum(r) FILTER (HAS_CLAIM = 1) - any_value(p) * (any_value(p) + 1) / 2) / (any_value(p) * (any_value(n.n) - any_value(p))), 9) AS roc_auc FROM r, n""")
def auc_ranksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(scoring.roc_auc(policy(spark, sf_dir), "HAS_CLAIM", "SCORE"), 9)


@query("""WITH q AS (SELECT quantile_cont(CAST(SCORE AS DOUBLE), 0.95) AS c FROM policy) SELECT round(any_value(c), 6) AS threshold, 0.05 AS target_rate, round(avg((SCORE >= c)::INT), 6) AS achieved_rate, round(avg((SCORE >= 0.5)::INT), 6) AS raw_rate_at_half, round(quantile_cont(CAST(SCORE AS DOUBLE), 0.5), 6) AS median_probability, count(DISTINCT SCORE) AS n_distinct, avg((SCORE >= c)::INT) > 0.075 AS ties_limit_calibration FROM policy, q""")
def threshold_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir).withColumn("SCORE", F.col("SCORE").cast("double"))
    return scoring.choose_threshold(df, "SCORE", 0.05)


_RANGE_SQL = _union(f"""SELECT '{c}' AS "column", CASE WHEN iqr > 0 THEN greatest(q1 - 3 * iqr, lo) ELSE a END AS low, CASE WHEN iqr > 0 THEN least(q3 + 3 * iqr, hi) ELSE b END AS high FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3, quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) AS iqr, quantile_cont({x}, 0.005) AS a, quantile_cont({x}, 0.995) AS b, min({x}) AS lo, max({x}) AS hi FROM policy)""" for c, x in (("PREMIUM", "PREMIUM"), ("CARRYING_CAPACITY", "CARRYING_CAPACITY"), ("SEATS_NUM", "CAST(SEATS_NUM AS DOUBLE)")))


@query(f'SELECT "column", round(low, 4) AS low, round(high, 4) AS high FROM ({_RANGE_SQL})')
def tukey_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(scoring.tukey_ranges(policy(spark, sf_dir), ["PREMIUM", "CARRYING_CAPACITY", "SEATS_NUM"]), 4)


@query("SELECT sum((PREMIUM > 2500 OR PREMIUM < 10)::INT)::BIGINT + sum(coalesce((CARRYING_CAPACITY > 4500)::INT, 0))::BIGINT AS outliers, count(*) AS rows, round((sum((PREMIUM > 2500 OR PREMIUM < 10)::INT) + sum(coalesce((CARRYING_CAPACITY > 4500)::INT, 0))) / count(*), 9) AS ratio FROM policy")
def outlier_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(scoring.count_outliers(policy(spark, sf_dir), {"PREMIUM": (10.0, 2500.0), "CARRYING_CAPACITY": (0.0, 4500.0), "ABSENT": (0.0, 1.0)}), 9)


@query("WITH c AS (SELECT HAS_CLAIM AS label, count(*) AS n FROM policy GROUP BY 1) SELECT label, n, round(sum(n) OVER () / (2 * n), 9) AS weight, round(sqrt(sum(n) OVER () / (2 * n)), 9) AS root FROM c")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir)
    both = scoring.class_weights(df, "HAS_CLAIM").join(scoring.class_weights(df, "HAS_CLAIM", "sqrt").select("label", F.col("weight").alias("root")), "label")
    return _round(both, 9)


@query("WITH s AS (SELECT HAS_CLAIM AS label, row_number() OVER (PARTITION BY HAS_CLAIM ORDER BY (ORDER_KEY * 7919) % 10007, ORDER_KEY, LINE) AS i, count(*) OVER (PARTITION BY HAS_CLAIM) AS n FROM policy) SELECT label, i <= round(n * 0.2) AS is_validation, count(*) AS n FROM s GROUP BY 1, 2")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [(F.col("ORDER_KEY") * 7919) % 10007, F.col("ORDER_KEY"), F.col("LINE")]
    return scoring.stratified_split(policy(spark, sf_dir), "HAS_CLAIM", order).groupBy(F.col("HAS_CLAIM").alias("label"), "is_validation").agg(F.count("*").alias("n"))


def _prepared(spark: SparkSession, sf_dir: str, imputer: str, scaler: str) -> DataFrame:
    df = policy(spark, sf_dir)
    prep = preparation.Preparation(["PREMIUM", "CARRYING_CAPACITY"], [], imputer, scaler).fit(df)
    return _round(rules.stacked(df, "column", {c: {"n": F.count(x), "mean": F.avg(x), "low": F.min(x), "high": F.max(x)} for c, x in prep.columns(df).items()}), 5)


def _prepared_sql(fill: str, centre: str, scale: str) -> str:
    return _union(f"""SELECT '{c}' AS "column", count(*) AS n, round(avg((x - m) / s), 5) + 0.0 AS mean, round(min((x - m) / s), 5) AS low, round(max((x - m) / s), 5) AS high FROM (SELECT coalesce({c}, (SELECT {fill.format(c)} FROM policy)) AS x FROM policy), (SELECT {centre} AS m, {scale} AS s FROM (SELECT coalesce({c}, (SELECT {fill.format(c)} FROM policy)) AS x FROM policy))""" for c in ("PREMIUM", "CARRYING_CAPACITY"))


def _plus_zero(df: DataFrame) -> DataFrame:
    return df.withColumn("mean", F.col("mean") + 0.0)


@query(_prepared_sql("quantile_cont({}, 0.5)", "avg(x)", "stddev_pop(x)"))
def scale_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plus_zero(_prepared(spark, sf_dir, "median", "standard"))


@query(_prepared_sql("avg({})", "quantile_cont(x, 0.5)", "quantile_cont(x, 0.75) - quantile_cont(x, 0.25)"))
def scale_robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plus_zero(_prepared(spark, sf_dir, "mean", "robust"))


@query(_prepared_sql("quantile_cont({}, 0.5)", "max(0.0)", "max(1.0)"))
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plus_zero(_prepared(spark, sf_dir, "median", "none"))


@query(_prepared_sql("0.0 * count({})", "max(0.0)", "max(1.0)"))
def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plus_zero(_prepared(spark, sf_dir, "constant", "none"))


@query("""WITH c AS (SELECT MAKE AS v, count(*) AS n FROM policy GROUP BY 1), k AS (SELECT v, n FROM c WHERE n >= 8 ORDER BY n DESC, v LIMIT 7)
SELECT 'MAKE_' || v AS feature, n AS ones FROM k UNION ALL SELECT 'MAKE___INFREQUENT__', sum(n)::BIGINT FROM c WHERE v NOT IN (SELECT v FROM k)""")
def one_hot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir)
    prep = preparation.Preparation([], ["MAKE"], top_k=8).fit(df)
    return rules.stacked(df, "feature", {n: {"ones": F.sum(x).cast("long")} for n, x in prep.columns(df).items()})


_GAPPY = "CASE WHEN LINE % 4 = 0 THEN NULL ELSE USAGE END"


@query(f"""WITH g AS (SELECT {_GAPPY} AS u FROM policy), m AS (SELECT u FROM (SELECT u, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY 1) ORDER BY n DESC, u LIMIT 1),
f AS (SELECT 'most_frequent' AS imputer, coalesce(u, (SELECT u FROM m)) AS v FROM g UNION ALL SELECT 'constant', coalesce(u, 'missing') FROM g) SELECT imputer, 'U_' || v AS feature, count(*) AS ones FROM f GROUP BY 1, 2""")
def one_hot_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain one-hot columns of a column with missing values, by both imputers."""
    df, made = policy(spark, sf_dir).select(F.expr(_GAPPY).alias("U")), None
    for how in ("most_frequent", "constant"):
        prep = preparation.Preparation([], ["U"], categorical_imputer=how).fit(df)
        one = rules.stacked(df, "feature", {n: {"ones": F.sum(x).cast("long")} for n, x in prep.columns(df).items()}).withColumn("imputer", F.lit(how))
        made = one if made is None else made.unionByName(one)
    return made


@query("WITH m AS (SELECT S AS v FROM (SELECT CASE WHEN LINE % 5 = 0 THEN NULL ELSE CAST(SEATS_NUM AS DOUBLE) END AS S FROM policy) WHERE S IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) SELECT v AS fill FROM m")
def impute_most_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir).select(F.expr("CASE WHEN LINE % 5 = 0 THEN NULL ELSE CAST(SEATS_NUM AS DOUBLE) END").alias("S"))
    return spark.createDataFrame([(preparation.Preparation(["S"], [], "most_frequent").fit(df).fill["S"],)], "fill double")


@query("""WITH k AS (SELECT DISTINCT MAKE AS v FROM policy WHERE MAKE NOT IN ('Brand#3', 'Brand#4', 'brand#11')) SELECT 'MAKE' AS "column", MAKE AS value, count(*) AS n FROM policy WHERE MAKE NOT IN (SELECT v FROM k) GROUP BY 2 ORDER BY n DESC, value LIMIT 10""")
def unknown_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy(spark, sf_dir)
    known = df.where("MAKE NOT IN ('Brand#3', 'Brand#4', 'brand#11')").select(F.lit("MAKE").alias("column"), F.col("MAKE").alias("value")).distinct()
    return preparation.unknown_categories(df, ["MAKE"], known)


@query("""WITH t AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events) SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM t WHERE i % 7 = 0 GROUP BY 1""")
def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh event in id order; places come from counts before each range of ids, not from one sorted partition."""
    at = ranks.numbered(spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("all", F.lit(0)), "all", ["event_id"], ranges=16)
    return at.where(F.col("place") % 7 == 0).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def stream_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly totals of a stream of files, until all that is there has been read."""
    from .streaming.monthly import monthly_totals, run_to_table

    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    live = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    where = scratch(spark, "stream")
    return run_to_table(monthly_totals(live, "o_orderdate", "o_totalprice"), f"totals_{where[-8:]}", where)


#: A label that can be learnt, but for the noise that SCORE adds; no feature holds it.
_LABEL = "CASE WHEN coalesce(PREMIUM, 0) / 1000 + SEATS_NUM / 4.0 + SCORE > 3.5 THEN 1 ELSE 0 END"


def _trained_sql(name: str, where: str = "true") -> str:
    return f"""WITH c AS (SELECT {_LABEL} AS y, count(*) AS n FROM policy WHERE {where} GROUP BY 1)
SELECT '{name}' AS model, sum(n - CAST(round(n * 0.2) AS BIGINT))::BIGINT AS rows, sum(CAST(round(n * 0.2) AS BIGINT))::BIGINT AS validated, sum(CAST(round(n * 0.2) AS BIGINT)) FILTER (y = 1)::BIGINT AS positives, true AS learnt FROM c"""


def _training(spark: SparkSession, sf_dir: str, name: str, where: str = "true", **how):
    """The outcome of a model on all features of policies."""
    from .plans.training import train_batch

    df = policy(spark, sf_dir).where(where).withColumn("HIGH", F.expr(_LABEL)).drop("SCORE", "CLAIM_PAID", "HAS_CLAIM", "EFFECTIVE_YR")
    numbers, kinds = features.feature_list(df, NUMERIC, CATEGORICAL)
    df, _ = features.engineer(df)
    key = [F.col(c).cast("string") for c in ("ORDER_KEY", "LINE", "INSURED_VALUE", "INSR_BEGIN")]
    return train_batch(df, numbers, kinds, "HIGH", key, names=[name], **how)


def _told(spark: SparkSession, made, name: str, shown: str | None = None) -> DataFrame:
    m = made.models[name].metrics
    row = (shown or name, made.rows, m["tp"] + m["fp"] + m["fn"] + m["tn"], m["tp"] + m["fn"], m["roc_auc"] >= 0.9)
    return spark.createDataFrame([row], "model string, rows long, validated long, positives long, learnt boolean")


def _trained(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A model with its defaults: rows used, rows and positives validated, and whether its ROC AUC is 0.9 or more."""
    return _told(spark, _training(spark, sf_dir, name), name)


@query(_trained_sql("lr"))
def train_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir, "lr")


@query(_trained_sql("dt"))
def train_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir, "dt")


@query(_trained_sql("rf"))
def train_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir, "rf")


@query(_trained_sql("mlp"))
def train_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir, "mlp")


_EARLY, _LATE = "year(INSR_BEGIN) < 1998", "year(INSR_BEGIN) >= 1998"


@query(_trained_sql("mlp, partial_fit", _LATE))
def train_mlp_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The perceptron on two batches: what the first taught goes on with the second, whose held-out rows say whether it has learnt."""
    first = _training(spark, sf_dir, "mlp", _EARLY).models["mlp"].model
    later = _training(spark, sf_dir, "mlp", _LATE, warm={"mlp": first})
    return _told(spark, later, "mlp", f"mlp, {later.models['mlp'].mode}")


@query("SELECT count(*) AS rows, count(*) AS in_place FROM orders")
def predictions_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as several CSV files, scored in another order: the lines of the result that stand where their input line stands."""
    source, out = scratch(spark, "lines"), scratch(spark, "predictions")
    spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice").repartition(5, "o_orderkey").write.option("header", True).csv(source)
    scored = batches.with_places(batches.read_raw(spark, source)).drop("source").repartition(7, "o_totalprice")
    batches.write_predictions(scored.withColumns({"predict": F.lit(0), "predict_proba": F.lit(0.5)}), out)

    def lines(path: str, name: str) -> DataFrame:
        df = batches.with_places(batches.read_raw(spark, path)).select(F.lit(0).alias("all"), F.col("o_orderkey").alias(name), batches.PLACE)
        return ranks.numbered(df, "all", [batches.PLACE]).select("place", name)

    both = lines(source, "line").join(lines(out, "result"), "place", "full_outer")
    return both.agg(F.count("*").alias("rows"), F.count_if(F.col("line") == F.col("result")).alias("in_place"))
