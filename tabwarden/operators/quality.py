"""Quality metrics of a batch: completeness, validity, types, timeliness, mined rules, cleaning."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import numeric
from ..functions.dates import parse_datetime
from .rules import Rule, RuleSet, clean_by_rules, evaluate_rules, stacked

#: The label that mining and checking give a missing value.
MISSING = "__MISSING__"


def _missing_in_row(columns: list[str]) -> Column:
    return sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))


def completeness(df: DataFrame, features: list[str]) -> DataFrame:
    """One row: shares of missing values in all, in the worst column (the first of equals), in the worst and the mean row."""
    columns = [c for c in features if c in df.columns]
    if not columns:
        nan = F.lit(float("nan"))
        return df.limit(0).agg(nan.alias("total_missing_ratio"), nan.alias("max_column_ratio"), F.lit(None).cast("string").alias("max_column"), nan.alias("max_row_ratio"), nan.alias("mean_row_ratio"), F.lit(0).alias("n_columns"))
    k = len(columns)
    per_row = df.select(*columns, _missing_in_row(columns).alias("_m"))
    made = per_row.agg(F.count("*").alias("n"), F.sum("_m").alias("total"), F.max("_m").alias("worst"), F.array(*[F.count_if(F.col(c).isNull()) for c in columns]).alias("each"))
    most = F.array_max("each")
    share = lambda x, y: x / F.nullif(y, F.lit(0))
    return made.select(
        share(F.col("total"), F.col("n") * k).alias("total_missing_ratio"),
        share(most, F.col("n")).alias("max_column_ratio"),
        F.get(F.array(*map(F.lit, columns)), (F.array_position("each", most) - 1).cast("int")).alias("max_column"),
        (F.col("worst") / k).alias("max_row_ratio"),
        share(F.col("total"), F.col("n") * k).alias("mean_row_ratio"),
        F.lit(k).alias("n_columns"),
    )


def validity(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, checked, violations, ratio): violations among values that were present; null where nothing was checked.

    A conditional rule that counts missing values checks its whole scope.
    """
    def checked(r: Rule) -> Column:
        whole = (r.applies_when and r.on_missing == "violation") or r.op in ("notna", "isna")
        return r.applicable(df) if whole else r.applicable(df) & F.col(r.column).isNotNull()

    made = stacked(df, "rule", {r.name: {"checked": F.count_if(checked(r)), "violations": F.count_if(checked(r) & r.violation(df))} for r in rules})
    return made.withColumn("ratio", F.col("violations") / F.nullif(F.col("checked"), F.lit(0)))


def type_check(df: DataFrame, expected_numeric: list[str], examples: int = 5) -> DataFrame:
    """(column, checked, non_numeric, ratio, examples) of columns with text that is no number; examples in value order."""
    columns = [c for c in expected_numeric if c in df.columns]
    bad = {c: F.col(c).isNotNull() & numeric(df, c).isNull() for c in columns}
    counts = stacked(df, "column", {c: {"checked": F.count(c), "non_numeric": F.count_if(bad[c])} for c in columns}).where("non_numeric > 0")
    junk = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.when(bad[c], F.col(c).cast("string")).alias("value")) for c in columns]))).where("value IS NOT NULL").distinct()
    few = junk.withColumn("_n", F.row_number().over(Window.partitionBy("column").orderBy("value"))).where(F.col("_n") <= examples)
    shown = few.groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("value")), "|").alias("examples"))
    return counts.withColumn("ratio", F.col("non_numeric") / F.col("checked")).join(shown, "column")


def timeliness(df: DataFrame, time_col: str, fmt: str | None = None) -> DataFrame:
    """One row: first and last day, span, distinct times, the largest gap between neighbours, rows without a time."""
    if time_col not in df.columns:
        return df.sparkSession.createDataFrame([(False, f"no column {time_col}")], "available boolean, reason string")
    times = df.select(parse_datetime(df, time_col, fmt).alias("t"))
    # gaps within a month, and between the months that have times, which are few
    distinct = times.where("t IS NOT NULL").distinct().withColumn("month", F.trunc("t", "month"))
    days = lambda a, b: F.timestamp_diff("DAY", a, b)
    inside = distinct.withColumn("gap", days(F.lag("t").over(Window.partitionBy("month").orderBy("t")), F.col("t")))
    months = inside.groupBy("month").agg(F.max("gap").alias("gap"), F.min("t").alias("first"), F.max("t").alias("last"))
    between = months.withColumn("step", days(F.lag("last").over(Window.orderBy("month")), F.col("first")))
    gaps = between.agg(F.max(F.greatest("gap", "step")).alias("max_gap_days"))
    span = times.agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count_distinct("t").alias("n_unique"), F.count_if(F.col("t").isNull()).alias("unparsed"))
    return span.join(F.broadcast(gaps)).select(
        (F.col("n_unique") > 0).alias("available"), F.date_format("first", "yyyy-MM-dd").alias("min_date"), F.date_format("last", "yyyy-MM-dd").alias("max_date"),
        F.timestamp_diff("DAY", F.col("first"), F.col("last")).alias("span_days"), "n_unique", "max_gap_days", "unparsed",
    )


def static_rules(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, list[str]]:
    """Ratios over all rows of the rules whose columns are there, and the names of the others."""
    return evaluate_rules(df, rules.available(df.columns)), rules.missing(df.columns)


def _all_equal(df: DataFrame, pairs: list[dict]) -> Column:
    cond = F.lit(True)
    for p in pairs:
        c = p["column"]
        cond = cond & (F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) == p["value"] if c in df.columns else F.lit(False))
    return cond


def dynamic_rules(df: DataFrame, mined: list[dict], min_antecedent_rows: int = 30) -> DataFrame:
    """(rule, antecedent_rows, violations, violation_ratio, raw_violation_ratio, support) of mined rules on another batch.

    The ratio is hidden where the antecedent has too few rows.
    """
    def measures(rule: dict) -> dict[str, Column]:
        when, then = _all_equal(df, rule["antecedents"]), _all_equal(df, rule["consequents"])
        return {"antecedent_rows": F.count_if(when), "violations": F.count_if(when & ~then), "rows": F.count("*")}

    made = stacked(df, "rule", {r["label"]: measures(r) for r in mined})
    raw = F.col("violations") / F.nullif(F.col("antecedent_rows"), F.lit(0))
    return made.select(
        "rule", "antecedent_rows", "violations", F.when(F.col("antecedent_rows") >= min_antecedent_rows, raw).alias("violation_ratio"),
        raw.alias("raw_violation_ratio"), (F.col("antecedent_rows") / F.nullif(F.col("rows"), F.lit(0))).alias("support"),
    )


def dedupe(df: DataFrame) -> DataFrame:
    """Distinct rows; nulls are equal."""
    return df.dropDuplicates()


@dataclass
class CleaningReport:
    rows_in: int = 0
    rows_out: int = 0
    sparse_rows: int = 0
    duplicates: int = 0
    dropped_by_rule: dict[str, int] = field(default_factory=dict)
    skipped_by_rule: dict[str, float] = field(default_factory=dict)
    missing_columns: list[str] = field(default_factory=list)

    @property
    def removed(self) -> int:
        return self.rows_in - self.rows_out

    def steps(self) -> list[tuple[str, int]]:
        return [("rows_in", self.rows_in), ("sparse_rows", self.sparse_rows), ("duplicates", self.duplicates), *[(f"rule:{k}", v) for k, v in self.dropped_by_rule.items()], ("rows_out", self.rows_out)]


def clean(df: DataFrame, features: list[str], rules: RuleSet, max_row_missing_ratio: float = 0.5, max_violation_ratio: float = 0.3) -> tuple[DataFrame, CleaningReport]:
    """Drop rows with too many missing features, repeated rows, and what violates rules - in this order, each on what is left."""
    columns = [c for c in features if c in df.columns]
    sparse = _missing_in_row(columns) / len(columns) > max_row_missing_ratio if columns and max_row_missing_ratio < 1.0 else F.lit(False)
    rows, thin = df.agg(F.count("*"), F.count_if(sparse)).first()
    report = CleaningReport(rows_in=rows, sparse_rows=thin, missing_columns=rules.missing(df.columns))
    df = dedupe(df.where(~sparse))
    out, by_rule = clean_by_rules(df, rules.available(df.columns), max_violation_ratio)
    report.dropped_by_rule, report.skipped_by_rule = by_rule.dropped, by_rule.skipped
    report.rows_out = by_rule.left if by_rule.left is not None else df.count()
    report.duplicates = rows - thin - report.rows_out - sum(by_rule.dropped.values())
    return out, report
