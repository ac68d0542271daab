"""Declarative rules as data, compiled to Columns: all of a table's rules are evaluated in one scan."""

from __future__ import annotations

from dataclasses import dataclass, field
from numbers import Number
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_text, numeric

#: How each operator reads.
OPERATORS = {
    "notna": "is present", "isna": "is missing", "positive": "> 0", "non_negative": ">= 0", "eq": "==", "ne": "!=", "ge": ">=", "gt": ">",
    "le": "<=", "lt": "<", "in": "in", "not_in": "not in", "between": "between", "not_between": "not between",
}


def predicate(df: DataFrame, column: str, op: str, value: Any = None) -> Column:
    """A condition as a Column without nulls: missing and junk fail it, but pass ``ne``, ``not_in`` and ``not_between``."""
    if op not in OPERATORS:
        raise ValueError(f"unknown operator {op!r}")
    if column not in df.columns:
        raise KeyError(column)
    c, no, yes = F.col(column), F.lit(False), F.lit(True)

    def known(cond: Column, missing: Column) -> Column:
        return F.coalesce(cond, missing)

    def like(v: Any) -> bool:
        """Whether a raw comparison of the column with the operand makes sense at all."""
        return isinstance(v, str) == is_text(df, column)

    match op:
        case "notna":
            return c.isNotNull()
        case "isna":
            return c.isNull()
        case "positive":
            return known(numeric(df, column) > 0, no)
        case "non_negative":
            return known(numeric(df, column) >= 0, no)
        case "eq" | "ne":
            if isinstance(value, Number) and not isinstance(value, bool):
                same = numeric(df, column) == float(value)
            else:
                same = (c == F.lit(value)) if like(value) else no
            return known(same, no) if op == "eq" else known(~same, yes)
        case "in" | "not_in":
            some = [v for v in value if like(v)]
            inside = c.isin(some) if some else no
            return known(inside, no) if op == "in" else known(~inside, yes)
        case "between" | "not_between":
            inside = numeric(df, column).between(float(value[0]), float(value[1]))
            return known(inside, no) if op == "between" else known(~inside, yes)
    x, v = numeric(df, column), float(value)
    return known({"ge": x >= v, "gt": x > v, "le": x <= v, "lt": x < v}[op], no)


@dataclass(frozen=True)
class Condition:
    column: str
    op: str
    value: Any = None


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    op: str
    value: Any = None
    applies_when: Condition | None = None
    on_missing: str = "ignore"
    severity: str = "error"
    description: str = ""

    @property
    def columns(self) -> list[str]:
        return [self.column] + ([self.applies_when.column] if self.applies_when else [])

    def applicable(self, df: DataFrame) -> Column:
        s = self.applies_when
        return predicate(df, s.column, s.op, s.value) if s else F.lit(True)

    def violation(self, df: DataFrame) -> Column:
        """Out of the condition and in scope; a missing value counts only by ``on_missing`` - junk text is not missing."""
        bad = ~predicate(df, self.column, self.op, self.value) & self.applicable(df)
        if self.on_missing == "ignore" and self.op not in ("notna", "isna"):
            bad = bad & F.col(self.column).isNotNull()
        return bad

    def describe(self) -> str:
        def said(column: str, op: str, value: Any) -> str:
            if op in ("between", "not_between"):
                return f"{column} {OPERATORS[op]} {value[0]} and {value[1]}"
            if op in ("in", "not_in"):
                return f"{column} {OPERATORS[op]} ({', '.join(map(str, value))})"
            return f"{column} {OPERATORS[op]}" + (f" {value}" if op in ("eq", "ne", "ge", "gt", "le", "lt") else "")

        scope = self.applies_when
        return said(self.column, self.op, self.value) + (f" when {said(scope.column, scope.op, scope.value)}" if scope else "")


@dataclass(frozen=True)
class RuleSet:
    rules: list[Rule] = field(default_factory=list)

    @classmethod
    def from_config(cls, items: list[dict]) -> RuleSet:
        return cls([Rule(**{**x, "applies_when": Condition(**x["applies_when"]) if x.get("applies_when") else None}) for x in items])

    def available(self, columns: list[str]) -> list[Rule]:
        return [r for r in self.rules if set(r.columns) <= set(columns)]

    def missing(self, columns: list[str]) -> list[str]:
        return [r.name for r in self.rules if not set(r.columns) <= set(columns)]

    @property
    def error_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.severity == "error"]

    @property
    def warn_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.severity == "warn"]


def stacked(df: DataFrame, key: str, values: dict[str, dict[str, Column]], by: list[str] | None = None) -> DataFrame:
    """Aggregate all columns of ``values`` {name: {measure: aggregate}} in one scan; then a row per name."""
    by = by or []
    aggregates = [F.struct(F.lit(name).alias(key), *[c.alias(m) for m, c in measures.items()]) for name, measures in values.items()]
    flat = [c.alias(f"_{i}_{m}") for i, measures in enumerate(values.values()) for m, c in measures.items()]
    if not aggregates:
        raise ValueError("nothing to aggregate")
    rows = [F.struct(F.lit(name).alias(key), *[F.col(f"_{i}_{m}").alias(m) for m in measures]) for i, (name, measures) in enumerate(values.items())]
    return df.groupBy(*by).agg(*flat).select(*by, F.inline(F.array(*rows)))


def evaluate_rules(df: DataFrame, rules: list[Rule], by: list[str] | None = None) -> DataFrame:
    """(by..., rule, violations, rows, ratio): the share of all rows that violate each rule."""
    made = stacked(df, "rule", {r.name: {"violations": F.count_if(r.violation(df)), "rows": F.count("*")} for r in rules}, by)
    return made.withColumn("ratio", F.coalesce(F.col("violations") / F.nullif(F.col("rows"), F.lit(0)), F.lit(0.0)))


@dataclass
class RuleCleaning:
    """What cleaning by rules did: rows dropped by each applied rule, and the ratio of each skipped one."""

    dropped: dict[str, int] = field(default_factory=dict)
    skipped: dict[str, float] = field(default_factory=dict)
    left: int | None = None


#: Rules whose violations are counted in one job, as one combination of bits a row.
_AT_ONCE = 16


def clean_by_rules(df: DataFrame, rules: list[Rule], max_violation_ratio: float) -> tuple[DataFrame, RuleCleaning]:
    """Drop what violates each ``error`` rule in turn, unless that would be more than the given share of what is left.

    Rows are counted by which rules they violate; these counts give every share of the sequence at once.
    """
    report, errors = RuleCleaning(), [r for r in rules if r.severity == "error"]
    for first in range(0, len(errors), _AT_ONCE):
        some = errors[first : first + _AT_ONCE]
        bad = {r.name: r.violation(df) for r in some}
        mask = sum((F.when(bad[r.name], 1 << i).otherwise(0) for i, r in enumerate(some)), F.lit(0))
        left = {r["mask"]: r["count"] for r in df.groupBy(mask.alias("mask")).count().collect()}  # at most 2 ** _AT_ONCE
        applied = []
        for i, rule in enumerate(some):
            rows, count = sum(left.values()), sum(n for m, n in left.items() if m >> i & 1)
            share = count / rows if rows else 0.0
            if count and share > max_violation_ratio:
                report.skipped[rule.name] = share
            else:
                report.dropped[rule.name] = count
                left = {m: n for m, n in left.items() if not m >> i & 1}
                applied += [bad[rule.name]] * bool(count)
        report.left = sum(left.values())
        for cond in applied:
            df = df.where(~cond)
    return df, report
