"""Scoring new data: input checks, a calibrated threshold, and a chain of fallbacks."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric
from ..operators.preparation import Preparation
from ..operators.scoring import choose_threshold, count_outliers, tukey_ranges
from .training import scored


@dataclass
class ValidationReport:
    """A fatal finding always rejects, whatever came before."""

    status: str = "ok"
    findings: list[dict] = field(default_factory=list)

    def add(self, check: str, detail: Any, fatal: bool = False) -> None:
        self.findings.append({"check": check, "detail": detail, "fatal": fatal})
        self.status = "rejected" if fatal or self.status == "rejected" else "degraded"


def training_ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Ranges to keep beside the model; a row a column."""
    return {r["column"]: (r["low"], r["high"]) for r in tukey_ranges(df, columns).collect()}


def validate_input(df: DataFrame, prep: Preparation, ranges: dict[str, tuple[float, float]] | None = None, max_outlier_ratio: float = 0.5) -> tuple[DataFrame, ValidationReport]:
    """The input with numeric columns repaired, and what was found: by one aggregate and one anti join."""
    report = ValidationReport()
    if missing := prep.verify(df):
        report.add("required columns", missing, fatal=True)
        return df, report
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNotNull() & numeric(df, c).isNull()).alias(c) for c in prep.numeric], *[F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in prep.categorical]).first().asDict()
    if not counts.pop("rows"):
        report.add("rows", 0, fatal=True)
        return df, report
    if junk := {c: n for c, n in counts.items() if n and not c.startswith("null ")}:
        report.add("non-numeric values", junk)
    if gaps := {c[5:]: n for c, n in counts.items() if n and c.startswith("null ")}:
        report.findings.append({"check": "missing categories", "detail": gaps, "fatal": False})
    fixed = df.withColumns({c: numeric(df, c) for c in prep.numeric}) if prep.numeric else df
    if prep.categorical and (unknown := [r.asDict() for r in prep.unknown(df).collect()]):
        report.add("unknown categories", unknown)
    if ranges:
        found = count_outliers(fixed, ranges).first()
        if found["ratio"] > max_outlier_ratio:
            report.add("outliers", found["ratio"], fatal=True)
        elif found["outliers"]:
            report.findings.append({"check": "outliers", "detail": found["ratio"], "fatal": False})
    return fixed, report


@dataclass
class Prediction:
    rows: DataFrame
    model: str
    threshold: dict
    notes: list[str]


def predict(df: DataFrame, prep: Preparation, models: dict[str, Any], best: str | None, target_rate: float = 0.05, method: str = "quantile", fixed: float = 0.5, fallback: str = "lr") -> Prediction:
    """Original columns with predict and predict_proba, by the first model in the chain that works; a constant 0 if none does."""
    chain = list(dict.fromkeys([m for m in (best, fallback, *models) if m in models]))
    notes = []
    for name in chain:
        try:
            keep = df.columns
            ready = prep.transform(df, keep).select(*keep, "features")
            rows = scored(models[name], ready).drop("features").persist()
            cut = choose_threshold(rows, "p", target_rate if method == "quantile" else 0.0, fixed).first().asDict()
            made = rows.withColumn("predict", (F.col("p") >= cut["threshold"]).cast("int")).withColumnRenamed("p", "predict_proba")
            return Prediction(made, name, cut, notes)
        except Exception as e:  # the chain exists for models that fail
            notes.append(f"{name} failed: {e}"[:300])
    notes.append("no model works; everything is predicted negative")
    return Prediction(df.withColumns({"predict": F.lit(0), "predict_proba": F.lit(0.0)}), "constant", {"threshold": fixed}, notes)
