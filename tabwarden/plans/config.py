"""Configuration: sections, defaults and checks that report every mistake at once."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path
from typing import Any

from ..operators.rules import OPERATORS
from ..sources.files import read_artifacts

SECTIONS = ["dataset", "schema", "features", "target", "batching", "quality", "training", "paths"]
TWO_SIDED, LISTS, SINGLE = ("between", "not_between"), ("in", "not_in"), ("eq", "ne", "ge", "gt", "le", "lt")


class ConfigError(ValueError):
    """All mistakes, one a line."""


def check_rule(rule: dict, where: str) -> list[str]:
    """What is wrong with a rule or a scope."""
    wrong = [f"{where}: {k} is missing" for k in ("column", "op") if not rule.get(k)]
    op, value = rule.get("op"), rule.get("value")
    if op and op not in OPERATORS:
        wrong.append(f"{where}: unknown operator {op!r}")
    if op in TWO_SIDED and not (isinstance(value, list | tuple) and len(value) == 2 and value[0] <= value[1]):
        wrong.append(f"{where}: {op} needs two ordered bounds")
    if op in LISTS and not (isinstance(value, list | tuple) and value):
        wrong.append(f"{where}: {op} needs a list with values")
    if op in SINGLE and value is None:
        wrong.append(f"{where}: {op} needs a value")
    if rule.get("severity", "error") not in ("error", "warn"):
        wrong.append(f"{where}: severity is error or warn")
    if rule.get("on_missing", "ignore") not in ("ignore", "violation"):
        wrong.append(f"{where}: on_missing is ignore or violation")
    if rule.get("applies_when"):
        wrong += check_rule(rule["applies_when"], f"{where}, applies_when")
    return wrong


def validate(data: dict) -> list[str]:
    wrong = [f"section {s} is missing" for s in SECTIONS if s not in data]
    names: list[str] = []
    for i, rule in enumerate(data.get("quality", {}).get("rules", [])):
        wrong += check_rule(rule, f"rule {rule.get('name', i)}")
        names.append(rule.get("name"))
    wrong += [f"rule {n} stands twice" for n in sorted({n for n in names if n and names.count(n) > 1})]
    if any(not n for n in names):
        wrong.append("a rule has no name")
    if data.get("batching", {}).get("size", "month") not in ("month", "quarter", "year"):
        wrong.append("batching.size is month, quarter or year")
    for key in ("max_violation_ratio", "max_row_missing_ratio"):
        if not 0 <= data.get("quality", {}).get(key, 0.5) <= 1:
            wrong.append(f"quality.{key} lies in [0, 1]")
    rate = data.get("inference", {}).get("target_positive_rate", "auto")
    if rate != "auto" and not (isinstance(rate, int | float) and 0 < rate < 1):
        wrong.append("inference.target_positive_rate lies in (0, 1) or is auto")
    return wrong


class Config:
    def __init__(self, data: dict):
        if wrong := validate(data):
            raise ConfigError("\n".join(wrong))
        self.data = data

    @classmethod
    def load(cls, path: str | Path) -> Config:
        text = Path(path).read_text(encoding="utf-8")
        if str(path).endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise ConfigError("YAML needs the yaml package; JSON works without") from e
            return cls(yaml.safe_load(text))
        return cls(json.loads(text))

    def get(self, path: str, default: Any = None) -> Any:
        at: Any = self.data
        for k in path.split("."):
            if not isinstance(at, dict) or k not in at:
                return default
            at = at[k]
        return at

    @property
    def hash(self) -> str:
        return hashlib.sha256(json.dumps(self.data, sort_keys=True, default=str).encode()).hexdigest()[:16]

    def target_positive_rate(self, metadata: str | Path, default: float = 0.05) -> float:
        """The configured rate, or with auto the newest valid one of the last five quality files."""
        rate = self.get("inference.target_positive_rate", "auto")
        if rate != "auto":
            return float(rate)
        for _, x in reversed(read_artifacts(metadata, "quality_")[-5:]):
            found = (x.get("target") or {}).get("rate")
            if isinstance(found, int | float) and 0 < found < 1:
                return float(found)
        return default
