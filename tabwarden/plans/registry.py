"""Model versions: every one is kept as a record; a gate and a comparison decide which is in production.

A version's files are a folder of their own that is never written again.  Records and pointers change by commits: numbered files, each
made whole under a name that must be new.  So a reader finds whole models at any time, a writer that stops halfway leaves nothing that a
record names, and of two writers the second one sees the first one's commit before it makes its own.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from ..operators.perceptron import Perceptron
from ..session import delete
from ..sources.files import load_json, save_json

VERSION = 1


@dataclass(frozen=True)
class QualityGate:
    """Thresholds that are None are not applied."""

    min_f1: float | None = None
    min_roc_auc: float | None = None
    max_regression_f1: float | None = None
    max_psi: float | None = None

    def evaluate(self, metrics: dict, production: dict | None = None, max_psi: float | None = None) -> dict:
        checks: dict[str, dict] = {}
        if self.min_f1 is not None:
            checks["min_f1"] = {"passed": metrics["f1"] >= self.min_f1, "value": metrics["f1"]}
        if self.min_roc_auc is not None:  # unknown fails
            auc = metrics.get("roc_auc")
            checks["min_roc_auc"] = {"passed": auc is not None and auc >= self.min_roc_auc, "value": auc}
        if self.max_regression_f1 is not None and production:
            loss = production["f1"] - metrics["f1"]
            checks["max_regression_f1"] = {"passed": loss <= self.max_regression_f1, "value": loss}
        if self.max_psi is not None:  # unknown passes
            checks["max_psi"] = {"passed": max_psi is None or max_psi <= self.max_psi, "value": max_psi, "skipped": max_psi is None}
        return {"passed": all(c["passed"] for c in checks.values()), "checks": checks}


@dataclass
class Registry:
    """Folders of saved models and a folder of commits; versions are keyed by batch and model, so a repeated batch adds none.

    ``files`` is the folder or URI of the models, which all nodes see; by default they lie beside the commits.
    """

    folder: Path
    gate: QualityGate = field(default_factory=QualityGate)
    files: str | None = None
    kept_commits: int = 20

    def __post_init__(self):
        self.folder = Path(self.folder)
        self.refresh()

    def _commits(self) -> list[int]:
        return sorted(int(p.stem) for p in (self.folder / "commits").glob("*.json") if p.stem.isdigit())

    def refresh(self) -> None:
        """Read the last commit."""
        done = self._commits()
        self.revision = done[-1] if done else 0
        self.data = (load_json(self.folder / "commits" / f"{self.revision}.json") if done else None) or {"schema_version": VERSION, "versions": [], "production": {}, "latest": None}

    def _commit(self, change: Callable[[], Any]) -> Any:
        """Apply a change to the last commit and make the next one; if another writer was first, to that one's."""
        folder = self.folder / "commits"
        while True:
            self.refresh()
            result = change()
            self._point()
            part = folder / f"{uuid.uuid4().hex}.part"
            save_json(part, self.data)
            try:
                os.link(part, folder / f"{self.revision + 1}.json")  # fails if the commit is there
            except FileExistsError:
                continue
            finally:
                part.unlink()
            self.revision += 1
            for old in self._commits()[: -self.kept_commits]:
                (folder / f"{old}.json").unlink(missing_ok=True)
            return result

    def versions(self, model: str | None = None) -> list[dict]:
        return [v for v in self.data["versions"] if model in (None, v["model"])]

    def production(self, model: str) -> dict | None:
        return next((v for v in self.versions(model) if v["status"] == "production"), None)

    def path(self, version: dict) -> Path:
        """The local folder of a version's files."""
        return self.folder / version["folder"]

    def uri(self, version: dict) -> str:
        return f"{self.files.rstrip('/')}/{version['folder']}" if self.files else f"file://{self.path(version).resolve()}"

    def register(self, model: str, batch_idx: int, fitted: Any, metrics: dict, max_psi: float | None = None, **info) -> dict:
        self.refresh()
        find = lambda: next((v for v in self.versions(model) if v["batch_idx"] == batch_idx), None)
        if known := find():
            return known
        version = {"model": model, "batch_idx": batch_idx, "metrics": metrics, "files": True, "folder": f"{model}/v{batch_idx:05d}-{uuid.uuid4().hex[:8]}", **info}
        self._save_model(fitted, version)

        def add() -> dict:
            if known := find():  # another writer was first
                return known
            now = self.production(model)
            verdict = self.gate.evaluate(metrics, now["metrics"] if now else None, max_psi)
            better = now is None or metrics["f1"] > now["metrics"]["f1"]
            status = "rejected" if not verdict["passed"] else "production" if better else "candidate"
            if status == "production" and now:
                now["status"] = "previous"
            made = version | {"gate": verdict, "status": status}
            self.data["versions"].append(made)
            return made

        made = self._commit(add)
        if made["folder"] != version["folder"]:
            self._delete_model(version)
        return made

    def _save_model(self, fitted: Any, version: dict) -> None:
        if isinstance(fitted, Perceptron):
            fitted.save(SparkSession.getActiveSession(), self.uri(version))
        else:
            fitted.write().save(self.uri(version))

    def _delete_model(self, version: dict) -> None:
        if self.files:
            delete(SparkSession.getActiveSession(), self.uri(version))
        else:
            shutil.rmtree(self.path(version), ignore_errors=True)

    def _point(self) -> None:
        """Name the production version of each model, the best of these, and the latest version."""
        on = [v for v in self.data["versions"] if v["status"] == "production"]
        self.data["production"] = {v["model"]: v["batch_idx"] for v in on}
        self.data["best"] = max(on, key=lambda v: v["metrics"]["f1"])["model"] if on else None
        last = self.data["versions"][-1] if self.data["versions"] else None
        self.data["latest"] = {"model": last["model"], "batch_idx": last["batch_idx"]} if last else None

    def refresh_pointers(self) -> None:
        self._commit(lambda: None)

    def prune(self, keep: int) -> int:
        """Delete the files of all but the newest ``keep`` versions of each model; records and production stay.  0 or less keeps all.

        The records say so before the files go, so that no reader looks for them.
        """
        if keep <= 0:
            return 0

        def mark() -> list[dict]:
            old = [v for model in {v["model"] for v in self.data["versions"]} for v in sorted(self.versions(model), key=lambda v: v["batch_idx"])[:-keep]]
            gone = [v for v in old if v["files"] and v["status"] != "production"]
            for v in gone:
                v["files"] = False
            return gone

        gone = self._commit(mark)
        for v in gone:
            self._delete_model(v)
        return len(gone)

    def load(self, model: str, version: dict | None = None) -> Any:
        from pyspark.ml.classification import DecisionTreeClassificationModel, LogisticRegressionModel, RandomForestClassificationModel

        kinds = {"lr": LogisticRegressionModel, "dt": DecisionTreeClassificationModel, "rf": RandomForestClassificationModel}
        version = version or self.production(model)
        if not version or not version["files"]:
            raise FileNotFoundError(f"no saved version of {model}")
        return Perceptron.load(SparkSession.getActiveSession(), self.uri(version)) if model == "mlp" else kinds[model].load(self.uri(version))

    def summary(self) -> dict:
        by: dict[str, dict] = {}
        for v in self.data["versions"]:
            own = by.setdefault(v["model"], {"versions": 0, "rejected": 0, "pruned": 0, "last_rejection": None})
            own["versions"] += 1
            own["pruned"] += not v["files"]
            if v["status"] == "rejected":
                own["rejected"] += 1
                own["last_rejection"] = v["batch_idx"]
        return {"models": by, "production": self.data["production"], "best": self.data.get("best")}
