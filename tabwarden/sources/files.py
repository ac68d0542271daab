"""Control files: written whole or not at all, read tolerantly.  Data itself goes through Spark's readers and writers."""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import batch_period, batch_prefix


def clean_json(x: Any) -> Any:
    """NaN and infinity become null, times become ISO text."""
    if isinstance(x, dict):
        return {str(k): clean_json(v) for k, v in x.items()}
    if isinstance(x, list | tuple | set):
        return [clean_json(v) for v in x]
    if isinstance(x, float):
        return x if math.isfinite(x) else None
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return x if isinstance(x, str | int | bool | type(None)) else str(x)


def save_json(path: str | Path, data: Any) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_suffix(path.suffix + ".part")
    with part.open("w", encoding="utf-8") as out:
        json.dump(clean_json(data), out, ensure_ascii=False, indent=1)
        out.flush()
        os.fsync(out.fileno())
    os.replace(part, path)


def load_json(path: str | Path, default: Any = None) -> Any:
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (FileNotFoundError, ValueError):
        return default


def read_artifacts(folder: str | Path, prefix: str) -> list[tuple[int, Any]]:
    """(number, content) of ``<prefix><number>.json`` files in order; unreadable ones are left out."""
    found = []
    for p in Path(folder).glob(f"{prefix}*.json"):
        m = re.fullmatch(rf"{re.escape(prefix)}(\d+)", p.stem)
        data = load_json(p)
        if m and data is not None:
            found.append((int(m[1]), data))
    return sorted(found, key=lambda x: x[0])


def latest_by_name(names: DataFrame, name: str = "name") -> DataFrame:
    """(prefix, period, name) of the last file of each prefix, by the period in its name; other names are left out."""
    at = names.select(F.col(name).alias("name"), batch_period(F.col(name)).alias("period"), batch_prefix(F.col(name)).alias("prefix")).where("period IS NOT NULL")
    return at.groupBy("prefix").agg(F.max(F.struct("period", "name")).alias("last")).select("prefix", "last.period", "last.name")


def prune_none(x: Any) -> Any:
    """``x`` without None, empty dictionaries and empty lists, at any depth."""
    if isinstance(x, dict):
        made = {k: prune_none(v) for k, v in x.items()}
        return {k: v for k, v in made.items() if v is not None and v != {} and v != []}
    if isinstance(x, list):
        return [v for v in map(prune_none, x) if v is not None and v != {} and v != []]
    return x


def file_hash(path: str | Path) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()[:16]


def dataset_hash(paths: dict[str, str | Path], known: dict[str, str] | None = None) -> str:
    """One hash over all sources by name; ``known`` ones have a hash already."""
    each = {n: file_hash(p) for n, p in paths.items()} | (known or {})
    return hashlib.sha256("\n".join(f"{n}:{h}" for n, h in sorted(each.items())).encode()).hexdigest()[:16]
