"""Run state: which batches there are and how far processing came.  A small control file beside the checkpoint."""

from __future__ import annotations

from pathlib import Path

from ..sources.files import load_json, save_json

VERSION = 2


class RunState:
    """``path`` is the control file; without one the state lives in memory only."""

    def __init__(self, path: str | Path | None):
        self.path = Path(path) if path is not None else None
        data = (load_json(self.path) if self.path else None) or {"schema_version": VERSION}
        if data.get("schema_version") != VERSION:
            raise ValueError(f"state of version {data.get('schema_version')}, not {VERSION}")
        self.batches: list[str] = data.get("batches", [])
        self.done: list[str] = data.get("done", [])
        self.history: list[dict] = data.get("history", [])
        self.runs: list[dict] = data.get("runs", [])
        self.source_hash: str | None = data.get("source_hash")

    def save(self) -> None:
        if self.path is None:
            return
        save_json(self.path, {"schema_version": VERSION, "batches": self.batches, "done": self.done, "history": self.history, "runs": self.runs, "source_hash": self.source_hash})

    @property
    def remaining(self) -> list[str]:
        """Batches not done, in their order; late ones stand at the end."""
        done = set(self.done)
        return [b for b in self.batches if b not in done]

    @property
    def next_batch(self) -> str | None:
        return next(iter(self.remaining), None)

    @property
    def has_next(self) -> bool:
        return bool(self.remaining)

    @property
    def last_processed(self) -> int:
        """The index of the last processed batch, -1 before the first."""
        return len(self.done) - 1

    def init_batches(self, batches: list[str], source_hash: str, reset: bool = False) -> bool:
        """Set the batches; progress is kept unless the data changed or a reset is asked for."""
        fresh = reset or source_hash != self.source_hash
        if fresh:
            self.batches, self.done, self.history = list(batches), [], []
        else:
            self.add_batches(batches, save=False)
        self.source_hash = source_hash
        self.save()
        return fresh

    def add_batches(self, batches: list[str], save: bool = True) -> list[str]:
        """New ones go to the end, so that what was processed is never reordered."""
        new = [b for b in batches if b not in set(self.batches)]
        self.batches += new
        if save:
            self.save()
        return new

    def missing(self, found: list[str]) -> list[str]:
        return [b for b in self.batches if b not in set(found)]

    def mark_processed(self, batch: str, **info) -> None:
        """Progress never goes back; a batch counts once."""
        if batch not in self.batches:
            raise KeyError(batch)
        if batch not in self.done:
            self.done.append(batch)
            self.history.append({"batch": batch, **info})
        self.save()

    def record_run(self, **info) -> None:
        self.runs.append(info)
        self.save()

    def reset(self) -> None:
        self.done, self.history = [], []
        self.save()
