"""Command line: init, update, infer, summary, publish and collect.  Any failed batch makes the exit code 1."""

from __future__ import annotations

import argparse
import json
import logging
import sys

from .session import session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tabwarden", description=__doc__)
    p.add_argument("mode", choices=["init", "update", "infer", "summary", "publish", "collect"])
    p.add_argument("--config", default="config.json")
    p.add_argument("-n", "--limit", type=int)
    p.add_argument("--reset", action="store_true")
    p.add_argument("--file")
    p.add_argument("--out", default="out")
    p.add_argument("--describe", action="store_true")
    p.add_argument("--append")
    p.add_argument("--save", help="write what the collector was made with to this file")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--json", action="store_true")
    p.add_argument("--log", help="write the log to this file, too")
    return p


def main(args: list[str] | None = None, spark=None) -> int:
    from .plans.config import Config
    from .plans.pipeline import Pipeline
    from .plans.reports import default_views
    from .sources.batches import Collector

    a = parser().parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    if a.log:
        handler = logging.FileHandler(a.log, encoding="utf-8")
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
        logging.getLogger().addHandler(handler)
    try:
        pipeline = Pipeline(spark or session(), Config.load(a.config))
        if a.mode == "init":
            out = pipeline.init(a.reset)
        elif a.mode == "update":
            out = pipeline.update(a.limit)
        elif a.mode == "infer":
            out = pipeline.infer(a.file, a.out)
        elif a.mode in ("summary", "publish"):
            out = default_views().render_all(pipeline, a.out, ["site"] if a.mode == "publish" else None)
        else:
            c = Collector(pipeline.spark, pipeline.table, pipeline.config.get("schema.required_columns", []), pipeline.time_col, pipeline.fmt, pipeline.config.get("batching.size", "month"))
            if not (a.describe or a.append or a.save):
                return 2
            out = {"appended": c.append_external(a.append, a.overwrite)} if a.append else c.describe() if a.describe else {}
            if a.save:
                c.save(a.save)
                out["saved"] = a.save
    except Exception as e:
        logging.error("%s", e)
        return 1
    print(json.dumps(out, ensure_ascii=False, default=str) if a.json else "\n".join(f"{k}: {v}" for k, v in out.items()))
    return 1 if out.get("error") else 0


if __name__ == "__main__":
    sys.exit(main())
