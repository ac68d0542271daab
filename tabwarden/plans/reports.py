"""What people read: a text report, a page with charts, a small site; each is a view of the accumulated records."""

from __future__ import annotations

import html
import logging
import shutil
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import SparkSession

from ..operators import meta
from ..sources.files import read_artifacts, save_json
from .pipeline import Pipeline, format_duration, runs, setting_names
from .training import ORDER

log = logging.getLogger(__name__)
SITE_BYTES = 20 * 2**20


def analyse(spark: SparkSession, manifests: list[dict], least: int = 3) -> dict:
    """The report over runs; refused under ``least`` batches."""
    if len(manifests) < least:
        return {"available": False, "reason": f"{len(manifests)} batches, {least} are needed"}
    df = runs(spark, manifests).persist()
    rows = lambda x: [r.asDict() for r in x.collect()]
    conditions = ["rows_used", "rows_clean", "positive_rate", "n_features", "batch_idx"]
    out = {
        "available": True, "batches": len(manifests), "dynamics": rows(meta.dynamics(df)), "winners": rows(meta.winners(df, ORDER).orderBy("batch_idx")), "calibration": rows(meta.calibration(df)),
        "conditions": rows(meta.condition_influence(df, conditions)), "settings": rows(meta.rank_settings(df, setting_names(manifests)).orderBy("rank")),
        "mode": {"verdict": meta.overall_verdict(df, "mode"), "models": rows(meta.feature_influence(df, "mode"))}, "consensus": consensus(spark, manifests[-1]),
    }
    out["findings"] = findings(out)
    df.unpersist()
    return out


def consensus(spark: SparkSession, manifest: dict) -> list[dict]:
    """The features that several models of a batch hold for strong."""
    weights = [(model, x["feature"], float(x["weight"])) for model, e in manifest.get("explanation", {}).items() for x in e.get("features", [])]
    if not weights:
        return []
    return [r.asDict() for r in meta.consensus(spark.createDataFrame(weights, "model string, feature string, weight double")).where("models > 1").collect()]


def findings(report: dict) -> list[str]:
    """The report in sentences."""
    said = [f"{d['model']}: mean f1 {d['mean']:.4f} over {d['n']} batches, {d['trend']}" for d in sorted(report["dynamics"], key=lambda d: -d["mean"])]
    said += [f"{c['model']} predicts {c['ratio']:.2f} times the actual share of positives" for c in report["calibration"] if c["ratio"] and not 0.67 <= c["ratio"] <= 1.5]
    said += [f"{s['setting']}: the values differ by {s['spread']:.4f} in f1" for s in report["settings"] if s["verdict"] == "varied"]
    said += [f"{c['feature']} is strong in {c['models']} models" for c in report["consensus"][:5]]
    said += [f"{c['model']}: f1 goes with {c['condition']} (rho {c['rho']:+.2f}, n {c['n']})" for c in report["conditions"] if abs(c["rho"]) >= 0.5]
    return said


def _by_rule(records: list[dict], part: str, value: str) -> dict[str, list[float]]:
    """Values of a part's rows by rule, over the batches that have one."""
    out: dict[str, list[float]] = {}
    for q in records:
        for r in q.get(part) or []:
            if r.get(value) is not None:
                out.setdefault(r["rule"], []).append(r[value])
    return out


def _worst(pairs: list[tuple[str, float]], most: int = 5) -> list[tuple[str, float]]:
    """The largest values that are above 0, the earlier batch first."""
    return sorted([p for p in pairs if p[1]], key=lambda p: -p[1])[:most]


def sections(pipeline: Pipeline, analysis: dict | None = None) -> dict[str, list[str]]:
    """Twelve sections of lines, from the records of all batches."""
    ms, numbered = pipeline.manifests(), read_artifacts(pipeline.meta, "quality_")
    qs, state, summary = [q for _, q in numbered], pipeline.state, pipeline.registry.summary()
    name = {m["batch_idx"]: m["batch"] for m in ms}
    labelled = [(name.get(i, str(i)), q) for i, q in numbered]
    mean = lambda v: sum(v) / len(v) if v else 0.0

    kept = [(n, q["cleaning"]["rows_out"]) for n, q in labelled]
    data = [f"rows in {sum(q['cleaning']['rows_in'] for q in qs)}, kept {sum(r for _, r in kept)}"]
    if kept:
        small, large = min(kept, key=lambda p: p[1]), max(kept, key=lambda p: p[1])
        data += [f"mean a batch {mean([r for _, r in kept]):.0f}, least {small[1]} ({small[0]}), most {large[1]} ({large[0]})"]
    data += [f"{n}: {q['timeliness']['min_date']} to {q['timeliness']['max_date']}" for n, q in labelled[-1:] if (q.get("timeliness") or {}).get("min_date")]

    gaps = [(n, q["completeness"]["max_column_ratio"], q["completeness"]["max_column"]) for n, q in labelled if q.get("completeness")]
    complete = [f"largest missing share {max((g[1] or 0 for g in gaps), default=0):.4f}", f"mean missing share {mean([q['completeness']['total_missing_ratio'] or 0 for q in qs if q.get('completeness')]):.4f}"]
    complete += [f"{n}: {share:.4f} of {next(g[2] for g in gaps if g[0] == n)}" for n, share in _worst([(g[0], g[1] or 0) for g in gaps])]

    dropped: dict[str, list[int]] = {}
    skipped: dict[str, int] = {}
    for q in qs:
        for rule, n in q["cleaning"]["dropped_by_rule"].items():
            dropped.setdefault(rule, []).append(n)
        for rule in q["cleaning"].get("skipped_by_rule") or {}:
            skipped[rule] = skipped.get(rule, 0) + 1
    cleaning = [f"sparse rows {sum(q['cleaning']['sparse_rows'] for q in qs)}, repeated rows {sum(q['cleaning']['duplicates'] for q in qs)}"]
    cleaning += [f"{r}: {sum(n)} rows in {sum(x > 0 for x in n)} batches" for r, n in sorted(dropped.items())]
    cleaning += [f"{r}: not applied in {n} batches, as it would take too much" for r, n in sorted(skipped.items())]

    types: dict[str, int] = {}
    shown: dict[str, str] = {}
    for q in qs:
        for t in q["types"]:
            types[t["column"]] = types.get(t["column"], 0) + t["non_numeric"]
            shown[t["column"]] = t.get("examples") or ""
    valid, mined = _by_rule(qs, "validity", "ratio"), _by_rule(qs, "dynamic_rules", "violation_ratio")

    status = [m["drift"]["status"] for m in ms]
    moved = [f"{x}: {status.count(x)}" for x in ("ok", "warn", "alert") if x in status]
    moved += [f"{n}: largest PSI {p:.4f}" for n, p in _worst([(m["batch"], m["drift"].get("max_psi") or 0) for m in ms])]
    moved += [f"{n}: largest KS {p:.4f}" for n, p in _worst([(m["batch"], m["drift"].get("max_ks") or 0) for m in ms], 3)]

    models: list[str] = []
    for model in ORDER:
        own = [(m["batch"], m["metrics"][model]) for m in ms if model in m["metrics"]]
        if own:
            last, best = own[-1][1], max(own, key=lambda p: p[1]["f1"])
            auc = f", roc auc {last['roc_auc']:.4f}" if last.get("roc_auc") is not None else ""
            models += [f"{model}: f1 {last['f1']:.4f}{auc}; mean f1 {mean([x['f1'] for _, x in own]):.4f}, best {best[1]['f1']:.4f} ({best[0]})"]
    wins: dict[str, int] = {}
    for w in (analysis or {}).get("winners", []):
        wins[w["model"]] = wins.get(w["model"], 0) + 1
    models += [f"{model} is the best in {n} batches" for model, n in sorted(wins.items(), key=lambda p: -p[1])]

    seconds: dict[str, float] = {}
    for m in ms:
        for k, t in m["seconds"].items():
            seconds[k] = seconds.get(k, 0.0) + t
    spent = [f"{k}: {format_duration(t)}" for k, t in sorted(seconds.items(), key=lambda x: -x[1])]
    spent += [f"all: {format_duration(sum(seconds.values()))}, {format_duration(sum(seconds.values()) / len(ms))} a batch"] if ms else []
    spent += [f"peak memory of the driver's Python {max(m.get('peak_mb', 0) for m in ms):.0f} MB"] if ms else []
    return {
        "State": [f"batches {len(state.batches)}, processed {len(state.done)}, pending {len(state.remaining)}", *[f"last {b}" for b in state.done[-1:]], *[f"next {b}" for b in state.remaining[:1]]],
        "Data": data, "Completeness": complete,
        "Validity": [f"{r}: mean violation {mean(x):.4f}, most {max(x):.4f}" for r, x in sorted(valid.items(), key=lambda p: -mean(p[1]))],
        "Cleaning": cleaning, "Types": [f"{c}: {n} values are no numbers, such as {shown[c]}" for c, n in sorted(types.items())],
        "Mined rules": [f"{r}: mean violation {mean(x):.4f} in {len(x)} batches" for r, x in sorted(mined.items())],
        "Drift": moved, "Models": models,
        "Registry": [f"{n}: {x['versions']} versions, {x['rejected']} rejected, {x['pruned']} pruned" for n, x in summary["models"].items()] + [f"best: {summary['best']}"],
        "Time": spent, "Findings": (analysis or {}).get("findings", []),
    }


def text_report(pipeline: Pipeline, out: Path, analysis: dict | None = None) -> Path:
    """Fixed-width text, and the same as JSON."""
    made = sections(pipeline, analysis)
    out.mkdir(parents=True, exist_ok=True)
    lines = [x for title, rows in made.items() for x in ("", title, "-" * 78, *[f"  {r}"[:100] for r in rows or ["none"]])]
    (out / "report.txt").write_text("\n".join(lines[1:]) + "\n", encoding="utf-8")
    save_json(out / "report.json", made)
    return out / "report.txt"


def chart(title: str, series: dict[str, list[float | None]], lines: dict[str, float] | None = None, width: int = 640, height: int = 200) -> str:
    """A line chart as SVG; a missing value is a gap, thresholds are dashed, every sixth batch has a tick."""
    values = [v for s in series.values() for v in s if v is not None] + list((lines or {}).values())
    if not values:
        return f"<p>{html.escape(title)}: no data</p>"
    low, high = min(0.0, *values), max(values) or 1.0
    n = max(len(s) for s in series.values())
    x = lambda i: 40 + i * (width - 60) / max(n - 1, 1)
    y = lambda v: height - 25 - (v - low) * (height - 45) / ((high - low) or 1.0)
    colours, parts = ["#1f5fa8", "#b3541e", "#2e7d4f", "#7a4fa0"], []
    for k, (name, s) in enumerate(series.items()):
        path, pen = "", "M"
        for i, v in enumerate(s):
            if v is None:
                pen = "M"
                continue
            path, pen = f"{path}{pen}{x(i):.1f},{y(v):.1f}", "L"
        parts.append(f'<path d="{path}" fill="none" stroke="{colours[k % 4]}" stroke-width="1.6"/><text x="{60 + 110 * k}" y="12" fill="{colours[k % 4]}" font-size="11">{html.escape(name)}</text>')
    for name, v in (lines or {}).items():
        parts.append(f'<line x1="40" x2="{width - 20}" y1="{y(v):.1f}" y2="{y(v):.1f}" stroke="#999" stroke-dasharray="4 3"/><text x="{width - 18}" y="{y(v):.1f}" font-size="9" text-anchor="end">{html.escape(name)}</text>')
    parts += [f'<text x="{x(i):.1f}" y="{height - 8}" font-size="9" text-anchor="middle">{i}</text>' for i in range(0, n, 6)]
    parts += [f'<text x="36" y="{y(v):.1f}" font-size="9" text-anchor="end">{v:.3g}</text>' for v in (low, high)]
    return f'<figure><figcaption>{html.escape(title)}</figcaption><svg viewBox="0 0 {width} {height}" role="img" aria-label="{html.escape(title)}">{"".join(parts)}</svg></figure>'


def dashboard(pipeline: Pipeline, out: Path, analysis: dict | None = None) -> Path:
    """One self-contained page."""
    ms = pipeline.manifests()
    of = lambda f: [f(m) for m in ms]
    names = [n for n in ORDER if any(n in m["metrics"] for m in ms)]
    charts = [
        chart("f1", {n: of(lambda m, n=n: (m["metrics"].get(n) or {}).get("f1")) for n in names}), chart("roc auc", {n: of(lambda m, n=n: (m["metrics"].get(n) or {}).get("roc_auc")) for n in names}),
        chart("largest PSI", {"psi": of(lambda m: m["drift"].get("max_psi"))}, {"warn": pipeline.thresholds.psi_warn, "alert": pipeline.thresholds.psi_alert}), chart("positive rate", {"rate": of(lambda m: m["target"].get("rate"))}), chart("rows", {"clean": of(lambda m: m["rows_clean"])}),
        chart("largest KS", {"ks": of(lambda m: m["drift"].get("max_ks"))}, {"warn": pipeline.thresholds.ks_warn}), chart("seconds", {k: of(lambda m, k=k: m["seconds"].get(k)) for k in ("train", "drift", "quality")}),
        chart("predicted share of positives", {n: of(lambda m, n=n: (m["metrics"].get(n) or {}).get("predicted_positive_rate")) for n in names}),
    ] if ms else []
    qs = [q for _, q in read_artifacts(pipeline.meta, "quality_")]
    charts += [
        chart("missing values", {"all": [q["completeness"]["total_missing_ratio"] for q in qs], "worst column": [q["completeness"]["max_column_ratio"] for q in qs]}),
        chart("rows taken by cleaning", {"rules": [sum(q["cleaning"]["dropped_by_rule"].values()) for q in qs], "repeated": [q["cleaning"]["duplicates"] for q in qs], "sparse": [q["cleaning"]["sparse_rows"] for q in qs]}),
        chart("violations", {r: [next((x["ratio"] for x in q["validity"] if x["rule"] == r), None) for q in qs] for r in sorted(_by_rule(qs, "validity", "ratio"))[:4]}),
    ] if qs else []
    body = "".join(f"<h2>{html.escape(t)}</h2><ul>{''.join(f'<li>{html.escape(r)}</li>' for r in rows)}</ul>" for t, rows in sections(pipeline, analysis).items())
    out.mkdir(parents=True, exist_ok=True)
    page = out / "dashboard.html"
    page.write_text(f'<!doctype html><html lang="en"><meta charset="utf-8"><title>Batches</title><style>body{{font:14px sans-serif;max-width:760px;margin:2em auto}}svg{{width:100%}}</style><h1>Batches</h1>{"".join(charts)}{body}</html>', encoding="utf-8")
    return page


def site(pipeline: Pipeline, out: Path, analysis: dict | None = None) -> list[str]:
    """A folder to publish: index, page, reports, records of production models within a budget of bytes."""
    shutil.rmtree(out, ignore_errors=True)
    out.mkdir(parents=True)
    made = []
    if pipeline.manifests():
        made.append(dashboard(pipeline, out, analysis).name)
    text_report(pipeline, out, analysis)
    made += ["report.txt", "report.json"]
    save_json(out / "meta.json", analysis or {})
    made.append("meta.json")
    used = sum((out / n).stat().st_size for n in made)
    for model in pipeline.registry.data["production"]:
        v = pipeline.registry.production(model)
        source = pipeline.registry.path(v)
        size = sum(p.stat().st_size for p in source.rglob("*") if p.is_file()) if source.exists() else 0
        if v["files"] and size and used + size <= SITE_BYTES:
            shutil.copytree(source, out / "models" / model)
            used += size
            made.append(f"models/{model}")
    (out / "index.html").write_text('<!doctype html><meta charset="utf-8"><title>Batches</title><ul>' + "".join(f'<li><a href="{html.escape(n)}">{html.escape(n)}</a></li>' for n in made) + "</ul>", encoding="utf-8")
    return ["index.html", *made]


class Views:
    """Named views in order; one that fails does not stop the others, and the analysis comes first."""

    def __init__(self):
        self.views: dict[str, Callable[[Pipeline, Path, dict | None], object]] = {}

    def register(self, name: str, view: Callable[[Pipeline, Path, dict | None], object]) -> None:
        if name in self.views:
            raise ValueError(f"view {name} is there already")
        self.views[name] = view

    def render_all(self, pipeline: Pipeline, out: str | Path, only: Iterable[str] | None = None) -> dict[str, str]:
        out, results = Path(out), {}
        try:
            analysis = analyse(pipeline.spark, pipeline.manifests(), pipeline.config.get("reports.min_batches", 3))
            save_json(out / "meta.json", analysis)
            results["meta"] = "ok"
        except Exception as e:  # the other views work without
            analysis, results["meta"] = None, str(e)
        for name, view in self.views.items():
            if only is None or name in only:
                try:
                    view(pipeline, out, analysis)
                    results[name] = "ok"
                except Exception as e:
                    log.exception("view %s failed", name)
                    results[name] = str(e)
        return results


def default_views() -> Views:
    views = Views()
    views.register("text", lambda p, out, a: text_report(p, out, a))
    views.register("html", lambda p, out, a: dashboard(p, out, a))
    views.register("site", lambda p, out, a: site(p, out / "site", a))
    return views
