import json
import os
import zipfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tabwarden import cli
from tabwarden.plans import inference, registry, reports, training
from tabwarden.plans.config import Config, ConfigError, check_rule
from tabwarden.plans.pipeline import Pipeline, format_duration, runs
from tabwarden.sources import batches, files
from tabwarden.streaming import monthly
from tabwarden.streaming.state import RunState

from .fixtures import config, policies


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    (root / "p.csv").write_text(policies(2))
    with zipfile.ZipFile(root / "p.zip", "w") as z:
        z.write(root / "p.csv", "p.csv")
    data = config(root / "work", root / "p.zip")
    data["sources"] = [{"name": "a", "path": str(root / "p.zip"), "extracted_to": str(root / "raw")}, {"name": "broken", "path": "/nope.csv", "prefix": "b_"}]
    (root / "config.json").write_text(json.dumps(data))
    p = Pipeline(spark, Config.load(root / "config.json"))
    assert p.init() == {"fresh": True, "batches": 2} and p.init()["fresh"] is False
    assert p.update() == {"done": ["2015-01", "2015-02"], "error": None}
    return p, root


def test_update_writes_everything(trained):
    p, root = trained
    ms = p.manifests()
    assert [m["batch"] for m in ms] == ["2015-01", "2015-02"] and set(ms[0]["metrics"]) == {"lr", "dt", "rf", "mlp"}
    assert ms[1]["hyperparameters"]["mlp"]["mode"] in ("partial_fit", "scratch") and ms[1]["rows_used"] > ms[0]["rows_used"]
    assert p.store.indices() == [0, 1] and not p.store.append(0, p.store.load()) and p.store.load(1).select("batch_idx").distinct().count() == 1
    q = files.load_json(p.meta / "quality_0.json")
    assert q["types"][0]["column"] == "PROD_YEAR" and q["profile"]["case_conflicts"][0]["spellings"] == "ISUZU|isuzu"
    assert RunState(p.state.path).remaining == [] and p.update()["done"] == []
    assert {v["model"] for v in p.registry.versions()} == {"lr", "dt", "rf", "mlp"} and len(p.registry.versions()) == 8


def test_inference(trained, spark, tmp_path):
    p, root = trained
    (tmp_path / "new.csv").write_text(policies(1, 60, seed=9))
    got = p.infer(str(tmp_path / "new.csv"), str(tmp_path / "out"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert rows.count() == 60 and rows.columns[-2:] == ["predict", "predict_proba"] and got["status"] == "degraded"
    (tmp_path / "bad.csv").write_text("A,B\n1,2\n")
    with pytest.raises(ValueError, match="rejected"):
        p.infer(str(tmp_path / "bad.csv"), str(tmp_path / "out2"))


def test_reports(trained, tmp_path):
    p, _ = trained
    views = reports.default_views()
    views.register("broken", lambda *a: 1 / 0)
    got = views.render_all(p, tmp_path)
    assert {k: v for k, v in got.items() if k != "broken"} == dict.fromkeys(["meta", "text", "html", "site"], "ok") and "zero" in got["broken"]
    text = (tmp_path / "report.txt").read_text()
    assert "Registry" in text and "<svg" in (tmp_path / "dashboard.html").read_text() and (tmp_path / "site/index.html").exists()
    made = json.loads((tmp_path / "report.json").read_text())
    assert len(made) == 12 and any("PROD_YEAR" in x and "4D" in x for x in made["Types"]) and any(x.startswith("mlp: f1") for x in made["Models"]) and len(made["Time"]) > 5
    assert reports.chart("t", {"a": [1.0, None, 2.0]}).count("M") >= 2 and "no data" in reports.chart("<t>", {"a": []})
    assert runs(p.spark, p.manifests()).count() == 8


def test_external_batches(trained, spark, tmp_path):
    p, root = trained
    c = batches.Collector(spark, str(tmp_path / "t"), ["PREMIUM"], "INSR_BEGIN", "%d-%b-%y")
    (tmp_path / "x.csv").write_text("INSR_BEGIN,PREMIUM\n01-MAR-15,1\n02-MAR-15,2\njunk,3\n")
    assert c.append_external(str(tmp_path / "x.csv")) == "2015-03" and c.periods() == ["2015-03"]
    assert c.describe() == {"batches": 1, "first": "2015-03", "last": "2015-03", "rows": 2}
    c.save(str(tmp_path / "c.json"))
    assert batches.Collector.load(spark, str(tmp_path / "c.json")).describe() == c.describe()
    with pytest.raises(ValueError):
        batches.Collector.load(spark, str(tmp_path / "none.json"))
    with pytest.raises(FileExistsError):
        c.append_external(str(tmp_path / "x.csv"))
    c.append_external(str(tmp_path / "x.csv"), overwrite=True)
    for text, why in (("INSR_BEGIN,PREMIUM\n", "no rows"), ("INSR_BEGIN\n01-MAR-15\n", "missing"), ("INSR_BEGIN,PREMIUM\n01-MAR-15,1\n01-APR-15,1\n", "several"), ("INSR_BEGIN,PREMIUM\nx,1\n", "no date")):
        (tmp_path / "y.csv").write_text(text)
        with pytest.raises(ValueError, match=why):
            c.append_external(str(tmp_path / "y.csv"))
    with pytest.raises(ValueError):
        c.append_external(str(tmp_path / "x.txt"))
    with pytest.raises(FileNotFoundError):
        c.append_external(str(tmp_path / "z.csv"))


def test_cli(trained, spark, tmp_path, capsys):
    _, root = trained
    at = ["--config", str(root / "config.json")]
    assert cli.main(["collect", *at], spark) == 2 and cli.main(["collect", "--describe", "--json", *at], spark) == 0
    assert json.loads(capsys.readouterr().out)["batches"] == 2
    assert cli.main(["collect", "--save", str(tmp_path / "c.json"), "--log", str(tmp_path / "run.log"), *at], spark) == 0 and (tmp_path / "run.log").exists()
    assert batches.Collector.load(spark, str(tmp_path / "c.json")).describe()["batches"] == 2
    assert cli.main(["update", *at], spark) == 0 and cli.main(["infer", "--file", "/nope.csv", *at], spark) == 1 and cli.main(["init", "--config", "/nope.json"], spark) == 1


def test_state(tmp_path):
    s = RunState(tmp_path / "s.json")
    s.init_batches(["a", "b"], "h")
    s.mark_processed("a")
    s.mark_processed("a")
    assert not s.init_batches(["a", "b", "c"], "h") and s.next_batch == "b" and s.last_processed == 0
    assert s.add_batches(["0"]) == ["0"] and s.remaining == ["b", "c", "0"] and s.missing(["a"]) == ["b", "c", "0"]
    assert s.init_batches(["a"], "other") and s.done == []
    files.save_json(tmp_path / "old.json", {"schema_version": 1})
    with pytest.raises(ValueError):
        RunState(tmp_path / "old.json")
    with pytest.raises(KeyError):
        s.mark_processed("nope")


class FileModel:
    """Something to save: a file with a number; ``fails`` stops halfway."""

    def __init__(self, number=0, fails=False):
        self.number, self.fails = number, fails

    def write(self):
        return self

    def save(self, path):
        folder = Path(path.removeprefix("file://"))
        folder.mkdir(parents=True)  # a version's folder is new
        (folder / "a").write_text(str(self.number))
        if self.fails:
            raise OSError("disk full")
        (folder / "b").write_text(str(self.number))


def whole(r):
    """What a reader of a registry finds: the numbers of the production model's two files."""
    v = r.production("lr")
    return v and tuple((r.path(v) / n).read_text() for n in "ab")


def test_readers_find_whole_models_whenever_a_writer_stops(tmp_path, monkeypatch):
    w = registry.Registry(tmp_path)
    assert whole(registry.Registry(tmp_path)) is None
    w.register("lr", 0, FileModel(7), {"f1": 0.3})
    with pytest.raises(OSError, match="disk full"):  # while the files are written
        w.register("lr", 1, FileModel(8, fails=True), {"f1": 0.9})
    assert whole(registry.Registry(tmp_path)) == ("7", "7")
    for step in ("link", "fsync", "replace"):  # while the commit is made
        with monkeypatch.context() as m:
            m.setattr(os, step, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
            with pytest.raises(KeyboardInterrupt):
                w.register("lr", 1, FileModel(8), {"f1": 0.9})
        assert whole(registry.Registry(tmp_path)) == ("7", "7")
    old = registry.Registry(tmp_path)
    w.register("lr", 1, FileModel(8), {"f1": 0.9})
    assert whole(old) == ("7", "7") and whole(registry.Registry(tmp_path)) == ("8", "8")  # the replaced one stays whole for its readers
    with monkeypatch.context() as m:
        m.setattr(registry.shutil, "rmtree", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            w.prune(1)
    assert not registry.Registry(tmp_path).versions("lr")[0]["files"]


def test_two_writers_see_each_others_commits(tmp_path):
    a, b = registry.Registry(tmp_path), registry.Registry(tmp_path)
    a.register("lr", 0, FileModel(1), {"f1": 0.5})
    b.register("lr", 1, FileModel(2), {"f1": 0.4})
    a.register("rf", 0, FileModel(3), {"f1": 0.6})
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: registry.Registry(tmp_path).register("dt", i % 10, FileModel(i), {"f1": i / 100}), range(30)))
    end = registry.Registry(tmp_path)
    assert [v["status"] for v in end.versions("lr")] == ["production", "candidate"] and end.data["best"] == "rf"
    assert sorted(v["batch_idx"] for v in end.versions("dt")) == list(range(10)) and sum(v["status"] == "production" for v in end.versions("dt")) == 1
    assert {p.name for p in (tmp_path / "dt").iterdir()} == {v["folder"].split("/")[1] for v in end.versions("dt")}
    assert len(list((tmp_path / "commits").iterdir())) <= end.kept_commits + 1


def test_gate_and_registry(tmp_path, spark):
    gate = registry.QualityGate(min_f1=0.2, min_roc_auc=0.6, max_regression_f1=0.1, max_psi=0.3)
    assert not gate.evaluate({"f1": 0.5, "roc_auc": None})["passed"] and gate.evaluate({"f1": 0.5, "roc_auc": 0.7})["checks"]["max_psi"]["skipped"]
    assert not gate.evaluate({"f1": 0.3, "roc_auc": 0.7}, {"f1": 0.5})["passed"] and registry.QualityGate().evaluate({"f1": 0.0})["passed"]

    Model = FileModel
    r = registry.Registry(tmp_path, registry.QualityGate(min_f1=0.1))
    status = [r.register("lr", i, Model(), {"f1": f})["status"] for i, f in enumerate([0.3, 0.2, 0.5, 0.05, 0.5])]
    assert status == ["production", "candidate", "production", "rejected", "candidate"] and r.versions("lr")[0]["status"] == "previous"
    assert r.register("lr", 1, Model(), {"f1": 0.9})["status"] == "candidate" and len(r.versions()) == 5
    assert r.prune(0) == 0 and r.prune(1) == 3 and r.prune(1) == 0 and r.production("lr")["batch_idx"] == 2
    assert r.summary()["models"]["lr"] == {"versions": 5, "rejected": 1, "pruned": 3, "last_rejection": 3} and registry.Registry(tmp_path).data["latest"]["batch_idx"] == 4


def test_config_reports_every_mistake(tmp_path):
    data = config(tmp_path, "x.csv")
    assert Config(data).get("quality.max_violation_ratio") == 0.6 and Config(data).hash == Config(json.loads(json.dumps(data))).hash
    bad = {**data, "batching": {"size": "week"}, "quality": {"rules": [{"name": "a", "column": "x", "op": "between", "value": [3, 1]}, {"name": "a", "column": "x", "op": "in", "value": []}, {"op": "zz"}]}}
    del bad["paths"]
    with pytest.raises(ConfigError) as e:
        Config(bad)
    assert len(str(e.value).split("\n")) == 8
    assert check_rule({"column": "x", "op": "ge"}, "r") and not check_rule({"column": "x", "op": "notna"}, "r")
    auto = Config({**data, "inference": {}})
    assert auto.target_positive_rate(tmp_path) == 0.05
    files.save_json(tmp_path / "quality_3.json", {"target": {"rate": 0.11}})
    files.save_json(tmp_path / "quality_10.json", {"target": {"rate": 0}})
    (tmp_path / "quality_11.json").write_text("{broken")
    assert auto.target_positive_rate(tmp_path) == 0.11 and [i for i, _ in files.read_artifacts(tmp_path, "quality_")] == [3, 10]
    assert format_duration(3.21) == "3.2 s" and format_duration(3700) == "1 h 01 min"


def test_fallback_chain_and_fatal_findings(spark):
    from tabwarden.operators.preparation import Preparation

    df = spark.createDataFrame([(float(i), str(i % 2)) for i in range(10)], "x double, c string")
    prep = Preparation(["x"], ["c"]).fit(df)

    class Broken:
        def transform(self, df):
            raise RuntimeError("no")

    got = inference.predict(df, prep, {"rf": Broken(), "lr": Broken()}, "rf")
    assert got.model == "constant" and len(got.notes) == 3 and got.rows.agg(F.sum("predict")).first()[0] == 0
    odd = spark.createDataFrame([("junk", "q"), ("1e9", "1")], "x string, c string")
    _, report = inference.validate_input(odd, prep, {"x": (0.0, 1.0)}, 0.4)
    assert report.status == "rejected" and {f["check"] for f in report.findings} == {"non-numeric values", "unknown categories", "outliers"}
    assert inference.validate_input(df.limit(0), prep)[1].status == "rejected" and inference.validate_input(df, prep)[1].status == "ok"


def test_training_needs_two_classes_and_sweeps(spark):
    df = spark.createDataFrame([(i, float(i % 17), i % 2, int(i % 17 > 9)) for i in range(200)], "i long, x double, c int, y int")
    with pytest.raises(ValueError):
        training.train_batch(df.where("y = 1"), ["x"], ["c"], "y", [F.col("i")])
    with pytest.raises(KeyError):
        training.train_batch(df, ["nope"], [], "y", [F.col("i")])
    got = training.sweep(df, {"a": {"imputer": "median"}, "b": {"imputer": "mean", "scaler": "robust"}, "bad": {"imputer": "zz"}}, ["x"], ["c"], "y", [F.col("i")])
    assert got["winner"] in ("a", "b") and "bad" in got["failed"] and got["results"]["a"]["roc_auc"] > 0.95
    assert got["n_tied"] >= 1 and got["options"] == {"a": {"imputer": "median"}, "b": {"imputer": "mean", "scaler": "robust"}}[got["winner"]]
    assert [r["status"] for r in got["records"]] == ["ok", "ok", "failed"] and got["statistics"] <= 3  # moments, counts, categories: once for all
    alone = training.train_batch(df, ["x"], ["c"], "y", [F.col("i")], prep=got["options"], names=["lr"]).models["lr"].metrics
    assert abs(alone["roc_auc"] - got["results"][got["winner"]]["roc_auc"]) < 1e-9
    cut = training.stratified_split(df, "y", [F.xxhash64("i")])
    assert cut.where("is_validation").groupBy("y").count().orderBy("y").collect()[0]["count"] in range(20, 30)


def test_stream_equals_batch(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    live = monthly.stream(spark, str(tmp_path / "in"), df.schema)
    got = monthly.run_to_table(monthly.monthly_totals(live, "o_orderdate", "o_totalprice"), "totals", str(tmp_path / "c"))
    want = monthly.monthly_totals(df, "o_orderdate", "o_totalprice")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    seen = []
    for _ in range(2):
        monthly.process_available(monthly.stream(spark, str(tmp_path / "in"), df.schema), lambda b, i: seen.append((i, b.count())), str(tmp_path / "c2"))
    assert sum(n for _, n in seen) == df.count() and len({i for i, _ in seen}) == 3
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "e"))
    late = monthly.late_windows(monthly.stream(spark, str(tmp_path / "e"), events.schema), "ts", "event_type")
    assert late.isStreaming


def test_sources_of_a_store_are_hashed_by_listing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    source = batches.Source("a", f"file://{tmp_path}/a.csv")
    one = batches.sources_hash([source], spark)
    assert one == batches.sources_hash([source], spark)
    (tmp_path / "a.csv").write_text("x\n1\n2\n")
    assert one != batches.sources_hash([source], spark)
    assert files.prune_none({"a": None, "b": {"c": None}, "d": [None, {"e": 0}], "f": ""}) == {"d": [{"e": 0}], "f": ""}


def test_sources_are_checked():
    with pytest.raises(ValueError) as e:
        batches.sources_from_config({"sources": [{"name": "a", "path": "x", "share": 2}, {"name": "b", "path": "y"}]})
    assert "share" in str(e.value) and "twice" in str(e.value)
    assert batches.sources_from_config({"dataset": {"path": "x"}})[0].name == "default"
