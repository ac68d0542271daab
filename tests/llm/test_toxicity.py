import inspect
import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import functions as F

from tabwarden.llm import queries, toxicity
from tabwarden.llm.words import Words

from .helpers import documents, save, words

LABELS = "doc_id long, quality int, toxic int"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def auc(pairs):
    up, down = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in up for b in down) / (len(up) * len(down))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries.op9_toxicity(spark, sf).collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.held_out == held(i) and r.predicted == (r.score >= 0.5) for i, r in got.items())
    rows = [(got[i].score, y) for i, y in toxic.items() if i in got and held(i)]
    assert auc(rows) > 0.85


def test_held_out_labels_are_not_read(spark, tmp_path):
    r = random.Random(0)
    texts = [" ".join(r.choice(["foo", "bar", "baz"] + ["nasty"] * (i % 3 == 0)) for _ in range(20)) for i in range(200)]
    docs = documents(spark, texts)
    rows = [(i, 0, int(i % 3 == 0)) for i in range(200)]
    a = save(spark, tmp_path / "a", documents=docs, labels=spark.createDataFrame(rows, LABELS))
    b = save(spark, tmp_path / "b", documents=docs, labels=spark.createDataFrame([(i, q, 1 - t if held(i) else t) for i, q, t in rows], LABELS))
    one, two = ({x.doc_id: x.score for x in queries.op9_toxicity(spark, f).collect()} for f in (a, b))
    assert one == two
    assert all((one[i] >= 0.5) == (i % 3 == 0) for i in range(200) if held(i))


def test_ratios_match_brute_force(spark):
    texts = [("foo Fob", True), ("bar foo\tfé", False), ("zzzzzzzz foo", False), ("", True)]
    df = spark.createDataFrame(texts, "text string, toxic boolean")
    grams = toxicity._counts(df)
    counts = {True: Counter(), False: Counter()}
    for t, y in texts:
        for w in t.lower().encode().split():
            s = b" " + w + b" "
            for k in range(1, len(s)):
                counts[y][s[max(0, k - 6) : k + 1]] += 1
    number = lambda g: int.from_bytes(g, "big")
    assert {r.gram: (r.toxic, r.ordinary) for r in grams.collect()} == {number(g): (counts[True][g], counts[False][g]) for g in counts[True] | counts[False]}
    ratio, rest = (dict(map(tuple, x.collect())) for x in toxicity.log_ratios(grams))
    every = set(counts[True] | counts[False])

    def own(count, g, below):
        same = [x for x in every if x[:-1] == g[:-1]]
        n, kinds = sum(count[x] for x in same), sum(count[x] > 0 for x in same)
        return max(count[g] - 0.75, 0) / n + 0.75 * kinds / n * below if n else below

    def p(y, g):
        low = len([x for x in every if x[-4:] == g[-4:]]) / len([x for x in every if x[-4:-1] == g[-4:-1]])
        return own(counts[y], g, own(counts[True] + counts[False], g, low))

    for g in every:
        if len(g) >= 4:
            assert math.isclose(ratio[number(g)], math.log(p(True, g) / p(False, g)), abs_tol=1e-9), g
    w = Words(["foo é"], lower=True)
    gram, first = toxicity.byte_grams(w, [0, 1])
    assert [int(x).to_bytes(8, "big").lstrip(b"\0") for x in gram] == [b" f", b" fo", b" foo", b" foo ", b" \xc3", b" \xc3\xa9", b" \xc3\xa9 "] and first.tolist() == [0, 4]


def test_without_labels_or_texts(spark):
    docs = documents(spark, ["a b", None, ""])
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.toxicity_scores(docs, none).collect()} == {0.5}
    assert toxicity.toxicity_scores(documents(spark, []), none).count() == 0
    odd = spark.createDataFrame([(i, 0, None if i == 1 else i % 2) for i in range(60)] + [(None, 0, 1)], LABELS)
    got = toxicity.toxicity_scores(documents(spark, [None if i % 7 == 0 else "a b" * i for i in range(60)]), odd, send_labels=0).collect()
    assert len(got) == 60 and all(0 <= r.score <= 1 for r in got)


def test_models_are_whole_and_read_from_files(spark):
    assert "most_grams" not in inspect.signature(toxicity.toxicity_scores).parameters
    r = random.Random(3)
    texts = [(" ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 9))) for _ in range(40)), i % 3 == 0) for i in range(60)]
    df = spark.createDataFrame(texts, "text string, toxic boolean")
    tables = toxicity.log_ratios(toxicity._counts(df))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = [toxicity.write_ratios(t, t.columns[0]) for t in tables]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert all(len(p) > 1 for p in parts)
    want = [dict(map(tuple, t.collect())) for t in tables]
    for p, w in zip(parts, want, strict=True):
        keys = np.array(sorted({k + d for k in w for d in (-1, 0, 1)} | {-5, 2**60}), np.int64)
        seen, ratio = toxicity.Ratios(p, SparkFiles.get).find(keys)
        assert {int(k): float(x) for k, x, s in zip(keys, ratio, seen, strict=True) if s} == {k: float(np.float32(x)) for k, x in w.items()}
    unseen = [("abcdxyz aaaa é", None)]
    w = Words([t for t, _ in texts + unseen], lower=True)
    gram, first = toxicity.byte_grams(w, np.arange(len(w.hash)))
    one = [want[0].get(g, want[1].get(g >> 8, 0.0)) for g in gram.tolist()]
    assert len(one) > 10_000 and np.allclose(np.add.reduceat(one, first), toxicity.word_evidence(w, *map(toxicity.Ratios, parts)), atol=1e-4)
    none = toxicity.write_ratios(tables[0].limit(0), "gram")
    assert none == [] and not toxicity.Ratios(none).find(np.array([1, 2]))[0].any()


def test_scores_match_brute_force(spark):
    """Mean, peak and top of each text by plain loops over the models' ratios, and the logistic function fitted on them."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    some = [word() for _ in range(60)]
    texts = [" ".join([r.choice(some) for _ in range(r.choice([0, 1, 5, 40, 300]))] + ["vile"] * (i % 3 == 0)) for i in range(150)] + [None, "", "\u2003", "a " * 60_000 + "vile"]
    toxic = {i: int(i % 3 == 0) for i in range(150)}
    # columns with the names of working ones, and rows with no id or the same one
    docs = documents(spark, texts).withColumnsRenamed({"lang": "mean", "source": "words"})
    again = next(i for i in range(150) if held(i))
    docs = docs.unionByName(docs.where(f"doc_id = {again}")).unionByName(docs.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))
    labels = spark.createDataFrame([(i, 0, y) for i, y in toxic.items()], LABELS)
    got = toxicity.toxicity_scores(docs, labels).collect()

    group = lambda i: zlib.crc32(str(i).encode()) % 5
    learn = spark.createDataFrame([(texts[i], bool(y)) for i, y in toxic.items() if group(i) in (1, 2, 3)], "text string, toxic boolean")
    ratio, rest = (dict(map(tuple, x.collect())) for x in toxicity.log_ratios(toxicity._counts(learn)))

    def one(w):
        b, total = b" " + w.lower().encode() + b" ", 0.0
        for k in range(1, len(b)):
            g = int.from_bytes(b[max(0, k - 6) : k + 1], "big")
            total += ratio.get(g, rest.get(g >> 8, 0.0))
        return total

    def features(t):
        each = [one(w) for w in words(t)]
        n = len(each)
        peak = max((sum(each[i : i + 16]) / 16 for i in range(n)), default=0.0)
        top = sorted({w.lower(): x for w, x in zip(words(t), each, strict=True)}.values(), reverse=True)[:3]
        mean, top = sum(each) / max(n, 1), sum(top) / 3
        return [mean, peak, top, math.log1p(n), top * math.log1p(n)]

    made = {i: features(t) for i, t in enumerate(texts)}
    fit = [(made[i], y) for i, y in toxic.items() if group(i) == 4]
    centre, scale, weights = toxicity.fit_logistic(np.array([f for f, _ in fit]), np.array([float(y) for _, y in fit]))
    for x in got:
        i = 4 if x.id is None else x.id
        want = 1 / (1 + math.exp(-(sum((f - c) / s * w for f, c, s, w in zip(made[i], centre, scale, weights, strict=False)) + weights[-1])))
        assert math.isclose(x.score, want, abs_tol=2e-3), (x, want)
    assert sum(x.id == again for x in got) == 2 and [x.held_out for x in got if x.id is None] == [False]
