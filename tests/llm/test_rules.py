import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwarden.llm import contamination, quality, queries

from .helpers import DOCS, documents, save, shingles, words


def repeated(text):
    w = words(text)
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    return len({k for places in at.values() if len(places) > 1 for i in places for k in (i, i + 1, i + 2)})


def dup_lines(text):
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(lines) - len(set(lines))


def texts(seed=4, count=60):
    r = random.Random(seed)
    some = ["a", "b", "c", "Dé", "e#", "$f|", "<g>", "\t", "\n", "\n\n", " a b c", "\x0b", "\x0c\r"]
    return [None, "", " ", "a b", "a b a b a b", "x\nx\n \n \nx", "#\n#"] + [" ".join(r.choice(some[: r.choice([4, 9, 13])]) for _ in range(r.choice([3, 10, 80, 400]))) for _ in range(count)] + ["the cat sat " * 4000]


@pytest.mark.parametrize("bits", [20, 3])
def test_counts_match_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(quality, "_BITS", bits)
    every = texts()
    rows = quality.with_counts(documents(spark, every).withColumnRenamed("n_chars", "n_words")).collect()
    for r in rows:
        t = every[r.doc_id] or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words(t)), sum(map(len, words(t))), len(re.findall(r"[#*$%&|<>]", t)), dup_lines(t), repeated(t)), t[:80]


def test_outliers_go_and_ordinary_documents_stay(spark, tmp_path):
    r = random.Random(2)
    rows = []
    for i in range(1200):
        n = int(r.lognormvariate(5.3, 0.5)) + 60
        w = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 9))) for _ in range(n)]
        if i % 40 == 0:
            w = [x + "%%%" for x in w]
        if i % 40 == 1:
            w = ["longrunofletters" * 6] * 3 + [x * 12 for x in w]
        rows.append((i, " ".join(w), ["en", "de", None][i % 3], "s" if i % 2 else "rare" + str(i), 0))
    save(spark, tmp_path, documents=spark.createDataFrame(rows, DOCS))
    kept = {x.doc_id: x.kept for x in queries.op10_quality_rules(spark, str(tmp_path)).collect()}
    assert not any(kept[i] for i in range(1200) if i % 40 < 2)
    assert sum(kept[i] for i in range(1200) if i % 40 > 1) >= 1138


def concentrated(x, keep, steps=100):
    """Concentration steps from rows to keep: the logarithm of the determinant, mean and covariance."""
    floor, h, last = np.diag(np.array(quality.FLOOR) ** 2), int(np.ceil(0.75 * len(x))), np.inf
    for _ in range(steps):
        mean, cov = x[keep].mean(0), np.cov(x[keep].T, bias=True) + floor
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        keep = d <= np.sort(d)[h - 1]
        det = np.linalg.slogdet(cov)[1]
        if abs(last - det) < 1e-9:
            break
        last = det
    return det, mean, cov


def test_distances_are_those_of_the_least_determinant(spark):
    """Against concentration steps from 200 random starts, on rows of which a fifth is far off along a correlated direction."""
    rng = np.random.default_rng(3)
    mix = np.array([[1, 0, 0, 0], [0.8, 0.6, 0, 0], [0.3, 0.2, 1.5, 0], [0, 0.9, 0.1, 0.8]])
    x = rng.normal(size=(1200, 4)) @ mix.T + [5, 1, 0.5, 1]
    x[::5] += [3, -4, 6, 0]
    x[1] = x[6] = x[11]  # repeated rows
    rows = spark.createDataFrame([("en", "s", i % quality.SALTS, *map(float, r), i) for i, r in enumerate(x)], "lang string, source string, salt int, x0 double, x1 double, x2 double, x3 double, i int")
    got = {r.i: r for r in quality.robust_distances(rows).collect()}
    best = min((concentrated(x, rng.choice(len(x), 60, replace=False)) for _ in range(200)), key=lambda m: m[0])
    want = np.einsum("ij,jk,ik->i", x - best[1], np.linalg.inv(best[2]), x - best[1])
    want *= quality.chi_square(quality.chi_square_bound(0.75, 4), 6) / 0.75
    made = np.array([got[i].d2 for i in range(len(x))])
    assert np.allclose(made, want, rtol=0.02) and {r.pool for r in got.values()} == {"own"}
    assert made[::5].min() > np.quantile(made[np.arange(len(x)) % 5 > 0], 0.99)


def test_chi_square():
    assert abs(quality.chi_square_bound(0.95, 4) - 9.487729) < 1e-5 and abs(quality.chi_square_bound(0.99, 6) - 16.811894) < 1e-5


def test_quality_of_nothing(spark):
    assert quality.judge_quality(documents(spark, [])).count() == 0
    odd = documents(spark, [None, "", "one two"]).withColumns({"salt": F.lit("x"), "g": F.lit("y"), "pool": F.lit("z"), "distance": F.lit(1)})
    got = quality.judge_quality(odd.unionByName(odd.where("doc_id = 2").withColumn("doc_id", F.lit(None).cast("long")))).collect()
    got = [r for r in got if r.id is not None] if sum(r.id is None for r in got) == 1 else []
    assert [(r.n_words, r.base_failed, r.kept) for r in sorted(got, key=lambda r: r.id)] == [(0, True, False), (0, True, False), (2, True, False)]


def contaminated(seed=8):
    """Items and documents that hold none, whole or damaged items."""
    r = random.Random(seed)
    v = [f"w{i}" for i in range(300)]
    items = {i: " ".join(r.choice(v) for _ in range(r.choice([3, 5, 8, 14, 30, 59]))) for i in range(60)}
    items |= {100: None, 101: "", 102: "w1 w2", 103: "w1 w2"}
    docs = []
    for _ in range(150):
        w = [r.choice(v) for _ in range(r.choice([0, 4, 60, 700]))]
        for _ in range(r.choice([0, 1, 3])):
            part = items[r.randrange(60)].upper().split()
            for _ in range(r.choice([0, 0, 1, 2])):
                part[r.randrange(len(part))] = "zz"
            at = r.randrange(len(w) + 1)
            w[at:at] = part
        docs.append(" ".join(w))
    for _ in range(100):  # the first shingle of a long item, and no more
        docs.append(" ".join([r.choice(v) for _ in range(40)] + items[r.choice([i for i in range(60) if len(items[i].split()) > 13])].split()[:5]))
    docs += [None, "", "W1 w2", items[0], " ".join(r.choice(v) for _ in range(150_000)) + " " + items[1]]
    want, near = set(), set()
    mine = {i: shingles(x, 5) for i, x in items.items()}
    for d, t in enumerate(docs):
        a = shingles(t, 5)
        for i, b in mine.items():
            if a & b:
                near.add((d, i))
            if b and 10 * len(a & b) >= 8 * len(b):
                want.add((d, i, len(a & b), len(b)))
    return items, docs, want, near


ITEM = "item_id long, text string"


@pytest.mark.parametrize("send", [500_000, 0])
def test_containment_matches_brute_force(spark, send):
    items, docs, want, _ = contaminated()
    # a column named as a working column, and rows without an id
    table = documents(spark, docs).withColumnRenamed("lang", "hash").withColumnRenamed("source", "w").unionByName(spark.createDataFrame([(None, items[0], "x", "y", 0)], "doc_id long, text string, hash string, w string, n_chars long"))
    got = contamination.contained_items(table, spark.createDataFrame([*items.items(), (None, items[0])], ITEM), send_rows=send)
    assert {tuple(x) for x in got.collect()} == want and len(want) > 60
    left = contamination.decontaminated(table, spark.createDataFrame(list(items.items()), ITEM), send_rows=send)
    assert left.columns == table.columns and sorted((r.doc_id for r in left.collect()), key=str) == sorted([*({*range(len(docs))} - {w[0] for w in want}), None], key=str)


def test_sketches_prune_and_decide(spark):
    items, docs, want, near = contaminated()
    table = documents(spark, docs).select(F.col("doc_id").alias("id"), "text")
    sketch = contamination.sketched(spark.createDataFrame(list(items.items()), "id long, text string"))
    pairs = contamination.candidate_pairs(table, sketch)
    found = {tuple(x) for x in pairs.collect()}
    assert found >= {w[:2] for w in want} and len(found) < 0.6 * len(near), (len(found), len(near), len(want))
    # what the search does not name is not looked at, whatever it holds
    some = sorted(found)[::2]
    kept = contamination.verified(table, sketch, spark.createDataFrame(some, "id long, item long"))
    assert {tuple(x) for x in kept.collect()} == {w for w in want if w[:2] in some}


def test_containment_of_nothing(spark):
    none, one = documents(spark, []), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contamination.contained_items(none, one).count() == 0
    assert contamination.contained_items(documents(spark, ["a b c d e f"]), one.limit(0)).count() == 0
    assert contamination.decontaminated(documents(spark, ["a b c d e f x", "b c", None]), one).count() == 2


def test_groups_that_swing_keep_their_least_determinant(spark, monkeypatch):
    r = random.Random(2)
    rows = [("en", "a", i % 4, *[r.gauss(0, 1) for _ in range(quality.DIMS)]) for i in range(600)] + [("en", "b", i % 4, *[r.gauss(3, 1) for _ in range(quality.DIMS)]) for i in range(400)]
    df = spark.createDataFrame(rows, "lang string, source string, salt int, " + ", ".join(f"x{i} double" for i in range(quality.DIMS)))
    whole, calls = quality._sums, []

    def swing(near, names):
        """From the third step on, the models of one source grow and shrink in turn."""
        made = whole(near, names)
        calls.append(names)
        if names == ["best"]:
            wide = 0.5 if len(calls) % 2 else -0.5
            far = F.col("best").withField("logdet", F.col("best.logdet") + wide)
            made = made.withColumn("best", F.when(F.col("g").contains('"b"'), far).otherwise(F.col("best")))
        return made

    monkeypatch.setattr(quality, "_sums", swing)
    got = quality.robust_distances(df, min_rows=200).collect()
    assert len(got) == 1000 and {(x.source, x.settled) for x in got} == {("a", True), ("b", False)} and all(x.d2 is not None for x in got)


def test_counts_beside_columns_of_any_name(spark):
    df = spark.createDataFrame([("one two", 1, "y", 5)], "text string, _words int, `_w` string, n_words int")
    assert quality.with_counts(df).select("_words", "_w", "n_words").collect() == [(1, "y", 2)]
