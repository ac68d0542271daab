import random

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tabwarden.llm import queries

from .helpers import DOCS, components, save, shingles
from .test_packing import check
from .test_pii import base


def corpus(seed=1):
    r = random.Random(seed)
    v = ["".join(r.choice("abcdefghijklm") for _ in range(r.randint(1, 8))) for _ in range(900)]
    text = lambda n: " ".join(r.choice(v) for _ in range(n))
    items = [text(20) for _ in range(5)]
    docs = {i: text(r.randint(60, 160)) for i in range(400)}
    for i in range(0, 40):  # copies, exact and near
        w = docs[i].split()
        w[r.randrange(len(w))] = "changed"
        docs[500 + i] = docs[i] if i % 2 else " ".join(w)
    for i in range(5):
        docs[600 + i] = f"{text(50)} {items[i]} {text(40)}"
        docs[610 + i] = " ".join(x + "%%%" for x in text(90).split())
        docs[620 + i] = "too short"
        docs[630 + i] = f"{text(70)} mail me: p{i}@example.com or 10.0.0.{i} {text(9)}"
    return docs, items


def test_stages(spark, tmp_path):
    docs, items = corpus()
    rows = [(i, t, ["en", "de"][i % 2], "s", len(t)) for i, t in docs.items()] + [(630, docs[630], "en", "s", len(docs[630])), (None, docs[5], "en", "s", 1), (900, None, None, None, None)]
    sf = save(spark, tmp_path, documents=spark.createDataFrame(rows, DOCS), benchmark=spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    at, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, sf).write.parquet(f"{tmp_path}/{k}")
        at = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(at.collect())
        if k < 4:
            assert at.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    ids = [sorted({r.doc_id for r in x if r.doc_id is not None}) for x in kept]
    assert ids[0] == [i for i in sorted(docs) if not 610 <= i < 630]
    groups = components({i: shingles(docs[i], 5) for i in ids[0]})
    assert ids[1] == [i for i in ids[0] if groups[i] == i] and sum(r.doc_id == 630 for r in kept[1]) == 1
    assert ids[2] == [i for i in ids[1] if not 600 <= i < 605]
    assert ids[3] == ids[2]
    for r in kept[3]:
        if r.doc_id is not None and 630 <= r.doc_id < 635:
            assert "[EMAIL]" in r.text and "[IP]" in r.text and not base(r.text) and r.n_chars == len(r.text)
        elif r.doc_id is not None:
            assert r.text == docs[r.doc_id]
    tokenizer = Tokenizer.from_file(queries.word_tokenizer())
    want = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in kept[3]}
    check([r.asDict() | {"id": r.doc_id, "ids": np.frombuffer(r.ids, "<u4").tolist()} for r in kept[4]], want, 4096)


def test_run_equals_the_stages_on_nothing(spark, tmp_path):
    sf = save(spark, tmp_path, documents=spark.createDataFrame([], DOCS), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_each_row_is_judged_by_its_own_text(spark, tmp_path):
    r = random.Random(5)
    v = ["".join(r.choice("abcdefghijklm") for _ in range(r.randint(2, 8))) for _ in range(900)]
    text = lambda n: " ".join(r.choice(v) for _ in range(n))
    item, one, two, three, four, five, six = [text(n) for n in (20, 90, 100, 110, 80, 95, 105)]
    leak = f"{four} {item}"
    rows = {
        "quality rules": ([(None, "too short"), (None, one), (7, two), (7, "too short"), (7, three)], {(None, one), (7, two), (7, three)}),
        "near-duplicates": ([(None, one), (3, one), (2, f"{one} end"), (None, two), (None, two), (7, three), (7, five), (8, five), (9, three), (9, six), (None, None), (4, "")], {(2, f"{one} end"), (None, two), (7, three), (7, five), (9, six), (None, None), (4, "")}),
        "benchmark decontamination": ([(None, leak), (None, one), (7, two), (7, leak)], {(None, one), (7, two)}),
    }
    sf = save(spark, tmp_path, benchmark=spark.createDataFrame([(0, item)], "item_id long, text string"))
    stages = dict(corpus_pipeline.STAGES)
    for k, (name, (have, want)) in enumerate(rows.items()):
        docs = save(spark, tmp_path / str(k), documents=spark.createDataFrame([(i, t, "en", "s", 1) for i, t in have], DOCS))
        got = [(x.doc_id, x.text) for x in stages[name](spark, spark.read.parquet(f"{docs}/documents.parquet"), sf).collect()]
        assert len(got) == len(want) and set(got) == want, name
