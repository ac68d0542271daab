"""Encoding and decoding against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabwarden.llm import bpe, queries

from .helpers import documents, save

LETTERS = "abcdeé'st ,.1\n\t\r  　\x85\x1c​Ж漢字😀🏽ΣAZ"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.byte_tokenizer())


def texts(n=400):
    r = random.Random(5)
    some = [None, "", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "don't we'll I'VE 've", "x" * 3000, " " * 500, "ab" * 700, "é" * 65]
    some += ["".join(r.choice(LETTERS) for _ in range(r.choice([1, 5, 40, 400]))) for _ in range(n)]
    some += ["".join(chr(r.choice([r.randrange(1, 0xD800), r.randrange(0xE000, 0x110000)])) for _ in range(20)) for _ in range(n)]
    return [*some, "a\U000323b0b ՘՘", "same same", "same same"]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_and_texts_are_the_librarys(library):
    vocabulary, all_ = bpe.Vocabulary(queries.byte_tokenizer()), texts()
    bounds, ids = vocabulary.encode(all_)
    back = vocabulary.decode(bounds, ids.astype(np.int64))
    for k, t in enumerate(all_):
        want = ids_of(library, t)
        assert ids[bounds[k] : bounds[k + 1]].tolist() == want and back[k] == (t or "")


def test_any_ids_decode_as_the_librarys_do(library):
    r, vocabulary = random.Random(1), bpe.Vocabulary(queries.byte_tokenizer())
    lists = [[r.randrange(50_257) for _ in range(r.choice([0, 1, 3, 30]))] for _ in range(300)] + [[50_256, 60_000, 220]]
    bounds = np.cumsum([0, *map(len, lists)])
    got = vocabulary.decode(bounds, np.array([i for x in lists for i in x], np.int64))
    assert got == [library.decode(x, skip_special_tokens=False) for x in lists]


def test_long_words_and_short_ones_merge_alike(library, monkeypatch):
    r = random.Random(3)
    words = ["".join(r.choice("0123456789abcdef") for _ in range(n)) for n in (1, 2, 63, 64, 65, 300, 5000)] + ["a" * 200, "aab" * 90]
    for long in (0, 10**9):
        monkeypatch.setattr(bpe, "LONG", long)
        bounds, ids = bpe.Vocabulary(queries.byte_tokenizer()).encode(words)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [ids_of(library, w) for w in words]


def test_a_very_long_text(library):
    r = random.Random(4)
    text = "".join(r.choice("abcdefghij") for _ in range(300_000)) + " word" * 200_000
    bounds, ids = bpe.Vocabulary(queries.byte_tokenizer()).encode([text])
    assert ids.tolist() == ids_of(library, text) and bounds.tolist() == [0, len(ids)]


def test_forgetting_changes_nothing(library):
    vocabulary = bpe.Vocabulary(queries.byte_tokenizer(), remember=3)
    for t in ("a b c d e", "f g a", None, "a<|endoftext|>"):
        assert vocabulary.encode([t])[1].tolist() == ids_of(library, t)


def test_the_query_on_odd_rows(spark, library, tmp_path):
    all_ = texts(30)
    sf = save(spark, tmp_path, documents=documents(spark, all_).repartition(3))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for i, t in enumerate(all_):
        ids = ids_of(library, t)
        want.add((i, len(ids), digest(",".join(map(str, ids))), digest(t or "")))
    assert {tuple(r) for r in queries.op11_bpe(spark, sf).collect()} == want


def test_columns_that_clash_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, "a b", [1], "x"), (5, None, None, None), (5, None, None, None)], "`doc id` long, text string, ids array<int>, `a.b` string")
    made = bpe.encoded(df, queries.byte_tokenizer())
    assert made.columns == ["doc id", "a.b", "ids"]
    assert sorted(map(tuple, made.collect()), key=str) == [(5, None, []), (5, None, []), (None, "x", [64, 275])]
    lists = spark.createDataFrame([([64, None, -3, 275], "t", 1), (None, "t", 2)], "ids array<bigint>, text string, k int")
    assert {tuple(r) for r in bpe.decoded(lists, queries.byte_tokenizer()).collect()} == {(1, "a b"), (2, "")}
    assert bpe.encoded(df.limit(0), queries.byte_tokenizer()).count() == 0
    assert bpe.decoded(lists.limit(0), queries.byte_tokenizer()).count() == 0
    broken = spark.sql("SELECT CAST(unhex('61FF62') AS STRING) AS text")
    assert bpe.decoded(bpe.encoded(broken, queries.byte_tokenizer()), queries.byte_tokenizer()).first()[0] == "a�b"


def test_files_whose_merges_are_out_of_order_are_refused(tmp_path):
    with open(queries.byte_tokenizer(), encoding="utf-8") as f:
        told = json.load(f)
    told["model"]["merges"].reverse()
    (tmp_path / "t.json").write_text(json.dumps(told), encoding="utf-8")
    with pytest.raises(ValueError, match="merge"):
        bpe.Vocabulary(str(tmp_path / "t.json"))


def test_memory_is_bounded_by_words_and_ids():
    made = bpe.Vocabulary(queries.byte_tokenizer())
    r, most = random.Random(2), 0
    for _ in range(16):  # over 300,000 different words
        made.encode([" ".join(str(r.randrange(10**9)) for _ in range(20_000))])
        most = max(most, len(made.known))
    assert most < 300_000
    parts = list(bpe._parts(np.array([0, 5, 240_000, 20_000, 900_000, *[1] * 1200, 0])))
    assert parts == [(0, 3), (3, 4), (4, 5), (5, 505), (505, 1005), (1005, 1206)] and not list(bpe._parts(np.array([], np.int64)))
