import hashlib
import random

import numpy as np
import pytest

from tabwarden.llm import neardup, passages, queries
from tabwarden.llm.words import Words

from .helpers import components, documents, lower, save, shingles, words


def _texts(seed=3, count=90):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    made = [" ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 2, 5, 30, 90, 300]))) for _ in range(count)]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    for i in range(count):
        k = r.random()
        if k < 0.25:
            made.append(made[i])
        elif k < 0.6:
            w = made[r.randrange(i + 1)].split()
            for _ in range(max(1, len(w) // r.choice([8, 12, 20, 60]))):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocabulary)
            made.append(" ".join(w))
        elif k < 0.8:
            made[i] = "x " * r.randrange(9) + made[i] + "\n" + passage[r.randrange(100) :] + "\t end"
    made += [None, "", " \n ", "Élan Über é", "ÉLAN über é", "a", "A", "a b", "ab " * 3000, "ab " * 3000]
    return made


def removed(texts, n=13):
    where = {}
    for i, t in enumerate(texts):
        w = words(t)
        for k in range(len(w) - n + 1):
            where.setdefault(tuple(w[k : k + n]), i)
    for i, t in enumerate(texts):
        w, gone = words(t), set()
        for k in range(len(w) - n + 1):
            if where[tuple(w[k : k + n])] < i:
                gone.update(range(k, k + n))
        yield i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()


@pytest.mark.parametrize("size", [4_000_000, 3000])
def test_passages_match_brute_force(spark, size):
    texts = _texts()
    got = passages.repeated_passages(documents(spark, texts), block_bytes=size, bucket_rows=size // 12).collect()
    made = {r.id: (r.id, r.n_words, sum(x.end - x.start for x in r.removed), hashlib.sha256(r.kept.encode()).hexdigest()) for r in got}
    assert sorted(made.values()) == list(removed(texts))


@pytest.mark.parametrize("window", [1, 3, 8, 25])
def test_other_windows(spark, window):
    texts = _texts(5, 40)
    got = passages.repeated_passages(documents(spark, texts), window=window, block_bytes=5000).collect()
    assert {r.id: sum(x.end - x.start for x in r.removed) for r in got} == {x[0]: x[2] for x in removed(texts, window)}


def test_near_duplicates_match_brute_force(spark, tmp_path):
    texts = _texts(11, 120)
    save(spark, tmp_path, documents=documents(spark, texts))
    sets = {i: shingles(t, 2) for i, t in enumerate(texts)}
    want = components(sets)
    assert sum(want[i] != i for i in want) > 20
    got = {r.doc_id: r for r in queries.op5_minhash_near_dedup(spark, str(tmp_path)).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in want}


@pytest.mark.parametrize("chunk", [3, 256])
def test_family_of_borderline_copies(spark, chunk):
    """Most pairs are just below or above the threshold; many chunks."""
    r = random.Random(9)
    base = [f"t{i}" for i in range(150)]
    texts = []
    for i in range(120):
        w = list(base)
        for k in r.sample(range(150), r.choice([2, 8, 9, 10, 11, 12, 30])):
            w[k] = f"n{r.random()}"
        texts.append(" ".join(w))
    sets = {i: shingles(t, 2) for i, t in enumerate(texts)}
    want = components(sets)
    assert 5 < len(set(want.values())) < 100
    assert {x.id: x.component_id for x in neardup.near_duplicates(documents(spark, texts), shingle=2, chunk=chunk).collect()} == want


def test_chain_of_links_is_one_component(spark):
    """Neighbours are similar, the ends are not; only links that miss the hub join them."""
    r = random.Random(1)
    w = [f"t{i}" for i in range(200)]
    texts = []
    for _ in range(40):
        texts.append(" ".join(w))
        for k in r.sample(range(200), 9):
            w[k] = f"n{r.random()}"
    r.shuffle(texts)
    sets = {i: shingles(t, 2) for i, t in enumerate(texts)}
    got = {x.id: x.component_id for x in neardup.near_duplicates(documents(spark, texts), shingle=2).collect()}
    assert got == components(sets) and len(set(got.values())) < 5


def test_empty_null_and_clashing(spark):
    nothing = documents(spark, [])
    assert neardup.near_duplicates(nothing).count() == 0 and passages.repeated_passages(nothing).count() == 0
    odd = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "y"), (None, "a b c", "z"), (2, None, None)], "doc_id long, text string, set string")
    assert sorted(map(tuple, neardup.near_duplicates(odd).collect()), key=str) == sorted([(1, 1, 1), (1, 1, 1), (None, 1, None), (2, 0, 2)], key=str)
    assert sorted(((r.id, r.n_words) for r in passages.repeated_passages(odd).collect()), key=str) == sorted([(1, 3), (1, 3), (2, 0), (None, 3)], key=str)
    # rows without an id are the latest, and none of them is earlier than another; columns with the names of working ones do no harm
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text, 1, "a"), (None, text, 2, "b"), (5, text, 3, "c"), (None, text + " more", 4, "d")]
    for size in (4_000_000, 100):
        got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string, _block int, bucket string"), block_bytes=size).collect()
        assert sorted(((r.id, r.n_words, r.kept) for r in got), key=str) == sorted([(None, 40, ""), (None, 40, ""), (5, 40, text), (None, 41, "more")], key=str)


def test_superminhash_estimates_similarity():
    r = np.random.default_rng(0)
    for n in (3, 60, 2000):
        a = r.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[: n // 2], r.integers(0, 2**63, n - n // 2).astype(np.uint64)])
        sign = neardup.super_minhash(np.concatenate([a, b]), np.array([0, n, 2 * n]), 128)
        assert np.array_equal(np.sort((sign[0] >> np.uint64(32)) >= 0), np.ones(128, bool))
        share, want = (sign[0] == sign[1]).mean(), (n // 2) / (2 * n - n // 2)
        assert abs(share - want) < 0.17
        again = neardup.super_minhash(b, np.array([0, n]), 128)
        assert np.array_equal(again[0], sign[1])


def test_words_are_those_of_the_pattern():
    texts = ["a  b\x0bc d\x1ce", None, "", " Ä b ", "퟿ x" * 3, "y" * 5000]
    w = Words(texts)
    assert [[w.data[a:b].tobytes().decode() for a, b in zip(w.start[p:q], w.end[p:q])] for p, q in zip(w.first, w.first[1:])] == [words(t) for t in texts]
    assert Words(["ABC Éa"], lower=True).data.tobytes().decode().strip() == lower("ABC Éa")
    h, _ = w.grams(1)
    assert len(set(h.tolist())) == len({x for t in texts for x in words(t)})
