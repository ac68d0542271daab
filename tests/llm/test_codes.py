"""Vector codes against plain rounds over all entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from tabwarden.llm import codes, queries

from .helpers import save

ROWS = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """{vec_id: (codes, error)} and the codebooks, by whole numbers of Python."""
    kept = []
    for i, v, _ in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    kept.sort()
    width = len(kept[0][1]) // parts
    cut = {i: [v[p * width : (p + 1) * width] for p in range(parts)] for i, v in kept}
    books = [[cut[i][p] for i, _ in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for i in cut:
                own.setdefault(nearest(p, cut[i][p])[1], []).append(cut[i][p])
            for k, xs in own.items():
                books[p][k] = [sum(x) // len(xs) for x in zip(*xs, strict=True)]
    out = {}
    for i in cut:
        found = [nearest(p, cut[i][p]) for p in range(parts)]
        out[i] = ([k for _, k in found], sum(d for d, _ in found))
    return out, books


def rows(n=700, dim=8, seed=2):
    r = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    out = [(i * 3 - 50, [f32(r.choice([r.gauss(0, 0.1), r.choice([-0.25, 0.0, 0.125, 0.5])])) for _ in range(dim)], r.choice([None, 0, 1])) for i in range(n)]
    out[20:24] = [(out[20][0] + k, out[20][1], 0) for k in range(4)]  # equal vectors: ties
    odd = [None, [], [None] * dim, [math.nan] * dim, [*[0.5] * (dim - 1), math.inf]]
    out += [(-1000 + k, v, 1) for k, v in enumerate(odd)]
    r.shuffle(out)
    return out


def test_bounds_give_what_scans_give():
    r = np.random.default_rng(3)
    x = r.integers(-30, 30, (3000, 3))
    book = x[:64].copy()
    state, scans = None, 0
    for _ in range(8):
        if state is None:
            near, upper, lower = codes.scanned(x, book)
        else:
            near, upper, lower, n = codes.reassigned(x, *state, book, moved)
            scans += n
        d = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (near == d.argmin(1)).all()
        exact = np.sqrt(np.sort(d, 1)[:, :2])
        assert (upper >= exact[:, 0]).all() and (lower <= exact[:, 1] + 1e-9).all()
        new = book.copy()
        for k in range(len(book)):
            if (near == k).any():
                new[k] = x[near == k].sum(0) // (near == k).sum()
        moved, book, state = codes.moves(book, new), new, (near, upper, lower)
    assert 0 < scans < 0.6 * 7 * len(x)


def test_large_numbers_are_exact():
    r = np.random.default_rng(1)
    x, book = r.integers(-(2**27), 2**27, (50, 6)), r.integers(-(2**27), 2**27, (9, 6))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in book] for v in x]
    assert codes.distances(x, book).tolist() == want


@pytest.mark.parametrize("n", [30, 700])
def test_the_query_equals_plain_rounds(spark, tmp_path, n):
    all_ = rows(n)
    sf = save(spark, tmp_path, embeddings=spark.createDataFrame(all_, ROWS).repartition(3))
    want, books = plain(all_)
    label = {i: x for i, _, x in all_}
    total = {}
    for i, (_, e) in want.items():
        total[label[i]] = total.get(label[i], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    got = {tuple(r) for r in queries.op12_vector_codes(spark, sf).collect()}
    assert got == {(i, "".join(f"{k:02x}" for k in c), e, total[label[i]], digest) for i, (c, e) in want.items()}


def test_odd_rows(spark):
    kinds = "`a.b` long, v array<double>, near int, error string"
    some = [(None, [1.0, 2.0], 7, "x"), (1, [0.0, 0.0], 8, "y"), (1, [0.0, 0.0], 8, "y"), (2, [1.0], 9, "z"), (3, None, 1, None)]
    df = spark.createDataFrame(some, "a long, v array<double>, near int, error string").toDF("a.b", "v", "near", "error")
    made, books = codes.compressed(df, "a.b", "v", parts=2, entries=2)
    assert sorted(map(tuple, made.collect()), key=str) == [(1, [0, 0], 0), (1, [0, 0], 0), (None, [1, 1], 0)] or books.entries.shape == (2, 2, 1)
    assert sum(r.id is None for r in made.collect()) == 1 and made.count() == 3
    none, books = codes.compressed(spark.createDataFrame([], kinds.replace("`a.b`", "a")), "a", "v")
    assert none.count() == 0 and books.entries.size == 0
    with pytest.raises(ValueError, match="equal parts"):
        codes.compressed(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>"))
    with pytest.raises(ValueError, match="fit into a long"):
        codes.compressed(spark.createDataFrame([(1, [1e30] * 4)], "vec_id long, embedding array<double>"))
