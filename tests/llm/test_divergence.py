"""Divergences against plain counting in Python's whole numbers."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tabwarden.llm import divergence, queries

from .helpers import documents, lower, save

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=10, most=10):
    """Rows (lang, source, part, item, value, rank) of rows (text, lang, source)."""
    counts, docs, groups = {}, Counter(), set()
    for text, lang, source in rows:
        found = Counter(TERM.findall(lower(text)))
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        counts.setdefault((lang, source), Counter()).update(found)
        docs.update((lang, t) for t in found)
    share = lambda n, total, v: 1 + 10**9 * (n + 2) // (total + 2 * v)
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    out = set()
    for lang in {g[0] for g in groups}:
        terms = [t for (x, t), n in docs.items() if x == lang and n >= least]
        own = {s: {t: counts[lang, s][t] for t in terms} for x, s in groups if x == lang}
        total = {t: sum(c[t] for c in own.values()) for t in terms}
        q = {t: share(total[t], sum(total.values()), len(terms)) for t in terms}
        p = {s: {t: share(c[t], sum(c.values()), len(terms)) for t in terms} for s, c in own.items()}
        for s in own:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in terms)) for o in own if o != s]
            best = [(t, gap(p[s][t], q[t])) for t in terms if own[s][t] and p[s][t] > q[t]]
            for part, found, cut in (("pair", pairs, None), ("term", best, most)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:cut])}
    return out


def rows(n=260, seed=7):
    r = random.Random(seed)
    words = ["aa", "B", "Straße", "ÉTÉ", "été", "漢字", "x", "zz", "É"] + [f"w{chr(97 + i)}" for i in range(26)]
    made = []
    for i in range(n):
        lang = r.choice(["en", "en", "de", None])
        source = r.choice(["s1", "s1", "s1", "s2", "é", "", None, f"s{i % 5}"])
        text = r.choice([None, "", "12 3_4"]) if i % 17 == 0 else "".join(r.choice(words[: 9 + i % 26]) + r.choice([" ", "\n", "\x00", "-", "9", "_"]) for _ in range(r.choice([1, 9, 60])))
        made.append((text, lang, source))
    return made + [("only here", "xx", "a"), (None, "xx", "b"), ("only", "xx", "c"), (None, "yy", None)] + [made[1]] * 3


@pytest.mark.parametrize(("block", "tile"), [(divergence.BLOCK, divergence.TILE), (7, 2)])
def test_blocks_and_tiles_give_what_counting_gives(spark, block, tile):
    made = rows()
    df = spark.createDataFrame([(*x, 1, "n") for x in made], "text string, lang string, source string, rank int, `of_term` string").repartition(5)
    got = divergence.source_divergences(df, block=block, tile=tile).collect()
    assert len(got) == len(set(map(tuple, got))) and {tuple(r) for r in got} == plain(made)


def test_the_query(spark, tmp_path):
    made = rows(120, 3)
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(made)], "doc_id long, text string, lang string, source string")
    assert {tuple(r) for r in queries.op13_source_divergence(spark, save(spark, tmp_path, documents=df)).collect()} == plain(made)


def test_a_very_long_text_is_one_document(spark):
    text = "Ab cd " * 300_000 + "É" * 100_000
    df = documents(spark, [text] + ["ab cd"] * 9)
    got = {(r.part, r.item): r.value for r in divergence.source_divergences(df).collect()}
    assert got == {} or all(k[0] == "term" for k in got)
    assert {tuple(r) for r in divergence.source_divergences(df, least_docs=1).collect()} == plain([(text, "en", "s")] + [("ab cd", "en", "s")] * 9, least=1)


def test_terms_of_one_hash_stay_apart():
    parts = ["b Ab ab abc xyz É é".encode(), b"", b"abc 12 q", b"\xff\xfe a"]
    for digest in (lambda b: 0, lambda b: len(b), None):
        text, code, terms = divergence.terms_of(parts, digest) if digest else divergence.terms_of(parts)
        got = [(t, terms[c]) for t, c in zip(text.tolist(), code.tolist(), strict=True)]
        want = [(0, x) for x in (b"b", b"ab", b"ab", b"abc", b"xyz", "É".encode(), "é".encode())] + [(2, b"abc"), (2, b"q"), (3, b"\xff\xfe"), (3, b"a")]
        assert got == want and len(set(terms)) == len(terms)


def test_shares_of_large_counts_are_exact():
    count = np.array([0, 1, 10**15, 4 * 10**15])
    total = np.array([5, 10**9, 4 * 10**15, 8 * 10**15])
    assert divergence.shares(count, total, 3).tolist() == [1 + 10**9 * (int(c) + 2) // (int(t) + 6) for c, t in zip(count, total, strict=True)]


def test_nothing(spark):
    assert divergence.source_divergences(documents(spark, [])).count() == 0
