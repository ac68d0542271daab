import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabwarden.llm import queries, urls

from .helpers import save

PAGES = "page_id long, url string, html string"


def judged(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
        host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else default


def pages():
    r = random.Random(1)
    hosts = ["example.com", "a.example.com", "EXAMPLE.Com", "com", "xcom", "net", "sub.example.net", "m.x.org", "org.", "", "user@example.com:80", "Äb.org", "." * 50 + "com"]
    paths = ["/en/7", "/en/", "/en", "/en/77?x=/de/", "/de/8#a", "/de/", "/de", "/es/", "?q=/en/", "#/en/", "", "/EN/7", "/en/7://x"]
    rows = [(i, f"{r.choice(['http', 'https', ''])}://{r.choice(hosts)}{r.choice(paths)}", None) for i in range(400)]
    return rows + [(900, None, ""), (901, "", ""), (902, "no scheme/en/", ""), (903, "a://b://c/en/", ""), (904, "http://example.com/en/" + "7" * 100_000, ""), (904, "http://example.com/en/7", ""), (905, "x\n://net/de/8\nz", "")]


@pytest.mark.parametrize("most", [urls.MAX_RULES, 0])
def test_query_and_join_match_brute_force(spark, tmp_path, most):
    rows = pages()
    df = spark.createDataFrame(rows, PAGES)
    got = queries.op3_url_filters(spark, save(spark, tmp_path, pages=df)) if most else urls.judge_urls(df, queries.URL_RULES, max_rules=0)
    want = sorted((i, *judged(u, queries.URL_RULES)) for i, u, _ in rows)
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == want
    assert {x[4] for x in want} == {"allow", "block"} and len({x[3] for x in want}) == 6


@pytest.mark.parametrize("most", [urls.MAX_RULES, 0])
def test_many_rules(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "ARRAY_RULES", 60)
    r = random.Random(2)
    rules = [(r.choice(urls.VERDICTS), f"h{i % 40}.{r.choice(['com', 'org'])}", f"/p{i}"[: r.choice([1, 2, 3, 4])]) for i in range(500)]
    rules = [(v, h, p) for (h, p), v in {(h, p): v for v, h, p in rules}.items()]
    rows = [(i, f"http://www.h{r.randrange(45)}.{r.choice(['com', 'org'])}/p{r.randrange(600)}", None) for i in range(300)]
    table = spark.createDataFrame([*rules, ("block", None, None)], "verdict string, host string, path string")  # as a table, with a rule that fits nothing
    got = urls.judge_urls(spark.createDataFrame(rows, PAGES), table, default="block", max_rules=most).collect()
    assert sorted((x.page_id, x.host, x.path, x.rule, x.verdict) for x in got) == sorted((i, *judged(u, rules, "block")) for i, u, _ in rows)


def test_no_rules_clashing_names_and_nothing(spark):
    df = spark.createDataFrame([("http://a/b", "old", "x")], "url string, host string, verdict string")
    assert urls.judge_urls(df, []).first().asDict() == {"url": "http://a/b", "host": "a", "path": "/b", "rule": None, "verdict": "allow"}
    assert urls.judge_urls(df.limit(0), queries.URL_RULES).count() == 0
    odd = spark.createDataFrame([(7, "http://a.com/b", 1, 2, 3, 4, None)], "_keys int, url string, _digests int, keys int, digests int, row int, `a b` string")
    for most in (urls.MAX_RULES, 0):
        made = urls.judge_urls(odd, [("block", "com", "/b")], max_rules=most)
        assert made.columns == [*odd.columns, "host", "path", "rule", "verdict"] and tuple(made.first()) == (7, "http://a.com/b", 1, 2, 3, 4, None, "a.com", "/b", "com/b", "block")


def test_digests_are_xxhash64_and_collisions_are_confirmed(spark, tmp_path):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([("com/en/",), ("é",)], "s string").select(F.xxhash64("s")).collect()
    assert [np.uint64(np.int64(r[0])) for r in got] == [xxhash.xxh64_intdigest(s.encode(), 42) for s in ("com/en/", "é")]
    rules = urls.Rules(np.array([7, 7]), np.array([1, 0]), np.array([0, 2, 5]), np.frombuffer(b"aabbb", np.uint8))  # two strings of one digest
    (tmp_path / "f").write_bytes(rules.dumped())
    for held in (rules, urls.Rules.map(str(tmp_path / "f"))):
        assert held.find(np.array([7, 7, 7, 8]), ["bbb", "aa", "c", "aa"]).tolist() == [1, 0, -1, -1]


@pytest.mark.parametrize("most", [urls.MAX_RULES, 0])
def test_block_comes_before_allow_of_one_string(spark, most):
    rules = [("allow", "a.com", "/x"), ("block", "a.com", "/x"), ("block", "B.com", "/"), ("allow", "b.com", "/"), ("allow", "a.com", "/x/y")]
    df = spark.createDataFrame([(1, "http://a.com/x", None), (2, "http://b.com/", None), (3, "http://a.com/x/y", None)], PAGES)
    got = urls.judge_urls(df, rules, max_rules=most).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in got) == [(1, "a.com/x", "block"), (2, "b.com/", "block"), (3, "a.com/x/y", "allow")]


def test_groups_stay_small_whichever_side_is_large(spark, monkeypatch):
    monkeypatch.setattr(urls, "ARRAY_RULES", 200)
    for rules, pages in ((20, 3000), (3000, 20)):
        made = [("block", f"h{i}.org", "/") for i in range(rules)]
        df = spark.createDataFrame([(i, f"http://h{i}.org/x{i}") for i in range(pages)], "page_id long, url string")
        got = {r.page_id: r.verdict for r in urls.judge_urls(df, made, max_rules=0).collect()}
        assert got == {i: "block" if i < rules else "allow" for i in range(pages)}
        groups = urls.groups_for(rules, pages)
        sizes = spark.range(max(rules, pages)).groupBy(F.pmod(F.xxhash64(F.xxhash64(F.concat(F.lit("h"), F.col("id"), F.lit(".org/")))), F.lit(groups))).count()
        assert groups == 15 and sizes.agg(F.max("count")).first()[0] < 1.5 * 200
