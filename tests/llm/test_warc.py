import base64
import gzip
import hashlib
import random

from tabwarden.llm import queries, warc

from .helpers import save

PAGES = "page_id long, url string, html string"


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def rows():
    r = random.Random(3)
    same = ["<p>é</p>", "", None, "x" * 50_000]
    out = [(i, f"https://{r.choice('ab')}.Example.{r.choice(['com', 'org'])}/p{r.randrange(6)}?q#f", r.choice([*same, f"<b>{i}</b>\r\n\r\nWARC/1.1"])) for i in range(300)]
    r.shuffle(out)
    return out + [(500, None, "<i>"), (501, "no scheme\r\nX: y", "<i>")]


def test_archives_round_trip(spark, tmp_path):
    data = rows()
    sf = save(spark, tmp_path / "in", pages=spark.createDataFrame(data, PAGES).repartition(3))
    got = {r.page_id: r for r in queries.op7_warc(spark, sf).collect()}
    first = {}
    for i, _, html in sorted(data):
        first.setdefault(html or "", i)
    assert len(got) == len(data)
    for i, _, html in data:
        want = first[html or ""]
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == (len((html or "").encode()), b32(html), "response" if want == i else "revisit", None if want == i else want)


def test_index_is_ordered_and_points_at_records(spark, tmp_path):
    data = rows()
    folder = f"{tmp_path}/warc"
    index = warc.archive_pages(spark.createDataFrame(data, PAGES), file_bytes=4000, range_rows=40, folder=folder)
    got = sorted((r.asDict() for r in index.collect()), key=lambda r: (r["range"], r["place"]))
    assert len({r["range"] for r in got}) > 3 and len({r["file"] for r in got}) > 3
    keys = [(r["url_key"], r["time"], r["id"]) for r in got]
    assert keys == sorted(keys) and len(keys) == len(data)
    texts = {i: html or "" for i, _, html in data}
    for r in got[::7]:
        raw = open(f"{folder}/{r['file']}", "rb").read()
        record = gzip.decompress(raw[r["offset"] : r["offset"] + r["length"]])
        assert record.startswith(b"WARC/1.1\r\n")
        if r["kind"] == "response":
            assert record.split(b"\r\n\r\n", 2)[2][:-4].decode() == texts[r["id"]]
    numbered = warc.histories(index).where("url_key = 'com,example,a)/p1?q'").collect()
    assert sorted(r.capture for r in numbered) == list(range(1, len(numbered) + 1)) and len(numbered) > 5


def test_least_payload_clashing_and_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://x/a", "aa", "r"), (2, "http://x/a", "aa", "r"), (3, None, None, "r"), (4, None, "", "r"), (2, "http://x/a", "aa", "r"), (None, "http://x/a", "aa", "r")], PAGES + ", digest string")
    got = sorted((r.id or 99, r.kind, r.refers_to) for r in warc.archive_pages(df, least=1).collect())
    assert got == [(1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (3, "response", None), (4, "response", None), (99, "revisit", 1)]
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_loser_tree():
    r = random.Random(5)
    for k in range(12):
        runs = [sorted(r.randrange(50) for _ in range(r.choice([0, 1, 9]))) for _ in range(k)]
        assert list(warc.LoserTree([[(x, x) for x in run] for run in runs])) == sorted(x for run in runs for x in run)
