import hashlib
import random
import re

from pyspark.sql import functions as F

from tabwarden.llm import pii, queries

from .helpers import documents, save

#: The base patterns as the contract has them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(n - 9 if n > 9 else n for n in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def base(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return [f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in sorted(out)]


def texts():
    r = random.Random(6)
    parts = ["a@b.c", "x@y", "é@b.co", "+1 (234) 555-1234", "+12345678", "+9", "1.2.3.4", "300.1.1.1", "0255.00.1.9", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "5500005555555559", "@", "+", ".", " ", "-", "é", "\n", "\U0001f600", "12", "a.b+c@d-e.f.g", ".x"]
    made = ["".join(r.choice(parts) + r.choice(["", " ", "", "\n"]) for _ in range(r.choice([1, 3, 8, 40]))) for _ in range(150)]
    return made + [None, "", "1" * 30_000, "a" * 30_000 + "@b.c", "+" * 3000, "1." * 5000, "a@" * 5000, "@b.c" * 3000, "4111 1111 1111 1111 x " * 1500]


def test_base_spans_match_brute_force(spark, tmp_path):
    every = texts()
    sf = save(spark, tmp_path, documents=documents(spark, every).repartition(4))
    got = {r.doc_id: r for r in queries.op8_pii(spark, sf).collect()}
    assert len(got) == len(every)
    for i, t in enumerate(every):
        want = base(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t or "")[:200]
        counts = [sum(x.startswith(k) for x in want) for k in PATTERNS]
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == counts
        assert set(want) <= set(got[i].spans.split(","))


def card(r, length=16):
    """Digits with a right checksum."""
    body = "4" + "".join(r.choice("0123456789") for _ in range(length - 2))
    return next(body + d for d in "0123456789" if luhn([int(c) for c in body + d]))


def planted(seed, count=900):
    """(text, spans to be found) of documents; a third has personal data in forms without a base pattern, a third what only looks like it."""
    r = random.Random(seed)
    fill = lambda n: " ".join(r.choice(["lorem", "ipsum", "dolor", "sit", "amet", "look", "at", "this"]) for _ in range(n))
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    token = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))

    def dotted(number):
        return ".".join(number[i : i + 4] for i in range(0, 16, 4))

    def wrong(number):
        return number[:-1] + str((int(number[-1]) + 1) % 10)

    true = [
        lambda: ("phone", "call us: ", f"(0{digits(3)[1:]}9) 555-{digits(4)}".replace("(00", "(01")), lambda: ("phone", "Telefon ", f"0049 30 {digits(3)} {digits(4)}"), lambda: ("email", "e-mail: ", f"bob{digits(2)} (at) mail{digits(1)} (dot) org"),
        lambda: ("email", "write to ", f"ann{digits(2)} at example dot com"), lambda: ("ip", "host ", f"10[.]{r.randrange(256)}[.]{r.randrange(256)}[.]7"), lambda: ("ip", "server ", f"2001:db8::{r.randrange(16, 4096):x}:a{digits(1)}f"),
        lambda: ("card", "card ", dotted(card(r))), lambda: ("secret", "token = ", token()),
    ]
    false = [lambda: ("on ", f"2015-0{r.randrange(1, 9)}-1{digits(1)}"), lambda: ("order ", wrong(card(r))), lambda: ("nr. ", dotted(wrong(card(r)))), lambda: ("", "".join(r.choice("abcdefgh") for _ in range(24))), lambda: ("isbn ", f"978-3-16-14841{digits(1)}-0"), lambda: ("look ", "at this dot")]
    base = [lambda: f"a{digits(2)}@mail.example.com", lambda: f"+1 ({digits(3)}) 555-{digits(4)}", lambda: f"{r.randrange(256)}.1.{r.randrange(256)}.4", lambda: card(r)]
    out = []
    for i in range(count):
        text, spans = fill(6) + " ", []
        if i % 3 == 0:
            kind, before, said = r.choice(true)()
            text += before
            spans.append(f"{kind}:{len(text)}:{len(text) + len(said)}")
            text += said
        elif i % 3 == 1:
            before, said = r.choice(false)()
            text += before + said
        else:
            text += r.choice(base)()
        out.append((text + " " + fill(6), spans))
    return out


def test_added_spans_have_precision_and_recall(spark):
    rows = planted(2)
    got = pii.find_spans(documents(spark, [t for t, _ in rows])).collect()
    right = added = wanted = 0
    for r in got:
        found = {f"{s.kind}:{s.start}:{s.end}" for s in r.spans if not s.base}
        right, added, wanted = right + len(found & set(rows[r.doc_id][1])), added + len(found), wanted + len(rows[r.doc_id][1])
    assert wanted == 300 and right / wanted >= 0.9 and right / added >= 0.9, (right, added, wanted)


def test_estimation_finds_the_labelers_rates():
    """Votes drawn from known rates are recovered, whatever the share of true spans."""
    r = random.Random(4)
    up, down, counts = [1, 0.9, 0.8, 0.7, 0.6, 0.95, 0.8], [0, 0.3, 0.1, 0.2, 0.3, 0.4, 0.3], {}
    for i in range(20_000):
        y = i % 4 == 0
        votes = [0] + [0 if r.random() < 0.3 else 1 if r.random() < (u if y else d) else 2 for u, d in zip(up[1:], down[1:], strict=True)]
        base = y and i % 8 == 0
        key = (sum(v * 3**k for k, v in enumerate(votes)), base)
        counts[key] = counts.get(key, 0) + 1
    post, rate = pii.estimate(counts)
    for (a, b), u, d in list(zip(rate, up, down, strict=True))[1:]:
        assert abs(a - u) < 0.04 and abs(b - d) < 0.04
    assert all(p == 1 for (_, base), p in post.items() if base) and pii.train([]) and len(pii.train([(3, 5.0, 1.0)])) == len(pii.FEATURES) + 1


def test_clashing_columns_and_long_texts(spark):
    long = ("word +1 (555) 555-1234 and a@b.co, " * 400).strip()
    df = spark.createDataFrame([(1, long, "x", "y"), (None, None, "x", "y")], "doc_id long, text string, spans string, found string")
    got = {r.doc_id: r for r in pii.find_spans(df).select("*", pii.redacted(F.col("text"), F.col("spans")).alias("made")).collect()}
    assert got[None].spans == [] and got[None].found == "y" and got[None].made is None and len(got[1].spans) == 800
    assert got[1].made == ("word [PHONE] and [EMAIL], " * 400).strip()


def test_redaction_and_nothing(spark):
    docs = documents(spark, ["é a@b.c, 1.2.3.4!", "none", None, "a@b.c"])
    got = pii.find_spans(docs)
    made = {r.doc_id: r.t for r in got.select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert made == {0: "é [EMAIL], [IP]!", 1: "none", 2: None, 3: "[EMAIL]"}
    assert pii.find_spans(documents(spark, [])).count() == 0
