r"""PII: base patterns with checks, and a span classifier learnt by weak supervision.

*Base.*  Four patterns (email, ip, card, phone), leftmost and non-overlapping in each kind, whose matches must pass a check.

*Weak supervision.*  Candidates are the base matches, those that fail their check, and the matches of wider patterns:
written-out and bracketed addresses, national and ``00`` phone numbers, other groupings of digits, IPv6, and long mixed strings
(kind ``secret``, which has no base).  Seven labelers look at a candidate and vote for, against, or abstain: the check, the
shape, a gazetteer, words before it that name its kind, words that name something else, its edges, and its variety of characters.
Expectation-maximisation over the counts of vote combinations estimates how often each labeler is right when it votes, from all
candidates of a kind; base spans are known to be true, and spans that their kind's definition rules out (a wrong checksum, a number over 255,
a date, a spelled-out address without a top-level domain) to be false.  The posteriors are soft labels of the final classifier, logistic in the
span's own features and those of its context (:data:`FEATURES`), which sees no vote; it adds spans, and base ones stay.

Texts are read once: candidates with votes and features are written, and fitting and judging read them.  To the driver go only
counts: at most 5 x 3**7 vote combinations and 5 x 2**13 feature combinations.  Everything is a DataFrame expression.

Patterns are anchored or possessive where that changes no match, and a candidate's context is cut from the text between it and its
neighbours of the same pattern, so that time stays linear in the text's length.

Defined cases: a null text is empty; spans are code points, end exclusive; a candidate that overlaps a base
span of its kind is dropped; repeated rows are judged alike; very long texts are read whole; a column ``spans`` of the input is
replaced, all other columns stay, whatever their names; without candidates nothing is added; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, pieces, starts_of, written

KINDS = ["email", "ip", "card", "phone"]
#: All kinds of candidates; ``secret`` has no base pattern.
EVERY = [*KINDS, "secret"]
#: The base patterns; ``\G`` allows a start within a run after a match that ended there.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"(?:\(at\)|\[at\]|\{at\}|<at>)", r"(?:\.|\x20?\(dot\)\x20?|\x20?\[dot\]\x20?|\x20?\{dot\}\x20?|\x20dot\x20)"
_LABEL = r"[A-Za-z0-9-]{1,63}+"
_BRACKETED = r"(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))"
#: Wider forms.
LOOSE = {
    "email": rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+(?:\x20?{_AT}\x20?{_LABEL}(?:{_DOT}{_LABEL}){{0,8}}+|\x20@\x20{_LABEL}(?:\.{_LABEL}){{1,8}}+|\x20at\x20{_LABEL}(?:\x20dot\x20{_LABEL}){{1,8}}+|@{_LABEL})",
    "ip": rf"(?<![0-9A-Za-z.:])(?:[0-9]{{1,3}}(?:{_BRACKETED}[0-9]{{1,3}}){{3}}|(?:[0-9A-Fa-f]{{1,4}}+:){{7}}[0-9A-Fa-f]{{1,4}}+|(?:[0-9A-Fa-f]{{1,4}}+:){{1,6}}(?::[0-9A-Fa-f]{{1,4}}+){{1,6}})(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z./_-])[0-9]{4}(?:([./_]|\x20{2})[0-9]{4}\1[0-9]{4}\1[0-9]{4}|([./_]|\x20{2})[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z/_-])",
    "phone": r"(?<![0-9A-Za-z+./_-])(?:00[1-9][0-9]{0,2}[\x20./-]?)?(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[\x20./-]{1,2}[0-9]{2,4}){2,5}+(?![0-9A-Za-z/_-])",
    "secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,256}+={0,2}(?![A-Za-z0-9+/_=-])",
}
_TOP = r"(?i)[.\x20)\]}](?:com|org|net|edu|gov|info|io|eu|de|at|ch|fr|es|uk|it|nl)$"
#: Entries of the gazetteer, in the span or beside it: mail hosts and top-level domains, private networks, issuers' numbers, country codes, makers' prefixes.
GAZETTEER = {
    "email": rf"(?i)(?:gmail|yahoo|hotmail|outlook|example|mail[0-9]*)|{_TOP}",
    "ip": r"(?i)^(?:10|127|192.{1,5}168|172.{1,5}(?:1[6-9]|2[0-9]|3[01]))[.\[(]|^(?:fe80|fd[0-9a-f]{2}|2001):",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)",
    "phone": r"^(?:\+|00)(?:1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|^\(?0[1-9]|555",
    "secret": r"^(?:AKIA|ASIA|ghp_|gho_|sk-|sk_|pk_|xox[abp]-|AIza|eyJ|glpat-)",
}
#: Words before a span that name its kind.
BEFORE = {
    "email": "e-?mail|mail|contact|kontakt|correo|courriel|write|address",
    "ip": "ip|ipv4|ipv6|host|server|router|address|adresse|dirección|addr",
    "card": "card|karte|carte|tarjeta|credit|kredit|visa|mastercard|amex",
    "phone": "phone|tel|call|telefon|téléphone|teléfono|mobile|handy|fax|anruf|llamar|whatsapp",
    "secret": "token|secret|key|api[_-]?key|apikey|passw(?:or)?d|pwd|auth|bearer|credential",
}
#: Words before a span that say that it is something else.
OTHER = r"(?i)\b(?:version|release|license|licence|lizenz|isbn|issn|order|invoice|bestellung|commande|pedido|page|seite|figure|fig|chapter|section|sha(?:1|256)?|md5|checksum|commit|revision|uuid|doi|score|year)\b\W{0,3}(?:\w{0,12}\W{1,3})?$"
_DATE = r"^(?:19|20)[0-9]{2}[\x20./-][0-9]{1,2}[\x20./-][0-9]{1,2}$|^[0-9]{1,2}[\x20./-][0-9]{1,2}[\x20./-](?:19|20)[0-9]{2}$"
LABELERS = ["check", "shape", "gazetteer", "before", "other", "edges", "variety"]
#: What the final classifier sees; none of it is a labeler's vote.
FEATURES = ["passes", "usual", "named", "other", "left", "right", "over 12", "over 24", "parted", "over 8 distinct", "digits", "letters", "mixed case"]
_SPAN = "array<struct<start:bigint,end:bigint,said:string,before:string,after:string>>"
_BLOCK = 64


def _luhn(digits: Column) -> Column:
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: let(c.cast("int") * (1 + i % 2), lambda n: n - F.when(n > 9, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda s, n: s + n) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """Whether a match of a base pattern passes its kind's check; for secrets, whether letters and digits mix."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?"
        return match.rlike(rf"^(?:{part})(?:\.(?:{part})){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "secret":
        return (F.length(digits) >= 4) & match.rlike("[A-Za-z].*[A-Za-z]")
    return F.lit(True)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, said, before, after>> of a pattern's leftmost non-overlapping matches, in code points.

    ``before`` and ``after`` are up to 40 and 20 characters of the text between the match and its neighbours.
    """

    def placed(found: Column, gaps: Column) -> Column:
        sizes = F.transform(found, lambda m: F.length(m))
        lengths = F.transform(gaps, lambda g: F.length(g))
        both = let(lengths, lambda g: let(sizes, lambda n: F.zip_with(g, starts_of(F.transform(g, lambda x, i: x + F.coalesce(F.get(n, i), F.lit(0)))), lambda x, s: s + x)))

        def span(m: Column, i: Column, at: Column) -> Column:
            return F.struct(at[i].alias("start"), (at[i] + F.length(m)).alias("end"), m.alias("said"), F.substring(gaps[i], -40, 40).alias("before"), F.substring(gaps[i + 1], 1, 20).alias("after"))

        return let(both, lambda at: F.transform(found, lambda m, i: span(m, i, at)))

    found = let(F.regexp_extract_all(text, F.lit(pattern), 0), lambda m: let(F.split(text, pattern, -1), lambda g: placed(m, g)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _all_base(text: Column, kind: str) -> Column:
    """Base matches with whether they pass."""
    found = F.transform(matches(text, BASE[kind]), lambda m: F.struct(*[m[c].alias(c) for c in ("start", "end", "said", "before", "after")], passes(kind, m["said"]).alias("base")))
    hint = {"email": "@", "phone": "+", "ip": "."}.get(kind)
    none = F.array().cast(_SPAN.replace("after:string", "after:string,base:boolean"))
    return F.when(F.contains(text, F.lit(hint)), found).otherwise(none) if hint else found


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(_all_base(text, kind), lambda m: m["base"])


def _usual(kind: str, said: Column) -> Column:
    """Whether a span has a usual form of its kind."""
    form = {
        "email": r"(?i)^[^@\x20]+@[^@\x20]+\.[a-z]{2,}$|(?:\(at\)|\[at\]|\{at\}|<at>|\x20at\x20).*(?:\(dot\)|\[dot\]|\{dot\}|\x20dot\x20|\.)\x20?[a-z]{2,}$|\x20@\x20.*\.[a-z]{2,}$",
        "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\W{1,5}(?:0|[1-9][0-9]{0,2})){3}$|:.*:",
        "card": r"^[0-9]{13,16}$|^[0-9]{4}(\D{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{4}$|^[0-9]{4}(\D{1,2})[0-9]{6}\2[0-9]{5}$",
        "phone": r"^(?:\+|00)[1-9]|^\([0-9]{2,5}\)[\x20.-]|^0[1-9]|^[0-9]{3}([\x20.-])[0-9]{3}\1[0-9]{4}$",
        "secret": r"^[A-Za-z0-9]{20,}={0,2}$|^[A-Za-z0-9+/]{24,}={0,2}$|^[a-z]{2,4}[-_][A-Za-z0-9_-]{16,}$",
    }
    return said.rlike(form[kind])


def _seen(kind: str, base: Column, m: Column) -> Column:
    """struct<votes, features> of a candidate: votes in base 3 (0 abstains, 1 for, 2 against), features as bits."""
    said, before, after = m["said"], m["before"], m["after"]
    digits, size = F.length(F.regexp_replace(said, "[^0-9]", "")), F.length(said)
    usual, named, other = _usual(kind, said), before.rlike(rf"(?i)(?:^|[^\p{{L}}])(?:{BEFORE[kind]})(?:$|[^\p{{L}}])"), before.rlike(OTHER)
    left = (before == "") | before.rlike(r"[\s\"'(\[<{:=,;|>]$")
    right = (after == "") | after.rlike(r"^(?:[\s\"')\]>},;:|<!?]|\.(?![0-9A-Za-z]))")
    distinct = F.size(F.array_distinct(F.split(F.lower(said), "")))
    # what the kind's check says, of forms that the base pattern does not have as well
    check = {
        "email": F.when(base, 1).when(said.rlike(r"(?i)\x20at\x20") & ~said.rlike(_TOP), 2).otherwise(0),
        "ip": F.when(base, 1).when(said.rlike(r"^[0-9.]+$"), 2).when(said.contains(":") & said.rlike("(?i)[a-f]"), 1).otherwise(0),
        "card": F.when(base, 1).when(digits.between(12, 19) & _luhn(F.regexp_replace(said, "[^0-9]", "")), 1).otherwise(2),
        "phone": F.when(base, 1).when(~digits.between(7, 15) | said.rlike(_DATE), 2).otherwise(0),
        "secret": F.when(passes(kind, said), 1).otherwise(2),
    }[kind]
    plenty = {"email": 6, "ip": 3, "card": 5, "phone": 4, "secret": 10}[kind]
    votes = [check, F.when(usual, 1).otherwise(2), F.when(said.rlike(GAZETTEER[kind]), 1).otherwise(0), F.when(named, 1).otherwise(0), F.when(other, 2).otherwise(0), F.when(left & right, 1).otherwise(2), F.when(distinct >= plenty, 1).otherwise(2)]
    bits = [
        passes(kind, said) if kind != "email" else base, usual, named, other, left, right, size > 12, size > 24, said.rlike(r"[\x20./()-]"), distinct > 8, digits * 2 > size, said.rlike("[A-Za-z]"), said.rlike("[a-z]") & said.rlike("[A-Z]"),
    ]
    code = sum((v * 3**i for i, v in enumerate(votes)), F.lit(0))
    flags = sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0))
    return F.struct(code.alias("votes"), flags.alias("features"))


def _apart(spans: Column, from_: Column) -> Column:
    """Those spans that overlap none of ``from_``, which are in order of their starts and are looked through in blocks."""
    count = F.ceil(F.size(from_) / F.lit(_BLOCK)).cast("int")
    block = lambda b: F.struct(b[0]["start"].alias("start"), F.array_max(F.transform(b, lambda x: x["end"])).alias("end"), b.alias("own"))
    parts = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: F.slice(from_, i * _BLOCK + 1, F.lit(_BLOCK)))
    blocks = F.transform(F.filter(parts, lambda b: F.size(b) > 0), block)
    meets = lambda x, m: (x["start"] < m["end"]) & (m["start"] < x["end"])
    return let(blocks, lambda bs: F.filter(spans, lambda m: ~F.exists(bs, lambda b: meets(b, m) & F.exists(b["own"], lambda x: meets(x, m)))))


def candidates(text: Column) -> Column:
    """array<struct<kind, start, end, base, votes, features>> of a non-null text, by kind."""
    base = F.struct(*[_worth(kind, _all_base(text, kind)).alias(kind) for kind in KINDS])

    def every(found: Column) -> Column:
        ends = lambda kind: F.transform(F.filter(found[kind], lambda m: m["base"]), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
        taken = F.sort_array(F.concat(*[ends(kind) for kind in KINDS]))
        return let(taken, lambda t: F.concat(*[_of_kind(text, number, kind, found[kind] if kind in BASE else None, t) for number, kind in enumerate(EVERY)]))

    return let(base, every)


def _worth(kind: str, found: Column) -> Column:
    """Short numbers that fail the check of cards are everywhere, and no one's."""
    return F.filter(found, lambda m: m["base"] | (F.length(F.regexp_replace(m["said"], "[^0-9]", "")) >= 12)) if kind == "card" else found


def _of_kind(text: Column, number: int, kind: str, own: Column | None, taken: Column) -> Column:
    """The base spans of a kind, and its other matches apart from base spans of all kinds."""

    def item(m: Column, base: Column) -> Column:
        return let(_seen(kind, base, m), lambda seen: F.struct(F.lit(number).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), base.alias("base"), seen["votes"].alias("votes"), seen["features"].alias("features")))

    # texts that cannot have a match are not searched
    hint = {"email": r"@|(?i:[(\[{<]at[)\]}>]|\x20dot\x20)", "ip": r"[0-9A-Fa-f]:|[0-9][\[(]", "phone": r"[0-9)][\x20./-]"}.get(kind)
    wide = matches(text, LOOSE[kind])
    if hint:
        wide = F.when(text.rlike(hint), wide).otherwise(F.array().cast(_SPAN))
    if own is None:
        return F.transform(_apart(wide, taken), lambda m: item(m, F.lit(False)))
    sure = F.transform(F.filter(own, lambda m: m["base"]), lambda m: item(m, F.lit(True)))
    failed = F.transform(_apart(F.filter(own, lambda m: ~m["base"]), taken), lambda m: item(m, F.lit(False)))
    return F.concat(sure, failed, F.transform(_apart(_apart(wide, taken), own), lambda m: item(m, F.lit(False))))


@dataclass(frozen=True)
class SpanModel:
    """For each kind the constant and the features' weights, and each labeler's share of right votes on true and false spans."""

    weights: tuple[tuple[float, ...], ...]
    right: tuple[tuple[tuple[float, float], ...], ...] = field(default=())

    def accepts(self, kind: Column, features: Column) -> Column:
        line = F.lit(None).cast("double")
        for k, w in enumerate(self.weights):
            if w:
                own = sum((F.when(features.bitwiseAND(F.lit(1 << i)) > 0, F.lit(x)).otherwise(F.lit(0.0)) for i, x in enumerate(w[1:])), F.lit(w[0]))
                line = F.when(kind == k, own).otherwise(line)
        return F.coalesce(line > 0, F.lit(False))


def estimate(counts: dict[tuple[int, bool], int], most: int = 500, close: float = 1e-6) -> tuple[dict[tuple[int, bool], float], list[tuple[float, float]]]:
    """Posteriors of (votes, base) and, for each labeler, how often it is for a true and for a false span when it votes (EM).

    Abstaining says nothing.  Base spans are true, and spans that the check votes against are false: the definition of their
    kind rules them out.  At the start a labeler is right four times in five.
    """
    votes = {v: [v[0] // 3**i % 3 for i in range(len(LABELERS))] for v in counts}
    rate, prior, post = [(0.8, 0.2)] * len(LABELERS), 0.5, {}
    for _ in range(most):
        for v in counts:
            up, down = math.log(prior), math.log(1 - prior)
            for (a, b), x in zip(rate, votes[v], strict=True):
                if x:
                    up, down = up + math.log(a if x == 1 else 1 - a), down + math.log(b if x == 1 else 1 - b)
            ruled_out = votes[v][0] == 2
            post[v] = 1.0 if v[1] else 0.0 if ruled_out else 1 / (1 + math.exp(min(50.0, max(-50.0, down - up))))
        loose = [(v, c) for v, c in counts.items() if not v[1] and votes[v][0] != 2]
        prior = (sum(c * post[v] for v, c in loose) + 1) / (sum(c for _, c in loose) + 2)
        share = lambda i, of: (sum(c * of(v) for v, c in counts.items() if votes[v][i] == 1) + 8 * of(None), sum(c * of(v) for v, c in counts.items() if votes[v][i]) + 10)
        # ten made-up votes of each class, four in five right, keep a labeler that was seen little from deciding alone
        up = [share(i, lambda v: 1.0 if v is None else post[v]) for i in range(len(LABELERS))]
        down = [share(i, lambda v: 0.25 if v is None else 1 - post[v]) for i in range(len(LABELERS))]
        before, rate = rate, [(a / n, b / m) for (a, n), (b, m) in zip(up, down, strict=True)]
        if max(abs(x - y) for old, new in zip(before, rate, strict=True) for x, y in zip(old, new, strict=True)) < close:
            break
    return post, rate


def train(rows: list[tuple[int, float, float]], ridge: float = 0.1, most: int = 50) -> tuple[float, ...]:
    """Logistic weights by Newton steps on (features, weight of true, weight of false); a made-up span without features is false."""
    rows = [*rows, (0, 0.0, 1.0)]
    x = np.array([[1.0] + [float(f >> i & 1) for i in range(len(FEATURES))] for f, _, _ in rows])
    up, both, w = np.array([p for _, p, _ in rows]), np.array([p + q for _, p, q in rows]), np.zeros(len(FEATURES) + 1)
    ridges = np.full(len(w), ridge)
    ridges[0] = 1e-6
    for _ in range(most):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (both * p * (1 - p) + 1e-12)) @ x + np.diag(ridges), x.T @ (both * p - up) + ridges * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(a) for a in w)


def fit(found: DataFrame) -> SpanModel:
    """Learn from all rows (kind, votes, features, base) of candidates."""
    votes = found.groupBy("kind", "votes", "base").count().collect()  # at most 5 x 3**7 x 2 rows
    fitted = []
    for k in range(len(EVERY)):
        fitted.append(estimate({(r["votes"], r["base"]): r["count"] for r in votes if r["kind"] == k}))
    known = [(k, v, b, p) for k, (post, _) in enumerate(fitted) for (v, b), p in post.items()]
    posts = found.sparkSession.createDataFrame(known, "kind int, votes int, base boolean, p double")
    soft = found.join(F.broadcast(posts), ["kind", "votes", "base"]).groupBy("kind", "features").agg(F.sum("p").alias("p"), F.sum(1 - F.col("p")).alias("q"))
    rows = soft.collect()  # at most 5 x 2**13
    weights = [[(r["features"], r["p"], r["q"]) for r in rows if r["kind"] == k] for k in range(len(EVERY))]
    return SpanModel(tuple(train(own) if own else () for own in weights), tuple(tuple(rate) for _, rate in fitted))


def find_spans(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, model: SpanModel | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, by default all) with spans, an array<struct<kind, start, end, base>> by start and then kind.

    The texts are read once; candidates are written with the kept columns.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    found = candidates(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    # one struct of what is kept, so that no name clashes
    scanned = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("kept"), found.alias("found")), "candidates", compression="zstd")
    if model is None:
        model = fit(scanned.select(F.inline("found")))
    chosen = F.filter("found", lambda c: c["base"] | model.accepts(c["kind"], c["features"]))
    ordered = F.sort_array(F.transform(chosen, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base"))))
    names = F.array(*map(F.lit, EVERY))
    spans = F.transform(ordered, lambda c: F.struct(names[c["kind"]].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base")))
    return scanned.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], spans.alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; a span that begins inside an earlier one only lengthens it.

    Spans that meet are joined first; then the text is cut in blocks of spans and each block in pieces, so that no
    piece is searched for from the text's begin.
    """
    spot = lambda a, b, kind: F.struct(a.alias("start"), b.alias("end"), kind.alias("kind"))

    def step(s: Column, c: Column) -> Column:
        last = F.element_at(s, -1)
        longer = F.concat(F.slice(s, F.lit(1), F.size(s) - 1), F.array(spot(last["start"], F.greatest(last["end"], c["end"]), last["kind"])))
        return F.when((F.size(s) > 0) & (c["start"] < F.get(s, F.size(s) - 1)["end"]), longer).otherwise(F.concat(s, F.array(spot(c["start"], c["end"], c["kind"]))))

    joined = F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"), step)
    end = F.length(text).cast("bigint")

    def whole(all_: Column) -> Column:
        # the texts before, between and after the spans
        edge = lambda i: F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(all_, i - 1)["end"])
        stop = lambda i: F.coalesce(F.get(all_, i)["start"], end)
        gaps = F.transform(F.sequence(F.lit(0), F.size(all_)), lambda i: F.struct(edge(i).alias("start"), stop(i).alias("end")))
        marks = F.transform(all_, lambda c: F.concat(F.lit("["), F.upper(c["kind"]), F.lit("]")))
        return F.array_join(F.zip_with(pieces(text, gaps), F.concat(marks, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")

    return F.when(F.size(spans) == 0, text).otherwise(let(joined, whole))


def written_out(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string"))), ",")
