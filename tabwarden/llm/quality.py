"""Quality rules: base counts of a text, and robust multivariate outliers for each language and source.

Statistic vectors (logarithms of size, word length, symbol and repetition rates) get a minimum-covariance-determinant
estimate in each (language, source).  Three deterministic starts share medians and median deviations and differ in the correlations:
none, those of the hyperbolic tangents, and those of the spatial signs.  Concentration steps keep the nearest
``support`` of the rows by Mahalanobis distance and estimate mean and covariance anew; after two steps from each start the one with the
least determinant goes on until no group's determinant changes.  Groups meet only as sums, so that a source with a third of all rows is no larger than
another after the map side.  A document is rejected when its distance is beyond the chi-square bound.  Everything is a DataFrame expression.

Defined cases: a null text has no words and fails the base rule; null language or source is a group of its
own; groups under ``min_rows`` are pooled by language, and if still too small, together (``pool`` says which); a pool still too small
rejects nothing and has no distance; repeated rows count as often as they stand; ties in distance are kept together; very long texts are
read whole; rows with a null id are judged like others; columns named like the counts are replaced, others of any name do no
harm; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP_CHARS, discard, let, words_of, written

DIMS = 4
#: The least standard deviation of each dimension: most texts have no symbols and no repetition at all, and a
#: first one (a quoted line, a price) is no outlier.  With the bound of 1e-11, about 9.2 deviations, each dimension can reject by itself:
#: 16 symbols a hundred words, or 39 repeated words and lines a hundred, above what its group has.
FLOOR = (0.10, 0.05, 0.30, 0.40)
_BITS = 20
#: Parts that a group's rows are dealt out to.
SALTS = 32


def repeated_words(words: Column) -> Column:
    """How many words lie in 3-word windows found twice or more.

    Windows sort by 44 bits of their hash and then place, in one number; those of equal hashes are compared word by word.  Longer
    texts than 2**20 words sort pairs of hash and place.
    """

    def covered(places: Column) -> Column:
        zero = F.struct(F.lit(-3).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(places, zero, lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3).cast("bigint"), p - s["last"])).alias("n")), lambda s: s["n"])

    def counted(w: Column) -> Column:
        at = F.sequence(F.lit(0).cast("bigint"), F.size(w).cast("bigint") - 3)
        code = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        same = lambda i, j: F.coalesce((F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2)), F.lit(False))

        def found(items: Column, hash_of, place_of) -> Column:
            like = lambda x, y: F.coalesce(hash_of(x) == hash_of(y), F.lit(False)) & same(place_of(x), place_of(y))
            def again(a: Column, x: Column, k: Column) -> Column:
                before, after = F.get(a, k - 1), F.get(a, k + 1)
                meets = lambda y: F.coalesce(hash_of(x) == hash_of(y), F.lit(False))
                # different windows of one hash: the whole run is looked through
                other = F.exists(a, lambda y: (hash_of(y) == hash_of(x)) & (place_of(y) != place_of(x)) & same(place_of(x), place_of(y)))
                return F.when(like(x, before) | like(x, after), F.lit(True)).when(meets(before) | meets(after), other).otherwise(F.lit(False))

            twice = let(items, lambda a: F.filter(a, lambda x, k: again(a, x, k)))
            return covered(F.sort_array(F.transform(twice, place_of)))

        packed = found(F.sort_array(F.transform(at, lambda i: F.shiftleft(code(i), _BITS).bitwiseOR(i))), lambda x: F.shiftright(x, _BITS), lambda x: x.bitwiseAND(F.lit(2**_BITS - 1)))
        pairs = found(F.sort_array(F.transform(at, lambda i: F.struct(code(i).alias("h"), i.alias("i")))), lambda x: x["h"], lambda x: x["i"])
        return F.when(F.size(w) < 3, F.lit(0).cast("bigint")).when(F.size(w) < 2**_BITS, packed).otherwise(pairs)

    return counted(words)


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    by_word = let(words_of(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(GAP_CHARS)) != "")
    dup = let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))
    long = lambda c: c.cast("bigint")
    word = "_words"
    while word in docs.columns:  # a working name that no column of the caller has
        word += "_"
    return docs.select(
        *[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c not in made],
        by_word.alias(word),
        long(F.length(F.translate(text, GAP_CHARS, ""))).alias("word_chars"),
        long(F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).alias("n_symbols"),
        long(dup).alias("n_dup_lines"),
    ).withColumns({"n_words": F.col(f"{word}.n_words"), "n_repeat_words": F.col(f"{word}.n_repeat_words")}).drop(word)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics of a document."""
    n = F.col("n_words") + 1.0
    return [F.log(n), F.log((F.col("word_chars") + 1.0) / n), F.log1p(100.0 * F.col("n_symbols") / n), F.log1p(100.0 * (F.col("n_repeat_words") + F.col("n_dup_lines")) / n)]


def chi_square(x: float, d: int) -> float:
    """The chi-square distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(d // 2))


def chi_square_bound(p: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, d) < p else (low, mid)
    return high


#: The starts' correlations.
STARTS = ["none", "tanh", "signs"]


def _factored(df: DataFrame, parts: dict) -> DataFrame:
    """(g, names...): for each name and its (mean, covariance) the struct<logdet, m0.., l00..> with the Cholesky factor.

    All names go through a column of the factor together, so that the plan stays short.
    """
    for j in range(DIMS):
        rest = lambda s, i, j=j: parts[s][1](i, j) - sum((F.col(f"l{i}{k}_{s}") * F.col(f"l{j}{k}_{s}") for k in range(j)), F.lit(0.0))
        df = df.withColumns({f"l{j}{j}_{s}": F.sqrt(F.greatest(rest(s, j), F.lit(FLOOR[j] ** 2 / 4))) for s in parts})
        if j + 1 < DIMS:
            df = df.withColumns({f"l{i}{j}_{s}": rest(s, i) / F.col(f"l{j}{j}_{s}") for s in parts for i in range(j + 1, DIMS)})

    def whole(s: str) -> Column:
        logdet = 2 * sum((F.log(f"l{i}{i}_{s}") for i in range(DIMS)), F.lit(0.0))
        return F.struct(logdet.alias("logdet"), *[parts[s][0](i).alias(f"m{i}") for i in range(DIMS)], *[F.col(f"l{i}{j}_{s}").alias(f"l{i}{j}") for i, j in _pairs()])

    return df.select("g", *[whole(s).alias(s) for s in parts])


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(DIMS) for j in range(i + 1)]


def _sums(rows: DataFrame, names: list[str]) -> DataFrame:
    """Mean and covariance factor of each group's rows within the cut of each named model."""
    x = [F.col(f"x{i}") for i in range(DIMS)]
    sums = []
    for s in names:
        within = lambda v, s=s: F.sum(F.when(F.col(f"d_{s}") <= F.col(f"cut_{s}"), v))
        sums += [within(F.lit(1)).alias(f"n_{s}"), *[within(a).alias(f"s{i}_{s}") for i, a in enumerate(x)], *[within(x[i] * x[j]).alias(f"q{i}{j}_{s}") for i, j in _pairs()]]
    df = rows.groupBy("g").agg(*sums).where(f"n_{names[0]} > 0")
    mean = lambda s: lambda i: F.col(f"s{i}_{s}") / F.col(f"n_{s}")
    spread = lambda s: lambda i, j: F.col(f"q{i}{j}_{s}") / F.col(f"n_{s}") - mean(s)(i) * mean(s)(j) + (FLOOR[i] ** 2 if i == j else 0.0)
    return _factored(df, {s: (mean(s), spread(s)) for s in names})


def _starts(sized: DataFrame, min_rows: int) -> DataFrame:
    """The models of the starts for groups with enough rows."""
    middle = lambda c: F.percentile_approx(c, 0.5, 10_000)
    centre = sized.groupBy("g").agg(F.count("*").alias("n"), *[middle(f"x{i}").alias(f"m{i}") for i in range(DIMS)]).where(F.col("n") >= min_rows)
    spread = sized.join(_per_salt(centre), ["g", "salt"]).groupBy("g").agg(*[F.first(f"m{i}").alias(f"m{i}") for i in range(DIMS)], *[F.greatest(1.4826 * middle(F.abs(F.col(f"x{i}") - F.col(f"m{i}"))), F.lit(FLOOR[i])).alias(f"d{i}") for i in range(DIMS)])
    spread = written(spread, "spread")
    at = sized.join(_per_salt(spread), ["g", "salt"]).select("g", *[((F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"d{i}")).alias(f"z{i}") for i in range(DIMS)])
    size = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(DIMS)), F.lit(0.0)))
    way = {"tanh": lambda z: F.tanh(z), "signs": lambda z: z / F.greatest(F.col("size"), F.lit(1e-9))}

    def corr(s: str, i: int, j: int) -> Column:
        a, b = way[s](F.col(f"z{i}")), way[s](F.col(f"z{j}"))
        return F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))

    tied = at.withColumn("size", size).groupBy("g").agg(*[corr(s, i, j).alias(f"r{i}{j}_{s}") for s in way for i, j in _pairs() if i > j])
    df = spread.join(tied, "g")

    def covariance(s: str):
        def of(i: int, j: int) -> Column:
            r = F.lit(float(i == j)) if i == j or s == "none" else 0.999 * F.coalesce(F.col(f"r{i}{j}_{s}"), F.lit(0.0))
            return r * F.col(f"d{i}") * F.col(f"d{j}")

        return of

    return _factored(df, {s: (lambda i: F.col(f"m{i}"), covariance(s)) for s in STARTS})


def _per_salt(model: DataFrame) -> DataFrame:
    """A group's row once for each salt, so that a join deals a large group out."""
    return model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _distances(rows: DataFrame, model: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with d_* for each named model: the squared Mahalanobis distance; null for groups without a model."""
    df, kept = rows.join(_per_salt(model), ["g", "salt"], "left"), rows.columns
    for i in range(DIMS):  # forward substitution
        z = lambda s, i=i: F.col(f"x{i}") - F.col(f"{s}.m{i}") - sum((F.col(f"{s}.l{i}{j}") * F.col(f"z{j}_{s}") for j in range(i)), F.lit(0.0))
        df = df.withColumns({f"z{i}_{s}": z(s) / F.col(f"{s}.l{i}{i}") for s in names})
    return df.select(*kept, *[sum((F.col(f"z{i}_{s}") * F.col(f"z{i}_{s}") for i in range(DIMS)), F.lit(0.0)).alias(f"d_{s}") for s in names])


def _step(sized: DataFrame, model: DataFrame, names: list[str], support: float, then: Callable[[DataFrame], DataFrame] = lambda made: made) -> DataFrame:
    """The models estimated from the rows that are nearest to the named models; what ``then`` makes of them is written."""
    near = _distances(sized, model, names)
    cut = near.groupBy("g").agg(*[F.percentile_approx(f"d_{s}", support, 10_000).alias(f"cut_{s}") for s in names])
    cut = written(cut, "cut")  # of known size, so that Spark need not shuffle the rows to join it
    made = written(then(_sums(near.join(_per_salt(cut), ["g", "salt"]), names)), "model")
    discard(cut)
    return made


def least_determinants(sized: DataFrame, support: float, min_rows: int, most: int = 40, close: float = 1e-3) -> DataFrame:
    """(g, best, settled): the model of each group with enough rows.

    Two steps from each start, then the start with the least determinant goes on.  A group settles alone, when a step changes the
    logarithm of its determinant by less than ``close``, and keeps that model.  Cuts are approximate, so a group may swing for ever: after
    ``most`` steps such a group has the model of the least determinant it has had, and says that it has not settled.
    """
    model = written(_starts(sized, min_rows), "model")
    for _ in range(2):
        last, model = model, _step(sized, model, STARTS, support)
        discard(last)
    first = F.array_min(F.array(*STARTS))
    last, model = model, written(model.select("g", first.alias("best"), first.alias("least"), F.lit(False).alias("settled")), "state")
    discard(last)
    for _ in range(most):

        def after(made: DataFrame, was: DataFrame = model) -> DataFrame:
            now = F.coalesce("now", "best")
            still = F.abs(now["logdet"] - F.col("best.logdet")) < close
            both = was.join(made.select("g", F.col("best").alias("now")), "g", "left")
            return both.select("g", F.when(F.col("settled"), F.col("best")).otherwise(now).alias("best"), F.array_min(F.array(F.col("least"), now)).alias("least"), (F.col("settled") | still).alias("settled"))

        last, model = model, _step(sized, model.select("g", "best"), ["best"], support, after)
        discard(last)
        if model.where(~F.col("settled")).isEmpty():
            break
    return model.select("g", F.when(F.col("settled"), F.col("best")).otherwise(F.col("least")).alias("best"), "settled")


def robust_distances(rows: DataFrame, support: float = 0.75, min_rows: int = 200) -> DataFrame:
    """``rows`` (lang, source, salt and x0, x1, ...) with pool, settled, and d2, scaled so that it is chi-square for normal rows."""
    name = lambda *c: F.to_json(F.struct(*[F.col(x).alias(x) for x in c]))
    sized = rows.withColumns({"g2": name("lang", "source"), "g1": name("lang")})
    groups = sized.groupBy("g2", "g1").agg(F.count("*").alias("n")).withColumn("own", F.col("n") >= min_rows)
    by_lang = groups.where(~F.col("own")).groupBy("g1").agg((F.sum("n") >= min_rows).alias("lang_own"))
    groups = _per_salt(groups.join(by_lang, "g1", "left").select("g2", "own", "lang_own"))
    pool = F.when(F.col("own"), F.lit("own")).when(F.col("lang_own"), F.lit("language")).otherwise("rest")
    sized = sized.join(groups, ["g2", "salt"], "left").withColumn("pool", pool)
    sized = sized.withColumn("g", F.when(F.col("pool") == "own", F.col("g2")).when(F.col("pool") == "language", F.col("g1")).otherwise("rest")).drop("g1", "g2", "own", "lang_own")
    sized = written(sized, "statistics")
    model, q = least_determinants(sized, support, min_rows), chi_square_bound(support, DIMS)
    judged = _distances(sized, model.select("g", "best"), ["best"]).withColumn("d2", F.col("d_best") * (chi_square(q, DIMS + 2) / support))
    settled = _per_salt(model.select("g", "settled"))
    return judged.join(settled, ["g", "salt"], "left").drop("g", "salt", "d_best")


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tail: float = 1e-11, **how) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, pool, settled, distance, kept) of every row."""
    df = docs.select(F.col(id_col).alias("id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col(text_col).alias("text"))
    df = with_counts(df).drop("text").withColumn("base_failed", base_failed())
    df = df.withColumns({f"x{i}": x for i, x in enumerate(vector())}).withColumn("salt", F.floor(F.rand() * SALTS).cast("int"))
    df = written(df, "counts")  # salts are drawn once
    judged = robust_distances(df, **how).withColumn("distance", F.sqrt("d2"))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= chi_square_bound(1 - tail, DIMS))
    return judged.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "pool", "settled", "distance", kept.alias("kept"))
