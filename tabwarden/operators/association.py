"""Association rules between column values, mined once and checked on later batches."""

from __future__ import annotations

import itertools
import json
import math
import os
from collections.abc import Iterable
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .quality import MISSING

ITEM = "struct<column:string,value:string>"


def _item(c: str) -> Column:
    return F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("value"))


def itemsets(df: DataFrame, columns: list[str], min_support: float, max_len: int = 2) -> DataFrame:
    """(items, n, rows, support) of all itemsets of up to ``max_len`` values that are frequent enough.

    Each row gives its own combinations, which are counted before the shuffle: one scan, no self-join.
    """
    combos = [F.array(*[_item(c) for c in some]) for k in range(1, max_len + 1) for some in itertools.combinations(columns, k)]
    rows = df.count()
    counts = df.select(F.explode(F.array(*combos)).alias("items")).groupBy("items").agg(F.count("*").alias("n"))
    return counts.withColumn("rows", F.lit(rows).cast("long")).withColumn("support", F.col("n") / F.lit(float(max(rows, 1)))).where(F.col("support") >= min_support)


def apriori_itemsets(df: DataFrame, columns: list[str], min_support: float, max_len: int) -> DataFrame:
    """The same level by level: sets of k values are looked for only where all their parts of k - 1 values are frequent.

    Rows of equal values are one row with a weight.  Candidates are a tree dealt out by prefix: two frequent sets that differ in their last
    value make one, and a prefix has the list of values that may follow, at most 1 / min_support a column.  Rows meet the tree by a join on the
    frequent sets that they have, so no task holds more than the followers of its prefixes, and nothing needs to be broadcast.
    """
    rows = df.count()
    each = df.select(F.array(*[_item(c) for c in columns]).alias("row")).groupBy("row").agg(F.count("*").alias("w"))
    order = F.array(*map(F.lit, columns))
    place = lambda x: F.array_position(order, x["column"])
    have = each.select("row", "w", F.explode("row").alias("x")).select("row", "w", F.array("x").alias("items"))
    found = None
    for k in range(1, max_len + 1):
        if k > 1:
            have = have.join(_followers(level, k, place), have["items"] == F.col("prefix")).select("row", "w", "items", F.explode(F.array_intersect("row", "next")).alias("x"))
            have = have.select("row", "w", F.concat("items", F.array("x")).alias("items"))
        level = written(have.groupBy("items").agg(F.sum("w").alias("n")).where(F.col("n") / F.lit(float(max(rows, 1))) >= min_support), "itemsets")
        have = have.join(level.select("items"), "items", "left_semi")
        found = level if found is None else found.unionByName(level)
    return found.select("items", "n", F.lit(rows).cast("long").alias("rows"), (F.col("n") / F.lit(float(max(rows, 1)))).alias("support"))


def _followers(level: DataFrame, k: int, place) -> DataFrame:
    """(prefix, next) of the candidates of k values: the values that may follow a frequent set of k - 1."""
    stem, last = F.slice("items", 1, k - 2), F.element_at("items", -1)
    ends = level.select(stem.alias("stem"), last.alias("last"))
    pairs = ends.join(ends.select(F.col("stem").alias("_stem"), F.col("last").alias("after")), F.col("stem") == F.col("_stem")).where(place(F.col("last")) < place(F.col("after")))
    made = pairs.select(F.concat("stem", F.array("last")).alias("prefix"), "after")
    for i in range(k - 2):  # the other parts of k - 1 values have to be frequent too
        part = F.concat(F.slice("prefix", 1, i), F.slice("prefix", i + 2, k), F.array("after"))
        made = made.withColumn("_part", part).join(level.select(F.col("items").alias("_part")), "_part", "left_semi").drop("_part")
    return made.groupBy("prefix").agg(F.collect_list("after").alias("next"))


def fpgrowth_itemsets(df: DataFrame, columns: list[str], min_support: float, max_len: int) -> DataFrame:
    """The same by FP-growth, dealt out by item, for longer itemsets.

    Rows of equal values are one row with a weight, and so are equal conditional rows; what a task reads grows with the variety of rows, not with
    their number, and nothing is kept in memory beside it.
    """
    rows = df.count()
    least = F.col("n") / F.lit(float(max(rows, 1))) >= min_support
    each = written(df.select(*[_item(c).alias(f"c{k}") for k, c in enumerate(columns)]).groupBy(*[f"c{k}" for k in range(len(columns))]).agg(F.count("*").alias("w")), "rows")
    items = each.select("w", F.explode(F.array(*[f"c{k}" for k in range(len(columns))])).alias("x")).groupBy("x").agg(F.sum("w").alias("n")).where(least)
    frequent = [(r["x"], r["n"]) for r in items.select("x", "n").orderBy(F.desc("n"), "x").collect()]  # at most 1 / min_support a column
    named = df.sparkSession.createDataFrame([(k, x) for k, (x, _) in enumerate(frequent)], f"id int, x {ITEM}")
    rank = [F.broadcast(named.where(F.col("x")["column"] == c).select(F.col("id").alias(f"r{k}"), F.col("x").alias(f"c{k}"))) for k, c in enumerate(columns)]
    for k, r in enumerate(rank):
        each = each.join(r, f"c{k}", "left")
    path = each.select("w", F.array_sort(F.array_compact(F.array(*[f"r{k}" for k in range(len(columns))]))).alias("path"))
    below = path.select("w", F.posexplode("path").alias("at", "item"), "path").select("item", F.slice("path", 1, F.col("at")).alias("path"), "w")
    bases = below.groupBy("item", "path").agg(F.sum("w").alias("w"))
    need = next((n for n in range(math.ceil(rows * min_support) - 1, rows + 1) if n / max(rows, 1) >= min_support), rows + 1)

    def grown(base: pd.DataFrame) -> pd.DataFrame:
        item = int(base["item"].iloc[0])
        found = _grown(_merged(zip(map(tuple, base["path"]), base["w"].tolist(), strict=True)), (item,), need, max_len)
        return pd.DataFrame({"ids": [list(i) for i, _ in found], "n": [n for _, n in found]})

    sets = bases.groupBy("item").applyInPandas(grown, "ids array<int>, n long")
    order = F.array(*map(F.lit, columns))
    place = lambda x: F.array_position(order, x["column"]).cast("int")
    told = F.array_sort(F.transform("ids", lambda i: F.col("known")[i]), lambda a, b: place(a) - place(b))
    known = F.broadcast(named.agg(F.array_sort(F.collect_list(F.struct("id", "x"))).alias("known")).select(F.transform("known", lambda k: k["x"]).alias("known")))
    return sets.crossJoin(known).select(told.alias("items"), "n", F.lit(rows).cast("long").alias("rows"), (F.col("n") / F.lit(float(max(rows, 1)))).alias("support"))


def _merged(base: Iterable[tuple[tuple, int]]) -> dict[tuple, int]:
    out: dict[tuple, int] = {}
    for path, w in base:
        out[path] = out.get(path, 0) + w
    return out


def _grown(base: dict[tuple, int], suffix: tuple, need: int, most: int) -> list[tuple[tuple, int]]:
    """The frequent sets that end in ``suffix``, whose conditional rows are ``base``."""
    total = sum(base.values())
    if total < need:
        return []
    out, counts = [(suffix, total)], {}
    if len(suffix) < most:
        for path, w in base.items():
            for i in path:
                counts[i] = counts.get(i, 0) + w
        for i, n in counts.items():
            if n >= need:
                out += _grown(_merged((p[: p.index(i)], w) for p, w in base.items() if i in p), (i, *suffix), need, most)
    return out


def _label(items: Column) -> Column:
    return F.transform(items, lambda x: F.concat(x["column"], F.lit("="), x["value"]))


def rules_of(sets: DataFrame) -> DataFrame:
    """Every split of a frequent itemset into antecedents and consequents, with support, confidence and lift."""
    sides = sets.where(F.size("items") > 1).select("items", "n", "rows", "support", F.explode(F.expr("sequence(1, shiftleft(1, size(items)) - 2)")).alias("mask"))
    part = lambda want: F.filter("items", lambda x, i: (F.floor(F.col("mask") / F.pow(F.lit(2.0), i)) % 2) == want)
    sides = sides.select("n", "rows", "support", part(1).alias("antecedents"), part(0).alias("consequents"))
    count = lambda side, name: sets.select(F.col("items").alias(side), F.col("n").alias(name))
    made = sides.join(count("antecedents", "n_antecedent"), "antecedents").join(count("consequents", "n_consequent"), "consequents")
    confidence = F.col("n") / F.col("n_antecedent")
    label = F.concat(F.array_join(_label(F.col("antecedents")), " ∧ "), F.lit(" → "), F.array_join(_label(F.col("consequents")), " ∨ "))
    return made.select(label.alias("label"), "antecedents", "consequents", "support", confidence.alias("confidence"), (confidence * F.col("rows") / F.col("n_consequent")).alias("lift"))


def majority_items(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column's most frequent value (the smallest of equals) as an item."""
    counts = df.select(F.explode(F.array(*[_item(c) for c in columns])).alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    return counts.groupBy(F.col("item.column").alias("column")).agg(F.min_by("item", F.struct((-F.col("n")).alias("n"), F.col("item.value"))).alias("item")).select("item")


def mine_rules(
    df: DataFrame, columns: list[str], min_support: float = 0.01, min_confidence: float = 0.5, min_lift: float = 1.2, max_len: int = 2,
    n_rules: int = 5, algorithm: str = "counts", exclude_majority_consequent: bool = False,
) -> DataFrame:
    """The best rules by lift, confidence and support (then label)."""
    columns = [c for c in columns if c in df.columns]
    sets = {"counts": itemsets, "apriori": apriori_itemsets, "fpgrowth": fpgrowth_itemsets}[algorithm](df, columns, min_support, max_len).persist()
    made = rules_of(sets).where(F.col("confidence") >= min_confidence)
    if exclude_majority_consequent:
        usual = F.broadcast(majority_items(df, columns).agg(F.collect_set("item").alias("_usual")))  # one item a column
        made = made.join(usual).where(~F.arrays_overlap("consequents", "_usual")).drop("_usual")
    best = made.where(F.col("lift") >= min_lift).orderBy(F.desc("lift"), F.desc("confidence"), F.desc("support"), "label").limit(n_rules)
    rows = best.collect()  # n_rules at most
    sets.unpersist()
    return df.sparkSession.createDataFrame(rows, best.schema)


def rule_statistics(rules: DataFrame) -> DataFrame:
    return rules.agg(F.count("*").alias("n_rules"), F.max("lift").alias("max_lift"), F.avg("lift").alias("mean_lift"), F.avg("confidence").alias("mean_confidence"), F.avg("support").alias("mean_support"))


def save_rules(rules: DataFrame, path: str) -> list[dict]:
    """Write the (few) rules as JSON; an empty list is written, too."""
    found = [r.asDict(recursive=True) for r in rules.collect()]
    part = Path(f"{path}.part")
    part.write_text(json.dumps(found, ensure_ascii=False, indent=1))
    os.replace(part, path)
    return found


def load_rules(path: str) -> list[dict] | None:
    try:
        return json.loads(Path(path).read_text())
    except (FileNotFoundError, ValueError):
        return None
