"""Benchmark decontamination: which documents contain at least ``share`` of a test item's word shingles.

*Size-partitioned MinHash containment.*  A short item in a long document has next to no Jaccard similarity, so
sketches are taken on the item's side only.  Items are partitioned by the power of two of their size; a
partition's sketch has as many of an item's least hashes as the largest item in it may miss, plus one.  A document
that contains enough of the item then must hold some of the sketch: how many, is known for each
size, so no true pair is lost.  The search (:func:`candidate_pairs`) hashes every document once and joins only sketches;
:func:`verified` then reads the texts of candidates alone and compares their shingles, as strings, with their items'.

Sketches, candidates and item shingles are sent to all tasks only if they have at most ``send_rows`` rows; otherwise they
join by a shuffle, in which a document's salt splits shingles that many documents share.  Everything is a DataFrame expression.

Defined cases: words are A-Z lower-cased; a text shorter than a shingle is one shingle; null and blank texts have
none and match nothing; rows with a null id are not judged (number rows first, as the pipeline does); rows with one
id are one document or item; very long texts are read whole; other columns of any name are ignored by the search and kept by
:func:`decontaminated`; empty tables give no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, words_of, written

#: Parts that the documents with one shingle are dealt out to when it joins by a shuffle.
SALTS = 16


def _words(df: DataFrame) -> DataFrame:
    return df.select("id", words_of(F.translate("text", UPPER, LOWER)).alias("w")).where(F.size("w") > 0)


def _places(n: int) -> Column:
    """The first words of a text's shingles."""
    return F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0))))


def shingle_hashes(df: DataFrame, n: int) -> DataFrame:
    """(id, hash) of each shingle of (id, text): a hash of its words' hashes, each word hashed once."""
    df = _words(df).select("id", F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
    df = df.select("id", "w", _places(n).alias("i"))
    return df.select("id", F.xxhash64(*[F.get("w", F.col("i") + k) for k in range(n)]).alias("hash"))


def shingles(df: DataFrame, n: int) -> DataFrame:
    """(id, hash, shingle) of each shingle, with the same hashes and the words joined by spaces."""
    df = _words(df).select("id", "w", _places(n).alias("i"))
    each = [F.get("w", F.col("i") + k) for k in range(n)]
    hashes = [F.when(x.isNotNull(), F.xxhash64(x)) for x in each]  # a hash of null is not null
    return df.select("id", F.xxhash64(*hashes).alias("hash"), F.concat_ws(" ", *each).alias("shingle"))


def _few(df: DataFrame, most: int) -> bool:
    return df.limit(most + 1).count() <= most


def _join(big: DataFrame, small: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Join; ``small`` is broadcast if it has at most so many rows, else both are dealt out by keys and a salt of the document."""
    if _few(small, most):
        return big.join(F.broadcast(small), keys)
    salted = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, [*keys, "salt"]).drop("salt")


def slots(n: Column, share: float) -> Column:
    """The slots of an item's size partition, and how many of them a document must hold at least."""
    miss = lambda size: F.floor(size * round(1000 * (1 - share)) / 1000)  # noqa: E731  whole thousandths, so that 0.8 misses exactly a fifth
    upper = F.pow(F.lit(2.0), F.floor(F.log2(n)) + 1) - 1
    size = F.least(miss(upper) + 1, n)
    return F.struct(size.alias("slots"), (size - miss(n)).alias("least"))


def sketched(items: DataFrame, shingle: int = 5, share: float = 0.8) -> DataFrame:
    """(item, hash, shingle, n_item, least, in_sketch) of each shingle of items (id, text)."""
    whole = shingles(items, shingle).distinct().withColumnRenamed("id", "item")
    own = Window.partitionBy("item")  # an item is one text
    whole = whole.withColumns({"n_item": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("hash", "shingle"))})
    whole = whole.withColumn("part", slots(F.col("n_item"), share))
    return whole.select("item", "hash", "shingle", "n_item", F.col("part.least").alias("least"), (F.col("rank") <= F.col("part.slots")).alias("in_sketch"))


def candidate_pairs(docs: DataFrame, items: DataFrame, shingle: int = 5, send_rows: int = 500_000) -> DataFrame:
    """(id, item): documents (id, text) that hold enough of the sketch of an item of :func:`sketched`."""
    # two shingles of an item may have one hash: its hits count for both
    sketch = items.where("in_sketch").groupBy("item", "hash", "least").agg(F.count("*").alias("n"))
    hits = _join(shingle_hashes(docs, shingle), sketch, ["hash"], send_rows).groupBy("id", "item", "least", "hash").agg(F.first("n").alias("n"))
    return hits.groupBy("id", "item", "least").agg(F.sum("n").alias("n")).where("n >= least").select("id", "item")


def verified(docs: DataFrame, items: DataFrame, pairs: DataFrame, shingle: int = 5, share: float = 0.8, send_rows: int = 500_000) -> DataFrame:
    """(id, item, n_shared, n_item) of those pairs whose document contains enough of the item's shingles."""
    ids = pairs.select("id").distinct()
    few = docs.join(F.broadcast(ids) if _few(ids, send_rows) else ids.hint("shuffle_hash"), "id", "left_semi")
    # strings decide: hashes only bring shingles together
    found = _join(shingles(few, shingle), items.select("item", "hash", "shingle", "n_item"), ["hash", "shingle"], send_rows)
    once = found.groupBy("id", "item", "n_item", "hash", "shingle").agg(F.lit(1).alias("hit"))
    shared = once.join(pairs, ["id", "item"], "left_semi").groupBy("id", "item", "n_item").agg(F.count("*").alias("n_shared"))
    enough = F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(round(share * 1000)) / 1000)
    return shared.where(enough).select("id", "item", "n_shared", "n_item")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", shingle: int = 5, share: float = 0.8, send_rows: int = 500_000) -> DataFrame:
    """Pairs (id, item, n_shared, n_item)."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    items = items.select(F.col(item_col).alias("id"), F.col(item_text).alias("text")).where("id IS NOT NULL")
    items = written(sketched(items, shingle, share), "items")
    pairs = written(candidate_pairs(docs, items, shingle, send_rows), "candidates")
    return verified(docs, items, pairs, shingle, share, send_rows)


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """``docs`` without those that contain an item."""
    bad = contained_items(docs, items, id_col, **how).select(F.col("id").alias(id_col)).distinct()
    return docs.join(bad.hint("shuffle_hash"), id_col, "left_anti")  # alike at every size, and texts are not sorted
