"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

A toxic and an ordinary model predict each byte of a word from the six before it, the word's begin included.  Both
back off to one shared model of the counts of all labelled texts, which itself backs off to continuation counts of the
last three bytes: for what neither class has seen they agree, and rare expressions are smoothed alike.

A text's evidence is length-normalised: the mean over its words of log P(toxic) - log P(ordinary), the
highest mean over ``window`` neighbouring words, and the mean of its three highest distinct words, as a few words are thin in a long text.
A logistic function of these and the length, fitted on at most ``fit_rows`` labelled rows that the models have not seen, makes it a score.

Counts cover all labelled rows for training, and every byte sequence counts, however many there are.  The models are Spark
tables; tasks write them as sorted files of key ranges to the shared folder, which executors fetch once and map
into memory.  So a model needs disk on each executor but neither the driver's memory nor the tasks'.

Defined cases: null and blank texts have no evidence and get the score of none; rows without a label are only
scored; rows with a null id are scored and never held out; rows that repeat an id are scored each by their own text; ties of the highest words
are broken by hash; very long texts are read whole; other columns of any name are ignored; several labels of one document all count; without labels of both classes every score is the share of toxic ones, 0.5 without any.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import new_path, written
from .words import Words, slices

DISCOUNT = 0.75
ORDER = 7


def byte_grams(w: Words, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the picked words, and the end of each: seven bytes in a number, from the begin of the word at most.

    The second array says where each word's numbers begin.
    """
    start, size = w.start[pick], w.end[pick] - w.start[pick] + 1
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    at = np.repeat(start, size) + place
    data = np.where(np.isin(w.data, (0x09, 0x0A, 0x0B, 0x0C, 0x0D)), np.uint8(0x20), w.data).astype(np.int64)
    data = np.concatenate([[0x20] * (ORDER - 1), data])  # a text's first word begins like all others
    gram = data[at + ORDER - 1].copy()
    for k in range(1, ORDER):
        gram |= np.where(place + 1 >= k, data[at + ORDER - 1 - k], 0) << (8 * k)
    return gram, first


def _counts(docs: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary) of (text, toxic); each task sums before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]

        def summed() -> None:
            every, where = np.unique(np.concatenate(grams), return_inverse=True)
            both = np.concatenate(counts)
            total = np.stack([np.bincount(where, both[:, c], len(every)) for c in (0, 1)], 1).astype(np.int64)
            grams[:], counts[:] = [every], [total]

        for b in batches:
            for labels, texts in slices(b["toxic"].to_pylist(), (x.as_py() for x in b["text"])):
                w = Words(texts, lower=True)
                if len(w.hash):
                    _, pick, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
                    toxic = np.array(labels, bool)[w.doc]
                    by_word = np.stack([np.bincount(inverse, toxic, len(pick)), np.bincount(inverse, ~toxic, len(pick))], 1)
                    gram, first = byte_grams(w, pick)
                    grams.append(gram)
                    counts.append(np.repeat(by_word, np.diff(np.append(first, len(gram))), axis=0).astype(np.int64))
                    if sum(map(len, grams)) > 3_000_000:
                        summed()
        summed()
        for a in range(0, len(grams[0]), 100_000):
            part = counts[0][a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(grams[0][a : a + 100_000]), pa.array(np.ascontiguousarray(part[:, 0])), pa.array(np.ascontiguousarray(part[:, 1]))], names=["gram", "toxic", "ordinary"])

    return docs.mapInArrow(run, "gram long, toxic long, ordinary long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def log_ratios(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, ratio) and, for what follows a context that was seen without it, (context, ratio)."""
    grams = grams.withColumn("both", F.col("toxic") + F.col("ordinary"))
    kinds = ("toxic", "ordinary", "both")
    context = grams.groupBy(F.shiftright("gram", 8).alias("context")).agg(*[F.sum(c).alias(f"n_{c}") for c in kinds], *[F.count_if(F.col(c) > 0).alias(f"t_{c}") for c in kinds])
    low = F.col("gram").bitwiseAND(F.lit(2**32 - 1))
    lower = grams.groupBy(low.alias("low")).agg(F.count("*").alias("with"))
    lower = lower.join(grams.groupBy(F.shiftright(low, 8).alias("low_context")).agg(F.count("*").alias("all")), F.shiftright("low", 8) == F.col("low_context"))
    lower = lower.select("low", (F.col("with") / F.col("all")).alias("lower"))

    def back(c: str) -> Column:
        """The weight of the model backed off to."""
        return F.when(F.col(f"n_{c}") > 0, DISCOUNT * F.col(f"t_{c}") / F.col(f"n_{c}")).otherwise(F.lit(1.0))

    def p(c: str, below: Column) -> Column:
        own = F.when(F.col(f"n_{c}") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"n_{c}")).otherwise(F.lit(0.0))
        return own + back(c) * below

    full = grams.withColumns({"context": F.shiftright("gram", 8), "low": low}).join(context, "context").join(lower, "low")
    full = full.withColumn("shared", p("both", F.col("lower")))
    return full.select("gram", F.log(p("toxic", F.col("shared")) / p("ordinary", F.col("shared"))).alias("ratio")), context.select("context", F.log(back("toxic") / back("ordinary")).alias("ratio"))


def write_ratios(df: DataFrame, key: str) -> list[tuple[int, str]]:
    """Write (key, ratio) rows as files of key ranges and send them to all executors: the first key and the name of each, in order.

    Only names pass through the driver; files of attempts that failed have other names and are not listed.
    """
    uri = new_path(df.sparkSession, "ratios")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = (b for b in batches if b.num_rows)
        if (b := next(full, None)) is None:
            return
        first, name = b[0][0].as_py(), uuid.uuid4().hex
        store, path = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{name}.keys") as keys, store.open_output_stream(f"{path}/{name}.ratios") as ratios:
            while b is not None:
                keys.write(b[0].to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                ratios.write(b[1].to_numpy(zero_copy_only=False).astype("<f4").tobytes())
                b = next(full, None)
        yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([name])], names=["first", "name"])

    made = df.select(key, "ratio").repartitionByRange(key).sortWithinPartitions(key).mapInArrow(run, "first long, name string")
    parts = sorted(map(tuple, made.collect()))
    for _, name in parts:
        for kind in ("keys", "ratios"):
            df.sparkSession.sparkContext.addFile(f"{uri}/{name}.{kind}")
    return parts


class Ratios:
    """The memory-mapped files of :func:`write_ratios`."""

    def __init__(self, parts: list[tuple[int, str]], where: Callable[[str], str] = SparkFiles.get):
        self.first = np.array([first for first, _ in parts], np.int64)
        self.parts = [(np.memmap(where(f"{name}.keys"), "<i8", "r"), np.memmap(where(f"{name}.ratios"), "<f4", "r")) for _, name in parts]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys, which are in order, are there, and their ratios."""
        seen, ratio = np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
        edge = [*np.searchsorted(keys, self.first), len(keys)]
        for (held, values), a, b in zip(self.parts, edge[:-1], edge[1:], strict=True):
            if a < b:
                at = np.minimum(np.searchsorted(held, keys[a:b]), len(held) - 1)
                seen[a:b], ratio[a:b] = held[at] == keys[a:b], values[at]
        return seen, ratio


def word_evidence(w: Words, grams: Ratios, contexts: Ratios) -> np.ndarray:
    """The log ratio of each word; equal words are looked up once."""
    if not len(w.hash):
        return np.zeros(0)
    _, pick, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
    gram, first = byte_grams(w, pick)

    every, where = np.unique(gram, return_inverse=True)
    seen, ratio = grams.find(every)
    known, rest = contexts.find(every >> 8)
    ratio = np.where(seen, ratio, np.where(known, rest, 0))
    return np.add.reduceat(ratio[where].astype(float), first)[inverse]


def evidence(docs: DataFrame, grams: list[tuple[int, str]], contexts: list[tuple[int, str]], window: int) -> DataFrame:
    """(id, words, mean, peak, top) of (id, text) and the files of the models."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = Ratios(grams), Ratios(contexts)
        for b in batches:
            for ids, texts in slices(b["id"].to_pylist(), (x.as_py() for x in b["text"]), 3_000_000):
                w = Words(texts, lower=True)
                ratio = word_evidence(w, *models)
                total = np.concatenate([[0.0], np.cumsum(ratio)])
                size = np.diff(w.first)
                mean = (total[w.first[1:]] - total[w.first[:-1]]) / np.maximum(size, 1)
                last = np.minimum(np.arange(len(w.hash)) + window, w.first[1:][w.doc])  # windows end with their text
                part = (total[last] - total[:-1]) / window
                peak, full = np.zeros(len(ids)), np.flatnonzero(size)
                if len(full):
                    peak[full] = np.maximum.reduceat(part, w.first[:-1][full])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(size, pa.int64()), pa.array(mean), pa.array(peak), pa.array(_top(w, ratio))], names=["id", "words", "mean", "peak", "top"])

    return docs.mapInArrow(run, "id long, words long, mean double, peak double, top double")


def _top(w: Words, ratio: np.ndarray, most: int = 3) -> np.ndarray:
    """The mean of each text's highest ratios over distinct words; missing ones are 0."""
    order = np.lexsort((w.hash, -ratio, w.doc))
    new = np.ones(len(order), bool)
    new[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
    order = order[new]
    doc = w.doc[order]
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    return np.bincount(doc[rank < most], ratio[order][rank < most], len(w.first) - 1) / most


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights (the last is the constant) by Newton steps."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z, weights = np.column_stack([(x - centre) / scale, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (p - y) + ridge * weights
        bend = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return centre, scale, weights


def remainder(id_: Column) -> Column:
    return F.crc32(id_.cast("string")) % 5


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", window: int = 16, fit_rows: int = 50_000, send_labels: int = 2_000_000) -> DataFrame:
    """(id, held_out, words, mean, peak, top, score).  Labels of rows held out (crc32 of the id divisible by 5) are never read.

    Remainders 1 to 3 make the models, 4 the logistic function.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    labels = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL").where(remainder(F.col("id")) != 0)
    few = labels.limit(send_labels + 1).count() <= send_labels
    sent = lambda df: F.broadcast(df) if few else df
    learn, fit = labels.where(remainder(F.col("id")) != 4), labels.where(remainder(F.col("id")) == 4)
    grams = written(_counts(docs.join(sent(learn), "id").select("text", (F.col("toxic") > 0).alias("toxic"))), "grams")
    grams, contexts = log_ratios(grams)
    scored = written(evidence(docs, write_ratios(written(grams, "gram-ratios"), "gram"), write_ratios(written(contexts, "context-ratios"), "context"), window), "evidence")

    x = {"mean": F.col("mean"), "peak": F.col("peak"), "top": F.col("top"), "size": F.log1p("words"), "top_size": F.col("top") * F.log1p("words")}
    rows = scored.join(sent(fit), "id").orderBy(F.xxhash64("id"), "mean", "toxic").limit(fit_rows).select(*[c.alias(n) for n, c in x.items()], "toxic").toArrow()
    y = (rows["toxic"].to_numpy() > 0).astype(float)
    if len(set(y)) == 2:
        centre, scale, weights = fit_logistic(np.column_stack([rows[c].to_numpy() for c in x]), y)
        line = F.lit(float(weights[-1]))
        for value, c, s, k in zip(x.values(), centre, scale, weights, strict=False):
            line = line + (value - float(c)) * float(k / s)
        score = 1 / (1 + F.exp(-line))
    else:
        score = F.lit(float(y.mean()) if len(y) else 0.5)
    return scored.select("id", F.coalesce(remainder(F.col("id")) == 0, F.lit(False)).alias("held_out"), "words", "mean", "peak", "top", score.alias("score"))
