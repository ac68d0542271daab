"""URL filters: sorted arrays of 64-bit digests of the rules, probed by vectorised binary search, strings confirmed.

Spark makes the candidate strings of a URL (the suffixes of its host that have as many labels as some rule's, each with
the path prefixes that are as long as that rule's) and their xxhash64 digests.  Tasks look all digests of a
batch up at once in the sorted array and compare the stored strings, so that a collision of digests never decides.

Rules within ``max_rules`` and ``MAX_RULE_BYTES`` are one file in the shared folder, which each executor fetches once and maps into memory.
More rules are dealt out by their digests into arrays of bounded size, and the distinct candidates with them; what fits comes back
by a salted join.  The array and the probe are the same; no size changes a result.

Defined cases: a null URL or one without ``://`` has empty host and path and gets the default verdict;
of several rules the longest string wins; equal rule strings: block before allow; null hosts or paths of rules are empty; rows repeat as they
came; very long URLs are read whole; columns host, path, rule and verdict of the input are replaced, all others stay, whatever their
names; no rules: everything gets the default; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, new_path, written

#: Up to so many rules and bytes of them are one file for every executor.
MAX_RULES, MAX_RULE_BYTES = 5_000_000, 400_000_000
#: Rules of one array beyond that, about, and the parts that rows with one fitting rule are dealt out to.
ARRAY_RULES, SALTS = 1_000_000, 16
VERDICTS = ["allow", "block"]


def url_host(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1)))
    return F.translate(F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The rule strings that could fit, for each (labels in the host, characters in the path) that a rule has."""
    if not shapes:
        return F.array().cast("array<string>")
    every = F.from_json(F.lit(json.dumps([{"k": k, "n": n} for k, n in shapes])), "array<struct<k:int,n:int>>")
    some = F.filter(every, lambda s: s["n"] <= F.length(path))
    return F.array_distinct(F.transform(some, lambda s: F.concat(F.call_function("substring_index", host, F.lit("."), -s["k"]), F.substring(path, F.lit(1), s["n"]))))


def rule_table(spark: SparkSession, rules: DataFrame | list[tuple[str, str, str]]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """(rule, verdict, digest), each string once, and the shapes of all rules, which are few."""
    frame = rules if isinstance(rules, DataFrame) else spark.createDataFrame(rules, "verdict string, host string, path string")
    host, path = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER), F.coalesce("path", F.lit(""))
    made = frame.select(F.concat(host, path).alias("rule"), "verdict", (F.length(host) - F.length(F.replace(host, F.lit("."))) + 1).alias("k"), F.length(path).alias("n"))
    shapes = sorted((r["k"], r["n"]) for r in made.select("k", "n").distinct().collect())
    once = made.groupBy("rule").agg(F.max("verdict").alias("verdict"))  # block is after allow
    return once.withColumn("digest", F.xxhash64("rule")), shapes


class Rules:
    """Digests in order, with verdicts, offsets and strings."""

    def __init__(self, digest: np.ndarray, verdict: np.ndarray, offset: np.ndarray, text: np.ndarray):
        self.digest, self.verdict, self.offset, self.text = digest, verdict, offset, text

    @classmethod
    def of(cls, digests, rules: list[str], verdicts: list[str]) -> Rules:
        order = np.argsort(np.asarray(digests, "<i8"), kind="stable")
        texts = [rules[i].encode() for i in order]
        return cls(np.asarray(digests, "<i8")[order], np.array([VERDICTS.index(verdicts[i]) for i in order], "<i8"), np.cumsum([0, *map(len, texts)]).astype("<i8"), np.frombuffer(b"".join(texts), np.uint8))

    @classmethod
    def map(cls, path: str) -> Rules:
        """A file of :meth:`dumped` rules, mapped into memory."""
        n = int(np.fromfile(path, "<i8", 1)[0])
        ints = np.memmap(path, "<i8", "r", 8, 3 * n + 1)
        text = np.memmap(path, np.uint8, "r", 8 * (3 * n + 2)) if ints[3 * n] else np.zeros(0, np.uint8)
        return cls(ints[:n], ints[n : 2 * n], ints[2 * n :], text)

    def dumped(self) -> bytes:
        return np.array([len(self.digest)], "<i8").tobytes() + self.digest.tobytes() + self.verdict.tobytes() + self.offset.tobytes() + self.text.tobytes()

    def find(self, digests: np.ndarray, texts: list[str]) -> np.ndarray:
        """The row of each string, or -1."""
        at = np.searchsorted(self.digest, digests)
        found = np.full(len(digests), -1)
        for k in np.flatnonzero((at < len(self.digest)) & (self.digest[np.minimum(at, len(self.digest) - 1)] == digests)) if len(self.digest) else ():
            i, said = at[k], texts[k].encode()
            while i < len(self.digest) and self.digest[i] == digests[k]:
                if self.text[self.offset[i] : self.offset[i + 1]].tobytes() == said:
                    found[k] = i
                    break
                i += 1
        return found


def write_rules(spark: SparkSession, table: DataFrame) -> str:
    """Write the rules as one file and send it to all executors; only for tables of checked size."""
    rows = table.collect()
    body = Rules.of([r["digest"] for r in rows], [r["rule"] for r in rows], [r["verdict"] for r in rows]).dumped()
    uri = new_path(spark, f"rules-{hashlib.sha256(body).hexdigest()[:12]}")
    store, path = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path) as out:
        out.write(body)
    spark.sparkContext.addFile(uri)
    return uri.rpartition("/")[2]


def judge_urls(df: DataFrame, rules: DataFrame | list[tuple[str, str, str]], url_col: str = "url", default: str = "allow", max_rules: int = MAX_RULES) -> DataFrame:
    """``df`` with host, path, rule and verdict; rules are (verdict, host, path), and fit their host and its subdomains."""
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    table, shapes = rule_table(df.sparkSession, rules)
    # what the input has is one column and what is worked with another, so that no names clash
    url = df.select(F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(0).alias("_")).alias("row"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    url = url.withColumn("keys", candidates(F.col("host"), F.col("path"), shapes))
    count, size = table.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("rule")), F.lit(0))).first()
    made = _mapped(url, table, default) if count <= max_rules and size <= MAX_RULE_BYTES else _dealt(url, table, count, default)
    return made.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], "host", "path", "rule", "verdict")


def _mapped(url: DataFrame, table: DataFrame, default: str) -> DataFrame:
    """Rows with rule and verdict, by the file that executors map."""
    name = write_rules(url.sparkSession, table)
    given = ["row", "host", "path"]
    schema = url.select(*given).schema.add("rule", "string").add("verdict", "string")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = Rules.map(SparkFiles.get(name))
        for b in batches:
            keys, digests = (pa.table(b)[c].combine_chunks() for c in ("keys", "digests"))
            texts = keys.flatten().to_pylist()
            owner = np.repeat(np.arange(b.num_rows), np.diff(keys.offsets.to_numpy()))
            found = file.find(digests.flatten().to_numpy(zero_copy_only=False), texts)
            best: list[str | None] = [None] * b.num_rows
            verdict = [default] * b.num_rows
            for k in np.flatnonzero(found >= 0):
                if best[owner[k]] is None or len(texts[k]) > len(best[owner[k]]):
                    best[owner[k]], verdict[owner[k]] = texts[k], VERDICTS[file.verdict[found[k]]]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in given], pa.array(best, pa.string()), pa.array(verdict, pa.string())], names=[*given, "rule", "verdict"])

    return url.withColumn("digests", F.transform("keys", lambda k: F.xxhash64(k))).mapInArrow(probe, schema)


def groups_for(rules: int, candidates: int) -> int:
    """How many groups keep both the rules and the candidates of each at about ``ARRAY_RULES``."""
    return max(1, -(-max(rules, candidates) // ARRAY_RULES))


def _dealt(url: DataFrame, table: DataFrame, count: int, default: str) -> DataFrame:
    """The same with rules too many to send: arrays by digest, each probed with its part of the distinct candidates.

    Rules and distinct candidates are both dealt out by digest into as many groups as the more numerous of them needs.
    """
    rows = written(url.withColumn("number", F.monotonically_increasing_id()), "urls", compression="zstd")
    asked = written(rows.select(F.explode("keys").alias("rule")).distinct().withColumn("digest", F.xxhash64("rule")), "asked", compression="zstd")
    arrays = groups_for(count, asked.count())
    dealt = lambda x: x.withColumn("array", F.pmod(F.xxhash64("digest"), F.lit(arrays))).groupBy("array")

    def probe(mine: pa.Table, asks: pa.Table) -> pa.Table:
        file = Rules.of(mine["digest"].to_numpy(), mine["rule"].to_pylist(), mine["verdict"].to_pylist())
        texts = asks["rule"].to_pylist()
        found = file.find(asks["digest"].to_numpy(), texts)
        hit = np.flatnonzero(found >= 0)
        return pa.table({"rule": pa.array([texts[k] for k in hit], pa.string()), "verdict": pa.array([VERDICTS[file.verdict[found[k]]] for k in hit], pa.string())})

    hits = dealt(table).cogroup(dealt(asked)).applyInArrow(probe, "rule string, verdict string")
    hits = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = rows.select("number", F.explode("keys").alias("rule")).withColumn("salt", F.pmod(F.col("number"), F.lit(SALTS)).cast("int"))
    best = each.join(hits, ["rule", "salt"]).groupBy("number").agg(F.max_by(F.struct("rule", "verdict"), F.length("rule")).alias("hit"))
    return rows.join(best, "number", "left").select("row", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
