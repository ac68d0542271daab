"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full shingle sets, union-find grouping.

*SuperMinHash.*  Each element of a set draws one permutation of the slots and, for rank j, a number in
[j, j + 1) for the slot that has rank j; a slot keeps the least.  Ranks of one element are correlated, which
lowers the variance, and ranks are taken in rounds over all elements at once: a document stops early, when
no slot can still get less.

*Links.*  Equal sets are one representative.  Representatives that agree in a band form a bucket; its smallest
id is its hub.  Members go to groups: those whose signature is not far from the hub's into one group for each hub, those not near
it into one for each bucket.  A group is dealt out by a hash into chunks of bounded size; a task compares
a chunk's full sets, one against all that are not connected to it yet.  In groups of more than one chunk, the members outside
the component that most members belong to are then compared with all members, again chunk by chunk.  Only links leave the tasks, never pairs.
At similarity 0.8 the 32 bands of 4 slots miss a link with probability 5e-8.

Defined cases: null and blank texts have an empty set and are linked with nothing; a text with fewer words
than a shingle is one shingle; rows with one id and equal texts share their component; rows with a null id
are not compared; very long texts are read whole; other columns of any name are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written
from .words import Words, mix, slices

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: A member whose signature agrees with its hub's in this share of slots at least goes to the hub's group; below the other, to its bucket's.
NOT_FAR, NEAR = 0.35, 0.6
_LOW = np.uint64(0xFFFFFFFF)


def shingle_sets(texts: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of lower-cased texts, one after another, and where each text's begin."""
    w = Words(texts, lower=True)
    h, at = w.grams(n)
    doc = w.doc[at]
    size = np.diff(w.first)
    short = np.flatnonzero((size > 0) & (size < n))
    h, doc = np.concatenate([h, w.whole()[short] ^ np.uint64(1)]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(texts) + 1))


def super_minhash(sets: np.ndarray, first: np.ndarray, slots: int = 128, most: int = 200_000) -> np.ndarray:
    """Signatures (sets x slots); rank in the high, draw in the low 32 bits.  Empty sets: the largest number."""
    count = len(first) - 1
    out = np.full((count, slots), np.uint64(2**64 - 1))
    begin = 0
    while begin < count:  # some sets at a time, for the permutations' memory
        end = max(begin + 1, int(np.searchsorted(first, first[begin] + most, "right")) - 1)
        end = min(end, count)
        _sign(sets[first[begin] : first[end]], np.repeat(np.arange(end - begin), np.diff(first[begin : end + 1])), out[begin:end])
        begin = end
    return out


def _sign(element: np.ndarray, owner: np.ndarray, out: np.ndarray) -> None:
    slots, flat = out.shape[1], out.reshape(-1)
    place = None
    for j in range(slots):
        if not len(element):
            return
        draw = mix(element + np.uint64((j + 1) * int(_STEP) % 2**64))
        pick = j + (((draw & _LOW) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            slot, first_pick = pick, pick
        else:
            row = np.arange(len(element))
            if place is None:
                place = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(element), 1))
                place[row, 0], place[row, first_pick] = first_pick, 0
            slot, there = place[row, pick].astype(np.int64), place[row, j]
            place[row, pick], place[row, j] = there, slot
        np.minimum.at(flat, owner * slots + slot, (np.uint64(j) << np.uint64(32)) | (draw >> np.uint64(32)))
        open_ = (out.max(axis=1) > np.uint64((j + 1) << 32))[owner]
        if not open_.all():
            element, owner = element[open_], owner[open_]
            if j == 0:
                first_pick = first_pick[open_]
            else:
                place = place[open_]


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    count, slots = signatures.shape
    key = np.tile(np.arange(slots // rows, dtype=np.uint64), (count, 1)) * _STEP
    for r in range(rows):
        key = mix(key ^ mix(signatures[:, r::rows][:, : slots // rows]) + np.uint64(r))
    return key.view(np.int64)


def _signed(docs: DataFrame, n: int, slots: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in slices(b["id"].to_pylist(), (x.as_py() for x in b["text"])):
                sets, first = shingle_sets(texts, n)
                sign = super_minhash(sets, first, slots)
                total = lambda salt: np.diff(np.concatenate([[np.uint64(0)], np.cumsum(mix(sets ^ np.uint64(salt)), dtype=np.uint64)])[first])
                keys, small = band_keys(sign, rows), mix(sign).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.diff(first)), pa.array(total(1).view(np.int64)), pa.array(total(2).view(np.int64)), pa.array([x.tobytes() for x in small], pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))],
                    names=["id", "n", "k1", "k2", "sign", "bands"],
                )

    return docs.mapInArrow(run, "id long, n long, k1 long, k2 long, sign binary, bands array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in slices(b["id"].to_pylist(), (x.as_py() for x in b["text"])):
                sets, first = shingle_sets(texts, n)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([sets[a:z].tobytes() for a, z in zip(first[:-1], first[1:], strict=True)], pa.binary())], names=["id", "set"])

    return docs.mapInArrow(run, "id long, set binary")


def _likely(pairs: DataFrame, least: float) -> DataFrame:
    """(a, b, near): near is the share of equal slots, with 8 bits of each; -1 below ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b[c].to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("sign_a", "sign_b"))
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array((x == y).mean(axis=1) if b.num_rows else np.zeros(0))], names=["a", "b", "near"])

    return pairs.mapInArrow(run, "a long, b long, near double").where(F.col("near") >= least)


class Chunk:
    """Members' sets, as one array of dense numbers and where each set's begin."""

    def __init__(self, sets: list):
        each = [np.frombuffer(x, np.uint64) for x in sets]
        self.size = np.array([len(x) for x in each])
        self.first = np.cumsum(self.size) - self.size
        distinct, self.flat = np.unique(np.concatenate(each), return_inverse=True)
        self.mark = np.zeros(len(distinct), np.int64)

    def linked(self, i: int, percent: int) -> np.ndarray:
        """Which members are similar enough to member i."""
        own = self.flat[self.first[i] : self.first[i] + self.size[i]]
        self.mark[own] = 1
        both = np.add.reduceat(self.mark[self.flat], self.first)
        self.mark[own] = 0
        return 100 * both >= percent * (self.size[i] + self.size - both)


def _chunk_links(rows: list, percent: int) -> Iterator[tuple[int, int]]:
    """Links that connect a chunk's (id, set, asks, component) as all links would: from those that ask, to others."""
    chunk, label = Chunk([r[1] for r in rows]), np.array([r[3] for r in rows])
    label = np.unique(label, return_inverse=True)[1]
    for i, (one, _, asks, _) in enumerate(rows):
        if asks and (label != label[i]).any():
            for j in np.flatnonzero(chunk.linked(i, percent) & (label != label[i])):
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    yield max(one, rows[j][0]), min(one, rows[j][0])


def _links(members: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links (a, b) within each chunk; ``members`` have the keys, id, set, asks and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []

        def solved() -> pa.RecordBatch:
            found = list(_chunk_links(rows, percent)) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        for b in batches:
            for *key, id_, set_, asks, component in zip(*[b[k].to_pylist() for k in keys], *[b[c].to_pylist() for c in ("id", "set", "asks", "component")], strict=True):
                if key != last:
                    yield solved()
                    last, rows = key, []
                rows.append((id_, set_, asks, component))
        yield solved()

    dealt = members.select(*keys, "id", "set", "asks", "component").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a long, b long")


def _with(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with a column of both."""
    of = lambda side: table.select(F.col("id").alias(side), F.col(column).alias(f"{column}_{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b")


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id that each end of an edge (a, b) reaches.

    Each task replaces its edges by a star for each of its union-find trees; then large-star and
    small-star rounds run until nothing changes.  Every round is written, as lineage would grow.
    """

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root.setdefault(up, up)
            return x

        for b in batches:
            for x, y in zip(b["a"].to_pylist(), b["b"].to_pylist(), strict=True):
                x, y = find(x), find(y)
                root[max(x, y)] = min(x, y)
        pairs = [(x, find(x)) for x in list(root)]
        pairs = [(x, y) for x, y in pairs if x != y]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], names=["a", "b"])

    pick = lambda df: df.select("a", "b").where("a <> b").distinct()
    stars = written(edges.select("a", "b").mapInArrow(forest, "a long, b long"), "stars")
    digest = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    state = digest(stars)
    for _ in range(rounds):
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = pick(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = pick(down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))))
        old, stars = stars, written(small, "stars")
        discard(old)
        before, state = state, digest(stars)
        if before == state:
            break
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    tops = stars.select(F.col("b").alias("a"), "b").distinct()
    return stars.union(tops).select(F.col("a").alias("id"), F.col("b").alias("component")).groupBy("id").agg(F.min("component").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, slots: int = 128, rows: int = 4, chunk: int = 256) -> DataFrame:
    """(id, n_shingles, component_id) for every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = written(_signed(docs, shingle, slots, rows), "signatures")
    full = signed.where("n > 0 AND id IS NOT NULL")
    same = full.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.first("sign").alias("sign"), F.first("bands").alias("bands"))
    same = written(same, "representatives")
    signs = same.select(F.col("rep").alias("id"), "sign")

    banded = same.select("rep", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where("size > 1").select("key", "hub")
    members = written(banded.join(hubs, "key"), "buckets")
    pairs = members.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    near = written(_likely(_with(pairs, signs, "sign"), 0.0), "estimates")
    alike = near.where(F.col("near") >= NOT_FAR).select(F.col("b").alias("g"), F.lit(0).cast("long").alias("k"), F.col("a").alias("id"))
    alike = alike.union(alike.select("g", "k", F.col("g").alias("id")).distinct())
    apart = members.join(near.where(F.col("near") < NEAR).select(F.col("a").alias("rep"), F.col("b").alias("hub")), ["rep", "hub"]).select(F.col("hub").alias("g"), F.col("key").alias("k"), F.col("rep").alias("id"))
    groups = alike.union(apart)
    # written, so that the join is one of two tables, in which Spark splits a large group
    sized = written(groups.groupBy("g", "k").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    groups = written(groups.join(sized, ["g", "k"]), "groups")
    needed = groups.select("id").distinct()
    # the texts are shuffled at every size, and not sorted
    sets = written(_sets(docs.join(needed.hint("shuffle_hash"), "id", "left_semi").dropDuplicates(["id"]), shingle), "sets")

    part = lambda n: F.pmod(F.xxhash64("id", "g"), F.ceil(F.col(n) / chunk))
    dealt = groups.select("g", "k", part("size").alias("m"), "id", F.lit(True).alias("asks"), F.col("id").alias("component")).join(sets, "id")
    links = written(_links(dealt, ["g", "k", "m"], percent), "links")
    first = connected(links).withColumnRenamed("id", "node")

    large = groups.where(F.col("size") > chunk)
    large = large.join(first, large["id"] == first["node"], "left").select("g", "k", "size", "id", F.coalesce("component", "id").alias("component"))
    main = large.groupBy("g", "k", "component").agg(F.count("*").alias("n")).groupBy("g", "k").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    large = written(large.join(main.where(F.col("all") > F.col("most")), ["g", "k"]), "mixed")
    left = F.col("all") - F.col("most")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(n / chunk) - 1))
    members = large.select("g", "k", part("size").alias("m"), every(left).alias("r"), "id", F.lit(False).alias("asks"), "component")
    asking = large.where("component <> main").withColumn("left", left)
    asking = asking.select("g", "k", every(F.col("size")).alias("m"), part("left").alias("r"), "id", F.lit(True).alias("asks"), "component")
    rest = _links(members.unionByName(asking).join(sets, "id"), ["g", "k", "m", "r"], percent)
    groups = connected(links.union(rest))

    named = same.select("k1", "k2", "rep").join(groups.withColumnRenamed("id", "rep"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("id", F.col("n").alias("n_shingles"), "k1", "k2").join(named, ["k1", "k2"], "left")
    return out.select("id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
