"""Substring dedup: words covered by a window that starts in an earlier document too are removed.

*Difference-cover anchors.*  With a difference cover D modulo p, two equal windows at places i and j
have an offset d < p with i + d and j + d both in D modulo p.  So only short windows (anchors) at such
places are hashed and shuffled; every long match shares an aligned anchor.  The matches then extend:
only windows around an anchor that another document shares are hashed (96 bits) and compared.

Three passes over blocks of documents, dealt by a hash of id and text; Spark shuffles the texts once and
reads that shuffle three times.  What a block sends out has each key once, so that a passage in a third of
all documents costs one entry a block.

Defined cases: null and blank texts have no words and are kept as empty; rows with one id are
judged alike and none of them is "earlier" than the other; a null id counts as the latest, and stays null; very long texts are read whole;
other columns of any name are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, slices

#: Perfect difference covers by period (fixed values).
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9)}
LAST = np.iinfo(np.int64).max


def _cover(window: int) -> tuple[int, np.ndarray, int]:
    """Period, which places of it are in the cover, words in an anchor."""
    period = max(p for p in COVERS if p == 1 or window >= p + max(2, p // 2 + 2))
    marked = np.zeros(period, bool)
    marked[list(COVERS[period])] = True
    return period, marked, window - period + 1


def _rows(table: pa.Table) -> tuple[np.ndarray, list]:
    return table["_id"].combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False), table["_text"]


def _parts(table: pa.Table):
    ids, texts = _rows(table)
    for number, some in slices(range(len(ids)), (x.as_py() for x in texts)):
        yield ids[np.array(number)], Words(some), np.array(number)


def _anchors(table: pa.Table, window: int, buckets: int):
    """For each part of a block: its words, the anchors' places and their codes (bucket, then 32 bits)."""
    period, marked, size = _cover(window)
    for ids, w, _ in _parts(table):
        h, at = w.grams(size)
        some = marked[(at - w.first[w.doc[at]]) % period]
        h, at = h[some], at[some]
        yield ids, w, at, ((h >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def _by_bucket(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """Where each bucket's run lies in a sorted array."""
    begin = np.flatnonzero(np.diff(bucket, prepend=-1))
    return [(int(bucket[a]), slice(a, b)) for a, b in zip(begin, [*begin[1:], len(bucket)], strict=True)] if len(bucket) else []


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Number the runs of equal keys in sorted arrays."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _blobs(table: pa.Table, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """A column of packed arrays as one array, and the row of each entry."""
    each = [np.frombuffer(x.as_py(), kind) for x in table[name]]
    return (np.concatenate(each), np.repeat(np.arange(len(each)), [len(x) for x in each])) if each else (np.zeros(0, kind), np.zeros(0, np.int64))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, block_bytes: int = 4_000_000, bucket_rows: int = 1_000_000) -> DataFrame:
    """(id, n_words, removed, kept): removed are word ranges (start, end), kept the other words joined by spaces."""
    df = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    total = df.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks, buckets = total // block_bytes + 1, total // (12 * bucket_rows) + 1
    df = df.withColumn("_block", F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)))  # rows without an id, or with one, are many blocks

    def emit(table: pa.Table) -> pa.Table:
        codes = [np.unique(c) for _, _, _, c in _anchors(table, window, buckets)]
        codes = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.uint64)
        runs = _by_bucket((codes >> np.uint64(32)).astype(np.int64))
        low = (codes & np.uint64(0xFFFFFFFF)).astype("<u4")
        return pa.table({"bucket": pa.array([b for b, _ in runs], pa.int64()), "block": pa.array([table["_block"][0].as_py()] * len(runs), pa.int64()), "keys": pa.array([low[s].tobytes() for _, s in runs], pa.binary())})

    def shared(table: pa.Table) -> pa.Table:
        keys, row = _blobs(table, "keys", "<u4")
        order = np.argsort(keys, kind="stable")
        keys, row = keys[order], row[order]
        group = _groups(keys)
        found = np.bincount(group)[group] > 1
        keys, row = keys[found], row[found]
        order = np.argsort(row, kind="stable")
        keys, row = keys[order], row[order]
        runs = _by_bucket(row)
        return pa.table({"block": table["block"].take(pa.array([r for r, _ in runs], pa.int64())), "bucket": table["bucket"].take(pa.array([r for r, _ in runs], pa.int64())), "keys": pa.array([keys[s].tobytes() for _, s in runs], pa.binary())})

    def windows(table: pa.Table, other: pa.Table) -> pa.Table:
        low, row = _blobs(other, "keys", "<u4")
        bucket = np.array(other["bucket"].to_pylist(), np.uint64)
        abroad = np.sort((bucket[row] << np.uint64(32)) | low) if len(low) else np.zeros(0, np.uint64)
        parts = list(_anchors(table, window, buckets))
        codes = np.concatenate([c for *_, c in parts]) if parts else np.zeros(0, np.uint64)
        owner = np.concatenate([ids[w.doc[at]] for ids, w, at, _ in parts]) if parts else np.zeros(0, np.int64)
        order = np.lexsort((owner, codes))
        group = _groups(codes[order])
        many = np.zeros(len(codes), bool)
        if len(codes):
            first = np.flatnonzero(np.diff(group, prepend=-1))
            low_id, high_id = np.minimum.reduceat(owner[order], first), np.maximum.reduceat(owner[order], first)
            many[order] = (low_id != high_id)[group]
            if len(abroad):
                many |= abroad[np.minimum(np.searchsorted(abroad, codes), len(abroad) - 1)] == codes
        reach, begin, out = _cover(window)[0], 0, []
        for ids, w, at, c in parts:
            hit = at[many[begin : begin + len(c)]]
            begin += len(c)
            edge = np.zeros(len(w.hash) + 1, np.int64)
            np.add.at(edge, np.maximum(hit - reach + 1, w.first[w.doc[hit]]), 1)
            np.add.at(edge, hit + 1, -1)
            h, start = w.grams(window)
            near = (np.cumsum(edge[:-1]) > 0)[start]
            h2, _ = w.grams(window, 1)
            out.append((h[near], (h2[near] & np.uint64(0xFFFFFFFF)).astype("<u4"), ids[w.doc[start[near]]]))
        h, h2, ids = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.uint64), np.zeros(0, "<u4"), np.zeros(0, np.int64))
        place = (h >> np.uint64(32)) % np.uint64(buckets)
        order = np.lexsort((ids, h2, h, place))
        place, h, h2, ids = place[order], h[order], h2[order], ids[order]
        first = np.flatnonzero(np.diff(_groups(h, h2, place), prepend=-1)) if len(h) else np.zeros(0, np.int64)
        place, h, h2, ids = place[first], h[first], h2[first], ids[first]
        runs = _by_bucket(place.astype(np.int64))
        base = int(ids.min()) if len(ids) else 0
        kind = "<u4" if len(ids) and int(ids.max()) - base < 2**32 else "<i8"
        return pa.table({"bucket": pa.array([b for b, _ in runs], pa.int64()), "block": pa.array([table["_block"][0].as_py() if table.num_rows else None] * len(runs), pa.int64()), "h": pa.array([h[s].tobytes() for _, s in runs], pa.binary()), "h2": pa.array([h2[s].tobytes() for _, s in runs], pa.binary()), "base": pa.array([base] * len(runs), pa.int64()), "ids": pa.array([(ids[s] - base).astype(kind).tobytes() for _, s in runs], pa.binary())})

    def earliest(table: pa.Table) -> pa.Table:
        h, row = _blobs(table, "h", "<u8")
        h2, _ = _blobs(table, "h2", "<u4")
        ids = [np.frombuffer(i, "<u4" if len(i) < len(x) else "<i8").astype(np.int64) + b for i, x, b in zip(table["ids"].to_pylist(), table["h"].to_pylist(), table["base"].to_pylist(), strict=True)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        order = np.lexsort((ids, h2, h))
        h, h2, ids, row = h[order], h2[order], ids[order], row[order]
        group = _groups(h, h2)
        least = ids[np.flatnonzero(np.diff(group, prepend=-1))][group] if len(h) else ids
        late = ids > least
        h, least, row = h[late], least[late], row[late]
        order = np.argsort(row, kind="stable")
        h, least, row = h[order], least[order], row[order]
        runs = _by_bucket(row)
        return pa.table({"block": table["block"].take(pa.array([r for r, _ in runs], pa.int64())), "h": pa.array([h[s].tobytes() for _, s in runs], pa.binary()), "ids": pa.array([least[s].astype("<i8").tobytes() for _, s in runs], pa.binary())})

    def cut(table: pa.Table, other: pa.Table) -> pa.Table:
        far, _ = _blobs(other, "h", "<u8")
        far_id, _ = _blobs(other, "ids", "<i8")
        order = np.argsort(far)
        far, far_id = far[order], far_id[order]
        parts = [(ids, w, *w.grams(window)) for ids, w, _ in _parts(table)]
        h = np.concatenate([x[2] for x in parts]) if parts else np.zeros(0, np.uint64)
        owner = np.concatenate([ids[w.doc[at]] for ids, w, _, at in parts]) if parts else np.zeros(0, np.int64)
        least = owner.copy()
        if len(h):
            order = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.diff(group := _groups(h[order]), prepend=-1))
            least[order] = np.minimum.reduceat(owner[order], first)[group]
            if len(far):
                at = np.minimum(np.searchsorted(far, h), len(far) - 1)
                least = np.where(far[at] == h, np.minimum(least, far_id[at]), least)
        late, begin, counts, removed, kept = least < owner, 0, [], [], []
        for _, w, _, at in parts:
            edge = np.zeros(len(w.hash) + 1, np.int64)
            hit = at[late[begin : begin + len(at)]]
            begin += len(at)
            edge[hit] += 1
            edge[hit + window] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            counts += np.diff(w.first).tolist()
            kept += w.joined(~gone)
            for a, b in zip(w.first[:-1], w.first[1:], strict=True):
                turn = np.flatnonzero(np.diff(gone[a:b].view(np.int8), prepend=0, append=0)) if gone[a:b].any() else ()
                removed.append([{"start": int(x), "end": int(y)} for x, y in zip(turn[0::2], turn[1::2], strict=True)])
        return pa.table({"id": table["_id"], "n_words": pa.array(counts, pa.int64()), "removed": pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    anchors = df.groupBy("_block").applyInArrow(emit, "bucket long, block long, keys binary")
    common = anchors.groupBy("bucket").applyInArrow(shared, "block long, bucket long, keys binary")
    found = df.groupBy("_block").cogroup(common.groupBy("block")).applyInArrow(windows, "bucket long, block long, h binary, h2 binary, base long, ids binary")
    late = found.groupBy("bucket").applyInArrow(earliest, "block long, h binary, ids binary")
    return df.groupBy("_block").cogroup(late.groupBy("block")).applyInArrow(cut, "id long, n_words long, removed array<struct<start:long,end:long>>, kept string")
