"""WARC archives of pages with deduplicated payloads, read back, and a capture index merged from sorted runs.

*Archives.*  Tasks write gzip members, a record each, into files of bounded size in the shared folder.  Of equal payloads
the capture with the smallest id is a response, the others are revisits that refer to it.  A task's rows are put in order first, so
that its files have the same bytes whenever it runs; a file appears by a rename once complete, so a task that is run again does no harm.

*External index merge.*  The captures of a file are sorted by URL key and time and are a run; this is the only sort.  Runs are dealt out by
ranges of (URL key, time, id), so that one URL with a third of all captures is split as well; a task gets
each run's part of its range in order, and merges them by a loser tree over the places of its rows, which stay in Arrow.  Ranges
in order are globally ordered capture histories.

Defined cases: null HTML is an empty payload; a null URL has the empty key; a null id takes part as a capture of its own
after all others; rows that repeat the response's id and payload are responses too; equal keys and times are ordered by id;
an empty table makes no files and an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, written
from .urls import url_host, url_path


def url_key(url: Column) -> Column:
    """The host's labels from the last, then the path and query, A-Z lower-cased in the host: ``com,example)/a?b``."""
    host = url_host(url)
    tail = F.coalesce(F.regexp_extract(F.split_part(url, F.lit("#"), F.lit(1)), r"\?.*$", 0), F.lit(""))
    return F.when(host == "", F.coalesce(url, F.lit(""))).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), url_path(url), tail))


def marked_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(id, url, time, html) with sha (hexadecimal SHA-1), bytes and refers_to, the id of the response that the row revisits."""
    df = pages.withColumn("html", F.coalesce("html", F.lit(""))).withColumn("rank", F.coalesce("id", F.lit(2**63 - 1)))
    df = df.withColumns({"sha": F.sha1("html"), "bytes": F.octet_length("html").cast("long")})
    first = df.where(F.col("bytes") >= least).groupBy("sha").agg(F.min("rank").alias("refers_to"), F.max("rank").alias("last")).where("refers_to < last").drop("last")
    late = df.select("rank", "sha").join(first, "sha").where("rank > refers_to").distinct()
    # joined by id, as a payload may be that of a third of all rows
    return df.join(late, ["rank", "sha"], "left").select("id", "url", "time", "html", "bytes", "refers_to", "sha")


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def capture(row: dict) -> bytes:
    """The record of a row, a gzip member of its own."""
    uri = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", row["url"] or "")
    name = lambda i: f"<urn:capture:{'none' if i is None else i}>"
    headers = [("WARC-Record-ID", name(row["id"])), ("WARC-Target-URI", uri), ("WARC-Date", row["time"]), ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(row['sha'])).decode()}"), ("Content-Type", "application/http;msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if row["refers_to"] is None:
        made = _record("response", headers, http + row["html"].encode("utf-8", "surrogatepass"))
    else:
        more = [("WARC-Refers-To", name(row["refers_to"])), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Payload-Length", str(row["bytes"]))]
        made = _record("revisit", headers + more, http)
    return gzip.compress(made, 6, mtime=0)


def write_archives(pages: DataFrame, folder: str, file_bytes: int = 16_000_000) -> None:
    """Write marked pages as ``capture-<partition>-<number>.warc.gz`` files of about ``file_bytes`` into ``folder``."""

    uri = folder if re.match(r"\w+:", folder) else f"file://{folder}"
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)  # of an empty table, too

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(uri)
        task, number, out, size = TaskContext.get(), 0, None, 0
        part = lambda: f"{path}/_{task.taskAttemptId()}-{number}"

        def close() -> None:
            nonlocal number, out, size
            if out is not None:
                out.close()
                store.move(part(), f"{path}/capture-{task.partitionId():06d}-{number:06d}.warc.gz")
                number, out, size = number + 1, None, 0

        for b in batches:
            for k in range(b.num_rows):
                member = capture({c: b[c][k].as_py() for c in b.schema.names})
                out = out or store.open_output_stream(part())
                out.write(member)
                size += len(member)
                if size >= file_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([number])], names=["files"])

    ordered = pages.withColumn("time", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")).sortWithinPartitions("id", "sha", "url", "time")
    ordered.mapInArrow(run, "files long").agg(F.sum("files")).collect()


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member."""
    at = 0
    while at < len(data):
        unzip, end, parts = zlib.decompressobj(31), at, []
        while not unzip.eof and end < len(data):  # a little at a time: what follows the member is copied
            parts.append(unzip.decompress(data[end : end + 16_384]))
            end = min(end + 16_384, len(data))
        end -= len(unzip.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def parse(content: bytes) -> dict:
    """Headers, and the payload's bytes and digest as the record has them."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
    ident = lambda x: None if x in (None, "none") else int(x)
    number = lambda s: ident(re.fullmatch("<urn:capture:(.*)>", s)[1])
    full = fields["WARC-Type"] == "response"
    return {
        "id": number(fields["WARC-Record-ID"]), "kind": fields["WARC-Type"], "url": fields.get("WARC-Target-URI", ""), "time": fields["WARC-Date"],
        "bytes": len(payload) if full else int(fields["X-Payload-Length"]),
        "digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if full else fields["WARC-Payload-Digest"].partition(":")[2],
        "refers_to": None if full else number(fields["WARC-Refers-To"]),
    }


ENTRY = "id long, kind string, url string, time string, bytes long, digest string, refers_to long, file string, offset long, length long"
_NAMES = [x.split()[0] for x in ENTRY.split(", ")]
_KINDS = [pa.int64() if x.endswith("long") else pa.string() for x in ENTRY.split(", ")]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """An index entry per record; a file's entries stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b["path"].to_pylist(), b["content"], strict=True):
                rows = [parse(content) | {"file": path.rpartition("/")[2], "offset": at, "length": n} for at, n, content in members(data.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(_NAMES, _KINDS, strict=True)], names=_NAMES)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "content")
    # a file is one row; one file at a time goes to Python, whatever the batch size is
    return files.mapInArrow(run, ENTRY)


class LoserTree:
    """Merge sorted runs of (key, value): each inner node holds the run that lost there, so a step costs one path."""

    def __init__(self, runs: list):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.count = max(1, len(self.runs))
        self.tree = [-1] * self.count
        for k in range(len(self.runs)):
            self._play(k)

    def _before(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and (self.heads[a] is not None or a < b)
        return (self.heads[a][0], a) < (self.heads[b][0], b)

    def _play(self, winner: int) -> None:
        node = (winner + self.count) // 2
        while node:
            other = self.tree[node]
            if other < 0:
                self.tree[node] = winner
                return
            if self._before(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        while self.runs and self.heads[k := self.tree[0]] is not None:
            yield self.heads[k][1]
            self.heads[k] = next(self.runs[k], None)
            self._play(k)


def merged_index(entries: DataFrame, parts: int) -> DataFrame:
    """All entries with url_key, range and place: ordered by (range, place) they are ordered by URL key, time and id.

    A task holds its range of entries: about 0.6 kB each.
    """
    keyed = entries.withColumn("url_key", url_key(F.col("url")))
    runs = written(keyed.sortWithinPartitions("file", "url_key", "time", "id"), "runs")
    names = [*runs.columns, "range", "place"]
    schema = runs.schema.add("range", "integer").add("place", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        columns = [table[c].to_pylist() for c in ("url_key", "time", "id", "file", "offset")]
        key = [(k, t, i is not None, i or 0, f, o) for k, t, i, f, o in zip(*columns, strict=True)]  # as Spark sorts, nulls first
        by_file: dict[str, list[int]] = {}
        for place, f in enumerate(columns[3]):
            by_file.setdefault(f, []).append(place)
        for part in by_file.values():
            part.sort(key=key.__getitem__)  # one pass, as a run comes in its order
        merged = list(LoserTree([[(key[i], i) for i in by_file[f]] for f in sorted(by_file)]))
        made = table.take(pa.array(merged, pa.int64()))
        made = made.append_column("range", pa.array([TaskContext.get().partitionId()] * len(merged), pa.int32())).append_column("place", pa.array(range(len(merged)), pa.int64()))
        yield from made.to_batches(5000)

    return runs.repartitionByRange(parts, "url_key", "time", "id").mapInArrow(run, schema).select(*names)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time: Column | None = None, least: int = 0, file_bytes: int = 16_000_000, range_rows: int = 50_000, folder: str | None = None) -> DataFrame:
    """Write pages as WARC files into ``folder`` (by default a new one in the shared folder), read them back and return the merged index.

    Without ``time`` a capture's second is its id.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    made = F.coalesce(time if time is not None else F.timestamp_seconds(F.pmod(F.coalesce(F.col(id_col), F.lit(0)), F.lit(4_000_000_000))), F.timestamp_seconds(F.lit(0)))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), made.alias("time"), F.col(html_col).alias("html"))
    write_archives(marked_revisits(rows, least), folder, file_bytes)
    entries = read_archives(spark, folder)
    return merged_index(entries, max(1, -(-rows.count() // range_rows)))


def positioned(index: DataFrame) -> DataFrame:
    """The index with position, a record's place in the whole of it; the ranges' sizes are a row a range.

    The index is written first: ranges are drawn anew each time it is computed.
    """
    index = written(index, "index")
    sizes = index.groupBy("range").agg(F.count("*").alias("n"))
    before = sizes.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return index.join(before, "range").withColumn("position", F.col("place") + F.col("before")).drop("before")


def histories(index: DataFrame) -> DataFrame:
    """The index with each capture's number among those of its URL key."""
    return index.withColumn("capture", F.row_number().over(Window.partitionBy("url_key").orderBy("range", "place")))
