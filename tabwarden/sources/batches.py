"""Sources to a stream of period batches: one Parquet table partitioned by period, whatever the number of sources."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass
from pathlib import Path
from zipfile import BadZipFile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import period_name
from ..functions.dates import parse_datetime
from .archives import archives, members, read_zipped
from .files import dataset_hash, file_hash, load_json, save_json

log = logging.getLogger(__name__)
PERIOD = re.compile(r"\d{4}(-\d{2}|Q[1-4])?")


@dataclass(frozen=True)
class Source:
    """``share`` is information only: nothing is sampled by it."""

    name: str
    path: str
    extracted_to: str = "data/raw"
    prefix: str = "batch_"
    share: float = 1.0
    enabled: bool = True


def sources_from_config(config: dict) -> list[Source]:
    """The declared sources, or the one that older configurations name; every mistake is reported at once."""
    items = config.get("sources") or ([{"name": "default", "path": config["dataset"]["path"]}] if config.get("dataset") else [])
    sources = [Source(**x) for x in items]
    on = [s for s in sources if s.enabled]
    wrong = [f"{s.name}: share must lie in (0, 1]" for s in sources if not 0 < s.share <= 1]
    if not on:
        wrong.append("no source is enabled")
    wrong += [f"prefix {p!r} is used twice" for p in {s.prefix for s in on} if sum(s.prefix == p for s in on) > 1]
    if wrong:
        raise ValueError("; ".join(wrong))
    return sources


def prepare(sources: list[Source]) -> dict[str, str]:
    """Path by source name; a broken source is logged and left out.  Archives stay archives: tasks read their members."""
    out = {}
    for s in sources:
        if s.enabled:
            try:
                if s.path.endswith(".zip"):
                    for a in archives(s.path):
                        if len(names := members(a)) > 1:
                            log.warning("%s holds %d CSV files; the first is read", a, len(names))
                elif "://" not in s.path and not Path(s.path).exists():
                    raise FileNotFoundError(s.path)
                out[s.name] = s.path
            except (OSError, ValueError, BadZipFile) as e:
                log.error("source %s is left out: %s", s.name, e)
    return out


def sources_hash(sources: list[Source], spark: SparkSession | None = None) -> str:
    """One hash over all sources: of the content of local files, and of names, lengths and times of what a URI holds, which Spark lists."""
    found = prepare(sources)
    listed = {n: listing_hash(spark, p) for n, p in found.items() if "://" in p and not p.endswith(".zip")}
    listed |= {n: ",".join(file_hash(a) for a in archives(p)) for n, p in found.items() if p.endswith(".zip")}
    return dataset_hash({n: p for n, p in found.items() if n not in listed}, listed)


def listing_hash(spark: SparkSession, uri: str) -> str:
    """A hash of the files under a URI by name, length and time; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(uri).select("path", "length", "modificationTime")
    n, total = files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return f"{n}:{total}"


def read_raw(spark: SparkSession, path: str | Path, source: str = "default") -> DataFrame:
    """All columns as text, so that junk survives until a rule or a type check names it."""
    path = str(path)
    if path.endswith(".zip"):
        return read_zipped(spark, path).withColumn("source", F.lit(source))
    reader = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.option("header", True).option("escape", '"').csv(path)
    return reader.withColumn("source", F.lit(source))


#: Where a row stands in its files; carried along so that results can be written in the same order.
PLACE = "_place"


def with_places(df: DataFrame) -> DataFrame:
    """Rows that come straight from files with their place: file, block of the file, and the number that Spark gives while it reads the block."""
    at = F.col("_metadata")
    return df.select("*", F.struct(at["file_path"].alias("file"), at["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row")).alias(PLACE))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df


def split_by_period(df: DataFrame, time_col: str, fmt: str | None, size: str = "month") -> DataFrame:
    """``df`` with parsed times and their period; rows without a time go."""
    at = parse_datetime(df, time_col, fmt)
    return df.withColumn(time_col, at).where(F.col(time_col).isNotNull()).withColumn("period", period_name(F.col(time_col), size))


def split_sources(spark: SparkSession, sources: list[Source], table: str, time_col: str, fmt: str | None, size: str = "month", required: list[str] = ()) -> list[str]:
    """Write all sources as one table partitioned by period; the periods in order.

    Rows are dealt out by period once, and a large period to as many tasks as its size asks for.
    """
    parts = [split_by_period(require(read_raw(spark, p, n), list(required)), time_col, fmt, size) for n, p in prepare(sources).items()]
    if not parts:
        raise ValueError("no source could be read")
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    write_periods(both, table)
    return periods(spark, table)


def write_periods(df: DataFrame, table: str) -> None:
    """Write rows with a period as a table partitioned by it; Spark splits large periods into files of even size, and joins small ones' rows."""
    df.hint("rebalance", "period").write.mode("overwrite").partitionBy("period").parquet(table)


def periods(spark: SparkSession, table: str) -> list[str]:
    """The periods a table has, from its partitions."""
    return [r[0] for r in spark.read.parquet(table).select(F.col("period").cast("string")).distinct().orderBy("period").collect()]


def read_batch(spark: SparkSession, table: str, period: str, required: list[str] = ()) -> DataFrame:
    """One period; only its partition is read."""
    return require(spark.read.parquet(table).where(F.col("period").cast("string") == period).drop("period"), list(required))


class Collector:
    """Accepts external batches into the table, one period each."""

    def __init__(self, spark: SparkSession, table: str, required: list[str], time_col: str, fmt: str | None = None, size: str = "month"):
        self.spark, self.table, self.required, self.time_col, self.fmt, self.size = spark, table, list(required), time_col, fmt, size

    def periods(self) -> list[str]:
        return [p for p in periods(self.spark, self.table) if PERIOD.fullmatch(p)] if self.exists() else []

    def path_for(self, period: str) -> str:
        """The folder of a period, whether it is there or not."""
        if not PERIOD.fullmatch(period):
            raise ValueError(f"{period!r} is no period")
        return f"{self.table}/period={period}"

    def batch_paths(self) -> dict[str, str]:
        """The folders of all periods that are there, in order."""
        return {p: self.path_for(p) for p in self.periods()}

    def exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.table)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def validate(self, df: DataFrame) -> dict:
        """Counts by one aggregate, and what is wrong with the batch."""
        missing = [c for c in self.required if c not in df.columns]
        errors = [f"missing columns: {', '.join(missing)}"] if missing else []
        if self.time_col not in df.columns:
            return {"ok": False, "errors": errors or [f"no column {self.time_col}"], "rows": df.count(), "unparsed": None, "periods": []}
        at = parse_datetime(df, self.time_col, self.fmt)
        rows, parsed, found = df.agg(F.count("*"), F.count(at), F.slice(F.sort_array(F.collect_set(period_name(at, self.size))), 1, 10)).first()
        if not rows:
            errors.append("no rows")
        elif not parsed:
            errors.append("no date could be read")
        elif len(found) != 1:
            errors.append(f"several periods: {', '.join(found)}")
        return {"ok": not errors, "errors": errors, "rows": rows, "unparsed": rows - parsed, "periods": found}

    def append_external(self, path: str, overwrite: bool = False) -> str:
        """Add a CSV file's batch; a period that is there already is refused unless it may be overwritten."""
        if not str(path).lower().endswith(".csv"):
            raise ValueError("only CSV files are accepted")
        if not Path(path).exists():
            raise FileNotFoundError(path)
        df = read_raw(self.spark, path, Path(path).stem)
        report = self.validate(df)
        if not report["ok"]:
            raise ValueError("; ".join(report["errors"]))
        period = report["periods"][0]
        if period in self.periods() and not overwrite:
            raise FileExistsError(f"period {period} is there already")
        made = split_by_period(df, self.time_col, self.fmt, self.size)
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(self.table)
        return period

    def save(self, path: str) -> None:
        """What the collector was made with, as JSON."""
        save_json(path, {"kind": "collector", "table": self.table, "required": self.required, "time_col": self.time_col, "fmt": self.fmt, "size": self.size})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Collector:
        data = load_json(path)
        if not isinstance(data, dict) or data.pop("kind", None) != "collector":
            raise ValueError(f"{path} does not describe a collector")
        return cls(spark, **data)

    def describe(self) -> dict:
        counts = self.spark.read.parquet(self.table).groupBy(F.col("period").cast("string").alias("p")).agg(F.count("*").alias("n"))
        n, first, last, rows = counts.agg(F.count("*"), F.min("p"), F.max("p"), F.sum("n")).first()
        return {"batches": n, "first": first, "last": last, "rows": rows or 0}


class TrainingStore:
    """Append-only training parts by batch; a part that is there is left as it is, so a repeated batch adds nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def indices(self) -> list[int]:
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(jpath):
            return []
        done = [s.getPath() for s in fs.listStatus(jpath) if s.isDirectory()]
        return sorted(int(p.getName().split("=")[1]) for p in done if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def append(self, batch_idx: int, df: DataFrame) -> bool:
        if batch_idx in self.indices():
            return False
        df.write.mode("overwrite").parquet(f"{self.path}/batch_idx={batch_idx}")
        return True

    def load(self, window: int | None = None, columns: list[str] = ()) -> DataFrame | None:
        """The last ``window`` parts; other partitions are not read."""
        kept = self.indices()[-window:] if window else self.indices()
        if not kept:
            return None
        df = self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/batch_idx={i}" for i in kept])
        return require(df, list(columns))

    def stats(self) -> dict:
        df = self.load()
        return {"parts": len(self.indices()), "rows": df.count() if df is not None else 0}

    def clear(self) -> None:
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jpath, True)


def write_predictions(df: DataFrame, path: str) -> None:
    """Original columns, predict and predict_proba (six decimals) as CSV; with places, lines stand in the order of the input.

    Rows are dealt out by ranges of places, so the files in the order of their names, one after another, are the input's files.
    """
    df = df.withColumn("predict_proba", F.round("predict_proba", 6))
    if PLACE in df.columns:
        df = df.repartitionByRange(PLACE).sortWithinPartitions(PLACE).drop(PLACE)
    df.write.mode("overwrite").option("header", True).csv(path)
