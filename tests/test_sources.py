"""Archives that tasks read, and predictions in the order of the input."""

import csv
import zipfile

import pytest
from pyspark.sql import functions as F

from tabwarden.sources import archives, batches


def zipped(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(f"{name}.csv", text)


def test_many_archives_are_read_by_many_tasks(spark, tmp_path):
    for k in range(6):
        zipped(tmp_path / f"a{k}.zip", first="x,y\n" + "".join(f"{k * 100 + i},v\n" for i in range(50)), second=f'y,z,x\n"q, ""r""",,{k}\n\nshort\n')
    first = archives.read_zipped(spark, str(tmp_path))
    assert first.columns == ["x", "y"] and first.count() == 300 and first.rdd.getNumPartitions() == 6
    both = archives.read_zipped(spark, str(tmp_path / "*.zip"), every=True)
    assert both.columns == ["x", "y", "z"] and both.rdd.getNumPartitions() == 12
    assert sorted(map(tuple, both.where("y <> 'v'").collect()), key=str) == sorted([(str(k), 'q, "r"', None) for k in range(6)] + [(None, "short", None)] * 6, key=str)
    assert both.agg(F.countDistinct("x")).first()[0] == 300


def test_broken_archives_are_left_out(tmp_path, spark):
    zipped(tmp_path / "good.zip", a="x\n1\n")
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("a.txt", "")
    (tmp_path / "bad.zip").write_text("no archive")
    names = ["good", "none", "bad", "absent"]
    sources = [batches.Source(n, str(tmp_path / f"{n}.zip")) for n in names]
    assert list(batches.prepare(sources)) == ["good"]
    with pytest.raises(zipfile.BadZipFile):
        archives.members(str(tmp_path / "bad.zip"))
    before = batches.sources_hash(sources, spark)
    assert before == batches.sources_hash(sources, spark)
    zipped(tmp_path / "good.zip", a="x\n2\n")
    assert before != batches.sources_hash(sources, spark)


def test_predictions_stand_in_the_order_of_the_input(spark, tmp_path):
    (tmp_path / "in").mkdir()
    want = []
    for k in range(4):
        lines = [(str((i * 7919 + k) % 1000), f"t{k}") for i in range(2000 + k)]
        want += lines
        (tmp_path / "in" / f"f{k}.csv").write_text("x,t\n" + "".join(f"{a},{b}\n" for a, b in lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")  # many blocks a file
    try:
        df = batches.with_places(batches.read_raw(spark, str(tmp_path / "in"))).drop("source")
        scored = df.repartition(7, "x").withColumns({"predict": F.lit(0), "predict_proba": F.col("x").cast("double") / 1000})
        batches.write_predictions(scored, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = []
    for part in sorted((tmp_path / "out").glob("part-*")):
        with part.open(newline="") as f:
            got += [tuple(r) for r in list(csv.reader(f))[1:]]
    assert [r[:2] for r in got] == want and all(float(r[3]) == int(r[0]) / 1000 for r in got)
