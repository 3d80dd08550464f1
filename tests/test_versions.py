"""Versioned tables, erasure by file, and streams whose batches read no earlier results."""

import os

import pytest
from pyspark.sql import functions as F

from sparkmart.sources import versions as V
from sparkmart.streaming import jobs as J


def files(spark, root, part=None):
    m = V.manifest(spark, root)
    return {r.file for r in (m if part is None else m.filter(F.col("part") == part)).collect()}


def rows(df):
    return sorted(map(repr, df.collect()))


def test_only_changed_parts_are_written(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a/b", 1.0), (2, "c=d", 2.0), (3, None, 3.0), (4, "", 4.0), (5, "a/b", None)], "k int, part string, v double")
    assert V.publish(df, root, "part") == ["", "\0", "a/b", "c=d"]
    assert rows(V.read(spark, root)) == rows(df)
    before = files(spark, root)
    assert V.publish(df.orderBy(F.desc("k")), root, "part") == [] and files(spark, root) == before
    changed = df.withColumn("v", F.when(F.col("k") == 2, 9.0).otherwise(F.col("v")))
    assert V.publish(changed, root, "part") == ["c=d"] and rows(V.read(spark, root)) == rows(changed)
    assert files(spark, root, "a/b") < before and not files(spark, root, "c=d") & before
    fewer = changed.filter("part = 'a/b'")
    V.publish(fewer, root, "part")
    assert rows(V.read(spark, root)) == rows(fewer) == rows(V.read(spark, root, ["a/b"]))
    assert V.publish(fewer.withColumnRenamed("v", "w"), root, "part") == ["a/b"]  # a renamed column is a change
    with pytest.raises(FileNotFoundError):
        V.read(spark, str(tmp_path / "none"))


def test_readers_keep_the_old_version_until_the_manifest(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    V.publish(spark.range(3), root)

    def stop(*_):
        raise RuntimeError("lost between the files and the manifest")

    monkeypatch.setattr(V, "_publish", stop)
    with pytest.raises(RuntimeError):
        V.publish(spark.range(9), root)
    assert V.read(spark, root).count() == 3


def test_erasure_leaves_other_files_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(i, f"p{i}@x.org", f"r{i % 5}") for i in range(50)], "k int, email string, region string")
    V.publish(df, root, "region")
    gone = df.filter("k IN (2, 7, 12)").select(F.sha2("email", 256).alias("email_sha"))
    before = {f: os.stat(f.removeprefix("file:")).st_mtime_ns for f in files(spark, root)}
    touched = V.erase(spark, root, gone, ["email"], "region")
    assert rows(V.read(spark, root)) == rows(df.filter("k NOT IN (2, 7, 12)"))
    kept = files(spark, root) & set(before)
    assert set(touched) == set(before) - kept and 0 < len(touched) <= 3
    assert all(os.stat(f.removeprefix("file:")).st_mtime_ns == before[f] for f in kept)
    assert V.erase(spark, root, gone, ["email"], "region") == []
    assert V.publish(df.filter("k NOT IN (2, 7, 12)"), root, "region") == []  # the manifest knows the new contents


def test_upsert_merges_batches(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    every = None
    for n in range(9):
        part = spark.range(200).select((F.col("id") % (40 + n)).alias("k"), F.lit(n).alias("t"), F.col("id").alias("v"))
        part.coalesce(1).write.mode("append").parquet(src)
        every = part if every is None else every.unionByName(part)
        got = J.upsert(J.read_stream(spark, src, part.schema, 1), "k", [F.desc("t"), F.desc("v")], out)
        want = every.groupBy("k").agg(F.max(F.struct("t", "v")).alias("m")).select("k", "m.t", "m.v")
        assert rows(got) == rows(want)
    assert len([d for d in os.listdir(f"{out}/data") if d.startswith("batch_id=")]) <= 5


def test_batches_do_not_read_earlier_results(spark, tmp_path):
    """What a batch scans is its own file: results written before are not in its plan."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    from datetime import datetime
    for n in range(3):
        spark.range(n, n + 5).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v")).coalesce(1).write.mode("append").parquet(src)
        first = J.last_changed(J.read_stream(spark, src, "k long, v long", 1), "k", ["v"], datetime(2024, 1, n + 1), out)
    got = {r.k: r.last_changed.day for r in first.collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 2, 6: 3}
    assert all(len(os.listdir(f"{out}/data/{d}")) for d in os.listdir(f"{out}/data"))


def test_streams_without_rows(spark, tmp_path):
    (tmp_path / "none").mkdir()
    from datetime import datetime
    stream = J.read_stream(spark, str(tmp_path / "none"), "k long, v string")
    good, bad = J.route(stream, F.col("v").isNull(), str(tmp_path / "a"))
    assert good.count() == bad.count() == 0
    assert J.last_changed(stream, "k", ["v"], datetime(2024, 1, 1), str(tmp_path / "b")).count() == 0
    assert J.upsert(stream, "k", ["v"], str(tmp_path / "c")).count() == 0
