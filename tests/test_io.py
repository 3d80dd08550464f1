"""Sources, sinks, privacy and streams."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from sparkmart.operators import incremental as I, nested as N, privacy as P
from sparkmart.sources import readers as R, sinks as W
from sparkmart.streaming import jobs as J


def test_token_ranges(spark):
    assert [R.token_range(t) for t in ("2024", "202402", "20240229", "202412")] == [
        (datetime(2024, 1, 1), datetime(2025, 1, 1)), (datetime(2024, 2, 1), datetime(2024, 3, 1)), (datetime(2024, 2, 29), datetime(2024, 3, 1)), (datetime(2024, 12, 1), datetime(2025, 1, 1))]
    assert R.partitions_for(spark, "2024").count() == 366 * 24
    first = R.partitions_for(spark, "20240101").orderBy("hour").first()
    assert first["partition"] == "output/2024/01/01/00"
    with pytest.raises(ValueError):
        R.token_range("2024-01")


def test_window_bounds():
    at = lambda h: datetime(2024, 1, 1, h)
    assert R.window_bounds(at(10), at(23), at(20), 5) == (datetime(2024, 1, 1, 9, 30), datetime(2024, 1, 1, 14, 30))
    assert R.window_bounds(at(10), at(12), at(20), 5)[1] == at(12)
    assert R.window_bounds(None, at(12), at(20), 5) == (at(7), at(12))
    with pytest.raises(ValueError):
        R.window_bounds(at(20), at(10), at(10), 5)


def test_tsv_positions(spark, tmp_path):
    (tmp_path / "log.tsv").write_text("This\tis\ttest\n\n\"a\tb\nx\ty\tz\textra\n")
    got = sorted(tuple(r) for r in R.read_event_tsv(spark, str(tmp_path), ["a", "b", "c"]).fillna("-").collect())
    assert got == [('"a', "b", "-"), ("This", "is", "test"), ("x", "y", "z")]


def test_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    assert W.write_if_changed(df, path) and not W.write_if_changed(df.orderBy("k"), path)
    assert W.write_if_changed(df.dropDuplicates(), path)
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert W.schema_changed(df, df.drop("v")) and not W.schema_changed(df, df.withColumn("_uploaded_at", F.lit(1)))
    W.pump(df, str(tmp_path / "csv"), limit=2, order=["k"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    with pytest.raises(ValueError):
        W.pump(df, str(tmp_path / "csv"), limit=2)
    W.pump(spark.range(1_200_000), str(tmp_path / "all"))
    assert spark.read.csv(str(tmp_path / "all"), header=True).count() == 1_200_000


def test_recent_sample_is_exact(spark):
    df = spark.range(1000).select("id", F.expr("timestamp_ntz'2024-01-30 00:00:00' - make_dt_interval(0, 0, 0, id div 3 * 7)").alias("ts"))
    want = [r["id"] for r in df.orderBy(F.desc("ts"), "id").limit(137).collect()]
    for n in (137, 1, 1000, 5000):
        got = sorted(r["id"] for r in R.recent_sample(df, "ts", "id", 7, n, "2024-01-30").select("id").collect())
        assert got == sorted(r["id"] for r in df.orderBy(F.desc("ts"), "id").limit(n).collect())
    assert len(want) == 137


def test_rollup_clones(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    a = spark.createDataFrame([("1", "x")], "k string, v string")
    out = R.rollup_clones({"t_20240108": a, "t_20240109": a, "t_20240208": a.drop("v"), "t_20231208": a}, schema, "t_20231208", days=[8])
    assert sorted((r["k"], r["v"], r["original_table_name"], str(r["snapshot_date"])) for r in out.collect()) == [(1, None, "t_20240108", "2024-01-08"), (1, None, "t_20240208", "2024-02-08")]


def test_masks_of_all_types(spark):
    df = spark.sql("SELECT 'a' AS s, 1.5D AS f, 7 AS i, array('x') AS arr, parse_json('{\"a\":1}') AS v, date'2020-01-01' AS d, timestamp_ntz'2020-01-01 00:00:00' AS t, true AS b")
    tagged = P.tag(df, **{c: {"masking_policy": "p"} for c in df.columns})
    out = P.mask(tagged, []).withColumn("v", F.to_json("v")).collect()[0]
    assert out[:] == ("***MASKED***", 0.0, 0, ["***MASKED***"], '["***MASKED***"]', None, None, None)
    assert [f.dataType for f in P.mask(tagged, []).schema] == [f.dataType for f in df.schema]
    assert P.mask(tagged, ["p"]).select("s", "i").collect()[0][:] == ("a", 7) == P.mask(tagged, ["loader"]).select("s", "i").collect()[0][:]


def test_erasure_keeps_null_emails(spark):
    df = spark.createDataFrame([(1, " A@x.org ", None), (2, None, "a@X.org"), (3, None, None), (4, "b@x.org", "c")], "k int, email string, note string")
    import hashlib
    sha = hashlib.sha256(b"a@x.org").hexdigest()
    assert sorted(r["k"] for r in P.erase(df, [sha], ["email", "note"]).collect()) == [3, 4]
    subjects = spark.createDataFrame([(sha,)], "email_sha string")
    assert sorted(r["k"] for r in P.erase_subjects(df, subjects, ["email", "note"]).collect()) == [3, 4]
    red = {r["k"]: (r["email"], r["note"]) for r in P.redact(df, [sha], ["email"], ["note"]).collect()}
    assert red[1] == (sha, "GDPR Redacted") and red[2] == (None, "a@X.org")


def test_flatten_reports_depth(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": {"c": 1}}, "d": [1, {"e": null}], "f": "x"}'), (2, "broken")], "id int, doc string")
    got = sorted((r["path"], r["too_deep"]) for r in N.flatten_paths(df, "id", "doc", 2).filter("id = 1").collect())
    assert ("a.b", True) in got and ("d[0]", False) in got and ("f", False) in got
    assert N.flatten_paths(df, "id", "doc").filter("too_deep").count() == 0
    deep = spark.createDataFrame([(1, '{"a":{"b":{"c":{"d":{"e":{"f":1}}}}}}')], "id int, doc string")
    assert [(r["path"], r["value"]) for r in N.flatten_paths(deep, "id", "doc").collect()] == [("a.b.c.d.e.f", "1")]
    boxes = {r["path"]: r["value"] for r in N.flatten_paths(deep, "id", "doc", containers=True).collect()}
    assert set(boxes) == {"a", "a.b", "a.b.c", "a.b.c.d", "a.b.c.d.e", "a.b.c.d.e.f"} and boxes["a.b.c.d.e"] == '{"f":1}'


def test_incremental(spark):
    s = "k int, v string, n int"
    target, batch = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], s), spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], s)
    rows = lambda d: sorted((r["k"], r["v"]) for r in d.collect())
    assert rows(I.upsert(target, batch, "k", [F.desc("n")])) == [(1, "a"), (2, "d"), (3, "e")]
    assert rows(I.insert_new(target, batch, "k")) == [(1, "a"), (2, "b"), (3, "e")]
    assert rows(I.known_only(target, batch, "k")) == [(1, "a"), (2, "b"), (2, "c"), (2, "d")]
    assert I.increment(batch, target.limit(0), "n").count() == 3


@pytest.fixture
def files(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    src = str(tmp_path / "src")
    ev.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(src)
    return ev, src, str(tmp_path / "out")


def test_stream_in_batches_equals_table(spark, files):
    ev, src, out = files
    stream = J.read_stream(spark, src, ev.schema, files_per_batch=1)
    # Files arrive in any order, so the watermark must span the data.
    got = J.tumble_counts(stream, "ts", "1 day", ["event_type"], out + "1", watermark="60 days")
    want = I.tumble(ev, "ts", "1 day", ["event_type"])
    key = lambda d: sorted((str(r["window_start"])[:10], r["event_type"], r["events"]) for r in d.collect())
    assert key(got) == key(want)
    last = J.upsert(J.read_stream(spark, src, ev.schema, 1), "user_id", [F.desc("ts"), F.desc("event_id")], out + "2")
    best = ev.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    assert sorted(r[:] for r in last.select("user_id", "event_id").collect()) == sorted(r[:] for r in best.collect())
    first = J.last_changed(J.read_stream(spark, src, ev.schema, 1), "user_id", ["event_type"], datetime(2024, 2, 1), out + "3")
    assert first.count() == ev.select("user_id", "event_type").distinct().count()
    again = J.last_changed(J.read_stream(spark, src, ev.schema, 1), "user_id", ["event_type"], datetime(2024, 3, 1), out + "3")
    assert again.select("last_changed").distinct().count() == 1


def test_dedupe_stream_drops_replays(spark, files):
    ev, src, out = files
    twice = J.read_stream(spark, src, ev.schema, 1).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    assert J.dedupe(twice, "ts", "event_id", out, watermark="60 days").count() == ev.count()


def test_stream_without_input(spark, tmp_path):
    src = tmp_path / "none"
    src.mkdir()
    stream = J.read_stream(spark, str(src), "event_id long, ts timestamp_ntz, user_id long")
    assert J.upsert(stream, "user_id", [F.desc("ts")], str(tmp_path / "o1")).count() == 0
    assert J.dedupe(stream, "ts", "event_id", str(tmp_path / "o2")).count() == 0
