"""Structured Streaming jobs.

Every job drains what is available and stops (`availableNow`), with its progress in a
checkpoint folder. Results are written one folder per micro-batch and overwritten when
a batch is replayed after a failure, so each batch counts once. Readers take the newest
row per key.

What a job must remember of earlier batches is keyed state in RocksDB with a change log: a batch
reads its own input and the state of its keys, never the results written so far.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkmart.functions import as_col, surrogate_key
from sparkmart.operators import incremental as inc, topk
from sparkmart.sources import sinks


STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet file stream over a folder or glob."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def event_time(df, ts) -> DataFrame:
    """Watermarks need a TIMESTAMP; a zone-less column is read as UTC."""
    return df.withColumn(ts, as_col(ts).cast("timestamp"))


def drain(stream: DataFrame, folder: str, mode: str, write: Callable[[DataFrame, int], None] | None = None) -> str:
    """Run a streaming query over all available input; returns the data folder."""
    data = f"{folder.rstrip('/')}/data"

    def default(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{data}/batch_id={batch_id}")

    for key, value in STATE.items():
        stream.sparkSession.conf.set(key, value)
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder.rstrip('/')}/checkpoint")
             .trigger(availableNow=True).foreachBatch(write or default).start())
    query.awaitTermination()
    return data


def drained(stream: DataFrame, data: str, schema=None) -> DataFrame:
    """Rows of a drained folder; empty when no batch had any input yet."""
    spark = stream.sparkSession
    if sinks.path_exists(spark, data):
        return spark.read.parquet(data)
    return spark.createDataFrame([], schema or stream.schema).withColumn("batch_id", F.lit(0))


def tumble_counts(stream, ts, width, keys, folder, watermark="30 minutes") -> DataFrame:
    """Tumbling counts kept up to date by window and key."""
    counted = inc.tumble(event_time(stream, ts).withWatermark(ts, watermark), ts, width, keys)
    data = drain(counted, folder, "update")
    return topk.latest_per_key(drained(counted, data), ["window_start", *keys], [F.desc("batch_id")]).drop("batch_id")


def dedupe(stream, ts, key, folder, watermark="30 minutes") -> DataFrame:
    """One row per key; state is dropped once the watermark has passed."""
    once = event_time(stream, ts).withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])
    return drained(once, drain(once, folder, "append")).drop("batch_id")


def session_counts(stream, ts, gap, keys, folder, watermark="30 minutes") -> DataFrame:
    """Closed sessions, appended as the watermark passes their end."""
    closed = inc.session(event_time(stream, ts).withWatermark(ts, watermark), ts, gap, keys)
    return drained(closed, drain(closed, folder, "append")).drop("batch_id")


def enrich(stream, dim, key, folder) -> DataFrame:
    """Stream-static join."""
    joined = inc.enrich(stream, dim, key)
    return drained(joined, drain(joined, folder, "append")).drop("batch_id")


def route(stream, bad, folder) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad rows in two outputs of one pass; the batch is read once."""
    spark, root = stream.sparkSession, folder.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("side", F.when(F.coalesce(bad, F.lit(False)), "bad").otherwise("good"))
        tagged.write.mode("overwrite").partitionBy("side").parquet(f"{root}/data/batch_id={batch_id}")

    data = drain(stream, folder, "append", write)
    rows = drained(stream.withColumn("side", F.lit("")), data).drop("batch_id")
    return rows.filter("side = 'good'").drop("side"), rows.filter("side = 'bad'").drop("side")


def upsert(stream, key, order, folder) -> DataFrame:
    """Latest row per key. order: descending columns with a unique tiebreak.

    The newest row of a key is state; a batch writes the keys it touched. Written batches are merged
    when they are as large as what was merged before, so readers meet a number of folders that grows
    with the logarithm of all rows, and a row is merged as often as that.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = [c if isinstance(c, str) else re.search(r"'(.*?) DESC", str(c))[1] for c in order]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), F.struct(*names))
    rows = stream.groupBy(*keys).agg(newest.alias("__row")).select("__row.*")
    data = drain(rows, folder, "update")
    winners = lambda df: topk.latest_per_key(df, keys, [F.desc(n) for n in names])
    if sinks.path_exists(stream.sparkSession, data):
        compact(stream.sparkSession, data, winners)
    return winners(drained(rows, data, stream.schema).drop("batch_id"))


def compact(spark, data: str, merge: Callable[[DataFrame], DataFrame]) -> int:
    """Merge the newest batches of a folder, as far back as those before are no larger than twice what
    follows; returns the number of folders left. A merge of batches up to n is folder -(n + 1). The old
    folders go last: until then readers meet rows twice, which `merge` is to take for one."""
    fs, path = sinks._fs(spark, data)
    found = [(int(s.getPath().getName().split("=")[1]), s.getPath()) for s in fs.listStatus(path) if s.getPath().getName().startswith("batch_id=")]
    runs = sorted(((n if n >= 0 else -n - 1, p, fs.getContentSummary(p).getLength()) for n, p in found), key=lambda r: (r[0], r[1].getName()))
    take, size = [runs[-1]], runs[-1][2]
    for run in reversed(runs[:-1]):
        if run[2] > 2 * size:
            break
        take.append(run)
        size += run[2]
    if len(take) < 2:
        return len(runs)
    last = max(r[0] for r in take)
    beside = f"{data}/../merging-{uuid.uuid4().hex}"
    merge(spark.read.parquet(*[r[1].toString() for r in take])).write.parquet(beside)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{data}/batch_id={-(last + 1)}")
    old = [p for _, p, _ in take if p.getName() != target.getName()]
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(beside), target):
        raise OSError(f"cannot put {target.toString()} in place")
    for p in old:
        fs.delete(p, True)
    return len(runs) - len(take) + 1


def last_changed(stream, key, cols, now: datetime, folder) -> DataFrame:
    """Time each content hash was first seen, kept across batches: hashes seen are keyed state."""
    hashed = stream.select(key, surrogate_key(*cols).alias("content_hash")).dropDuplicates([key, "content_hash"])
    hashed = hashed.withColumn("last_changed", F.lit(now).cast("timestamp_ntz"))
    return drained(hashed, drain(hashed, folder, "append")).drop("batch_id")


def increment(spark, path, schema, folder) -> DataFrame:
    """Files not yet read: the checkpoint is the high watermark."""
    stream = read_stream(spark, path, schema)
    return drained(stream, drain(stream, folder, "append")).drop("batch_id")
