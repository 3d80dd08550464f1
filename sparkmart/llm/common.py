"""Helpers the operators share: words, stored intermediates, ranks without a hot task, components."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkmart.session import ensure_checkpoint_dir, tune

#: The six white-space characters between words, as text and as a regular expression.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


#: Rows and bytes of the batches that tasks hand to Python: what a worker holds at a time.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder, in a session that sends small batches to Python."""
    tune(spark)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole(text) -> Column:
    """The text, '' for NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_array(text) -> Column:
    """Words of a text: maximal runs of other than the six blanks; none for NULL."""
    bare = F.btrim(whole(text), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only where it is unset."""
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def stored(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Written to the shared folder and read again: computed once, lineage cut, safe when executors are lost. `codec` compresses large texts harder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/sparkmart-llm/{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash32(key) -> Column:
    """0 to 2**32 - 1 from the key's text, the same in every engine that has MD5."""
    c = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")


def rank_within(df: DataFrame, groups: list[str], hashed: str, ties: list[str], rank: str, bands: list[str] | None = None) -> DataFrame:
    """Add the place, from 1, of a row in its group in the order (bands, hashed, ties).

    No group is sorted in one task. The range of `hashed` (0 to 2**32 - 1) is cut into a number of
    chunks that follows the root of the row count; chunks are counted, the counts summed over the
    chunks before, and rows only ranked inside their chunk.
    """
    bands = bands or []
    chunk, before, n = f"{rank}_chunk", f"{rank}_before", f"{rank}_n"
    bits = min(12, max(4, round(math.log2(max(1, df.count())) / 2) - 2))
    df = df.withColumn(chunk, F.shiftright(F.col(hashed), 32 - bits))
    part = [*groups, *bands, chunk]
    # NULL groups meet in the join below through a hash of all parts.
    tag = f"{rank}_tag"
    df = df.withColumn(tag, F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(f"p{i}") for i, c in enumerate(part))))
    counts = df.groupBy(tag, *part).agg(F.count(F.lit(1)).alias(n))
    frame = Window.partitionBy(*groups).orderBy(*bands, chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(tag, F.coalesce(F.sum(n).over(frame), F.lit(0)).alias(before))
    inside = Window.partitionBy(tag).orderBy(hashed, *ties)
    return (
        df.withColumn(rank, F.row_number().over(inside))
        .join(offsets, tag)
        .withColumn(rank, (F.col(rank) + F.col(before)).cast("long"))
        .drop(chunk, before, tag)
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label): label is the smallest id reachable over the undirected edges.

    Every round takes the smallest label among a node's neighbours, then follows the label's own
    label, so chains shrink by half or better. Minima combine before the shuffle; a node with very
    many edges only widens a join that Spark splits.
    """
    both = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(F.col(b), F.col(a))).distinct())
    labels = stored(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m")).select("id", F.least("id", "m").alias("label")))
    while True:
        heard = both.join(labels, both.v == labels.id).groupBy("u").agg(F.min("label").alias("heard"))
        lower = labels.join(heard, labels.id == heard.u).select("id", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        up = lower.select(F.col("id").alias("at"), F.col("label").alias("jump"))
        after = stored(lower.join(up, lower.label == up.at).select("id", "old", F.least("label", "jump").alias("label")))
        labels = after.select("id", "label")
        if after.filter(F.col("label") != F.col("old")).isEmpty():
            return labels
