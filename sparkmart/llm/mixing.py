"""Mixing sources to target weights by systematic sampling of whole documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkmart.llm.common import hash32, rank_within, stored, word_array

#: Documents of a source are ordered by size to within one part in BAND, then by hash.
BAND = 32


def size_band(size: Column) -> Column:
    """Increasing in size; a band spans one part in BAND of its sizes, one size below 2 * BAND."""
    high = F.length(F.bin(size)) - 6
    return F.when(size < 2 * BAND, size).otherwise(F.call_function("shiftright", size, high.cast("int")) + BAND * high).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> target words.

    Sources in the order of their code points, NULL last, weigh `weights` in turn and share `share`
    of all sizes; no target passes `most` times its source's size, the rest goes to the others by
    weight. The level of the others follows in one pass: sources fill up in the order of their
    capacity per unit of weight.
    """
    if most < share:
        raise ValueError("the sources cannot hold the mix")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.pmod(rank - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    filling = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capacity = F.col("source_size") * most
    return (
        sizes.withColumn("weight", weight)
        .withColumn("budget", F.sum("source_size").over(every) * share)
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
        .withColumn("level", F.col("left") / F.sum("weight").over(after))
        # The first source in filling order whose capacity lies above its level ends the full ones.
        .withColumn("open", F.col("level") * F.col("weight") < capacity)
        .withColumn("final", F.min(F.when(F.col("open"), F.struct(F.row_number().over(filling).alias("at"), F.col("level").alias("level")))).over(every))
        .withColumn("target", F.when(F.col("final").isNull(), capacity).otherwise(F.least(capacity, F.col("final.level") * F.col("weight"))))
        .select("source", "source_size", F.col("target").cast("double").alias("target"))
    )


def copies(rank: Column, rate: Column, offset: Column) -> Column:
    """Integer boundaries in (rate * (rank - 1) + offset, rate * rank + offset]."""
    return (F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset)).cast("long")


def mix(
    df: DataFrame, size: str, source: str = "source", key: str = "doc_id", weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """Add source_size, target and copies: how often the mix takes each row.

    Within a source every row expects target / source_size copies. Those expectations are summed
    along the source, one random offset per source (from `seed`) is added, and a row is taken once
    for every integer the sum crosses, so no row is taken more than `most` times, rounded up. Rows stand in
    the order of size, so neighbours stand in for each other and the words taken differ from the
    target by about one of the largest rows at most. Reruns agree. NULL sources form a source, NULL keys count
    as the empty key; rows equal in source, size and key are interchangeable; rows of size 0 are
    counted like others. An empty table stays empty. Columns of the added names are replaced. `df` is
    read three times: pass a stored table.
    """
    df = df.drop("source_size", "target", "copies")
    s, band, h, rank = "mix_source", "mix_band", "mix_hash", "mix_rank"
    sizes = df.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("source_size"))
    goal = targets(sizes, weights, share, most).withColumnRenamed("source", s)
    placed = df.withColumn(band, size_band(F.col(size))).withColumn(h, hash32(key))
    ranked = rank_within(placed, [source], h, [key, size], rank, bands=[band])
    out = ranked.join(goal, F.col(source).eqNullSafe(F.col(s)))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = hash32(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(source), F.lit("")))) / float(2**32)
    return out.withColumn("copies", copies(F.col(rank), rate, offset)).drop(s, band, h, rank)


def repeat(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    each = mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(*columns)


def digest(docs: DataFrame) -> DataFrame:
    """Words taken of every document."""
    slim = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), F.size(word_array("text")).cast("long").alias("size")))
    out = mix(slim, "size")
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
