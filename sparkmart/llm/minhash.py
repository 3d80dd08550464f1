"""Near-duplicates by an inverted join of signature coordinates, confirmed on the full shingle sets.

A document's signature has COORDS coordinates, each the smallest hash of its shingles under one of
as many multipliers. Documents are posted under their coordinate-value pairs, and a pair of documents
is a candidate if it agrees in MATCHES coordinates. At a similarity of exactly 0.75 a pair agrees in
144 of 192 on average, with a deviation of 6.0; fewer than MATCHES = 106 have odds of some 1e-9.

Postings stay short in three ways.
* Skip: a value that one document has cannot collide. Of the first SCOUTS coordinates a linked
  document has fewer than SCOUT_HITS shared ones with odds of some 1e-10; such documents are left out
  before the others are read again and posted in full.
* Prefix: with the values of all documents ordered from rare to frequent, two documents that agree
  in MATCHES of COORDS share one of their COORDS - MATCHES + 1 rarest values. Only those are posted,
  and a passage that many documents hold makes its values frequent, so they fall behind the prefix.
* Merging: documents with equal sets are one. In each posting list all others first meet one hub; a
  document is compared with the hub it shares most lists with. What that joins needs no more
  comparisons. After some rounds, the documents of lists with several components are posted once more
  under their rarest shingles, of those that several components hold, and two of different components
  are paired only if, from a common one on, both have enough of them for a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sparkmart.llm.common import components, stored
from sparkmart.llm.scan import by_bytes, set_id, shingle_sets

WIDTH, NEAR = 5, 75
COORDS, MATCHES = 192, 106
SCOUTS, SCOUT_HITS = 32, 7
#: Rounds with hubs; each takes another one of every list.
ROUNDS = 3
U = np.uint64
#: Odd multipliers; the shingle hashes they meet are mixed already.
MULTIPLIERS = np.array([pow(0x2545F4914F6CDD1D, 2 * i + 1, 2**64) for i in range(COORDS)], dtype=U)


def signature(shingles: np.ndarray, coords: int) -> np.ndarray:
    """The first `coords` minima, of 32 bits."""
    low = np.full(coords, ~U(0), U)
    for at in range(0, len(shingles), 2048):
        np.minimum(low, (shingles[at : at + 2048, None] * MULTIPLIERS[None, :coords]).min(axis=0), out=low)
    return (low >> U(32)).astype(np.uint32)


def signatures(docs: DataFrame, coords: int, sets: bool = False) -> DataFrame:
    """doc_id, n_shingles, set_id, sig, and on request the sorted shingles, of every whole text; NULL without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            n, ids, sigs, held = [], [], [], []
            for s in shingle_sets(batch.column("text").to_pylist(), WIDTH):
                n.append(len(s))
                ids.append(set_id(s) if len(s) else None)
                sigs.append(signature(s, coords).tobytes() if len(s) else None)
                held.append(s.tobytes() if sets else None)
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(sigs, pa.binary())]
            names = ["doc_id", "n_shingles", "set_id", "sig"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(held, pa.binary())] if sets else columns, [*names, "shingles"] if sets else names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_id binary, sig binary" + (", shingles binary" if sets else ""))


def postings(sigs: DataFrame, coords: int) -> DataFrame:
    """(key, doc_id) for every coordinate; the key holds the value and the coordinate."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                flat = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32).reshape(-1, coords).astype(np.int64)
                ids = np.repeat(part.column("doc_id").to_numpy(zero_copy_only=False), coords)
                yield pa.RecordBatch.from_arrays([pa.array(((flat << 8) + np.arange(coords)).ravel()), pa.array(ids, pa.int64())], ["key", "doc_id"])

    return sigs.select("doc_id", "sig").mapInArrow(post, "key long, doc_id long")


def shared(posts: DataFrame) -> DataFrame:
    """Postings whose value several documents have, with their number."""
    often = posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return posts.join(often, "key")


def prefixes(sigs: DataFrame) -> DataFrame:
    """The postings that can join two documents: the rarest shared values of documents that share enough."""
    each = Window.partitionBy("doc_id")
    ranked = shared(postings(sigs, COORDS)).withColumn("at", F.row_number().over(each.orderBy("n", "key"))).withColumn("held", F.count(F.lit(1)).over(each))
    return ranked.filter(F.col("at") <= F.col("held") - MATCHES + 1).select("key", "doc_id")


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, COORDS) for c in ("sig_a", "sig_b"))
        yield batch.filter(pa.array((a == b).sum(axis=1) >= MATCHES)).select(["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "set_a"):
        keep = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            x, y = np.frombuffer(x, U), np.frombuffer(y, U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= NEAR * (len(x) + len(y) - both))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def _attach(pairs: DataFrame, table: DataFrame, column: str, name: str) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(table.select(F.col("doc_id").alias(side), F.col(column).alias(f"{name}_{side}")), side)
    return pairs


def confirmed(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The pairs (a, b) that agree in MATCHES coordinates and whose full sets are NEAR percent alike."""
    likely = stored(_attach(pairs, sigs, "sig", "sig").mapInArrow(_alike, "a long, b long").distinct())
    return stored(_attach(likely, sigs, "shingles", "set").mapInArrow(_linked, "a long, b long").distinct())


def sizes_fit(a: str, b: str):
    """Whether sets of these sizes can be NEAR percent alike."""
    return (F.col(a) * 100 >= F.col(b) * NEAR) & (F.col(b) * 100 >= F.col(a) * NEAR)


def parted(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings of lists that hold several components, with each document's component."""
    known = posts.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("part"))
    divided = known.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x < y").select("key")
    return stored(known.join(divided, "key"))


def spokes(known: DataFrame, turn: int) -> DataFrame:
    """(a, b): each document with the hub, of another component and a size that fits, that most of its lists name."""
    pick = F.xxhash64("doc_id", F.lit(turn)) if turn else F.col("doc_id")
    hubs = known.groupBy("key").agg(F.min(F.struct(pick.alias("pick"), "doc_id", "n_shingles", "part")).alias("hub"))
    hubs = hubs.select("key", F.col("hub.doc_id").alias("a"), F.col("hub.n_shingles").alias("na"), F.col("hub.part").alias("hub_part"))
    met = known.join(hubs, "key").filter((F.col("part") != F.col("hub_part")) & sizes_fit("na", "n_shingles"))
    often = met.groupBy("doc_id", "a").agg(F.count(F.lit(1)).alias("n"))
    return often.groupBy("doc_id").agg(F.max(F.struct("n", (-F.col("a")).alias("a"))).alias("m")).select((-F.col("m.a")).alias("a"), F.col("doc_id").alias("b"))


def exploded(sets: DataFrame) -> DataFrame:
    """(shingle, doc_id) of every shingle of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "shingles", 1 << 20):
            held = batch.column("shingles").to_pylist()
            ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), [len(x) // 8 for x in held])
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(held), np.int64)), pa.array(ids, pa.int64())], ["shingle", "doc_id"])

    return sets.select("doc_id", "shingles").mapInArrow(run, "shingle long, doc_id long")


def reaching(known: DataFrame, sigs: DataFrame) -> DataFrame:
    """(key, doc_id, n_shingles, part, rest): shingles that can be the first one of a link across components.

    A link shares only shingles that several components hold. With those of all documents ordered from
    rare to frequent, `rest` counts a document's from this one on: it bounds what two documents share
    of which this is the first common shingle.
    """
    docs = known.select("doc_id", "n_shingles", "part").distinct()
    each = exploded(sigs.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")).distinct().join(docs.select("doc_id", "part").distinct(), "doc_id")
    far = each.groupBy("shingle").agg(F.min("part").alias("x"), F.max("part").alias("y"), F.count(F.lit(1)).alias("n")).filter("x < y").select("shingle", "n")
    back = Window.partitionBy("doc_id").orderBy(F.col("n").desc(), F.col("shingle").desc())
    ranked = each.select("shingle", "doc_id").join(far, "shingle").withColumn("rest", F.row_number().over(back)).drop("n")
    return stored(ranked.join(docs, "doc_id").filter(F.col("rest") * 100 >= F.col("n_shingles") * NEAR).withColumnRenamed("shingle", "key"))


def enough(rest_a: str, rest_b: str, n_a: str, n_b: str):
    """Whether sets of sizes n that share at most `rest` shingles can be NEAR percent alike."""
    return F.least(rest_a, rest_b) * (100 + NEAR) >= (F.col(n_a) + F.col(n_b)) * NEAR


def across(known: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs of documents of different components that can be linked, by the first shingle they share."""
    known = reaching(known, sigs)
    parts = known.groupBy("key", "part").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"), F.max("rest").alias("rest"))
    one, two = (parts.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("part", "low", "high", "rest"))) for s in "pq")
    fit = (F.col("high_p") * 100 >= F.col("low_q") * NEAR) & (F.col("high_q") * 100 >= F.col("low_p") * NEAR)
    fit = fit & enough("rest_p", "rest_q", "low_p", "low_q")
    both = one.join(two, "key").filter((F.col("part_p") < F.col("part_q")) & fit).select("key", "part_p", "part_q")
    left = known.select("key", F.col("part").alias("part_p"), F.col("doc_id").alias("x"), F.col("n_shingles").alias("nx"), F.col("rest").alias("rx"))
    right = known.select("key", F.col("part").alias("part_q"), F.col("doc_id").alias("y"), F.col("n_shingles").alias("ny"), F.col("rest").alias("ry"))
    pairs = both.join(left, ["key", "part_p"]).join(right, ["key", "part_q"]).filter(sizes_fit("nx", "ny") & enough("rx", "ry", "nx", "ny"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Two documents are linked if their sets of distinct 5-word shingles (A-Z lowered; fewer words:
    all of them as one) share 75 % of their union. component_id is the smallest doc_id that links
    reach; of each component the document with that id is kept. Texts that are NULL or without a
    word are linked with nothing. Rows with equal doc_id are one document, linked if one of them
    is; a NULL doc_id is never linked: its component_id is NULL and it is kept. An empty table stays empty.
    """
    signed = stored(signatures(docs, SCOUTS))
    real = signed.filter(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull())
    heads = stored(real.groupBy("set_id").agg(F.min("doc_id").alias("head")))
    own = real.join(heads, (real.set_id == heads.set_id) & (real.doc_id == heads["head"]), "left_semi").dropDuplicates(["set_id"])

    scouts = shared(postings(own, SCOUTS))
    active = scouts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("hits")).filter(F.col("hits") >= SCOUT_HITS).select("doc_id")
    sigs = stored(signatures(docs.select("doc_id", "text").join(active, "doc_id"), COORDS, sets=True).filter("set_id IS NOT NULL").dropDuplicates(["doc_id", "set_id"]))
    posts = stored(prefixes(sigs).join(sigs.select("doc_id", "n_shingles"), "doc_id").select("key", "doc_id", "n_shingles"))

    links = None
    labels = sigs.limit(0).select(F.col("doc_id").alias("id"), F.col("doc_id").alias("label"))
    for turn in range(ROUNDS + 1):
        known = parted(posts, labels)
        found = confirmed(spokes(known, turn) if turn < ROUNDS else across(known, sigs), sigs)
        links = found if links is None else links.union(found)
        labels = components(links)

    # Rows of one doc_id with different texts tie their sets together.
    ties = real.join(heads, "set_id").filter(F.col("head") != F.col("doc_id")).select(F.col("head").alias("a"), F.col("doc_id").alias("b"))
    several = real.groupBy("doc_id").agg(F.min("set_id").alias("s"), F.max("set_id").alias("t")).filter("s <> t").select(F.col("doc_id").alias("several"))
    links = links.union(ties.join(several, ties.b == several.several, "left_semi"))
    labels = components(links)
    named = signed.join(heads, "set_id", "left").withColumn("node", F.coalesce("head", "doc_id"))
    out = named.join(labels, named.node == labels.id, "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "node")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents of `docs` that stand for their component, all columns as they are."""
    found = near_duplicates(docs).filter(F.col("doc_id").isNotNull() & ~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(found, docs.doc_id == F.col("_gone"), "left_anti")
