"""Line dedup by a segment-partition edit join.

Lines are compared in lower case (A-Z) with white space runs as one blank. Two lines within `threshold` edits
of code points: cut the shorter into threshold + 1 even segments and one of them is a substring of the
longer, near its place. So every line is posted under its segments (with its length and the segment's
number) and looked up under the substrings that can stand there for its own and each shorter length.

A posting list with few lines gives candidate pairs, verified by a banded bit-parallel edit distance.
A long list would give their square. For a threshold of 1 its lines are instead posted once more
under each text that one deletion leaves: lines that agree there, with the place, differ by one
replacement, all of them among each other; so a star of links holds them together, and the work
follows the length of the lines. Thresholds over 1 pair long lists in full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkmart.llm.common import components, stored
from sparkmart.llm.scan import U, Hasher, blank, by_bytes, code_points, groups, lower, mixed, word_bounds

THRESHOLD = 1
#: Lines with fewer words get no near links: short lines are alike by chance.
LEAST_WORDS = 8
#: Words of a line from which exact copies of it count, in the registered query and the pipeline.
LEAST_EXACT = 1
#: Lines of a posting list that are paired directly.
SHORT_LIST = 32
TAG = U(0xA24BAED4963EE407)
#: Kinds of the keys of `one_deleted`.
PLACED, SHORTER, WHOLE = 0, 1, 2


class Lines:
    """Normal forms of the lines, with LEAST_WORDS words at least, of some texts."""

    def __init__(self, texts: list[str], least: int):
        raw = code_points("\n".join(texts))
        starts, ends = word_bounds(raw)
        points = lower(raw)
        newlines = np.flatnonzero(raw == 10)
        row = np.repeat(np.arange(len(newlines) + 1), np.diff(np.searchsorted(starts, newlines), prepend=0, append=len(starts)))
        first = np.flatnonzero(np.diff(row, prepend=-1))
        last = np.append(first[1:], len(row)) - 1 if len(first) else first
        enough = (last - first + 1) >= least
        first, last = first[enough], last[enough]
        # A word is kept with the blank behind it; any other white space goes.
        keep = np.append(~blank(raw), False)
        points = np.where(keep[:-1], points, 32)
        keep[ends] = True
        self.points = points[keep[:-1]]
        place = np.cumsum(ends - starts + 1)
        self.start, self.end = place[first] - (ends - starts + 1)[first], place[last] - 1
        size = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.text = np.searchsorted(size, starts[first], side="right") - 1
        self.number = (row[first] - np.searchsorted(newlines, size[self.text])).astype(np.int32)

    def ids(self) -> list[bytes]:
        """128 bits of the normal form."""
        held = memoryview(self.points.tobytes())
        return [hashlib.blake2b(held[a:b], digest_size=16).digest() for a, b in zip((self.start * 4).tolist(), (self.end * 4).tolist())]

    def forms(self) -> list[str]:
        held = memoryview(self.points.tobytes())
        return [str(held[a:b], "utf-32-le", "surrogatepass") for a, b in zip((self.start * 4).tolist(), (self.end * 4).tolist())]

    def posts(self, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, key, whether the key is a segment of the line's own partition)."""
        long = np.flatnonzero(self.end - self.start > threshold)
        start, size = self.start[long], (self.end - self.start)[long]
        find = Hasher(self.points)
        out = []
        for less in range(threshold + 1):
            own = size - less
            ok = own > threshold
            for i in range(threshold + 1):
                base, rest = own // (threshold + 1), own % (threshold + 1)
                plain = threshold + 1 - rest  # the last `rest` segments are one longer
                at = i * base + np.maximum(0, i - plain)
                width = base + (i >= plain)
                for shift in range(max(-i, less - (threshold - i)), min(i, less + (threshold - i)) + 1):
                    a = at + shift
                    good = np.flatnonzero(ok & (a >= 0) & (a + width <= size))
                    found = find(start[good] + a[good], start[good] + a[good] + width[good])
                    key = mixed(found + own[good].astype(U) * TAG + U((i + 1) * 0x9FB21C651E98DF25 % 2**64))
                    out.append((long[good], key.view(np.int64), np.full(len(good), less == 0 and shift == 0)))
        return tuple(np.concatenate(x) for x in zip(*out))


def lines(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, line, id): the number, from 0, of every line with enough words in its text, and what it says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            for at, held in groups(batch.column("text").to_pylist()):
                found = Lines(held, least)
                doc = batch.column("doc_id").take(pa.array(found.text + at))
                yield pa.RecordBatch.from_arrays([doc, pa.array(found.number), pa.array(found.ids(), pa.binary())], ["doc_id", "line", "id"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, line int, id binary")


def short(ids: list[bytes]) -> pa.Array:
    """The first 64 bits; texts are told apart by all bits once a candidate is read."""
    return pa.array(np.frombuffer(b"".join(i[:8] for i in ids), np.int64))


def posts(docs: DataFrame, threshold: int, least: int = LEAST_WORDS) -> DataFrame:
    """(key, short, own) of all lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            for _, held in groups(batch.column("text").to_pylist()):
                found = Lines(held, least)
                if len(found.start):
                    row, key, own = found.posts(threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(key), short(found.ids()).take(pa.array(row)), pa.array(own)], ["key", "short", "own"])

    return docs.select("text").mapInArrow(run, "key long, short long, own boolean")


def forms(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """(short, id, form) of all lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            for _, held in groups(batch.column("text").to_pylist()):
                found = Lines(held, least)
                ids = found.ids()
                yield pa.RecordBatch.from_arrays([short(ids), pa.array(ids, pa.binary()), pa.array(found.forms())], ["short", "id", "form"])

    return docs.select("text").mapInArrow(run, "short long, id binary, form string")


def within(a: str, b: str, threshold: int) -> bool:
    """Whether a and b are at most `threshold` edits apart.

    Bit k of near[d] tells whether a[: j + k - threshold] and b[:j] are within d edits; only that band can matter.
    """
    if abs(len(a) - len(b)) > threshold:
        return False
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return True
    x, y = code_points(a), code_points(b)
    head = int(np.argmax(x[:n] != y[:n]))
    x, y = x[head:], y[head:]
    n -= head
    differs = x[::-1][:n] != y[::-1][:n]
    tail = int(np.argmax(differs)) if differs.any() else n
    p, q = x[: len(x) - tail].tolist(), y[: len(y) - tail].tolist()
    band = (1 << (2 * threshold + 1)) - 1
    near = [((1 << (d + 1)) - 1) << threshold & band for d in range(threshold + 1)]
    for j, c in enumerate(q, 1):
        match = 0
        valid = 0
        for k in range(2 * threshold + 1):
            i = j + k - threshold
            if 0 <= i <= len(p):
                valid |= 1 << k
                if i and p[i - 1] == c:
                    match |= 1 << k
        after = [near[0] & match]
        for d in range(1, threshold + 1):
            after.append(((near[d] & match) | near[d - 1] | (near[d - 1] >> 1) | (after[d - 1] << 1)) & valid)
        near = after
        if not near[threshold]:
            return False
    end = len(p) - len(q) + threshold
    return 0 <= end <= 2 * threshold and bool(near[threshold] >> end & 1)


def verified(pairs: DataFrame, texts: DataFrame, threshold: int, by: str = "short") -> DataFrame:
    """(a, b), a < b: ids of the lines behind pairs (x, y) of short or full ids that are within the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [within(p, q, threshold) for p, q in zip(batch.column("form_x").to_pylist(), batch.column("form_y").to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    for side, ident in (("x", "id_x"), ("y", "id_y")):
        pairs = pairs.join(texts.select(F.col(by).alias(side), F.col("id").alias(ident), F.col("form").alias(f"form_{side}")), side)
    near = F.abs(F.char_length("form_x") - F.char_length("form_y")) <= threshold
    ordered = pairs.filter(near & (F.col("id_x") != F.col("id_y"))).select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"), "form_x", "form_y")
    return ordered.mapInArrow(run, "a binary, b binary").distinct()


def one_deleted(texts: DataFrame) -> DataFrame:
    """(key, id, kind): keys PLACED for every place whose character is left out, SHORTER for every text that leaves, WHOLE for the line.

    Lines that share a PLACED key differ by one replacement there. A SHORTER key, one for each run of
    equal characters, is the WHOLE key of the line that is that text: one insertion apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "form", 1 << 18):
            ids, keys, counts, kinds = batch.column("id"), [], [], []
            for form in batch.column("form").to_pylist():
                points = code_points(form)
                find, n = Hasher(points), len(points)
                at, zero = np.arange(n), np.zeros(n, np.int64)
                left = find(zero, at) + (find.sums[n] - find.sums[at + 1]) * U(pow(0x9E3779B97F4A7C15, -1, 2**64))
                runs = np.flatnonzero(np.diff(points.astype(np.int64), prepend=-1))
                placed = mixed(left + (at + 1).astype(U) * TAG + U(n))
                shorter = mixed(mixed(left[runs]) + U(n - 1))
                itself = mixed(mixed(find.sums[n : n + 1]) + U(n))
                keys.append(np.concatenate((placed, shorter, itself)))
                counts.append(len(keys[-1]))
                kinds.append(np.repeat(np.array([PLACED, SHORTER, WHOLE], np.int32), [n, len(runs), 1]))
            rows = np.repeat(np.arange(len(counts)), counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), ids.take(pa.array(rows)), pa.array(np.concatenate(kinds))], ["key", "id", "kind"])

    return texts.select("id", "form").mapInArrow(run, "key long, id binary, kind int")


def links(docs: DataFrame, threshold: int = THRESHOLD, least: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """(a, b) that tie all lines within the threshold together, and (id, n_links): how many other lines each is within."""
    every = stored(posts(docs, threshold, least).distinct())
    several = every.groupBy("key").agg(F.min("short").alias("low"), F.max("short").alias("high"), F.count(F.lit(1)).alias("n"), F.max("own").alias("any_own"))
    several = several.filter((F.col("low") < F.col("high")) & F.col("any_own")).select("key", "n")
    held = stored(every.join(several, "key"))
    brief = F.lit(True) if threshold != 1 else F.col("n") <= SHORT_LIST
    one, two = held.filter(brief).select("key", F.col("short").alias("p")), held.filter(brief & F.col("own")).select("key", F.col("short").alias("q"))
    pairs = stored(one.join(two, "key").filter("p <> q").select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct())
    crowded = held.filter(~brief).select("short").distinct()
    wanted = stored(pairs.select(F.col("x").alias("short")).union(pairs.select("y")).distinct().withColumn("crowd", F.lit(False)).union(crowded.withColumn("crowd", F.lit(True))).groupBy("short").agg(F.max("crowd").alias("crowd")))
    texts = stored(forms(docs, least).join(wanted, "short").dropDuplicates(["id"]))
    found = stored(verified(pairs, texts, threshold))

    crowd = texts.filter("crowd")
    left = stored(one_deleted(crowd))
    hubs = left.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("kind") != WHOLE, F.col("id"))).alias("hub"), F.max("kind").alias("top"))
    hubs = hubs.filter(f"n > 1 AND top <> {SHORTER}").select("key", "n", F.col("hub.id").alias("hub"), "top")
    spokes = stored(left.join(hubs, "key"))
    tied = verified(spokes.filter(F.col("id") != F.col("hub")).select(F.least("id", "hub").alias("x"), F.greatest("id", "hub").alias("y")).distinct(), crowd, threshold, "id")
    # Pairs of two crowded lines are counted from the keys, all others from the verified pairs.
    by_key = spokes.groupBy("id").agg(F.sum(F.when((F.col("top") == PLACED) | (F.col("kind") == WHOLE), F.col("n") - 1).otherwise(F.lit(1))).alias("n"))
    known = crowd.select(F.col("id").alias("c"))
    ends = found.join(known.withColumnRenamed("c", "ca"), F.col("a") == F.col("ca"), "left").join(known.withColumnRenamed("c", "cb"), F.col("b") == F.col("cb"), "left")
    ends = ends.filter(F.col("ca").isNull() | F.col("cb").isNull())
    by_pair = ends.select(F.col("a").alias("id")).union(ends.select("b")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    degrees = by_pair.union(by_key).groupBy("id").agg(F.sum("n").alias("n_links"))
    return found.union(tied), degrees


def repeated(docs: DataFrame, threshold: int = THRESHOLD, least: int = LEAST_WORDS, exact: int | None = None) -> DataFrame:
    """(doc_id, line, keeper_doc, keeper_line, n_links) of every line whose class has several occurrences.

    Classes are the components of the links; lines of fewer than `least` but at least `exact` words
    (`least` by default) are in a class with their exact copies only. A class's first line in the order
    (doc_id, line), NULL doc_id first, is its keeper. n_links counts the other texts within the threshold.
    """
    found = stored(lines(docs, least if exact is None else min(exact, least)))
    edges, degrees = links(docs, threshold, least)
    firsts = found.groupBy("id").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
    labels = components(edges).withColumnRenamed("id", "node")
    classed = stored(firsts.join(labels, firsts.id == labels.node, "left").withColumn("class", F.coalesce("label", "id")))
    keepers = classed.groupBy("class").agg(F.min("first").alias("keeper"), F.sum("n").alias("many")).filter("many > 1")
    table = classed.join(keepers, "class").join(degrees, "id", "left").select("id", "keeper", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return found.join(table, "id").select("doc_id", "line", F.col("keeper.doc_id").alias("keeper_doc"), F.col("keeper.line").alias("keeper_line"), "n_links")


def dropped(docs: DataFrame, threshold: int = THRESHOLD, least: int = LEAST_WORDS, exact: int | None = None) -> DataFrame:
    """One row per doc_id that has repeated lines: the numbers of those to drop, all repeated lines with their keepers, and links."""
    rows = repeated(docs, threshold, least, exact)
    gone = ~(F.col("doc_id").eqNullSafe(F.col("keeper_doc")) & (F.col("line") == F.col("keeper_line")))
    return rows.groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.when(gone, F.col("line")))).alias("drop"),
        F.array_sort(F.collect_set(F.struct("line", "keeper_doc", "keeper_line"))).alias("classes"),
        F.sum("n_links").alias("n_links"),
    )


def dedup_lines(docs: DataFrame, threshold: int = THRESHOLD, least: int = LEAST_WORDS, exact: int | None = None) -> DataFrame:
    """The documents without the lines that an earlier document or line holds; all columns as they are.

    Lines of fewer words than `exact` (`least` by default) stay. A document none of whose words is left goes; one that had
    no word, or a NULL text, stays as it is. Rows with equal doc_id are one document: a line that is
    kept in one of them is kept in all. An n_chars column is set to the new length. An empty table stays empty.
    """
    gone = dropped(docs, threshold, least, exact).filter(F.size("drop") > 0).select(F.col("doc_id").alias("_of"), F.col("drop").alias("_drop"))
    joined = docs.join(gone, docs.doc_id.eqNullSafe(F.col("_of")), "left").drop("_of")
    at = joined.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            texts, keep = [], []
            for text, drop in zip(batch.column("text").to_pylist(), batch.column("_drop").to_pylist()):
                if drop and text:
                    drop = set(drop)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
                    keep.append(bool(text.strip(" \t\n\x0b\x0c\r")))
                else:
                    keep.append(True)
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            out = pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(keep, pa.bool_()))
            yield out.select([c for c in out.schema.names if c != "_drop"])

    out = joined.mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def digest(docs: DataFrame, exact: int | None = None) -> DataFrame:
    """One row per document: its lines, those dropped, the classes of its repeated lines, and links."""
    found = dropped(docs, exact=exact)
    rows = docs.select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    none = F.array().cast("array<int>")
    joined = rows.join(found.withColumnRenamed("doc_id", "_of"), F.col("doc_id").eqNullSafe(F.col("_of")), "left")
    return joined.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("drop", none).alias("dropped"),
        F.coalesce("classes", F.array().cast("array<struct<line:int,keeper_doc:bigint,keeper_line:int>>")).alias("classes"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
