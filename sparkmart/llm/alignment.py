"""Tokens of two vocabularies aligned over the corpus, by inverted pair bitmaps.

Where tokens of both vocabularies end at the same byte, a text falls into groups; a group links each
token of the first vocabulary (A) with each of the second (B). Documents are numbered in blocks. A
block keeps one posting per linked pair: the compressed bitmap of the block's documents that hold the
pair, and, over its members, one plane per bit of the number of links. Blocks hold different
documents, so the OR of a pair's bitmaps lays them side by side: its popcount is the sum of theirs,
and the planes' popcounts, each doubled, give the links. A pair's score then goes to its postings, and
the postings of a block return it to the block's documents, as often as the planes say.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkmart.llm.common import stored
from sparkmart.llm.scan import by_bytes

#: A block ends when it has so many documents, or (document, pair) entries; one document is never split.
DOCS, ENTRIES = 1 << 14, 1_500_000
#: Pairs of tokens in a group beyond which equal tokens are counted before they are paired.
WIDE = 1 << 12

MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def default_files() -> tuple[str, str]:
    """Paths of two public vocabularies: byte-level BPE and pieces."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file. Where ids follow the merges, the same vocabulary is read as ranks, which encode faster."""

    def __init__(self, spec: bytes):
        import tokenizers

        self.slow = tokenizers.Tokenizer.from_str(spec.decode())
        self.slow.encode_special_tokens = True
        letters = byte_letters()
        vocab = self.slow.get_vocab(with_added_tokens=False)
        self.table = [b""] * (1 + max(self.slow.get_vocab().values()))
        for token, i in vocab.items():
            self.table[i] = bytes(map(letters.__getitem__, token)) if all(c in letters for c in token) else token.encode()
        self.fast = self._ranks(json.loads(spec), vocab)

    def _ranks(self, spec: dict, vocab: dict[str, int]):
        import public_tokenizers
        import tiktoken

        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = not spec["normalizer"] and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        plain &= split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
        plain &= len(set(self.table)) >= len(vocab) and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and len(vocab) == 256 + len(merges)
        if not plain:
            return None
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks={self.table[i]: i for i in vocab.values()}, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


class Pieces:
    """A piece model, which adds the blank before a text itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.table = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text[1:]), np.uint32)


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... first[0] + size[0] - 1, first[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Values that two sorted arrays have in common, each once."""
    x = x[np.append(True, x[1:] != x[:-1])]
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return x[y[at] == x]


class Speller:
    """Bytes and decimal digits of tokens, many at once."""

    def __init__(self, table: list[bytes]):
        self.size = np.array([len(t) for t in table], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.width = len(str(len(table)))
        said = [str(i).rjust(self.width).encode() for i in range(len(table))]
        self.digits = np.frombuffer(b"".join(said), np.uint8).reshape(-1, self.width)

    def text(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ranges(self.first[ids], self.size[ids])]


class Aligner:
    """Aligns texts on one worker."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.say_a, self.say_b = Speller(self.a.table), Speller(self.b.table)
        self.n_b = len(self.b.table)
        self.pairs = len(self.a.table) * self.n_b

    def faithful(self, say: Speller, ids: list[np.ndarray], whole: list[bytes]) -> np.ndarray:
        """Whether the tokens' bytes, joined, are the text's."""
        flat = np.concatenate([np.empty(0, np.int64), *ids]).astype(np.int64)
        stop = np.cumsum([len(x) for x in ids])
        upto = np.concatenate(([0], np.cumsum(say.size[flat])))
        size = np.diff(upto[np.concatenate(([0], stop)).astype(np.int64)])
        want = np.array([len(t) for t in whole])
        ok = size == want
        if ok.all():
            got, said = say.text(flat), np.frombuffer(b"".join(whole), np.uint8)
            wrong = np.flatnonzero(got != said)
            ok[np.searchsorted(np.cumsum(want), wrong, "right")] = False
            return ok
        return np.array([k and say.text(x.astype(np.int64)).tobytes() == t for k, x, t in zip(ok, ids, whole)], bool)

    def align(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray]:
        """Measures and digest of every text; (text * pairs + pair, links) of what it links, in that order."""
        n = len(texts)
        out = {k: np.zeros(n, np.int64) for k in MEASURES}
        sums = [""] * n
        held = np.array([i for i, t in enumerate(texts) if t], np.int64)
        said = [" " + texts[i] for i in held]
        ids_a, ids_b, whole = [self.a.encode(t) for t in said], [self.b.encode(t) for t in said], [t.encode() for t in said]
        if held.size:
            ok = self.faithful(self.say_a, ids_a, whole) & self.faithful(self.say_b, ids_b, whole)
            held = held[ok]
            ids_a, ids_b = ([x for x, good in zip(ids, ok) if good] for ids in (ids_a, ids_b))
        if not held.size:
            return out, sums, np.empty(0, np.int64), np.empty(0, np.int64)
        text_a, text_b = (np.repeat(np.arange(len(held)), [len(x) for x in ids]) for ids in (ids_a, ids_b))
        a, b = np.concatenate(ids_a).astype(np.int64), np.concatenate(ids_b).astype(np.int64)
        # Both vocabularies spell the same bytes, so ends count through all texts alike. Tokens of no byte end with the token before.
        end_a, end_b = np.cumsum(self.say_a.size[a]), np.cumsum(self.say_b.size[b])
        common = shared(end_a, end_b)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        text_of = text_a[first_a]
        links = in_a * in_b
        for name, values, weights in (("n_a", text_a, None), ("n_b", text_b, None), ("n_groups", text_of, None)):
            out[name][held] = np.bincount(values, minlength=len(held))
        total = np.zeros(len(held), np.int64)
        np.add.at(total, text_of, links)
        out["n_links"][held] = total
        for i, digest in zip(held.tolist(), self.digests(a, b, group_a, group_b, first_a, first_b, in_a, in_b, text_of, len(held))):
            sums[i] = digest
        keys, times = self.linked(a, b, group_a, in_a, in_b, first_a, first_b, links, held[text_of])
        return out, sums, keys, times

    def digests(self, a, b, group_a, group_b, first_a, first_b, in_a, in_b, text_of, n) -> list[str]:
        """SHA-256 of each text's groups written out."""
        at_a = np.arange(len(a)) + first_b[group_a]
        at_b = np.arange(len(b)) + (first_a + in_a)[group_b]
        width = max(self.say_a.width, self.say_b.width)
        rows = np.full((len(a) + len(b), width + 1), ord(" "), np.uint8)
        rows[at_a, width - self.say_a.width : width] = self.say_a.digits[a]
        rows[at_b, width - self.say_b.width : width] = self.say_b.digits[b]
        rows[:, width] = ord(",")
        after = first_a + in_a + first_b
        rows[after - 1, width] = ord("|")
        rows[after + in_b - 1, width] = ord(";")
        keep = rows != ord(" ")
        said = rows[keep].tobytes()
        upto = np.concatenate(([0], np.cumsum(keep.sum(axis=1, dtype=np.int64))))
        stop = (after + in_b)[np.flatnonzero(np.append(text_of[1:] != text_of[:-1], True))]
        cuts = [0, *upto[stop].tolist()]
        return [hashlib.sha256(said[x : y - 1]).hexdigest() for x, y in zip(cuts, cuts[1:])]

    def linked(self, a, b, group_a, in_a, in_b, first_a, first_b, links, text) -> tuple[np.ndarray, np.ndarray]:
        wide = links > WIDE
        some = np.flatnonzero(~wide[group_a])
        g = group_a[some]
        left = np.repeat(a[some] * self.n_b + text[g] * self.pairs, in_b[g])
        keys, times = np.unique(left + b[ranges(first_b[g], in_b[g])], return_counts=True)
        more_keys, more_times = [keys], [times]
        for g in np.flatnonzero(wide).tolist():
            xs, nx = np.unique(a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            ys, ny = np.unique(b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            more_keys.append(((xs * self.n_b)[:, None] + ys[None, :]).ravel() + text[g] * self.pairs)
            more_times.append((nx[:, None] * ny[None, :]).ravel())
        if len(more_keys) > 1:
            keys, back = np.unique(np.concatenate(more_keys), return_inverse=True)
            times = np.zeros(len(keys), np.int64)
            np.add.at(times, back, np.concatenate(more_times))
        return keys, times


def postings(docs: np.ndarray, pairs: np.ndarray, times: np.ndarray, n: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """(pair, bitmap, planes) of a block of n documents, from its entries.

    A bitmap is a sorted list of 16-bit numbers while that is shorter than n bits. Planes are bits over
    the bitmap's members in their order, lowest first, and empty where every member has one link.
    """
    order = np.argsort(pairs * (1 << 16) + docs, kind="stable")
    docs, pairs, times = docs[order].astype("<u2"), pairs[order], times[order]
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.empty(0, np.int64)
    held = np.diff(np.append(first, len(pairs)))
    full = (n + 7) // 8
    dense = 2 * held >= full
    size = np.where(dense, full, 2 * held)
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    thin = np.flatnonzero(~dense)
    out[ranges(at[thin], size[thin])] = docs.view(np.uint8)[ranges(2 * first[thin], size[thin])]
    thick = np.flatnonzero(dense)
    for part in np.array_split(thick, 1 + len(thick) * n // 20_000_000) if len(thick) else ():
        bits = np.zeros((len(part), 8 * full), bool)
        bits[np.repeat(np.arange(len(part)), held[part]), docs[ranges(first[part], held[part])]] = True
        out[ranges(at[part], size[part])] = np.packbits(bits, axis=1, bitorder="little").ravel()

    most = np.maximum.reduceat(times, first) if len(first) else first
    levels = np.where(most > 1, np.floor(np.log2(np.maximum(most, 1))).astype(np.int64) + 1, 0)
    each = (held + 7) // 8
    room = levels * each
    begin = np.cumsum(room) - room
    planes = np.empty(int(room.sum()), np.uint8)
    for k in range(int(levels.max()) if len(levels) else 0):
        rows = np.flatnonzero(levels > k)
        padded = np.zeros(int(each[rows].sum()) * 8, bool)
        start = (np.cumsum(each[rows]) - each[rows]) * 8
        padded[ranges(start, held[rows])] = (times[ranges(first[rows], held[rows])] >> k & 1).astype(bool)
        planes[ranges(begin[rows] + k * each[rows], each[rows])] = np.packbits(padded, bitorder="little")
    return pairs[first], binaries(out, size), binaries(planes, room)


def binaries(data: np.ndarray, size: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def members(bitmaps: pa.Array, planes: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, document, links) of the entries behind postings: `postings` undone."""

    def opened(x: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        offsets = np.frombuffer(x.buffers()[1], np.int32)[x.offset : x.offset + len(x) + 1].astype(np.int64)
        data = np.frombuffer(x.buffers()[2], np.uint8) if x.buffers()[2] else np.empty(0, np.uint8)
        return data, offsets[:-1], np.diff(offsets)

    data, at, size = opened(bitmaps)
    full = (n + 7) // 8
    dense = size == full
    thin = np.flatnonzero(~dense)
    docs = np.ascontiguousarray(data[ranges(at[thin], size[thin])]).view("<u2").astype(np.int64)
    rows = np.repeat(thin, size[thin] // 2)
    parts_rows, parts_docs = [rows], [docs]
    thick = np.flatnonzero(dense)
    for part in np.array_split(thick, 1 + len(thick) * n // 20_000_000) if len(thick) else ():
        bits = np.unpackbits(data[ranges(at[part], size[part])].reshape(len(part), full), axis=1, bitorder="little")
        r, d = np.nonzero(bits)
        parts_rows.append(part[r])
        parts_docs.append(d)
    rows, docs = np.concatenate(parts_rows), np.concatenate(parts_docs)
    order = np.argsort(rows, kind="stable")
    rows, docs = rows[order], docs[order]
    held = np.bincount(rows, minlength=len(bitmaps))
    first = np.cumsum(held) - held

    data, at, size = opened(planes)
    each = (held + 7) // 8
    levels = size // np.maximum(each, 1)
    times = np.ones(len(rows), np.int64)
    many = np.flatnonzero(levels > 0)
    times[ranges(first[many], held[many])] = 0
    for k in range(int(levels.max()) if len(levels) else 0):
        some = np.flatnonzero(levels > k)
        bits = np.unpackbits(data[ranges(at[some] + k * each[some], each[some])], bitorder="little")
        start = (np.cumsum(each[some]) - each[some]) * 8
        times[ranges(first[some], held[some])] += bits[ranges(start, held[some])].astype(np.int64) << k
    return rows, docs, times


ADDED = {
    "block": "long", "place": "integer", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string",
    "pair": "long", "n": "integer", "bitmap": "binary", "planes": "binary",
}
ARROW = {"long": pa.int64(), "integer": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def indexed(df: DataFrame, text: str, carried: list[str], a: str, b: str) -> DataFrame:
    """Rows of documents (`row` holds the carried columns) and of postings (`pair` is set), stored once."""
    with open(a, "rb") as f, open(b, "rb") as g:
        spec, model = f.read(), g.read()
    slim = df.select(F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(spec, model)
        block, n, entries, held = TaskContext.get().partitionId() << 32, 0, 0, []
        schema = None

        def closed() -> Iterator[pa.RecordBatch]:
            keys, times = (np.concatenate(x) for x in zip(*held))
            pairs, bitmaps, planes = postings(keys // aligner.pairs, keys % aligner.pairs, times, n)
            for at in range(0, len(pairs), 50_000):
                size = len(pairs[at : at + 50_000])
                named = {"block": pa.array(np.full(size, block)), "pair": pa.array(pairs[at : at + size]), "n": pa.array(np.full(size, n, np.int32)), "bitmap": bitmaps.slice(at, size), "planes": planes.slice(at, size)}
                yield pa.RecordBatch.from_arrays([named[f.name] if f.name in named else pa.nulls(size, f.type) for f in schema], schema=schema)

        for batch in by_bytes(batches, "text"):
            if schema is None:
                schema = pa.schema([pa.field("row", batch.schema.field("row").type), *(pa.field(c, ARROW[kind]) for c, kind in ADDED.items())])
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), DOCS):
                some = texts[at : at + DOCS]
                if n and (n + len(some) > DOCS or entries > ENTRIES):
                    yield from closed()
                    block, n, entries, held = block + 1, 0, 0, []
                measures, sums, keys, times = aligner.align(some)
                named = {k: pa.array(v) for k, v in measures.items()}
                named |= {"row": batch.column("row").slice(at, len(some)), "block": pa.array(np.full(len(some), block)), "place": pa.array(np.arange(n, n + len(some), dtype=np.int32)), "groups_sha256": pa.array(sums, pa.string())}
                yield pa.RecordBatch.from_arrays([named[f.name] if f.name in named else pa.nulls(len(some), f.type) for f in schema], schema=schema)
                held.append((keys + n * aligner.pairs, times))
                n, entries = n + len(some), entries + len(keys)
        if n:
            yield from closed()

    out = T.StructType().add("row", slim.schema["row"].dataType)
    for name, kind in ADDED.items():
        out = out.add(name, kind)
    return stored(slim.mapInArrow(run, out))


def members_of(bitmap: str = "bitmap", n: str = "n") -> Column:
    """Popcount of a bitmap: half its bytes while it is a list of numbers."""
    size = F.length(bitmap)
    return F.when(size == F.floor((F.col(n) + 7) / 8), F.bitmap_count(bitmap)).otherwise((size / 2).cast("long"))


def links_of(held: str = "held", planes: str = "planes") -> Column:
    """Links behind a posting: popcounts of its planes, each doubled as often as its place."""
    each = ((F.col(held) + 7) / 8).cast("int")
    levels = (F.length(planes) / each).cast("int")
    plane = lambda k: F.bitmap_count(F.substring(F.col(planes), (k * each + 1).cast("int"), each))
    summed = F.aggregate(F.sequence(F.lit(0), levels - 1), F.lit(0).cast("long"), lambda s, k: s + F.call_function("shiftleft", plane(k), k))
    return F.when(levels == 0, F.col(held)).otherwise(summed)


def pair_counts(index: DataFrame, n_b: int) -> DataFrame:
    """(pair, a, b, n_docs, n_links): popcounts of each pair's bitmaps and planes, summed over the blocks."""
    held = index.filter("pair IS NOT NULL").select("pair", members_of().alias("held"), "planes")
    counts = held.groupBy("pair").agg(F.sum("held").alias("n_docs"), F.sum(links_of()).alias("n_links"))
    return counts.select("pair", F.expr(f"pair DIV {n_b}").alias("a"), (F.col("pair") % n_b).alias("b"), "n_docs", "n_links")


def returned(index: DataFrame, n_b: int) -> DataFrame:
    """(block, place, n_best, count_sum): what the postings of a block give its documents."""
    held = index.filter("pair IS NOT NULL")
    counts = stored(held.groupBy("pair").agg(F.sum(members_of()).alias("count")))
    a = F.expr(f"pair DIV {n_b}")
    # One row for an id of A, so never more than the vocabulary has.
    best = F.broadcast(counts.groupBy(a.alias("a")).agg(F.max("count").alias("most")))
    scores = counts.withColumn("a", a).join(best, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    scored = held.select("pair", "block", "n", "bitmap", "planes").join(scores, "pair").drop("pair")

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        n = t.column("n")[0].as_py()
        whole = lambda c: t.column(c).chunk(0)
        rows, docs, times = members(whole("bitmap"), whole("planes"), n)
        count, best = np.asarray(whole("count")), np.asarray(whole("best").cast(pa.int64()))
        total, top = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(total, docs, times * count[rows])
        np.add.at(top, docs, times * best[rows])
        block = t.column("block")[0].as_py()
        return pa.table({"block": pa.array(np.full(n, block)), "place": pa.array(np.arange(n, dtype=np.int32)), "n_best": pa.array(top), "count_sum": pa.array(total)})

    return scored.groupBy("block").applyInArrow(run, "block long, place int, n_best long, count_sum long")


def align(df: DataFrame, text: str = "text", a: str | None = None, b: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 to every row; columns of these names are replaced.

    A text is encoded by the byte-level file `a` with a blank before it, and by the piece model `b`, which
    adds one; without special tokens. A pair's count is the number of rows of the whole table that link
    it; n_best counts a row's links whose pair has its A id's highest count, ties included; count_sum
    adds the counts of all its links. NULL and empty texts, and those that either vocabulary doesn't
    spell byte by byte, have no tokens: zeros and ''. Repeated rows count each. An empty table stays
    empty. Long texts are taken whole. `keep` names the columns to return besides, all by default.
    """
    paths = default_files()
    a, b = a or paths[0], b or paths[1]
    added = [*MEASURES, "n_best", "count_sum", "groups_sha256"]
    carried = [c for c in (keep or df.columns) if c not in added] or [text]
    index = indexed(df, text, carried, a, b)
    n_b = pieces_of(b)
    scores = returned(index, n_b)
    docs = index.filter("pair IS NULL").select("row", "block", "place", *MEASURES, "groups_sha256")
    out = docs.join(scores, ["block", "place"], "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")})
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in carried), *added)


def pieces_of(b: str) -> int:
    """Size of a piece model's vocabulary."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size()


def pair_table(df: DataFrame, text: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """(a, b, n_docs, n_links) of every pair of ids that some row links."""
    paths = default_files()
    a, b = a or paths[0], b or paths[1]
    return pair_counts(indexed(df, text, [text], a, b), pieces_of(b)).drop("pair")


def digest(docs: DataFrame) -> DataFrame:
    """What every document's tokens link, and how often the corpus does."""
    return align(docs, keep=["doc_id"])
