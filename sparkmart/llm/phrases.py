"""Collocations from a prefix-free parse of the corpus.

Every document is cut where its own words say so: a window of OVERLAP words whose hash is divisible
by EVERY begins a chunk, and the chunk before runs on to the end of that window. Equal passages so
give equal chunks wherever they stand. The distinct chunks of a language form a dictionary with the
number of times the parse uses each.

Phrases are counted inside distinct chunks and weighted by those numbers. A phrase belongs to the
chunk in which it starts before the overlap (in a document's last chunk: anywhere), so one that lies
in two chunks counts once; as an overlap has LONGEST - 1 words, the phrase never leaves that chunk.

Words stand as 64-bit hashes, seeded by their language, and phrases as lists of them; the text of a
phrase is only looked up once it has a place in the report or ties for one. A phrase of n words is
only counted if its first and its last n - 1 words are frequent themselves. What is frequent travels
as a bitmap of fixed size, whose false hits cost time and change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sparkmart.llm.common import stored
from sparkmart.llm.scan import FACTORS, Hasher, U, by_bytes, code_points, groups, lower, mixed

#: Words of the longest phrase, words that neighbouring chunks share, mean words between two triggers.
LONGEST, EVERY = 4, 32
OVERLAP = LONGEST - 1
#: Occurrences that make a candidate; per cent of them inside one longer phrase that drop it; places of a language's list.
LEAST, INSIDE, PLACES = 30, 80, 2000
SCALE = 2_000_000
#: Bits of the bitmap of frequent phrases, in bitmaps of 2**15 bits each.
BITS, PAGE = 26, 15
#: Characters of distinct chunks, and counts of hashes, that a task holds before it hands them on.
HELD, PENDING = 8_000_000, 4_000_000

BREAKS = ".,;:!?\n\x0b\x0c\r"


def layout(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of lowered code points, and the breaks up to each position."""
    brk = np.zeros(len(points), bool)
    for c in BREAKS:
        brk |= points == ord(c)
    gap = np.concatenate(([True], brk | (points == 32) | (points == 9), [True])).view(np.int8)
    edge = np.diff(gap)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1), np.concatenate(([0], np.cumsum(brk)))


def word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed(Hasher(points)(starts, ends) + (ends - starts).astype(U))


def chunks(texts: list[str | None]) -> Iterator[tuple[int, str, bool]]:
    """(text, chunk, whether it is the text's last) of the prefix-free parse, A-Z lowered."""
    for first, held in groups(texts):
        points = lower(code_points("\n".join(held)))
        starts, ends, _ = layout(points)
        if not len(starts):
            continue
        size = np.fromiter((len(t) + 1 for t in held), np.int64, len(held))
        cuts = np.searchsorted(starts, np.concatenate(([0], np.cumsum(size))))
        words = word_hashes(points, starts, ends)
        n = max(0, len(words) - OVERLAP + 1)
        rolled = np.zeros(n, U)
        for k in range(OVERLAP):
            rolled += words[k : k + n] * FACTORS[k]
        text_of = np.repeat(np.arange(len(held)), np.diff(cuts))
        begins = np.flatnonzero(mixed(rolled) % U(EVERY) == 0)
        begins = begins[text_of[begins] == text_of[begins + OVERLAP - 1]]
        begins = np.unique(np.concatenate((begins, cuts[:-1][np.diff(cuts) > 0])))
        owner = text_of[begins]
        last = np.append(owner[1:] != owner[:-1], True)
        stop = np.where(last, cuts[owner + 1], np.append(begins[1:], 0) + OVERLAP) - 1
        said = points.tobytes().decode("utf-32-le", "surrogatepass")
        for t, a, b, z in zip(owner.tolist(), starts[begins].tolist(), ends[stop].tolist(), last.tolist()):
            yield first + t, said[a:b], z


def parse(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The dictionary: (lang, chunk, last, uses). `last` marks ends of documents, whose overlap is nobody else's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, bool, str], int] = {}
        room = HELD

        def out() -> pa.RecordBatch:
            langs, last, said = zip(*seen) if seen else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(said, pa.string()), pa.array(last, pa.bool_()), pa.array(seen.values(), pa.int64())], ["lang", "chunk", "last", "uses"])

        for batch in by_bytes(batches, "text"):
            langs = batch.column("lang").to_pylist()
            for t, chunk, last in chunks(batch.column("text").to_pylist()):
                key = (langs[t], last, chunk)
                n = seen.get(key)
                seen[key] = (n or 0) + 1
                if n is None:
                    room -= len(chunk)
            if room < 0:
                yield out()
                seen, room = {}, HELD
        yield out()

    slim = df.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    found = slim.mapInArrow(run, "lang string, chunk string, last boolean, uses long")
    return found.groupBy("lang", "chunk", "last").agg(F.sum("uses").alias("uses"))


def combined(words: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases whose first, second, ... words are given."""
    out = np.full(len(words[0]), U(len(words)))
    for k, w in enumerate(words):
        out += w * FACTORS[k]
    return mixed(out)


def lang_seed(lang: str) -> np.uint64:
    points = code_points(lang + "\n")
    return mixed(Hasher(points)(np.array([0]), np.array([len(points)])))[0]


class Chunks:
    """Chunks of the dictionary one after the other in one array of code points, with their words."""

    def __init__(self, batch: pa.RecordBatch, texts: list[str]):
        self.points = code_points("\n".join(texts))
        self.starts, self.ends, self.breaks = layout(self.points)
        size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        cuts = np.searchsorted(self.starts, np.concatenate(([0], np.cumsum(size))))
        names = batch.column("lang").dictionary_encode()
        self.kinds = names.dictionary.to_pylist()
        self.of = np.repeat(np.arange(len(texts)), np.diff(cuts))
        self.lang = np.asarray(names.indices)[self.of]
        self.uses = np.asarray(batch.column("uses"))[self.of]
        last = np.asarray(batch.column("last").to_pylist(), bool)
        self.owned = np.arange(len(self.starts)) < (cuts[1:] - np.where(last, 0, OVERLAP))[self.of]
        seeds = np.array([lang_seed(x) for x in self.kinds], U)[self.lang]
        self.words = mixed(word_hashes(self.points, self.starts, self.ends) ^ seeds)

    def stretches(self, n: int) -> list[np.ndarray]:
        """The first, second, ... word of the n words from each word on."""
        m = max(0, len(self.words) - n + 1)
        return [self.words[k : k + m] for k in range(n)]

    def phrases(self, n: int, parts: np.ndarray | None = None) -> np.ndarray:
        """First words of the phrases of n words that start in what a chunk owns; only those whose parts the bitmap holds."""
        m = len(self.starts) - n + 1
        if m <= 0:
            return np.empty(0, np.int64)
        ok = self.owned[:m] & (self.breaks[self.starts[n - 1 :]] == self.breaks[self.starts[:m]]) & (self.of[n - 1 :] == self.of[:m])
        if parts is not None:
            hit = holds(parts, combined(self.stretches(n - 1)))
            ok &= hit[:m] & hit[1 : m + 1]
        return np.flatnonzero(ok)


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunks]:
    for batch in by_bytes(batches, "chunk", 4 << 20):
        for at, texts in groups(batch.column("chunk").to_pylist(), 1_000_000):
            yield Chunks(batch.slice(at, len(texts)), texts)


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes & U(2**BITS - 1)
    return (bits[(h >> U(3)).astype(np.int64)] >> (h & U(7)).astype(np.uint8) & 1).astype(bool)


def added(words: list[np.ndarray], uses: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sums by phrase."""
    _, first, back = np.unique(combined(words), return_index=True, return_inverse=True)
    if not all((w[first][back] == w).all() for w in words):
        return words, uses  # two phrases share a hash: nothing is summed up here
    total = np.zeros(len(first), np.int64)
    np.add.at(total, back, uses)
    return [w[first] for w in words], total


def level(dictionary: DataFrame, n: int, parts: np.ndarray | None) -> DataFrame:
    """(w0, w1, ..., uses) of all phrases of n words, whose parts are in the bitmap; for n = 1 with their `lang`, and all its words as w0 NULL."""
    cols = [f"w{k}" for k in range(n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, uses, room = [[] for _ in cols], [], PENDING

        def out() -> pa.RecordBatch:
            keys, total = added([np.concatenate(w) for w in words], np.concatenate(uses))
            return pa.RecordBatch.from_arrays([*(pa.array(w.view(np.int64)) for w in keys), pa.array(total)], [*cols, "uses"])

        for some in chunks_of(batches):
            at = some.phrases(n, parts)
            for held, w in zip(words, some.stretches(n)):
                held.append(w[at])
            uses.append(some.uses[at])
            room -= len(at)
            if room < 0:
                yield out()
                words, uses, room = [[] for _ in cols], [], PENDING
        if uses:
            yield out()

    def run_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in chunks_of(batches):
            at = some.phrases(1)
            for i, name in enumerate(some.kinds):
                mine = at[some.lang[at] == i]
                (w,), total = added([some.words[mine]], some.uses[mine])
                yield pa.RecordBatch.from_arrays([pa.array([name] * (len(w) + 1), pa.string()), pa.array([*w.view(np.int64).tolist(), None], pa.int64()), pa.array([*total.tolist(), int(total.sum())], pa.int64())], ["lang", "w0", "uses"])

    if n == 1:
        return dictionary.mapInArrow(run_words, "lang string, w0 long, uses long").groupBy("lang", "w0").agg(F.sum("uses").alias("uses"))
    return dictionary.mapInArrow(run, ", ".join(f"{c} long" for c in cols) + ", uses long").groupBy(*cols).agg(F.sum("uses").alias("uses"))


def bitmap(phrases: DataFrame, n: int) -> np.ndarray:
    """Bitmap of phrases of n words: 2**BITS bits whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                h = combined([np.asarray(batch.column(k)).view(U) for k in range(n)]) & U(2**BITS - 1)
                yield pa.RecordBatch.from_arrays([pa.array((h >> U(PAGE)).astype(np.int64)), pa.array((h & U(2**PAGE - 1)).astype(np.int64))], ["page", "bit"])

    pages = phrases.select(*[f"w{k}" for k in range(n)]).mapInArrow(run, "page long, bit long").groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = np.zeros(2**BITS >> 3, np.uint8)
    for row in pages.toLocalIterator():
        at = row["page"] << PAGE >> 3
        bits[at : at + (1 << PAGE >> 3)] = np.frombuffer(row["bits"], np.uint8)
    return bits


def counted(dictionary: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, w, f) of all phrases of 1 to LONGEST words found `least` times or more, and (lang, n) of all words."""
    words = stored(level(dictionary, 1, None))
    often = words.filter(F.col("w0").isNotNull() & (F.col("uses") >= least))
    levels, bits = [], bitmap(often, 1)
    for n in range(2, LONGEST + 1):
        found = stored(level(dictionary, n, bits).filter(F.col("uses") >= least))
        if n < LONGEST:
            bits = bitmap(found, n)
        levels.append(found.select(F.array(*[f"w{k}" for k in range(n)]).alias("w"), F.col("uses").alias("f")))
    longer = levels[0]
    for found in levels[1:]:
        longer = longer.unionByName(found)
    named = often.select(F.col("w0").alias("__first"), "lang")
    longer = longer.join(named, F.col("w")[0] == F.col("__first")).select("lang", "w", "f")
    totals = words.filter("w0 IS NULL").select("lang", F.col("uses").alias("n"))
    return often.select("lang", F.array("w0").alias("w"), F.col("uses").alias("f")).unionByName(longer), totals


def spelled(dictionary: DataFrame, wanted: DataFrame) -> DataFrame:
    """(w, phrase): the text of the phrases (column `w`) that are wanted."""
    bitmaps = {n: bitmap(wanted.filter(F.size("w") == n).select(*[F.col("w")[k].alias(f"w{k}") for k in range(n)]), n) for n in range(1, LONGEST + 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, ...], str] = {}
        for some in chunks_of(batches):
            said = some.points.tobytes().decode("utf-32-le", "surrogatepass")
            for n, bits in bitmaps.items():
                if not bits.any():
                    continue
                at, words = some.phrases(n), some.stretches(n)
                at = at[holds(bits, combined([w[at] for w in words]))]
                for i, key in zip(at.tolist(), zip(*(w[at].view(np.int64).tolist() for w in words))):
                    if key not in known:
                        known[key] = " ".join(said[some.starts[i + k] : some.ends[i + k]] for k in range(n))
            if len(known) > PENDING >> 3:
                yield pa.RecordBatch.from_arrays([pa.array(map(list, known), pa.list_(pa.int64())), pa.array(known.values(), pa.string())], ["w", "phrase"])
                known = {}
        yield pa.RecordBatch.from_arrays([pa.array(map(list, known), pa.list_(pa.int64())), pa.array(known.values(), pa.string())], ["w", "phrase"])

    found = dictionary.mapInArrow(run, "w array<long>, phrase string").groupBy("w").agg(F.min("phrase").alias("phrase"))
    return found.join(wanted.select("w").distinct(), "w")


def frequencies(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """(lang, words, phrase, f) of all phrases of 1 to LONGEST words found `least` times or more."""
    dictionary = stored(parse(df, text, lang))
    f = stored(counted(dictionary, least)[0])
    return f.join(spelled(dictionary, f), "w").select("lang", F.size("w").alias("words"), "phrase", "f")


def ranked(df: DataFrame, places: int, order: list[F.Column], ties: bool, salt: str) -> DataFrame:
    """First rows of a language, with those that tie for the last place if wanted; each of many parts keeps its own first before they meet."""
    place = F.rank() if ties else F.row_number()
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64(salt), F.lit(256))).orderBy(*order)
    some = df.withColumn("rank", place.over(parts)).filter(F.col("rank") <= places)
    return some.withColumn("rank", place.over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= places)


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, inside: int = INSIDE, places: int = PLACES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to LONGEST words.

    A-Z are lowered, texts split at `[.,;:!?\\x0A-\\x0D]` and blanks or tabs; NULL languages count as
    `und`, NULL and empty texts as no words, repeated rows as often as they stand there. `a` counts a
    phrase, `l` and `r` the parts of its lowest-scoring cut (ties: the earliest), `n` all words; the
    score is floor(SCALE * a / (l + r)), in decimals. A phrase goes if `inside` per cent of it lie in
    one longer phrase. Ties in score stand by `a`, then by the phrase's bytes. An empty table gives no
    rows, and other columns are not looked at, whatever their names.
    """
    dictionary = stored(parse(df, text, lang))
    f, totals = counted(dictionary, least)
    f = stored(f)
    phrases = f.filter(F.size("w") > 1).select("lang", "w", F.size("w").alias("words"), F.col("f").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "w", "a", "k", F.slice("w", F.lit(1), F.col("k")).alias("left"), F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    part = lambda side, count: f.select(F.col("w").alias(side), F.col("f").alias(count))
    cuts = cuts.join(part("left", "l"), "left").join(part("right", "r"), "right")
    score = F.expr(f"CAST(CAST(a AS DECIMAL(28, 0)) * {SCALE} DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0))) AS BIGINT)")
    best = cuts.withColumn("score", score).groupBy("lang", "w", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    longer = phrases.filter("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    longer = longer.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    around = longer.groupBy(F.slice("w", F.col("first"), F.col("size")).alias("w")).agg(F.max("a").alias("most"))
    big = lambda c: F.col(c).cast("decimal(28,0)")
    kept = best.join(around, "w", "left").filter(F.col("most").isNull() | (big("most") * 100 < big("a") * inside))
    kept = kept.select("lang", "w", "a", "best.l", "best.r", "best.score")
    order = [F.col("score").desc(), F.col("a").desc()]
    # Only phrases that have a place, whatever their text, or tie for one are spelled.
    contenders = stored(ranked(kept, places, order, True, "w").drop("rank"))
    shown = contenders.join(spelled(dictionary, contenders), "w")
    top = ranked(shown, places, [*order, F.col("phrase")], False, "phrase")
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
