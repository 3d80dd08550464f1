"""Toxicity by a string-kernel support vector machine with Nystroem landmarks.

The kernel counts the subsequences of ORDER letters that two strings share, each weighted by DECAY to
the power of the letters it spans in both, so an insult still matches with a letter inserted, left
out or starred. Strings are the words of a sentence in folded letters; single letters in a row
("i d i o t") are read as one word. The kernel of two strings is the inner product of their weighted
subsequence counts, so the machine, a weighted sum of kernels with its landmarks, is one table of
weights over subsequences and scoring a word costs its own subsequences only.

Training is for labels on whole documents, whose harmless sentences are the larger part: words are
the instances, weighted by the labelled documents that hold them; a document is judged by its two
most toxic words. A logistic curve, fitted on the training documents, turns that into a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkmart.llm.common import stored, whole
from sparkmart.llm.scan import by_bytes

ORDER, DECAY = 3, 0.6
#: Longer words are scored in windows of WINDOW letters, half of it apart.
WINDOW = 22
#: Bounds of the training sample, in words: of toxic documents, and of others.
POSITIVE, NEGATIVE = 3000, 9000
LANDMARKS = 512
#: Labelled documents that the model learns from, at most.
LABELLED = 40_000
#: Rounds in which misjudged words are added, NEGATIVE // 2 at most in each.
ROUNDS = 2
#: Lengths of word stretches that are counted, end marks included, and the evidence (a log-likelihood ratio) that counts.
STEMS, EVIDENCE = (5, 6), 8.0
#: Words below this decision value are as good as absent.
FLOOR = -1.0
#: Digits and signs that stand for letters.
FOLD = str.maketrans("0134578@$!|", "oieastbasil")
#: Punctuation around a word.
MARKS = ".,;:!?\"'()[]{}<>«»„“”‘’-_*"
#: Letters in classes: a-z by themselves, all others by code point in the remaining ones.
CLASSES = 40
NOT_LETTERS = re.compile(r"[\W_]+")


def letters(word: str) -> str:
    """A word's letters: look-alike digits and signs folded, punctuation out."""
    bare = word.strip(MARKS)
    return bare if bare.isalpha() else NOT_LETTERS.sub("", bare.translate(FOLD))


def words(text: str | None) -> list[str]:
    """Words of a text in letters; three or more single letters in a row are one word."""
    out: list[str] = []
    run: list[str] = []
    for raw in (text or "").lower().split():
        w = raw if raw.isalpha() else letters(raw)
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) > 2:
            out.append("".join(run))
        if run:
            run = []
        if len(w) >= ORDER:
            out.append(w)
    if len(run) > 2:
        out.append("".join(run))
    return out


def pieces(word: str) -> list[str]:
    """The word between marks of its ends, or windows that cover all of that."""
    word = f"^{word}$"
    if len(word) <= WINDOW:
        return [word]
    step = WINDOW // 2
    return [word[i : i + WINDOW] for i in range(0, len(word) - step, step)]


def coded(strings: list[str]) -> np.ndarray:
    """Letter classes of equally long strings, a row each."""
    points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(strings), -1).astype(np.int64)
    latin = (points >= 97) & (points <= 122)
    return np.where(latin, points - 97, 26 + points % (CLASSES - 26))


_spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def subsequences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the subsequences of every row, and their weights."""
    n = codes.shape[1]
    if n not in _spans:
        places = np.array(list(combinations(range(n), ORDER)), np.int64).reshape(-1, ORDER)
        _spans[n] = places, DECAY ** (places[:, -1] - places[:, 0] + 1.0)
    places, weight = _spans[n]
    number = np.zeros((len(codes), len(places)), np.int64)
    for k in range(ORDER):
        number = number * CLASSES + codes[:, places[:, k]]
    return number, weight


def norms(number: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Square root of each row's kernel with itself."""
    order = np.argsort(number, axis=1, kind="stable")
    number, w = np.take_along_axis(number, order, 1), weight[order]
    new = np.ones(number.shape, bool)
    new[:, 1:] = number[:, 1:] != number[:, :-1]
    sums = np.add.reduceat(w.ravel(), np.flatnonzero(new.ravel()))
    row = np.flatnonzero(new.ravel()) // number.shape[1]
    return np.sqrt(np.bincount(row, sums**2, minlength=len(number)))


def evaluate(strings: list[str], table: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """Inner product of each string's normalised subsequence weights with `table` (or its columns); `rows` says where a subsequence stands in it."""
    shape = (len(strings),) if table.ndim == 1 else (len(strings), table.shape[1])
    out = np.zeros(shape, table.dtype)
    by_length: dict[int, list[int]] = {}
    for i, s in enumerate(strings):
        by_length.setdefault(len(s), []).append(i)
    for n, at in by_length.items():
        if n < ORDER:
            continue
        # What is gathered at a time stays at a few megabytes, for the columns of a table as for one.
        room = max(1, 300_000 // (len(list(combinations(range(n), ORDER))) * (1 if table.ndim == 1 else table.shape[1] // 4 + 1)))
        for k in range(0, len(at), room):
            some = at[k : k + room]
            number, weight = subsequences(coded([strings[i] for i in some]))
            if table.ndim == 1:
                out[some] = (table[number] @ weight) / norms(number, weight)
            else:
                place = number if rows is None else rows[number]
                out[some] = np.einsum("rsl,s->rl", table[place], weight) / norms(number, weight)[:, None]
    return out


@dataclass(frozen=True)
class Model:
    """Decision of a word: its kernel with `table`, plus `bias`; a document's score: logistic in its top two."""

    table: np.ndarray
    bias: float
    curve: tuple[float, float, float] = (0.0, 0.0, -20.0)

    def decide(self, strings: list[str]) -> list[float]:
        """Largest decision among the pieces of every string."""
        cut = [pieces(s) for s in strings]
        flat = evaluate([p for c in cut for p in c], self.table) + self.bias
        ends = np.cumsum([0] + [len(c) for c in cut])[:-1]
        return np.maximum.reduceat(flat, ends).tolist() if len(cut) else []

    def score(self, top, second):
        a, b, c = self.curve
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(top * a + second * b + c)))


def train_machine(positive: dict[str, float], negative: dict[str, float], landmarks: int = LANDMARKS) -> tuple[np.ndarray, float] | None:
    """Squared-hinge linear machine in the Nystroem space of words with weights; None without both kinds."""
    if not positive or not negative:
        return None
    cut = lambda d: [(p, w) for s, w in d.items() for p in pieces(s)]
    rows = [(p, w, 1.0) for p, w in cut(positive)] + [(p, w, -1.0) for p, w in cut(negative)]
    strings, weight, sign = [r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    for s in (1.0, -1.0):
        weight[sign == s] /= weight[sign == s].sum()
    # Landmarks: the heaviest words of either kind, half of them each.
    heavy = lambda k: [r[0] for r in sorted((r for r in rows if r[2] == k), key=lambda r: (-r[1], r[0]))[: landmarks // 2]]
    marks = list(dict.fromkeys([*heavy(1.0), *heavy(-1.0)]))
    # Only subsequences that some landmark has get a row, behind a first one of zeros for all others.
    own = [subsequences(coded([m])) for m in marks]
    used = np.unique(np.concatenate([number.ravel() for number, _ in own]))
    rows_of = np.zeros(CLASSES**ORDER, np.int32)
    rows_of[used] = np.arange(1, len(used) + 1)
    maps = np.zeros((len(used) + 1, len(marks)), np.float32)
    for j, (number, w) in enumerate(own):
        np.add.at(maps[:, j], rows_of[number[0]], w / norms(number, w)[0])
    between = maps.T @ maps
    value, vector = np.linalg.eigh(between.astype(float))
    good = value > 1e-6 * value[-1]
    root = vector[:, good] / np.sqrt(value[good])
    x = np.ones((len(strings), root.shape[1] + 1), np.float32)
    for at in range(0, len(strings), 2000):  # blocks keep the driver small
        x[at : at + 2000, :-1] = evaluate(strings[at : at + 2000], maps, rows_of) @ root
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), 1e-5)
    ridge[-1] = 1e-8
    for _ in range(30):
        active = 1 - sign * (x @ w) > 0
        square, cross = np.diag(ridge), np.zeros(len(w))
        for at in range(0, len(x), 2000):
            part = np.flatnonzero(active[at : at + 2000]) + at
            block = x[part].astype(float)
            scaled = block * weight[part, None]
            square, cross = square + scaled.T @ block, cross + scaled.T @ sign[part]
        new = np.linalg.solve(square, cross)
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    table = np.zeros(CLASSES**ORDER)
    table[used] = (maps @ (root @ w[:-1]))[1:]
    return table, float(w[-1])


def fit_curve(top: np.ndarray, second: np.ndarray, label: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the label on the two top decisions, by Newton's method; n rows stand behind each."""
    if not (label == 1).any() or not (label == 0).any():
        return (0.0, 0.0, 20.0 if (label == 1).any() else -20.0)
    x = np.column_stack((top, second, np.ones(len(top))))
    weight = n
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1.0, 1.0, 0.01]), x.T @ (weight * (label - p)) - np.array([1.0, 1.0, 0.01]) * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, toxic, clean): labelled documents of either kind that hold the word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 4 << 20):
            seen: tuple[dict[str, int], dict[str, int]] = ({}, {})
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                held = seen[label]
                for w in set(words(text)):
                    held[w] = held.get(w, 0) + 1
            for label, held in enumerate(seen):
                yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array([label] * len(held), pa.int32()), pa.array(held.values(), pa.int64())], ["word", "label", "n"])

    parts = labelled.select("text", "label").mapInArrow(count, "word string, label int, n long")
    return parts.groupBy("word").agg(F.sum(F.col("n") * F.col("label")).alias("toxic"), F.sum(F.col("n") * (1 - F.col("label"))).alias("clean"))


def decided(counts: DataFrame, model: Model) -> DataFrame:
    """(word, clean, decision) of every counted word."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("clean"), pa.array(model.decide(batch.column("word").to_pylist()), pa.float64())], ["word", "clean", "decision"])

    return counts.select("word", "clean").mapInArrow(judge, "word string, clean long, decision double")


def top_words(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of `docs`, and the decisions of the two most toxic words, FLOOR where there is none."""
    table, bias = model.table, model.bias

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Model(table, bias)
        known: set[str] = set()
        hot: dict[str, float] = {}
        for batch in by_bytes(batches, "text", 4 << 20):
            held = [words(t) for t in batch.column("text").to_pylist()]
            new = sorted(set().union(*held) - known) if held else []
            if len(known) > 400_000:  # only a memory of words already judged
                known.clear()
                new = sorted(set().union(*held))
            known.update(new)
            hot.update((w, v) for w, v in zip(new, machine.decide(new)) if v > FLOOR)
            tops, seconds = [], []
            for doc in held:
                first = second = FLOOR
                for w in doc:
                    v = hot.get(w)
                    if v is not None and v > second:
                        first, second = (v, first) if v > first else (first, v)
                tops.append(first)
                seconds.append(second)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tops, pa.float64()), pa.array(seconds, pa.float64())], [*batch.schema.names, "_top", "_second"])

    schema = type(docs.schema)([*docs.schema.fields]).add("_top", "double").add("_second", "double")
    return docs.mapInArrow(judge, schema)


def evidence(toxic, clean, share: float):
    """Log-likelihood ratio for more toxic holders than a `share` of all of them; 0 for fewer."""
    expected = (toxic + clean) * share
    return F.when((toxic > expected), toxic * F.log(toxic / expected) - (toxic - expected)).otherwise(F.lit(0.0))


def stems_of(marked, n: int):
    """All stretches of n letters."""
    return F.when(F.length(marked) >= n, F.transform(F.sequence(F.lit(1), F.length(marked) - n + 1), lambda i: F.substring(marked, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def train(labelled: DataFrame) -> Model:
    """Fit on (text, label) rows, label 1 toxic or 0.

    Counts of words, and of their stretches of STEMS letters, cover all labelled rows. Of the words
    the machine takes, as instances, at most POSITIVE whose holders, or those of one of their
    stretches, are toxic far beyond chance, the strongest first, and at most NEGATIVE of clean
    documents: half the most frequent, half by hash. Without labels of both kinds
    every score is near 0 (or 1, if all are toxic).
    """
    labelled = labelled.filter("label in (0, 1)").select("text", F.col("label").cast("int").alias("label"))
    kinds = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = kinds.get(1, 0), kinds.get(0, 0)
    blank = Model(np.zeros(CLASSES**ORDER), FLOOR, (0.0, 0.0, 20.0 if n1 and not n0 else -20.0))
    if not n1 or not n0:
        return blank
    counts = stored(word_counts(labelled))
    said = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    share = (said["t"] or 0) / max(1, (said["t"] or 0) + (said["c"] or 0))
    if not 0 < share < 1:
        return blank
    marked = F.concat(F.lit("^"), "word", F.lit("$"))
    parts = [stems_of(marked, n) for n in STEMS]
    stems = counts.select("word", "toxic", "clean", F.explode(F.array_distinct(F.concat(*parts))).alias("stem"))
    telling = stems.groupBy("stem").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).withColumn("evidence", evidence(F.col("t"), F.col("c"), share)).filter(F.col("evidence") >= EVIDENCE)
    by_stem = stems.filter("toxic > 0").join(telling.select("stem", "evidence"), "stem").groupBy("word").agg(F.max("evidence").alias("stem_evidence"))
    judged = counts.filter("toxic > 0").join(by_stem, "word", "left").withColumn("own", evidence(F.col("toxic"), F.col("clean"), share))
    judged = judged.withColumn("weight", F.greatest(F.when(F.col("own") >= EVIDENCE, F.col("own")).otherwise(0.0), F.coalesce("stem_evidence", F.lit(0.0)))).filter("weight > 0")
    pos = judged.filter(F.col("toxic") * (1 - share) > F.col("clean") * share * 4).orderBy(F.col("weight").desc(), F.xxhash64("word")).limit(POSITIVE).collect()
    often = counts.filter("clean > 0").orderBy(F.col("clean").desc(), F.xxhash64("word")).limit(NEGATIVE // 2).collect()
    some = counts.filter("clean > 0").orderBy(F.xxhash64("word")).limit(NEGATIVE // 2).collect()
    positive = {r["word"]: float(r["toxic"]) for r in pos}
    negative = {r["word"]: float(r["clean"]) ** 0.5 for r in [*often, *some] if r["word"] not in positive}
    machine = train_machine(positive, negative)
    if machine is None:
        return blank
    for _ in range(ROUNDS):  # words of clean documents that are taken for insults become instances
        wrong = decided(counts.filter("clean > 0"), Model(*machine)).filter(F.col("decision") > -0.5).orderBy(F.col("decision").desc(), F.xxhash64("word")).limit(NEGATIVE // 2).collect()
        negative.update((r["word"], 3.0 * float(r["clean"]) ** 0.5) for r in wrong if r["word"] not in positive)
        machine = train_machine(positive, negative)
    model = Model(*machine)
    judged = top_words(labelled, model)
    cell = lambda c: F.round(c * 50) / 50
    table = judged.groupBy(cell(F.col("_top")).alias("t"), cell(F.col("_second")).alias("s"), "label").agg(F.count(F.lit(1)).alias("n")).collect()
    t, s, y, n = (np.array([r[c] for r in table], float) for c in ("t", "s", "label", "n"))
    return Model(model.table, model.bias, fit_curve(t, s, y, n))


def in_training(doc_id) -> F.Column:
    """Whether a label may be learned from: crc32 of the id's text leaves a remainder modulo 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 0


def train_on(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Model:
    """Fit on at most `most` labels of the training share, chosen by hash; several labels of a document count as the largest.

    The chosen ids, a dozen bytes each, are sent to all executors, so no text is shuffled.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & in_training(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return train(stored(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "label")))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Add score, 0 to 1. NULL, empty and wordless texts score what two words at FLOOR score. All other columns stay, one named score is replaced."""
    docs = docs.drop("score")
    return top_words(docs, model).withColumn("score", model.score(F.col("_top"), F.col("_second"))).drop("_top", "_second")


def keep_clean(docs: DataFrame, labels: DataFrame, source: DataFrame) -> DataFrame:
    """The documents that score below 0.5, by a model of the labelled documents in `source`; all columns as they are."""
    return scored(docs, train_on(source, labels)).filter("score < 0.5").drop("score")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every document."""
    out = scored(docs.select("doc_id", whole("text").alias("text")), train_on(docs, labels))
    return out.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
