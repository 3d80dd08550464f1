"""Document fingerprints by winnowing: rolling k-gram hashes, the rightmost minimum of every window, positions kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkmart.llm.common import whole, word_array
from sparkmart.llm.quality import pairs

#: A longer run without a blank, as scripts written without spaces have them, counts as single characters.
LONGEST = 32
#: Tokens of a gram, and grams of a window: any K + WINDOW - 1 tokens that two texts share give a common fingerprint.
K, WINDOW = 5, 16
PRIME, BASE = 2**31 - 1, 1_000_003
HIGH = 2**31


def add_tokens(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add hashes, below PRIME, of the words between blanks; a run of over LONGEST characters gives one for each character."""
    word = f"{out}_w"
    df = df.withColumn(word, word_array(text))
    long = lambda x: F.char_length(x) > LONGEST
    cut = F.flatten(F.transform(word, lambda x: F.when(long(x), F.filter(F.split(x, ""), lambda c: c != "")).otherwise(F.array(x))))
    df = df.withColumn(word, F.when(F.exists(word, long), cut).otherwise(F.col(word)))
    return df.withColumn(out, F.transform(word, lambda x: F.crc32(x.cast("binary")) % PRIME)).drop(word)


def joined(width: int):
    """hash(xy) from hash(x) and hash(y), y being `width` tokens long."""
    up = pow(BASE, width, PRIME)
    return lambda x, y: (x * up + y) % PRIME


def add_grams(df: DataFrame, token: str, out: str, k: int) -> DataFrame:
    """Polynomial hashes modulo PRIME of all k-grams; a shorter text is one gram of all its tokens.

    hash(xy) = hash(x) * BASE**len(y) + hash(y): widths are doubled, so k-grams need about log2(k) passes.
    """
    width, have = 1, token
    steps = []
    for bit in bin(k)[3:]:
        steps.append((have, width, have, width))
        have, width = f"{out}_{2 * width}", 2 * width
        if bit == "1":
            steps.append((have, width, token, 1))
            have, width = f"{out}_{width + 1}", width + 1
    made = []
    for a, wa, b, wb in steps:
        name = f"{out}_{wa + wb}"
        df = df.withColumn(name, pairs(F.col(a), F.col(b), wa, joined(wb)))
        made.append(name)
    short = F.aggregate(token, F.lit(0).cast("long"), lambda acc, x: (acc * BASE + x) % PRIME)
    n = F.size(token)
    df = df.withColumn(out, F.when(n >= k, F.col(have)).when(n > 0, F.array(short)).otherwise(F.array().cast("array<bigint>")))
    return df.drop(*made)


def add_fingerprint(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add `out`: array of longs, hash * 2**31 + (2**31 - 1 - position), in the order of positions.

    The smallest such number of a window is its smallest hash and, among equals, the rightmost.
    Window minima double like the grams. A text with fewer grams than a window has one window; a
    text without a token (NULL, empty, blank) has no fingerprint.
    """
    t, g = f"{out}_t", f"{out}_g"
    df = add_tokens(df, text, t)
    df = add_grams(df, t, g, k).drop(t)
    df = df.withColumn(f"{out}_1", F.transform(g, lambda x, i: x * HIGH + (HIGH - 1 - i)))
    width, made = 1, [f"{out}_1"]
    while width < window:
        more = min(width, window - width)
        have = F.col(made[-1])
        df = df.withColumn(f"{out}_{width + more}", pairs(have, have, more, lambda x, y: F.least(x, y)))
        made.append(f"{out}_{width + more}")
        width += more
    n = F.size(g)
    chosen = F.when(n >= window, F.array_distinct(F.col(made[-1]))).when(n > 0, F.array(F.array_min(F.col(made[0])))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, chosen).drop(g, *made)


def grams(fingerprint: str | Column) -> Column:
    """Distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, 31)))


def positions(fingerprint: str | Column) -> Column:
    return F.transform(fingerprint, lambda x: (HIGH - 1 - x.bitwiseAND(HIGH - 1)).cast("int"))


def as_text(fingerprint: str | Column) -> Column:
    """hash@position in hexadecimal, joined by blanks; '' without a fingerprint."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(F.lower(F.hex(F.shiftright(x, 31))), F.lit("@"), F.lower(F.hex(HIGH - 1 - x.bitwiseAND(HIGH - 1))))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two hash sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def runs_of(df: DataFrame, order: str, rows: int) -> Column:
    """Number of the run of neighbouring `order` values a row belongs to: quantiles cut runs of about `rows` rows, 2**14 at most."""
    n, key = df.count(), F.col(order)
    runs = max(1, min(2**14, n // rows))
    cuts = sorted(set(df.agg(F.percentile_approx(order, [i / runs for i in range(1, runs)], max(10_000, 4 * runs)).alias("q")).first()["q"] or [])) if runs > 1 else []
    if not cuts:
        return F.lit(0)
    # Two levels, so that a row is compared with some square root of the cuts.
    step = max(1, round(len(cuts) ** 0.5))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    block = F.size(F.filter(F.array(*(F.lit(b[0]) for b in blocks)), lambda x: x <= key))
    table = F.array(*(F.array(*(F.lit(x).cast("long") for x in b)) for b in blocks))
    inner = F.size(F.filter(F.element_at(table, block), lambda x: x <= key))
    return F.when(key.isNull() | (block == 0), F.lit(0)).otherwise((block - 1) * step + inner)


def in_runs(df: DataFrame, order: str, tie: str, rows: int = 256) -> DataFrame:
    """Add _run and _guard: every run also holds a copy of the row that follows its last, with _guard true.

    Rows follow each other in ascending (order, tie), NULL first; the first row follows the last.
    """
    df = df.withColumn("_run", runs_of(df.select(order), order, rows))
    place = F.struct(F.col(order), F.col(tie))
    firsts = df.groupBy("_run").agg(F.min(place).alias("first"))
    every = Window.partitionBy().orderBy(F.col("_run"))
    before = F.coalesce(F.lag("_run").over(every), F.max("_run").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = firsts.select(F.col("_run").alias("of"), F.col("first." + order).alias("o"), F.col("first." + tie).alias("t"), before.alias("to"))
    hit = (F.col("_run") == F.col("of")) & F.col(order).eqNullSafe(F.col("o")) & F.col(tie).eqNullSafe(F.col("t"))
    guards = df.join(firsts, hit).dropDuplicates(["of"]).withColumn("_run", F.col("to")).drop("of", "o", "t", "to")
    return df.withColumn("_guard", F.lit(False)).unionByName(guards.withColumn("_guard", F.lit(True)))


def digest(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness to it and to the next document."""
    slim = docs.select("doc_id", whole("text").alias("text")).withColumn("_tie", F.xxhash64("text"))
    rows = in_runs(slim, "doc_id", "_tie")
    follow = Window.partitionBy("_run").orderBy("_guard", F.col("doc_id").asc_nulls_first(), "_tie")
    rows = rows.withColumn("_next", F.lead("text").over(follow))
    rows = add_fingerprint(rows, "text", "_fp", k, window)
    rows = rows.withColumn("_after", F.lead("_fp").over(follow)).filter(~F.col("_guard"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("_edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("_next", F.lit(1), half)))
    rows = add_fingerprint(rows, "_edited", "_efp", k, window)
    rows = rows.withColumn("_a", grams("_fp")).withColumn("_b", grams("_efp")).withColumn("_c", grams("_after"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("_fp").alias("fingerprint"),
        as_text("_efp").alias("edited_fingerprint"),
        likeness(F.col("_a"), F.col("_b")).alias("near_edited"),
        likeness(F.col("_a"), F.col("_c")).alias("near_next"),
    )
