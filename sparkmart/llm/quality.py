"""Quality rules with thresholds that follow each language and source, from mergeable quantile sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkmart.llm.common import BLANKS, stored, whole, word_array

SYMBOLS = "#*$%&|<>"
#: Sketch cells per power of two: a quantile is exact to one part in CELLS.
CELLS = 32
#: Groups with fewer documents take the sketch of their language, and that failing, of all documents.
LEAST_DOCS = 200
#: Fences stand REACH interquartile ranges outside the quartiles, and SLACK (per metric) at least.
REACH = 3.0

#: metric -> (expression over the measures, side that is fenced, slack)
METRICS = {
    "word_length": ("word_chars * 100 div n_words", "both", 100),
    "symbols": ("n_symbols * 1000 div n_words", "high", 100),
    "repeated": ("n_repeat_words * 1000 div n_words", "high", 200),
    "same_lines": ("n_dup_lines * 1000 div n_lines", "high", 200),
}


def pairs(a: Column, b: Column, skip: int, join) -> Column:
    """join(a[i], b[i + skip]) for every i that has both."""
    n = F.greatest(F.size(a) - skip, F.lit(0)) if a is b else F.greatest(F.least(F.size(a), F.size(b) - skip), F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1 + skip), n), join)


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of the whole text (NULL: none).

    Columns of these names are replaced.
    """
    df = df.drop("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    t = whole(text)
    df = df.withColumn("_w", word_array(text)).withColumn("_l", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    df = df.select(
        "*",
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"),
    ).drop("_w", "_l")
    # Every array is referred to at least twice below, so Spark keeps it as a column of its own
    # instead of computing it again for every element.
    h = F.col("_h")
    df = df.withColumn("_two", pairs(h, h, 1, lambda x, y: F.xxhash64(x, y)))
    df = df.withColumn("_three", pairs(F.col("_two"), h, 2, lambda x, y: F.xxhash64(x, y))).drop("_h", "_two")
    three = F.col("_three")
    again = F.size(F.array_distinct(three)) < F.size(three)
    df = df.withColumn("_s", F.when(again, F.array_sort(F.transform(three, lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("_three")
    s = F.col("_s")
    same = F.flatten(pairs(s, s, 1, lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
    df = df.withColumn("_p", F.when(s.isNotNull(), F.array_sort(F.array_distinct(same)))).drop("_s")
    p = F.col("_p")
    covered = F.aggregate(pairs(p, p, 1, lambda a, b: F.least(b - a, F.lit(3))), F.lit(3), lambda acc, x: acc + x)
    return df.withColumn("n_repeat_words", F.coalesce(F.when(F.size(p) > 0, covered), F.lit(0)).cast("long")).drop("_p")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def cell(value: Column) -> Column:
    """Sketch cell of a whole number: itself below 2 * CELLS, then CELLS cells per power of two."""
    high = F.length(F.bin(value)) - 6
    return F.when(value < 2 * CELLS, value).otherwise(F.call_function("shiftright", value, high.cast("int")) + CELLS * high).cast("long")


def cell_top(c: Column) -> Column:
    """Largest value of a cell."""
    high = F.floor(c / CELLS).cast("int") - 1
    return F.when(c < 2 * CELLS, c).otherwise(F.call_function("shiftleft", c - CELLS * high + 1, high) - 1).cast("long")


def sketch(df: DataFrame, by: list[str]) -> DataFrame:
    """Quantile sketches: documents per (group, metric, cell). Adding counts merges sketches."""
    cells = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), cell(F.expr(e)).alias("cell")) for m, (e, _, _) in METRICS.items())))
    return df.select(*by, cells.alias("c")).groupBy(*by, "c.metric", "c.cell").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by, "metric", "cell").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, by: list[str], shares: dict[str, float]) -> DataFrame:
    """Per group and metric: n, and for each name the top of the cell that holds that share of the documents."""
    group = Window.partitionBy(*by, "metric")
    run = sketches.withColumn("upto", F.sum("n").over(group.orderBy("cell"))).withColumn("total", F.sum("n").over(group))
    found = [F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("cell"))).alias(name) for name, q in shares.items()]
    out = run.groupBy(*by, "metric").agg(F.max("total").alias("n"), *found)
    return out.select(*by, "metric", "n", *(cell_top(F.col(name)).alias(name) for name in shares))


def fences(sketches: DataFrame, by: list[str]) -> DataFrame:
    """One row per group with n and, per metric, its lowest and highest accepted value."""
    q = quantiles(sketches, by, {"q1": 0.25, "q3": 0.75})
    slack = F.element_at(F.create_map(*(F.lit(x) for m, v in METRICS.items() for x in (m, float(v[2])))), F.col("metric"))
    reach = F.greatest((F.col("q3") - F.col("q1")) * REACH, slack)
    q = q.withColumn("low", F.col("q1") - reach).withColumn("high", F.col("q3") + reach)
    sides = []
    for m, (_, side, _) in METRICS.items():
        sides += [F.max(F.when(F.col("metric") == m, F.col("low"))).alias(f"{m}_low")] * (side == "both")
        sides += [F.max(F.when(F.col("metric") == m, F.col("high"))).alias(f"{m}_high")]
    return q.groupBy(*by).agg(F.max("n").alias("n"), *sides)


def verdict(df: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Add base_failed and kept to a table that has `measures`; pass it stored, it is read twice.

    Documents that pass the base rules are sketched per (lang, source). A group's fences come from
    its own sketch if it has LEAST_DOCS documents, else from the merged sketch of its language, else
    of all documents. NULL languages and sources are groups of their own. With no document that
    passes the base rules there are no fences and nothing is kept. Columns named base_failed and kept are replaced.
    """
    df = df.drop("base_failed", "kept")
    df = df.withColumn("base_failed", base_failed())
    named = df.withColumn("_lang", F.coalesce(F.concat(F.lit("="), F.col(lang)), F.lit(""))).withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")))
    own = stored(sketch(named.filter(~F.col("base_failed")), ["_lang", "_source"]))
    limits = [c for m, (_, side, _) in METRICS.items() for c in ([f"{m}_low"] * (side == "both") + [f"{m}_high"])]
    some = fences(own, ["_lang", "_source"]).withColumnsRenamed({"n": "n_own", **{c: f"own_{c}" for c in limits}})
    lang_wide = fences(merge(own, ["_lang"]), ["_lang"]).withColumnsRenamed({"n": "n_lang", **{c: f"lang_{c}" for c in limits}})
    every = fences(merge(own.withColumn("_all", F.lit(1)), ["_all"]), ["_all"]).withColumnsRenamed({"n": "n_all", **{c: f"all_{c}" for c in limits}})
    keys = named.select("_lang", "_source").distinct().withColumn("_all", F.lit(1))
    table = keys.join(some, ["_lang", "_source"], "left").join(lang_wide, "_lang", "left").join(every, "_all", "left")
    pick = lambda c: F.when(F.col("n_own") >= LEAST_DOCS, F.col(f"own_{c}")).when(F.col("n_lang") >= LEAST_DOCS, F.col(f"lang_{c}")).otherwise(F.col(f"all_{c}"))
    table = table.select("_lang", "_source", *(pick(c).alias(c) for c in limits))
    ok = F.lit(True)
    for m, (e, side, _) in METRICS.items():
        ok = ok & (F.expr(e) <= F.col(f"{m}_high"))
        if side == "both":
            ok = ok & (F.expr(e) >= F.col(f"{m}_low"))
    joined = named.join(table, ["_lang", "_source"], "left")
    return joined.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(ok, F.lit(False)))).drop("_lang", "_source")


def digest(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every document."""
    slim = docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    out = verdict(stored(measures(slim).drop("text")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
