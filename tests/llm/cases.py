"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

import random

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int) -> str:
    out = []
    for i in range(words):
        out.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))))
        if i % 13 == 12:
            out[-1] += ".\n"
    return " ".join(out)


def awkward(rng: random.Random) -> list[tuple]:
    """NULLs in every column, empty, blank, one-word and very long texts, a repeated row, odd characters."""
    base = prose(rng, 120)
    texts = [None, "", " \n\t ", "word", "a b c d", base, base, base.upper(), prose(rng, 6000), "é漢字😀 x▁y " * 20, "z" * 5000, "\n".join(["same line of ten words is here again and again"] * 4)]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t) if t else None) for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, base, None, None, None), (None, None, "en", "s1", 0)]


def frame(spark, rows: list[tuple], extra: bool = False):
    """The rows as `documents`, with columns on request whose names operators use themselves."""
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("score", "kept", "target", "copies", "shard", "slot", "ids", "n_words", "component_id", "key", "label"):
            df = df.selectExpr("*", f"'mine' AS {name}")
    return df
