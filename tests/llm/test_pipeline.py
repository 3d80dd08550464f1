"""The pipeline as a whole: shapes between stages, and their effect on planted cases."""

import random
import re

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp
from sparkmart.llm import mixing, pieces, queries
from sparkmart.llm.common import word_array
from tests.llm.cases import DOCS, FOLDER, prose
from tests.oracle import compare, connect


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def corpus(folder, spark):
    rng = random.Random(17)
    rows, labels = [], []
    insults = ["idiot", "moron", "stupid", "pathetic"]
    passage = " ".join(prose(rng, 60).split())
    for i in range(400):
        w = prose(rng, rng.randint(60, 120)).split(" ")
        if i % 8 == 0:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(insults))
        rows.append((i, " ".join(w) + (f"\n{passage}" if i % 10 == 1 else ""), "en", f"s{i % 3}", 1))
        labels.append((i, 1, int(i % 8 == 0)))
    base = " ".join(prose(rng, 100).split())
    rows += [(500, base, "en", "s0", 1), (501, base, "en", "s1", 1), (502, base + " one more word", "en", "s1", 1), (503, None, None, None, None), (504, "", "en", None, 0)]
    write(spark, folder, "documents", rows, DOCS)
    write(spark, folder, "labels", labels, "doc_id long, quality int, toxic int")
    return rows, passage


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    rows, passage = corpus(folder, spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, folder)
        if k < len(cp.STAGES) - 1:
            assert sorted(out.columns) == sorted(cp.COLUMNS)
        out.write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
        ids[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
        if name == "line_dedup":
            assert docs.filter(docs.text.contains(passage)).count() == 1
    toxic = {i for i in range(400) if i % 8 == 0}
    assert len(toxic & set(ids["toxicity"])) <= 2 and len(ids["toxicity"]) >= len(rows) - len(toxic) - 4
    assert 501 not in ids["line_dedup"] and 502 in ids["line_dedup"] and {503, 504} <= set(ids["line_dedup"])
    assert 500 in ids["minhash_near_dedup"] and 502 not in ids["minhash_near_dedup"]
    assert max(ids["source_mix"].count(i) for i in set(ids["source_mix"])) <= 2
    kept = spark.read.parquet(f"{folder}/stage2")
    sized = mixing.mix(kept.selectExpr("doc_id", "source", "size(split(trim(text), ' +')) * 1L AS n"), "n")
    assert sized.agg({"copies": "sum"}).first()[0] > 0
    judge = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    assert all(r["ids"] == (judge.encode(r["text"]) if r["text"] else []) and r["n_pieces"] == len(r["ids"]) for r in docs.collect())
    whole = cp.run(spark, folder)
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(ids["sentencepiece"])


def test_sources_are_mixed_without_texts_in_the_ranks(spark, tmp_path):
    """A source's documents of a size meet in one task: their texts may not come along. Keys repeat and are null."""
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(150)]), prose(rng, rng.randint(1, 60)), None, rng.choice(["a", "b", None]), 1) for _ in range(300)]
    rows += [rows[0]] * 5 + [(7, None, None, "a", None), (7, "", "en", "c", 0), (None, "one", "en", "c", 1)]
    write(spark, tmp_path, "documents", rows, DOCS)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = cp.mix_sources(spark, docs, str(tmp_path))
    sized = docs.withColumn("n", F.size(word_array("text")).cast("long"))
    assert out.columns == docs.columns
    shape = ["doc_id", "source", F.size(word_array("text")).alias("n")]  # rows equal in these are interchangeable
    assert sorted(map(str, out.select(*shape).collect())) == sorted(map(str, mixing.repeat(mixing.mix(sized, "n"), docs.columns).select(*shape).collect()))
    assert {tuple(r) for r in out.collect()} <= set(rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [re.search(r"[A-Za-z]", line).start() if line.strip() else 0 for line in plan]
    windows = [i for i, line in enumerate(plan) if "Window [" in line]
    for i in windows:
        below = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
        assert not [line for line in plan[i:below] if re.search(r"\btext#", line) and "Relation" not in line]
    assert windows


def test_registered_queries(spark):
    con = connect(FOLDER)
    for key, run in queries.QUERIES.items():
        if sql := queries.ORACLES.get(key):
            diff = compare(spark, con, type("Q", (), {"sql": sql, "__call__": lambda self, s, f, run=run: run(s, f)})(), FOLDER)
            assert diff is None, (key, diff)
        else:
            assert run(spark, FOLDER).count() > 0
