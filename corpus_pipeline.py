"""From raw documents to training tokens: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkmart.llm import line_dedup, minhash, mixing, pieces, toxicity
from sparkmart.llm.common import stored, table, word_array

#: Columns of documents, which every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labelled documents of `documents`."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line holds go, and documents of which nothing is left."""
    return line_dedup.dedup_lines(docs, exact=line_dedup.LEAST_EXACT).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it. Rows are ranked without their texts, which meet the copies by a number of the row."""
    sized = stored(docs.withColumns({"_row": F.monotonically_increasing_id(), "_size": F.size(word_array("text")).cast("long")}))
    taken = mixing.mix(sized.select("_row", "doc_id", "source", "_size"), "_size").select("_row", "copies").filter("copies > 0")
    return mixing.repeat(sized.join(taken, "_row"), docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of the text's pieces and their number."""
    return pieces.encode(docs, pieces.default_model()).withColumn("n_pieces", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: A trained model, an edit-distance join and a tokenizer are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
