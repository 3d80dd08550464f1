"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm import alignment, disclosure, html_text, line_dedup, minhash, mixing, oracles, phrases, pieces, quality, sharding, toxicity, warc, winnow
from sparkmart.llm.common import table


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(table(spark, folder, "documents"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digest(table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.digest(table(spark, folder, "pages"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(table(spark, folder, "documents"), line_dedup.LEAST_EXACT)


def op6_adaptive_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.digest(table(spark, folder, "documents"))


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.digest(table(spark, folder, "pages"))


def op8_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.digest(table(spark, folder, "documents"))


def op9_rendezvous_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.digest(table(spark, folder, "documents"))


def op10_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.digest(table(spark, folder, "documents"))


def op12_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.digest(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_source_mix, op2_sentencepiece, op3_toxicity, op4_warc_derivatives, op5_line_dedup, op6_adaptive_quality, op7_html_text, op8_winnowing, op9_rendezvous_shards, op10_minhash_near_duplicates, op11_token_alignment, op12_disclosure, op13_collocations,
)}

ORACLES: dict[str, str] = {
    "op1_source_mix": oracles.MIX,
    "op6_adaptive_quality": oracles.quality(quality.METRICS, quality.LEAST_DOCS, quality.REACH, quality.CELLS),
    "op9_rendezvous_shards": oracles.SHARDS,
    "op10_minhash_near_duplicates": oracles.NEAR,
    "op13_collocations": oracles.COLLOCATIONS,
}
