"""The registered queries of the corpus operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, html_text, jaccard_join, language_id, mixing, packing, pii, quality_mil, repetition, toxicity
from .common import fold
from .labelled import labelled_sample
from .oracles import ORACLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_coverage(_table(spark, sf_dir, "documents"))


def op2_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), fold("doc_id", 3) == 1
    model = quality_mil.fit(labelled_sample(docs, _table(spark, sf_dir, "labels"), "quality", ~held_out))
    return quality_mil.score_quality(docs.withColumn("held_out", held_out), model, keep=("held_out",))


def op3_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    return language_id.identify_language(docs.withColumn("held_out", held_out), ~held_out, keep=("held_out",))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op4_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_links(_table(spark, sf_dir, "documents"))[0]


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op8_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op9_toxicity_deobfuscated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), fold("doc_id", 3) == 1
    sample = labelled_sample(docs, _table(spark, sf_dir, "labels"), "toxic", ~held_out)
    model = toxicity.fit(sample, toxicity.language_model(docs))
    return toxicity.score_toxicity(docs.withColumn("held_out", held_out), model, keep=("held_out",))


def op10_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_repetition_coverage, op2_quality_attention, op3_identify_language, op4_jaccard_join, op4_jaccard_links, op5_mix_sources, op6_pack, op7_sanitise, op8_line_blocks, op9_toxicity_deobfuscated, op10_stable_projections]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express a query; the others are held against brute force, round trips or held-out rows in tests."""
    return dict(ORACLES)
