"""The test tables as record sources.

``documents`` gives three registries: source by doc_id, a name and an address from the text, the language as country, and
equal texts as known links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, source, business_name, business_address, country, content (a digest of the text)."""
    docs = table(spark, sf_dir, "documents")
    source = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"))
    number = (F.col("n_chars") % 200).cast("string")
    code = (F.lit(10000) + (F.col("n_chars") * 7) % 90000).cast("string")
    return docs.select(
        F.concat(source, F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), source.alias("source"),
        F.substring("text", 1, 60).alias("business_name"), F.concat(number, F.lit(" "), F.substring("text", 61, 40), F.lit(" "), code).alias("business_address"),
        F.col("lang").alias("country"), F.md5(F.col("text").cast("binary")).alias("content"),
    )


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records of S1, S2 and S3."""
    every = registry(spark, sf_dir)
    return tuple(every.filter(F.col("source") == s) for s in ("S1", "S2", "S3"))


def packed_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source1_entity_id and its known links, by id, as a comma list: a row per S1 record."""
    every = registry(spark, sf_dir).select("entity_id", "source", "content")
    q, t = every.filter("source = 'S1'"), every.filter("source <> 'S1'").select(F.col("entity_id").alias("target"), "content")
    links = q.join(t, "content").groupBy("entity_id").agg(F.array_join(F.array_sort(F.collect_list("target")), ",").alias("ids"))
    return q.join(links, "entity_id", "left").select(F.col("entity_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))
