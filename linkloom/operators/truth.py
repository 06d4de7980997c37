"""Known links: edges from packed lists, checks, and labels of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def truth_edges(packed: DataFrame) -> DataFrame:
    """source1_id, target_id, each pair once, from source1_entity_id and a comma list matched_entity_ids."""
    rows = packed.select(F.trim("source1_entity_id").alias("source1_id"), F.explode(F.split(F.coalesce("matched_entity_ids", F.lit("")), ",")).alias("t"))
    return rows.select("source1_id", F.trim("t").alias("target_id")).filter("source1_id <> '' and target_id <> ''").dropDuplicates()


def group_sizes(packed: DataFrame) -> DataFrame:
    """How many queries have how many links."""
    n = F.size(F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), F.trim), lambda t: t != ""))
    return packed.select(n.alias("links")).groupBy("links").agg(F.count(F.lit(1)).alias("queries"))


def truth_violations(edges: DataFrame, queries: DataFrame) -> DataFrame:
    """One row: edges of unknown queries, and targets with several owners."""
    unknown = edges.join(queries.select(F.col("entity_id").alias("source1_id")), "source1_id", "left_anti").agg(F.count(F.lit(1)).alias("unknown_queries"))
    shared = edges.groupBy("target_id").agg(F.count_distinct("source1_id").alias("n")).filter("n > 1").agg(F.count(F.lit(1)).alias("shared_targets"))
    return unknown.join(shared)  # two rows of one aggregate each


def first_owner(edges: DataFrame) -> DataFrame:
    """Edges in which every target keeps its smallest owner only."""
    return edges.groupBy("target_id").agg(F.min("source1_id").alias("source1_id")).select("source1_id", "target_id")


def labelled(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs with label 1 if they are known links, else 0."""
    return pairs.join(edges.select("source1_id", "target_id").withColumn("label", F.lit(1)), ["source1_id", "target_id"], "left").fillna({"label": 0})
