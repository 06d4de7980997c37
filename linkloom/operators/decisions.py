"""Decisions on scored pairs: fixed rules, thresholds, one owner per target, packed lists."""

from __future__ import annotations

from functools import reduce
from operator import add, and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Digits of rule scores, and of the scores that lists are ordered by.
SCORE_DIGITS, ORDER_DIGITS = 6, 8


#: What a feature adds to the rule score; least values of the rules. A rule is met if all its first values are
#: reached and one of its others; ``same_place`` stands for an equal address, postal code or house, or half of the numbers.
RULE_WEIGHTS = {
    "name": 0.37, "name_words": 0.12, "address": 0.27, "address_words": 0.10, "house_number_equal": 0.06, "postal_equal": 0.05, "exact_name": 0.18, "exact_address": 0.08,
    "candidate_rank_reciprocal": 0.04,
}
RULES = (
    ({"exact_name": 1}, {"address": 0.25, "address_words": 0.30, "same_place": 1}),
    ({"name": 0.94, "name_words": 0.55}, {"address": 0.45, "address_words": 0.35, "same_place": 1}),
    ({"name": 0.87, "name_words": 0.50}, {"address": 0.70, "address_words": 0.55}),
    ({"name": 0.75, "name_words": 0.35}, {"address": 0.93, "address_words": 0.78, "exact_address": 1}),
)
_MEASURES = {"name": "name_edit_similarity", "name_words": "name_token_jaccard", "address": "address_edit_similarity", "address_words": "address_token_jaccard", "exact_name": "exact_name", "exact_address": "exact_address"}


def rule_matches(features: DataFrame, rules=RULES, weights: dict[str, float] = RULE_WEIGHTS) -> DataFrame:
    """Pairs that meet one of the rules, with their rule_score, rounded. Of a feature's native and romanised value the larger counts."""
    value = {m: F.greatest(F.col(c), F.col(f"roman_{c}")) for m, c in _MEASURES.items()}
    of = lambda m: value.get(m, F.col(m) if m not in value else None)
    numbers = F.when(F.col("number_jaccard") >= 0.5, 1.0).otherwise(0.0)
    value["same_place"] = F.greatest(value["exact_address"], F.col("postal_equal"), F.col("house_number_equal"), numbers)
    reached = lambda limits: [of(m) >= limit for m, limit in limits.items()]
    met = [reduce(and_, reached(every)) & reduce(or_, reached(some)) for every, some in rules]
    score = reduce(add, [F.lit(w) * of(m) for m, w in weights.items()])
    return features.withColumn("rule_score", F.round(score, SCORE_DIGITS)).filter(reduce(or_, met))


def over_thresholds(scored: DataFrame, thresholds: dict[str, float] | float, score: str = "probability") -> DataFrame:
    """Pairs at or over one threshold, or over that of their target's source."""
    if isinstance(thresholds, dict):
        limit = F.coalesce(*[F.when(F.col("target_source") == s, F.lit(t)) for s, t in thresholds.items()])
    else:
        limit = F.lit(thresholds)
    return scored.filter(F.col(score) >= limit)


def exclusive(pairs: DataFrame, score: str) -> DataFrame:
    """One pair per target: the best score, then the better rank, then the smaller query."""
    order = Window.partitionBy("target_id").orderBy(F.desc(score), "candidate_rank", "source1_id")
    return pairs.withColumn("k", F.row_number().over(order)).filter("k = 1").drop("k")


def packed_lists(all_queries: DataFrame, pairs: DataFrame, score: str, name: str) -> DataFrame:
    """One row per query: its targets joined by commas, best score first, then source and id; empty if it has none.

    Scores count to 8 digits: those that agree so far are equal.
    """
    entry = F.struct((-F.round(score, ORDER_DIGITS)).alias("s"), F.col("target_source").alias("o"), F.col("target_id").alias("t"))
    lists = pairs.groupBy("source1_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["t"]), ",").alias(name))
    return all_queries.select(F.col("entity_id").alias("source1_id")).join(lists, "source1_id", "left").select(F.col("source1_id").alias("source1_entity_id"), F.coalesce(name, F.lit("")).alias(name))


def top_candidates(pairs: DataFrame, cap: int, score: str = "rank") -> DataFrame:
    """Per query and source the cap best distinct targets; of a target's rows the best one counts."""
    if cap < 0:
        raise ValueError("the cap can't be negative")
    best = pairs.groupBy("source1_id", "target_source", "target_id").agg(F.max(score).alias(score))
    order = Window.partitionBy("source1_id", "target_source").orderBy(F.desc(score), "target_id")
    return best.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= cap).drop("k")


def best_per_target(scored: DataFrame, threshold: float, score: str = "probability", rank: str = "candidate_rank") -> DataFrame:
    """Every target's best query, if it reaches the threshold; ties go to the better rank."""
    order = Window.partitionBy("target_id").orderBy(F.desc(score), rank)
    return scored.withColumn("k", F.row_number().over(order)).filter((F.col("k") == 1) & (F.col(score) >= threshold)).drop("k")


def hard_negatives(labelled: DataFrame, per_source: int = 8) -> DataFrame:
    """Wrong pairs with the best scores of every query and source."""
    order = Window.partitionBy("source1_id", "target_source").orderBy(F.desc("retrieval_score"), "target_id")
    return labelled.filter("label = 0").withColumn("negative_rank", F.row_number().over(order)).filter(F.col("negative_rank") <= per_source)


def training_sample(labelled: DataFrame, per_source: int = 8) -> DataFrame:
    """All right pairs and the hardest wrong ones."""
    return labelled.filter("label = 1").unionByName(hard_negatives(labelled, per_source).drop("negative_rank"), allowMissingColumns=True)
