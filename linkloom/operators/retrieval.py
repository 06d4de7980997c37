"""Retrieval over frequency-pruned blocks: postings, budgets, hits, scores, ranks.

Every step is a DataFrame of its own. Values too frequent in a source are found on counts, which are aggregated before the
shuffle; the most frequent of them are dropped where they are read, the others as their postings meet the counts. Scores are rounded before they are ranked: the sum of
weights may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocking import ADDRESS_COMPOSITES, NAME_COMPOSITES, Blocking

KEY = ["country", "target_source", "kind", "value"]
SCORE_DIGITS = 6
#: Values over their limit that all tasks are told, the most frequent ones: so many short rows at most.
HOT_VALUES = 10_000
#: What evidence adds to a retrieval score, by feature (fixed values); the second for composite blocks only.
FACTORS = {"exact_name_hit": 12.0, "exact_address_hit": 12.0, "postal_house_hit": 6.0, "name_token_hits": 0.75, "address_token_hits": 0.55, "name_gram_hits": 0.20, "address_gram_hits": 0.15}
COMPOSITE_FACTORS = {"roman_exact_name_hit": 12.0, "roman_exact_address_hit": 12.0, "name_composite_hits": 1.25, "address_composite_hits": 1.0}


def exploded(records: DataFrame, *columns: str) -> DataFrame:
    """The columns, kind and value: a row per key of a record.

    The outer explode is on purpose: from the inner one the optimizer infers a filter on the keys' number and carries it, with
    the whole expression of the keys, down to the scan, where every key would be found once more for each use.
    """
    rows = records.select(*columns, F.explode_outer("block_keys").alias("k"))
    return rows.select(*columns, "k.kind", "k.value").filter("kind is not null")


def postings(targets: DataFrame) -> DataFrame:
    """entity_id, country, target_source, kind, value: a row per target and key."""
    return exploded(targets, "entity_id", "country", "target_source")


def posting_stats(posts: DataFrame, config: Blocking) -> DataFrame:
    """How many targets have each value, and how many may. Ids are unique and a record's keys distinct, so rows are targets."""
    return posts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("posting_df")).withColumn("posting_limit", config.of("limit", F.col("kind")))


def eligible(stats: DataFrame) -> DataFrame:
    return stats.filter("posting_df <= posting_limit").select(*KEY, "posting_df")


def without_hot(rows: DataFrame, stats: DataFrame, most: int = HOT_VALUES) -> DataFrame:
    """Rows without the most frequent of the values that are over their limit: they go before anything is shuffled by value.

    The less frequent of these values are dropped by the joins with eligible keys, so results are the same.
    """
    top = stats.filter("posting_df > posting_limit").orderBy(F.desc("posting_df"), *KEY).limit(most).select(*KEY)
    return rows.join(F.broadcast(top), KEY, "left_anti")


def query_keys(queries: DataFrame, sources: list[str], keys: DataFrame, config: Blocking, stats: DataFrame | None = None) -> DataFrame:
    """The rarest keys of every query in every source, as many of a kind as its budget allows. With ``stats``, hot values go first."""
    own = exploded(queries, "entity_id", "country").withColumn("target_source", F.explode(F.array(*[F.lit(s) for s in sources])))
    own = own if stats is None else without_hot(own, stats)
    order = Window.partitionBy("entity_id", "target_source", "kind").orderBy("posting_df", "value")
    own = own.join(keys, KEY).withColumn("key_rank", F.row_number().over(order))
    return own.filter(F.col("key_rank") <= config.of("budget", F.col("kind")))


def block_hits(own: DataFrame, posts: DataFrame, keys: DataFrame) -> DataFrame:
    """source1_id, country, target_source, target_id, kind, posting_df: a row per key that a query shares with a target."""
    there = posts.join(keys, KEY).select(*KEY, F.col("entity_id").alias("target_id"))
    return own.select(F.col("entity_id").alias("source1_id"), *KEY, "posting_df").join(there, KEY).select("source1_id", "country", "target_source", "target_id", "kind", "posting_df")


def _any(*kinds: str):
    return F.max(F.when(F.col("kind").isin(*kinds), 1).otherwise(0))


def _times(*kinds: str):
    names = [n for k in kinds for n in (k, f"roman_{k}")]
    return F.sum(F.when(F.col("kind").isin(*names), 1).otherwise(0))


def evidence(hits: DataFrame, config: Blocking) -> DataFrame:
    """Counts of shared keys by kind for every pair, rarity_score and retrieval_score."""
    weight = config.of("weight", F.col("kind")) / F.log(F.col("posting_df").cast("double") + F.lit(1.0))
    sums = {
        "exact_name_hit": _any("exact_name"), "exact_address_hit": _any("exact_address"), "postal_house_hit": _any("postal_house", "roman_postal_house"),
        "name_token_hits": _times("name_token"), "address_token_hits": _times("address_token"),
        "name_gram_hits": _times("name_gram"), "address_gram_hits": _times("address_gram"),
    }
    factors = dict(FACTORS)
    if config.composite:
        sums |= {
            "roman_exact_name_hit": _any("roman_exact_name"), "roman_exact_address_hit": _any("roman_exact_address"),
            "composite_key_hits": _times(*NAME_COMPOSITES, *ADDRESS_COMPOSITES), "name_composite_hits": _times(*NAME_COMPOSITES), "address_composite_hits": _times(*ADDRESS_COMPOSITES),
        }
        factors |= COMPOSITE_FACTORS
    pairs = hits.withColumn("w", weight).groupBy("source1_id", "country", "target_source", "target_id").agg(*[e.alias(c) for c, e in sums.items()], F.round(F.sum("w"), SCORE_DIGITS).alias("rarity_score"))
    score = F.col("rarity_score")
    for c, f in factors.items():
        score = score + F.lit(f) * F.col(c)
    return pairs.withColumn("retrieval_score", F.round(score, SCORE_DIGITS))


def ranked(pairs: DataFrame, cap: int) -> DataFrame:
    """The cap best targets of every query and source, with their rank."""
    order = Window.partitionBy("source1_id", "target_source").orderBy(F.desc("retrieval_score"), F.desc("exact_name_hit"), F.desc("exact_address_hit"), "target_id")
    return pairs.withColumn("candidate_rank", F.row_number().over(order)).filter(F.col("candidate_rank") <= cap)


def candidates(queries: DataFrame, targets: DataFrame, config: Blocking, sources: list[str] = ["S2", "S3"]) -> DataFrame:  # noqa: B006
    """Ranked candidate pairs of prepared queries and prepared targets."""
    posts = postings(targets)
    stats = posting_stats(posts, config)
    keys = eligible(stats)
    return ranked(evidence(block_hits(query_keys(queries, sources, keys, config, stats), without_hot(posts, stats), keys), config), config.cap)
