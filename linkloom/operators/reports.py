"""Figures of a run: distributions of candidates, reduction of pairs, counts by country, confusion counts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def candidate_counts(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """entity_id, country, n: candidates of every query, 0 included."""
    n = pairs.groupBy(F.col("source1_id").alias("entity_id")).agg(F.count(F.lit(1)).alias("n"))
    return queries.select("entity_id", "country").join(n, "entity_id", "left").fillna({"n": 0})


def distribution(counts: DataFrame, value: str = "n", accuracy: int = 10_000) -> DataFrame:
    """Mean, approximate percentiles (values that occur) and the largest."""
    p = F.percentile_approx(value, [0.5, 0.95, 0.99], accuracy)
    return counts.agg(F.round(F.avg(value), 6).alias("mean"), p.alias("p"), F.max(value).alias("max")).select("mean", *[F.col("p")[k].alias(n) for k, n in enumerate(("p50", "p95", "p99"))], "max")


def distribution_linear(counts: DataFrame, value: str = "n") -> DataFrame:
    """Mean, exact percentiles between values, and the largest."""
    return counts.agg(F.round(F.avg(value), 6).alias("mean"), *[F.round(F.percentile(value, F.lit(q)), 6).alias(n) for q, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))], F.max(value).alias("max"))


def reduction(queries: DataFrame, targets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Possible pairs of equal countries, candidates, and the part that retrieval spares."""
    q, t = (df.groupBy("country").agg(F.count(F.lit(1)).alias(c)) for df, c in ((queries, "q"), (targets, "t")))
    possible = q.join(t, "country").agg(F.coalesce(F.sum(F.col("q") * F.col("t")), F.lit(0)).alias("possible_pairs"))
    got = pairs.agg(F.count(F.lit(1)).alias("candidate_pairs"))
    one = possible.crossJoin(F.broadcast(got))  # a row each
    return one.withColumn("reduction_ratio", F.when(F.col("possible_pairs") > 0, F.round(1.0 - F.col("candidate_pairs") / F.col("possible_pairs"), 9)).otherwise(0.0))


def per_country(counts: DataFrame) -> DataFrame:
    return counts.groupBy("country").agg(F.count(F.lit(1)).alias("queries"), F.sum("n").alias("candidates"), F.round(F.avg("n"), 6).alias("mean"), F.percentile_approx("n", 0.95, 10_000).alias("p95"))


def confusion(scored: DataFrame, predicted: str = "predicted") -> DataFrame:
    """True positives, false positives and false negatives among labelled pairs."""
    p = F.col(predicted)
    return scored.agg(F.count_if(p & (F.col("label") == 1)).alias("tp"), F.count_if(p & (F.col("label") == 0)).alias("fp"), F.count_if(~p & (F.col("label") == 1)).alias("fn"))


_PLACE = re.compile(r"\[\[([\w.]+)(?::([^\]]*))?\]\]")


def filled(template: str, metrics: dict) -> str:
    """A text with its places ``[[name]]`` or ``[[name:format]]`` filled from nested metrics (``[[test.pairs:,]]``).

    A place that the metrics don't have is an error, as is a format that its value doesn't take.
    """

    def of(m: re.Match) -> str:
        value = metrics
        for part in m[1].split("."):
            if not isinstance(value, dict) or part not in value:
                raise KeyError(f"nothing to fill {m[0]} with")
            value = value[part]
        return format(value, m[2] or "")

    return _PLACE.sub(of, template)
