"""Evaluation and calibration as relational sweeps: a small table of settings against pre-aggregated counts, no UDF."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.vocabulary import CAPS, TARGET_CAPS, TARGET_THRESHOLDS, THRESHOLDS

from .decisions import exclusive


def f_half(tp: Column, predicted: Column, truth: Column) -> Column:
    """F0.5 of one query: 1 if nothing is true and nothing predicted, 0 if only one of them is empty."""
    return F.when((truth == 0) & (predicted == 0), 1.0).when((truth == 0) | (predicted == 0), 0.0).otherwise(1.25 * tp / (predicted + 0.25 * truth))


def _grid(spark, **axes) -> DataFrame:
    """All combinations of a few settings: a table whose size the call fixes, made without a job. None is allowed among them."""
    kinds = ["int" if isinstance(values[0], int) else "double" for values in axes.values()]
    cell = lambda v, kind: f"CAST({'NULL' if v is None else v} AS {kind})"
    rows = ", ".join(f"({', '.join(map(cell, row, kinds))})" for row in product(*axes.values()))
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(axes)})"))


def truth_counts(queries: DataFrame, edges: DataFrame) -> DataFrame:
    n = edges.groupBy("source1_id").agg(F.count_distinct("target_id").alias("truth_count"))
    return queries.select(F.col("entity_id").alias("source1_id")).distinct().join(n, "source1_id", "left").fillna({"truth_count": 0})


def sweep(queries: DataFrame, scored: DataFrame, edges: DataFrame, caps=CAPS, thresholds=THRESHOLDS, score: str = "probability") -> DataFrame:
    """Macro F0.5 and candidate recall for every cap per source and threshold.

    Only settings under which a query has predictions are counted out; all others score what an empty answer scores.
    """
    spark = scored.sparkSession
    truth = truth_counts(queries, edges)
    # A setting without a threshold counts the links among candidates, so pairs are read once.
    grid = _grid(spark, cap_per_source=list(caps), threshold=[*map(float, thresholds), None])
    kept = scored.select("source1_id", "candidate_rank", F.col(score).alias("p"), "label")
    counts = kept.join(grid, (F.col("candidate_rank") <= F.col("cap_per_source")) & (F.col("threshold").isNull() | (F.col("p") >= F.col("threshold"))))
    counts = counts.groupBy("cap_per_source", "threshold", "source1_id").agg(F.sum("label").alias("tp"), F.count(F.lit(1)).alias("predicted"))
    per = counts.join(truth, "source1_id", "left").withColumn("gain", f_half(F.col("tp"), F.col("predicted"), F.col("truth_count")) - f_half(F.lit(0), F.lit(0), F.col("truth_count")))
    sums = per.groupBy(F.col("cap_per_source").alias("c"), F.col("threshold").alias("t")).agg(F.sum("gain").alias("gain"), F.sum("tp").alias("tp"))
    all_ = truth.agg(F.count(F.lit(1)).alias("n"), F.sum("truth_count").alias("truth_links"), F.sum(f_half(F.lit(0), F.lit(0), F.col("truth_count"))).alias("empty"))
    out = grid.join(sums, (F.col("cap_per_source") == F.col("c")) & F.col("threshold").eqNullSafe(F.col("t")), "left")  # a row per setting
    out = out.withColumn("candidate_hits", F.max(F.when(F.col("threshold").isNull(), F.col("tp"))).over(Window.partitionBy("cap_per_source")))
    out = out.filter("threshold is not null").crossJoin(F.broadcast(all_))  # one row
    return out.select(
        "cap_per_source", "threshold", F.round((F.col("empty") + F.coalesce("gain", F.lit(0.0))) / F.col("n"), 9).alias("macro_f0_5"),
        F.coalesce("candidate_hits", F.lit(0)).alias("candidate_hits"), "truth_links",
        F.when(F.col("truth_links") > 0, F.coalesce("candidate_hits", F.lit(0)) / F.col("truth_links")).otherwise(0.0).alias("candidate_recall"),
    )


def best_per_cap(swept: DataFrame) -> DataFrame:
    """Every cap's best threshold; ties go to the lowest."""
    order = Window.partitionBy("cap_per_source").orderBy(F.desc("macro_f0_5"), "threshold")
    return swept.withColumn("k", F.row_number().over(order)).filter("k = 1").drop("k")


def operating_point(caps: DataFrame, recall_gate: float = 0.99, tolerance: float = 0.002) -> DataFrame:
    """The smallest cap with enough recall near the best score; without one, the smallest cap of the best score.

    ``caps`` has a row per cap. An empty table has no operating point: the result is empty.
    """
    # A row per cap: the windows order a handful of rows.
    every = Window.partitionBy(F.lit(1))
    df = caps.withColumn("best", F.max("macro_f0_5").over(every))
    df = df.withColumn("class", F.when((F.col("candidate_recall") >= recall_gate) & (F.col("macro_f0_5") >= F.col("best") - tolerance), 0).when(F.col("macro_f0_5") == F.col("best"), 1))
    order = Window.partitionBy(F.lit(1)).orderBy("class", "cap_per_source")
    return df.filter("class is not null").withColumn("k", F.row_number().over(order)).filter("k = 1").drop("k", "class", "best")


def source_sweep(queries: DataFrame, scored: DataFrame, edges: DataFrame, cap: int, fixed: dict[str, float], varying: str, thresholds=THRESHOLDS, score: str = "probability") -> DataFrame:
    """Macro F0.5 for every threshold of one source, those of the others fixed."""
    truth = truth_counts(queries, edges)
    kept = scored.filter(F.col("candidate_rank") <= cap).select("source1_id", "target_source", F.col(score).alias("p"), "label")
    grid = _grid(scored.sparkSession, threshold=list(thresholds))
    fixed_limit = F.coalesce(*[F.when(F.col("target_source") == s, F.lit(t)) for s, t in fixed.items()], F.lit(2.0))
    limit = F.when(F.col("target_source") == varying, F.col("threshold")).otherwise(fixed_limit)
    counts = kept.join(grid, F.col("p") >= limit).groupBy("threshold", "source1_id").agg(F.sum("label").alias("tp"), F.count(F.lit(1)).alias("predicted"))
    per = counts.join(truth, "source1_id").withColumn("gain", f_half(F.col("tp"), F.col("predicted"), F.col("truth_count")) - f_half(F.lit(0), F.lit(0), F.col("truth_count")))
    all_ = truth.agg(F.count(F.lit(1)).alias("n"), F.sum(f_half(F.lit(0), F.lit(0), F.col("truth_count"))).alias("empty"))
    out = grid.join(per.groupBy("threshold").agg(F.sum("gain").alias("gain")), "threshold", "left").crossJoin(F.broadcast(all_))  # one row
    return out.select("threshold", F.round((F.col("empty") + F.coalesce("gain", F.lit(0.0))) / F.col("n"), 9).alias("macro_f0_5"))


def calibrated(queries: DataFrame, scored: DataFrame, edges: DataFrame, cap: int, start: float, sources=("S2", "S3"), rounds: int = 2, thresholds=THRESHOLDS, score: str = "probability") -> tuple[dict[str, float], float]:
    """Thresholds per source by coordinates, and the macro F0.5 reached; ties go to the highest threshold."""
    at, best = dict.fromkeys(sources, start), 0.0
    for _ in range(rounds):
        for s in sources:
            row = source_sweep(queries, scored, edges, cap, at, s, thresholds, score).orderBy(F.desc("macro_f0_5"), F.desc("threshold")).first()
            at[s], best = float(row["threshold"]), float(row["macro_f0_5"])
    return at, best


def fixed_score(queries: DataFrame, scored: DataFrame, edges: DataFrame, cap: int, thresholds: dict[str, float], score: str = "probability") -> DataFrame:
    """One row of metrics at fixed thresholds per source, every target with one owner."""
    kept = scored.filter(F.col("candidate_rank") <= cap)
    limit = F.coalesce(*[F.when(F.col("target_source") == s, F.lit(t)) for s, t in thresholds.items()])
    hits = kept.groupBy("source1_id").agg(F.sum("label").alias("candidate_hits"))
    won = exclusive(kept.filter(F.col(score) >= limit), score).groupBy("source1_id").agg(F.sum("label").alias("tp"), F.count(F.lit(1)).alias("predicted"))
    per = truth_counts(queries, edges).join(hits, "source1_id", "left").join(won, "source1_id", "left").fillna(0)
    per = per.withColumn("f", f_half(F.col("tp"), F.col("predicted"), F.col("truth_count")))
    total = per.agg(F.round(F.avg("f"), 9).alias("macro_f0_5"), *[F.sum(c).cast("long").alias(a) for c, a in (("tp", "true_positives"), ("predicted", "predicted_pairs"), ("truth_count", "truth_links"), ("candidate_hits", "candidate_hits"))])
    zero = F.lit(0).cast("long")
    return total.select(
        "macro_f0_5", F.when(F.col("truth_links") > 0, F.col("candidate_hits") / F.col("truth_links")).otherwise(0.0).alias("candidate_recall"), "true_positives",
        F.greatest(zero, F.col("predicted_pairs") - F.col("true_positives")).alias("false_positives"), F.greatest(zero, F.col("truth_links") - F.col("true_positives")).alias("false_negatives"),
        F.greatest(zero, F.col("truth_links") - F.col("candidate_hits")).alias("missed_by_blocking"), F.greatest(zero, F.col("candidate_hits") - F.col("true_positives")).alias("false_negatives_within_candidate_set"),
        "truth_links", "predicted_pairs",
    )


def target_recall(scored: DataFrame, edges: DataFrame, caps=TARGET_CAPS) -> DataFrame:
    """cap, candidate_pairs and candidate_recall: how many targets have their known query among the first of each cap, of all that have one."""
    grid = _grid(scored.sparkSession, cap=list(caps))
    first = scored.groupBy("target_id").agg(F.min(F.when(F.col("label") == 1, F.col("candidate_rank"))).alias("at"), F.collect_list("candidate_rank").alias("ranks"))
    hits = first.join(grid, F.lit(True)).groupBy("cap").agg(F.count_if(F.col("at") <= F.col("cap")).alias("hits"), F.sum(F.size(F.filter("ranks", lambda r: r <= F.col("cap")))).alias("candidate_pairs"))
    known = F.broadcast(edges.agg(F.count_distinct("target_id").alias("known")))  # one row
    out = grid.join(hits, "cap", "left").crossJoin(known)
    recall = F.when(F.col("known") > 0, F.round(F.coalesce("hits", F.lit(0)) / F.col("known"), 9)).otherwise(0.0)
    return out.select("cap", F.coalesce("candidate_pairs", F.lit(0)).cast("long").alias("candidate_pairs"), recall.alias("candidate_recall"))


def target_cells(references: DataFrame, scored: DataFrame, edges: DataFrame, by: list[str] = [], caps=TARGET_CAPS, thresholds=TARGET_THRESHOLDS, score: str = "probability") -> DataFrame:  # noqa: B006
    """Every target goes to its best query among its cap first: for each cap, threshold and group of queries (the columns
    ``by`` of ``references``, few values) the queries n, the sum f of their F0.5, true and predicted pairs.

    ``scored`` has target_id, candidate_rank within the target, source1_id, the score and label.
    """
    spark = scored.sparkSession
    levels, rank = sorted({*map(float, thresholds)}), F.col("candidate_rank")
    own = F.struct(F.col(score).alias("p"), (-rank).alias("rank"), "source1_id", "label")
    best = scored.groupBy("target_id").agg(*[F.max(F.when(rank <= c, own)).alias(f"b{k}") for k, c in enumerate(caps)])
    best = best.select(F.explode(F.array(*[F.struct(F.lit(c).alias("cap"), F.col(f"b{k}").alias("b")) for k, c in enumerate(caps)])).alias("x"))
    # A row has the number of thresholds that it reaches: rows are counted by that, and thresholds told apart where a query's counts are together.
    settings = F.array(*map(F.lit, levels))
    best = best.select("x.cap", "x.b.source1_id", "x.b.label", F.size(F.filter(settings, lambda t: F.col("x.b.p") >= t)).alias("level")).filter("level > 0")
    counts = best.groupBy("cap", "source1_id", "level").agg(F.sum("label").alias("tp"), F.count(F.lit(1)).alias("predicted"))
    counts = counts.groupBy("cap", "source1_id").agg(F.collect_list(F.struct("level", "tp", "predicted")).alias("at"))
    truth = truth_counts(references, edges).join(references.select(F.col("entity_id").alias("source1_id"), *by).dropDuplicates(["source1_id"]), "source1_id")
    nothing = f_half(F.lit(0), F.lit(0), F.col("truth_count"))
    reached = F.explode(F.sequence(F.lit(1), F.array_max(F.transform("at", lambda x: x["level"]))))
    per = counts.join(truth, "source1_id").withColumn("level", reached)
    total = lambda c: F.aggregate("at", F.lit(0).cast("long"), lambda n, x: n + F.when(x["level"] >= F.col("level"), x[c]).otherwise(0)).alias(c)
    per = per.select("cap", F.element_at(settings, F.col("level")).alias("threshold"), *by, "truth_count", total("tp"), total("predicted"))
    per = per.withColumn("gain", f_half(F.col("tp"), F.col("predicted"), F.col("truth_count")) - nothing)
    sums = per.groupBy("cap", "threshold", *by).agg(F.sum("gain").alias("gain"), F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"))
    groups = truth.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(nothing).alias("empty"), F.count_if(F.col("truth_count") > 0).alias("with_truth"))
    out = _grid(spark, cap=list(caps), threshold=list(map(float, thresholds))).join(F.broadcast(groups), F.lit(True))  # a row per group
    out = out.join(sums, ["cap", "threshold", *by], "left")
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("cap", "threshold", *by, "n", (F.col("empty") + F.coalesce("gain", F.lit(0.0))).alias("f"), whole("tp"), whole("predicted"), "with_truth")


def target_sweep(queries: DataFrame, scored: DataFrame, edges: DataFrame, caps=TARGET_CAPS, thresholds=TARGET_THRESHOLDS, score: str = "probability") -> DataFrame:
    """Macro F0.5 over queries when every target goes to its best query among its cap first, and the candidates' recall, for every cap and threshold."""
    cells = target_cells(queries, scored, edges, [], caps, thresholds, score).join(target_recall(scored, edges, caps).select("cap", "candidate_recall"), "cap")
    return cells.select(F.col("cap").alias("cap_per_target"), "threshold", F.round(F.col("f") / F.col("n"), 9).alias("macro_f0_5"), "candidate_recall")


def target_audit(references: DataFrame, scored: DataFrame, edges: DataFrame, audit_fold: int, caps=TARGET_CAPS, thresholds=TARGET_THRESHOLDS, score: str = "probability", countries=("US", "India", "France")) -> tuple[DataFrame, DataFrame]:
    """Calibrate on the queries outside of ``audit_fold`` (column fold of ``references``), audit on those in it.

    The first result is one row: the operating point, its macro F0.5 on both parts, what it predicts outside the audit fold, and
    its candidates. The second has the point's macro F0.5 outside the audit fold by country, other countries together.
    """
    country = F.when(F.col("country").isin(*countries), F.col("country")).otherwise("Other")
    refs = references.select("entity_id", (F.col("fold") == audit_fold).alias("audit"), country.alias("country"))
    cells = target_cells(refs, scored, edges, ["audit", "country"], caps, thresholds, score)
    part = lambda audit, name: F.round(F.sum(F.when(F.col("audit") == audit, F.col("f"))) / F.sum(F.when(F.col("audit") == audit, F.col("n"))), 9).alias(name)
    outside = ~F.col("audit")
    total = lambda c, when, name: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0)).cast("long").alias(name)
    grid = cells.groupBy(F.col("cap").alias("cap_per_target"), "threshold").agg(
        part(False, "macro_f0_5"), part(True, "audit_macro_f0_5"), total("n", ~outside, "audit_source1_entities"), total("with_truth", F.lit(True), "truth_entities"),
        total("tp", outside, "matched_pairs"), total("predicted", outside, "predicted_pairs"),
    )
    point = target_operating_point(grid)
    recall = target_recall(scored, edges, caps).withColumnRenamed("cap", "cap_per_target")
    at = F.broadcast(point.select(F.col("cap_per_target").alias("cap"), "threshold"))  # one row
    by_country = cells.filter(outside).join(at, ["cap", "threshold"]).select("country", F.round(F.col("f") / F.col("n"), 9).alias("macro_f0_5"))
    return point.join(recall, "cap_per_target"), by_country


def target_operating_point(swept: DataFrame, tolerance: float = 0.0002) -> DataFrame:
    """Near the best score: the smallest cap, then the best score, then the highest threshold. A handful of rows."""
    df = swept.withColumn("best", F.max("macro_f0_5").over(Window.partitionBy(F.lit(1)))).filter(F.col("macro_f0_5") >= F.col("best") - tolerance)
    order = Window.partitionBy(F.lit(1)).orderBy("cap_per_target", F.desc("macro_f0_5"), F.desc("threshold"))
    return df.withColumn("k", F.row_number().over(order)).filter("k = 1").drop("k", "best")
