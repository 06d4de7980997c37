"""Whole linkage runs, composed of operators: fixed rules, boosted trees, ranked retrieval."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators import contracts, decisions, evaluation, features, folds, fuzzy, model, ranked, retrieval, truth
from linkloom.operators.blocking import BASE, COMPOSITE, Blocking
from linkloom.operators.keep import keep
from linkloom.operators.records import prepare_records


def prepared(s1: DataFrame, s2: DataFrame, s3: DataFrame, config: Blocking, all_scripts: bool = False) -> tuple[DataFrame, DataFrame]:
    """Queries and targets, prepared in one pass and kept, on disk where memory is short: a run reads them four times."""
    columns = ["entity_id", "business_name", "business_address", "country"]
    every = [df.select(*columns, F.lit(name).cast("string").alias("target_source")) for df, name in ((s1, None), (s2, "S2"), (s3, "S3"))]
    df = keep(prepare_records(every[0].unionByName(every[1]).unionByName(every[2]), config, None, all_scripts, keep=("target_source",)))
    return df.filter("target_source is null").drop("target_source"), df.filter("target_source is not null")


@dataclass
class Linked:
    """What a run returns. ``matches`` has a pair per row, the lists a row per query.

    Pairs and matches are kept, for several results come from them: ``keep.release()`` lets them go, or the end of ``keep.holding()``.
    """

    candidates: DataFrame
    matches: DataFrame
    score: str
    queries: DataFrame
    metrics: dict = field(default_factory=dict)

    def candidate_lists(self) -> DataFrame:
        return decisions.packed_lists(self.queries, self.candidates, "retrieval_score", "candidate_entity_ids")

    def match_lists(self) -> DataFrame:
        return decisions.packed_lists(self.queries, self.matches, self.score, "matched_entity_ids")

    def check(self, exclusive: bool = True) -> Linked:
        """Matches are candidates, and a target has one owner where that is asked for."""
        contracts.assert_no_rows(contracts.outside_candidates(self.matches, self.candidates), "a match is no candidate")
        contracts.assert_no_rows(contracts.repeated(self.matches, "source1_id", "target_id"), "a match occurs twice")
        if exclusive:
            contracts.assert_no_rows(contracts.exclusive_targets(self.matches), "a target has several owners")
        return self


def rule_linkage(s1: DataFrame, s2: DataFrame, s3: DataFrame, all_scripts: bool = False) -> Linked:
    """Composite blocks, then fixed rules, then one owner per target. Nothing is learned."""
    q, t = prepared(s1, s2, s3, COMPOSITE, all_scripts)
    pairs = keep(retrieval.candidates(q, t, COMPOSITE))
    # Rules over features that are still expressions would give the optimizer every combination of both as a constraint.
    found = keep(features.pair_features(pairs, q, t, composite=True))
    accepted = decisions.rule_matches(found).select(*features.PAIR, "rule_score")
    return Linked(pairs, keep(decisions.exclusive(accepted, "rule_score")), "rule_score", q)


def boosted_linkage(train: tuple[DataFrame, DataFrame, DataFrame], edges: DataFrame, test: tuple[DataFrame, DataFrame, DataFrame], composite: bool = False, smoke: bool = False, all_scripts: bool = False, **trees) -> Linked:
    """Fit a pair model on a split of the training queries, calibrate on another, decide on the test sources.

    The base configuration takes one threshold and the cap of the operating point; the composite one calibrates a threshold
    per source at the full cap, reports an untouched audit split, and gives every target one owner.
    """
    config = COMPOSITE if composite else BASE
    names = features.COMPOSITE_FEATURES if composite else features.BASE_FEATURES
    n, ranges = folds.split_ranges(composite, smoke)
    q, t = prepared(*train, config, all_scripts)
    q = q.withColumn("split", folds.split(folds.bucket(F.col("entity_id"), n), ranges)).filter("split is not null")
    pairs = features.pair_features(retrieval.candidates(q, t, config), q, t, composite)
    known = keep(truth.labelled(pairs, edges).join(q.select(F.col("entity_id").alias("source1_id"), "split"), "source1_id"))
    fitted = model.fit(decisions.training_sample(known.filter("split = 'fit'")), names, **trees)
    held = "calibration" if composite else "validation"

    def part(split: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        own = q.filter(F.col("split") == split)
        return own, keep(model.score(fitted, known.filter(F.col("split") == split), names)), edges.join(own.select(F.col("entity_id").alias("source1_id")), "source1_id", "left_semi")

    own, scored, links = part(held)
    point = evaluation.operating_point(evaluation.best_per_cap(evaluation.sweep(own, scored, links))).first().asDict()
    metrics = {"operating_point": point}
    cap, limits = int(point["cap_per_source"]), float(point["threshold"])
    if composite:
        cap = config.cap
        limits, metrics["calibrated_macro_f0_5"] = evaluation.calibrated(own, scored, links, cap, limits)
        metrics["audit"] = evaluation.fixed_score(*part("audit"), cap, limits).first().asDict()
    metrics["thresholds"] = limits
    tq, tt = prepared(*test, config, all_scripts)
    found = keep(retrieval.candidates(tq, tt, config))
    scored = keep(model.score(fitted, features.pair_features(found, tq, tt, composite), names).filter(F.col("candidate_rank") <= cap))
    matches = decisions.over_thresholds(scored, limits)
    if composite:
        matches = decisions.exclusive(matches, "probability")
    return Linked(found if composite else found.filter(F.col("candidate_rank") <= cap), matches, "probability", tq, metrics)


def ranked_linkage(s1: DataFrame, s2: DataFrame, s3: DataFrame, threshold: float, all_scripts: bool = False) -> tuple[DataFrame, DataFrame]:
    """Ranked retrieval of S1 for every target, fused, and the best fused reference per target at or over a score.

    Returns fused candidates and matches (target_id, rid, rrf). A pair model over :func:`wide_pairs` can replace the score.
    """
    refs = ranked.record_fields(s1, all_scripts)
    targets = ranked.record_fields(s2.unionByName(s3), all_scripts)
    fused = ranked.fuse(ranked.search_records(targets, refs))
    return fused, decisions.best_per_target(fused, threshold, "rrf")


def wide_pairs(fused: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """The 58 features of fused pairs."""
    from linkloom.functions.unicode_text import ranked_views

    view = lambda df: df.withColumn("v", ranked_views(F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))))
    targets = view(s2.withColumn("target_source", F.lit("S2")).unionByName(s3.withColumn("target_source", F.lit("S3"))))
    return fuzzy.wide_features(fused, targets.select("entity_id", "country", "target_source", "v.*"), view(s1).select("entity_id", "country", "v.*"))
