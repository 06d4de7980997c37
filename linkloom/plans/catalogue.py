"""Registered queries of the linkage engine: each applies an operator to the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.functions.unicode_text import unicode_views as views_of
from linkloom.operators import contracts, decisions, evaluation, features, folds, fuzzy, model, ordinal, ranked, reports, retrieval, truth
from linkloom.operators.blocking import BASE, COMPOSITE, Blocking, with_blocking_keys
from linkloom.operators.keep import keep
from linkloom.sources import tables

from . import linkage
from .registry import packed_truth, registry, sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Folds of the registered cross-fit.
FOLDS = 5


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _sides(spark, sf, config: Blocking):
    return linkage.prepared(*sources(spark, sf), config)


def _candidates(spark, sf, config: Blocking):
    q, t = _sides(spark, sf, config)
    return q, t, retrieval.candidates(q, t, config)


def _features(spark, sf, composite: bool):
    q, t, pairs = _candidates(spark, sf, COMPOSITE if composite else BASE)
    return q, t, features.pair_features(pairs, q, t, composite)


def _edges(spark, sf) -> DataFrame:
    return truth.truth_edges(packed_truth(spark, sf))


def _scored(spark, sf):
    """Queries, composite pairs with labels and a score that any engine can compute, and the known links, which are kept."""
    edges = keep(_edges(spark, sf))
    q, t, pairs = _features(spark, sf, True)
    own = F.round((F.col("name_edit_similarity") + F.col("address_edit_similarity")) / 2, 6)
    return q, truth.labelled(pairs, edges).withColumn("probability", own), edges


def _rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


@query
def rule_linkage(spark, sf):
    """The flagship: one row per query with its matched targets."""
    return linkage.rule_linkage(*sources(spark, sf)).match_lists()


@query
def scan_prepare(spark, sf):
    df = registry(spark, sf)
    rows = linkage.prepare_records(df)
    return rows.select("entity_id", "country", "norm_name", "norm_address", F.size("name_tokens").alias("n_name_tokens"), F.size("address_tokens").alias("n_address_tokens"))


@query
def truth_edges(spark, sf):
    return _edges(spark, sf)


@query
def truth_group_sizes(spark, sf):
    return truth.group_sizes(packed_truth(spark, sf))


@query
def truth_violations(spark, sf):
    q = registry(spark, sf).filter("source = 'S1'")
    return truth.truth_violations(_edges(spark, sf), q.filter(F.col("entity_id").endswith("7") == F.lit(False)))


@query
def first_owners(spark, sf):
    return truth.first_owner(_edges(spark, sf))


@query
def trigrams_sampled(spark, sf):
    df = registry(spark, sf).select("entity_id", T.business_name(F.col("business_name")).alias("n"))
    return df.select("entity_id", F.explode(T.sampled_trigrams(F.col("n"), 4)).alias("gram"))


@query
def trigrams_full(spark, sf):
    df = registry(spark, sf).select("entity_id", T.business_name(F.col("business_name")).alias("n"))
    return df.select("entity_id", F.explode(T.trigrams(F.col("n"))).alias("gram"))


@query
def numbers_postal(spark, sf):
    df = registry(spark, sf).select("entity_id", T.numbers(T.business_address(F.col("business_address"))).alias("n"))
    return df.select("entity_id", F.array_join("n", ",").alias("numbers"), T.last_of_length(F.col("n"), 5, 6).alias("postal"))


def _keys(spark, sf, config):
    df = registry(spark, sf).select("entity_id", T.business_name(F.col("business_name")).alias("n"), T.business_address(F.col("business_address")).alias("a"))
    return retrieval.exploded(with_blocking_keys(df, "n", "a", config), "entity_id")


@query
def blocking_keys_base(spark, sf):
    return _keys(spark, sf, BASE)


@query
def blocking_keys_composite(spark, sf):
    return _keys(spark, sf, COMPOSITE)


def _posts(spark, sf, config=BASE):
    q, t = _sides(spark, sf, config)
    posts = retrieval.postings(t)
    return q, posts, retrieval.posting_stats(posts, config)


@query
def posting_stats(spark, sf):
    return _posts(spark, sf)[2]


@query
def posting_prune(spark, sf):
    return retrieval.eligible(_posts(spark, sf)[2])


@query
def query_key_budget(spark, sf):
    q, _, stats = _posts(spark, sf)
    return retrieval.query_keys(q, ["S2", "S3"], retrieval.eligible(stats), BASE)


@query
def blocking_hits(spark, sf):
    q, posts, stats = _posts(spark, sf)
    keys = retrieval.eligible(stats)
    return retrieval.block_hits(retrieval.query_keys(q, ["S2", "S3"], keys, BASE), posts, keys)


@query
def candidates_topk(spark, sf):
    return _candidates(spark, sf, BASE)[2]


@query
def candidates_topk_composite(spark, sf):
    return _candidates(spark, sf, COMPOSITE)[2]


@query
def pair_features_base(spark, sf):
    return _rounded(_features(spark, sf, False)[2])


@query
def pair_features_composite(spark, sf):
    return _rounded(_features(spark, sf, True)[2])


@query
def label_pairs(spark, sf):
    pairs = truth.labelled(_features(spark, sf, False)[2], _edges(spark, sf))
    return pairs.groupBy("label").agg(F.count(F.lit(1)).alias("pairs"))


@query
def hard_negatives(spark, sf):
    pairs = truth.labelled(_features(spark, sf, False)[2], _edges(spark, sf))
    return decisions.hard_negatives(pairs).select("source1_id", "target_id", "target_source", "negative_rank")


@query
def training_sample(spark, sf):
    pairs = truth.labelled(_features(spark, sf, False)[2], _edges(spark, sf))
    return decisions.training_sample(pairs).select("source1_id", "target_id", "target_source", "label")


@query
def rule_matches(spark, sf):
    return decisions.rule_matches(_features(spark, sf, True)[2]).select("source1_id", "target_id", "target_source", "candidate_rank", "rule_score")


@query
def exclusive_assignment(spark, sf):
    accepted = decisions.rule_matches(_features(spark, sf, True)[2])
    return decisions.exclusive(accepted, "rule_score").select("source1_id", "target_id", "rule_score")


@query
def source_thresholds(spark, sf):
    _, scored, _ = _scored(spark, sf)
    return decisions.over_thresholds(scored, {"S2": 0.5, "S3": 0.6}).select("source1_id", "target_id", "target_source", "probability")


@query
def packed_candidates(spark, sf):
    q, _, pairs = _candidates(spark, sf, COMPOSITE)
    return decisions.packed_lists(q, pairs, "retrieval_score", "candidate_entity_ids")


@query
def top_candidates(spark, sf):
    pairs = _candidates(spark, sf, BASE)[2].select("source1_id", "target_source", "target_id", F.col("retrieval_score").alias("rank"))
    return decisions.top_candidates(pairs.unionByName(pairs), 4)


@query
def sweep_cap_threshold(spark, sf):
    q, scored, edges = _scored(spark, sf)
    return _rounded(evaluation.sweep(q, scored, edges))


@query
def operating_point(spark, sf):
    q, scored, edges = _scored(spark, sf)
    return _rounded(evaluation.operating_point(evaluation.best_per_cap(evaluation.sweep(q, scored, edges)))).select("cap_per_source", "threshold", "macro_f0_5")


@query
def source_threshold_sweep(spark, sf):
    q, scored, edges = _scored(spark, sf)
    return evaluation.source_sweep(q, scored, edges, 8, {"S2": 0.5, "S3": 0.6}, "S2")


@query
def fixed_threshold_score(spark, sf):
    q, scored, edges = _scored(spark, sf)
    return _rounded(evaluation.fixed_score(q, scored, edges, 8, {"S2": 0.5, "S3": 0.6}))


@query
def confusion_counts(spark, sf):
    _, scored, _ = _scored(spark, sf)
    return reports.confusion(scored.withColumn("predicted", F.col("probability") >= 0.5))


def _counts(spark, sf):
    q, _, pairs = _candidates(spark, sf, BASE)
    return reports.candidate_counts(q, pairs)


@query
def candidate_distribution(spark, sf):
    return reports.distribution(_counts(spark, sf))


@query
def candidate_distribution_linear(spark, sf):
    return reports.distribution_linear(_counts(spark, sf))


@query
def reduction_ratio(spark, sf):
    return reports.reduction(*_candidates(spark, sf, BASE))


@query
def per_country_counts(spark, sf):
    return reports.per_country(_counts(spark, sf))


@query
def anti_containment(spark, sf):
    """Known links that are not among the candidates of S2: those whose target is of S3, and what retrieval missed."""
    return contracts.outside_candidates(_edges(spark, sf), _candidates(spark, sf, BASE)[2].filter("target_source = 'S2'"))


@query
def duplicate_rows(spark, sf):
    """Contents that several records share."""
    return contracts.repeated(registry(spark, sf), "content")


@query
def target_existence(spark, sf):
    """Links whose target is no record of S2."""
    return contracts.missing_targets(_edges(spark, sf), registry(spark, sf).filter("source = 'S2'"))


@query
def list_violations(spark, sf):
    """A table of lists against fewer queries and a lower cap than it was made for."""
    q, _, pairs = _candidates(spark, sf, BASE)
    lists = decisions.packed_lists(q, pairs, "retrieval_score", "candidate_entity_ids")
    return contracts.list_violations(lists, q.filter(~F.col("entity_id").endswith("7")), 8)


def _ranked(spark, sf, views):
    s1, s2, s3 = sources(spark, sf)
    return ranked.search_records(ranked.record_fields(s2.unionByName(s3)), ranked.record_fields(s1), views)


_WORD_VIEWS = {"name": {"nw": 1.0, "ncw": 1.2}, "address": {"aw": 1.0, "acw": 1.2}}


@query
def bm25_word_topk(spark, sf):
    return _ranked(spark, sf, _WORD_VIEWS)


@query
def bm25_views_topk(spark, sf):
    return _ranked(spark, sf, ranked.VIEWS)


@query
def rrf_fuse(spark, sf):
    return ranked.fuse(_ranked(spark, sf, _WORD_VIEWS), views=["name", "address"])


@query
def recall_at_k(spark, sf):
    edges = truth.first_owner(_edges(spark, sf))
    found = _ranked(spark, sf, ranked.VIEWS)
    return ranked.recall_at(found, edges)


@query
def target_argmax_match(spark, sf):
    fused = ranked.fuse(_ranked(spark, sf, _WORD_VIEWS), views=["name", "address"])
    return decisions.best_per_target(fused, 0.03, "rrf").select("target_id", "rid", "rrf")


def _target_scored(spark, sf):
    """References, fused pairs with labels and a score that any engine can compute, and known links, all but references kept."""
    fused = ranked.fuse(_ranked(spark, sf, _WORD_VIEWS), views=["name", "address"])
    edges, s1 = keep(truth.first_owner(_edges(spark, sf))), sources(spark, sf)[0]
    return s1, keep(truth.labelled(fused.select("target_id", F.col("rid").alias("source1_id"), "candidate_rank", F.round(F.col("rrf") * 30, 6).alias("probability")), edges)), edges


@query
def target_sweep(spark, sf):
    return evaluation.target_sweep(*_target_scored(spark, sf))


def _target_audit(spark, sf):
    s1, scored, edges = _target_scored(spark, sf)
    s1 = s1.withColumn("fold", folds.md5_bucket(F.col("entity_id"), FOLDS))
    return evaluation.target_audit(s1, scored, edges, FOLDS - 1, countries=("en", "de", "fr"))


@query
def target_calibration(spark, sf):
    """The operating point calibrated on all folds but the last, audited on that."""
    return _target_audit(spark, sf)[0]


@query
def target_country_scores(spark, sf):
    return _target_audit(spark, sf)[1]


@query
def retrieval_audit(spark, sf):
    """Recall by country on the known links of a fifth of the queries."""
    s1, s2, s3 = sources(spark, sf)
    return ranked.audit(s2.unionByName(s3), s1, truth.first_owner(_edges(spark, sf)), folds.md5_bucket, 5)["by_country"]


def _by_id(df: DataFrame, key: str = "entity_id") -> DataFrame:
    return df.orderBy(key)


@query
def match_accounting(spark, sf):
    """The accounts of the known links as matches, against fewer queries and the targets of one source."""
    _, s2, _ = sources(spark, sf)
    lists = ordinal.with_ordinal(_by_id(packed_truth(spark, sf), "source1_entity_id"))
    known = ordinal.with_ordinal(_by_id(sources(spark, sf)[0].filter(~F.col("entity_id").endswith("7"))))
    return contracts.match_accounting(lists, known, s2.withColumn("target_source", F.lit("S2")))


def _sequence(spark, sf) -> DataFrame:
    return ordinal.with_sequence([_by_id(df.select("entity_id")) for df in sources(spark, sf)[1:]])


@query
def target_sequence(spark, sf):
    """Targets numbered without gaps, S2 before S3."""
    return _sequence(spark, sf)


@query
def sequence_coverage(spark, sf):
    """Whether the numbers of targets, dealt to shards and put together again, cover every place once."""
    return ordinal.coverage(_sequence(spark, sf).withColumn("shard", folds.md5_bucket(F.col("entity_id"), 6)))


@query
def wide_set_features(spark, sf):
    """Those of the wide features that are no ratios of letters."""
    df = wide_features(spark, sf)
    return _rounded(df.drop(*fuzzy.RATIO_FEATURES))


@query
def fold_assignment_md5(spark, sf):
    targets = registry(spark, sf).filter("source <> 'S1'")
    return folds.target_folds(targets, truth.first_owner(_edges(spark, sf)), folds.md5_bucket)


@query
def fold_assignment_blake2b(spark, sf):
    targets = registry(spark, sf).filter("source <> 'S1'")
    return folds.target_folds(targets, truth.first_owner(_edges(spark, sf)), folds.blake_fold)


@query
def split_crc32(spark, sf):
    at = folds.crc_bucket(F.col("entity_id"), 100)
    return registry(spark, sf).select("entity_id", at.alias("bucket"), folds.split(at, folds.COMPOSITE_SPLITS).alias("split"))


@query
def split_xxhash(spark, sf):
    at = folds.bucket(F.col("entity_id"), 100)
    return registry(spark, sf).select("entity_id", at.alias("bucket"), folds.split(at, folds.BASE_SPLITS).alias("split"))


@query
def unicode_views(spark, sf):
    return registry(spark, sf).select("entity_id", views_of("business_name", "business_address").alias("v")).select("entity_id", "v.*")


@query
def fuzzy_ratios(spark, sf):
    q, t, pairs = _candidates(spark, sf, BASE)
    both = features.with_records(pairs, q, t)
    return both.select("source1_id", "target_id", fuzzy.fuzzy_ratios("q_norm_name", "t_norm_name").alias("f")).select("source1_id", "target_id", "f.*")


@query
def wide_features(spark, sf):
    s1, s2, s3 = sources(spark, sf)
    fused, _ = linkage.ranked_linkage(s1, s2, s3, 0.0)
    return linkage.wide_pairs(fused, s1, s2, s3)


@query
def gbt_fit_score(spark, sf):
    pairs = keep(truth.labelled(_features(spark, sf, False)[2], _edges(spark, sf)))
    fitted = model.fit(decisions.training_sample(pairs), features.BASE_FEATURES)
    return model.score(fitted, pairs, features.BASE_FEATURES).select("source1_id", "target_id", "label", "probability")


@query
def crossfit_oof(spark, sf):
    pairs = truth.labelled(_features(spark, sf, False)[2], _edges(spark, sf))
    pairs = pairs.withColumn("rid_fold", folds.md5_bucket(F.col("source1_id"), FOLDS))
    # A matched target has its owner's fold.
    pairs = keep(pairs.withColumn("fold", F.when(F.col("label") == 1, F.col("rid_fold")).otherwise(folds.md5_bucket(F.col("target_id"), FOLDS))))
    return model.cross_fit(pairs, features.BASE_FEATURES, FOLDS).oof.select("source1_id", "target_id", "label", "probability")


def _place(spark, name: str) -> str:
    """A new path in the folder that driver and executors share, or the warehouse."""
    top = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query
def parquet_roundtrip(spark, sf):
    path = _place(spark, "features")
    tables.write_features(linkage.prepare_records(registry(spark, sf)).select("entity_id", "norm_name", "norm_address"), path)
    return tables.merge_shards(spark, [path])


@query
def sharded_roundtrip(spark, sf):
    """Records in four shards with manifests, put together again."""
    path, rows = _place(spark, "shards"), registry(spark, sf).select("entity_id", "content")
    for k in range(4):
        tables.write_shard(rows.filter(folds.md5_bucket(F.col("entity_id"), 4) == k), path, k, 4)
    return tables.finalize_shards(spark, path, 4, rows.count())[0]


@query
def tsv_roundtrip(spark, sf):
    path = _place(spark, "truth")
    tables.write_tsv(packed_truth(spark, sf), path, 4)
    return tables.read_parts(spark, path, tables.TRUTH.names)
