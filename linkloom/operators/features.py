"""Features of candidate pairs: similarities of names and addresses, and what retrieval found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_FEATURES = """name_edit_similarity name_token_jaccard name_token_containment address_edit_similarity address_token_jaccard
address_token_containment number_jaccard postal_equal exact_name exact_address postal_house_hit name_token_hits address_token_hits
name_gram_hits address_gram_hits rarity_score retrieval_score target_is_s2 query_address_missing target_address_missing
name_length_ratio address_length_ratio""".split()
COMPOSITE_FEATURES = [
    *BASE_FEATURES,
    *"""house_number_equal candidate_rank_reciprocal roman_name_edit_similarity roman_name_token_jaccard roman_address_edit_similarity
    roman_address_token_jaccard roman_exact_name roman_exact_address composite_key_hits name_composite_hits address_composite_hits""".split(),
]
PAIR = ["source1_id", "target_id", "target_source", "candidate_rank"]
_CARRIED = ["norm_name", "norm_address", "roman_name", "roman_address", "name_tokens", "address_tokens", "roman_name_tokens", "roman_address_tokens", "numbers", "postal"]


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 0 if both are empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(0.0)).otherwise(1.0 - F.levenshtein(a, b) / longer)


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


def containment(a: Column, b: Column) -> Column:
    """Common words over the shorter list, whose repeated words count."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1))


def equal(a: Column, b: Column) -> Column:
    """1 if both are the same text and not empty."""
    return ((a != "") & (a == b)).cast("double")


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def with_records(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Candidate pairs with the normal forms of both records as q_... and t_... columns."""
    q = queries.select(F.col("entity_id").alias("source1_id"), "country", *[F.col(c).alias(f"q_{c}") for c in _CARRIED])
    t = targets.select(F.col("entity_id").alias("target_id"), "country", "target_source", *[F.col(c).alias(f"t_{c}") for c in _CARRIED])
    return pairs.join(q, ["source1_id", "country"]).join(t, ["country", "target_source", "target_id"])


def pair_features(pairs: DataFrame, queries: DataFrame, targets: DataFrame, composite: bool = False) -> DataFrame:
    """One row per candidate pair: its ids, source, rank and features, all doubles."""
    df = with_records(pairs, queries, targets)

    def both(c: str) -> tuple[Column, Column]:
        return F.col(f"q_{c}"), F.col(f"t_{c}")

    again: dict[str, Column] = {}
    made = {"target_is_s2": F.col("target_source") == "S2", "query_address_missing": F.col("q_norm_address") == "", "target_address_missing": F.col("t_norm_address") == ""}
    made |= {"number_jaccard": jaccard(*both("numbers")), "postal_equal": equal(*both("postal"))}
    for part in ("name", "address"):
        norm, words = both(f"norm_{part}"), both(f"{part}_tokens")
        made |= {
            f"{part}_edit_similarity": edit_similarity(*norm), f"exact_{part}": equal(*norm), f"{part}_length_ratio": length_ratio(*norm),
            f"{part}_token_jaccard": jaccard(*words), f"{part}_token_containment": containment(*words),
        }
        if composite:
            # Where both records' romanised forms are their normal forms, which most are, nothing is measured twice.
            roman, words = both(f"roman_{part}"), both(f"roman_{part}_tokens")
            as_is = (roman[0] == norm[0]) & (roman[1] == norm[1])
            again |= {
                f"roman_{part}_edit_similarity": F.when(as_is, F.col(f"{part}_edit_similarity")).otherwise(edit_similarity(*roman)),
                f"roman_{part}_token_jaccard": F.when(as_is, F.col(f"{part}_token_jaccard")).otherwise(jaccard(*words)), f"roman_exact_{part}": equal(*roman),
            }
    if composite:
        house = [F.coalesce(F.get(n, F.lit(0)), F.lit("")) for n in both("numbers")]
        made |= {"house_number_equal": equal(*house), "candidate_rank_reciprocal": 1.0 / F.greatest(F.col("candidate_rank").cast("double"), F.lit(1.0))}
    names = COMPOSITE_FEATURES if composite else BASE_FEATURES
    df = df.withColumns({c: e.cast("double") for c, e in made.items()}).withColumns({c: e.cast("double") for c, e in again.items()})
    return df.select(*PAIR, *[F.col(c).cast("double").alias(c) for c in names])
