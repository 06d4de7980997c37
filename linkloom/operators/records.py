"""Records ready for linkage: trimmed ids, normal forms, tokens, numbers and blocking keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.functions.unicode_text import unicode_views

from .blocking import BASE, Blocking, with_blocking_keys, with_both_views


def _trimmed(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))


def prepare_records(records: DataFrame, config: Blocking = BASE, source: str | None = None, all_scripts: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record with an id.

    The columns entity_id, business_name, business_address and country are read, others ignored; nulls count as empty.
    ``keep`` names further columns that stay. ``all_scripts`` keeps other scripts than Latin and adds romanised views, by an Arrow UDF; else all is done on columns.
    """
    df = records.select(
        _trimmed("entity_id").alias("entity_id"), _trimmed("country").alias("country"),
        F.coalesce(F.col("business_name"), F.lit("")).alias("business_name"), F.coalesce(F.col("business_address"), F.lit("")).alias("business_address"), *keep,
    ).filter("entity_id <> ''")
    if all_scripts:
        df = df.withColumn("v", unicode_views("business_name", "business_address"))
        df = df.withColumns({"norm_name": F.col("v.name"), "norm_address": F.col("v.address"), "roman_name": F.col("v.roman_name"), "roman_address": F.col("v.roman_address")}).drop("v")
        df = with_both_views(df, config)
    else:
        df = df.withColumns({"norm_name": T.business_name(F.col("business_name")), "norm_address": T.business_address(F.col("business_address"))})
        df = with_blocking_keys(df, "norm_name", "norm_address", config)
        df = df.withColumns({"roman_name": F.col("norm_name"), "roman_address": F.col("norm_address")})
    df = df.withColumns({
        "name_tokens": T.tokens(F.col("norm_name")), "address_tokens": T.tokens(F.col("norm_address")),
        "roman_name_tokens": T.tokens(F.col("roman_name")), "roman_address_tokens": T.tokens(F.col("roman_address")),
        "numbers": T.numbers(F.col("norm_address")),
    })
    df = df.withColumn("postal", T.last_of_length(F.col("numbers"), 5, 6))
    return df if source is None else df.withColumn("target_source", F.lit(source))
