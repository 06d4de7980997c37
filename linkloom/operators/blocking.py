"""Blocking keys: which values of a record may bring it together with others, by kind.

A configuration says which kinds there are, in how many records of a source a value may occur, how many values of a kind a
query may use and what a shared value weighs. Both configurations run through the same operators.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as T

EXACT, TOKEN, GRAM, PAIR = "exact", "token", "gram", "pair"


@dataclass(frozen=True)
class Kind:
    """limit: records of a source that may share a value; budget: values a query may use; weight: of a shared value."""

    name: str
    limit: int
    budget: int
    weight: float


@dataclass(frozen=True)
class Blocking:
    kinds: tuple[Kind, ...]
    composite: bool
    cap: int = 32

    def of(self, attribute: str, kind: Column) -> Column:
        """An attribute of a kind, as an expression; the roman form of a kind has the same."""
        groups: dict[float, list[str]] = {}
        for k in self.kinds:
            groups.setdefault(getattr(k, attribute), []).extend([k.name, f"roman_{k.name}"])
        out = F
        for value, names in groups.items():
            out = out.when(kind.isin(*names), F.lit(value))
        return out


_BOTH = (("exact_name", 64, 1, 8.0), ("exact_address", 64, 1, 8.0), ("postal_house", 32, 1, 5.0))
#: Kinds, limits, budgets and weights (fixed values).
BASE = Blocking(
    tuple(Kind(*k) for k in (*_BOTH, ("name_token", 12, 2, 1.0), ("address_token", 12, 2, 1.0), ("name_gram", 16, 3, 0.45), ("address_gram", 16, 3, 0.45))),
    composite=False,
)
COMPOSITE = Blocking(
    tuple(
        Kind(*k)
        for k in (
            *_BOTH, ("name_token", 32, 2, 1.0), ("address_token", 32, 2, 1.0), ("name_gram", 16, 2, 0.45), ("address_gram", 16, 2, 0.45),
            ("compact_name", 220, 1, 4.0), ("name_anchor", 48, 1, 1.7), ("name_pair", 220, 2, 4.0), ("name_house", 220, 1, 4.0),
            ("name_place", 180, 1, 3.0), ("address_pair", 160, 2, 3.0), ("house_address", 120, 1, 3.0),
        )
    ),
    composite=True,
)
NAME_COMPOSITES = ("compact_name", "name_anchor", "name_pair", "name_house", "name_place")
ADDRESS_COMPOSITES = ("address_pair", "house_address")


def _keys(kind: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def _one(value: Column) -> Column:
    """The value alone, or nothing where it is empty."""
    return F.when(value != "", F.array(value)).otherwise(F.array().cast("array<string>"))


def _joined(a: Column, b: Column) -> Column:
    return F.when((a != "") & (b != ""), F.concat(a, F.lit("|"), b)).otherwise(F.lit(""))


def with_blocking_keys(df: DataFrame, name: str, address: str, config: Blocking, out: str = "block_keys", prefix: str = "", other_address: str | None = None) -> DataFrame:
    """Adds a record's distinct (kind, value) pairs, from the columns of its normal forms.

    ``prefix`` names the keys of another view; the house and the place of its name come from ``other_address``. Words are
    kept in columns on the way, so each is found once.
    """
    columns = df.columns
    df = df.withColumns({"_a": T.tokens(F.col(address)), "_n": T.tokens(F.col(name))})
    df = df.withColumns({"_top": T.longest(T.name_words(F.col("_n"))), "_whole": F.filter("_a", T.is_number), "_salient": T.salient_words(F.col("_a"))})
    df = df.withColumns({"_house": T.first(F.col("_whole")), "_postal": T.last_of_length(F.col("_whole"), 5, 6), "_places": T.longest(F.col("_salient"))})
    goes = F.col("_a")
    if other_address:
        df = df.withColumn("_other", T.tokens(F.col(other_address)))
        goes = F.col("_other")
    df = df.withColumns({"_name_house": T.first(F.filter(goes, T.is_number)), "_tail": F.coalesce(F.try_element_at(T.salient_words(goes), F.lit(-1)), F.lit(""))})
    top, places = F.col("_top"), F.col("_places")
    parts = {
        "exact_name": _one(F.col(name)), "name_token": top, "name_gram": T.sampled_trigrams(F.col(name), 4),
        "exact_address": _one(F.col(address)), "address_token": T.longest(T.address_words(F.col("_a"))), "address_gram": T.sampled_trigrams(F.col(address), 3),
        "postal_house": _one(_joined(F.col("_postal"), F.col("_house"))),
    }
    if config.composite:
        compact = F.regexp_replace(name, " ", "")
        parts |= {
            "compact_name": F.when(F.length(compact) >= 5, F.array(compact)).otherwise(F.array().cast("array<string>")), "name_anchor": _one(T.first(top)), "name_pair": T.pairs(top),
            "name_house": _one(_joined(T.first(top), F.col("_name_house"))), "name_place": _one(_joined(T.first(top), F.col("_tail"))),
            "address_pair": T.pairs(places), "house_address": _one(_joined(F.col("_house"), T.first(places))),
        }
    return df.withColumn(out, F.array_distinct(F.concat(*[_keys(f"{prefix}{k}", v) for k, v in parts.items()]))).select(*columns, out)


def with_both_views(df: DataFrame, config: Blocking) -> DataFrame:
    """Adds block_keys of the native view, and of the romanised one where it differs."""
    columns = df.columns
    new_name = (F.col("roman_name") != "") & (F.col("roman_name") != F.col("norm_name"))
    new_address = (F.col("roman_address") != "") & (F.col("roman_address") != F.col("norm_address"))
    df = with_blocking_keys(df, "norm_name", "norm_address", config, "_native")
    # Where only the name differs, its composites go with the native address.
    df = df.withColumn("_with", F.when(new_address, F.col("roman_address")).otherwise(F.col("norm_address")))
    df = with_blocking_keys(df, "roman_name", "roman_address", config, "_roman", "roman_", "_with")
    of_name = [f"roman_{k}" for k in ("exact_name", "name_token", "name_gram", *NAME_COMPOSITES)]
    more = F.filter("_roman", lambda k: F.when(k["kind"].isin(*of_name), new_name).otherwise(new_address))
    return df.withColumn("block_keys", F.concat("_native", more)).select(*columns, "block_keys")
