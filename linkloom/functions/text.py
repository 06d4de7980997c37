"""Text functions on columns, without Python on the rows: normal forms, tokens, trigrams, numbers.

They work on ASCII after Latin accents are taken off; :mod:`linkloom.functions.unicode_text` has the forms for all scripts.
"""

from __future__ import annotations

import unicodedata
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import ADDRESS_SHORT, LEGAL_SUFFIXES, STOPWORDS


def _accents() -> tuple[str, str]:
    """Letters up to U+024F and U+1EFF whose compatibility decomposition has exactly one ASCII character, and those."""
    pairs = []
    for point in (*range(0x80, 0x250), *range(0x1E00, 0x1F00)):
        plain = unicodedata.normalize("NFKD", chr(point)).encode("ascii", "ignore").decode()
        if len(plain) == 1 and plain.isalnum():
            pairs.append((chr(point), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()


def ascii_text(text: Column) -> Column:
    """Accents off, other characters beyond ASCII gone, lower case, runs of anything but letters and digits one space."""
    folded = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), ACCENTED, PLAIN), "[^\\x00-\\x7F]", "")
    return F.trim(F.regexp_replace(F.lower(folded), "[^a-z0-9]+", " "))


def tokens(text: Column) -> Column:
    """Words between spaces; none for the empty text."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def without_suffixes(text: Column, suffixes: list[str] = LEGAL_SUFFIXES) -> Column:
    """A normal form without its trailing legal words; nothing may remain."""
    return F.regexp_replace(text, f"(?:(?:^| )(?:{'|'.join(suffixes)}))+$", "")


def shortened(text: Column, table: dict[str, str] = ADDRESS_SHORT) -> Column:
    """A normal form with the table's words for its own."""
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.array_join(F.transform(tokens(text), lambda t: F.coalesce(F.try_element_at(lookup, t), t)), " ")


def business_name(text: Column) -> Column:
    return without_suffixes(ascii_text(text))


def business_address(text: Column) -> Column:
    return shortened(ascii_text(text))


def longest(words: Column, n: int = 4) -> Column:
    """The n longest distinct words, equal lengths by alphabet."""
    ranked = F.array_sort(F.transform(F.array_distinct(words), lambda t: F.struct((-F.length(t)).alias("l"), t.alias("t"))))
    return F.transform(F.slice(ranked, 1, n), lambda s: s["t"])


def is_number(t: Column) -> Column:
    return t.rlike("^[0-9]+$")


def name_words(words: Column) -> Column:
    """Words that may tell a name."""
    return F.filter(words, lambda t: ~t.isin(*STOPWORDS, *LEGAL_SUFFIXES))


def address_words(words: Column) -> Column:
    """Words of an address other than numbers."""
    return F.filter(words, lambda t: ~t.isin(*STOPWORDS) & ~is_number(t))


def salient_words(words: Column) -> Column:
    """Words that may tell a place: no number, and neither side of the table of short forms."""
    return F.filter(words, lambda t: ~t.isin(*STOPWORDS, *ADDRESS_SHORT, *ADDRESS_SHORT.values()) & ~is_number(t))


def pairs(words: Column, n: int = 4) -> Column:
    """All pairs of the first n words, each by alphabet, joined by a bar."""
    of = [F.when(F.size(words) >= j + 1, F.array_join(F.array_sort(F.array(F.get(words, F.lit(i)), F.get(words, F.lit(j)))), "|")) for i, j in combinations(range(n), 2)]
    return F.array_compact(F.array(*of))


def sampled_trigrams(text: Column, limit: int) -> Column:
    """At most ``limit`` distinct trigrams at even distances over the text without spaces; a shorter text as a whole.

    Positions round half to even.
    """
    compact = F.regexp_replace(text, " ", "")
    n = F.length(compact) - 2
    every = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(compact, i + 1, 3))
    at = F.sequence(F.lit(0), F.lit(limit - 1))
    some = F.transform(at, lambda i: F.substring(compact, F.rint(i * (n - 1) / F.lit(max(1, limit - 1))).cast("int") + 1, 3))
    few = F.when(compact == "", F.array().cast("array<string>")).otherwise(F.array(compact))
    return F.array_distinct(F.when(n < 1, few).when(n <= limit, every).otherwise(some))


def trigrams(text: Column) -> Column:
    """All distinct trigrams of the text between underscores, spaces underscores too."""
    padded = F.concat(F.lit("_"), F.regexp_replace(text, " ", "_"), F.lit("_"))
    n = F.length(padded) - 2
    return F.when(n < 1, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(padded, i, 3))))


def numbers(text: Column) -> Column:
    """Distinct runs of digits, in order; digits of all scripts."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?U)(\\d+)"), F.lit(1)))


def last_of_length(words: Column, *lengths: int) -> Column:
    """The last word of one of the lengths, or the empty text."""
    return F.coalesce(F.try_element_at(F.filter(words, lambda t: F.length(t).isin(*lengths)), F.lit(-1)), F.lit(""))


def first(words: Column) -> Column:
    return F.coalesce(F.get(words, F.lit(0)), F.lit(""))
