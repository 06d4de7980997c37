"""Fuzzy similarities of texts, and the wide feature set of ranked retrieval. Ratios come from an Arrow UDF."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.functions.vocabulary import POSTAL_LENGTHS

#: Names and order of the features (fixed values).
FEATURES = """name_ratio name_token_sort name_token_set name_partial name_core_ratio name_core_token_set name_translit_ratio
name_translit_token_set name_translit_gram_jaccard name_gram_jaccard name_gram_containment name_token_jaccard name_token_containment
name_common_tokens name_prefix_equal name_length_ratio name_exact core_name_exact address_ratio address_token_sort address_token_set
address_translit_ratio address_translit_gram_jaccard address_gram_jaccard address_gram_containment address_token_jaccard
address_token_containment address_common_tokens address_exact number_jaccard number_containment number_common number_conflict
postal_equal postal_conflict name_missing address_missing target_name_length reference_name_length target_address_length
reference_address_length name_ratio_joint name_ratio_address name_ratio_rank address_ratio_rank joint_rank name_rank address_rank
joint_score name_score address_score best_rank rank_gap rrf_score target_is_s2 country_us country_india country_france""".split()

#: Those that come from ratios of letters.
RATIO_FEATURES = [f for f in FEATURES if "ratio" in f and f != "name_length_ratio" or f.endswith(("_token_sort", "_token_set")) or f == "name_partial"]


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit per character of ``a``."""
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & where.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths; 0 if either is empty."""
    return 2 * common_subsequence(a, b) / (len(a) + len(b)) if a and b else 0.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best ratio among the shared words and those words with either side's own."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (x <= y or y <= x):
        return 1.0
    p, q = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    shared = len(" ".join(sorted(both)))
    lead = shared + (shared > 0)
    best = 1 - (len(p) + len(q) - 2 * common_subsequence(p, q)) / (2 * lead + len(p) + len(q))
    if shared:
        best = max(best, *(1 - (1 + len(z)) / (shared + lead + len(z)) for z in (p, q)))
    return best


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter text with a part of the longer one that is as long, or shorter at its ends."""
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    best = _best_part(a, b)
    return max(best, _best_part(b, a)) if len(a) == len(b) else best


def _best_part(a: str, b: str) -> float:
    """Best ratio of ``a`` with a part of ``b``. Only parts that share enough letters to beat the best so far are compared."""
    n, need = len(a), Counter(a)
    have: Counter[str] = Counter()
    common, bounds = 0, {}
    for k in range(1 - n, len(b)):  # slide over b; count the letters that a and the part have in common
        if k + n - 1 < len(b):
            c = b[k + n - 1]
            have[c] += 1
            common += have[c] <= need[c]
        if k > 0:
            c = b[k - 1]
            common -= have[c] <= need[c]
            have[c] -= 1
        part = b[max(0, k) : k + n]
        bounds[part] = 2 * common / (n + len(part))
    best = 0.0
    for part, bound in sorted(bounds.items(), key=lambda x: -x[1]):
        if bound <= best:
            break
        best = max(best, ratio(a, part))
    return best


_RATIOS = {"ratio": ratio, "token_sort": token_sort, "token_set": token_set, "partial": partial}
#: Letters that are compared at once, about: pairs of similar lengths go side by side.
_CELLS = 1 << 16


def _gains(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each place j of ``b``: a part of ``b`` that ends after j shares one letter more with ``a`` than without j if it starts at or after this.

    A column is a pair, a row a place. The recurrence over all places of both goes along diagonals, whose cells don't depend on each other.
    """
    (m, pairs), n = a.shape, len(b)
    kind = np.uint8 if n < 255 else np.uint16 if n < 65535 else np.uint32
    turned, none = np.ascontiguousarray(b[::-1]), np.iinfo(kind).max
    starts, rows = np.repeat(np.arange(n, 0, -1, dtype=kind)[:, None], pairs, axis=1), np.zeros((m, pairs), kind)
    unlike, x, y = np.empty((min(m, n), pairs), bool), *np.empty((2, min(m, n), pairs), kind)
    for d in range(m + n - 1):
        lo, hi = max(0, d - n + 1), min(m - 1, d) + 1
        own, v, h, size = slice(n - 1 - d + lo, n - 1 - d + hi), rows[lo:hi], starts[n - 1 - d + lo : n - 1 - d + hi], hi - lo
        u, p, q = unlike[:size], x[:size], y[:size]
        np.not_equal(a[lo:hi], turned[own], out=u)
        np.multiply(u.view(np.uint8) if kind is np.uint8 else u, kind(none), out=p)
        np.bitwise_not(p, out=q)
        np.bitwise_or(q, v, out=q)  # where letters are equal, the two strands change places
        np.bitwise_and(p, h, out=p)
        np.maximum(v, p, out=p)
        np.minimum(h, q, out=v)
        h[:] = p
    return starts[::-1]


def _best_parts(starts: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """:func:`_best_part` of each pair, of these lengths, from its gains."""
    width, pairs = starts.shape
    at, place = np.arange(width)[:, None], np.arange(pairs)
    first = np.cumsum(starts == 0, axis=0)  # letters that b's first places share with a
    ends = at + 1
    best = np.where(ends <= m, 2 * first / (m + ends), 0.0).max(axis=0)
    # A part that moves on gains by the place that comes in, and by the one place whose gain begins where the part does.
    where = np.full((width + 1, pairs), width, np.int32)
    where[starts, place] = at
    ends = at + m
    comes = (np.take_along_axis(starts, np.minimum(ends, width - 1), axis=0) <= ends - m + 1) & (ends < n)
    begins = where[1:] < np.minimum(ends, n)
    found = first[np.minimum(m, n) - 1, place] + np.cumsum(comes.astype(np.int32) + begins, axis=0)
    ahead = at + 1  # where parts start
    size = np.minimum(ahead + m, n) - ahead
    return np.maximum(best, np.where(size > 0, 2 * (found - ahead) / (m + np.maximum(size, 0)), 0.0).max(axis=0))


def _letters(texts: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All letters of the texts as small numbers, 2 at least, and where each text begins."""
    every = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(every) and every.max() > 253:
        every = np.unique(every, return_inverse=True)[1].astype(np.uint32)
    every = every + np.uint32(2)
    return every.astype(np.uint8) if not len(every) or every.max() < 256 else every, np.cumsum(lengths) - lengths


def compared(a: list[str], b: list[str], parts: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """:func:`common_subsequence` of many pairs, and where asked for their :func:`partial`."""
    shorter, longer = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)], [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    m, n = (np.fromiter(map(len, x), np.int64, len(x)) for x in (shorter, longer))
    common, best = np.zeros(len(a), np.int64), np.zeros(len(a)) if parts else None
    letters, begins = _letters([*shorter, *longer], np.concatenate([m, n]))
    order = np.lexsort((m, n))
    order, k = order[m[order] > 0], 0
    while k < len(order):
        take = order[k : k + max(1, _CELLS // int(n[order[min(k + 64, len(order) - 1)]]))]
        k += len(take)

        def block(at, lengths, none):
            inside = np.arange(lengths.max())[:, None]
            return np.where(inside < lengths, letters[np.minimum(begins[at] + inside, len(letters) - 1)], letters.dtype.type(none))

        sides = block(take, m[take], 0), block(take + len(a), n[take], 1)
        starts = _gains(*sides)
        common[take] = ((starts == 0) & (np.arange(len(starts))[:, None] < n[take])).sum(axis=0)
        if parts:
            best[take] = _best_parts(starts, m[take], n[take])
            same = np.flatnonzero(m[take] == n[take])
            if len(same):
                turned = _gains(np.ascontiguousarray(sides[1][:, same]), np.ascontiguousarray(sides[0][:, same]))
                best[take[same]] = np.maximum(best[take[same]], _best_parts(turned, m[take][same], n[take][same]))
    return common, best


def _ratios(common: np.ndarray, a: list[str], b: list[str]) -> np.ndarray:
    total = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), np.int64, len(a))
    return 2 * common / np.maximum(total, 1)


def similarities(a: list[str], b: list[str], names: list[str]) -> dict[str, np.ndarray]:
    """:func:`ratio`, :func:`token_sort`, :func:`token_set` and :func:`partial` of many pairs, those named."""
    out = {}
    if "ratio" in names or "partial" in names:
        common, out["partial"] = compared(a, b, "partial" in names)
        out["ratio"] = _ratios(common, a, b)
    if "token_sort" in names:
        ordered = {t: " ".join(sorted(t.split())) for t in {*a, *b}}
        x, y = ([ordered[t] for t in side] for side in (a, b))
        out["token_sort"] = _ratios(compared(x, y)[0], x, y)
    if "token_set" in names:
        words = {t: set(t.split()) for t in {*a, *b}}
        score, left = np.zeros(len(a)), []
        for k, (s, t) in enumerate(zip(a, b, strict=True)):
            x, y = words[s], words[t]
            if x and y:
                both = x & y
                if both and (len(both) == len(x) or len(both) == len(y)):
                    score[k] = 1.0
                else:
                    left.append((k, " ".join(sorted(x - y)), " ".join(sorted(y - x)), sum(map(len, both)) + max(len(both) - 1, 0)))
        if left:
            at, p, q, shared = (list(x) for x in zip(*left, strict=True))
            shared, lengths = np.array(shared), [np.array([len(z) for z in side]) for side in (p, q)]
            lead, total = shared + (shared > 0), lengths[0] + lengths[1]
            best = 1 - (total - 2 * compared(p, q)[0]) / (2 * lead + total)
            for z in lengths:
                best = np.where(shared > 0, np.maximum(best, 1 - (1 + z) / (shared + lead + z)), best)
            score[at] = best
        out["token_set"] = score
    return {n: out[n] for n in names}


def fuzzy_ratios(a, b, *which: str):
    """Similarities of two columns, as a struct: those named, or all of ratio, token_sort, token_set and partial."""
    names = list(which or _RATIOS)

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def of(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(similarities(a.fillna("").tolist(), b.fillna("").tolist(), names), dtype="float64")

    return of(a, b)


def _overlap(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """Jaccard, containment and common elements of sets; 0 if either is empty."""
    common, some = F.size(F.array_intersect(a, b)), (F.size(a) > 0) & (F.size(b) > 0)
    return (
        F.when(some, common / F.size(F.array_union(a, b))).otherwise(0.0),
        F.when(some, common / F.least(F.size(a), F.size(b))).otherwise(0.0),
        common.cast("double"),
    )


def _postal(numbers: Column, country: Column) -> Column:
    """The last number as long as the country's postal codes."""
    out = F
    for name, lengths in POSTAL_LENGTHS.items():
        out = out.when(country == name, T.last_of_length(numbers, *lengths))
    return out.otherwise(T.last_of_length(numbers, 5, 6))


def wide_features(pairs: DataFrame, targets: DataFrame, references: DataFrame) -> DataFrame:
    """The 58 features of fused pairs, in their order.

    Both sides have entity_id, country and the views raw_name, name, roman_name, raw_address, address, roman_address; targets
    also target_source.
    """
    views = ["raw_name", "name", "roman_name", "raw_address", "address", "roman_address"]
    own = lambda side: [F.col(c).alias(f"{side}_{c}") for c in views]
    t = targets.select(F.col("entity_id").alias("target_id"), "country", "target_source", *own("t"))
    r = references.select(F.col("entity_id").alias("rid"), *own("r"))
    df = pairs.join(t, "target_id").join(r, "rid")
    c, both = F.col, (lambda v: (F.col(f"t_{v}"), F.col(f"r_{v}")))
    wanted = {"raw_name": ["ratio"], "name": [], "roman_name": ["ratio", "token_set"], "address": ["ratio", "token_sort", "token_set"], "roman_address": ["ratio"]}
    for v, which in wanted.items():
        df = df.withColumn(f"f_{v}", fuzzy_ratios(*both(v), *which))
    # Terms are found when a pair's records are together: they are many times as large as the texts, which is what joins and workers pass on.
    grams_of, words_of = T.trigrams, lambda c: F.array_distinct(T.tokens(c))
    df = df.withColumns({f"{side}_{kind}_{v}": make(F.col(f"{side}_{v}")) for side in "tr" for v in ("name", "address") for kind, make in (("grams", grams_of), ("words", words_of))})
    same = lambda side, v: F.when(F.col(f"{side}_roman_{v}") == F.col(f"{side}_{v}"), F.col(f"{side}_grams_{v}")).otherwise(grams_of(F.col(f"{side}_roman_{v}")))
    df = df.withColumns({f"{side}_grams_roman_{v}": same(side, v) for side in "tr" for v in ("name", "address")})
    grams = {v: _overlap(*both(f"grams_{v}")) for v in ("name", "address", "roman_name", "roman_address")}
    words = {v: _overlap(*both(f"words_{v}")) for v in ("name", "address")}
    nums = [F.regexp_extract_all(x, F.lit("(?U)(\\d+)"), F.lit(1)) for x in both("raw_address")]
    n_set = [F.array_distinct(x) for x in nums]
    n_jaccard, n_contained, n_common = _overlap(*n_set)
    post = [_postal(x, c("country")) for x in nums]
    ranks = F.array_sort(F.array("joint_rank", "name_rank", "address_rank"))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    some = lambda v: (both(v)[0] != "") & (both(v)[1] != "")
    made = {
        "name_ratio": c("f_raw_name.ratio"), "name_token_sort": c("f_name.token_sort"), "name_token_set": c("f_name.token_set"), "name_partial": c("f_name.partial"),
        "name_core_ratio": c("f_name.ratio"), "name_core_token_set": c("f_name.token_set"), "name_translit_ratio": c("f_roman_name.ratio"), "name_translit_token_set": c("f_roman_name.token_set"),
        "name_translit_gram_jaccard": grams["roman_name"][0], "name_gram_jaccard": grams["name"][0], "name_gram_containment": grams["name"][1],
        "name_token_jaccard": words["name"][0], "name_token_containment": words["name"][1], "name_common_tokens": words["name"][2],
        "name_prefix_equal": flag(some("name") & (T.first(T.tokens(c("t_name"))) == T.first(T.tokens(c("r_name"))))),
        "name_length_ratio": F.least(*[F.length(x) for x in both("name")]) / F.greatest(*[F.length(x) for x in both("name")], F.lit(1)),
        "name_exact": flag(some("raw_name") & (c("t_raw_name") == c("r_raw_name"))), "core_name_exact": flag(some("name") & (c("t_name") == c("r_name"))),
        "address_ratio": c("f_address.ratio"), "address_token_sort": c("f_address.token_sort"), "address_token_set": c("f_address.token_set"),
        "address_translit_ratio": c("f_roman_address.ratio"), "address_translit_gram_jaccard": grams["roman_address"][0],
        "address_gram_jaccard": grams["address"][0], "address_gram_containment": grams["address"][1],
        "address_token_jaccard": words["address"][0], "address_token_containment": words["address"][1], "address_common_tokens": words["address"][2],
        "address_exact": flag(some("raw_address") & (c("t_raw_address") == c("r_raw_address"))),
        "number_jaccard": n_jaccard, "number_containment": n_contained, "number_common": n_common,
        "number_conflict": flag((F.size(n_set[0]) > 0) & (F.size(n_set[1]) > 0) & (n_common == 0)),
        "postal_equal": flag((post[0] != "") & (post[0] == post[1])), "postal_conflict": flag((post[0] != "") & (post[1] != "") & (post[0] != post[1])),
        "name_missing": flag(c("t_name") == ""), "address_missing": flag(c("t_address") == ""),
        "target_name_length": F.length("t_name"), "reference_name_length": F.length("r_name"), "target_address_length": F.length("t_address"), "reference_address_length": F.length("r_address"),
        "name_ratio_joint": c("f_name.ratio") * c("joint_score"), "name_ratio_address": c("f_name.ratio") * c("address_score"),
        "name_ratio_rank": c("f_name.ratio") / c("joint_rank"), "address_ratio_rank": c("f_address.ratio") / c("address_rank"),
        "best_rank": ranks[0], "rank_gap": ranks[1] - ranks[0], "rrf_score": 1.0 / (60 + c("joint_rank")) + 1.0 / (60 + c("name_rank")) + 1.0 / (60 + c("address_rank")),
        "target_is_s2": flag(c("target_source") == "S2"), "country_us": flag(c("country") == "US"), "country_india": flag(c("country") == "India"), "country_france": flag(c("country") == "France"),
    }
    return df.select("target_id", "rid", "target_source", "candidate_rank", *[made.get(f, c(f) if f not in made else None).cast("double").alias(f) for f in FEATURES])
