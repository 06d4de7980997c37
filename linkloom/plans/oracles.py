"""DuckDB SQL of the registered queries, written from the definitions and not from the DataFrame code.

Each query is a chain of common table expressions; ``_sql`` takes the parts that a query names, and what they need.
"""

from __future__ import annotations

from linkloom.functions import vocabulary as V
from linkloom.operators import features, folds, fuzzy, ranked
from linkloom.operators.blocking import ADDRESS_COMPOSITES, BASE, COMPOSITE, NAME_COMPOSITES, Blocking


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _plain(x: str) -> str:
    return f"trim(regexp_replace(lower(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', ' ', 'g'))"


def _short(x: str, table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items())
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda t: CASE t {cases} ELSE t END), ' ')"


def _tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def _without(x: str, words) -> str:
    return f"list_filter({x}, lambda t: NOT list_contains({_list(words)}, t))"


def _no_numbers(x: str) -> str:
    return f"list_filter({x}, lambda t: NOT regexp_full_match(t, '[0-9]+'))"


def _longest(x: str) -> str:
    return f"list_slice(list_transform(list_sort(list_transform(list_distinct({x}), lambda t: {{'l': -length(t), 't': t}})), lambda s: s.t), 1, 4)"


def _pairs(x: str) -> str:
    of = [f"CASE WHEN len({x}) >= {j} THEN least({x}[{i}], {x}[{j}]) || '|' || greatest({x}[{i}], {x}[{j}]) END" for i in range(1, 5) for j in range(i + 1, 5)]
    return f"list_filter([{', '.join(of)}], lambda p: p IS NOT NULL)"


def _sampled(x: str, limit: int) -> str:
    c = f"replace({x}, ' ', '')"
    every = f"list_transform(range(1, length({c}) - 1), lambda i: substr({c}, i, 3))"
    some = f"list_transform(range(0, {limit}), lambda i: substr({c}, CAST(round_even(i * (length({c}) - 3) / {limit - 1}.0, 0) AS BIGINT) + 1, 3))"
    return f"list_distinct(CASE WHEN {c} = '' THEN [] WHEN length({c}) < 3 THEN [{c}] WHEN length({c}) - 2 <= {limit} THEN {every} ELSE {some} END)"


def _grams(x: str) -> str:
    p = f"('_' || replace({x}, ' ', '_') || '_')"
    return f"list_distinct(list_transform(range(1, length({p}) - 1), lambda i: substr({p}, i, 3)))"


def _one(x: str) -> str:
    return f"CASE WHEN {x} <> '' THEN [{x}] ELSE [] END"


def _joined(a: str, b: str) -> str:
    return f"CASE WHEN {a} <> '' AND {b} <> '' THEN [{a} || '|' || {b}] ELSE [] END"


_SALIENT = [*V.STOPWORDS, *V.ADDRESS_SHORT, *V.ADDRESS_SHORT.values()]
PARTS: dict[str, tuple[str, list[str]]] = {}


def part(name: str, sql: str, *needs: str) -> None:
    PARTS[name] = sql, list(needs)


def _sql(final: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for m in PARTS[n][1]:
            visit(m)
        if n not in order:
            order.append(n)

    for n in needs:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][0]})" for n in order) + "\n" + final


part("reg", """SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, 'S' || (doc_id % 3 + 1) AS source, substr(text, 1, 60) AS business_name,
  (n_chars % 200) || ' ' || substr(text, 61, 40) || ' ' || (10000 + (n_chars * 7) % 90000) AS business_address, lang AS country, md5(text) AS content FROM documents""")  # fmt: skip
part("norm", f"""SELECT entity_id, source, trim(country) AS country, regexp_replace({_plain('business_name')}, '(?:(?:^| )(?:{'|'.join(V.LEGAL_SUFFIXES)}))+$', '') AS name,
  {_short(_plain('business_address'), V.ADDRESS_SHORT)} AS address FROM reg""", "reg")  # fmt: skip
part("rec0", f"""SELECT *, {_tokens('name')} AS nt, {_tokens('address')} AS adt, regexp_extract_all(address, '[0-9]+') AS runs,
  list_filter({_tokens('address')}, lambda t: regexp_full_match(t, '[0-9]+')) AS whole FROM norm""", "norm")  # fmt: skip
part("rec", f"""SELECT *, list_filter(runs, lambda x, i: list_position(runs, x) = i) AS numbers, coalesce(whole[1], '') AS house,
  coalesce(list_filter(whole, lambda t: length(t) IN (5, 6))[-1], '') AS zip, {_longest(_without('nt', [*V.STOPWORDS, *V.LEGAL_SUFFIXES]))} AS top,
  {_longest(_no_numbers(_without('adt', V.STOPWORDS)))} AS atop, {_longest(_no_numbers(_without('adt', _SALIENT)))} AS sal,
  coalesce({_no_numbers(_without('adt', _SALIENT))}[-1], '') AS tail FROM rec0""", "rec0")  # fmt: skip
part("rec2", "SELECT *, coalesce(list_filter(numbers, lambda t: length(t) IN (5, 6))[-1], '') AS postal FROM rec", "rec")


def _key_parts(config: Blocking) -> str:
    lists = {
        "exact_name": _one("name"), "name_token": "top", "name_gram": _sampled("name", 4), "exact_address": _one("address"), "address_token": "atop",
        "address_gram": _sampled("address", 3), "postal_house": _joined("zip", "house"),
    }
    if config.composite:
        first, salient, compact = "coalesce(top[1], '')", "coalesce(sal[1], '')", "replace(name, ' ', '')"
        lists |= {
            "compact_name": f"CASE WHEN length({compact}) >= 5 THEN [{compact}] ELSE [] END", "name_anchor": _one(first), "name_pair": _pairs("top"),
            "name_house": _joined(first, "house"), "name_place": _joined(first, "tail"), "address_pair": _pairs("sal"), "house_address": _joined("house", salient),
        }
    return " UNION ALL ".join(f"SELECT entity_id, source, country, '{k}' AS kind, unnest({x}) AS value FROM rec2" for k, x in lists.items())


def _case(config: Blocking, attribute: str) -> str:
    return "CASE kind " + " ".join(f"WHEN '{k.name}' THEN {getattr(k, attribute)}" for k in config.kinds) + " END"


def _times(*kinds: str) -> str:
    return f"CAST(sum(CASE WHEN kind IN ({', '.join(repr(k) for k in kinds)}) THEN 1 ELSE 0 END) AS BIGINT)"


for _c, _config in (("b", BASE), ("c", COMPOSITE)):
    part(f"keys_{_c}", f"SELECT DISTINCT * FROM ({_key_parts(_config)})", "rec2")
    part(f"posts_{_c}", f"SELECT entity_id, country, source AS target_source, kind, value FROM keys_{_c} WHERE source <> 'S1'", f"keys_{_c}")
    part(f"stats_{_c}", f"SELECT country, target_source, kind, value, count(DISTINCT entity_id) AS posting_df, {_case(_config, 'limit')} AS posting_limit FROM posts_{_c} GROUP BY ALL", f"posts_{_c}")
    part(f"ok_{_c}", f"SELECT country, target_source, kind, value, posting_df FROM stats_{_c} WHERE posting_df <= posting_limit", f"stats_{_c}")
    part(f"own_{_c}", f"""SELECT * FROM (SELECT k.entity_id, k.country, e.target_source, k.kind, k.value, e.posting_df,
      row_number() OVER (PARTITION BY k.entity_id, e.target_source, k.kind ORDER BY e.posting_df, k.value) AS key_rank
      FROM keys_{_c} k JOIN ok_{_c} e USING (country, kind, value) WHERE k.source = 'S1') WHERE key_rank <= {_case(_config, 'budget')}""", f"keys_{_c}", f"ok_{_c}")  # fmt: skip
    part(f"hits_{_c}", f"""SELECT o.entity_id AS source1_id, o.country, o.target_source, p.entity_id AS target_id, o.kind, o.posting_df
      FROM own_{_c} o JOIN posts_{_c} p USING (country, target_source, kind, value)""", f"own_{_c}", f"posts_{_c}")  # fmt: skip
    _sums = {
        "exact_name_hit": "max(CASE WHEN kind = 'exact_name' THEN 1 ELSE 0 END)", "exact_address_hit": "max(CASE WHEN kind = 'exact_address' THEN 1 ELSE 0 END)",
        "postal_house_hit": "max(CASE WHEN kind = 'postal_house' THEN 1 ELSE 0 END)", "name_token_hits": _times("name_token"), "address_token_hits": _times("address_token"),
        "name_gram_hits": _times("name_gram"), "address_gram_hits": _times("address_gram"),
    }
    _score = "12 * exact_name_hit + 12 * exact_address_hit + 6 * postal_house_hit + 0.75 * name_token_hits + 0.55 * address_token_hits + 0.20 * name_gram_hits + 0.15 * address_gram_hits"
    if _config.composite:
        _sums |= {"roman_exact_name_hit": "0", "roman_exact_address_hit": "0", "composite_key_hits": _times(*NAME_COMPOSITES, *ADDRESS_COMPOSITES), "name_composite_hits": _times(*NAME_COMPOSITES), "address_composite_hits": _times(*ADDRESS_COMPOSITES)}
        _score += " + 1.25 * name_composite_hits + 1.0 * address_composite_hits"
    part(f"ev_{_c}", f"""SELECT source1_id, country, target_source, target_id, {', '.join(f'{e} AS {n}' for n, e in _sums.items())},
      round(sum(CAST({_case(_config, 'weight')} AS DOUBLE) / ln(posting_df + 1.0)), 6) AS rarity_score FROM hits_{_c} GROUP BY ALL""", f"hits_{_c}")  # fmt: skip
    part(f"cand_{_c}", f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source1_id, target_source ORDER BY retrieval_score DESC, exact_name_hit DESC, exact_address_hit DESC, target_id) AS candidate_rank
      FROM (SELECT *, round(rarity_score + CAST({_score} AS DOUBLE), 6) AS retrieval_score FROM ev_{_c})) WHERE candidate_rank <= 32""", f"ev_{_c}")  # fmt: skip


def _edit(a: str, b: str) -> str:
    return f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 0.0 ELSE 1.0 - levenshtein({a}, {b}) / CAST(greatest(length({a}), length({b})) AS DOUBLE) END"


def _inter(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b}))"


def _jac(a: str, b: str) -> str:
    return f"CAST({_inter(a, b)} AS DOUBLE) / greatest(len(list_distinct(list_concat({a}, {b}))), 1)"


def _same(a: str, b: str) -> str:
    return f"CASE WHEN {a} <> '' AND {a} = {b} THEN 1.0 ELSE 0.0 END"


def _lengths(a: str, b: str) -> str:
    return f"CAST(least(length({a}), length({b})) AS DOUBLE) / greatest(length({a}), length({b}), 1)"


_F = {"number_jaccard": _jac("q.numbers", "t.numbers"), "postal_equal": _same("q.postal", "t.postal"), "target_is_s2": "CASE WHEN c.target_source = 'S2' THEN 1.0 ELSE 0.0 END"}
_F |= {"query_address_missing": "CASE WHEN q.address = '' THEN 1.0 ELSE 0.0 END", "target_address_missing": "CASE WHEN t.address = '' THEN 1.0 ELSE 0.0 END"}
for _n, _w in (("name", "nt"), ("address", "adt")):
    _F |= {
        f"{_n}_edit_similarity": _edit(f"q.{_n}", f"t.{_n}"), f"exact_{_n}": _same(f"q.{_n}", f"t.{_n}"), f"{_n}_length_ratio": _lengths(f"q.{_n}", f"t.{_n}"), f"{_n}_token_jaccard": _jac(f"q.{_w}", f"t.{_w}"),
        f"{_n}_token_containment": f"CAST({_inter(f'q.{_w}', f't.{_w}')} AS DOUBLE) / greatest(least(len(q.{_w}), len(t.{_w})), 1)",
        f"roman_{_n}_edit_similarity": _edit(f"q.{_n}", f"t.{_n}"), f"roman_exact_{_n}": _same(f"q.{_n}", f"t.{_n}"), f"roman_{_n}_token_jaccard": _jac(f"q.{_w}", f"t.{_w}"),
    }
_F |= {"house_number_equal": "CASE WHEN len(q.numbers) > 0 AND len(t.numbers) > 0 AND q.numbers[1] = t.numbers[1] THEN 1.0 ELSE 0.0 END", "candidate_rank_reciprocal": "1.0 / greatest(c.candidate_rank, 1)"}
for _c, _names in (("b", features.BASE_FEATURES), ("c", features.COMPOSITE_FEATURES)):
    _cols = ", ".join(f"CAST({_F.get(n, f'c.{n}')} AS DOUBLE) AS {n}" for n in _names)
    part(f"feat_{_c}", f"""SELECT c.source1_id, c.target_id, c.target_source, c.candidate_rank, {_cols} FROM cand_{_c} c
      JOIN rec2 q ON q.entity_id = c.source1_id JOIN rec2 t ON t.entity_id = c.target_id""", f"cand_{_c}", "rec2")  # fmt: skip
part("s1", "SELECT entity_id FROM reg WHERE source = 'S1'", "reg")
part("edges", "SELECT DISTINCT q.entity_id AS source1_id, t.entity_id AS target_id FROM reg q JOIN reg t USING (content) WHERE q.source = 'S1' AND t.source <> 'S1'", "reg")
part("owners", "SELECT min(source1_id) AS source1_id, target_id FROM edges GROUP BY target_id", "edges")
_D = "CAST({} AS DOUBLE)".format
_RULE = " + ".join(f"{_D(w)} * {x}" for w, x in (
    (0.37, "name_edit_similarity"), (0.12, "name_token_jaccard"), (0.27, "address_edit_similarity"), (0.10, "address_token_jaccard"), (0.06, "house_number_equal"), (0.05, "postal_equal"),
    (0.18, "exact_name"), (0.08, "exact_address"), (0.04, "candidate_rank_reciprocal")))
_SUPPORT = "(postal_equal > 0 OR house_number_equal > 0 OR number_jaccard >= 0.5)"
part("rules", f"""SELECT source1_id, target_id, target_source, candidate_rank, round({_RULE}, 6) AS rule_score FROM feat_c WHERE
  (exact_name >= 1 AND (address_edit_similarity >= 0.25 OR address_token_jaccard >= 0.30 OR exact_address >= 1 OR {_SUPPORT}))
  OR (name_edit_similarity >= 0.94 AND name_token_jaccard >= 0.55 AND (address_edit_similarity >= 0.45 OR address_token_jaccard >= 0.35 OR exact_address >= 1 OR {_SUPPORT}))
  OR (name_edit_similarity >= 0.87 AND name_token_jaccard >= 0.50 AND (address_edit_similarity >= 0.70 OR address_token_jaccard >= 0.55))
  OR ((address_edit_similarity >= 0.93 OR address_token_jaccard >= 0.78 OR exact_address >= 1) AND name_edit_similarity >= 0.75 AND name_token_jaccard >= 0.35)""", "feat_c")  # fmt: skip
part("won", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY rule_score DESC, candidate_rank, source1_id) AS k FROM rules) WHERE k = 1", "rules")
part("scored", """SELECT f.*, CASE WHEN e.target_id IS NULL THEN 0 ELSE 1 END AS label, round((name_edit_similarity + address_edit_similarity) / 2, 6) AS probability
  FROM feat_c f LEFT JOIN edges e USING (source1_id, target_id)""", "feat_c", "edges")  # fmt: skip
part("labelled", "SELECT f.*, CASE WHEN e.target_id IS NULL THEN 0 ELSE 1 END AS label FROM feat_b f LEFT JOIN edges e USING (source1_id, target_id)", "feat_b", "edges")
part("hard", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source1_id, target_source ORDER BY retrieval_score DESC, target_id) AS negative_rank FROM labelled WHERE label = 0) WHERE negative_rank <= 8", "labelled")
part("truth", "SELECT entity_id AS source1_id, count(DISTINCT target_id) AS truth_count FROM s1 LEFT JOIN edges ON source1_id = entity_id GROUP BY 1", "s1", "edges")


def _values(name: str, values) -> str:
    return f"(SELECT unnest([{', '.join(_D(v) if isinstance(v, float) else str(v) for v in values)}]) AS {name})"


_FH = "CASE WHEN t.truth_count = 0 AND coalesce(predicted, 0) = 0 THEN 1.0 WHEN t.truth_count = 0 OR coalesce(predicted, 0) = 0 THEN 0.0 ELSE 1.25 * tp / CAST(predicted + 0.25 * t.truth_count AS DOUBLE) END"
part("sweep", f"""SELECT g.cap AS cap_per_source, g.threshold, round(avg({_FH}), 9) AS macro_f0_5, CAST(any_value(coalesce(h.hits, 0)) AS BIGINT) AS candidate_hits, CAST(sum(t.truth_count) AS BIGINT) AS truth_links,
  CASE WHEN sum(t.truth_count) > 0 THEN round(any_value(coalesce(h.hits, 0)) / CAST(sum(t.truth_count) AS DOUBLE), 9) ELSE 0.0 END AS candidate_recall
  FROM (SELECT * FROM {_values('cap', V.CAPS)}, {_values('threshold', V.THRESHOLDS)}) g CROSS JOIN truth t
  LEFT JOIN (SELECT cap, threshold, source1_id, sum(label) AS tp, count(*) AS predicted FROM scored, {_values('cap', V.CAPS)}, {_values('threshold', V.THRESHOLDS)} WHERE candidate_rank <= cap AND probability >= threshold GROUP BY ALL) p
    ON p.cap = g.cap AND p.threshold = g.threshold AND p.source1_id = t.source1_id
  LEFT JOIN (SELECT cap, sum(label) AS hits FROM scored, {_values('cap', V.CAPS)} WHERE candidate_rank <= cap GROUP BY cap) h ON h.cap = g.cap GROUP BY g.cap, g.threshold""", "scored", "truth")  # fmt: skip
part("percap", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cap_per_source ORDER BY macro_f0_5 DESC, threshold) AS k FROM sweep) WHERE k = 1", "sweep")
_LIMIT = f"CASE target_source WHEN 'S2' THEN {_D(0.5)} ELSE {_D(0.6)} END"
part("counts", "SELECT r.entity_id, r.country, count(c.target_id) AS n FROM rec2 r LEFT JOIN cand_b c ON c.source1_id = r.entity_id WHERE r.source = 'S1' GROUP BY ALL", "rec2", "cand_b")

# Ranked retrieval.
def _no_web(x: str) -> str:
    return f"regexp_replace({x}, '{V.WEB}', ' ', 'g')"


part("views", f"""SELECT entity_id, source, country, raw, address, array_to_string({_without(_tokens('raw'), [*V.LEGAL_WIDE, *V.STOP_WIDE])}, ' ') AS core FROM (
  SELECT entity_id, source, country, {_plain(f"replace({_no_web('business_name')}, '&', ' and ')")} AS raw, {_short(_plain(_no_web('business_address')), V.ADDRESS_WIDE)} AS address FROM reg)""", "reg")  # fmt: skip
_FIELDS = {
    "nw": f"list_distinct({_tokens('raw')})", "ncw": f"list_distinct({_tokens('core')})", "aw": f"list_distinct({_tokens('address')})", "acw": f"list_distinct({_tokens('address')})",
    "name": _grams("raw"), "name_core": _grams("core"), "address": _grams("address"), "address_core": _grams("address"),
}


def _search(tag: str, views: dict[str, dict[str, float]]) -> None:
    used = sorted({f for v in views.values() for f in v})
    rows = " UNION ALL ".join(f"SELECT entity_id, source, country, '{f}' AS field, {_FIELDS[f]} AS terms FROM views" for f in used)
    boosts = ", ".join(f"('{v}', '{f}', {_D(w)})" for v, fs in views.items() for f, w in fs.items())
    part(f"fields_{tag}", rows, "views")
    part(f"terms_{tag}", f"SELECT entity_id, source, country, field, unnest(terms) AS term, len(terms) AS len FROM fields_{tag}", f"fields_{tag}")
    part(f"n_{tag}", "SELECT country, count(*) AS n FROM views WHERE source = 'S1' GROUP BY country", "views")
    part(f"mean_{tag}", f"SELECT country, field, avg(len(terms)) AS mean FROM fields_{tag} WHERE source = 'S1' GROUP BY ALL", f"fields_{tag}")
    part(f"df_{tag}", f"SELECT country, field, term, count(*) AS df FROM terms_{tag} WHERE source = 'S1' GROUP BY ALL", f"terms_{tag}")
    part(f"index_{tag}", f"""SELECT t.entity_id AS rid, t.country, t.field, t.term, ln(1.0 + (n.n - d.df + 0.5) / CAST(d.df + 0.5 AS DOUBLE)) * 2.2 / CAST(1.0 + 1.2 * (0.25 + 0.75 * t.len / m.mean) AS DOUBLE) AS weight
      FROM terms_{tag} t JOIN df_{tag} d USING (country, field, term) JOIN n_{tag} n USING (country) JOIN mean_{tag} m USING (country, field) WHERE t.source = 'S1'""", f"terms_{tag}", f"df_{tag}", f"n_{tag}", f"mean_{tag}")  # fmt: skip
    part(f"found_{tag}", f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_id, view ORDER BY score DESC, rid) AS view_rank FROM (
      SELECT t.entity_id AS target_id, b.view, i.rid, round(sum(i.weight * b.boost), 6) AS score FROM terms_{tag} t JOIN index_{tag} i USING (country, field, term)
      JOIN (VALUES {boosts}) b(view, field, boost) USING (field) WHERE t.source <> 'S1' GROUP BY ALL)) WHERE view_rank <= 24""", f"terms_{tag}", f"index_{tag}")  # fmt: skip


_search("w", {"name": {"nw": 1.0, "ncw": 1.2}, "address": {"aw": 1.0, "acw": 1.2}})
_search("v", ranked.VIEWS)
_AT = "coalesce(max(CASE WHEN view = '{0}' THEN {1} END), {2}) AS {0}_{3}"
part("fused0", f"SELECT target_id, rid, {', '.join(_AT.format(v, c, d, s) for v in ('name', 'address') for c, d, s in (('view_rank', 25, 'rank'), ('score', 0.0, 'score')))} FROM found_w GROUP BY ALL", "found_w")
part("fused", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY rrf DESC, name_rank, address_rank, rid) AS candidate_rank FROM (
  SELECT *, round(1.0::DOUBLE / (60 + name_rank) + 1.0::DOUBLE / (60 + address_rank), 10) AS rrf FROM fused0)) WHERE candidate_rank <= 8""", "fused0")  # fmt: skip
part("tscored", """SELECT f.target_id, f.rid AS source1_id, f.candidate_rank, round(rrf * 30, 6) AS probability, CASE WHEN o.target_id IS NULL THEN 0 ELSE 1 END AS label
  FROM fused f LEFT JOIN owners o ON o.target_id = f.target_id AND o.source1_id = f.rid""", "fused", "owners")  # fmt: skip
part("otruth", "SELECT entity_id AS source1_id, count(DISTINCT target_id) AS truth_count FROM s1 LEFT JOIN owners ON source1_id = entity_id GROUP BY 1", "s1", "owners")
part("tbest", f"""SELECT cap, threshold, source1_id, sum(label) AS tp, count(*) AS predicted FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cap, target_id ORDER BY probability DESC, candidate_rank) AS k
  FROM tscored, {_values('cap', V.TARGET_CAPS)} WHERE candidate_rank <= cap) WHERE k = 1), {_values('threshold', V.TARGET_THRESHOLDS)} WHERE probability >= threshold GROUP BY ALL""", "tscored")  # fmt: skip
part("trecall", f"""SELECT cap, CAST((SELECT count(*) FROM tscored WHERE candidate_rank <= cap) AS BIGINT) AS candidate_pairs,
  round(CAST((SELECT count(DISTINCT target_id) FROM tscored WHERE label = 1 AND candidate_rank <= cap) AS DOUBLE) / (SELECT count(DISTINCT target_id) FROM owners), 9) AS candidate_recall FROM {_values('cap', V.TARGET_CAPS)}""", "tscored", "owners")  # fmt: skip
part("tcells", f"""SELECT g.cap, g.threshold, t.audit, t.country, count(*) AS n, sum({_FH}) AS f, sum(coalesce(tp, 0)) AS tp, sum(coalesce(predicted, 0)) AS predicted, count(*) FILTER (truth_count > 0) AS with_truth
  FROM (SELECT * FROM {_values('cap', V.TARGET_CAPS)}, {_values('threshold', V.TARGET_THRESHOLDS)}) g CROSS JOIN (SELECT o.*, CASE WHEN r.country IN ('en', 'de', 'fr') THEN r.country ELSE 'Other' END AS country,
    CAST(('0x' || substr(md5(o.source1_id), 1, 8)) AS BIGINT) % 5 = 4 AS audit FROM otruth o JOIN reg r ON r.entity_id = o.source1_id) t
  LEFT JOIN tbest p ON p.cap = g.cap AND p.threshold = g.threshold AND p.source1_id = t.source1_id GROUP BY ALL""", "otruth", "reg", "tbest")  # fmt: skip
part("tpoint", """SELECT * FROM (SELECT *, max(macro_f0_5) OVER () AS best FROM (SELECT cap, threshold, round(sum(f) FILTER (NOT audit) / sum(n) FILTER (NOT audit), 9) AS macro_f0_5, round(sum(f) FILTER (audit) / sum(n) FILTER (audit), 9) AS audit_macro_f0_5,
  CAST(sum(n) FILTER (audit) AS BIGINT) AS audit_source1_entities, CAST(sum(with_truth) AS BIGINT) AS truth_entities, CAST(sum(tp) FILTER (NOT audit) AS BIGINT) AS matched_pairs, CAST(sum(predicted) FILTER (NOT audit) AS BIGINT) AS predicted_pairs
  FROM tcells GROUP BY ALL)) WHERE macro_f0_5 >= best - 0.0002 ORDER BY cap, macro_f0_5 DESC, threshold DESC LIMIT 1""", "tcells")  # fmt: skip
_X = "[^\\p{L}\\p{N}]+"


def _fold(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(replace({x}, 'ß', 'ss'))), '{_X}', ' ', 'g'))"


part("uviews", f"""SELECT entity_id, source, country, raw_name, address, array_to_string({_without(_tokens('raw_name'), [*V.LEGAL_WIDE, *V.STOP_WIDE])}, ' ') AS name FROM (
  SELECT entity_id, source, country, {_fold(f"replace({_no_web('business_name')}, '&', ' and ')")} AS raw_name, {_short(_fold(_no_web('business_address')), V.ADDRESS_WIDE)} AS address FROM reg)""", "reg")  # fmt: skip
part("fusedv0", f"SELECT target_id, rid, {', '.join(_AT.format(v, c, d, s) for v in ('joint', 'name', 'address') for c, d, s in (('view_rank', 25, 'rank'), ('score', 0.0, 'score')))} FROM found_v GROUP BY ALL", "found_v")
part("fusedv", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY rrf DESC, joint_rank, name_rank, address_rank, rid) AS candidate_rank FROM (
  SELECT *, round(1.0::DOUBLE / (60 + joint_rank) + 1.0::DOUBLE / (60 + name_rank) + 1.0::DOUBLE / (60 + address_rank), 10) AS rrf FROM fusedv0)) WHERE candidate_rank <= 8""", "fusedv0")  # fmt: skip
_POSTAL = "coalesce(list_filter({0}, lambda t: length(t) IN (5, 6))[-1], '')"  # none of the countries has a rule of its own
part("uterms", f"""SELECT *, {_grams('name')} AS gn, {_grams('address')} AS ga, list_distinct({_tokens('name')}) AS wn, list_distinct({_tokens('address')}) AS wa, {_tokens('name')} AS ts,
  regexp_extract_all(address, '[0-9]+') AS runs FROM uviews""", "uviews")  # fmt: skip


def _set_features() -> str:
    some = lambda a: f"len(t.{a}) > 0 AND len(r.{a}) > 0"
    jac = lambda a: f"CASE WHEN {some(a)} THEN {_jac(f't.{a}', f'r.{a}')} ELSE 0 END"
    con = lambda a: f"CASE WHEN {some(a)} THEN CAST({_inter(f't.{a}', f'r.{a}')} AS DOUBLE) / least(len(list_distinct(t.{a})), len(list_distinct(r.{a}))) ELSE 0 END"
    com = lambda a: _inter(f"t.{a}", f"r.{a}")
    flag = lambda x: f"CASE WHEN {x} THEN 1 ELSE 0 END"
    tp, rp = _POSTAL.format("t.runs"), _POSTAL.format("r.runs")
    ranks = "list_sort([f.joint_rank, f.name_rank, f.address_rank])"
    made = {
        "name_translit_gram_jaccard": jac("gn"), "name_gram_jaccard": jac("gn"), "name_gram_containment": con("gn"), "name_token_jaccard": jac("wn"), "name_token_containment": con("wn"), "name_common_tokens": com("wn"),
        "name_prefix_equal": flag("t.name <> '' AND r.name <> '' AND t.ts[1] = r.ts[1]"), "name_length_ratio": _lengths("t.name", "r.name"), "name_exact": flag("t.raw_name <> '' AND t.raw_name = r.raw_name"),
        "core_name_exact": flag("t.name <> '' AND t.name = r.name"), "address_translit_gram_jaccard": jac("ga"), "address_gram_jaccard": jac("ga"), "address_gram_containment": con("ga"),
        "address_token_jaccard": jac("wa"), "address_token_containment": con("wa"), "address_common_tokens": com("wa"), "address_exact": flag("t.address <> '' AND t.address = r.address"),
        "number_jaccard": jac("runs"), "number_containment": con("runs"), "number_common": com("runs"), "number_conflict": flag(f"{some('runs')} AND {com('runs')} = 0"),
        "postal_equal": flag(f"{tp} <> '' AND {tp} = {rp}"), "postal_conflict": flag(f"{tp} <> '' AND {rp} <> '' AND {tp} <> {rp}"), "name_missing": flag("t.name = ''"), "address_missing": flag("t.address = ''"),
        "target_name_length": "length(t.name)", "reference_name_length": "length(r.name)", "target_address_length": "length(t.address)", "reference_address_length": "length(r.address)",
        **{f"{v}_{x}": f"f.{v}_{x}" for v in ("joint", "name", "address") for x in ("rank", "score")}, "best_rank": f"{ranks}[1]", "rank_gap": f"{ranks}[2] - {ranks}[1]",
        "rrf_score": "1.0::DOUBLE / (60 + f.joint_rank) + 1.0::DOUBLE / (60 + f.name_rank) + 1.0::DOUBLE / (60 + f.address_rank)", "target_is_s2": flag("t.source = 'S2'"),
        "country_us": flag("t.country = 'US'"), "country_india": flag("t.country = 'India'"), "country_france": flag("t.country = 'France'"),
    }
    cols = ", ".join(f"round(CAST({made[n]} AS DOUBLE), 9) AS {n}" for n in fuzzy.FEATURES if n not in fuzzy.RATIO_FEATURES)
    return f"SELECT f.target_id, f.rid, t.source AS target_source, f.candidate_rank, {cols} FROM fusedv f JOIN uterms t ON t.entity_id = f.target_id JOIN uterms r ON r.entity_id = f.rid"


def _bits(x: str, step: str) -> str:
    return f"list_reduce(list_concat([{x}], range(8)::UBIGINT[]), lambda x, i: {step})"


def _crc(x: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    step = _bits("xor(c, b)", "xor(x >> 1, 3988292384::UBIGINT * (x & 1))")
    codes = f"list_transform(string_split({x}, ''), lambda s: ascii(s)::UBIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {codes}), lambda c, b: {step}), 4294967295::UBIGINT)"


_W = "18446744073709551616::UHUGEINT"  # numbers of 64 bits
_P1, _P2, _P3, _P4, _P5 = (f"{p}::UHUGEINT" for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotated(x: str, n: int) -> str:
    return f"(({x} * {1 << n}::UHUGEINT) % {_W} + ({x} // {1 << (64 - n)}::UHUGEINT))"


def _xx64(x: str) -> str:
    """xxhash64 with seed 42 of an ASCII text of less than eight characters, as an unsigned number: a chain of subqueries."""
    code = lambda k: f"ascii(substr({x}, {k}, 1))::UHUGEINT"
    word = " + ".join(f"{code(f'{k + 1}')} * {1 << 8 * k}::UHUGEINT" for k in range(4))
    q = f"SELECT *, length({x}) AS n, (42::UHUGEINT + {_P5} + length({x})::UHUGEINT) % {_W} AS h FROM reg"
    mixed = f"({_rotated(f'xor(h, (({word}) * {_P1}) % {_W})', 23)} * {_P2} + {_P3}) % {_W}"
    q = f"SELECT * REPLACE (CASE WHEN n >= 4 THEN {mixed} ELSE h END AS h), CASE WHEN n >= 4 THEN 4 ELSE 0 END AS done FROM ({q})"
    for _ in range(3):
        one = f"({_rotated(f'xor(h, ({code('done + 1')} * {_P5}) % {_W})', 11)} * {_P1}) % {_W}"
        q = f"SELECT * REPLACE (CASE WHEN n > done THEN {one} ELSE h END AS h, done + 1 AS done) FROM ({q})"
    for shift, by in ((33, _P2), (29, _P3), (32, "1::UHUGEINT")):
        q = f"SELECT * REPLACE ((xor(h, h // {1 << shift}::UHUGEINT) * {by}) % {_W} AS h) FROM ({q})"
    return q


def _split(at: str, ranges: dict[str, tuple[int, int]]) -> str:
    return "CASE " + " ".join(f"WHEN {at} >= {a} AND {at} < {b} THEN '{n}'" for n, (a, b) in ranges.items()) + " END"


_KS = (1, 2, 3, 4, 8, 12, 24)
_CELL = f"""SELECT o.target_id, v.view, k.k, CASE WHEN EXISTS (SELECT 1 FROM found_v f WHERE f.target_id = o.target_id AND f.rid = o.source1_id AND (f.view = v.view OR v.view = 'union') AND f.view_rank <= k.k) THEN 1 ELSE 0 END AS hit
  FROM owners o, (SELECT unnest(['joint', 'name', 'address', 'union']) AS view) v, {_values('k', _KS)} k"""
_PAIR = "source1_id, target_id, target_source, candidate_rank"


def _packed(pairs: str, score: str, name: str) -> str:
    return f"SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS {name} FROM s1 LEFT JOIN (SELECT source1_id, string_agg(target_id, ',' ORDER BY {score} DESC, target_source, target_id) AS ids FROM {pairs} GROUP BY 1) ON source1_id = entity_id"


def _rounded(names) -> str:
    return ", ".join(f"round({n}, 9) AS {n}" for n in names)


_MD5 = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT) % {}"
_LISTS = f"""SELECT source1_entity_id AS q, CASE WHEN candidate_entity_ids = '' THEN [] ELSE string_split(candidate_entity_ids, ',') END AS ids FROM ({_packed('cand_b', 'retrieval_score', 'candidate_entity_ids')})"""
part("lists", _LISTS, "cand_b", "s1")

ORACLES = {
    "rule_linkage": _sql(_packed("won", "rule_score", "matched_entity_ids"), "won", "s1"),
    "scan_prepare": _sql("SELECT entity_id, country, name AS norm_name, address AS norm_address, CAST(len(nt) AS INTEGER) AS n_name_tokens, CAST(len(adt) AS INTEGER) AS n_address_tokens FROM rec2", "rec2"),
    "truth_edges": _sql("SELECT * FROM edges", "edges"),
    "truth_group_sizes": _sql("SELECT CAST(truth_count AS INTEGER) AS links, count(*) AS queries FROM truth GROUP BY 1", "truth"),
    "truth_violations": _sql("SELECT (SELECT count(*) FROM edges WHERE source1_id LIKE '%7') AS unknown_queries, (SELECT count(*) FROM (SELECT target_id FROM edges GROUP BY 1 HAVING count(DISTINCT source1_id) > 1)) AS shared_targets", "edges"),
    "first_owners": _sql("SELECT source1_id, target_id FROM owners", "owners"),
    "trigrams_sampled": _sql(f"SELECT entity_id, unnest({_sampled('name', 4)}) AS gram FROM norm", "norm"),
    "trigrams_full": _sql(f"SELECT entity_id, unnest({_grams('name')}) AS gram FROM norm", "norm"),
    "numbers_postal": _sql("SELECT entity_id, array_to_string(numbers, ',') AS numbers, postal FROM rec2", "rec2"),
    "blocking_keys_base": _sql("SELECT entity_id, kind, value FROM keys_b", "keys_b"),
    "blocking_keys_composite": _sql("SELECT entity_id, kind, value FROM keys_c", "keys_c"),
    "posting_stats": _sql("SELECT * FROM stats_b", "stats_b"),
    "posting_prune": _sql("SELECT * FROM ok_b", "ok_b"),
    "query_key_budget": _sql("SELECT * FROM own_b", "own_b"),
    "blocking_hits": _sql("SELECT * FROM hits_b", "hits_b"),
    "candidates_topk": _sql("SELECT * FROM cand_b", "cand_b"),
    "candidates_topk_composite": _sql("SELECT * FROM cand_c", "cand_c"),
    "pair_features_base": _sql(f"SELECT {_PAIR}, {_rounded(features.BASE_FEATURES)} FROM feat_b", "feat_b"),
    "pair_features_composite": _sql(f"SELECT {_PAIR}, {_rounded(features.COMPOSITE_FEATURES)} FROM feat_c", "feat_c"),
    "label_pairs": _sql("SELECT label, count(*) AS pairs FROM labelled GROUP BY 1", "labelled"),
    "hard_negatives": _sql("SELECT source1_id, target_id, target_source, negative_rank FROM hard", "hard"),
    "training_sample": _sql("SELECT source1_id, target_id, target_source, label FROM labelled WHERE label = 1 UNION ALL SELECT source1_id, target_id, target_source, label FROM hard", "labelled", "hard"),
    "rule_matches": _sql("SELECT * FROM rules", "rules"),
    "exclusive_assignment": _sql("SELECT source1_id, target_id, rule_score FROM won", "won"),
    "source_thresholds": _sql(f"SELECT source1_id, target_id, target_source, probability FROM scored WHERE probability >= {_LIMIT}", "scored"),
    "packed_candidates": _sql(_packed("cand_c", "retrieval_score", "candidate_entity_ids"), "cand_c", "s1"),
    "top_candidates": _sql("SELECT source1_id, target_source, target_id, rank FROM (SELECT source1_id, target_source, target_id, retrieval_score AS rank, row_number() OVER (PARTITION BY source1_id, target_source ORDER BY retrieval_score DESC, target_id) AS k FROM cand_b) WHERE k <= 4", "cand_b"),
    "sweep_cap_threshold": _sql("SELECT * FROM sweep", "sweep"),
    "operating_point": _sql("""SELECT cap_per_source, threshold, macro_f0_5 FROM (SELECT *, max(macro_f0_5) OVER () AS best FROM percap)
      ORDER BY CASE WHEN candidate_recall >= 0.99 AND macro_f0_5 >= best - 0.002 THEN 0 WHEN macro_f0_5 = best THEN 1 ELSE 2 END, cap_per_source LIMIT 1""", "percap"),
    "source_threshold_sweep": _sql(f"""SELECT g.threshold, round(avg({_FH}), 9) AS macro_f0_5 FROM {_values('threshold', V.THRESHOLDS)} g CROSS JOIN truth t
      LEFT JOIN (SELECT threshold, source1_id, sum(label) AS tp, count(*) AS predicted FROM scored, {_values('threshold', V.THRESHOLDS)} WHERE candidate_rank <= 8 AND probability >= CASE target_source WHEN 'S2' THEN threshold ELSE {_D(0.6)} END GROUP BY ALL) p
      ON p.threshold = g.threshold AND p.source1_id = t.source1_id GROUP BY g.threshold""", "scored", "truth"),
    "fixed_threshold_score": _sql(f"""SELECT macro_f0_5, CASE WHEN links > 0 THEN round(hits / CAST(links AS DOUBLE), 9) ELSE 0.0 END AS candidate_recall, tp AS true_positives, greatest(0, predicted - tp) AS false_positives,
      greatest(0, links - tp) AS false_negatives, greatest(0, links - hits) AS missed_by_blocking, greatest(0, hits - tp) AS false_negatives_within_candidate_set, links AS truth_links, predicted AS predicted_pairs FROM (
      SELECT round(avg({_FH}), 9) AS macro_f0_5, CAST(sum(coalesce(tp, 0)) AS BIGINT) AS tp, CAST(sum(coalesce(predicted, 0)) AS BIGINT) AS predicted, CAST(sum(truth_count) AS BIGINT) AS links, CAST(sum(coalesce(hits, 0)) AS BIGINT) AS hits FROM truth t
      LEFT JOIN (SELECT source1_id, sum(label) AS hits FROM scored WHERE candidate_rank <= 8 GROUP BY 1) USING (source1_id)
      LEFT JOIN (SELECT source1_id, sum(label) AS tp, count(*) AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY probability DESC, candidate_rank, source1_id) AS k FROM scored
        WHERE candidate_rank <= 8 AND probability >= {_LIMIT}) WHERE k = 1 GROUP BY 1) USING (source1_id))""", "scored", "truth"),
    "confusion_counts": _sql("SELECT count(*) FILTER (probability >= 0.5 AND label = 1) AS tp, count(*) FILTER (probability >= 0.5 AND label = 0) AS fp, count(*) FILTER (probability < 0.5 AND label = 1) AS fn FROM scored", "scored"),
    "candidate_distribution": _sql("SELECT round(avg(n), 6) AS mean, quantile_disc(n, 0.5) AS p50, quantile_disc(n, 0.95) AS p95, quantile_disc(n, 0.99) AS p99, max(n) AS max FROM counts", "counts"),
    "candidate_distribution_linear": _sql("SELECT round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS max FROM counts", "counts"),
    "reduction_ratio": _sql("""SELECT possible_pairs, candidate_pairs, CASE WHEN possible_pairs > 0 THEN round(1.0 - candidate_pairs / CAST(possible_pairs AS DOUBLE), 9) ELSE 0.0 END AS reduction_ratio FROM (
      SELECT CAST((SELECT sum(q * t) FROM (SELECT country, count(*) FILTER (source = 'S1') AS q, count(*) FILTER (source <> 'S1') AS t FROM rec2 GROUP BY 1)) AS BIGINT) AS possible_pairs, (SELECT count(*) FROM cand_b) AS candidate_pairs)""", "rec2", "cand_b"),
    "per_country_counts": _sql("SELECT country, count(*) AS queries, CAST(sum(n) AS BIGINT) AS candidates, round(avg(n), 6) AS mean, quantile_disc(n, 0.95) AS p95 FROM counts GROUP BY country", "counts"),
    "anti_containment": _sql("SELECT e.* FROM edges e ANTI JOIN (SELECT * FROM cand_b WHERE target_source = 'S2') c USING (source1_id, target_id)", "edges", "cand_b"),
    "duplicate_rows": _sql("SELECT content, count(*) AS n FROM reg GROUP BY 1 HAVING count(*) > 1", "reg"),
    "target_existence": _sql("SELECT source1_id, target_id FROM edges WHERE target_id NOT IN (SELECT entity_id FROM reg WHERE source = 'S2')", "edges"),
    "list_violations": _sql("""SELECT count(*) AS rows, count(*) FILTER (len(ids) = 0) AS empty_rows, count(*) FILTER (list_contains(ids, '')) AS empty_ids, count(*) FILTER (len(list_distinct(ids)) < len(ids)) AS repeated_ids,
      count(*) FILTER (len(list_filter(ids, lambda t: NOT (t LIKE 'S2-%' OR t LIKE 'S3-%'))) > 0) AS wrong_prefix, count(*) FILTER (len(list_filter(ids, lambda t: t LIKE 'S2-%')) > 8 OR len(list_filter(ids, lambda t: t LIKE 'S3-%')) > 8) AS over_cap,
      count(q) - count(DISTINCT q) AS repeated_queries, count(*) FILTER (q LIKE '%7') AS unknown_queries, CAST(0 AS BIGINT) AS missing_queries FROM lists""", "lists"),
    "bm25_word_topk": _sql("SELECT * FROM found_w", "found_w"),
    "bm25_views_topk": _sql("SELECT * FROM found_v", "found_v"),
    "rrf_fuse": _sql("SELECT * FROM fused", "fused"),
    "recall_at_k": _sql(f"SELECT view, k, CAST(sum(hit) AS BIGINT) AS hits, count(*) AS links, round(sum(hit) / CAST(count(*) AS DOUBLE), 9) AS recall FROM ({_CELL}) GROUP BY view, k", "owners", "found_v"),
    "target_argmax_match": _sql("SELECT target_id, rid, rrf FROM fused WHERE candidate_rank = 1 AND rrf >= 0.03::DOUBLE", "fused"),
    "target_sweep": _sql(f"""SELECT g.cap AS cap_per_target, g.threshold, round(avg({_FH}), 9) AS macro_f0_5, any_value(c.candidate_recall) AS candidate_recall FROM (SELECT * FROM {_values('cap', V.TARGET_CAPS)}, {_values('threshold', V.TARGET_THRESHOLDS)}) g
      CROSS JOIN otruth t JOIN trecall c ON c.cap = g.cap LEFT JOIN tbest p ON p.cap = g.cap AND p.threshold = g.threshold AND p.source1_id = t.source1_id GROUP BY g.cap, g.threshold""", "tbest", "otruth", "trecall"),
    "target_calibration": _sql("SELECT cap AS cap_per_target, threshold, macro_f0_5, audit_macro_f0_5, audit_source1_entities, truth_entities, matched_pairs, predicted_pairs, candidate_pairs, candidate_recall FROM tpoint JOIN trecall USING (cap)", "tpoint", "trecall"),
    "target_country_scores": _sql("SELECT c.country, round(c.f / c.n, 9) AS macro_f0_5 FROM tcells c JOIN tpoint USING (cap, threshold) WHERE NOT c.audit", "tcells", "tpoint"),
    "retrieval_audit": _sql(f"""SELECT country, view, k, CAST(sum(hit) AS BIGINT) AS hits, count(*) AS links, round(sum(hit) / CAST(count(*) AS DOUBLE), 9) AS recall FROM ({_CELL}) JOIN owners USING (target_id) JOIN reg ON entity_id = target_id
      WHERE CAST(('0x' || substr(md5(source1_id), 1, 8)) AS BIGINT) % 5 = 0 GROUP BY country, view, k""", "owners", "found_v", "reg"),
    "match_accounting": _sql("""SELECT (SELECT count(*) FROM s1) AS rows, (SELECT count(*) FROM s1) AS unique_rows, (SELECT count(*) FROM edges) AS matched_pairs, (SELECT count(*) FROM truth WHERE truth_count = 0) AS empty_rows,
      (SELECT count(*) FROM reg WHERE source = 'S2') AS targets_s2, CAST(0 AS BIGINT) AS targets_s3, CAST(0 AS BIGINT) AS repeated_rows, (SELECT count(*) FROM edges WHERE target_id LIKE 'S3-%') AS absent_targets,
      (SELECT count(*) FROM (SELECT row_number() OVER (ORDER BY entity_id) AS k, entity_id AS a FROM s1) FULL JOIN (SELECT row_number() OVER (ORDER BY entity_id) AS k, entity_id AS b FROM s1 WHERE entity_id NOT LIKE '%7') USING (k)
        WHERE a IS DISTINCT FROM b) AS misplaced""", "s1", "edges", "truth", "reg"),
    "target_sequence": _sql("SELECT entity_id, row_number() OVER (ORDER BY source, entity_id) - 1 AS seq FROM reg WHERE source <> 'S1'", "reg"),
    "sequence_coverage": _sql("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS least, count(*) - 1 AS most, count(*) AS different, true AS dense FROM reg WHERE source <> 'S1'", "reg"),
    "wide_set_features": _sql(_set_features(), "fusedv", "uterms"),
    "unicode_views": _sql(f"""SELECT entity_id, name, address, name AS roman_name, address AS roman_address FROM (SELECT entity_id, regexp_replace({_fold('business_name')}, '(?:(?:^| )(?:{'|'.join(V.LEGAL_SUFFIXES)}))+$', '') AS name,
      {_short(_fold('business_address'), V.ADDRESS_SHORT)} AS address FROM reg)""", "reg"),
    "split_crc32": _sql(f"SELECT entity_id, bucket, {_split('bucket', folds.COMPOSITE_SPLITS)} AS split FROM (SELECT entity_id, CAST({_crc('entity_id')} % 100 AS INTEGER) AS bucket FROM reg)", "reg"),
    "split_xxhash": _sql(f"""SELECT entity_id, bucket, {_split('bucket', folds.BASE_SPLITS)} AS split FROM (
      SELECT entity_id, CAST(((CASE WHEN h >= 9223372036854775808::UHUGEINT THEN h::HUGEINT - 18446744073709551616::HUGEINT ELSE h::HUGEINT END) % 100 + 100) % 100 AS INTEGER) AS bucket FROM ({_xx64('entity_id')}))""", "reg"),
    "sharded_roundtrip": _sql("SELECT entity_id, content FROM reg", "reg"),
    "fold_assignment_md5": _sql(f"SELECT entity_id AS target_id, source1_id AS owner, CAST({_MD5.format('coalesce(source1_id, entity_id)', 5)} AS INTEGER) AS fold FROM reg LEFT JOIN owners ON target_id = entity_id WHERE source <> 'S1'", "reg", "owners"),
    "parquet_roundtrip": _sql("SELECT entity_id, name AS norm_name, address AS norm_address FROM norm", "norm"),
    "tsv_roundtrip": _sql("SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS matched_entity_ids FROM s1 LEFT JOIN (SELECT source1_id, string_agg(target_id, ',' ORDER BY target_id) AS ids FROM edges GROUP BY 1) ON source1_id = entity_id", "s1", "edges"),
}
