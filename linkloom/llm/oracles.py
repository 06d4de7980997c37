"""DuckDB SQL of the corpus queries that SQL can express, written from the definitions."""

from __future__ import annotations

from . import mixing, repetition

_WORDS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"


def _covered(n: int) -> str:
    """Characters of the words in windows of n words that came before in their text."""
    return f"""SELECT w.doc_id, sum(length(w.ws[p.k])) AS chars FROM w JOIN (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS k FROM (
      SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS nth FROM (SELECT doc_id, i, list_slice(ws, i, i + {n - 1}) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM w))) WHERE nth > 1) p
      USING (doc_id) GROUP BY w.doc_id"""


def _repetition() -> str:
    limits = repetition.COVERED
    parts = [f"c{n} AS ({_covered(n)})" for n in limits]
    joins = " ".join(f"LEFT JOIN c{n} ON c{n}.doc_id = w.doc_id" for n in limits)
    columns = ", ".join(f"CAST(coalesce(c{n}.chars, 0) AS BIGINT) AS dup_chars_{n}" for n in limits)
    over = " OR ".join([f"dup_line_chars > CAST({repetition.COVERED_BY_LINES} AS DOUBLE) * word_chars", *[f"dup_chars_{n} > CAST({x} AS DOUBLE) * word_chars" for n, x in limits.items()]])
    return f"""WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS ws FROM documents),
    tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM (SELECT doc_id, i, list_slice(ws, i, i + 2) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))),
    rep AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS k FROM tri WHERE times > 1) GROUP BY 1),
    lines AS (SELECT doc_id, line, {_WORDS.format('line')} AS lw, row_number() OVER (PARTITION BY doc_id, line) AS nth FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)),
    dup AS (SELECT doc_id, count(*) AS n, sum(length(array_to_string(lw, ''))) AS chars FROM lines WHERE nth > 1 AND len(lw) > 0 GROUP BY 1), {', '.join(parts)},
    m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(dup.chars, 0) AS BIGINT) AS dup_line_chars, {columns}
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN dup ON dup.doc_id = w.doc_id {joins}),
    b AS (SELECT *, (n_words < {repetition.LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
    SELECT *, (NOT base_failed AND NOT ({over})) AS kept FROM b"""


_JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: list_slice(ws, i, i + 4)) WHEN len(ws) > 0 THEN [ws] ELSE [] END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(doc_id, reached) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
    SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY 1) c USING (doc_id)"""

_MIX = f"""WITH d AS (SELECT doc_id, source, CAST(len({_WORDS.format('text')}) AS BIGINT) AS size, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
    w AS (SELECT *, CAST([{', '.join(map(str, mixing.WEIGHTS))}][(k - 1) % {len(mixing.WEIGHTS)} + 1] AS DOUBLE) AS weight, CAST(source_size * {mixing.MAX_EPOCHS} AS DOUBLE) AS cap FROM s),
    o AS (SELECT *, (CAST({mixing.SHARE} AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
    t AS (SELECT source, source_size, least(weight * (SELECT max(level) FROM o WHERE level <= cap / weight), cap) AS target FROM o),
    x AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS BIGINT) AS whole,
      CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - whole * source_size - ahead)) AS BIGINT) AS taken FROM x"""

ORACLES = {"op1_repetition_coverage": _repetition(), "op4_jaccard_join": _JACCARD, "op5_mix_sources": _MIX}
