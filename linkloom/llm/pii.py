"""Personal data by patterns, and terms that give it away by information-theoretic sanitisation, in DataFrame functions only.

Emails, IP addresses, cards and phone numbers are found by pattern and check: the protected entities. A term reveals an
entity if, over the whole corpus, seeing the term says much about the entity: with p(e|t) the share of the texts with the
term that name the entity, and p(e) the entity's share of all words, log2(p(e|t) / p(e)) bits. A term that gives nearly
all of the entity's own -log2 p(e) bits is removed, one that gives a good part of them is generalised, wherever it stands
in a text that names the entity.

Small counts are smoothed by absolute discounting: p(e|t) is multiplied by (k - DISCOUNT) / k for k pieces of evidence.
Texts in which the entity stands between the same words are copies and one piece; one piece alone is next to no evidence,
or each rare word of a text would seem to reveal whatever stands in it. Entities that can't pass for want of pieces or of
bits are left out before terms are counted, which changes no result.

Only texts with a digit or an @ are searched. Texts' terms are pre-aggregated, so an entity or a term that a third of all
rows have is a few rows of counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

#: Kinds in their order, with patterns that match what the contract's do, leftmost and non-overlapping, in linear time:
#: possessive, and starting only where a run of the first class starts or where the last match ended.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){11,}+",  # shorter runs of digits can't be cards: long texts may be full of them
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PLACES = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalise": "[TERM]", "remove": ""}
#: Code points on either side of an entity that tell copies; what is taken from each count of evidence; shares of an
#: entity's bits from which a term is generalised or removed; least bits.
REACH, DISCOUNT, GENERALISE, REMOVE, LEAST_BITS = 48, 0.95, 0.92, 0.97, 8.0
_TERM = r"\p{L}[\p{L}\p{M}\p{N}'’-]{2,}+"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=.)", "").try_cast("int") <= 255, F.lit(False))
        return F.forall(F.split(v, r"\."), part)
    if kind == "card":
        return F.length(_digits(v)).between(12, 19) & F.call_function("luhn_check", _digits(v))
    if kind == "phone":
        return F.length(_digits(v)).between(9, 15)
    return F.lit(True)


_MATCH = "struct<start:int,end:int,value:string,near:bigint>"
_SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string,near:bigint>"
#: Items of an array that are folded together: what a fold has appended is copied with each item of its chunk, no further.
CHUNK = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is found once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def _fold(items: Column, kind: str, step) -> Column:
    """The array that ``step`` appends to over all items: it takes and gives (at, out), of which at goes on from item to item."""
    none = F.array().cast(f"array<{kind}>")

    def of_chunk(a, chunk):
        own = F.aggregate(chunk, F.struct(a["at"].alias("at"), none.alias("out")), step)
        return _let(own, lambda r: F.struct(r["at"].alias("at"), F.array_append(a["out"], r["out"]).alias("out")))

    def whole(p):
        last = F.greatest(F.floor((F.size(p) - 1) / CHUNK).cast("int"), F.lit(0))
        chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(p, c * CHUNK + 1, F.lit(CHUNK)))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.aggregate(chunks, zero, of_chunk, lambda a: F.flatten(a["out"]))

    return _let(items, whole)


def _found(text: Column, pattern: str) -> Column:
    """Array of (start, end, value, near) of a pattern's matches: what lies between matches gives their places and what they stand
    between, of which ``near`` is a hash."""
    values, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def around(p):
        pairs = F.zip_with(p["v"], p["g"], lambda v, g: F.struct(v.alias("v"), g.alias("g")))  # one gap more than values
        return F.zip_with(pairs, F.slice(p["g"], F.lit(2), F.size(p["g"])), lambda x, h: F.struct(x["v"].alias("v"), x["g"].alias("g"), h.alias("h")))

    def step(a, x):
        start = a["at"] + F.char_length(x["g"])
        end = start + F.char_length(x["v"])
        near = F.xxhash64(F.substring(x["g"], -REACH, REACH), F.substring(x["h"], 1, REACH))
        match = F.struct(start.alias("start"), end.alias("end"), x["v"].alias("value"), near.alias("near"))
        return F.when(x["v"].isNull(), a).otherwise(F.struct(end.alias("at"), F.array_append(a["out"], match).alias("out")))

    return _fold(_let(F.struct(values.alias("v"), gaps.alias("g")), around), _MATCH, step)


def _of_kind(text: Column, rank: int, kind: str) -> Column:
    some = F.filter(_found(text, KINDS[kind]), lambda x: _valid(kind, x["value"]))
    return F.transform(some, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"), x["near"].alias("near")))


def base_spans(text: Column) -> Column:
    """Array of (start, rank, end, kind, value, near), by start, then kind."""
    kinds = [_of_kind(text, rank, kind) for rank, kind in enumerate(KINDS)]
    return F.when(text.rlike("[0-9@]"), F.array_sort(F.concat(*kinds))).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _written(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def _terms(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), lambda t: F.lower(t)))


def _named(held: DataFrame) -> DataFrame:
    """A row per text and entity: key, entity, window (the hash of what the entity stands between, up to the next of its kind), times."""
    value = F.when(F.col("e.kind").isin("card", "phone"), _digits(F.col("e.value"))).otherwise(F.lower("e.value"))
    rows = held.select("key", F.explode("base").alias("e"))  # a row has its own match only, no text
    rows = rows.select("key", F.concat_ws(":", "e.kind", value).alias("entity"), F.col("e.near").alias("window"))
    return rows.groupBy("key", "entity").agg(F.min("window").alias("window"), F.count(F.lit(1)).alias("times"))


def revealing_terms(docs: DataFrame, held: DataFrame, named: DataFrame, discount: float, generalise: float, remove: float, least_bits: float) -> DataFrame | None:
    """entity, term, action of terms over the thresholds; None if no entity has enough evidence.

    ``docs`` has the column text; every row counts. Bits and shares are rounded to 9 digits.
    """
    total = max(docs.agg(F.sum(F.regexp_count("text", F.lit(WORD))).cast("double")).first()[0] or 1.0, 2.0)
    p_e = F.least(F.col("mentions") / F.lit(total), F.lit(0.5))
    known = named.groupBy("entity", "window").agg(F.sum("times").alias("times"))
    known = known.groupBy("entity").agg(F.sum("times").alias("mentions"), F.count(F.lit(1)).alias("pieces"))
    # With all texts of a term naming the entity: the bits are -log2 p(e) and what the discount takes.
    most = -F.log2(p_e) + F.log2((F.col("pieces") - F.lit(discount)) / F.col("pieces"))
    known = cut(known.filter((most >= least_bits - 1e-6) & (most >= -F.log2(p_e) * generalise - 1e-6)).select("entity", "mentions"))
    if known.isEmpty():
        return None
    near = cut(named.join(known, "entity").select("key", "entity", "window"))
    words = held.join(near.select("key").distinct(), "key", "left_semi").select("key", F.explode(_terms(F.col("text"))).alias("term"))
    joint = near.join(words, "key").groupBy("entity", "term", "window").agg(F.count(F.lit(1)).alias("n"))
    joint = joint.groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count(F.lit(1)).alias("pieces"))
    # Counted before they are joined: a task sends each of its terms once.
    times = docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("times"))
    rows = joint.join(times, "term").join(known, "entity")
    p_t = F.col("together") / F.greatest("times", "together") * (F.col("pieces") - F.lit(discount)) / F.col("pieces")
    rows = rows.withColumns({"bits": F.round(F.log2(p_t / p_e), 9), "own": F.round(-F.log2(p_e), 9)})
    share = F.col("bits") / F.col("own")
    rows = rows.filter((F.col("bits") >= least_bits) & (share >= generalise))
    return rows.select("entity", "term", F.when(share >= remove, "remove").otherwise("generalise").alias("action"))


def _occurrences(held: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, start, end, action of every occurrence of a text's wanted terms (key, term, action).

    Places are sums over the pieces of one text, taken in order, so a long text costs no more than its length.
    """
    text = F.col("text")
    values, gaps = F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), F.split(text, _TERM, -1)
    some = held.join(wanted.select("key").distinct(), "key", "left_semi")
    pieces = some.select("key", F.posexplode(F.zip_with(values, gaps, lambda v, g: F.struct(v.alias("v"), F.char_length(g).alias("gap")))).alias("at", "x"))
    pieces = pieces.select("key", "at", F.col("x.v").alias("v"), (F.col("x.gap") + F.coalesce(F.char_length("x.v"), F.lit(0))).alias("n"))
    pieces = pieces.withColumn("end", F.sum("n").over(Window.partitionBy("key").orderBy("at")).cast("int")).filter("v is not null")
    found = pieces.select("key", F.lower("v").alias("term"), (F.col("end") - F.char_length("v")).alias("start"), "end")
    return found.join(wanted, ["key", "term"]).select("key", "start", "end", "action")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", discount: float = DISCOUNT, generalise: float = GENERALISE, remove: float = REMOVE, least_bits: float = LEAST_BITS) -> tuple[DataFrame, DataFrame | None]:
    """The base spans of all rows, and the further spans of terms.

    The first result has the columns of ``docs`` as the struct ``row``, id, text and base: an array of (start, rank, end,
    kind, value, near). The second has of, print and more (spans of kind "term", rank 4, the action as value) per text with such
    terms, or is None. A term that several entities share is removed if one of them asks for it. Null and empty texts have
    no spans; repeated rows have equal spans.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    held = rows.filter(F.col("text").rlike("[0-9@]")).withColumn("base", base_spans(F.col("text"))).select("id", _print(), "text", "base").filter(F.size("base") > 0)
    held = cut(held.withColumn("key", F.monotonically_increasing_id()))
    named = cut(_named(held))
    terms = revealing_terms(rows.select("text"), held, named, discount, generalise, remove, least_bits)
    rows = rows.withColumn("base", base_spans(F.col("text")))
    if terms is None:
        return rows, None
    wanted = cut(named.join(terms, "entity").groupBy("key", "term").agg(F.max("action").alias("action")))
    more = _occurrences(held, wanted).join(held.select("key", "id", "print", "base"), "key")
    more = more.filter(~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"])))
    span = F.struct(F.col("start").alias("start"), F.lit(len(KINDS)).alias("rank"), F.col("end").alias("end"), F.lit("term").alias("kind"), F.col("action").alias("value"), F.lit(0).cast("long").alias("near"))
    return rows, cut(more.groupBy(F.col("id").alias("of"), "print").agg(F.collect_set(span).alias("more")))  # spans of one text


def _print() -> Column:
    """A digest of the text: with the id it names a row, up to equal rows."""
    return F.xxhash64("text").alias("print")


def _with_terms(rows: DataFrame, more: DataFrame | None) -> DataFrame:
    """Rows with id, print and base: adds ``spans``, by start, then kind."""
    if more is None:
        return rows.withColumn("spans", F.col("base"))
    columns = rows.columns
    rows = rows.join(more.withColumnRenamed("print", "of_print"), F.col("id").eqNullSafe(F.col("of")) & (F.col("print") == F.col("of_print")), "left")
    return rows.select(*columns, F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more"))).alias("spans"))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def pii_report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""
    found, more = find_pii(docs, id_col=id_col, **options)
    found = _with_terms(found.select("id", _print(), "base"), more)  # texts stay where they are
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(F.col("id").alias(id_col), *counts, F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def sanitise(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind's name; n_chars is counted anew. Null texts stay null."""
    found, more = find_pii(docs, text_col=text_col, **options)
    found = found.withColumn("print", _print())
    some = F.size("base") > 0
    # Only texts with spans move; terms stand in no others.
    found = found.filter(~some).withColumn("spans", F.col("base")).unionByName(_with_terms(found.filter(some), more))
    name = lambda s: F.coalesce(*[F.when((s["kind"] == k) | (s["value"] == k), F.lit(p)) for k, p in PLACES.items()], F.lit(""))

    def apart(a, s):  # of spans that overlap the first one counts
        piece = F.struct(a["at"].alias("first"), s["start"].alias("last"), name(s).alias("name"))
        return F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(s["end"].alias("at"), F.array_append(a["out"], piece).alias("out")))

    def written(x):  # pieces of an array of letters: a place in a text is found only by counting from its start
        chars, kept = x["c"], lambda a, b: F.array_join(F.slice(x["c"], a + 1, b - a), "")
        parts = F.transform(x["p"], lambda p: F.concat(kept(p["first"], p["last"]), p["name"]))
        return F.concat(F.array_join(parts, ""), kept(F.array_max(F.transform(x["s"], lambda s: s["end"])), F.size(chars)))

    pieces = _fold(F.col("spans"), "struct<first:int,last:int,name:string>", apart)
    done = _let(F.struct(F.split("text", "").alias("c"), pieces.alias("p"), F.col("spans").alias("s")), written)
    clean = F.when(F.col(f"row.`{text_col}`").isNull(), F.lit(None).cast("string")).when(F.size("spans") == 0, F.col("text")).otherwise(done)
    found = found.withColumn("clean", clean)
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {text_col: F.col("clean")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.size("spans") == 0, F.col("row.n_chars")).otherwise(F.char_length("clean")).cast(docs.schema["n_chars"].dataType)
    return found.select(*[v.alias(c) for c, v in columns.items()])
