"""Mix sources to target weights by capped water-filling, in DataFrame functions only.

Every source has a weight and may be repeated at most ``max_epochs`` times. The total is dealt out by weight; what a
source can't take is dealt to the others by weight until none is above its cap. That fixed point is
``min(weight * level, cap)``, and sources sorted by cap / weight give the level from two running sums.

Inside a source whole repetitions are taken of every document; the rest of the target goes, once more, to documents in
the order of a seeded hash, the last of them in part. The running sum over that order never puts a source in one task:
the hash's first digits make buckets, buckets are summed first, and only a bucket's own documents are ordered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

WEIGHTS, SHARE, MAX_EPOCHS, SEED = (5, 2, 1), 1.5, 2, "mix-1"
#: Hexadecimal digits of the hash that name a bucket: 4096 of them a source.
BUCKET_DIGITS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_filling(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to one row per source with columns source_key, source, source_size.

    Sources are ordered by code point, null last; weights repeat in that order. A source without words has target 0.
    The table has one row per source: its windows order sources, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    t = sources.withColumn("weight", w.cast("double")).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    t = t.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    total = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy()).cast("double")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level_here", (F.least(total, F.lit(float(max_epochs)) * F.sum("source_size").over(Window.partitionBy())) - before) / left)
    # Of the sources that it leaves under their caps the first one's level holds; those after it give less.
    level = F.max(F.when(F.col("level_here") <= F.col("ratio"), F.col("level_here"))).over(Window.partitionBy())
    return t.withColumn("target", F.coalesce(F.least(F.col("weight") * level, F.col("cap")), F.col("cap"))).select("source_key", "source_size", "target")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Words that the mix takes from every document.

    Returns id, size, source_size, target, taken. taken is the size times the whole repetitions, plus a whole size for
    documents that the seeded order reaches, plus a part of one document per source. Null texts and empty texts have
    size 0; null sources form one source; equal ids (repeated rows) are ordered by size, and equal rows are exchangeable.
    """
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source")))
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))
    sizes = cut(
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"))
        .withColumns({"source_key": key, "digest": digest})
        .withColumn("bucket", F.substring("digest", 1, bucket_digits))
    )
    buckets = sizes.groupBy("source_key", "bucket").agg(F.max("source").alias("source"), F.sum("size").alias("bucket_size"))
    sources = buckets.groupBy("source_key").agg(F.max("source").alias("source"), F.sum("bucket_size").alias("source_size"))
    targets = water_filling(sources, weights, share, max_epochs)
    ahead = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0))).select("source_key", "bucket", "ahead")
    buckets = buckets.join(targets, "source_key")
    inside = Window.partitionBy("source_key", "bucket").orderBy("digest", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = sizes.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(buckets, ["source_key", "bucket"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target")).cast("long") - whole * F.col("source_size") - F.col("ahead") - F.col("inside")
    taken = whole * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, the last time in part.

    A part is the text up to the end of its last word taken, white space kept. n_chars is counted anew. Returns the columns of ``docs``.
    Rows without words are never taken. Rows of one id and size share what is taken of them evenly, by a digest of the row, so
    repeated rows are exchangeable and reruns agree; rows without an id are of one id. An empty table stays empty.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    taken = mix_sources(docs, **options).groupBy(F.col(f"`{id_col}`").alias("taken_id"), F.col("size").alias("taken_size")).agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("alike"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), n_words(F.col(f"`{text_col}`")).alias("size"))
    rows = rows.join(taken, F.col("id").eqNullSafe(F.col("taken_id")) & (F.col("size") == F.col("taken_size")))
    # Rows that share id and size share what was taken from them: each gets an even part, and the first ones a word more, so none is lost.
    order = Window.partitionBy("id", "size").orderBy(F.xxhash64("text"), F.to_json("row"))
    again = rows.filter("alike > 1").withColumn("nth", F.row_number().over(order))
    rows = rows.filter("alike = 1").withColumn("nth", F.lit(1)).unionByName(again)
    more = (F.col("nth") <= F.col("taken") % F.col("alike")).cast("long")
    each, none = F.floor(F.col("taken") / F.col("alike")) + more, F.array().cast("array<int>")
    times = F.when(F.col("size") > 0, F.floor(each / F.col("size"))).otherwise(F.lit(0)).cast("int")
    part = F.when(F.col("size") > 0, each - times * F.col("size")).otherwise(F.lit(0)).cast("int")
    copies = F.concat(F.when(times > 0, F.array_repeat(F.lit(-1), times)).otherwise(none), F.when(part > 0, F.array(part)).otherwise(none))
    rows = rows.withColumn("copy", F.explode(copies))
    pieces = F.regexp_extract_all(F.col("text"), F.lit("[\\x20\\x09-\\x0D]*+" + WORD + "+"), F.lit(0))
    text = F.when(F.col("copy") < 0, F.col("text")).otherwise(F.array_join(F.slice(pieces, 1, F.greatest(F.col("copy"), F.lit(1))), ""))
    rows = rows.withColumn("mixed", text)
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {text_col: F.col("mixed")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("mixed").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[v.alias(c) for c, v in columns.items()])
