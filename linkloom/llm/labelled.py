"""Bounded samples of labelled documents, on which the driver fits classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the sample, and characters of the longest text in it.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """(text, label) of at most ``rows`` documents whose id meets ``train``, by a hash of the id; equal texts once.

    Labels other than 0 and 1 and null texts don't count; texts longer than ``chars`` are left out of the sample. An id with
    both labels has label 1; of several texts with one id the first by code point is taken.
    """
    own = labels.filter(train & F.col(f"`{label}`").isin(0, 1)).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
    chosen = own.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(rows)  # two short columns, at most ``rows`` rows
    text = F.col(f"`{text_col}`").cast("string")
    found = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).filter(F.char_length("text") <= chars).join(F.broadcast(chosen), "id")
    by_text = {}
    for r in sorted(found.groupBy("id", "y").agg(F.min("text").alias("text")).collect(), key=lambda r: (str(r["id"]), r["text"], r["y"])):
        by_text.setdefault(r["text"], r["y"])
    return list(by_text.items())
