"""Quality rules by repetition coverage: rolling hashes of several n-gram lengths, in numpy.

A text is repetitive when too many of its characters lie inside word n-grams, or inside lines, that it has already had:
first occurrences don't count, so one passage that a short text says twice is not yet repetition.
Every n-gram length has one rolling hash over the word hashes; the duplicated windows of all texts in a block are found
by one sort, and the characters they cover are counted once however many windows overlap.

Null and empty texts have no words and fail the base rule; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Block, blocks, hashed, mixed, map_arrow, sums

#: Largest share of word characters inside duplicated n-grams, by n-gram length in words.
COVERED = {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
#: Largest share of word characters inside lines that came before.
COVERED_BY_LINES = 0.30
#: Fewest words, and largest share of words in repeated windows of three words, of the base rule.
LEAST_WORDS, MOST_REPEATED = 50, 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_STEP = np.uint64(0x100000001B3)


def _repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which of these are not the first."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    again, later = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    again[order[1:][same]] = True
    later[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again, later


def _covered(at: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in one of the windows of ``width`` words that start at ``at``."""
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    return np.cumsum(change[:-1]) > 0


def measure(block: Block, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts for each text of a block; ``dup_chars_n``: characters inside n-grams of n words that came before."""
    data = block.data
    starts, ends, bounds = block.words()
    lead = np.cumsum(np.concatenate([[0], (data & 0xC0) != 0x80]))  # code points before each byte
    chars = lead[ends] - lead[starts]
    n = len(starts)
    text_of = np.repeat(np.arange(block.n), np.diff(bounds))
    own = mixed(text_of.astype(np.uint64) + np.uint64(1))
    h = hashed(data, starts, ends)
    last = bounds[1:][text_of] if n else np.zeros(0, np.int64)
    out = {"n_words": np.diff(bounds), "word_chars": sums(chars, bounds), "n_symbols": sums(_SYMBOL[data].astype(np.int64), block.offsets)}

    # Lines: cut at \n and at the texts' ends; a line's words all have the same number.
    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([block.offsets[:-1], breaks + 1]))
    line_ends = np.sort(np.concatenate([breaks, block.offsets[1:]]))
    line_text = np.sort(np.concatenate([np.arange(block.n), np.searchsorted(block.offsets, breaks, side="right") - 1]))
    words_before = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    has = words_before[1] > words_before[0]
    s, e, t = line_starts[has], line_ends[has], line_text[has]
    _, later = _repeated(hashed(data, s, e) ^ mixed(t.astype(np.uint64) + np.uint64(1)))
    out["n_dup_lines"] = np.bincount(t[later], minlength=block.n)
    total = np.concatenate([[0], np.cumsum(chars)])
    in_lines = (total[words_before[1]] - total[words_before[0]])[has]
    out["dup_line_chars"] = np.bincount(t[later], weights=in_lines[later], minlength=block.n).astype(np.int64)

    rolled, width = h.copy(), 1
    for size in sorted({3, *lengths}):
        while width < size:  # roll one word further
            rolled = rolled[:-1] * _STEP + h[width:]
            width += 1
        if not len(rolled):
            covered = np.zeros(n, dtype=bool)
        else:
            fits = np.flatnonzero(np.arange(len(rolled)) + size <= last[: len(rolled)])
            again, later = _repeated(mixed(rolled[fits]) ^ own[fits])
            covered = _covered(fits[later], size, n)
        if size == 3:
            repeated = _covered(fits[again], size, n) if len(rolled) else covered
            out["n_repeat_words"] = sums(repeated.astype(np.int64), bounds)
        if size in lengths:
            out[f"dup_chars_{size}"] = sums(np.where(covered, chars, 0), bounds)
    return out


def repetition_coverage(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    covered: dict[int, float] | None = None,
    covered_by_lines: float = COVERED_BY_LINES,
    least_words: int = LEAST_WORDS,
    most_repeated: float = MOST_REPEATED,
) -> DataFrame:
    """Measure repetition in every text and judge it.

    Returns the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, dup_chars_<n> for each
    n-gram length (5 to 10 words unless ``covered`` says otherwise; windows of 3 words give n_repeat_words), base_failed and
    kept. No shuffle: one Arrow pass over id and text. An empty table gives no rows; a very long text is one block of its own.
    """
    limits = dict(COVERED if covered is None else covered)
    lengths = tuple(sorted(limits))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counts = [*base, "dup_line_chars", *[f"dup_chars_{n}" for n in lengths]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {c: [] for c in counts}
            for block in blocks(batch.column(1)):
                for c, v in measure(block, lengths).items():
                    parts[c].append(v)
            got = [pa.array(np.concatenate(parts[c]) if parts[c] else np.zeros(0), pa.int64()) for c in counts]
            yield pa.RecordBatch.from_arrays([batch.column(0), *got], names=["id", *counts])

    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = map_arrow(docs, run, f"id {kind}, " + ", ".join(f"{c} long" for c in counts))
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") > F.lit(float(most_repeated)) * F.col("n_words"))
    over = F.col("dup_line_chars") > F.lit(float(covered_by_lines)) * F.col("word_chars")
    for n, share in limits.items():
        over = over | (F.col(f"dup_chars_{n}") > F.lit(float(share)) * F.col("word_chars"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~over)
    return out.withColumnRenamed("id", id_col)
