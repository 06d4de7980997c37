"""Pack tokenised documents into fixed windows by best-fit decreasing.

Documents longer than a window are first cut into full windows; what is left of each, longest first, goes to the open
window with the least room that still holds it. A segment tree indexed by remaining capacity finds that window.

Every task packs the rows that it reads, in blocks of a bounded number of pieces, so nothing is shuffled, only lengths
are held, and a lost executor's tasks are simply run again with the same result. A block leaves few windows unfilled.
"""

from __future__ import annotations

import base64
import functools
import gc
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

WINDOW, END_ID = 2048, 1
#: Pieces that are packed together.
BLOCK_PIECES = 100_000
VOCABULARY = "byte_bpe_50k"
#: White space in a row from which a text goes to the slower encoder, which takes such runs in linear time.
LONG_RUN = re.compile(r"\s{200}")

_encoders: dict[str, object] = {}


def encoder(folder: str | None = None, name: str = VOCABULARY):
    """A function from texts to lists of ids; loaded once, until :func:`forget_encoders`, and the slower one when a text first needs it.

    The ids are those of ``<name>.json`` in the ``tokenizers`` library as it loads, special strings in a text included:
    they become their own ids. The same vocabulary is kept as ranks, from which ``tiktoken`` makes the same ids in a fifth
    of the time; texts that its pattern engine might refuse go to ``tokenizers``.
    """
    import os

    import public_tokenizers
    import tiktoken

    at = (lambda f: os.path.join(folder, f)) if folder else public_tokenizers.path
    key = f"{folder}/{name}"
    if key not in _encoders:
        with open(at(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(at(f"{name}.json"), encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

        @functools.cache
        def slow():
            from tokenizers import Tokenizer

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            return Tokenizer.from_file(at(f"{name}.json"))

        def encode(text: str) -> list[int]:
            if not LONG_RUN.search(text):
                try:
                    return fast.encode(text, allowed_special="all")
                except ValueError:  # the pattern engine gave up
                    pass
            return slow().encode(text, add_special_tokens=False).ids

        _encoders[key] = encode
    return _encoders[key]


def forget_encoders() -> None:
    """Let loaded vocabularies go: workers outlive their tasks, and other stages' tasks run in them."""
    _encoders.clear()
    gc.collect()


class Capacities:
    """Open windows by remaining capacity: a segment tree whose nodes count the windows below them."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window_id: int) -> None:
        self.open[capacity].append(window_id)
        at = capacity + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove the window with the least capacity of at least ``length``: (capacity, window)."""
        at, count = length + self.size, self.count
        while not count[at]:  # climb until a subtree to the right has a window
            while at & 1:
                at >>= 1
            if at <= 1:
                return None
            at += 1
            if at & (at - 1) == 0:  # past the last leaf
                return None
        while at < self.size:
            at <<= 1
            at += not count[at]
        capacity = at - self.size
        while at:
            count[at] -= 1
            at >>= 1
        return capacity, self.open[capacity].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window number and offset of every piece, and the number of windows. Longest first; ties in the given order."""
    to, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free, n = Capacities(window), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[k])
        found = free.take(length)
        if found is None:
            found, n = (window, n), n + 1
        capacity, to[k] = found
        offset[k] = window - capacity
        if capacity > length:
            free.add(capacity - length, found[1])
    return to, offset, n


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    tokenizers_dir: str | None = None,
    block_pieces: int = BLOCK_PIECES,
) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``window`` tokens.

    Returns per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is the
    end id alone. Repeated rows are packed each. A sequence_id names the task in its upper half. An empty table has no pieces.
    """
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizers_dir)
        sequence = TaskContext.get().partitionId() << 32

        def packed(ids, rows):
            nonlocal sequence
            start, length, crc, total = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            to, offset, n = best_fit(length, window)
            out = [pa.array(ids), *[pa.array(x) for x in (start, length, crc, total, to + sequence, offset)]]
            sequence += n
            return pa.RecordBatch.from_arrays([x.cast(kind) if (kind := out_types[k]) != x.type else x for k, x in enumerate(out)], names=names)

        ids: list = []
        rows: list[tuple[int, int, int, int]] = []
        out_types = None
        for batch in batches:
            out_types = out_types or [batch.schema.field(0).type, *[pa.int64()] * 6]
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                tokens = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                for start in range(0, len(tokens), window):
                    piece = tokens[start : start + window]
                    ids.append(doc.as_py())
                    rows.append((start, len(piece), zlib.crc32(piece.tobytes()), len(tokens)))
                if len(rows) >= block_pieces:
                    yield packed(ids, rows)
                    ids, rows = [], []
        if rows:
            yield packed(ids, rows)

    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def packed_and_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            forget_encoders()

    out = map_arrow(docs, packed_and_left, f"id {kind}, " + ", ".join(f"`{c}` long" for c in names[1:]))
    return out.withColumnRenamed("id", id_col)
