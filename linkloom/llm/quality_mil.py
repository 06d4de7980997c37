"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages, and only the bag has a label. Each passage is encoded from its words' shapes and hashed
words; a gated attention network gives passages their weights in the bag; the weighted representation is scored. Encoder,
attention and score are learned together, by gradient descent on the driver, from a bounded sample of labelled texts.
Every whole text is then scored in one Arrow pass, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Block, blocks, hashed, mixed, map_arrow

#: Words of a passage; hashed word features; units of the encoder and of the attention; steps and rate of descent.
PASSAGE, HASHES, UNITS, GATES, STEPS, RATE, SEED = 48, 16, 16, 8, 300, 0.02, 20

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>{}[]=\\^~_@"]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!?"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:"]] = True
FEATURES = 12 + HASHES


def passages(block: Block, passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a block, and the number of passages of each text: at least one, which may be empty."""
    data = block.data
    starts, ends, bounds = block.words()
    n_words = np.diff(bounds)
    count = np.maximum(1, -(-n_words // passage))
    owner = np.repeat(np.arange(block.n), count)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = bounds[:-1][owner] + k * passage
    edges = np.stack([first, np.minimum(first + passage, bounds[1:][owner])])
    x = np.zeros((len(owner), FEATURES))
    size = edges[1] - edges[0]
    n = np.maximum(1, size)

    def total(values):
        run = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return run[edges[1]] - run[edges[0]]

    def chars(mask):
        run = np.concatenate([[0], np.cumsum(mask[data])])
        return run[ends] - run[starts]

    if len(starts):
        h = hashed(data, starts, ends)
        length = ends - starts
        upper, lower, digit, symbol, mark, stop = (chars(m) for m in (_UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK, _STOP))
        part = np.repeat(np.arange(len(owner)), size)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (part[1:] == part[:-1])
        key = np.sort(h ^ mixed(part.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(h ^ mixed(part.astype(np.uint64) + np.uint64(1)), kind="stable")
        fresh = np.ones(len(h), bool)
        fresh[order[1:]] = key[1:] != key[:-1]
        wide = np.concatenate([[0], np.cumsum(data >= 0x80)])
        for f, v in enumerate([np.minimum(length, 40) / 10, (upper >= 2) & (lower == 0), symbol > 0, (length == 1) & (upper + lower + digit == 0), mark > 0, digit > 0, stop > 0, same, fresh, _UPPER[data[starts]], (wide[ends] - wide[starts]) / length]):
            x[:, f] = total(v) / n
        bucket = (h >> np.uint64(7)) % np.uint64(HASHES)
        for b in range(HASHES):
            x[:, 12 + b] = total(bucket == b) / n
    x[:, 11] = np.log1p(size) / 4
    return x, count


class Model:
    """Parameters of the encoder, the attention and the score; ``prior`` alone where nothing could be learned."""

    def __init__(self, prior: float, parameters: dict[str, np.ndarray] | None = None):
        self.prior, self.p = prior, parameters

    def scores(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        if self.p is None:
            return np.full(len(count), self.prior)
        return _forward(self.p, (x - self.p["mean"]) / self.p["scale"], count)[0]


def _forward(p, x, count):
    at = np.cumsum(count) - count
    h = np.tanh(x @ p["W"] + p["w"])
    v, u = np.tanh(h @ p["V"] + p["v"]), 1 / (1 + np.exp(-(h @ p["U"] + p["u"])))
    e = (v * u) @ p["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), count))
    weight = e / np.repeat(np.add.reduceat(e, at), count)
    z = np.add.reduceat(weight[:, None] * h, at)
    score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
    return score, (at, h, v, u, weight, z)


def fit(sample: list[tuple[str, int]], steps: int = STEPS, rate: float = RATE, seed: int = SEED) -> Model:
    """Learn from (text, label) pairs. With one label only, every score is that label's smoothed share."""
    y = np.array([label for _, label in sample], dtype=np.float64)
    prior = float((y.sum() + 1) / (len(y) + 2))
    if len(set(y)) < 2:
        return Model(prior)
    got = [passages(b) for b in blocks(pa.array([t for t, _ in sample], pa.string()))]
    x, count = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
    rng = np.random.default_rng(seed)
    p = {"mean": x.mean(0), "scale": x.std(0) + 1e-6}
    x = (x - p["mean"]) / p["scale"]
    shape = {"W": (FEATURES, UNITS), "w": (UNITS,), "V": (UNITS, GATES), "v": (GATES,), "U": (UNITS, GATES), "u": (GATES,), "a": (GATES,), "c": (UNITS,), "b": ()}
    p |= {k: rng.normal(0, 0.3, s) if k.isupper() or k in "ac" else np.zeros(s) for k, s in shape.items()}
    p["b"] = np.array(np.log(prior / (1 - prior)))
    m, s = {k: np.zeros(v) for k, v in shape.items()}, {k: np.zeros(v) for k, v in shape.items()}
    for t in range(1, steps + 1):
        score, (at, h, v, u, weight, z) = _forward(p, x, count)
        d = (score - y) / len(y)
        g = {"c": z.T @ d, "b": d.sum()}
        dz = np.repeat(d[:, None] * p["c"], count, axis=0)
        dw = (dz * h).sum(1)
        de = weight * (dw - np.repeat(np.add.reduceat(weight * dw, at), count))
        g["a"] = (v * u).T @ de
        dv, du = de[:, None] * p["a"] * u * (1 - v**2), de[:, None] * p["a"] * v * u * (1 - u)
        g |= {"V": h.T @ dv, "v": dv.sum(0), "U": h.T @ du, "u": du.sum(0)}
        dh = (weight[:, None] * dz + dv @ p["V"].T + du @ p["U"].T) * (1 - h**2)
        g |= {"W": x.T @ dh + 1e-4 * p["W"], "w": dh.sum(0)}
        for k in shape:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            s[k] = 0.99 * s[k] + 0.01 * g[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-8)
    return Model(prior, p)


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Score every whole text. Returns the id, the columns in ``keep``, score and predicted (score >= 0.5).

    A null or empty text is a bag of one empty passage and gets the score that the model gives that. Repeated rows give
    repeated results, and equal texts equal scores, so there are no ties to break. A very long text is a bag of many passages,
    all of them read. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    columns = [id_col, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [model.scores(*passages(b)) for b in blocks(batch.column(batch.num_columns - 1))]
            score = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64())], names=[*[f"c{k}" for k in range(len(columns))], "score"])

    kinds = [docs.schema[c].dataType.simpleString() for c in columns]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)], F.col(f"`{text_col}`").cast("string").alias("text"))
    out = map_arrow(rows, run, ", ".join([*[f"c{k} {kind}" for k, kind in enumerate(kinds)], "score double"]))
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)], "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
