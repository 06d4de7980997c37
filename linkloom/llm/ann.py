"""Approximate nearest neighbours by stable projections and kd-trees.

Gaussian projections to a few dimensions keep distances in the mean: the squared projected distance over the squared true
one follows a chi-square law. Largest inner products become smallest distances by one further coordinate that gives every
vector the same norm.

One kd-tree of cells, split at the medians of a bounded sample, covers the projected space; every vector lies in one cell and
is shuffled to it. A query goes to cells in order of projected distance, in rounds: the nearest cell, then the next four, the
next sixteen and so on, until the test holds: with the given confidence, a point nearer than the k-th best found so far would
have had a smaller projected distance than all points of the cells that are left. Inside a cell a kd-tree of its own gives
leaves, and the same test says which leaves a query still verifies on the original vectors.

So a query travels to the cells that its own test leaves, and a vector once in each round in which its cell is asked. A cell's vectors are held in blocks of
bounded size while queries stream by; cells that very many queries ask are dealt to several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_arrow

K, DIMENSIONS, CONFIDENCE, LEAF, SEED = 20, 8, 0.95, 128, 11
#: Vectors of a cell, about, and of a block at most, about; most cells; vectors of the sample that says where cells are split.
CELL, MOST_CELLS, SAMPLE = 4096, 4096, 16_384
#: Queries that ask a block and are compared together; queries of a block in one task.
TOGETHER, ASKERS = 256, 65_536


def chi_square_cdf(x: np.ndarray, m: int) -> np.ndarray:
    """Distribution function of chi-square with an even number m of degrees of freedom: 1 - exp(-x/2) * sum (x/2)^i / i!."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(np.array(mid), m) < p else (low, mid)
    return high


class KdTree:
    """Median splits of the widest dimension down to leaves; leaves' bounding boxes give lower bounds of distances."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.bounds = [0]
        low, high = [], []
        stack = [(0, len(points))]
        while stack:
            first, last = stack.pop()
            own = points[self.order[first:last]]
            lo, hi = own.min(0), own.max(0)
            if last - first <= leaf:
                low.append(lo)
                high.append(hi)
                self.bounds.append(last)
                continue
            half = (last - first) // 2
            part = np.argpartition(own[:, int(np.argmax(hi - lo))], half)
            self.order[first:last] = self.order[first:last][part]
            stack += [(first + half, last), (first, first + half)]
        self.low, self.high, self.bounds = np.array(low), np.array(high), np.array(self.bounds)

    def leaf_distances(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance of every query to every leaf's box."""
        out = np.zeros((len(queries), len(self.low)))
        for d in range(queries.shape[1]):
            q = queries[:, d : d + 1]
            gap = np.maximum(self.low[:, d] - q, 0) + np.maximum(q - self.high[:, d], 0)
            out += gap * gap
        return out


class Cells:
    """Median splits of a sample's widest dimension: the regions cover all of the projected space."""

    def __init__(self, points: np.ndarray, n: int):
        self.nodes: list[tuple[int, float, int, int]] = []  # dimension, threshold, then nodes below and above; a cell is -1 - its number
        self.n = 0
        self.root = self._grow(points, n)

    def _grow(self, points: np.ndarray, n: int) -> int:
        spread = points.max(0) - points.min(0) if len(points) else np.zeros(1)
        d = int(np.argmax(spread))
        if n < 2 or not spread[d] > 0:
            self.n += 1
            return -self.n
        share = (n // 2) / n
        at = float(np.quantile(points[:, d], share))
        at = at if (points[:, d] < at).any() else float(np.nextafter(points[:, d].min(), np.inf))
        low = points[:, d] < at
        k = len(self.nodes)
        self.nodes.append((d, at, 0, 0))
        self.nodes[k] = (d, at, self._grow(points[low], n // 2), self._grow(points[~low], n - n // 2))
        return k

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of every point."""
        out = np.full(len(points), self.root)
        d, at, low, high = (np.array(x) for x in zip(*self.nodes, strict=True)) if self.nodes else (np.zeros(0, int),) * 4
        while len(inner := np.flatnonzero(out >= 0)):
            node = out[inner]
            out[inner] = np.where(points[inner, d[node]] < at[node], low[node], high[node])
        return -1 - out


class Space:
    """How vectors are projected: all tasks are told the same."""

    def __init__(self, length: int, top: float, dimensions: int, seed: int):
        self.length, self.top = length, top
        self.project = np.random.default_rng(seed).normal(size=(length + 1, dimensions))

    def vectors(self, column: pa.Array) -> np.ndarray:
        """Rows of one length; shorter vectors end in zeros."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        if (sizes == self.length).all():
            return flat.reshape(-1, self.length)
        out = np.zeros((len(sizes), self.length))
        out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        return out

    def points(self, v: np.ndarray) -> np.ndarray:
        """Candidates' projections, of equal norms before."""
        lifted = np.sqrt(np.maximum(0, self.top * self.top - (v * v).sum(1)))
        return np.c_[v, lifted] @ self.project

    def asked(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries' projections and norms. A query's length doesn't change its order of inner products: it is scaled to the common norm."""
        norms = np.sqrt((q * q).sum(1))
        return (q * (self.top / norms)[:, None]) @ self.project[:-1], norms

    def distance(self, score: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Squared distances behind inner products."""
        return np.maximum(0, 2 * self.top * self.top - 2 * score * self.top / norms)


def exact(q: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, summed in order of components."""
    return np.add.accumulate(vectors * q, axis=1)[:, -1]


class Block:
    """A cell's block of vectors, under a kd-tree of their projections."""

    def __init__(self, space: Space, ids: np.ndarray, vectors: np.ndarray, leaf: int):
        order = np.argsort(ids, kind="stable")
        self.space, ids, vectors = space, ids[order], vectors[order]
        self.tree = KdTree(space.points(vectors), leaf)
        self.ids, self.vectors = ids[self.tree.order], vectors[self.tree.order]
        self.slack = 1e-10 * max(1.0, space.top)

    def best(self, query_ids: np.ndarray, q: np.ndarray, least: np.ndarray, k: int, limit: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, scores) of each query's k best in the block that reach ``least``, its k-th best so far."""
        points, norms = self.space.asked(q)
        with np.errstate(invalid="ignore"):
            reach = np.where(np.isfinite(least), limit * self.space.distance(least, norms), np.inf)
        open_ = self.tree.leaf_distances(points) <= reach[:, None]
        scores = np.full((len(q), len(self.ids)), -np.inf)
        for leaf, (a, b) in enumerate(zip(self.tree.bounds[:-1], self.tree.bounds[1:], strict=True)):
            rows = np.flatnonzero(open_[:, leaf])
            if len(rows):
                scores[rows, a:b] = q[rows] @ self.vectors[a:b].T
        own = self.ids[None, :] == query_ids[:, None]
        scores[own] = -np.inf
        slack = self.slack * norms
        low = least - slack
        if len(self.ids) > k:
            low = np.maximum(low, -np.partition(-scores, k - 1, axis=1)[:, k - 1] - slack)
        for row in range(len(q)):
            at = np.flatnonzero((scores[row] >= low[row]) & np.isfinite(scores[row]))
            if len(at):
                value = exact(q[row], self.vectors[at])
                rank = np.lexsort((self.ids[at], -value))[:k]
                rank = rank[value[rank] >= least[row]]
                yield int(query_ids[row]), self.ids[at][rank], value[rank]


def _asked(space: Space, low: np.ndarray, high: np.ndarray, q: np.ndarray, least: np.ndarray, first: int, last: int, limit: float) -> np.ndarray:
    """Which cells queries ask in a round: the ``first`` to the ``last`` nearest ones, as far as the test leaves them."""
    points, norms = space.asked(q)
    far = np.zeros((len(q), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d : d + 1]
        gap = np.maximum(low[:, d] - x, 0) + np.maximum(x - high[:, d], 0)
        far += gap * gap
    near = np.zeros(far.shape, bool)
    np.put_along_axis(near, np.argsort(far, axis=1, kind="stable")[:, first:last], True, axis=1)
    with np.errstate(invalid="ignore"):
        reach = np.where(np.isfinite(least), limit * space.distance(least, norms), np.inf)
    return near & (far <= reach[:, None])


def _round(placed: DataFrame, asked: DataFrame, blocks: DataFrame, space, k: int, limit: float, leaf: int) -> DataFrame:
    """query_id, vec_id, score: each query's best in every block of the cells that it asks (cell, id, v, least)."""
    # A row per cell: how many blocks it has, and how many tasks share its queries.
    askers = blocks.join(asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / ASKERS).cast("int").alias("shares")), "cell")
    askers = F.broadcast(askers)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    members = placed.join(askers, "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), every(F.col("shares")).alias("share"), F.lit(0).alias("role"), "id", "v", F.lit(0.0).alias("least"))
    queries = asked.join(askers, "cell").select("cell", every(F.col("blocks")).alias("block"), F.pmod(F.xxhash64("id"), F.col("shares")).cast("int").alias("share"), F.lit(1).alias("role"), "id", "v", "least")
    rows = members.unionByName(queries).repartition("cell", "block", "share").sortWithinPartitions("cell", "block", "share", "role", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        key, held, block = None, [], None
        for batch in batches:
            cell, part, share, role, ids = (batch.column(c).to_numpy() for c in range(5))
            edges = np.flatnonzero((np.diff(cell) != 0) | (np.diff(part) != 0) | (np.diff(share) != 0) | (np.diff(role) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(ids)], strict=True):
                if a == b:
                    continue
                now = (int(cell[a]), int(part[a]), int(share[a]))
                if now != key:
                    key, held, block = now, [], None
                vectors = s.vectors(batch.column(5).slice(a, b - a))
                if role[a] == 0:
                    held.append((ids[a:b], vectors))
                    continue
                if held:
                    block = Block(s, np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]), leaf)
                    held = []
                if block is None:  # no vector of the cell is in this block
                    continue
                least = batch.column(6).to_numpy()[a:b]
                for first in range(0, b - a, TOGETHER):
                    last = min(first + TOGETHER, b - a)
                    found = list(block.best(ids[a + first : a + last], vectors[first:last], least[first:last], k, limit))
                    q = np.concatenate([np.full(len(i), one) for one, i, _ in found]) if found else np.zeros(0)
                    who = np.concatenate([i for _, i, _ in found]) if found else np.zeros(0)
                    value = np.concatenate([x for _, _, x in found]) if found else np.zeros(0)
                    yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int64)), pa.array(who.astype(np.int64)), pa.array(value.astype(np.float64))], names=["query_id", "vec_id", "score"])

    return map_arrow(rows, run, "query_id long, vec_id long, score double")


def nearest(
    table: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    dimensions: int = DIMENSIONS,
    confidence: float = CONFIDENCE,
    leaf: int = LEAF,
    cell: int = CELL,
    seed: int = SEED,
) -> DataFrame:
    """The k nearest by inner product of every query row, among all other rows.

    Returns query_id, rank, vec_id, score; the score is summed in order of components, in double precision. Vectors that
    are null, zero, or hold null or non-finite components take no part, nor do rows without an id. Of two lengths the shorter
    vector counts as ending in zeros. Of rows with one id the largest vector (as arrays compare) counts. Ties go to the smaller
    id. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    spark = table.sparkSession
    v = F.col("v")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), is_query.alias("asks"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0.0))
    rows = cut(rows.groupBy("id").agg(F.max("v").alias("v"), F.max("asks").alias("asks")))
    size, length, norm = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    space = Space(length, math.sqrt(norm) * (1 + 1e-9), dimensions, seed)
    some = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()  # at most SAMPLE vectors
    cells = Cells(space.points(space.vectors(some.column(0))), min(MOST_CELLS, math.ceil(size / cell)))
    told = spark.sparkContext.broadcast((space, cells))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, cells = told.value
        for batch in batches:
            points = space.points(space.vectors(batch.column(1)))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1, dtype=np.int32) * points.shape[1]), pa.array(points.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.of(points).astype(np.int32)), flat], names=["id", "v", "asks", "cell", "p"])

    placed = cut(map_arrow(rows, place, "id long, v array<double>, asks boolean, cell int, p array<double>"))
    sides = [f(F.col("p")[d]).alias(f"{name}{d}") for d in range(dimensions) for name, f in (("low", F.min), ("high", F.max))]
    boxes = sorted(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *sides).collect(), key=lambda r: r["cell"])  # a row per cell
    low, high = (np.array([[r[f"{name}{d}"] for d in range(dimensions)] for r in boxes]) for name in ("low", "high"))
    number, sizes = np.array([r["cell"] for r in boxes], dtype=np.int32), [r["n"] for r in boxes]
    blocks = spark.createDataFrame([(int(c), math.ceil(n / (2 * cell))) for c, n in zip(number, sizes, strict=True)], "cell int, blocks int")
    limit = chi_square_quantile(confidence, dimensions)
    map_of, space_told = spark.sparkContext.broadcast((space, low, high, number)), spark.sparkContext.broadcast(space)
    asking = placed.filter("asks").select("id", "v")

    def ask(queries: DataFrame, first: int, last: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            space, low, high, number = map_of.value
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    batch = whole.slice(at, 1024)
                    row, cell = np.nonzero(_asked(space, low, high, space.vectors(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False), first, last, limit))
                    yield pa.RecordBatch.from_arrays([pa.array(number[cell]), *[c.take(pa.array(row)) for c in batch.columns]], names=["cell", "id", "v", "least"])

        return map_arrow(queries.select("id", "v", "least"), run, "cell int, id long, v array<double>, least double")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best, first, width = None, 0, 1
    while first < len(number):
        if best is None:
            queries = asking.withColumn("least", F.lit(float("-inf")))
        else:
            reached = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
            queries = asking.join(reached, "id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
        asked = cut(ask(queries, first, first + width))
        found = _round(placed, asked, blocks, space_told, k, limit, leaf)
        if best is not None:
            found = best.select("query_id", "vec_id", "score").unionByName(found)
        best = cut(found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k))
        first, width = first + width, 4 * width
    return best.select("query_id", "rank", "vec_id", "score")
