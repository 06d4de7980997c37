"""Helpers shared by the corpus operators: words of Arrow text columns as numpy arrays, and tables in the shared folder."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java pattern of a word: a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Bytes of text that one numpy block holds, unless a single text is longer.
BLOCK_BYTES = 1 << 20
#: Seconds at least from one collection of the executors' garbage to the next.
BETWEEN_S = 4
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit values so that every bit depends on every other."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def reachable(df: DataFrame) -> DataFrame:
    """Let Python workers on this machine import this package, wherever the driver was started."""
    env = df.sparkSession.sparkContext.environment
    top = str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if top not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, top])
    return df


def release() -> None:
    """Give memory that a task no longer needs back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_given_back = [0.0]


def give_back(spark: SparkSession, tasks: int | None = None) -> None:
    """Let executors collect garbage, after which their heaps shrink to what is alive: an executor's memory also has to hold its Python workers.

    A job of one short task an executor (``tasks``, if given), some seconds after the last one at the soonest. On a local master
    there are none.
    """
    if tasks is None:
        if time.monotonic() - _given_back[0] < BETWEEN_S:
            return
        tasks = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1  # the driver is among them
    if tasks > 0:
        spark.range(0, tasks, 1, tasks).select(F.reflect(F.lit("java.lang.System"), F.lit("gc"))).collect()
    _given_back[0] = time.monotonic()


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow with a function of batches; what a task held is given back when it ends."""

    def released(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return reachable(df).mapInArrow(released, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` names it. Where that is unset it is the warehouse; on a local master, as in tests, where driver and
    executors are one process, a new temporary folder.
    """
    at = spark.conf.get("spark.checkpoint.dir", "")
    if not at:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get()
        if spark.sparkContext.master.startswith("local"):
            at = "file://" + tempfile.mkdtemp(prefix="linkloom-")
            atexit.register(shutil.rmtree, at[7:], ignore_errors=True)
        else:
            at = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/linkloom"
        spark.sparkContext.setCheckpointDir(at)
    return at


_scratch: list[list[DataFrame]] = []


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and read it again: a short lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/linkloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    give_back(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    if _scratch:
        _scratch[-1].append(out)
    return out


def forget(df: DataFrame) -> None:
    """Delete the table behind what ``cut`` returned; no result may need it any more."""
    path = getattr(df, "_cut_path", None)
    if path:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, cut; the tables that were cut on the way are deleted."""
    _scratch.append([])
    try:
        out = cut(make())
    finally:
        made = _scratch.pop()
    for df in made:
        if df is not out:
            forget(df)
    if _scratch:
        _scratch[-1].append(out)
    return out


def fold(key: str, n: int):
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % n


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns: whatever else a table has can clash with nothing."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


class Block:
    """Some whole texts as one byte array: ``data``, and the texts' ``offsets`` in it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.n = len(offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words, and the index of each text's first word (one more than texts)."""
        ok = ~SPACE[self.data]
        edge = np.zeros(len(ok) + 1, dtype=bool)
        edge[self.offsets] = True
        edge[0] = edge[-1] = True
        starts = ok.copy()
        starts[1:] &= ~ok[:-1] | edge[1:-1]
        ends = ok.copy()
        ends[:-1] &= ~ok[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes a step over all ranges at once."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = ends - starts
    out = left.astype(np.uint64) * _ODD
    live, at = np.arange(len(starts)), starts
    while len(live):
        part = eight[at] & _KEEP[np.minimum(left, 8)]
        out[live] = mixed(out[live] ^ part) * _ODD2 + _ODD
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return mixed(out)


def blocks(column: pa.Array | pa.ChunkedArray, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a text column in row order; nulls count as empty texts. Each text is whole in one block."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, where, content = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(content, dtype=np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, side="right")) - 1
        last = min(n, max(last, first + 1))
        base = offsets[first]
        yield Block(data[base : offsets[last]], offsets[first : last + 1] - base, first)
        first = last


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds, empty ranges included."""
    total = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
