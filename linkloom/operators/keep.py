"""Tables that several results are derived from: kept while they are needed, then let go.

What operators and runs persist goes through :func:`keep`. A caller who is done says :func:`release`, or works inside of
:func:`holding`, which lets go of what was kept since it began.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

_held: list[DataFrame] = []


def keep(df: DataFrame) -> DataFrame:
    """Persist, on disk where memory is short."""
    _held.append(df.persist())
    return _held[-1]


def release(since: int = 0) -> None:
    """Let go of all kept tables, or of those kept after the first ``since``."""
    while len(_held) > since:
        _held.pop().unpersist()


@contextmanager
def holding() -> Iterator[None]:
    """Tables kept inside are let go at the end: results must have been read or written by then."""
    since = len(_held)
    try:
        yield
    finally:
        release(since)
