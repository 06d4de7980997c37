"""Positions of rows: numbers without gaps in the order of a table, and checks of such numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .contracts import ContractError
from .keep import keep

_BITS = 33  # of monotonically_increasing_id, the position in a partition


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Adds the row's place in the table's order, from 0: that of the file for a table just read, else that of the last sort.

    Rows are counted by partition first; only these counts, a row per partition, are summed up and sent to all tasks. Rows are
    kept, for counts and rows must come from the same partitions: adaptive execution would sort each on its own, narrow counts
    into fewer partitions than whole rows.
    """
    rows = keep(df.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", _BITS)))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = F.broadcast(counts.select("_part", before.alias("_first")))
    inside = F.col("_at").bitwiseAND(F.lit((1 << _BITS) - 1))
    return rows.join(first, "_part").withColumn(name, F.col("_first") + inside).select(*df.columns, name)


def with_sequence(tables: list[DataFrame], name: str = "seq") -> DataFrame:
    """Several tables as one, numbered from 0 without gaps: all rows of the first in their order, then those of the next."""
    out, first = None, F.lit(0)
    for df in tables:
        own = with_ordinal(df, name)
        own = own.withColumn(name, F.col(name) + first)
        first = first + F.lit(df.count())
        out = own if out is None else out.unionByName(own)
    return out


def coverage(numbered: DataFrame, name: str = "seq") -> DataFrame:
    """One row: rows, the least and greatest number, how many are different, and whether they are 0 to rows - 1, each once."""
    row = numbered.agg(F.count(F.lit(1)).alias("rows"), F.min(name).alias("least"), F.max(name).alias("most"), F.count_distinct(name).alias("different"))
    n = F.col("rows")
    return row.withColumn("dense", (n == 0) | ((F.col("least") == 0) & (F.col("most") == n - 1) & (F.col("different") == n)))


def assert_dense(numbered: DataFrame, name: str = "seq") -> int:
    """The number of rows, if the numbers cover each place once."""
    row = coverage(numbered, name).first()
    if not row["dense"]:
        raise ContractError(f"{name}: {row.asDict()}")
    return int(row["rows"])
