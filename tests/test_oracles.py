"""Every registered query that SQL can express, against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from linkloom.plans.catalogue import QUERIES
from linkloom.plans.oracles import ORACLES

#: One query for each chain of operators; the others are parts of these.
CHAINS = ["rule_linkage", "candidates_topk", "pair_features_base", "sweep_cap_threshold", "fixed_threshold_score", "bm25_views_topk", "rrf_fuse", "recall_at_k", "target_sweep", "list_violations", "tsv_roundtrip", "fold_assignment_md5"]


def test_oracles_are_of_queries():
    assert set(ORACLES) <= set(QUERIES) and set(CHAINS) <= set(ORACLES)


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(round(float(v), 6) if isinstance(v, float) else str(v) for v in r) for r in frame.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", CHAINS)
def test_oracle(spark, sf, name):
    db = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got, want = QUERIES[name](spark, sf).toPandas(), db.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and _rows(got) == _rows(want)
    spark.catalog.clearCache()
