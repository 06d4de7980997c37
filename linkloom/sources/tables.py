"""Sources and sinks: record tables, packed lists, features, metrics. All paths go through Spark's readers and writers."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.operators.blocking import BASE, Blocking
from linkloom.operators.records import prepare_records

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None, quote: bool = False) -> DataFrame:
    """All columns of a tab-separated file with header, as text. A byte order mark before the header is dropped.

    Quotes are ordinary characters unless ``quote`` is set. Named columns are selected; others are ignored.
    """
    reader = spark.read.option("header", True).option("sep", "\t").option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("quote", '"' if quote else "")
    df = reader.csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.select(*columns) if columns else df


def read_records(spark: SparkSession, path: str, quote: bool = False) -> DataFrame:
    return read_tsv(spark, path, RECORD.names, quote)


def read_source(spark: SparkSession, path: str, source: str | None = None, config: Blocking = BASE, all_scripts: bool = False) -> DataFrame:
    """Records of a file, ready for linkage."""
    return prepare_records(read_records(spark, path), config, source, all_scripts)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, TRUTH.names)


def write_tsv(df: DataFrame, path: str, parts: int = 16) -> None:
    """Tab-separated parts with a header each; empty texts stay empty. Overwrites."""
    _tsv(df.repartition(parts)).mode("overwrite").csv(path)


def _tsv(df: DataFrame):
    return df.write.option("header", True).option("sep", "\t").option("emptyValue", "").option("nullValue", "").option("quote", "")


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def write_one_tsv(df: DataFrame, path: str) -> None:
    """One tab-separated file, which mustn't exist; it appears whole or not at all."""
    spark = df.sparkSession
    files, at = _files(spark, path)
    if files.exists(at):
        raise FileExistsError(path)
    folder = f"{path}.{uuid.uuid4().hex}"
    try:
        _tsv(df.coalesce(1)).mode("errorifexists").csv(folder)
        part = next(s.getPath() for s in files.listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder)) if s.getPath().getName().startswith("part-"))
        if not files.rename(part, at):
            raise OSError(f"can't write {path}")
    finally:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)


def write_json(spark: SparkSession, payload: dict, path: str) -> None:
    """A document of metrics as one line of JSON."""
    spark.createDataFrame([(json.dumps(payload, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    """The first document."""
    for row in spark.read.text(path).filter(F.trim("value") != "").limit(1).collect():
        return json.loads(row["value"])
    raise ValueError(f"no JSON in {path}")


class HeaderError(ValueError):
    """A part file has another header than the rest."""


def read_parts(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """All part files of a folder as one table; each must have the header ``columns``."""
    # A file's first line is the first row of its first split.
    lines = spark.read.text(folder).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("h"))
    wrong = first.filter(F.rtrim("h") != "\t".join(columns)).limit(1).collect()
    if wrong:
        raise HeaderError(wrong[0]["h"])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("sep", "\t").option("quote", "").csv(folder).fillna("")


def merge_parts(spark: SparkSession, folder: str, path: str, columns: list[str]) -> int:
    """Part files of a folder as one file; the number of rows."""
    df = read_parts(spark, folder, columns)
    write_one_tsv(df, path)
    return df.count()


def write_features(df: DataFrame, path: str) -> None:
    """Parquet in zstandard; doubles stay doubles."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def merge_shards(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet tables with one and the same schema, together."""
    schemas = [spark.read.parquet(p).schema for p in paths]
    for path, schema in zip(paths, schemas, strict=True):
        if schema != schemas[0]:
            raise ValueError(f"{path} has another schema")
    return spark.read.schema(schemas[0]).parquet(*paths)


class ShardError(ValueError):
    """Shards don't make up the whole."""


def write_shard(df: DataFrame, path: str, index: int, count: int, **metrics) -> dict:
    """One of ``count`` shards of a table, with a manifest of its place, its rows and further counts."""
    write_features(df, f"{path}/{index:03d}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/{index:03d}/rows").count()
    manifest = {"shard_index": index, "shard_count": count, "rows": rows, **metrics}
    write_json(df.sparkSession, manifest, f"{path}/{index:03d}/manifest")
    return manifest


def finalize_shards(spark: SparkSession, path: str, count: int, expected_rows: int | None = None) -> tuple[DataFrame, dict]:
    """All shards of a table together, and their counts summed up.

    Every shard must be there with its own manifest, have the rows that this says, and the rows of all must be those expected.
    """
    total: dict = {}
    for k in range(count):
        try:
            manifest = read_json(spark, f"{path}/{k:03d}/manifest")
        except Exception as e:  # noqa: BLE001  the reader's errors differ by store
            raise ShardError(f"shard {k} of {count} is incomplete") from e
        if (manifest["shard_index"], manifest["shard_count"]) != (k, count):
            raise ShardError(f"the manifest of shard {k} of {count} is that of another: {manifest}")
        for name, value in manifest.items():
            if isinstance(value, (int, float)) and not name.startswith("shard_"):
                total[name] = total.get(name, 0) + value
    df = merge_shards(spark, [f"{path}/{k:03d}/rows" for k in range(count)])
    if df.count() != total["rows"] or (expected_rows is not None and total["rows"] != expected_rows):
        raise ShardError(f"shards have {total['rows']} rows by their manifests, {df.count()} in fact, expected are {expected_rows}")
    return df, total


def content_signature(records: DataFrame) -> str:
    """SHA-256 over the records' own hashes, which are added up: the same for any order of rows."""
    h = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("")) for c in RECORD.names]).cast("binary"), 256)
    part = lambda k: F.sum(F.conv(F.substring(h, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)"))
    row = records.agg(F.count(F.lit(1)).alias("n"), *[part(k).alias(f"p{k}") for k in range(4)]).first()
    import hashlib

    return hashlib.sha256(":".join(str(x) for x in row).encode()).hexdigest()


def save_index(indexed: DataFrame, records: DataFrame, path: str) -> dict:
    """An index of :mod:`linkloom.operators.ranked` by country, with a manifest of what it was built from."""
    manifest = {"signature": content_signature(records), "countries": sorted(str(r[0]) for r in records.select("country").distinct().collect())}
    indexed.write.mode("overwrite").partitionBy("country").parquet(f"{path}/terms")
    write_json(records.sparkSession, manifest, f"{path}/manifest")
    return manifest


def load_index(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """The index, if it was built from these records; else ValueError."""
    if read_json(spark, f"{path}/manifest")["signature"] != content_signature(records):
        raise ValueError(f"{path} was built from other records")
    return spark.read.parquet(f"{path}/terms").withColumn("country", F.col("country").cast("string"))


def store_uri(uri: str, scheme: str = "s3a") -> str:
    """An object store's address under the scheme that the cluster knows; other addresses as they are."""
    if scheme not in ("s3", "s3a"):
        raise ValueError(scheme)
    head, mark, rest = uri.partition("://")
    return f"{scheme}://{rest}" if mark and head in ("s3", "s3a") else uri


def synthetic_records(spark: SparkSession, n: int = 250, unseen_country: bool = False) -> dict[str, DataFrame]:
    """Three small sources and their truth: S2 and S3 have a changed copy of every S1 record and a decoy each."""
    i = F.col("id")
    countries = ["US", "India", "France"] if unseen_country else ["US", "India"]
    country = F.element_at(F.array(*[F.lit(c) for c in countries]), (i % len(countries) + 1).cast("int"))
    base = spark.range(n).select(i, country.alias("country"), F.format_string("Harbour%d Trading%d", i * 7919 % 1009, i).alias("name"), F.format_string("%d Quay%d Street, Port%d %05d", i % 90 + 1, i * 31 % 211, i % 17, i * 271 % 90000 + 10000).alias("address"))
    row = lambda s, k, name, address: base.select(F.format_string(f"{s}-%d{k}", i).alias("entity_id"), name.alias("business_name"), address.alias("business_address"), "country")
    name, address = F.col("name"), F.col("address")
    out = {"S1": row("S1", "", F.concat(name, F.lit(" Inc")), address)}
    for s, suffix in (("S2", " Ltd"), ("S3", "")):
        true = row(s, "", F.concat(F.upper(name), F.lit(suffix)), F.regexp_replace(address, "Street", "St"))
        out[s] = true.unionByName(row(s, "d", F.format_string("Decoy%d Holdings", i * 13), F.format_string("%d Nowhere Road", i + 500)))
    out["truth"] = base.select(F.format_string("S1-%d", i).alias("source1_entity_id"), F.format_string("S2-%d,S3-%d", i, i).alias("matched_entity_ids"))
    return out
