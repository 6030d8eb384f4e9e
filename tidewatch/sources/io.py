"""Readers and writers: JSON documents, parquet and CSV tables, snapshots, upserts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


def manifest_urls(manifest: dict, category: str, first: int, last: int) -> list[str]:
    """Partition URLs of a category; those of events only from the given years."""
    if category not in ("event", "udi"):
        raise ValueError(f"unknown category: {category}")
    urls = [p["file"] for p in manifest["results"]["device"][category]["partitions"]]
    year = lambda u: re.search(r"/(\d{4})q\d+/", u)
    return urls if category == "udi" else [u for u in urls if (m := year(u)) and first <= int(m[1]) <= last]


def ingest_years(end: int, period: int = 3) -> tuple[int, int]:
    return end - period + 1, end


def object_key(url: str, month: str) -> str:
    return f"{month}/" + url.rsplit("/", 1)[-1].replace(".json.zip", ".json.gz")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON files with a ``results`` array: broken files are kept as null, each with its file name."""
    raw = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return raw.select("*", F.col("_metadata.file_path").alias("source_file"))


def record_hash(record: Column, fields: Sequence[str], keys: Sequence[str]) -> Column:
    """MD5 of a record's fields in order, the keys left out."""
    return F.md5(F.to_json(F.struct(*[record[f].alias(f) for f in sorted(fields) if f not in keys])))


def bronze(raw: DataFrame, keys: Sequence[str], batch: str, system: str) -> DataFrame:
    """One row per element of ``results``, with batch, keys as text, hash and the record."""
    rows = raw.select("source_file", F.explode("results").alias("raw_data"))
    fields = rows.schema["raw_data"].dataType.fieldNames()
    return rows.select(
        F.lit(batch).alias("source_batch_id"), F.lit(system).alias("source_system"), "source_file",
        *[F.col(f"raw_data.{k}").cast("string").alias(k) for k in keys], record_hash(F.col("raw_data"), fields, keys).alias("record_hash"), "raw_data",
    )


def read_table(spark: SparkSession, path: str, kind: str = "parquet", limit: int | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("inferSchema", True) if kind == "csv" else spark.read
    df = reader.format(kind).load(path)
    return df.limit(limit) if limit is not None else df


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_snapshot(df: DataFrame, path: str, key: str = "snapshot_date") -> None:
    """Replace the partitions that ``df`` holds, and no others; NaN becomes null."""
    numbers = [f.name for f in df.schema if f.dataType.simpleString() in ("double", "float")]
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers}) if numbers else df
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def append_by_name(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Union by name whatever the case; missing columns are null."""
    names = {c.lower(): c for c in target.columns}
    return target.unionByName(rows.withColumnsRenamed({c: names.get(c.lower(), c) for c in rows.columns}), allowMissingColumns=True)


def latest_batch(df: DataFrame, time: str = "ingest_time") -> DataFrame:
    return df.orderBy(F.desc(time)).limit(1)


def write_csv(df: DataFrame, path: str, only: Column | None = None) -> None:
    """CSV files with a header that start with a byte-order mark, so that spreadsheets read them as UTF-8; ``only`` selects rows."""
    df = df if only is None else df.where(only)
    first, *others = df.columns
    df.withColumnRenamed(first, "\ufeff" + first).select("\ufeff" + first, *others).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_sized(df: DataFrame, path: str, rows_a_file: int, compression: str = "gzip") -> None:
    """Compressed JSON files of at most so many rows each."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).option("compression", compression).json(path)


def table_schema(columns: Sequence[dict]) -> StructType:
    """The schema of configured columns: ``name``, ``type`` (default string) and ``nullable`` (default true)."""
    return StructType([StructField(c["name"], _parse_datatype_string(c.get("type", "string")), c.get("nullable", True)) for c in columns])


def ensure_table(spark: SparkSession, path: str, columns: Sequence[dict]) -> DataFrame:
    """The table at a path; an empty one of the configured columns is written first where there is none."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([], table_schema(columns)).write.parquet(path)
    return spark.read.parquet(path)


def insert_rows(spark: SparkSession, path: str, rows: Sequence[tuple], columns: Sequence[dict]) -> int:
    """Append literal rows to a table, which is made if it is not there; returns how many."""
    schema = table_schema(columns)
    ensure_table(spark, path, columns)
    spark.createDataFrame(list(rows), schema).write.mode("append").parquet(path)
    return len(rows)


def schema_of(df: DataFrame) -> DataFrame:
    """Name, type and place of every column."""
    rows = [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, ordinal_position int")


def dataset_path(config: dict, name: str) -> tuple[str, dict]:
    """The path and the reader's options of a dataset: below a local folder, or a bucket with its storage options."""
    if config.get("kind", "local") == "local":
        return f"{config['root'].rstrip('/')}/{name}", {}
    return f"s3a://{config['bucket']}/{config.get('prefix', '').strip('/')}/{name}".replace("//" + name, "/" + name), dict(config.get("storage_options", {}))


def load_report(raw: DataFrame, rows: DataFrame, table: DataFrame) -> DataFrame:
    """One row of a load: files read, broken files, rows inserted, rows of the table after it."""
    files = raw.agg(F.countDistinct("source_file").alias("files"), F.countDistinct(F.when(F.col("results").isNull(), F.col("source_file"))).alias("broken"))
    return files.crossJoin(rows.agg(F.count(F.lit(1)).alias("inserted"))).crossJoin(table.agg(F.count(F.lit(1)).alias("total")))


def drop_tables(spark: SparkSession, paths: Sequence[str]) -> int:
    """Delete the tables that exist; returns how many did."""
    jvm, gone = spark._jvm, 0
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True))
    return gone
