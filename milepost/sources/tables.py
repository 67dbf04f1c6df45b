"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_number, parse_timestamp
from ..functions.text import strip
from ..operators.joins import unique_on
from ..operators.quality import existing_columns
from ..session import scratch_path


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table by name."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_all(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: load(spark, folder, n) for n in names}


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens where there is none."""
    fs, target = _path(spark, path)
    fs.delete(target, True)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, where: str, schema: T.StructType) -> DataFrame:
    """Catalog table or parquet path; empty with the given schema when it does not exist yet."""
    if "/" not in where:
        return spark.table(where) if spark.catalog.tableExists(where) else empty(spark, schema)
    return spark.read.schema(schema).parquet(where) if path_exists(spark, where) else empty(spark, schema)


def write_table(
    df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()
) -> None:
    """Create-or-replace (``overwrite``) or log append (``append``)."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, cluster_by: Sequence[str], buckets: int = 200,
    path: str | None = None,
) -> None:
    """Catalog table bucketed and sorted on its merge keys, created when absent (S8), below ``path`` if given.

    Merges on those keys then read the target without a shuffle.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{k}`" for k in cluster_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS" + (f" LOCATION '{path}'" if path else "")
    )


def clustered(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The same rows, written to the shared folder clustered and sorted on their keys, and read back.

    A later join on those keys does not move them. Rows that come out of a window or join on the keys are written
    where they are. The catalog does not keep the table.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    table = path.rpartition("/")[2].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {table} ({fields}) USING parquet OPTIONS (compression 'zstd') "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    try:
        df.repartition(buckets, *keys).write.insertInto(table)
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def conform(df: DataFrame, schema: T.StructType, on_bad: Mapping[str, object] | None = None) -> DataFrame:
    """Cast text to a declared schema without failing (S3).

    NULL ids become empty text, bad integers 0, bad numbers and dates NULL; a
    column that is missing is filled in the same way. ``on_bad`` overrides the
    replacement per column.
    """
    on_bad = dict(on_bad or {})
    out = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None).cast("string")
        source = df.schema[f.name].dataType if f.name in df.columns else T.StringType()
        if source == f.dataType:
            value = c
        elif isinstance(f.dataType, T.StringType):
            value = c.cast("string")
        elif isinstance(f.dataType, T.TimestampNTZType):
            value = parse_timestamp(c.cast("string"))
        elif isinstance(f.dataType, (T.DoubleType, T.IntegralType)):
            value = parse_number(c, f.dataType.simpleString())
        else:
            value = c.try_cast(f.dataType)
        fallback = on_bad.get(f.name, _fallback(f.dataType))
        if fallback is not None:
            value = F.coalesce(value, F.lit(fallback))
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)


def _fallback(kind: T.DataType):
    if isinstance(kind, T.StringType):
        return ""
    return 0 if isinstance(kind, T.IntegralType) else None


def lookup(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Small text lookup with a header, trimmed, one row per key."""
    df = spark.read.option("header", True).csv(path)
    df = df.select(*[strip(c).alias(c) for c in df.columns])
    return unique_on(df, keys, path)


def read_upload(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """Uploaded table: parquet, or delimited text with a header, every column as text.

    ``position`` names a column to add with a number that grows along the file, for
    rules such as "the last row counts". A file is one upload, read by one task, as
    its quoted fields may hold line ends.
    """
    if path.endswith(".parquet"):
        df = spark.read.parquet(path)
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    else:
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.withColumn(position, F.monotonically_increasing_id()) if position else df


def export_report(df: DataFrame, cols: Sequence[str], path: str) -> DataFrame:
    """Write the listed columns that exist as delimited text with a header."""
    out = existing_columns(df, cols)
    out.write.mode("overwrite").option("header", True).csv(path)
    return out
