"""Relational sources and sinks over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000
BATCH_ROWS = 10_000


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 64,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options; with a partition column the range is read by parallel queries."""
    out = {"url": url, "dbtable": table, "fetchsize": str(FETCH_ROWS), **(properties or {})}
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its column")
        low, high = bounds
        out |= {
            "partitionColumn": partition_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return out


def extract(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Operational extract (S2). Filters on the frame are pushed into the database query."""
    return spark.read.format("jdbc").options(**read_options(url, table, **options)).load()


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    cols: Sequence[str],
    properties: Mapping[str, str] | None = None,
    writers: int = 8,
) -> None:
    """Batched append of the listed columns, NULLs preserved (S10); at most ``writers`` connections.

    The rows are dealt over the writers after the work, which keeps its own parallelism.
    """
    (
        df.select(*cols)
        .repartition(writers)
        .write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(BATCH_ROWS), **(properties or {}))
        .mode("append")
        .save()
    )
