"""Sharding by a keyed Feistel permutation with cycle walking over global row numbers.

The law is ``rows``: shard sizes differ by one at most. Rows get a global number
by the order (id, text hash): Spark sorts them by range, the counts of the ranges
give each range its base, and number = base + place in the range. A balanced
Feistel network permutes the smallest power of four not below the row count N;
a value that falls at N or above walks on until it falls below. The permuted
number p gives shard p mod S and slot p div S, so the place of any row can be
computed from its number, the key and N alone, and slots have no gaps.

A null text has no bytes (size 1) and the CRC of the empty text. Null ids sort
first. Rows equal in id and text are interchangeable; each still has its own slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

ROUNDS = 6


def feistel(numbers: np.ndarray, rows: int, key: int = 0) -> np.ndarray:
    """Permute 0 .. rows - 1; every value walks its cycle until it is back in the range."""
    half = max(1, (max(rows - 1, 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << half) - 1), numbers.astype(np.uint64)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + (i + 1) * 0xD1B54A32D192ED03) % (1 << 64)) for i in range(ROUNDS)]
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            x = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(rows)]
    return out.astype(np.int64)


def numbered(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """Rows with a gapless global number from 0 in the given order; nothing meets in one task.

    The sorted rows are written once, so that their numbers hold however often
    they are read; of each range only its count goes through the driver.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    ranked = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranked = written(ranked.withColumns({"_part": F.shiftright(place, 33).cast("int"), "_place": place.bitwiseAND((1 << 33) - 1)}), "numbered")
    sizes = {r["_part"]: r["count"] for r in ranked.groupBy("_part").count().collect()}  # one row for each range
    ends = np.cumsum([sizes.get(i, 0) for i in range(max(sizes, default=-1) + 1)]).tolist()
    base = F.array(*[F.lit(x).cast("long") for x in [0, *ends[:-1]]])
    return ranked.withColumn(name, base[F.col("_part")] + F.col("_place")).drop("_part", "_place")


def shards(df: DataFrame, count: int = 16, key: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's shard and slot: id column, size, text_crc32, law, shard, slot, grown_shard (null: the law is not ``key``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_hash"),
    )
    rows = numbered(rows, ["_id", "text_crc32", "_hash", "size"])
    total = rows.count()

    @F.pandas_udf("long")
    def permuted(numbers: pd.Series) -> pd.Series:
        return pd.Series(feistel(numbers.to_numpy(), total, key))

    rows = rows.withColumn("_place", permuted("row_number"))
    return rows.select(
        F.col("_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_place") % count).cast("int").alias("shard"),
        F.floor(F.col("_place") / F.lit(count)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
