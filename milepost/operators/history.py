"""History filters that leave most of the history where it is (J11, U2 at scale).

A bitmap of key hashes tells which keys a history can't have. It is kept for each part of the history (a day, a
batch), is built by Spark's own bitmap aggregates, and is as large as its user allows: ``bits`` / 8 bytes over all parts.
Rows whose bit is unset are new without a look at the history; only the others meet it, exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import key_text
from ..session import written
from .joins import keyed_join

#: Bits of a bitmap: 8 MB, about one false alarm in ten for seven million keys.
BITS = 1 << 26
#: Bits in one bucket of Spark's bitmap functions.
BUCKET = 32768


def _bit(key: Column, bits: int) -> Column:
    """1 to ``bits``: Spark counts bits from 1."""
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def key_bitmap(history: DataFrame, key: str, bits: int = BITS, by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, _bucket, _bitmap of a history's keys as trimmed text: one row for each bucket that has a bit, ``bits`` / 32768 for a part at most.

    Store it beside the history, partitioned by ``by``; a part that grows is built anew or added by :func:`merged_bitmap`.
    """
    if bits % BUCKET:
        raise ValueError(f"bits must be a multiple of {BUCKET}")
    bit = _bit(F.col("_key"), bits)
    keys = history.select(*by, key_text(key).alias("_key")).filter(F.col("_key").isNotNull())
    return keys.groupBy(*by, F.bitmap_bucket_number(bit).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bitmap"))


def merged_bitmap(bitmaps: DataFrame) -> DataFrame:
    """One bitmap out of those of several parts."""
    return bitmaps.groupBy("_bucket").agg(F.bitmap_or_agg("_bitmap").alias("_bitmap"))


def maybe_known(df: DataFrame, bitmap: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The rows with ``_maybe``: false where the bitmap rules their key out, and where they have none.

    The bitmap has ``bits`` / 32768 rows of 4 kB at most, so Spark may broadcast it.
    """
    bit = _bit(key_text(df[key]), bits)
    place = F.bitmap_bit_position(bit)
    side = bitmap.select(F.col("_bucket").alias("_b"), "_bitmap")
    joined = df.join(side, F.bitmap_bucket_number(bit) == F.col("_b"), "left")
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1
    return joined.withColumn("_maybe", F.coalesce(is_set, F.lit(False))).drop("_b", "_bitmap")


def not_in_history_by_bitmap(
    df: DataFrame, history: DataFrame, key: str, bitmap: DataFrame, bits: int = BITS, history_key: str | None = None
) -> DataFrame:
    """Rows whose key, as trimmed text, is not in the history; the same as ``not_in_history``.

    ``bitmap`` must cover the history (:func:`key_bitmap`). Of the history only keys that rows with a
    set bit ask for are kept, by a semi join that Spark runs as a broadcast where those are few; so
    for fresh keys the history is read, but not shuffled.
    """
    marked = written(maybe_known(df, bitmap, key, bits), "marked")
    asked = marked.filter("_maybe").select(key_text(key).alias("_asked")).distinct()
    known = history.select(key_text(history_key or key).alias("_seen"))
    seen = known.join(asked, F.col("_seen") == F.col("_asked"), "left_semi").distinct()
    doubtful = marked.filter("_maybe").drop("_maybe")
    rest = keyed_join(doubtful, seen, [(key_text(doubtful[key]), "_seen")], "left_anti")
    return marked.filter("NOT _maybe").drop("_maybe").unionByName(rest)
