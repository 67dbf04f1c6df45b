"""Keyed operators: newest / oldest row per key, first-of-group flags, group values on rows.

None of them sends a whole hot group to one task. Row picks keep one row per key
on the map side (``WindowGroupLimit`` before the exchange). Group values are
partially aggregated and go back to their rows by a join that AQE can split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column | str]


def _cols(order_by: Order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Order, where: Column | None = None) -> DataFrame:
    """First row per key in the given order.

    ``order_by`` must be total (end it with a unique column), otherwise the row
    kept among equals is arbitrary.
    """
    if where is not None:
        df = df.filter(where)
    w = Window.partitionBy(*keys).orderBy(*_cols(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def earliest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], where: Column | None = None) -> DataFrame:
    return latest_per_key(df, keys, [F.col(c).asc_nulls_first() for c in order_by], where)


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "last") -> DataFrame:
    """Sort and drop duplicates, keeping the first or the last row per key."""
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    if keep == "first":
        return earliest_per_key(df, keys, order_by)
    return latest_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order_by])


def add_group_values(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Add an aggregate of each row's group to the row.

    The same as ``agg().over(partitionBy(keys))``, without its whole-group task:
    group values are pre-aggregated on the map side and joined back, one row per
    group. The join carries a second key that is always 0, so that both sides get
    their own exchange and AQE splits the partition of a hot group. NULL keys form
    one group, as in a window.
    """
    names, key_names = list(values), [f"_g{i}" for i in range(len(keys))]
    groups = df.groupBy(*keys).agg(*[v.alias(n) for n, v in values.items()])
    groups = groups.select(*[F.col(k).alias(g) for k, g in zip(keys, key_names)], F.struct(*names).alias("_v"))
    # Always 0, but not a constant to the optimizer, which would drop the second key.
    groups = groups.withColumn("_zero", F.pmod(F.xxhash64(*key_names), F.lit(1).cast("bigint")))
    marked = df.withColumn("_none", F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint")))
    joined = marked.join(groups, _null_safe(marked, keys, key_names) & (F.col("_none") == F.col("_zero")), "left")
    return joined.withColumns({n: F.col("_v")[n] for n in names}).drop("_v", "_none", "_zero", *key_names)


def _null_safe(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> Column:
    test = None
    for k, name in zip(keys, names):
        part = df[k].eqNullSafe(F.col(name))
        test = part if test is None else test & part
    return test


def add_total(df: DataFrame, key: str, amount: Column, name: str) -> DataFrame:
    """Sum of an amount over the row's key, NULL amounts as 0, kept on each row."""
    exact = F.coalesce(amount.cast("decimal(38,9)"), F.lit(0).cast("decimal(38,9)"))
    return add_group_values(df, [key], {name: F.sum(exact).cast("decimal(38,9)")})


def add_any(df: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """1 when any row of the key meets the condition, else 0."""
    values = {name: F.max(F.when(cond, 1).otherwise(0)) for name, cond in flags.items()}
    return add_group_values(df, [key], values)


def primary_flag(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    name: str,
    labels: tuple[str, str],
    null_group: bool = False,
) -> DataFrame:
    """Mark the first row of each key.

    The first row is found by a partial ``min``; it meets the rows again on key
    *and* order columns, which are unique together, so no group stays in one
    place. Rows without a key get NULL; with ``null_group`` they form one group.
    """
    first = df.groupBy(key).agg(F.min(F.struct(*order_by)).alias("_first"))
    if not null_group:
        first = first.filter(F.col(key).isNotNull())
    names = ["_f", *[f"_f{i}" for i in range(len(order_by))]]
    first = first.select(
        F.col(key).alias("_f"), *[F.col("_first")[c].alias(n) for c, n in zip(order_by, names[1:])],
        F.lit(True).alias("_is_first"),
    )
    flag = F.when(F.col("_is_first"), labels[0]).otherwise(labels[1])
    if not null_group:
        flag = F.when(df[key].isNotNull(), flag)
    joined = df.join(first, _null_safe(df, [key, *order_by], names), "left")
    return joined.withColumn(name, flag).drop("_is_first", *names)
