"""Merge family on plain tables (M1-M4): each returns the new content of the target.

A file table has no ``MERGE INTO``; ``sources.buckets`` applies these to stored tables, rewriting
only the buckets that a source touches.
The target is left-joined to the source on its plain key columns, so a target that is
bucketed on its keys is not moved and a hot key can be split; source rows that found no
target row are added. The source is read for both, so pass a stored one where it is dear.
With ``whole`` the source is known to be about as large as the target (a snapshot of it): both are
read once, for one full join. ``"keyed"`` joins on the keys alone, so that sides which come out of a
window or join on them are not moved again; ``"spread"`` is for sides that may have many rows without a key.

Keys of the target are unique. Keys of the source are checked: ``on_dup="error"``
fails on a repeated key, ``"latest"`` keeps the first row by ``order_by``,
``"unique"`` trusts a source that has one row per key by construction, and
``"keep_all"`` lets inserts repeat. A source row with a NULL key matches nothing, so
every mode inserts it, as a SQL merge does; ``split_keys`` parts such rows off before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import unique_on
from .keyed import Order, latest_per_key


def split_keys(src: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys, and the rejected rows that lack one."""
    filled = F.lit(True)
    for k in keys:
        filled = filled & F.col(k).isNotNull()
    return src.filter(filled), src.filter(~filled)


def unique_source(src: DataFrame, keys: Sequence[str], on_dup: str = "error", order_by: Order | None = None) -> DataFrame:
    if on_dup in ("keep_all", "unique"):
        return src
    if on_dup == "latest":
        if not order_by:
            raise ValueError("on_dup='latest' needs order_by")
        filled, without = split_keys(src, keys)
        return latest_per_key(filled, keys, order_by).unionByName(without)
    if on_dup == "error":
        return unique_on(src, keys, "merge source", keep_null=True)
    raise ValueError(f"unknown on_dup: {on_dup}")


def new_rows(
    target: DataFrame, src: DataFrame, keys: Sequence[str], on_dup: str = "error", order_by: Order | None = None
) -> DataFrame:
    """Source rows whose key is not in the target: what an insert-only merge appends (M1)."""
    return _unmatched(target, unique_source(src, keys, on_dup, order_by), keys)


def _unmatched(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows without a target row: of the target only the keys found in the source are kept."""
    matched = target.select(*keys).join(src.select(*keys), list(keys), "left_semi")
    return src.join(matched, list(keys), "left_anti")


def merge_insert(
    target: DataFrame, src: DataFrame, keys: Sequence[str], on_dup: str = "error", order_by: Order | None = None
) -> DataFrame:
    return target.unionByName(new_rows(target, src, keys, on_dup, order_by))


def _source(src: DataFrame, keys: Sequence[str]) -> DataFrame:
    return src.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.struct(*src.columns).alias("_s"))


def _matched(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with the struct ``_s`` of their source row, NULL where there is none."""
    test = None
    for k in keys:
        part = target[k] == F.col(f"_s_{k}")
        test = part if test is None else test & part
    return target.join(_source(src, keys), test, "left")


def _pairs(target: DataFrame, src: DataFrame, keys: Sequence[str], whole: str | None = None) -> DataFrame:
    """Structs ``_t`` and ``_s`` of matching rows; one of them is NULL where there is no match."""
    if whole:
        sides, test = [], F.lit(True)
        for df, side in ((target, "_t"), (src, "_s")):
            names, no_key = [F.col(k).alias(f"{side}_{k}") for k in keys], F.lit(False)
            for k in keys:
                no_key = no_key | F.col(k).isNull()
            if whole == "spread":
                row = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) + 1
                names.append(F.when(no_key, row).otherwise(F.lit(0).cast("bigint")).alias(f"{side}_spread"))
            sides.append(df.select(*names, F.struct(*df.columns).alias(side)))
        for k in [*keys, *(["spread"] if whole == "spread" else [])]:
            test = test & (F.col(f"_t_{k}") == F.col(f"_s_{k}"))
        return sides[0].join(sides[1], test, "full_outer").select("_t", "_s")
    old = F.struct(*[target[c] for c in target.columns]).alias("_t")
    paired = _matched(target, src, keys).select(old, "_s")
    nothing = F.lit(None).cast(paired.schema["_t"].dataType).alias("_t")
    return paired.unionByName(_unmatched(target, src, keys).select(nothing, F.struct(*src.columns).alias("_s")))


def merge_update(
    target: DataFrame, src: DataFrame, keys: Sequence[str], cols: Sequence[str], on_dup: str = "error",
    order_by: Order | None = None,
) -> DataFrame:
    """Overwrite ``cols`` where the key matches; no inserts (M2)."""
    source = unique_source(src, keys, on_dup, order_by)
    joined = _matched(target, source, keys)
    new = F.col("_s")
    return joined.select(
        *[
            F.when(new.isNotNull(), new[c]).otherwise(target[c]).alias(c) if c in cols else target[c]
            for c in target.columns
        ]
    )


def merge_upsert(
    target: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    on_update: Mapping[str, Column] | None = None,
    on_dup: str = "error",
    order_by: Order | None = None,
    whole: str | None = None,
) -> DataFrame:
    """Update matched rows, insert the others (M3).

    ``on_insert`` / ``on_update`` give columns that the source does not carry,
    such as load and update times (M6). Columns named nowhere keep the target's
    value on update and are NULL on insert.
    """
    on_insert, on_update = dict(on_insert or {}), dict(on_update or {})
    cols = list(cols) if cols is not None else [c for c in src.columns if c not in keys]
    paired = _pairs(target, unique_source(src, keys, on_dup, order_by), keys, whole)
    t, s = F.col("_t"), F.col("_s")

    def value(c):
        if c in keys:
            return F.coalesce(t[c], s[c])
        update = on_update.get(c, s[c] if c in cols else t[c])
        insert = on_insert.get(c, s[c] if c in cols else F.lit(None))
        return F.when(s.isNull(), t[c]).when(t.isNull(), insert).otherwise(update)

    return paired.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def merge_actions(
    target: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    hash_col: str,
    delete_where: Column,
    on_dup: str = "error",
    order_by: Order | None = None,
    whole: str | None = None,
) -> DataFrame:
    """Full comparison of target and source: every row with its ``_action`` (M4).

    keep / update (hash differs) / insert / delete (missing from the source and
    inside ``delete_where``, a condition on target columns).
    """
    columns = target.columns
    marked = target.withColumn("_in_window", F.coalesce(delete_where, F.lit(False)))
    paired = _pairs(marked, unique_source(src, keys, on_dup, order_by), keys, whole)
    t, s = F.col("_t"), F.col("_s")
    action = (
        F.when(t.isNull(), "insert")
        .when(s.isNull() & t["_in_window"], "delete")
        .when(t[hash_col] != s[hash_col], "update")
        .otherwise("keep")
    )
    paired = paired.withColumn("_action", action)
    from_source = F.col("_action").isin("insert", "update")
    return paired.select(*[F.when(from_source, s[c]).otherwise(t[c]).alias(c) for c in columns], "_action")


def merge_sync(
    target: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    hash_col: str,
    delete_where: Column,
    on_dup: str = "error",
    order_by: Order | None = None,
    whole: str | None = None,
) -> DataFrame:
    """Hash-guarded sync with a windowed delete (M4)."""
    out = merge_actions(target, src, keys, hash_col, delete_where, on_dup, order_by, whole)
    return out.filter(F.col("_action") != "delete").drop("_action")


def change_feed(
    target: DataFrame, src: DataFrame, keys: Sequence[str], hash_col: str, delete_where: Column, on_dup: str = "error",
    order_by: Order | None = None,
    whole: str | None = None,
) -> DataFrame:
    """What a sync changes: keys, ``accion`` (insert, update, delete), ``antes`` and ``despues`` as structs.

    It comes from the one full comparison that the sync needs anyway; what follows a load can read it in place
    of the whole table. ``apply_changes`` gives the new content of the target.
    """
    marked = target.withColumn("_in_window", F.coalesce(delete_where, F.lit(False)))
    paired = _pairs(marked, unique_source(src, keys, on_dup, order_by), keys, whole)
    t, s = F.col("_t"), F.col("_s")
    action = F.when(t.isNull(), "insert").when(s.isNull() & t["_in_window"], "delete").when(t[hash_col] != s[hash_col], "update")
    fields = [(f.name, f.dataType) for f in target.schema.fields]

    def image(side: Column, there: Column) -> Column:
        return F.when(there, F.struct(*[side[n].cast(kind).alias(n) for n, kind in fields]))

    rows = paired.withColumn("accion", action).filter(F.col("accion").isNotNull())
    return rows.select(
        *[F.coalesce(t[k], s[k]).alias(k) for k in keys], "accion",
        image(t, F.col("accion") != "insert").alias("antes"), image(s, F.col("accion") != "delete").alias("despues"),
    )


def apply_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after a ``change_feed``: rows without a change, and the new images. Keys are unique and filled."""
    kept = target.join(feed.filter(F.col("accion") != "insert").select(*keys), list(keys), "left_anti")
    return kept.unionByName(feed.filter(F.col("despues").isNotNull()).select("despues.*").select(*target.columns))
