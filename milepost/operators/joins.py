"""Joins that keep their cardinality.

No join here forces a broadcast of a table of unknown size: Spark chooses by the
size it knows at planning or at run time (``autoBroadcastJoinThreshold``). Shuffle
joins are laid out so that AQE can split a hot key (see :func:`keyed_join`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import key_text
from ..session import written
from .keyed import Order, latest_per_key

Keys = Sequence[str | tuple[Column | str, Column | str]]

#: Cells along one side of a key in :func:`split_join`, and so the copies of a row, at most.
CELLS = 32


def unique_on(df: DataFrame, keys: Sequence[str], what: str = "table", keep_null: bool = False) -> DataFrame:
    """The same rows, failing at run time when two share a key.

    Rows with a NULL key are dropped, as a lookup can't find them; ``keep_null`` lets them pass.

    The check is a scalar subquery over the key columns alone, with partial
    aggregation; the rows themselves are not regrouped and go straight on.
    """
    filled = df.na.drop("any", subset=list(keys))
    repeated = filled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    example = repeated.agg(F.min(F.to_json(F.struct(*keys)))).scalar()
    message = F.concat(F.lit(f"{what}: several rows for key "), example)
    return (df if keep_null else filled).filter(F.when(example.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Order | None, what: str = "table") -> DataFrame:
    return latest_per_key(df, keys, order_by) if order_by else unique_on(df, keys, what)


def keyed_join(
    left: DataFrame, side: DataFrame, keys: Sequence[tuple[Column, str]], how: str = "left", spread: bool = True
) -> DataFrame:
    """Equi join of ``left`` to a side that has one row per key (or is only tested for presence).

    The side comes out of an aggregation on its key. Joined on that key alone, its
    partitioning would be reused and AQE could not split a hot key of ``left``. With
    ``spread`` the join carries a second key: 0 on the side and for ordinary rows of
    ``left``, so that both inputs get their own exchange and skewed partitions are
    split; and a row hash where the key is NULL, so that rows without a key, which
    never match, do not meet in one partition. Without ``spread`` (``left`` is known
    to be unique and filled on the key) consecutive joins share one shuffle.

    The key columns of the side stay in the result; ``_zero`` is removed.
    """
    test = None
    for c, name in keys:
        test = c == F.col(name) if test is None else test & (c == F.col(name))
    if not spread:
        return left.join(side, test, how)
    no_key = F.lit(False)
    for c, _ in keys:
        no_key = no_key | c.isNull()
    row_hash = F.pmod(F.xxhash64(*left.columns), F.lit(1 << 20)) + 1
    number = F.when(no_key, row_hash).otherwise(F.lit(0).cast("bigint"))
    # Always 0, but not a constant to the optimizer, which would drop the second key.
    zero = F.pmod(F.xxhash64(*[name for _, name in keys]), F.lit(1).cast("bigint"))
    return left.join(side.withColumn("_zero", zero), test & (number == F.col("_zero")), how).drop("_zero")


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: Keys,
    cols: Sequence[str] | Mapping[str, str] | None = None,
    expect: str = "one",
    order_by: Order | None = None,
    where: Column | None = None,
    cast: str | None = None,
    normalise=None,
    spread: bool | None = None,
    what: str = "lookup",
) -> DataFrame:
    """Left join that adds columns of ``dim``.

    on         key pairs ``(fact key, dim key)``, or a name common to both
    cols       dim columns to add; a mapping renames ``{dim name: new name}``.
               A fact column of the same name is replaced.
    expect     ``one``: at most one dim row per key, the fact keeps its row count.
               With ``order_by`` the first row in that order is used, otherwise two
               rows for a key are an error.
               ``unique``: the key is the declared primary key of the table; it is
               not checked again (see :func:`assert_unique`), so the dim is read
               straight into the join. ``many``: every matching row.
    where      filter on dim before the join (a constant residual in ON)
    cast       type both keys are safely cast to
    normalise  function Column -> Column applied to both keys
    spread     see :func:`keyed_join`: by default with ``order_by``; False when the
               fact is unique on the key, True for an aggregated ``unique`` side
    """
    if expect not in ("one", "unique", "many"):
        raise ValueError(f"expect must be 'one', 'unique' or 'many', not {expect!r}")
    if where is not None:
        dim = dim.filter(where)
    pairs = [(p, p) if isinstance(p, str) else p for p in on]

    def keyed(c, side):
        c = side[c] if isinstance(c, str) else c
        c = normalise(c) if normalise else c
        return c.try_cast(cast) if cast else c

    names = [f"_k{i}" for i in range(len(pairs))]
    if cols is None:
        own = {r for _, r in pairs if isinstance(r, str)}
        cols = [c for c in dim.columns if c not in own]
    renamed = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    order_names = _order_names(order_by)
    fact_columns = fact.columns
    clash = {f"_d_{new}": new for new in renamed.values() if new in fact_columns}
    added = {c: f"_d_{new}" if f"_d_{new}" in clash else new for c, new in renamed.items()}
    # Order columns that are added anyway are not moved a second time.
    ordered = {c: added.get(c, f"_o_{c}") for c in order_names}
    slim = dim.select(
        *[keyed(r, dim).alias(n) for (_, r), n in zip(pairs, names)],
        *[F.col(c).alias(name) for c, name in added.items()],
        *[F.col(c).alias(name) for c, name in ordered.items() if c not in added],
    )
    if expect == "one":
        slim = one_per_key(slim, names, [_renamed_order(c, ordered) for c in order_by] if order_by else None, what)
    if order_names:
        slim = slim.drop(*[name for c, name in ordered.items() if c not in added])
    left_keys = [(keyed(left, fact), n) for (left, _), n in zip(pairs, names)]
    if spread is None:
        spread = expect == "one" and order_by is not None
    out = keyed_join(fact, slim, left_keys, spread=spread).drop(*names, *clash.values())
    return out.withColumnsRenamed(clash) if clash else out


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """The same table, after checking at once that its key is unique; NULL keys do not count.

    Run it on a dimension when it is loaded, then join it with ``expect="unique"``.
    """
    repeated = df.na.drop("any", subset=list(keys)).groupBy(*keys).count().filter(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"{what}: several rows for one key {list(keys)}")
    return df


def _order_names(order_by: Order | None) -> list[str]:
    return [c for c, _ in (_split(o) for o in order_by or [])]


def _split(order) -> tuple[str, str]:
    """``"name desc"`` -> (name, direction)."""
    if not isinstance(order, str):
        raise TypeError("order_by of a join is given as text, e.g. 'updated desc'")
    name, _, direction = order.partition(" ")
    return name, direction.strip().lower() or "asc"


def _renamed_order(order: str, names: Mapping[str, str]) -> Column:
    name, direction = _split(order)
    c = F.col(names[name])
    return c.desc_nulls_last() if direction == "desc" else c.asc_nulls_first()


def star_join(fact: DataFrame, steps: Sequence[tuple]) -> DataFrame:
    """Chain of enrichments ``(dim, on, cols)`` or ``(dim, on, cols, options)`` in the given order."""
    for dim, on, cols, *options in steps:
        fact = enrich(fact, dim, on, cols, **(options[0] if options else {}))
    return fact


def role_join(
    fact: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, str], cols: Sequence[str], cast: str | None = None,
    expect: str = "one",
) -> DataFrame:
    """Join one dimension several times, ``{role: fact key}``; columns become ``role_column``."""
    for role, fact_key in roles.items():
        renamed = {c: f"{role}_{c}" for c in cols}
        fact = enrich(fact, dim, [(fact_key, key)], renamed, expect=expect, cast=cast, what=role)
    return fact


def not_in_history(
    df: DataFrame, history: DataFrame, key: str, where: Column | None = None, history_key: str | None = None
) -> DataFrame:
    """Rows whose key, as trimmed text, is not in the history (J11, U2). Rows without a key stay."""
    if where is not None:
        history = history.filter(where)
    seen = history.select(key_text(history[history_key or key]).alias("_seen")).distinct()
    return keyed_join(df, seen, [(key_text(df[key]), "_seen")], "left_anti")


def in_history(df: DataFrame, history: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    if where is not None:
        history = history.filter(where)
    seen = history.select(key_text(history[key]).alias("_seen")).distinct()
    return keyed_join(df, seen, [(key_text(df[key]), "_seen")], "left_semi")


def with_events(
    lines: DataFrame,
    events: DataFrame,
    on: Sequence[str],
    code: str,
    date: str,
    require: Mapping[int | str, str] | None = None,
    optional: Mapping[int | str, str] | None = None,
    forbid: Sequence[int | str] = (),
) -> DataFrame:
    """Lines that have the required events and none of the forbidden ones.

    An event counts only with a date. The date of required and optional events is
    added under the given name, the newest one when an event repeats (G24). All
    codes are folded in one aggregation of the event table, so there is a single
    join instead of one per code.
    """
    require, optional = dict(require or {}), dict(optional or {})
    codes = [*require, *optional, *forbid]
    dates = [
        F.max(F.when(F.col(code) == k, F.col(date))).alias(name) for k, name in {**require, **optional}.items()
    ]
    banned = F.max(F.col(code).isin(*forbid)).alias("_banned") if forbid else F.lit(False).alias("_banned")
    folded = (
        events.filter(F.col(code).isin(*codes) & F.col(date).isNotNull())
        .groupBy(*[F.col(c).alias(f"_e_{c}") for c in on])
        .agg(*dates, banned)
    )
    out = keyed_join(lines, folded, [(lines[c], f"_e_{c}") for c in on])
    out = out.filter(~F.coalesce(F.col("_banned"), F.lit(False)))
    for name in require.values():
        out = out.filter(F.col(name).isNotNull())
    return out.select(*lines.columns, *require.values(), *optional.values())


def with_state(df: DataFrame, state: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Saved state joined to today's rows; a missing counter takes its default."""
    out = enrich(df, state, [key], what="state")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def enrich_distinct(df: DataFrame, side: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Left join to the distinct ``key, cols`` of a line table; several different rows per key multiply."""
    side = side.select(key_text(key).alias("_key"), *cols).distinct()
    return df.join(side, key_text(df[key]) == F.col("_key"), "left").drop("_key")


def match_one(
    surveys: DataFrame, lines: DataFrame, key: str, line_key: str, worst_by: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """At most one line per survey document, the first by ``worst_by``; the survey count never changes."""
    return enrich(surveys, lines, [(key, line_key)], cols, order_by=worst_by, what="lines")


def cells(n: Column, rows: int) -> Column:
    """Cells along a side of ``n`` rows: so many that each has ``rows`` at most, but no more than ``CELLS``."""
    return F.least(F.ceil(n / rows), F.lit(CELLS)).cast("int")


def split_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, cols: Sequence[str], rows: int = 2000, what: str = "left"
) -> DataFrame:
    """All pairs of rows with equal keys, where a key may be frequent on both sides.

    AQE splits a hot partition of one side and repeats the other one whole, so a key that holds half of both
    multiplies in one place. Here the rows of every key are counted on both sides (partial aggregation), and the
    pairs of a key with more than ``rows`` rows on a side are cut into a rectangle of cells of ``rows`` by ``rows``
    at most, on average: a left row falls into one row of cells by its hash and is repeated for the cells of it, a right
    row into one column. Cells are keys of the join, so each goes to a task of its own. Other keys have one cell.
    A side has ``CELLS`` cells at most: what is dealt grows with the rows, not with their square, and cells of very
    frequent keys get larger in place of more. The join streams a cell's left rows over its right ones, which Spark spills.

    ``what`` is ``left`` (left rows without a partner stay, with NULLs) or ``inner``. ``cols`` are the right columns to add.
    Rows that are equal in all columns fall into the same cell.
    """
    if what not in ("left", "inner"):
        raise ValueError(f"what must be 'left' or 'inner', not {what!r}")
    sizes = [df.groupBy(F.col(k).alias(f"_k{i}")).agg(F.count(F.lit(1)).alias(f"_n{i}")) for i, (df, k) in enumerate(((left, left_key), (right, right_key)))]
    both = sizes[0].join(sizes[1], F.col("_k0") == F.col("_k1")).filter((F.col("_n0") > rows) | (F.col("_n1") > rows))
    sides = [cells(F.col(f"_n{i}"), rows).alias(name) for i, name in enumerate(("_rows", "_columns"))]
    hot = written(both.select(F.col("_k0").alias("_hot"), *sides), "hot-keys")

    def placed(df: DataFrame, key: str, own: str, other: str, names: Sequence[str]) -> DataFrame:
        """Rows with their own coordinate, once for every cell along the other one."""
        row = F.xxhash64(*df.columns)
        out = keyed_join(df, hot, [(df[key], "_hot")])
        size = F.coalesce(own, F.lit(1))
        return out.select(
            *names, F.pmod(row, size).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)).alias(other),
            F.col("_hot").isNotNull().alias("_split"),
        )

    a = placed(left, left_key, "_rows", "_columns", left.columns)
    b = placed(right, right_key, "_columns", "_rows", right.columns)
    b = b.select(F.col(right_key).alias("_key"), F.col("_rows").alias("_r"), F.col("_columns").alias("_c"), F.struct(*cols).alias("_right"))
    test = (a[left_key] == F.col("_key")) & (F.col("_rows") == F.col("_r")) & (F.col("_columns") == F.col("_c"))
    out = a.join(b, test, what)
    if what == "left":
        # A hot key has partners, but a cell of it may have none.
        out = out.filter(~F.col("_split") | F.col("_right").isNotNull())
    return out.select(*[F.col(c) for c in left.columns if c not in cols], *[F.col("_right")[c].alias(c) for c in cols])
