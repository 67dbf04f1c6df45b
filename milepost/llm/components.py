"""Connected components of a link table, by hooking every vertex to its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component: the smallest vertex reachable, for every vertex with a link to another one.

    In each round a vertex hooks to the smaller of itself and its smallest
    neighbour, and links are drawn anew between what they hooked to, until none
    is left; then the hooks are followed through the rounds. Every round at least
    halves the vertices that still have links. All tables are in the shared
    folder, none passes through the driver.
    """
    links = written(links.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
    rounds = []
    while not links.isEmpty():
        both = links.union(links.select(F.col("b"), F.col("a")))
        hooks = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to")).select("id", F.least("id", "to").alias("to")), "hooks")
        rounds.append(hooks)
        of = [hooks.select(F.col("id").alias(x), F.col("to").alias(f"to_{x}")) for x in ("a", "b")]
        moved = links.join(of[0], "a").join(of[1], "b").where("to_a != to_b")
        links = written(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    out = rounds[0].select("id", F.col("to").alias("component"))
    for hooks in rounds[1:]:
        step = hooks.select(F.col("id").alias("component"), "to")
        out = out.join(step, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return written(out, "components")
