"""A Merkle manifest of a table: every row is a leaf, every source a tree, one tree over the sources.

The leaves of a source ascend by id, null first; leaves with equal ids by their digest. Runs of
``arity`` consecutive nodes become their hash, level by level, a last shorter run too, until one node
remains; what remains of the sources, ordered by source (null first, else by bytes), goes on likewise.
A hash is the lowercase hex SHA-256 of its inputs, concatenated.

A level is made by sibling-shift self-joins: for every shift from 1 to arity - 1 each node is equijoined
with the node of its run whose slot lies that many further on, wrapping round (with two slots that is
the XOR of the lowest bit), and the row at slot 0 emits the parent from itself and what the shifts
brought. The same rows are the siblings of a proof: they are joined downwards, from the root to the
leaves, each node handing the path above it to the nodes of its run.

Nodes are numbered by a range sort and the counts of the ranges, so that no source is ever in one task.
Levels are small tables in the shared folder, a third as large each; none passes through the driver,
which learns only how many levels there are.

Nulls are written ``-``, so a null and an empty value differ. Rows with equal contents are leaves of
their own. A row with a null id isn't tampered with in ``audit``. Other columns are not read. An empty
table has no leaf and no root, and its manifest is empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else the byte count of its text, ``:`` and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: Sequence[Column]) -> Column:
    return digest(*[encoded(c) for c in fields])


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``tree`` (the number of their group in group order), ``idx`` (gapless in the group) and ``n`` (rows of the group).

    Sorted by range and written once; of each range only one row for every group in it is gathered.
    """
    spark = rows.sparkSession
    parts, at = int(spark.conf.get("spark.sql.shuffle.partitions")), F.monotonically_increasing_id()
    ranked = rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    ranked = written(ranked.withColumns({"_part": F.shiftright(at, 33).cast("int"), "_place": at.bitwiseAND((1 << 33) - 1)}), "ranked")
    runs = written(ranked.groupBy("_part", group).agg(F.min("_place").alias("first"), F.count("*").alias("size")), "runs")
    # A range holds its groups in order, so trees are numbered by range, then by place in it.
    starts = runs.withColumn("before", F.lag("_part").over(Window.partitionBy(group).orderBy("_part")))
    starts = written(starts.where("before IS NULL").select("_part", F.col(group).alias("_group"), "first"), "starts")
    per_part = written(starts.groupBy("_part").agg(F.count("*").alias("new")), "new-trees")  # a row for each range at most
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = per_part.select("_part", F.coalesce(F.sum("new").over(before), F.lit(0)).alias("trees"))
    trees = starts.join(sums, "_part").select("_group", (F.col("trees") + F.row_number().over(Window.partitionBy("_part").orderBy("first")) - 1).alias("tree"))
    own = Window.partitionBy(group)
    base = runs.select(
        "_part", group, "first",
        F.coalesce(F.sum("size").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("size").over(own).alias("n"),
    )
    base = base.join(trees, F.col(group).eqNullSafe(F.col("_group"))).select(F.col("_part").alias("p"), F.col(group).alias("g"), "first", "base", "n", "tree")
    base = written(base, "bases")
    out = ranked.join(base, (F.col("_part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g")))
    return out.withColumn("idx", F.col("base") + F.col("_place") - F.col("first")).drop("_part", "_place", "p", "g", "first", "base")


def siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """Nodes (tree, idx, n, h) with ``s1`` to ``s{arity - 1}``: the digests at the slots after theirs in the run, wrapping round; null where the run is shorter."""
    out = nodes.withColumns({"run": F.expr(f"idx div {arity}"), "slot": (F.col("idx") % arity).cast("int")})
    for shift in range(1, arity):
        other = nodes.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("h").alias(f"s{shift}"))
        sibling = F.col("run") * arity + (F.col("slot") + shift) % arity
        out = out.join(other, (F.col("tree") == F.col("_tree")) & (sibling == F.col("_idx")), "left").drop("_tree", "_idx")
    return out


def sides(arity: int = ARITY) -> tuple[Column, Column]:
    """Digests left and right of a node in its run, each concatenated in order of the slots."""
    left, right = [], []
    for slot in range(arity):
        own = F.col("slot") == slot
        at = {(slot + shift) % arity: F.col(f"s{shift}") for shift in range(1, arity)}
        left.append((own, F.concat_ws("", *[at[i] for i in range(slot)])))
        right.append((own, F.concat_ws("", *[at[i] for i in range(slot + 1, arity)])))

    def pick(cases):
        out = F.when(*cases[0])
        for case in cases[1:]:
            out = out.when(*case)
        return out

    return pick(left), pick(right)


def climb(nodes: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """Levels (tree, idx, n, run, lhs, rhs: digests on either side) from the leaves up, and tops (tree, h).

    ``nodes`` has tree, idx, n, h. A tree leaves the climb at the level where one node is left.
    """
    levels, tops = [], None
    left, right = sides(arity)
    at = written(nodes.select("tree", "idx", "n", "h"), "level")
    while True:
        top = at.where("n = 1").select("tree", "h")
        tops = top if tops is None else tops.union(top)
        open_ = at.where("n > 1")
        if open_.isEmpty():
            return levels, tops
        shifted = siblings(open_, arity)
        level = written(shifted.select("tree", "idx", "n", "run", "slot", "h", left.alias("lhs"), right.alias("rhs")), "siblings")
        levels.append(level)
        parents = level.where("slot = 0").select("tree", F.col("run").alias("idx"), F.ceil(F.col("n") / arity).alias("n"), digest(F.col("h"), F.col("rhs")).alias("h"))
        at = written(parents, "level")


def paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """tree, idx, path of every leaf with siblings: (lhs, rhs) of it and of its ancestors, upwards, ending with ``above`` (tree, path)."""
    below = None
    for level in reversed(levels):
        own = F.array(F.struct("lhs", "rhs"))
        last = F.col("n") <= ARITY  # its parent is the top of the tree
        rows = level.where(last).join(above, "tree").select("tree", "idx", F.concat(own, "path").alias("path"))
        if below is not None:
            up = below.select(F.col("tree").alias("_tree"), F.col("idx").alias("_run"), "path")
            inner = level.where(~last).join(up, (F.col("tree") == F.col("_tree")) & (F.col("run") == F.col("_run")))
            rows = rows.union(inner.select("tree", "idx", F.concat(own, "path").alias("path")))
        below = rows if level is levels[0] else written(rows, "paths")
    return below


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, start, lambda h, x: F.sha2(F.concat(x["lhs"], h, x["rhs"]), 256))


def proof(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["lhs"], x["rhs"])), ""), 256)


def manifest(rows: DataFrame, id_col: str = "doc_id", group_col: str = "source", leaf_col: str = "leaf") -> DataFrame:
    """The rows with ``subroot``, ``root`` and ``path`` (array of lhs and rhs, from the leaf up to the root).

    ``rows`` is read several times; pass a stored one.
    """
    keep = [c for c in rows.columns]
    order = rows.select(F.struct(*keep).alias("row"), F.col(group_col).alias("_source"), F.col(id_col).alias("_id"), F.col(leaf_col).alias("h"))
    leaves = written(numbered(order, "_source", ["_id", "h"]), "leaves")
    levels, tops = climb(leaves)
    tops = written(tops, "tops")
    upper = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").cast("long").alias("idx"), F.lit(tops.count()).cast("long").alias("n"), "h")
    high, root = climb(upper)
    root = written(root.select(F.col("h").alias("root")), "root")  # one row, or none
    empty = F.array().cast("array<struct<lhs:string,rhs:string>>")
    over = paths(high, root.select(F.lit(0).cast("long").alias("tree"), empty.alias("path"))) if high else None
    named = tops.select(F.col("tree").cast("long").alias("tree"), F.col("h").alias("subroot"))
    over = named.withColumn("path", empty) if over is None else named.join(over.select(F.col("idx").alias("tree"), "path"), "tree")
    over = written(over.join(F.broadcast(root)), "over")  # a row for each source
    up = over.select("tree", "path")
    found = paths(levels, up) if levels else up.withColumn("idx", F.lit(0).cast("long")).where(F.lit(False)).select("tree", "idx", "path")
    single = leaves.where("n = 1").join(up, "tree").select("tree", "idx", "path")
    found = found.select("tree", "idx", "path").union(single)
    out = leaves.select("row", "tree", "idx").join(found, ["tree", "idx"]).join(over.select("tree", "subroot", "root"), "tree")
    return out.select("row.*", "subroot", "root", "path")


def audit(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text") -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root that its proof gives for a text without line feeds.

    Rows whose id's CRC-32 is even are tampered with: their text loses its line feeds. ``verified`` tells
    whether the folded root is the true one.
    """
    odd = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    tampered = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text_col else F.col(c) for c in fields]
    own = leaf([F.col(c) for c in fields])
    changed = odd & F.contains(F.coalesce(text_col, F.lit("")), F.lit("\n"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("source"), own.alias("leaf"), F.when(changed, leaf(tampered)).alias("tampered"))
    found = manifest(written(rows, "manifest-rows"), "id", "source")
    start = F.coalesce("tampered", "leaf")
    out = found.select(F.col("id").alias(id_col), "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), fold(start, F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


CRC32 = """list_reduce(list_concat([4294967295::BIGINT], flatten([[ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0] for c in string_split({0}, '')])),
  lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384::BIGINT))"""


def oracle(arity: int = ARITY) -> str:
    """``audit`` of ``documents`` in DuckDB SQL."""

    def field(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    plain = " || ".join(field(c) for c in FIELDS)
    other = plain.replace("text", "replace(text, chr(10), '')")
    grow = f"""
  SELECT level + 1, tree, idx // {arity}, (any_value(n) + {arity - 1}) // {arity}, sha256(string_agg(h, '' ORDER BY idx)) FROM {{0}} WHERE n > 1 GROUP BY level, tree, idx // {arity}"""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, source, sha256({plain}) AS leaf,
  CASE WHEN xor({CRC32.format("doc_id::VARCHAR")}, 4294967295) % 2 = 0 THEN sha256({other}) ELSE sha256({plain}) END AS start FROM documents),
l AS (SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY source) AS n FROM d),
low(level, tree, idx, n, h) AS (SELECT 0, tree, idx, n, leaf FROM l UNION ALL {grow.format("low")}),
subs AS (SELECT tree, h, count(*) OVER () AS n FROM low WHERE n = 1),
high(level, tree, idx, n, h) AS (SELECT 100, -1::BIGINT, tree, n, h FROM subs UNION ALL {grow.format("high")}),
runs AS (SELECT level, tree, idx // {arity} AS run, any_value(n) AS n, list(h ORDER BY idx) AS hs FROM (SELECT * FROM low UNION ALL SELECT * FROM high) WHERE n > 1 GROUP BY ALL),
walk(doc, level, tree, idx, h, siblings) AS (SELECT rowid, level, tree, idx, h, s FROM (SELECT row_number() OVER () AS rowid, 0 AS level, tree, idx, start AS h, '' AS s FROM l)
  UNION ALL SELECT doc, CASE WHEN r.level IS NULL THEN 100 ELSE w.level + 1 END, CASE WHEN r.level IS NULL THEN -1 ELSE w.tree END, CASE WHEN r.level IS NULL THEN w.tree ELSE w.idx // {arity} END,
    CASE WHEN r.level IS NULL THEN w.h ELSE sha256(array_to_string(hs[:w.idx % {arity}], '') || w.h || array_to_string(hs[w.idx % {arity} + 2:], '')) END,
    siblings || CASE WHEN r.level IS NULL THEN '' ELSE array_to_string(hs[:w.idx % {arity}], '') || array_to_string(hs[w.idx % {arity} + 2:], '') END
  FROM walk w LEFT JOIN runs r ON r.level = w.level AND r.tree = w.tree AND r.run = w.idx // {arity} WHERE w.tree >= 0 OR r.level IS NOT NULL),
ends AS (SELECT doc, arg_max(h, level) AS h, arg_max(siblings, level) AS siblings FROM walk GROUP BY doc),
numbered AS (SELECT *, row_number() OVER () AS doc FROM l)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(siblings) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM numbered JOIN ends e USING (doc) JOIN subs s USING (tree), (SELECT h FROM high WHERE n = 1) t
"""
