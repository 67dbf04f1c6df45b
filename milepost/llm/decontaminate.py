"""Benchmark decontamination by a prefix-filtered set join over shingles, in DataFrame operations only.

A window is ``width`` consecutive words of an item, or a whole item that is shorter.
Its shingles are its word pairs (the word itself for a window of one word). They are
ordered by rarity in the documents; an exact occurrence holds all of them, so the
rarest alone is a necessary prefix. Documents' shingles meet the prefixes by hash;
position and length bounds leave the places where the window can lie, and there the
words are compared exactly.

The prefixes are one row per window. They are broadcast up to ``BROADCAST`` windows,
which the operator counts first; beyond that they are joined by shuffle and the
candidate places meet the words again by document.

Null and empty texts have no words; items without words have no windows. Documents
with equal id and text get equal rows, also where the id is null; items with equal ids count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Windows that may be broadcast: about 100 bytes each.
BROADCAST = 500_000
#: Fixed value: the bytes between words, after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), BETWEEN), "")


def windows(items: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """window, n (its words) of all distinct windows; and window, item_id."""
    size = F.size("words")
    every = items.select("item_id", words(F.col("text")).alias("words")).where(size > 0)
    every = every.withColumns({"n": F.least(size, F.lit(width)), "at": F.explode(F.sequence(F.lit(0), F.greatest(size - width, F.lit(0))))})
    every = written(every.select("item_id", "n", F.array_join(F.slice("words", F.col("at") + 1, F.col("n")), " ").alias("window")).distinct(), "windows")
    return every.select("window", "n").distinct(), every.select("window", "item_id")


def shingled(docs: DataFrame, pairs: bool) -> DataFrame:
    """A row for each place of each document, with the hash of its word pair or word."""
    rows = docs.select("id", "text_hash", "words", F.posexplode("words").alias("pos", "word"))
    return rows.withColumn("shingle", F.xxhash64("word", F.get("words", F.col("pos") + 1)) if pairs else F.xxhash64("word"))


def prefixes(docs: DataFrame, wins: DataFrame, pairs: bool, small: bool) -> DataFrame:
    """window, n, shingle, shift: the rarest shingle of each window and its place there."""
    parts = F.split("window", " ")
    every = wins.select("window", "n", F.posexplode(parts).alias("shift", "word"), parts.alias("parts"))
    if pairs:
        every = every.where(F.col("shift") < F.col("n") - 1).withColumn("shingle", F.xxhash64("word", F.get("parts", F.col("shift") + 1)))
    else:
        every = every.withColumn("shingle", F.xxhash64("word"))
    every = written(every.select("window", "n", "shift", "shingle"), "item-shingles")
    wanted = every.select("shingle").distinct()
    found = shingled(docs, pairs).join(F.broadcast(wanted) if small else wanted, "shingle").groupBy("shingle").agg(F.count("*").alias("places"))
    rank = F.struct(F.coalesce("places", F.lit(0)).alias("places"), F.col("shift"), F.col("shingle"))
    best = every.join(found, "shingle", "left").groupBy("window", "n").agg(F.min(rank).alias("best"))
    # A window with a shingle that no document has can't occur.
    return best.where("best.places > 0").select("window", "n", F.col("best.shingle").alias("shingle"), F.col("best.shift").alias("shift"))


def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by id and text_hash, where null ids are equal."""
    right = right.withColumnsRenamed({"id": "_id", "text_hash": "_hash"})
    return left.join(right, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), how).drop("_id", "_hash")


def occurrences(docs: DataFrame, items_windows: DataFrame, width: int) -> DataFrame:
    """id, text_hash, start, n, window: every exact occurrence of a window in a document."""
    small = items_windows.count() <= BROADCAST
    lengths = {r["pairs"] for r in items_windows.select((F.col("n") > 1).alias("pairs")).distinct().collect()}  # at most two rows
    start, out = F.col("pos") - F.col("shift"), None
    for pairs in sorted(lengths):
        own = items_windows.where(F.col("n") > 1 if pairs else F.col("n") == 1)
        keys = written(prefixes(docs, own, pairs, small), "prefixes")
        fits = (start >= 0) & (start + F.col("n") <= F.size("words"))
        same = F.array_join(F.slice("words", start + 1, F.col("n")), " ") == F.col("window")
        if small:
            found = shingled(docs, pairs).join(F.broadcast(keys), "shingle").where(fits & same)
        else:
            places = shingled(docs, pairs).select("id", "text_hash", "pos", "shingle").join(keys, "shingle")
            found = joined(docs, places.where(start >= 0).distinct(), "inner").where(fits & same)
        found = found.select("id", "text_hash", start.alias("start"), "n", "window")
        out = found if out is None else out.union(found)
    if out is None:
        out = docs.select("id", "text_hash", F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit("").alias("window")).where(F.lit(False))
    return out.distinct()


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """id column, n_words, n_hit, n_items, items_sha256, contaminated for every document.

    A word is hit if it lies inside an occurrence of a window. items_sha256 hashes
    the ids of the items with occurring windows, sorted as strings and comma-joined.
    """
    texts = documents.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"), words(F.col(text_col)).alias("words"))
    docs = written(texts, "words")
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    wins, owners = windows(items, width)
    found = written(occurrences(docs, wins, width), "occurrences")

    spans = found.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans"))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit"))

    def add(seen: Column, x: Column) -> Column:
        end = x["start"] + x["n"]
        more = F.greatest(end - F.greatest(x["start"], seen["end"]), F.lit(0))
        return F.struct(F.greatest(end, seen["end"]).alias("end"), (seen["hit"] + more).alias("hit"))

    hits = spans.select("id", "text_hash", F.aggregate("spans", none, add, lambda x: x["hit"]).cast("long").alias("n_hit"))
    named = found.select("id", "text_hash", "window").distinct().join(owners, "window").select("id", "text_hash", F.col("item_id").cast("string").alias("item"))
    named = named.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("item")).alias("items"))
    both = joined(hits, named, "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    out = docs.select("id", "text_hash", F.size("words").cast("long").alias("n_words"))
    out = joined(out, both, "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def oracle(width: int = 10) -> str:
    """The same over ``documents`` and ``benchmark`` in DuckDB SQL."""
    split = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {split} AS w FROM documents),
b AS (SELECT item_id, {split} AS w FROM benchmark),
iw AS (SELECT item_id, k, array_to_string(w[s + 1:s + k], ' ') AS win FROM (
  SELECT item_id, w, least(len(w), {width}) AS k, unnest(range(0, greatest(len(w) - {width}, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, s, array_to_string(w[s + 1:s + k], ' ') AS win FROM (
  SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS s FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
h AS (SELECT DISTINCT doc_id, item_id, dw.s, dw.k FROM dw JOIN iw USING (k, win)),
p AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS x FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(p.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN i USING (doc_id)
"""
