"""A training corpus from ``documents`` in five stages, each applying one operator to all the rows before it.

A stage's result is written and reread before the next one begins, so what the earlier stages of
the same input folder left in the shared folder is deleted then; folders that the next stage's rows
still come from stay. ``run`` keeps a list of its own, so its result is never touched by another run.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.llm import decontaminate, langid, near_dup, pieces, suffix_dedup
from milepost.llm.queries import prepared, tokenizer
from milepost.session import discard, recorded, written

#: Scratch folders of the stages that were called by hand, by input folder.
LEFT: dict[str, list[str]] = {}


def stage(f):
    """The function of a stage, which first deletes the scratch folders of the stages before it and records its own."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, left: list[str] | None = None) -> DataFrame:
        if left is None:
            left = LEFT.setdefault(sf_dir, [])
            if f.__name__ == "language":  # a new pass over the folder; an older one's result may still be read
                left.clear()
        discard(spark, left, unless_read_by=[docs])
        with recorded(left):
            return f(prepared(spark), docs, sf_dir)

    return run_stage


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language: null, empty, without any letter, or scored below ``langid.least_score``.

    That is half of the score that 99 of 100 training rows reach; a score of 0 never passes.
    Where no training row has a language, nothing was learned and all documents with a letter go on.
    """
    train = docs.where(~langid.held_out("doc_id")).select("doc_id", "text", "lang")
    filters = langid.fit(train)
    if not filters.langs:
        return langid.predict(docs.select(*COLUMNS), langid.Filters(["any"], filters.table)).where(F.col("lang_pred") != langid.UND).select(*COLUMNS)
    least = langid.least_score(train, filters)
    found = langid.predict(docs.select(*COLUMNS), filters)
    return found.where((F.col("lang_pred") != langid.UND) & (F.col("score") > 0) & (F.col("score") >= least)).select(*COLUMNS)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a number each, written once: ids may be null, or those of several rows."""
    return written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), name)


def without(rows: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """The numbered rows but the dropped ones, whose numbers are written first.

    Spark then knows their size before it plans the join, and moves the texts only where the numbers are too many to broadcast.
    """
    return rows.join(written(dropped.select("row"), name), "row", "left_anti").select(*COLUMNS)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class: five-word shingles, similarity of 0.8 or more.

    It is the row with the smallest id, a null id being the largest; equal ids are told apart by their contents.
    """
    rows = numbered(docs, "numbered")
    found = near_dup.near_duplicates(rows, width=5, percent=80, id_col="row").select("row", "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", F.xxhash64(*COLUMNS).alias("contents"), "row")
    found = written(found.join(rows.select("row", order.alias("order")), "row"), "classes-of-rows")
    keepers = found.groupBy("component_id").agg(F.min("order")["row"].alias("row")).select("row")
    dropped = found.select("row").join(keepers, "row", "left_anti")
    return without(rows, dropped, "dropped")


@stage
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the byte strings of 400 bytes that occur twice out of every text; every document stays."""
    kept = suffix_dedup.remove_repeats(docs.select(*COLUMNS), 400, as_text=True).withColumn("text", F.col("kept"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item, or a whole shorter item."""
    rows = numbered(docs, "numbered")
    found = decontaminate.contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row")
    return without(rows, found.where("contaminated"), "contaminated")


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the piece ids of every text; a text that its ids don't give back goes on by its decoded form."""
    model = tokenizer("piece_bpe_32k.model")
    both = pieces.encode(docs.select(*COLUMNS), model, decoded_col="decoded")
    return both.withColumn("text", F.col("decoded")).select(*COLUMNS, "piece_ids")


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", decontamination),
    ("SentencePiece", tokens),
]

#: Language models, tokenizers and components by hashing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back for the next."""
    docs, left = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in STAGES[:-1]:
        docs = step(spark, docs, sf_dir, left)
        with recorded(left):
            docs = written(docs, name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir, left)
