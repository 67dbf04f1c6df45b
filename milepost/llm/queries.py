"""Driver queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from ..sources.tables import load
from . import decontaminate, merkle, spelling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Rows of an Arrow batch, where the session does not say: texts are long rows.
BATCH_ROWS = "2000"


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file; the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings, and the package's folder on the workers' path (elsewhere it is shipped by ``--py-files``)."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if key not in {k for k, _ in spark.sparkContext.getConf().getAll()}:
        spark.conf.set(key, BATCH_ROWS)
    return configure(spark)


def query(name: str, sql: str | None = None):
    """Register ``f(spark, folder)`` under a name, with its SQL where SQL can say it."""

    def register(f):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(prepared(spark), folder)

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


@query("op1_token_counts")
def op1(spark, folder):
    """Tokens of every document."""
    from .token_count import token_counts

    return token_counts(load(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


@query("op2_html_text")
def op2(spark, folder):
    """Main text of every page."""
    from .html_text import main_text

    return main_text(load(spark, folder, "pages"))


@query("op3_topk_search")
def op3(spark, folder):
    """The ten best documents for every document whose id is divisible by 100."""
    from .topk import search

    docs = load(spark, folder, "documents").select("doc_id", "text")
    return search(docs, docs.where(F.col("doc_id") % 100 == 0))


@query("op4_decontamination", decontaminate.oracle())
def op4(spark, folder):
    """Words of every document that lie inside ten-word windows of benchmark items."""
    return decontaminate.contamination(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@query("op5_near_duplicates")
def op5(spark, folder):
    """Near-duplicate classes of documents: two-word shingles, similarity of 0.8 or more."""
    from .near_dup import near_duplicates

    return near_duplicates(load(spark, folder, "documents"), width=2, percent=80)


@query("op6_suffix_dedup")
def op6(spark, folder):
    """Documents without the byte strings of 400 bytes that occur twice."""
    from . import suffix_dedup

    return suffix_dedup.digest(suffix_dedup.remove_repeats(load(spark, folder, "documents").select("doc_id", "text"), 400))


@query("op7_sharding")
def op7(spark, folder):
    """Shard and slot of every document."""
    from .sharding import shards

    return shards(load(spark, folder, "documents"))


@query("op8_lm_scoring")
def op8(spark, folder):
    """Log-likelihood of every document, learned from the nine tenths that are not held out."""
    from .lm import log_likelihoods

    return log_likelihoods(load(spark, folder, "documents"))


@query("op9_language_id")
def op9(spark, folder):
    """Language of every document, learned from the four fifths that are not held out."""
    from . import langid

    docs = load(spark, folder, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out("doc_id"))
    filters = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.drop("lang"), filters).select("doc_id", "held_out", "lang_pred", "score")


@query("op10_sentencepiece")
def op10(spark, folder):
    """Piece ids of every document and the text they decode to, as digests."""
    from . import pieces

    model = tokenizer("piece_bpe_32k.model")
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return pieces.digest(pieces.encode(docs, model, decoded_col="decoded"))


@query("op11_merkle_manifest", merkle.oracle())
def op11(spark, folder):
    """Merkle leaves, roots and proofs of all documents, and which of the tampered ones are found out."""
    return merkle.audit(load(spark, folder, "documents"))


@query("op12_spelling_variants", spelling.oracle())
def op12(spark, folder):
    """Words of all documents with their near words, the form they are a variant of, and its root."""
    return spelling.variants(load(spark, folder, "documents"))


@query("op13_substring_dedup")
def op13(spark, folder):
    """Documents without the passages of 50 words that a document with a smaller id has."""
    from . import recompress

    return recompress.digest(recompress.remove_repeats(load(spark, folder, "documents"), 50))
