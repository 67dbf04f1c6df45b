"""Large delimited uploads read by many tasks, with the place of every row in its file.

A quoted field may hold line ends, so a split of a file cannot tell by itself where its
first record starts. Every line is read by the split that it begins in, and counted by the task that
reads it, batch by batch in their order, so lines are not moved to be put in order. One pass counts, for each
split, its quotes and the records that start in it if it begins outside a quoted field, and if it
begins inside one. Running sums over the splits, one row each, say which of the two holds and how many
records came before. The second pass joins the lines of a record where they are; only records
over the end of a batch or split are put together by a shuffle of their parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import read_upload

SPLIT = ["file", "block"]
#: As ``read_upload`` reads: a quote within a field is doubled, line ends within a field stay.
OPTIONS = {"escape": '"', "multiLine": "true"}


def _before(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _upto(value: Column, window) -> Column:
    return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, 0))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its split, whether it has an odd number of quotes, and whether it is blank."""
    value = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        ((F.octet_length(value) - F.octet_length(F.translate(value, '"', ""))) % 2 == 1).alias("quotes"),
        value.isin("", "\r").alias("blank"),
    )


def _running():
    """A function to sum values up to each line, within its split; made by value, so that workers don't import this package."""

    def running(values: np.ndarray, starts: np.ndarray, before: int) -> np.ndarray:
        # The lines ahead of the first start go on from ``before``.
        sums = np.cumsum(values, dtype=np.int64)
        offsets = np.concatenate(([-before], (sums - values)[starts]))
        return sums - offsets[np.cumsum(starts)]

    return running


def _counts(lines: DataFrame) -> DataFrame:
    """Per split, in parts: quotes, and the records that begin under both assumptions on the split's beginning."""
    running = _running()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, odd = None, 0  # of the line before
        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
            codes = files.indices.to_numpy()
            quotes, blank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            starts = np.concatenate(([split != (files[0].as_py(), int(blocks[0]))], (codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])))
            after = running(quotes, starts, odd)
            before = (after - quotes) % 2
            first = np.flatnonzero(np.concatenate(([True], starts[1:])))
            sums = [np.add.reduceat(x.astype(np.int64), first) for x in (quotes, ~blank & (before == 0), ~blank & (before == 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first)), pa.array(blocks[first]), *map(pa.array, sums)], ["file", "block", "quotes", "if_outside", "if_inside"])
            split, odd = (files[-1].as_py(), int(blocks[-1])), int(after[-1]) % 2

    return lines.select(*SPLIT, "quotes", "blank").mapInArrow(run, "file string, block long, quotes long, if_outside long, if_inside long")


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: whether it begins inside a field, and the records that its file and all files had before."""
    in_file, overall = Window.partitionBy("file").orderBy("block"), Window.orderBy(*SPLIT)
    splits = _counts(lines).groupBy(*SPLIT).agg(*[F.sum(c).alias(c) for c in ("quotes", "if_outside", "if_inside")])
    unclosed = F.lead("block").over(in_file).isNull() & (_upto(F.col("quotes"), in_file) % 2 == 1)
    starts = F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    splits = splits.withColumns({"inside": _before(F.col("quotes"), in_file) % 2, "unclosed": unclosed})
    message = F.concat(F.lit("upload with an unclosed quote: "), "file")
    splits = splits.withColumn("starts", F.when(F.col("unclosed"), F.raise_error(message).cast("long")).otherwise(starts))
    splits = splits.withColumn("in_file", _before(F.col("starts"), in_file))
    headers = _upto(F.when((F.col("in_file") == 0) & (F.col("starts") > 0), 1).otherwise(0), overall)
    return splits.withColumn("rows_before", _before(F.col("starts"), overall) - headers).select(*SPLIT, F.row_number().over(overall).alias("split"), "inside", "in_file", "rows_before")


def _parts(lines: DataFrame) -> DataFrame:
    """position, block, line, value, whole: the lines of each record joined, as far as a batch and split holds them."""
    running = _running()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, odd, begun, line = None, 0, 0, 0  # of the line before
        for batch in batches:
            if not batch.num_rows:
                continue
            split, block, inside, in_file, rows_before = (batch.column(i).to_numpy() for i in (0, 1, 5, 6, 7))
            quotes, blank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            starts = np.concatenate(([split[0] != last], split[1:] != split[:-1]))
            after = (running(quotes, starts, odd) + inside) % 2
            before = after ^ quotes
            begins = ~blank & (before == 0)
            begun_ = running(begins, starts, begun)
            lines_ = running(np.ones(len(split), np.int64), starts, line)
            kept = np.flatnonzero((~blank | (before == 1)) & (in_file + begun_ > 1))
            last, odd, begun, line = split[-1], int(after[-1] ^ inside[-1]), int(begun_[-1]), int(lines_[-1])
            if not len(kept):
                continue
            position = (rows_before + begun_ - 1)[kept]
            first = np.flatnonzero(np.concatenate(([True], (position[1:] != position[:-1]) | (split[kept][1:] != split[kept][:-1]))))
            bounds = np.append(first, len(kept))
            parts = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), batch.column(2).take(pa.array(kept)))
            whole = begins[kept[first]] & (after[kept[bounds[1:] - 1]] == 0)
            columns = [pa.array(position[first]), pa.array(block[kept[first]]), pa.array(lines_[kept[first]]), pc.binary_join(parts, "\n"), pa.array(whole)]
            yield pa.RecordBatch.from_arrays(columns, ["position", "block", "line", "value", "whole"])

    lines = lines.select("split", "block", "value", "quotes", "blank", "inside", "in_file", "rows_before")
    return lines.mapInArrow(run, "position long, block long, line long, value string, whole boolean")


def records(spark: SparkSession, path: str) -> DataFrame:
    """``position`` (0, 1, ... through all files in order of their paths) and ``record`` of every record but the headers."""
    lines = _lines(spark, path)
    # One row per split of the input, as the driver lists them for the scan.
    placed = _parts(lines.join(F.broadcast(_splits(lines)), SPLIT))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = F.array_join(F.transform(parts, lambda x: x["value"]), "\n")
    out = placed.where("whole").select("position", F.col("value").alias("record")).unionAll(
        placed.where("NOT whole").groupBy("position").agg(joined.alias("record"))
    )
    record = F.col("record")
    return out.withColumn("record", F.when(record.endswith("\r"), F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(record))


def read_upload_split(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """The rows of ``read_upload``, read by as many tasks as the text has splits, every column as text.

    ``path`` is a file or a folder of files with the same header. ``position`` names a column to add with the
    row's number, without gaps, headers and blank lines left out, files in order of their paths. Lines end
    in line feeds, with or without a carriage return. Quotes must pair up within each record (a field with
    one is quoted and doubles it); an odd number of them in a file fails. A record that spans several
    splits is put together whole. A file without rows gives none.
    """
    names = read_upload(spark, path).columns
    fields = ", ".join(f"`c{i}` STRING" for i in range(len(names)))
    found = records(spark, path).select("position", F.from_csv("record", fields, OPTIONS).alias("r"))
    out = [F.col("r")[f"c{i}"].alias(n) for i, n in enumerate(names)]
    return found.select(*out, *([F.col("position").alias(position)] if position else []))
