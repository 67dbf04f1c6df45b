"""Incremental forms of the batch operators as Structured Streaming micro-batches (ST1-ST3).

All of them run on the ``availableNow`` trigger by default: a scheduled run takes what has arrived and
stops. Keyed state lives in Spark's state store, and a batch writes only the rows that it changed, into a
folder of its own run and batch number. A batch that is repeated after a failure overwrites that
folder, so no protocol of commits is needed; a fresh checkpoint is a new run and adds to what is stored.
For large state, set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import contact
from ..functions import fixed_values as fixed
from ..functions.dates import AsOf
from ..functions.text import is_blank, key_text
from ..operators.joins import keyed_join, not_in_history
from ..operators.keyed import Order, latest_per_key
from ..plans import tracker
from ..session import written
from ..sources.buckets import BucketTable, upsert_buckets
from ..sources.tables import delete_path, empty, path_exists

#: Partition columns of what batches write: the run (the id that a checkpoint keeps) and the batch.
RUN, BATCH = "corrida", "lote"
#: Partition column of logs with a bounded history.
DAY = "dia"


def _start(stream: DataFrame, step, checkpoint: str, trigger: dict | None, mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(step)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _batch_folder(batch: DataFrame, batch_id: int, path: str) -> str:
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{path}/{RUN}={run}/{BATCH}={batch_id}"


def stream_latest(stream: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Latest row per key as a stateful streaming aggregation, for ``update`` mode sinks (ST1).

    The latest row is the one with the largest values of ``order_by``, compared in turn (NULL is
    the smallest); other columns break ties. Only the keys of a batch are touched; the state store holds the rest.
    """
    rest = [c for c in stream.columns if c not in keys]
    ordered = [*order_by, *[c for c in rest if c not in order_by]]
    latest = stream.groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("_row"))
    return latest.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in stream.columns])


def stream_upsert(
    stream: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Latest row per key of an event stream, kept below ``path`` (ST1).

    The state store decides what a batch changes, and those rows are all it writes: the files of a
    batch grow with the batch, not with the table. ``read_latest`` gives the table, ``compact`` shortens it.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(batch, batch_id, path))

    return _start(stream_latest(stream, keys, order_by), step, checkpoint, trigger, "update")


def read_latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Table of ``stream_upsert``: of all rows that batches wrote, the newest one per key.

    Every stored row was its key's latest once, so rows of other runs, repeated or half-written batches
    and rows that a compaction left behind change nothing.
    """
    if not path_exists(spark, path):
        return empty(spark, schema)
    rows = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    rest = sorted({*schema.fieldNames()} - {*keys, *order_by})
    return latest_per_key(rows, keys, [F.col(c).desc_nulls_last() for c in (*order_by, *rest)])


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order_by: Sequence[str]) -> None:
    """Put the newest rows in one folder and remove the batches they came from.

    Batches that arrive meanwhile stay. Cut off anywhere, it leaves rows twice at worst, which
    ``read_latest`` folds. Run it when batches outweigh the table.
    """
    # One row for each batch since the last compaction.
    old = spark.read.schema(schema).parquet(path).select(RUN, BATCH).distinct().collect() if path_exists(spark, path) else []
    if len(old) < 2:
        return
    newest = written(read_latest(spark, path, schema, keys, order_by), "compacted")
    base = 1 + max((int(r[BATCH]) for r in old if r[RUN] == "base"), default=-1)
    newest.write.mode("overwrite").parquet(f"{path}/{RUN}=base/{BATCH}={base}")
    for r in old:
        delete_path(spark, f"{path}/{RUN}={r[RUN]}/{BATCH}={r[BATCH]}")


def capture_run(
    feed: DataFrame, sends: DataFrame, state: BucketTable, points: str, as_of: AsOf, checkpoint: str, trigger: dict | None = None,
    time_format: str | None = None, **options,
) -> bool:
    """One location capture over what a feed stream has brought since the last run (ST2).

    The points are folded to the newest one of each phone, however many batches they come in, and kept
    below ``points``. Then one capture rewrites the touched buckets of ``state`` (keyed by NUM_RESERVA), so an
    attempt counts once per run. A run without new points is skipped; batches that were captured are listed below
    ``points``-captured, so a run that failed before its capture makes up for it. Returns whether it captured.
    """
    spark = sends.sparkSession
    own = feed.filter(~is_blank("latitud") & ~is_blank("longitud"))
    when = tracker.parse_timestamp("fecha", time_format) if time_format else F.col("fecha")
    own = own.withColumns({"clientUid": contact.phone_key("clientUid"), "_when": when, "_first": F.negative("posicion")})
    order = ["_when", "_first"]
    stream_upsert(own, points, ["clientUid"], order, checkpoint, trigger).awaitTermination()
    kinds = T.StructType([T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])
    if not path_exists(spark, points):
        return False
    there = spark.read.schema(own.schema).parquet(points).select(F.col(RUN).cast("string").alias(RUN), F.col(BATCH).cast("long").alias(BATCH)).distinct()
    seen = f"{points}-captured"
    done = spark.read.schema(kinds).parquet(seen) if path_exists(spark, seen) else empty(spark, kinds)
    fresh = written(there.join(done, [RUN, BATCH], "left_anti"), "fresh-batches")
    if fresh.isEmpty():
        return False
    newest = read_latest(spark, points, own.schema, ["clientUid"], order).drop(*order)
    answered = tracker.match_coordinates(sends, state.read(spark), newest, as_of, time_format=time_format, **options)
    upsert_buckets(state, answered.filter(F.col("NUM_RESERVA").isNotNull()), on_dup="unique")
    fresh.write.mode("append").parquet(seen)
    return True


def stream_attempts(sends: DataFrame, feed: DataFrame, delay: str, span: str = "1 day") -> DataFrame:
    """Outcome of every day's sends by event time, each emitted when its day is over (ST2).

    ``sends`` has NUM_RESERVA, FONO_CLI and FECHA_ENVIO, ``feed`` clientUid, latitud, longitud and fecha; both
    times are timestamps. Of each day the last send of a reservation and the newest point of its phone count.
    Watermarks (the slower stream's newest time less ``delay``) say when a day is over: then its
    reservations are closed, with the point or without answer; no feed row is needed for that. Rows
    that come later than that are dropped. State holds the days that are open, one row for each reservation and phone.
    """
    day = F.window("_time", span)
    sent = sends.select(key_text("NUM_RESERVA").alias("NUM_RESERVA"), contact.phone_key("FONO_CLI").alias("FONO_CLI"), F.col("FECHA_ENVIO").cast("timestamp").alias("_time"))
    sent = sent.filter(F.col("NUM_RESERVA").isNotNull()).withWatermark("_time", delay)
    sent = sent.groupBy(day, "NUM_RESERVA").agg(F.max(F.struct("_time", "FONO_CLI")).alias("_send"))
    sent = sent.select("window", "NUM_RESERVA", F.col("_send.FONO_CLI").alias("FONO_CLI"))
    seen = feed.filter(~is_blank("latitud") & ~is_blank("longitud"))
    seen = seen.select(contact.phone_key("clientUid").alias("_phone"), "latitud", "longitud", F.col("fecha").cast("timestamp").alias("_time")).withWatermark("_time", delay)
    seen = seen.groupBy(day, "_phone").agg(F.max(F.struct("_time", "latitud", "longitud")).alias("_point"))
    seen = seen.select(F.col("window").alias("_window"), "_phone", "_point")
    joined = sent.join(seen, (F.col("window") == F.col("_window")) & (F.col("FONO_CLI") == F.col("_phone")), "left_outer")
    return joined.select(
        F.col("window.start").cast("timestamp_ntz").alias("DIA"), "NUM_RESERVA", "FONO_CLI",
        F.col("_point.latitud").alias("LATITUD"), F.col("_point.longitud").alias("LONGITUD"), F.col("_point._time").cast("timestamp_ntz").alias("FECHA_COORDENADA"),
        F.when(F.col("_point").isNotNull(), fixed.STATE_FOUND).otherwise(fixed.STATE_NO_ANSWER).alias("ESTADO"),
    )


def stream_closed(
    sends: DataFrame, feed: DataFrame, path: str, checkpoint: str, delay: str, trigger: dict | None = None
) -> StreamingQuery:
    """Closed days of ``stream_attempts`` as a log below ``path``, each row once."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(batch, batch_id, path))

    return _start(stream_attempts(sends, feed, delay), step, checkpoint, trigger)


def attempts(closed: DataFrame) -> DataFrame:
    """State of each reservation from its closed days: the first answer, and the days waited for it, its own included.

    One partial aggregation for the first answer, one for the days up to it.
    """
    found = closed.filter(F.col("ESTADO") == fixed.STATE_FOUND).groupBy(F.col("NUM_RESERVA").alias("_key")).agg(
        F.min(F.struct("DIA", "FONO_CLI", "LATITUD", "LONGITUD", "FECHA_COORDENADA")).alias("_hit")
    )
    joined = keyed_join(closed, found, [(closed["NUM_RESERVA"], "_key")])
    waited = joined.filter(F.col("_hit").isNull() | (F.col("DIA") <= F.col("_hit.DIA")))
    out = waited.groupBy("NUM_RESERVA").agg(
        F.count_distinct("DIA").cast("long").alias("INTENTOS"), F.max(F.struct("DIA", "FONO_CLI")).alias("_last"), F.max("_hit").alias("_hit")
    )
    return out.select(
        "NUM_RESERVA", F.col("_last.FONO_CLI").alias("FONO_CLI"), F.col("_hit.LATITUD").alias("LATITUD"), F.col("_hit.LONGITUD").alias("LONGITUD"),
        F.col("_hit.FECHA_COORDENADA").alias("FECHA_COORDENADA"), F.col("_last.DIA").alias("DIA"),
        F.when(F.col("_hit").isNotNull(), fixed.STATE_FOUND).otherwise(fixed.STATE_NO_ANSWER).alias("ESTADO"), "INTENTOS",
    )


def _look_back(spark: SparkSession, path: str, schema: T.StructType, key: str, since, until, batch: str) -> DataFrame:
    """_key and dia of what earlier batches logged from ``since`` to ``until``; other days are not read."""
    logged = T.StructType([*schema.fields, T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.StringType())])
    past = spark.read.schema(logged).parquet(path) if path_exists(spark, path) else empty(spark, logged)
    past = past.filter((F.col(DAY) >= F.lit(since)) & (F.col(DAY) <= F.lit(until)) & (F.col(BATCH) != batch))
    return past.select(key_text(key).alias("_key"), DAY)


def first_of_spans(rows: DataFrame, past: DataFrame, key: str, days: int) -> DataFrame:
    """_key and dia of the rows to log: going by day, those whose key has no logged day in the ``days`` before or on it.

    What is gathered for a key are its days in the batch and in the look-back, not its rows.
    """
    own = rows.groupBy(key_text(key).alias("_key")).agg(F.array_sort(F.collect_set(DAY)).alias("_own"))
    own = own.filter(F.col("_key").isNotNull())
    logged = past.groupBy("_key").agg(F.collect_set(DAY).alias("_logged"))
    both = own.join(logged, "_key", "left")
    none = F.array().cast("array<date>")

    def near(known: Column, day: Column) -> Column:
        return F.exists(known, lambda x: (x <= day) & (x >= F.date_sub(day, days)))

    start = F.coalesce("_logged", none)
    taken = F.aggregate("_own", F.struct(start.alias("known"), none.alias("fresh")), lambda acc, day: F.when(near(acc["known"], day), acc).otherwise(
        F.struct(F.concat(acc["known"], F.array(day)).alias("known"), F.concat(acc["fresh"], F.array(day)).alias("fresh"))
    ), lambda acc: acc["fresh"])
    return both.select("_key", F.explode(taken).alias(DAY))


def stream_append_new(
    stream: DataFrame, path: str, key: str, checkpoint: str, order_by: Order | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Append rows whose key is not in the log yet, each batch exactly once (ST3).

    Every batch has its own folder, overwritten when it is repeated; the history a
    batch is compared with are the folders of the batches before it. With
    ``order_by`` a key repeated inside the batch enters once.
    """
    schema = stream.schema

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = latest_per_key(batch, [key], order_by) if order_by else batch
        if path_exists(spark, path):
            logged = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType(), True)])
            past = spark.read.schema(logged).parquet(path).filter(F.col(BATCH) < batch_id)
            fresh = not_in_history(fresh, past, key)
        fresh.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return _start(stream, step, checkpoint, trigger)


def stream_append_recent(
    stream: DataFrame, path: str, key: str, time: str, days: int, checkpoint: str, delay: str = "1 day", trigger: dict | None = None
) -> StreamingQuery:
    """Append rows whose key was not logged on their day or in the ``days`` days before it (ST3, bounded history).

    ``dropDuplicatesWithinWatermark`` on key and day drops repetitions before any history is read; its state holds the
    keys of the days within ``delay`` of the newest time, and no more. The log is partitioned by day, and
    a batch reads only its own days and the ``days`` before them, whatever the log's length. Of a key's rows
    of a day the first to arrive enters. Rows later than ``delay`` are dropped; a late row within it enters
    even if its key is logged on a later day. Rows without a key are left out.
    """
    schema = stream.schema

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = written(batch.drop("_event"), "append-batch")
        since, until = batch.agg(F.date_sub(F.min(DAY), days), F.max(DAY)).first()
        if since is None:
            return
        mark = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        past = _look_back(spark, path, schema, key, since, until, mark)
        fresh = first_of_spans(batch, past, key, days).withColumnRenamed(DAY, "_day")
        rows = batch.join(fresh, (key_text(batch[key]) == F.col("_key")) & (F.col(DAY) == F.col("_day")), "left_semi")
        rows.withColumn(BATCH, F.lit(mark)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(path)

    timed = stream.withColumns({DAY: F.col(time).cast("date"), "_event": F.col(time).cast("timestamp")})
    own = timed.withWatermark("_event", delay).dropDuplicatesWithinWatermark([key, DAY])
    return _start(own, step, checkpoint, trigger)
