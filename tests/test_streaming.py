"""Micro-batches: late rows, repeated batches, logs."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from milepost.operators.keyed import latest_per_key
from milepost.sources.buckets import BucketTable
from milepost.sources.schemas import COORDINATES
from milepost.streaming import micro


def write(spark, path, data):
    spark.createDataFrame(data, "k string, t int, v string").coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, [("a", 1, "x"), ("a", 5, "y"), ("b", 1, "z")])
    schema = spark.read.parquet(path).schema
    return path, spark.readStream.schema(schema).parquet(path), schema


ORDER = ["t", "v"]


def files(path):
    """Data files below a folder with their row counts."""
    found = sorted(str(p) for p in path.rglob("*.parquet"))
    return {f: pq.read_metadata(f).num_rows for f in found}


def upsert(spark, stream, out, done):
    micro.stream_upsert(stream, str(out), ["k"], ORDER, str(done)).awaitTermination()
    return micro.read_latest(spark, str(out), stream.schema, ["k"], ORDER)


def test_upsert_writes_what_a_batch_changes(spark, source, tmp_path, rows):
    path, stream, schema = source
    out, done = tmp_path / "out", tmp_path / "done"
    write(spark, path, [(f"n{i}", 1, "x") for i in range(500)])
    assert upsert(spark, stream, out, done).count() == 502
    first = files(out)
    write(spark, path, [("a", 3, "late"), ("b", 2, "w"), ("c", 1, "n")])
    got = upsert(spark, stream, out, done)
    more = {f: n for f, n in files(out).items() if f not in first}
    # A late row changes nothing, but its group is emitted again: three rows at most for three rows in.
    assert set(first) <= set(files(out)) and 2 <= sum(more.values()) <= 3
    assert [r for r in rows(got) if len(r[0]) == 1] == [("a", 5, "y"), ("b", 2, "w"), ("c", 1, "n")]
    newest = [F.col("t").desc(), F.col("v").desc()]
    assert rows(got) == rows(latest_per_key(spark.read.schema(schema).parquet(path), ["k"], newest))


def test_fresh_checkpoint_goes_on_after_what_is_stored(spark, source, tmp_path, rows):
    path, stream, _ = source
    upsert(spark, stream, tmp_path / "out", tmp_path / "one")
    write(spark, path, [("b", 9, "late")])
    assert rows(upsert(spark, stream, tmp_path / "out", tmp_path / "two")) == [("a", 5, "y"), ("b", 9, "late")]


def test_failed_batch_is_repeated(spark, source, tmp_path, rows, monkeypatch):
    """A batch that fails after it wrote ends the run; started again from the same checkpoint, it overwrites its folder."""
    path, stream, _ = source
    out, done = tmp_path / "out", tmp_path / "done"
    upsert(spark, stream, out, done)
    write(spark, path, [("b", 7, "again"), ("d", 1, "n")])

    def fails(batch, batch_id, to):
        batch.write.mode("overwrite").parquet(folder(batch, batch_id, to))
        raise RuntimeError("lost")

    folder = micro._batch_folder
    monkeypatch.setattr(micro, "_batch_folder", fails)
    with pytest.raises(Exception, match="lost"):
        upsert(spark, stream, out, done)
    monkeypatch.undo()
    for _ in range(2):
        assert rows(upsert(spark, stream, out, done)) == [("a", 5, "y"), ("b", 7, "again"), ("d", 1, "n")]
    assert len(list(out.glob("corrida=*"))) == 1


def test_compaction_keeps_the_newest_rows(spark, source, tmp_path, rows):
    path, stream, schema = source
    out, done = tmp_path / "out", tmp_path / "done"
    for data in ([("b", 2, "w")], [("c", 1, "n"), ("a", 9, "z")], [("c", 0, "late")]):
        upsert(spark, stream, out, done)
        write(spark, path, data)
    before = rows(upsert(spark, stream, out, done))
    for _ in range(2):
        micro.compact(spark, str(out), schema, ["k"], ORDER)
        assert rows(micro.read_latest(spark, str(out), schema, ["k"], ORDER)) == before
    assert sum(files(out).values()) == 3 and len(list(out.glob("corrida=*/lote=*"))) == 1
    write(spark, path, [("b", 8, "after")])
    assert rows(upsert(spark, stream, out, done)) == [("a", 9, "z"), ("b", 8, "after"), ("c", 1, "n")]


def test_capture_run_counts_one_attempt_and_takes_the_newest_point(spark, tmp_path, rows):
    path, points, done = str(tmp_path / "feed"), str(tmp_path / "points"), str(tmp_path / "done")
    state = BucketTable(str(tmp_path / "coords"), COORDINATES, ("NUM_RESERVA",), 4)
    kind = "clientUid string, latitud string, longitud string, fecha string, posicion int"
    for part in ([("912", "-1", "-2", "2024-01-15 08", 0)], [("912", "-3", "-4", "2024-01-15 09", 0)]):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(path)
    feed = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(path)
    sends = spark.createDataFrame([("1", "912", "a"), ("2", "913", "b"), (None, "914", "c")], "NUM_RESERVA string, FONO_CLI string, NOMBRE string").withColumn(
        "FECHA_ENVIO", F.expr("timestamp_ntz'2024-01-15 10:00:00'"))
    as_of = "2024-01-15 18:30:00"
    assert micro.capture_run(feed, sends, state, points, as_of, done)
    assert rows(state.read(spark), "NUM_RESERVA", "LATITUD", "INTENTOS") == [("1", "-3", 1), ("2", None, 1)]
    assert not micro.capture_run(feed, sends, state, points, as_of, done)
    assert rows(state.read(spark), "NUM_RESERVA", "INTENTOS") == [("1", 1), ("2", 1)]
    # Points that a failed run left uncaptured are captured by the next one, without new feed rows.
    spark.read.parquet(f"{points}-captured").limit(1).write.parquet(f"{points}-kept")
    for p in (tmp_path / "points-captured").glob("*"):
        p.unlink()
    assert micro.capture_run(feed, sends, state, points, as_of, done)
    assert rows(state.read(spark), "NUM_RESERVA", "INTENTOS") == [("1", 1), ("2", 2)]


def times(spark, path, data, kind):
    spark.createDataFrame(data, kind).coalesce(1).write.mode("append").parquet(path)


def test_days_close_by_the_watermark(spark, tmp_path, rows):
    """A day is closed once both streams are past its end and the delay; rows that come later are dropped."""
    out, done = str(tmp_path / "closed"), str(tmp_path / "done")
    sent, seen = str(tmp_path / "sends"), str(tmp_path / "feed")
    s_kind, f_kind = "NUM_RESERVA string, FONO_CLI string, at string", "clientUid string, latitud string, longitud string, at string"

    def run():
        sends = spark.readStream.schema(s_kind).option("maxFilesPerTrigger", 1).parquet(sent).withColumn("FECHA_ENVIO", F.col("at").cast("timestamp"))
        feed = spark.readStream.schema(f_kind).option("maxFilesPerTrigger", 1).parquet(seen).withColumn("fecha", F.col("at").cast("timestamp"))
        micro.stream_closed(sends, feed, out, done, "6 hours").awaitTermination()
        closed = spark.read.parquet(out) if list((tmp_path / "closed").rglob("*.parquet")) else None
        return closed

    times(spark, sent, [("1", "912", "2024-01-15 09:00:00"), (" 1 ", "913", "2024-01-15 10:00:00"), ("2", "914", "2024-01-15 11:00:00"), (None, "915", "2024-01-15 11:00:00")], s_kind)
    times(spark, seen, [("913", "-1", "-2", "2024-01-15 08:00:00"), ("913", "-3", "-4", "2024-01-15 12:00:00"), ("914", "", "-4", "2024-01-15 12:00:00")], f_kind)
    first = run()
    assert first is None or first.count() == 0
    # Both streams are in the next day, but not past the delay: the day stays open, and a late point still counts.
    times(spark, sent, [("2", "914", "2024-01-16 03:00:00")], s_kind)
    times(spark, seen, [("913", "-5", "-6", "2024-01-15 23:00:00"), ("999", "-7", "-8", "2024-01-16 05:00:00")], f_kind)
    first = run()
    assert first is None or first.count() == 0
    times(spark, sent, [("3", "916", "2024-01-16 20:00:00")], s_kind)
    times(spark, seen, [("999", "-9", "-9", "2024-01-16 21:00:00")], f_kind)
    cols = ["DIA", "NUM_RESERVA", "LATITUD", "ESTADO"]
    day = dt.datetime(2024, 1, 15)
    want = [(day, "1", "-5", "ENCONTRADA"), (day, "2", None, "SIN_RESPUESTA")]
    assert rows(run(), *cols) == want
    # After the day is closed, a send and a point of it are too late.
    times(spark, sent, [("4", "913", "2024-01-15 13:00:00"), ("5", "999", "2024-01-18 09:00:00")], s_kind)
    times(spark, seen, [("914", "-1", "-1", "2024-01-15 14:00:00"), ("914", "-2", "-2", "2024-01-16 22:00:00"), ("1", "-1", "-1", "2024-01-18 09:00:00")], f_kind)
    next_day = dt.datetime(2024, 1, 16)
    want += [(next_day, "2", "-2", "ENCONTRADA"), (next_day, "3", None, "SIN_RESPUESTA")]
    closed = run()
    assert rows(closed, *cols) == sorted(want, key=repr)
    got = rows(micro.attempts(closed), "NUM_RESERVA", "LATITUD", "ESTADO", "INTENTOS")
    assert got == [("1", "-5", "ENCONTRADA", 1), ("2", "-2", "ENCONTRADA", 2), ("3", None, "SIN_RESPUESTA", 1)]


def test_bounded_history_reads_its_days_only(spark, tmp_path, rows):
    path, out, done = str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "done")
    kind = "k string, at string"

    def run():
        stream = spark.readStream.schema(kind).parquet(path).withColumn("ts", F.col("at").cast("timestamp_ntz"))
        micro.stream_append_recent(stream, out, "k", "ts", 2, done, "3 days").awaitTermination()
        return [(k, str(d)[-2:]) for k, d in rows(spark.read.parquet(out), "k", "dia")]

    times(spark, path, [("a", "2024-01-01 08:00:00"), ("a", "2024-01-01 09:00:00"), ("a", "2024-01-03 08:00:00"), (None, "2024-01-03 08:00:00")], kind)
    assert run() == [("a", "01")]
    times(spark, path, [("a", "2024-01-04 08:00:00"), (" a", "2024-01-05 08:00:00"), ("b", "2024-01-04 08:00:00"), ("a", "2024-01-09 08:00:00")], kind)
    assert run() == [("a", "01"), ("a", "04"), ("a", "09"), ("b", "04")] and run() == run()
    # Within the delay a late row enters if the days before it are free; later than that it is dropped.
    times(spark, path, [("c", "2024-01-07 08:00:00"), ("d", "2024-01-02 08:00:00"), ("b", "2024-01-06 20:00:00")], kind)
    assert run() == [("a", "01"), ("a", "04"), ("a", "09"), ("b", "04"), ("c", "07")]
    past = micro._look_back(spark, out, spark.read.parquet(out).drop("dia", "lote").schema, "k", dt.date(2024, 1, 2), dt.date(2024, 1, 5), "none")
    plan = past._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dia" in plan and rows(past.select("_key")) == [("a",), ("b",)]


def test_log_takes_each_key_once(spark, source, tmp_path, rows):
    path, stream, _ = source
    out, done = str(tmp_path / "out"), str(tmp_path / "done")
    oldest = [F.col("t").asc()]
    micro.stream_append_new(stream, out, "k", done, oldest).awaitTermination()
    write(spark, path, [("a", 9, "again"), ("c", 2, "n")])
    micro.stream_append_new(stream, out, "k", done, oldest).awaitTermination()
    assert rows(spark.read.parquet(out), "k", "v") == [("a", "x"), ("b", "z"), ("c", "n")]


def test_stateful_form_agrees(spark, source, tmp_path, rows):
    _, stream, _ = source
    query = (
        micro.stream_latest(stream, ["k"], ["t", "v"]).writeStream.format("memory").queryName("latest_k")
        .outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("latest_k")) == [("a", 5, "y"), ("b", 1, "z")]
