"""Table mutations and streams on the driver tables."""

from pyspark.sql import functions as F

from ..functions.dates import in_window
from ..operators.merge import merge_insert, merge_sync, merge_update, merge_upsert, split_keys
from ..session import scratch_path
from ..sources.buckets import BucketTable, insert_buckets, sync_buckets, update_buckets, upsert_buckets
from ..sources.schemas import COORDINATES
from ..sources.tables import ensure_table, export_report, lookup, read_or_empty, read_upload, write_table
from ..sources.uploads import read_upload_split
from ..streaming import micro
from . import tracker as tracker_queries
from .registry import query
from .services import text

COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def target(t):
    """Orders known before: all but the pending ones."""
    return t.orders.filter(F.col("o_orderstatus") != "P").select(*COLUMNS)


def source(t):
    """Orders arriving: open and pending ones, dearer by a tenth."""
    changed = t.orders.filter(F.col("o_orderstatus") != "F").withColumn("o_totalprice", F.col("o_totalprice") + 10)
    return changed.withColumn("o_orderstatus", F.lower("o_orderstatus")).select(*COLUMNS)


@query("merge_insert", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'p' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice, o_orderdate FROM orders
""")
def insert(t):
    return merge_insert(target(t), source(t), ["o_orderkey"])


@query("merge_update", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 10 ELSE o_totalprice END
      AS o_totalprice, o_orderdate FROM orders WHERE o_orderstatus <> 'P'
""")
def update(t):
    return merge_update(target(t), source(t), ["o_orderkey"], ["o_totalprice"])


@query("merge_upsert", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE lower(o_orderstatus) END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 10 END AS o_totalprice, o_orderdate
    FROM orders
""")
def upsert(t):
    return merge_upsert(target(t), source(t), ["o_orderkey"])


def hashed(df):
    return df.withColumn("huella", F.md5(F.concat("o_orderstatus", F.col("o_orderkey").cast("string"))))


@query("merge_sync", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE lower(o_orderstatus) END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 10 END AS o_totalprice, o_orderdate,
           md5(CAST(CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE lower(o_orderstatus) END AS VARCHAR) || o_orderkey) AS huella
    FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1998-06-11')
""")
def sync(t):
    window = in_window("o_orderdate", "1998-06-15", -4, None)
    return merge_sync(hashed(target(t)), hashed(source(t)), ["o_orderkey"], "huella", window)


def keyless(df):
    """Every seventh row loses its key."""
    return df.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")))


@query("merge_null_keys", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' OR o_orderkey % 7 = 0 THEN o_orderstatus ELSE lower(o_orderstatus) END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'F' OR o_orderkey % 7 = 0 THEN o_totalprice ELSE o_totalprice + 10 END AS o_totalprice, o_orderdate
    FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderkey % 7 = 0)
    UNION ALL
    SELECT NULL, lower(o_orderstatus), o_totalprice + 10, o_orderdate FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 7 = 0
""")
def null_keys(t):
    return merge_upsert(target(t), keyless(source(t)), ["o_orderkey"])


@query("merge_rejects", """
    SELECT lower(o_orderstatus) AS o_orderstatus, o_totalprice + 10 AS o_totalprice, o_orderdate FROM orders
    WHERE o_orderstatus <> 'F' AND o_orderkey % 7 = 0
""")
def rejects(t):
    return split_keys(keyless(source(t)), ["o_orderkey"])[1].drop("o_orderkey")


@query("append_log", """
    SELECT o_orderkey, o_orderstatus, TIMESTAMP '2024-01-15 08:00:00' AS cargado,
           CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '2024-01-15 09:00:00' ELSE TIMESTAMP '2024-01-15 08:00:00' END
             AS actualizado
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, 'p', TIMESTAMP '2024-01-15 09:00:00', TIMESTAMP '2024-01-15 09:00:00' FROM orders
    WHERE o_orderstatus = 'P'
""")
def append_log(t):
    """Two appends read back; the newer one carries updates, folded to load and update time per order."""
    path = scratch_path(t.spark, "append-log")
    keep = ["o_orderkey", "o_orderstatus"]
    first, second = F.expr("timestamp_ntz'2024-01-15 08:00:00'"), F.expr("timestamp_ntz'2024-01-15 09:00:00'")
    write_table(target(t).select(*keep, first.alias("momento")), path, "append")
    write_table(source(t).select(*keep, second.alias("momento")), path, "append")
    log = t.spark.read.parquet(path)
    return log.groupBy("o_orderkey").agg(
        F.min(F.struct("momento", "o_orderstatus")).getField("o_orderstatus").alias("o_orderstatus"),
        F.min("momento").alias("cargado"), F.max("momento").alias("actualizado"),
    )


@query("table_versions", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'p' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 10 END AS o_totalprice, o_orderdate FROM orders
""")
def table_versions(t):
    """A stored table merged twice: rows appended to their buckets, then the touched buckets rewritten."""
    table = stored(t, target(t))
    insert_buckets(table, source(t))
    update_buckets(table, source(t), ["o_totalprice"])
    return table.read(t.spark)


def stored(t, rows, buckets=16):
    """The rows as a bucketed table of their own."""
    table = BucketTable(scratch_path(t.spark, "buckets"), rows.schema, ("o_orderkey",), buckets)
    table.append(rows)
    return table


def few(df):
    """Rows of the orders whose key is divisible by 997 alone: they touch few buckets of many."""
    return df.filter(F.col("o_orderkey") % 997 == 0)


@query("upsert_buckets", """
    WITH s AS (SELECT *, o_orderstatus <> 'F' AND o_orderkey % 997 = 0 AS nuevo FROM orders)
    SELECT o_orderkey, CASE WHEN nuevo THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN nuevo THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice, o_orderdate
    FROM s WHERE o_orderstatus <> 'P' OR nuevo
""")
def bucket_upsert(t):
    """Every stored order, with the few that arrive merged into their buckets; running the merge again changes nothing."""
    table = stored(t, target(t), 64)
    for _ in range(2):
        upsert_buckets(table, few(source(t)))
    return table.read(t.spark)


@query("sync_buckets", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE lower(o_orderstatus) END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 10 END AS o_totalprice, o_orderdate,
           md5(CAST(CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE lower(o_orderstatus) END AS VARCHAR) || o_orderkey) AS huella
    FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1998-06-11')
""")
def bucket_sync(t):
    """The stored form of the hash-guarded sync: whole rows are read and written only where one changes."""
    table = stored(t, hashed(target(t)), 64)
    for _ in range(2):
        sync_buckets(table, hashed(source(t)), "huella", in_window("o_orderdate", "1998-06-15", -4, None))
    return table.read(t.spark)


@query("merge_clustered", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE lower(o_orderstatus) END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 10 END AS o_totalprice, o_orderdate
    FROM orders
""")
def merge_clustered(t):
    """A merge into a catalog table that is clustered on its key: the table is not shuffled for it."""
    path = scratch_path(t.spark, "clustered")
    name = path.rpartition("/")[2].replace("-", "_")
    rows = target(t)
    ensure_table(t.spark, name, rows.schema, ["o_orderkey"], 16, path)
    rows.write.insertInto(name, overwrite=True)
    return merge_upsert(t.spark.table(name), source(t), ["o_orderkey"])


@query("export_report", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer
""")
def report(t):
    """A report written as delimited text with the columns that exist, read back as an upload."""
    path = scratch_path(t.spark, "report")
    export_report(t.customer, ["c_custkey", "c_name", "missing", "c_mktsegment"], path)
    return read_upload(t.spark, path)


@query("upload_split", """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus || chr(10) || '"' || o_orderpriority || '", ' || chr(10) AS note,
           row_number() OVER (ORDER BY o_orderkey) - 1 AS row_no FROM orders
""")
def upload_split(t):
    """An upload of several files with line ends and quotes in its fields, read by splits, with the place of each row."""
    path = scratch_path(t.spark, "upload")
    note = F.concat("o_orderstatus", F.lit('\n"'), "o_orderpriority", F.lit('", \n'))
    rows = t.orders.select(F.col("o_orderkey").cast("string"), note.alias("note"), F.col("o_orderkey").alias("key"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key").drop("key")
    ordered.write.option("header", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_upload_split(t.spark, path, position="row_no")


@query("text_lookup", """
    SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation
""")
def text_lookup(t):
    """A small text lookup with padded fields, read back trimmed."""
    path = scratch_path(t.spark, "lookup")
    padded = t.nation.select(F.col("n_nationkey").cast("string"), F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("n_name"))
    padded.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return lookup(t.spark, path, ["n_nationkey"])


@query("replace_table", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus <> 'P'")
def replace_table(t):
    """A table created or replaced: the second content is all that is left."""
    path = scratch_path(t.spark, "replaced")
    write_table(source(t), path, "overwrite")
    write_table(target(t), path, "overwrite", ["o_orderstatus"])
    return read_or_empty(t.spark, path, target(t).schema)


@query("missing_table", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE lower(o_orderstatus) END AS o_orderstatus,
           o_totalprice + 10 AS o_totalprice, o_orderdate FROM orders WHERE o_orderstatus <> 'F'
""")
def missing_table(t):
    """A first merge into a table that does not exist yet."""
    empty = read_or_empty(t.spark, scratch_path(t.spark, "missing"), source(t).schema)
    return merge_upsert(empty, source(t), ["o_orderkey"])


def _event_stream(t, name):
    """The events in several files, as a stream of one file per batch."""
    path = scratch_path(t.spark, name)
    t.events.repartitionByRange(3, "ts").write.parquet(path)
    return t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("stream_latest", """
    SELECT user_id, event_id, event_type, ts, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_latest(t):
    """Three batches; each writes the users whose newest event it changes, and a compaction folds them."""
    out, done = scratch_path(t.spark, "latest"), scratch_path(t.spark, "latest-progress")
    stream = _event_stream(t, "events")
    key, order = ["user_id"], ["ts", "event_id"]
    micro.stream_upsert(stream, out, key, order, done).awaitTermination()
    micro.compact(t.spark, out, t.events.schema, key, order)
    return micro.read_latest(t.spark, out, t.events.schema, key, order)


@query("stream_append_new", "SELECT DISTINCT user_id, event_type FROM events")
def stream_append_new(t):
    out, done = scratch_path(t.spark, "log"), scratch_path(t.spark, "log-progress")
    keyed = _event_stream(t, "events").withColumn("clave", F.concat_ws("/", "user_id", "event_type"))
    order = [F.col("ts").asc(), F.col("event_id").asc()]
    micro.stream_append_new(keyed, out, "clave", done, order_by=order).awaitTermination()
    return t.spark.read.parquet(out).select("user_id", "event_type")


@query("stream_coordinates", f"""
    WITH {tracker_queries.CAPTURE},
    n AS (SELECT DISTINCT o_orderkey, o_custkey, lower(o_orderpriority) AS nombre FROM orders WHERE o_orderstatus <> 'P')
    SELECT CAST(o_orderkey AS VARCHAR) AS "NUM_RESERVA", '519' || o_custkey AS "FONO_CLI", n.nombre AS "NOMBRE",
           pt.la AS "LATITUD", pt.lo AS "LONGITUD", pt.f AS "FECHA_COORDENADA", TIMESTAMP '2024-01-15 18:30:00' AS "FECHA_PROCESO",
           CASE WHEN pt.la IS NULL THEN 'SIN_RESPUESTA' ELSE 'ENCONTRADA' END AS "ESTADO", CAST(1 AS BIGINT) AS "INTENTOS"
    FROM n LEFT JOIN pt ON pt.tel = '519' || o_custkey
""")
def stream_coordinates(t):
    """A feed in two batches: the newest point wins, and the run counts one attempt."""
    path = scratch_path(t.spark, "feed")
    feed = tracker_queries.feed(t)
    feed.repartitionByRange(2, "posicion").write.parquet(path)
    stream = t.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(path)
    points, done = scratch_path(t.spark, "points"), scratch_path(t.spark, "coords-progress")
    state = BucketTable(scratch_path(t.spark, "coords"), COORDINATES, ("NUM_RESERVA",), 16)
    micro.capture_run(stream, tracker_queries.capture_sends(t), state, points, tracker_queries.AS_OF, done)
    return state.read(t.spark)


def _by_day(t, df, time, name, since):
    """The rows as a stream of three batches in time order, each file written after the one before."""
    path = scratch_path(t.spark, name)
    for low, high in zip(since, [*since[1:], "2100-01-01"]):
        df.filter((F.col(time) >= low) & (F.col(time) < high)).coalesce(1).write.mode("append").parquet(path)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


_PARTS = ["2000-01-01", "2024-01-10", "2024-01-20"]


@query("stream_append_recent", """
    WITH RECURSIVE d AS (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS dia FROM events),
    r AS (SELECT user_id, event_type, min(dia) AS dia FROM d GROUP BY 1, 2
          UNION ALL
          SELECT d.user_id, d.event_type, min(d.dia) FROM r JOIN d ON d.user_id = r.user_id AND d.event_type = r.event_type
            AND d.dia > r.dia + 4 GROUP BY d.user_id, d.event_type, r.dia)
    SELECT user_id, event_type, dia FROM r
""")
def stream_append_recent(t):
    """Events of a user and kind that had none logged in the four days before; the look-back reads those days only."""
    out, done = scratch_path(t.spark, "recent"), scratch_path(t.spark, "recent-progress")
    keyed = t.events.withColumn("clave", F.concat_ws("/", "user_id", "event_type"))
    stream = _by_day(t, keyed, "ts", "recent-in", _PARTS)
    micro.stream_append_recent(stream, out, "clave", "ts", 4, done).awaitTermination()
    return t.spark.read.parquet(out).select("user_id", "event_type", "dia")


@query("stream_attempts", """
    WITH s AS (SELECT date_trunc('day', ts) AS dia, 'r' || (user_id * 3 + event_id % 3) AS r, arg_max(user_id, (ts, '519' || lpad(CAST(user_id AS VARCHAR), 8, '0'))) AS u
               FROM events WHERE event_type IN ('error', 'view') GROUP BY 1, 2),
    p AS (SELECT date_trunc('day', ts) AS dia, user_id AS u, max({'t': ts, 'la': CAST(value AS VARCHAR), 'lo': CAST(event_id AS VARCHAR)}) AS x
          FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
    w AS (SELECT least((SELECT max(ts) FROM events WHERE event_type IN ('error', 'view')), (SELECT max(ts) FROM events WHERE event_type = 'purchase')) - INTERVAL 6 HOUR AS hasta),
    c AS (SELECT dia, r, x FROM s LEFT JOIN p USING (dia, u) WHERE dia + INTERVAL 1 DAY <= (SELECT hasta FROM w)),
    f AS (SELECT r, min(dia) AS dia FROM c WHERE x IS NOT NULL GROUP BY r)
    SELECT c.r AS "NUM_RESERVA", max(CASE WHEN c.dia = f.dia THEN x.la END) AS "LATITUD", max(CASE WHEN c.dia = f.dia THEN x.lo END) AS "LONGITUD",
      max(CASE WHEN c.dia = f.dia THEN x.t END) AS "FECHA_COORDENADA", CASE WHEN max(f.dia) IS NULL THEN 'SIN_RESPUESTA' ELSE 'ENCONTRADA' END AS "ESTADO",
      count(DISTINCT c.dia) AS "INTENTOS"
    FROM c LEFT JOIN f USING (r) WHERE f.dia IS NULL OR c.dia <= f.dia GROUP BY c.r
""")
def stream_attempts(t):
    """Attempts by event time: a reservation's day is closed by the watermark, with its phone's newest point or without answer."""
    phone = F.concat(F.lit("519"), F.lpad(text("user_id"), 8, "0"))
    sends = t.events.filter(F.col("event_type").isin("error", "view")).select(
        F.concat(F.lit("r"), F.col("user_id") * 3 + F.col("event_id") % 3).alias("NUM_RESERVA"), phone.alias("FONO_CLI"), F.col("ts").alias("FECHA_ENVIO")
    )
    points = t.events.filter(F.col("event_type") == "purchase").select(
        phone.alias("clientUid"), text("value").alias("latitud"), text("event_id").alias("longitud"), F.col("ts").alias("fecha")
    )
    out, done = scratch_path(t.spark, "closed"), scratch_path(t.spark, "closed-progress")
    streams = _by_day(t, sends, "FECHA_ENVIO", "sends", _PARTS), _by_day(t, points, "fecha", "points", _PARTS)
    micro.stream_closed(*streams, out, done, "6 hours").awaitTermination()
    return micro.attempts(t.spark.read.parquet(out)).drop("DIA", "FONO_CLI")
