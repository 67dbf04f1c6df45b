"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Run-time settings the library relies on; a value the user has set is left alone.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings that the session does not set itself."""
    explicit = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in RUNTIME_SETTINGS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where the setting is missing, a session on one machine (a ``local`` master, as in
    tests) gets a temporary folder, remembered in the session; any other one fails,
    as its executors could not see such a folder.
    """
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not found:
        found = spark.conf.get("milepost.scratch.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        found = tempfile.mkdtemp(prefix="milepost-")
        spark.conf.set("milepost.scratch.dir", found)
    return found.rstrip("/")


#: Scratch paths handed out within :func:`recorded`.
_record: ContextVar[list[str] | None] = ContextVar("scratch_record", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if (record := _record.get()) is not None:
        record.append(path)
    return path


@contextlib.contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Add the scratch paths handed out inside to ``paths``, for a later :func:`discard`."""
    token = _record.set(paths)
    try:
        yield
    finally:
        _record.reset(token)


def discard(spark: SparkSession, paths: list[str], unless_read_by: Iterable[DataFrame] = ()) -> None:
    """Delete scratch folders and take them off the list, but for those that a given frame still reads."""
    used = {f.partition(":")[2].lstrip("/") if ":" in f.split("/")[0] else f.lstrip("/") for df in unless_read_by for f in df.inputFiles()}
    for path in list(paths):
        bare = (path.partition(":")[2] if ":" in path.split("/")[0] else path).lstrip("/")
        if not any(f.startswith(f"{bare}/") for f in used):
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
            paths.remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read back.

    Cuts the lineage of a result that is used several times: its joins run once,
    later passes read only their columns, and a lost executor costs no more than
    re-reading files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
