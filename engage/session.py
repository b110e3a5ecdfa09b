"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "engage", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; what the cluster's own configuration sets stays as it is."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # whole documents and vectors travel in these batches
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.files.maxPartitionBytes": "128m",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # what the launcher has put into spark-defaults or on the command line is in the system properties by now
    running = SparkContext._active_spark_context
    given = running.getConf() if running else None
    for key, value in settings.items():
        if key in conf or given is None or not given.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables and stream checkpoints, under the cluster's shared folder.

    ``spark.checkpoint.dir`` names that folder.  Only a local-mode session may do without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="engage-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever store it is in."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes in this block go when it ends; what is to stay must be written before that."""
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        for path in paths:
            delete(spark, path)


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a frame once to the shared folder and read it back, so later jobs start from the table.

    ``compression`` names a codec other than the session's.  The table stays until the session's shared folder is cleared, or until the end of a ``scratch`` block around it.
    """
    path = shared_dir(df.sparkSession, name)
    if (paths := _written.get()) is not None:
        paths.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)
