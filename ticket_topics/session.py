"""Spark session and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH_DOCS = 1 << 10  # rows of lists, such as whole documents, that go to Python at a time


def build_session(app_name: str = "ticket-topics", **conf) -> SparkSession:
    """Session with UTC timestamps and AQE; master and paths come from submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which the cluster shares.

    Where the setting is missing and Spark runs in one process, a temporary
    folder is set for the session; on a cluster the missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^,\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="ticket-topics-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the scratch folder once and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the true
    size of the table. ``options`` are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """What is run here sends few rows to Python at a time: thousands of rows of long lists
    are a hundred megabytes, which the JVM holds outside its heap and the worker again."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(min(int(usual), BATCH_DOCS) if int(usual) > 0 else BATCH_DOCS))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of :func:`staged` tables that nothing will read again; others are
    left alone.

    The shuffles they came from go when the driver collects its garbage, which is done here:
    a large heap would put it off while they fill the disks.
    """
    found = False
    for table in tables:
        path = getattr(table, "staged_at", None)
        if path:
            jvm, context = table.sparkSession._jvm, table.sparkSession.sparkContext
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
            found = True
    if found:
        jvm.System.gc()
