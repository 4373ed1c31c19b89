"""Session defaults and staging of intermediate rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a partition with a frequent key even if what follows must shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Generated methods above 8000 bytes are never compiled to machine code; past that size let
    # each operator run its own, smaller generated code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Call-site capture costs several driver round trips per column expression; plans here are
    # made of thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "ordertide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the defaults that can still change to a session made elsewhere."""
    for key, value in DEFAULTS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


#: Whether Spark removes the shuffle files of a query at its end, and not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffle_files_go(spark: SparkSession) -> Iterator[None]:
    """Nothing reads the shuffle files of a table's write again, so they go when it is done: steps that follow each other
    need the disk of the largest and not of all."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write_through(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write ``df`` as Parquet, and leave no shuffle files."""
    with _shuffle_files_go(df.sparkSession):
        df.write.parquet(path, compression=compression)


def staged(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` once as a new table in ``folder``, which all executors must reach, and read it back.

    Used where several branches read the same enriched rows: each branch then scans only its own columns, and losing
    executors never replays the joins before this point. ``drop_staged`` removes the folder.
    """
    path = f"{folder.rstrip('/')}/staged-{uuid.uuid4().hex}"
    write_through(df, path, "zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, folder: str, key: str, parts: int, dealt: bool = False) -> DataFrame:
    """``staged``, dealt out by ``key`` into ``parts`` buckets: tables staged so are joined on ``key`` without moving a row.

    ``dealt`` says that the rows of ``df`` lie that way already. The catalog knows the table only until it is opened.
    """
    spark, name = df.sparkSession, f"staged_{uuid.uuid4().hex}"
    path = f"{folder.rstrip('/')}/staged-{uuid.uuid4().hex}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd') "
              f"CLUSTERED BY (`{key}`) INTO {parts} BUCKETS LOCATION '{path}'")
    try:
        with _shuffle_files_go(spark):
            (df if dealt else df.repartition(parts, key)).write.insertInto(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files below ``folder``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(root).getLength()


def drop_staged(spark: SparkSession, folder: str) -> bool:
    """Remove the tables ``staged`` wrote to ``folder``, once nothing reads them any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(conf)
    found = [entry.getPath() for entry in files.listStatus(root) if entry.getPath().getName().startswith("staged-")]
    return all([files.delete(path, True) for path in found])
