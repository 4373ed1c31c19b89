"""What the corpus operators share: reading tables and writing intermediate ones to the shared folder."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.session import write_through

CHECKPOINT_DIR = "spark.checkpoint.dir"


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only where a local session names none (local runs and tests) a new folder is made, and named in the session.
    """
    found = spark.conf.get(CHECKPOINT_DIR, None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        found = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set(CHECKPOINT_DIR, found)
    return found.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a new table in the shared folder and read it back, which cuts its lineage.

    The caller may drop the folder once its last result is written; nothing else refers to it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    write_through(df, path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove tables that ``materialise`` wrote, once all that was made from them is written itself."""
    settings = spark._jsc.hadoopConfiguration()
    for path in {file.rpartition("/")[0] for table in tables for file in table.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(settings).delete(folder, True)


BATCH_BYTES = 4 * 2**20
Mapping = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BATCH_BYTES``; a row is never cut."""
    for batch in batches:
        parts = max(1, min(batch.num_rows, -(-batch.nbytes // BATCH_BYTES)))
        size = max(1, -(-batch.num_rows // parts))
        for start in range(0, max(1, batch.num_rows), size):
            yield batch.slice(start, size)


def _give_back() -> None:
    """Return free memory to the system: Python workers are kept, and what they hold counts on top of what comes next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not on this platform
        pass


def bounded(function: Mapping) -> Mapping:
    """``function`` for ``mapInArrow``, given batches of bounded bytes, and its memory given back when a task ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(_cut(batches))
        finally:
            _give_back()

    return run


def null_safe_key(column: Column) -> Column:
    """A text that is equal for equal values, with NULL as a value of its own, for joins on keys that may be NULL."""
    return F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))


def fresh_names(taken: list[str], *wanted: str) -> list[str]:
    """``wanted``, each changed until it is none of ``taken``, whatever the case."""
    lower = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in lower:
            name += "_"
        out.append(name)
    return out
