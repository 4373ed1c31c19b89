"""The latest row of each key of an append-only log, kept as a table into which only new loads are merged.

The table is cut into buckets by a hash of the key. A merge reads the new load and the buckets that its keys fall to, and
writes these buckets anew; all others stay as they are. Which folder holds a bucket is a small published table, so
readers see the state before a merge or after it, and a merge that fails, or is run twice, changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import current_version, publish, read_published
from .latest import latest

BUCKET = "_bucket"


@dataclass(frozen=True)
class LatestState:
    """The state in ``folder``; ``order`` says which row of a key is the latest. ``buckets`` never changes."""

    folder: str
    keys: Sequence[str]
    order: Sequence[str]
    buckets: int = 256

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{key}`") for key in self.keys]), F.lit(self.buckets)).cast("int")

    def _places(self, spark: SparkSession) -> dict[int, str]:
        """The folder of each bucket that has rows."""
        if current_version(spark, self.folder) is None:
            return {}
        return {row["bucket"]: row["path"] for row in read_published(spark, self.folder).collect()}

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """The latest rows; of the named buckets only, if any are named."""
        places = self._places(spark)
        if not places:
            raise FileNotFoundError(f"no load has been merged into {self.folder}")
        return spark.read.parquet(*[path for bucket, path in places.items() if buckets is None or bucket in buckets])

    def touched(self, load: DataFrame) -> list[int]:
        """The buckets that the load's keys fall to: at most ``buckets`` numbers."""
        return sorted(row["bucket"] for row in load.select(self._bucket().alias("bucket")).distinct().collect())

    def merged(self, load: DataFrame, touched: Sequence[int]) -> DataFrame:
        """The latest rows of the touched buckets, with the load."""
        spark, places = load.sparkSession, self._places(load.sparkSession)
        fresh = latest(load, self.keys, self.order)
        old = [places[bucket] for bucket in touched if bucket in places]
        if not old:
            return fresh
        both = fresh.unionByName(spark.read.parquet(*old), allowMissingColumns=True)
        return latest(both, self.keys, self.order)

    def merge(self, load: DataFrame) -> list[int]:
        """Merge a load; the buckets that were written anew are returned."""
        spark = load.sparkSession
        touched = self.touched(load)
        if not touched:
            return []
        folder = f"{self.folder.rstrip('/')}/rows/{uuid.uuid4().hex}"
        rows = self.merged(load, touched).withColumn(BUCKET, self._bucket())
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        places = self._places(spark) | {bucket: f"{folder}/{BUCKET}={bucket}" for bucket in touched}
        publish(spark.createDataFrame(sorted(places.items()), "bucket int, path string").coalesce(1), self.folder)
        return touched

    def prune(self, spark: SparkSession) -> list[str]:
        """Remove folders that no bucket lies in any more. Not to be run beside a merge, or under a reader of an old state."""
        files = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder.rstrip('/')}/rows")
        system = files.getFileSystem(spark._jsc.hadoopConfiguration())
        used = set(self._places(spark).values())
        gone = []
        for version in system.listStatus(files):
            for bucket in system.listStatus(version.getPath()):
                path = bucket.getPath().toString()
                if bucket.isDirectory() and not any(path.endswith(place.split(":", 1)[-1]) for place in used):
                    system.delete(bucket.getPath(), True)
                    gone.append(path)
        return gone
