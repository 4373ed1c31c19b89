"""Sharding by extendible hashing: a directory indexed by hash-prefix bits, in which only oversized buckets split.

Only DataFrame functions. The keys' 60-bit hashes are counted at ``BITS`` bits further each pass, over the rows
of buckets that are still too large. Within a pass the bytes of all shorter prefixes are summed from these
counts, and a bucket is the shortest prefix whose rows fit. One pass gives 4096 buckets of every oversized one,
so 100 TB at 64 MiB takes two. No step needs more than sums; rows never meet in one task.

Defined results: NULL keys share one hash, as do repeated keys. Rows of one hash that do not fit together are
divided into overflow pages that fit. A single row above the limit has a page of its own, marked oversize.
NULL payloads have 0 bytes. An empty table gives no rows. Only key and payload are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import drop_tables, fresh_names, materialise

HASH_BITS = 60
BITS = 12
COLUMNS = ("key", "bytes", "shard", "depth", "shard_rows", "shard_bytes", "oversize")


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's MD5."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix_text(prefix: Column, depth: Column) -> Column:
    return F.when(depth > 0, F.lpad(F.bin(prefix), depth, F.lit("0"))).otherwise(F.lit(""))


def _directory(rows: DataFrame, base: int, limit: int) -> DataFrame:
    """(cell, depth, prefix, shard_rows, shard_bytes) of one pass; depth is NULL where even the cell is too large."""
    deep = min(base + BITS, HASH_BITS)
    cell = F.shiftright("hash", HASH_BITS - deep)
    cells = rows.groupBy(cell.alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    cells = materialise(cells, "shard-cells")
    depths = cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(deep))))
    prefix = F.expr(f"shiftright(cell, {deep} - depth)").alias("prefix")
    sums = depths.groupBy("depth", prefix).agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fits = sums.where(F.col("shard_bytes") <= limit)
    depths = depths.select("cell", "depth", prefix).join(fits, ["depth", "prefix"])
    found = depths.groupBy("cell").agg(F.min_by(F.struct("depth", "prefix", "shard_rows", "shard_bytes"), "depth").alias("b"))
    return cells.select("cell").join(found, "cell", "left").select("cell", "b.*")


def shards(df: DataFrame, key: str, payload: str, limit: int) -> DataFrame:
    """The shard of each row of ``df``: (key, bytes, shard, depth, shard_rows, shard_bytes, oversize).

    ``shard`` is the bucket's hash prefix in bits, so a directory lookup is a prefix test; overflow pages
    append ``-task-page``. The bytes of ``payload`` in a shard never exceed ``limit`` except in oversize rows.
    """
    return _placed(df.select(*_sized(key, payload)), limit)


def _sized(key: str, payload: str) -> list[Column]:
    return [
        F.col(key).alias("key"), F.coalesce(F.octet_length(payload), F.lit(0)).cast("long").alias("bytes"),
        key_hash(F.col(key)).alias("hash"),
    ]


def _placed(rows: DataFrame, limit: int, *own: str) -> DataFrame:
    """The shard of each of ``rows`` (key, bytes, hash), with their columns ``own``."""
    rows, done, base = materialise(rows, "shard-rows"), [], 0
    while base < HASH_BITS:
        found = materialise(_directory(rows, base, limit), "shard-directory")
        deep = min(base + BITS, HASH_BITS)
        at = rows.withColumn("cell", F.shiftright("hash", HASH_BITS - deep))
        here = at.join(found.where("depth IS NOT NULL"), "cell")
        done.append(here.select(
            "key", "bytes", _prefix_text(F.col("prefix"), F.col("depth")).alias("shard"), "depth", "shard_rows",
            "shard_bytes", F.lit(False).alias("oversize"), *own))
        open_cells = found.where("depth IS NULL").select("cell")
        if open_cells.isEmpty():
            return reduce(DataFrame.unionByName, done)
        rows = materialise(at.join(open_cells, "cell", "left_semi").drop("cell"), "shard-rows")
        base = deep
    return reduce(DataFrame.unionByName, [*done, _overflow(rows, limit, *own)])


def _overflow(rows: DataFrame, limit: int, *own: str) -> DataFrame:
    """Pages for rows whose full hash does not fit a shard.

    Bytes run on within one hash and input task only, so a frequent key is spread over as many pages as tasks.
    Rows that cross a multiple of the limit get pages of their own.
    """
    rows = rows.withColumn("task", F.spark_partition_id()).withColumn("nr", F.monotonically_increasing_id())
    running = Window.partitionBy("hash", "task").orderBy("nr").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum("bytes").over(running))
    first = F.floor((F.col("end") - F.col("bytes")) / limit)
    last = F.floor((F.greatest(F.col("end") - 1, F.col("end") - F.col("bytes"))) / limit)
    rows = rows.withColumn("page", 2 * first + F.when(first == last, 0).otherwise(1))
    rows = materialise(rows, "shard-overflow")
    sums = rows.groupBy("hash", "task", "page").agg(F.sum("bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    name = F.concat_ws("-", _prefix_text(F.col("hash"), F.lit(HASH_BITS)), "task", "page")
    return rows.join(sums, ["hash", "task", "page"]).select(
        "key", "bytes", name.alias("shard"), F.lit(HASH_BITS).alias("depth"), "shard_rows", "shard_bytes",
        (F.col("shard_bytes") > limit).alias("oversize"), *own)


def write_shards(df: DataFrame, key: str, payload: str, limit: int, path: str) -> DataFrame:
    """Write the rows of ``df``, one folder per shard, and return the assignment.

    A folder is named ``s`` and the shard's bits, which readers cannot mistake for a number. Rows are numbered and
    written first, so each goes to the shard that it was given itself, rows of repeated and of NULL keys too.
    """
    number, shard = fresh_names(df.columns, "number", "shard")
    numbered = materialise(df.withColumn(number, F.monotonically_increasing_id()), "shard-input")
    rows = numbered.select(*_sized(key, payload), F.col(number).alias("number"))
    placed = materialise(_placed(rows, limit, "number"), "shard-placed")
    assigned = placed.select(F.col("number").alias(number), F.concat(F.lit("s"), "shard").alias(shard))
    out = numbered.join(assigned, number).drop(number)
    out.repartition(shard).write.partitionBy(shard).parquet(path)
    drop_tables(df.sparkSession, numbered)
    return placed.select(*COLUMNS)
