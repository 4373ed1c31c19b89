"""Merkle fixity audit of archive replicas.

Records are hashed, and hashes are combined over ordered offset ranges: a leaf covers ``2**RANGE_BITS`` bytes of
one file, a node ``FAN_BITS`` bits more per level, up to one root per file. Roots of two replicas are compared,
and only the children of differing nodes are looked at further down, so an intact archive costs one join of roots.
Groups are bounded by the records that start in one range, and by the fan-out above; files of any size share work.

Only DataFrame functions. Defined results: a record is placed by the range its offset lies in; NULL digests are a
value of their own; NULL file names or offsets are not locatable and are reported as status ``unplaced``; rows
repeated within a replica are equal records at one place, and a differing number of them is ``repeated``. Empty
tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import materialise

RANGE_BITS = 16
FAN_BITS = 4


def record_digest(content: Column) -> Column:
    """The hash of one record."""
    return F.sha2(content.cast("binary"), 256)


def _hash_of(children: Column) -> Column:
    return F.sha2(F.to_json(F.sort_array(F.collect_list(children)), {"ignoreNullFields": "false"}).cast("binary"), 256)


def leaves(records: DataFrame) -> DataFrame:
    """(file, node, hash) of the offset ranges of ``records`` (file, offset, length, digest)."""
    node = F.shiftright("offset", RANGE_BITS).alias("node")
    return records.groupBy("file", node).agg(_hash_of(F.struct("offset", "length", "digest")).alias("hash"))


def parents(nodes: DataFrame) -> DataFrame:
    """(file, node, hash) one level up."""
    return nodes.groupBy("file", F.shiftright("node", FAN_BITS).alias("node")).agg(
        _hash_of(F.struct("node", "hash")).alias("hash"))


def tree(records: DataFrame, levels: int) -> list[DataFrame]:
    """Levels from the leaves to the roots."""
    out = [materialise(leaves(records), "fixity-leaves")]
    for _ in range(levels):
        out.append(materialise(parents(out[-1]), "fixity-level"))
    return out


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    both = left.withColumnRenamed("hash", "a").join(right.withColumnRenamed("hash", "b"), ["file", "node"], "full")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node")


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """Records (file, offset, length, digest) that differ between the two.

    Returns file, offset, status, expected_length, expected_digest, found_length, found_digest. Status is ``changed``,
    ``resized``, ``missing``, ``extra``, ``repeated`` or ``unplaced``.
    """
    columns = ["file", F.col("offset").cast("long").alias("offset"), F.col("length").cast("long").alias("length"), "digest"]
    sides = [materialise(x.select(*columns), "fixity-records") for x in (original, replica)]
    placed = [x.where("file IS NOT NULL AND offset IS NOT NULL") for x in sides]
    last = max((x.agg(F.max("offset")).first()[0] or 0) for x in placed)
    levels = max(0, -(-max(0, last.bit_length() - RANGE_BITS) // FAN_BITS))
    left, right = (tree(x, levels) for x in placed)
    wrong = materialise(_differing(left[-1], right[-1]), "fixity-wrong")
    for low_left, low_right in zip(reversed(left[:-1]), reversed(right[:-1])):
        below = [
            x.withColumn("up", F.shiftright("node", FAN_BITS))
            .join(wrong.withColumnRenamed("node", "up"), ["file", "up"], "left_semi").drop("up")
            for x in (low_left, low_right)
        ]
        wrong = materialise(_differing(*below), "fixity-wrong")
    expected, found = (
        x.withColumn("node", F.shiftright("offset", RANGE_BITS)).join(wrong, ["file", "node"], "left_semi")
        .groupBy("file", "offset", "length", "digest").agg(F.count("*").alias("n"))
        for x in placed
    )
    return _compared(expected, found).unionByName(_unplaced(*sides))


def _compared(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Equal records cancel out; what is left at one offset is paired in the order of length and digest."""
    left = expected.withColumnRenamed("n", "a").join(
        found.withColumnRenamed("n", "b").withColumnRenamed("length", "l2").withColumnRenamed("digest", "d2")
        .withColumnRenamed("file", "f2").withColumnRenamed("offset", "o2"),
        (F.col("file") == F.col("f2")) & (F.col("offset") == F.col("o2"))
        & F.col("length").eqNullSafe(F.col("l2")) & F.col("digest").eqNullSafe(F.col("d2")), "full")
    same = left.where("a <> b").select(
        "file", "offset", F.lit("repeated").alias("status"), F.col("length").alias("expected_length"),
        F.col("digest").alias("expected_digest"), F.col("l2").alias("found_length"), F.col("d2").alias("found_digest"))
    alone = left.where("a IS NULL OR b IS NULL").select(
        F.coalesce("file", "f2").alias("file"), F.coalesce("offset", "o2").alias("offset"),
        F.when(F.col("a").isNotNull(), F.struct("length", "digest")).alias("e"),
        F.when(F.col("b").isNotNull(), F.struct(F.col("l2").alias("length"), F.col("d2").alias("digest"))).alias("f"))
    pairs = alone.groupBy("file", "offset").agg(
        F.sort_array(F.collect_list("e")).alias("es"), F.sort_array(F.collect_list("f")).alias("fs"))
    pairs = pairs.select("file", "offset", F.explode(F.arrays_zip("es", "fs")).alias("p")).select(
        "file", "offset", F.col("p.es").alias("e"), F.col("p.fs").alias("f"))
    status = (
        F.when(F.col("e").isNull(), "extra").when(F.col("f").isNull(), "missing")
        .when(~F.col("e.length").eqNullSafe(F.col("f.length")), "resized").otherwise("changed"))
    return same.unionByName(pairs.select(
        "file", "offset", status.alias("status"), F.col("e.length").alias("expected_length"),
        F.col("e.digest").alias("expected_digest"), F.col("f.length").alias("found_length"),
        F.col("f.digest").alias("found_digest")))


def _unplaced(original: DataFrame, replica: DataFrame) -> DataFrame:
    lost = "file IS NULL OR offset IS NULL"
    empty = (F.lit(None).cast("long"), F.lit(None).cast("string"))
    side = lambda x, e, f: x.where(lost).select(
        "file", "offset", F.lit("unplaced").alias("status"), e[0].alias("expected_length"), e[1].alias("expected_digest"),
        f[0].alias("found_length"), f[1].alias("found_digest"))
    own = (F.col("length"), F.col("digest"))
    return side(original, own, empty).unionByName(side(replica, empty, own))
