"""Exact top-k search among binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments of 16 bits, each with its own index. In round s every query looks up all
segment values that differ from its own in s bits. After round s each code within
``segments * (s + 1) - 1`` bits of the query has been met, so a query is finished once its k-th verified distance
is at most that. Only unfinished queries go on.

Only DataFrame functions. Equal codes are searched once, with their k smallest ids, and equal queries too, so
groups of copies cost one entry. A pair is verified where it is met first (least radius, then segment), so no
pair is emitted twice, and only if it is as near as the k-th found in earlier rounds. Rounds are written to the
shared folder.

Defined results: the query itself is among the rows searched; ties go to the smaller id; with fewer than k rows
all are returned; a NULL vector has no code, is not found and finds nothing; NULL or missing elements are 0 bits;
repeated ids count as separate rows. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import materialise

CODE_BITS, SEGMENTS = 64, 4
WIDTH = CODE_BITS // SEGMENTS


def sign_code(vector: Column) -> Column:
    """64 bits: whether each of the first 64 elements is at least 0."""
    bits = [F.when(F.get(vector, i) >= 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")) for i in range(CODE_BITS)]
    code = F.lit(0).cast("long")
    for i, bit in enumerate(bits):
        code = code.bitwiseOR(F.shiftleft(bit, i))
    return F.when(vector.isNotNull(), code)


def segment(code: Column, number: int) -> Column:
    """The 16 bits of one segment."""
    return F.shiftrightunsigned(code, WIDTH * number).bitwiseAND(2**WIDTH - 1).cast("int")


def _segments(code: Column) -> Column:
    return F.array(*[F.struct(F.lit(j).alias("segment"), segment(code, j).alias("value")) for j in range(SEGMENTS)])


def _flips(radius: int) -> Column:
    """All values of one segment with ``radius`` bits set, as a constant."""
    values = (sum(1 << bit for bit in chosen) for chosen in combinations(range(WIDTH), radius))
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def _worth(radius: int) -> Column:
    """Whether the pair is met in no earlier round or segment than this, and is as near as the k-th found so far."""
    apart = [F.bit_count(segment(F.col("qcode").bitwiseXOR(F.col("code")), j)) for j in range(SEGMENTS)]
    ok = F.bit_count(F.col("qcode").bitwiseXOR(F.col("code"))) <= F.col("kth")
    for j, d in enumerate(apart):
        ok = ok & F.when(F.col("segment") > j, d > radius).otherwise(d >= radius)
    return ok


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, neighbour_id, distance) of the k nearest rows of each query.

    Both inputs have (id, code), code a long, see ``sign_code``.
    """
    rows = rows.select("id", "code").where("code IS NOT NULL")
    queries = materialise(queries.select("id", "code").where("code IS NOT NULL"), "hamming-queries")
    rank = Window.partitionBy("code").orderBy("id")
    few = rows.withColumn("nr", F.row_number().over(rank)).where(F.col("nr") <= k)
    codes = materialise(few.groupBy("code").agg(F.collect_list("id").alias("ids")), "hamming-codes")
    wanted = min(k, codes.agg(F.sum(F.size("ids"))).first()[0] or 0)
    index = codes.select("code", "ids", F.explode(_segments(F.col("code"))).alias("s")).select("code", "ids", "s.*")
    index = materialise(index, "hamming-index")
    still = queries.select(F.col("code").alias("qcode"), F.lit(CODE_BITS).alias("kth")).distinct()
    still = materialise(still, "hamming-open")
    found, done = None, None
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    for radius in range(WIDTH + 1):
        flips = F.explode(_flips(radius))
        # A few rows become thousands of probes each, so they are dealt to all cores first.
        dealt = still.select("qcode", "kth", F.explode(_segments(F.col("qcode"))).alias("s")).repartition(tasks, "qcode", "s")
        probes = dealt.select("qcode", "kth", "s.segment", F.col("s.value").alias("own"), flips.alias("flip"))
        probes = probes.select("qcode", "kth", "segment", F.col("own").bitwiseXOR(F.col("flip")).cast("int").alias("value"))
        # The probes are many more than their estimated size, so they must never be broadcast.
        met = probes.hint("merge").join(index, ["segment", "value"]).where(_worth(radius)).select(
            "qcode", F.explode("ids").alias("id"), F.bit_count(F.col("qcode").bitwiseXOR(F.col("code"))).alias("distance"))
        if found is not None:
            met = met.unionByName(found.join(still, "qcode", "left_semi"))
        nearest = Window.partitionBy("qcode").orderBy("distance", "id")
        found = met.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).drop("rank")
        found = materialise(found, "hamming-found")
        covered = SEGMENTS * (radius + 1) - 1
        reach = found.groupBy("qcode").agg(F.count("*").alias("n"), F.max("distance").alias("kth"))
        ready = reach.where((F.col("n") >= wanted) & (F.col("kth") <= covered)).select("qcode")
        kept = found.join(ready, "qcode", "left_semi")
        done = kept if done is None else done.unionByName(kept)
        bound = F.when(F.col("n") >= wanted, F.col("reach")).otherwise(CODE_BITS).alias("kth")
        left = still.select("qcode").join(ready, "qcode", "left_anti").join(reach.withColumnRenamed("kth", "reach"), "qcode", "left")
        still = materialise(left.select("qcode", bound), "hamming-open")
        if still.isEmpty():
            break
    nearest = Window.partitionBy("qcode").orderBy("distance", "id")
    ranked = done.withColumn("rank", F.row_number().over(nearest)).withColumnRenamed("id", "neighbour_id")
    return queries.withColumnsRenamed({"id": "query_id", "code": "qcode"}).join(ranked, "qcode").select(
        "query_id", "rank", "neighbour_id", "distance")
