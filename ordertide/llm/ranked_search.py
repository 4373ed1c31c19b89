"""Ranked lexical search over a length-stratified index.

A document's normaliser m is a whole number that depends only on its length, so documents of one m form a stratum, and
in it a term's impact depends only on how often it occurs (tf). The index is a table of postings, one row per stratum, block and
term: the distinct tf in falling order, and for each the documents. Strata are dealt into blocks of bounded words,
so a frequent length is spread over many tasks, and one of few documents is one row per term.

Building reads the texts twice: once for their lengths, from which N, L and the blocks of the large strata follow, and
once for their terms. A document moves once, as one row of terms with counts, to the task that inverts its block.

A search keeps the postings of the queries' terms. Per stratum the largest tf of each term bounds every score in
it, so strata are ordered per query: the ``FIRST`` strata with the highest bounds are visited first and give
the k-th best score, and of all others only blocks whose bound reaches it. Visits of a block add up whole-number impacts, each
computed once per tf, into one array of scores per query. Each task keeps k documents per query over all its blocks.

Defined results: NULL and empty texts have no terms, count for nothing and are never found; every row is a document of
its own, so repeated rows are ranked side by side; documents without an id come after others of equal score; equal scores are in
order of id; queries without terms find nothing; repeated query ids are queries of their own. Texts of any length are
read whole. Empty tables give no rows. Only ids and texts are read. Ids of documents must be whole numbers.

Bounds: queries are taken in blocks of ``QUERY_BYTES``; the driver holds one block's terms and, per query, ``FIRST``
strata and one score. The numbers of blocks of large strata are sent to the tasks: at most one per value of m.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import drop_tables, materialise
from ordertide.llm.words import plain_words

BLOCK_DOCUMENTS, BLOCK_WORDS = 4096, 2**21
QUERY_BYTES = 2**20
FIRST = 4
ONE, UNIT, LENGTH_WEIGHT = 10**9, 1000, 8
POSTINGS = "m long, block long, term string, tfs array<long>, ends array<long>, docs array<long>"
_LAST_ID = np.iinfo(np.int64).max


@dataclass
class Index:
    """Postings, and the numbers that the weights need. A row without a term lists its block's document ids in order;
    ``docs`` of the other rows are places in that list, and ``ends`` where the documents of each tf end."""

    postings: DataFrame
    documents: int  # N, with at least one term
    terms: int  # L, of all documents with repeats


def normaliser(n, documents: int, terms: int):
    """m of a document of ``n`` terms; for numbers and columns of whole numbers alike."""
    return 100 - 75 + (75 * n * documents) // terms


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (ONE * tf) // (UNIT * tf + LENGTH_WEIGHT * m)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Counter(len(plain_words(t.as_py())) for t in batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["n", "documents"])


def build_index(docs: DataFrame, key: str, text: str, block_documents: int = BLOCK_DOCUMENTS, block_words: int = BLOCK_WORDS) -> Index | None:
    """The index of all rows, its postings a table in the shared folder; None if no row has a term."""
    rows = _rows(docs, key, text)
    lengths = rows.select("text").mapInArrow(_lengths, "n long, documents long").where("n > 0")
    lengths = materialise(lengths.groupBy("n").agg(F.sum("documents").alias("documents")), "search-lengths")
    documents, terms = lengths.agg(F.sum("documents"), F.sum(F.col("n") * F.col("documents"))).first()
    if not documents:
        drop_tables(docs.sparkSession, lengths)
        return None
    strata = lengths.groupBy(F.expr(f"100 - 75 + ((75 * n * {documents}) div {terms})").alias("m")).agg(
        F.sum("documents").alias("d"), F.sum(F.col("n") * F.col("documents")).alias("w"))
    blocks = F.greatest(F.ceil(F.col("d") / block_documents), F.ceil(F.col("w") / block_words)).cast("long")
    large = {r["m"]: r["b"] for r in strata.select("m", blocks.alias("b")).where("b > 1").collect()}
    drop_tables(docs.sparkSession, lengths)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * 7919  # rows of one stratum are dealt in turn, each task from another block on
        for batch in batches:
            out = []
            for one, words in zip(batch.column(0).to_pylist(), (plain_words(t.as_py()) for t in batch.column(1))):
                if words:
                    counts, m = Counter(words), normaliser(len(words), documents, terms)
                    tfs = np.fromiter(counts.values(), "<i8", len(counts)).tobytes()
                    out.append((m, number % large.get(m, 1), one, b" ".join(counts), tfs))
                    number += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            columns = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["m", "block", "id", "terms", "tfs"])

    dealt = rows.mapInArrow(counted, "m long, block long, id long, terms binary, tfs binary")
    dealt = dealt.repartition("m", "block").sortWithinPartitions("m", "block")
    return Index(materialise(dealt.mapInArrow(_inverted, POSTINGS), "search-postings"), int(documents), int(terms))


def _inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(m, block, id, terms, tfs), sorted by block, to the postings of each block."""
    for m, block, rows in _blocks(batches):
        words = [w for batch in rows for t in batch.column(3) for w in t.as_py().split(b" ")]
        tfs = [np.frombuffer(t.as_py(), "<i8") for batch in rows for t in batch.column(4)]
        ids = pa.concat_arrays([batch.column(2) for batch in rows])
        encoded = pa.array(words, pa.binary()).dictionary_encode()
        names, code = encoded.dictionary.cast(pa.string()), encoded.indices.to_numpy(zero_copy_only=False)
        place, tf = np.repeat(np.arange(len(tfs)), [len(x) for x in tfs]), np.concatenate(tfs)
        order = np.lexsort((place, -tf, code))
        code, tf, place = code[order], tf[order], place[order]
        new_term = np.concatenate([[True], code[1:] != code[:-1]])
        new_tf = np.flatnonzero(new_term | np.concatenate([[True], tf[1:] != tf[:-1]]))
        starts = np.flatnonzero(new_term)
        tf_ends = np.append(new_tf[1:], len(tf)) - starts[code[new_tf]]
        of_tf = np.append(np.searchsorted(new_tf, starts), len(new_tf))
        _lists = lambda offsets, values: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
        none = pa.array([[]], pa.list_(pa.int64()))
        yield _postings(m, block, pa.nulls(1, pa.string()), none, none, pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids))
        yield _postings(m, block, names, _lists(of_tf, tf[new_tf]), _lists(of_tf, tf_ends), _lists(np.append(starts, len(tf)), place))


def _postings(m: int, block: int, *columns: pa.Array) -> pa.RecordBatch:
    size = len(columns[0])
    head = [pa.array(np.full(size, x, np.int64)) for x in (m, block)]
    return pa.RecordBatch.from_arrays([*head, *columns], names=["m", "block", "term", "tfs", "ends", "docs"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[pa.RecordBatch]]]:
    """(m, block, rows) of each run of rows of one block."""
    key, rows = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        m, block = (batch.column(i).to_numpy() for i in (0, 1))
        cut = np.flatnonzero((m[1:] != m[:-1]) | (block[1:] != block[:-1])) + 1
        for first, end in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            own = (int(m[first]), int(block[first]))
            if own != key:
                if rows:
                    yield *key, rows
                key, rows = own, []
            rows.append(batch.slice(first, end - first))
    if rows:
        yield *key, rows


@dataclass
class Queries:
    """One block of queries: for each term the queries that have it and how much an impact of 1 adds to their score."""

    ids: list
    terms: dict[str, tuple[np.ndarray, np.ndarray]]


def _query_blocks(items: DataFrame, key: str, text: str, size: int) -> Iterator[list[tuple[object, Counter]]]:
    block, used = [], 0
    for row in items.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t")).toLocalIterator():
        words = plain_words(row["t"] and bytes(row["t"]))
        if words:
            block.append((row["k"], Counter(w.decode() for w in words)))
            used += len(row["t"])
        if used >= size:
            yield block
            block, used = [], 0
    if block:
        yield block


def _weighted(block: list[tuple[object, Counter]], weights: dict[str, int]) -> Queries:
    of_term: dict[str, list[tuple[int, int]]] = {}
    for q, (_, counts) in enumerate(block):
        for term, times in counts.items():
            if weights.get(term, 0) > 0:
                of_term.setdefault(term, []).append((q, times * weights[term]))
    return Queries([k for k, _ in block], {t: tuple(np.array(x, np.int64) for x in zip(*found)) for t, found in of_term.items()})


class Visits:
    """Scores blocks and keeps the ``k`` best documents of each query."""

    def __init__(self, queries: Queries, k: int, floor: np.ndarray):
        self.queries, self.k, self.floor = queries, k, floor.copy()
        self.best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, m: int, rows: list[pa.RecordBatch], chosen: np.ndarray) -> None:
        """Score the block for those of the queries ``chosen`` (flags) whose bound reaches their score to beat."""
        ids, lists = None, {}
        for batch in rows:
            for term, tfs, ends, docs in zip(*(batch.column(i) for i in (2, 3, 4, 5))):
                if not term.is_valid:
                    ids = docs.values.fill_null(_LAST_ID).to_numpy(zero_copy_only=False)
                elif term.as_py() in self.queries.terms:
                    ends = ends.values.to_numpy()
                    impacts = impact(tfs.values.to_numpy(), m)
                    lists[term.as_py()] = docs.values.to_numpy(), np.repeat(impacts, np.diff(ends, prepend=0)), int(impacts[0])
        bound = np.zeros(len(self.floor), np.int64)
        parts: dict[int, list[tuple[str, int]]] = {}
        for term, (_, _, highest) in lists.items():
            of, weight = self.queries.terms[term]
            bound[of] += weight * highest
        for term in lists:
            for q, weight in zip(*(x.tolist() for x in self.queries.terms[term])):
                if chosen[q] and bound[q] >= self.floor[q]:
                    parts.setdefault(q, []).append((term, weight))
        scores = np.zeros(len(ids), np.int64)
        for q, found in parts.items():
            scores[:] = 0
            for term, weight in found:
                places, impacts, _ = lists[term]
                scores[places] += weight * impacts
            at = np.flatnonzero(scores >= max(1, self.floor[q]))
            if len(at):
                self._keep(q, scores[at], ids[at])

    def _keep(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if q in self.best:
            scores, ids = np.concatenate([self.best[q][0], scores]), np.concatenate([self.best[q][1], ids])
        if len(scores) > 4 * self.k:
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[scores >= least], ids[scores >= least]
        order = np.lexsort((ids, -scores))[:self.k]
        self.best[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.floor[q] = max(self.floor[q], self.best[q][0][-1])

    def rows(self) -> pa.RecordBatch:
        sizes = [len(s) for s, _ in self.best.values()]
        query = np.repeat(np.array(list(self.best), np.int64), sizes)
        scores, ids = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*self.best.values()) if sizes else ([], [])))
        return pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(ids, mask=ids == _LAST_ID), pa.array(scores)], names=["query", "doc_id", "score"])


def _bounds(queries: Queries):
    """(m, term, tf), sorted by m, to (query, m, bound): the most a document of the stratum may score."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, np.zeros(len(queries.ids), np.int64)

        def rows() -> pa.RecordBatch:
            at = np.flatnonzero(sums)
            return pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(np.full(len(at), key or 0)), pa.array(sums[at])], names=["query", "m", "bound"])

        for batch in batches:
            for m, term, tf in zip(*(c.to_pylist() for c in batch.columns)):
                if m != key:
                    yield rows()
                    key = m
                    sums[:] = 0
                of, weight = queries.terms[term]
                sums[of] += weight * int(impact(np.int64(tf), m))
        yield rows()

    return bounds


def search(index: Index | None, items: DataFrame, key: str, text: str, k: int, first: int = FIRST, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(id, rank, doc_id, score): the ``k`` documents of the highest score above 0 of each of ``items``."""
    spark, kind = items.sparkSession, items.select(F.col(key)).schema[0].dataType
    out = None
    for block in _query_blocks(items, key, text, query_bytes) if index else ():
        found = _search_block(index, block, k, first)
        names = spark.createDataFrame([(q, k_) for q, (k_, _) in enumerate(block)], f"query long, id {kind.simpleString()}")
        found = found.join(names, "query").select("id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"id {kind.simpleString()}, rank int, doc_id long, score long")
    return out


def _search_block(index: Index, block: list[tuple[object, Counter]], k: int, first: int) -> DataFrame:
    spark = index.postings.sparkSession
    words = sorted(set().union(*(counts for _, counts in block)))
    wanted = spark.createDataFrame([(w,) for w in [None, *words]], "word string")
    postings = materialise(index.postings.join(wanted, F.col("term").eqNullSafe(F.col("word")), "left_semi"), "search-lists")
    df = postings.where("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.documents + 2) / (2.0 * F.col("df") + 1))).cast("long")
    queries = _weighted(block, {r["term"]: r["w"] for r in df.select("term", weight.alias("w")).collect()})
    most = postings.where("term IS NOT NULL").groupBy("m", "term").agg(F.max(F.col("tfs")[0]).alias("tf"))
    useful = spark.createDataFrame([(t,) for t in queries.terms], "term string")
    most = most.join(useful, "term", "left_semi").select("m", "term", "tf").repartition("m").sortWithinPartitions("m")
    bounds = most.mapInArrow(_bounds(queries), "query long, m long, bound long")
    ahead = Window.partitionBy("query").orderBy(F.desc("bound"), "m")
    plan = bounds.withColumn("place", F.row_number().over(ahead)).where(F.col("place") <= first).select("query", "m").collect()
    strata: dict[int, list[int]] = {}
    for row in plan:
        strata.setdefault(row["m"], []).append(row["query"])

    def visited(floor: np.ndarray, again: bool):
        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            visits = Visits(queries, k, floor)
            for m, _, rows in _blocks(batches):
                chosen = np.full(len(floor), again)
                chosen[strata.get(m, [])] = not again
                visits.block(m, rows, chosen)
            yield visits.rows()

        return visit

    result, ranked = "query long, doc_id long, score long", Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    in_blocks = lambda lists: lists.repartition("m", "block").sortWithinPartitions("m", "block", F.asc_nulls_first("term"))
    none = np.zeros(len(block), np.int64)
    early = in_blocks(postings.where(F.col("m").isin(list(strata)))).mapInArrow(visited(none, False), result)
    early = materialise(early.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k), "search-first")
    floor = none.copy()
    for row in early.where(F.col("rank") == k).select("query", "score").collect():
        floor[row["query"]] = row["score"]
    late = in_blocks(postings).mapInArrow(visited(floor, True), result)
    both = early.drop("rank").unionByName(late).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    both = materialise(both, "search-found")
    drop_tables(spark, postings, early)
    return both
