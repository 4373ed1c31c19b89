"""Alignment of two tokenizers' tokens over the same bytes, and how often their tokens meet.

A text is encoded by a byte-level merge tokenizer (A, with a space put before it) and a sentence-piece one (B, which
puts the space itself). Tokens of both are runs of bytes, so each text has two rising lists of byte offsets where tokens end.
Offsets in both lists cut the text into groups of tokens that cover the same bytes. They are found by galloping
intersection: the elements of the shorter list are looked up in the longer, from the place of the last one found, in steps
that double until an element is bracketed, and then by halving the bracket; runs of the shorter list do so side by side. The common places cut both token lists into groups, and the differences of their ranks are the sizes.

Two tokens are linked where they lie in one group. A pair of ids counts the rows that hold it linked. Per row only its
different pairs are kept, with how often they occur, so copies of words are counted once there; partial counts are taken in
each task before they are exchanged. Counts go back to the rows by a join on the pair: broadcast while the pairs
counted are at most ``BROADCAST_PAIRS``, and otherwise exchanged by Spark, which splits the partitions of frequent pairs.

Defined results: NULL and empty texts, and those whose tokens of A or B do not spell a space and the text, have no tokens,
groups or links; every row counts for itself, whatever its id, which may be NULL or repeated; an empty table gives no rows.
Groups of any size are whole: of a large one the different ids are paired, with their numbers multiplied. Only id and
text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import drop_tables, materialise
from ordertide.llm.transducer import character_classes, compiled

LANES = 1024
BLOCK = 2**20
LARGE_GROUP = 4096  # links of one group, from which its different ids are paired instead of all its tokens
BROADCAST_PAIRS = 4_000_000  # 16 bytes each
BATCH_LINKS = 2**20
TASK_SHIFT = 40


@dataclass(frozen=True)
class Aligned:
    """One text: the ids of its tokens, and for each group the number of tokens of A and of B up to its end."""

    a: np.ndarray
    b: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray

    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.a_cut, prepend=0), np.diff(self.b_cut, prepend=0)

    def links(self) -> int:
        in_a, in_b = self.sizes()
        return int((in_a * in_b).sum())


_NONE = np.zeros(0, np.int64)
NOTHING = Aligned(_NONE, _NONE, _NONE, _NONE)


def _sought(long: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each place ``at`` the first from there on whose element is not below ``wanted``; ``long`` ends with a sentinel.

    Steps double until an element is bracketed, then the bracket is halved.
    """
    open_ = np.flatnonzero(long[at] < wanted)
    if not len(open_):
        return at
    low, high, step, last = at[open_], np.empty(len(open_), np.int64), 1, len(long) - 1
    target, going = wanted[open_], np.arange(len(open_))
    while len(going):
        probe = np.minimum(low[going] + step, last)
        smaller = long[probe] < target[going]
        high[going[~smaller]] = probe[~smaller]
        low[going[smaller]] = probe[smaller]
        going, step = going[smaller], step * 2
    while (wide := np.flatnonzero(high - low > 1)).size:
        middle = (low[wide] + high[wide]) >> 1
        smaller = long[middle] < target[wide]
        low[wide[smaller]] = middle[smaller]
        high[wide[~smaller]] = middle[~smaller]
    out = at.copy()
    out[open_] = high
    return out


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common elements of two rising lists, in the first and in the second.

    The first list is cut into ``LANES`` runs that gallop side by side, each from the place of its last element.
    """
    if not len(short) or not len(long):
        return _NONE, _NONE
    size = -(-len(short) // LANES)
    starts = np.arange(0, len(short), size)
    padded = np.append(long, np.iinfo(np.int64).max)
    places = np.empty(len(starts) * size, np.int64)
    at = np.zeros(len(starts), np.int64)
    for step in range(size):
        wanted = short[np.minimum(starts + step, len(short) - 1)]
        at = _sought(padded, at, wanted)
        places[step::size] = at
    places = places[:len(short)]
    match = np.flatnonzero(padded[places] == short)
    return match, places[match]


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common elements of two rising lists in both; the shorter drives the search."""
    if len(a) <= len(b):
        return gallop(a, b)
    in_b, in_a = gallop(b, a)
    return in_a, in_b


class Pair:
    """The two tokenizers. A is the compiled one of ``transducer``; its tokens always spell the text."""

    def __init__(self, path_a: str, path_b: str, runs: tuple[tuple[int, int], ...]):
        from sentencepiece import SentencePieceProcessor

        self.one, self.two = compiled(path_a, runs), SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [self._piece(i) for i in range(self.two.get_piece_size())]
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)

    def _piece(self, number: int) -> bytes:
        piece = self.two.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.two.is_byte(number) else piece.replace("▁", " ").encode()

    def align(self, texts: Iterable[str | None]) -> Iterator[Aligned]:
        """The tokens and groups of each text, in blocks of about ``BLOCK`` characters."""
        block, size = [], 0
        for text in texts:
            block.append(text)
            size += len(text or "")
            if size >= BLOCK:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, texts: list[str | None]) -> Iterator[Aligned]:
        """The ends of all texts that both tokenizers spell follow each other, so one search serves them all."""
        kept, base = [], 0
        for text, (a, ends) in zip(texts, self.one.encoded(" " + t if t else "" for t in texts)):
            two = self.two.encode(text, num_threads=1) if text else []
            if not two or b"".join(map(self.bytes_b.__getitem__, two)) != (" " + text).encode():
                kept.append(None)
                continue
            b = np.array(two, np.int64)
            kept.append((a, b, ends + base, np.cumsum(self.length_b[b]) + base))
            base += int(ends[-1])
        whole = [k for k in kept if k]
        in_a, in_b = common_ends(*(np.concatenate([_NONE, *(k[i] for k in whole)]) for i in (2, 3)))
        # The end of a text is common, so no group reaches into the next one.
        after_a = np.cumsum([0, *(len(k[0]) for k in whole)])
        cuts = iter(np.searchsorted(in_a, after_a).tolist())
        before = (0, 0)
        first = next(cuts)
        for k in kept:
            if k is None:
                yield NOTHING
                continue
            end = next(cuts)
            yield Aligned(k[0], k[1], in_a[first:end] + 1 - before[0], in_b[first:end] + 1 - before[1])
            first, before = end, (before[0] + len(k[0]), before[1] + len(k[1]))


def linked_pairs(found: Aligned, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The different linked pairs of ids, each as a * ``width`` + b, in order, and how often each is linked."""
    in_a, in_b = found.sizes()
    many = in_a * in_b
    first_a, first_b = found.a_cut - in_a, found.b_cut - in_b
    small = many <= LARGE_GROUP
    # Link k of a group takes token k // in_b of A and k % in_b of B.
    size, of = many[small], np.repeat(np.flatnonzero(small), many[small])
    k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    pairs = found.a[first_a[of] + k // in_b[of]] * width + found.b[first_b[of] + k % in_b[of]]
    pairs, times = np.unique(pairs, return_counts=True)
    for g in np.flatnonzero(~small).tolist():
        a, times_a = np.unique(found.a[first_a[g]:found.a_cut[g]], return_counts=True)
        b, times_b = np.unique(found.b[first_b[g]:found.b_cut[g]], return_counts=True)
        more, more_times = (a[:, None] * width + b).ravel(), (times_a[:, None] * times_b).ravel()
        pairs, where = np.unique(np.concatenate([pairs, more]), return_inverse=True)
        times = np.bincount(where, np.concatenate([times, more_times])).astype(np.int64)
    return pairs, times


def _documents(df: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    return df.select(F.col(key).alias("id"), F.col(text).alias("text")), kind


def align(df: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """(id, a, b, a_cut, b_cut) of each row: the ids of both tokenizers and where the groups end in each."""
    docs, kind = _documents(df, key, text)
    columns, runs = ("a", "b", "a_cut", "b_cut"), character_classes(path_a)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(path_a, path_b, runs)
        for batch in batches:
            found = list(pair.align(t.as_py() for t in batch.column(1)))
            arrays = [pa.array([getattr(f, c) for f in found], pa.list_(pa.int64())) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *columns])

    return docs.mapInArrow(aligned, f"id {kind}, " + ", ".join(f"{c} array<long>" for c in columns))


def links(
    df: DataFrame, key: str, text: str, path_a: str, path_b: str, describe: Callable[[Aligned], str] | None = None,
) -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, description, pairs, times) of each row.

    ``row`` is a number of the row's own. ``pairs`` are its different linked pairs, each as one number (``pair_ids``
    takes them apart), ``times`` how often each is linked. ``describe`` may make a text of a row's groups.
    """
    docs, kind = _documents(df, key, text)
    runs = character_classes(path_a)
    schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, description string, pairs array<long>, times array<long>"

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = Pair(path_a, path_b, runs), TaskContext.get().partitionId() << TASK_SHIFT
        width = len(pair.bytes_b)
        for batch in batches:
            out, size = [], 0
            for place, found in enumerate(pair.align(t.as_py() for t in batch.column(1))):
                pairs, times = linked_pairs(found, width)
                out.append((number, place, len(found.a), len(found.b), len(found.a_cut), found.links(), describe and describe(found), pairs, times))
                number, size = number + 1, size + len(pairs)
                if size >= BATCH_LINKS:
                    yield _link_batch(out, batch)
                    out, size = [], 0
            if out:
                yield _link_batch(out, batch)

    return docs.mapInArrow(linked, schema)


def _link_batch(rows: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
    row, place, *numbers, description, pairs, times = zip(*rows)
    ids = batch.column(0).slice(place[0], len(place))
    arrays = [pa.array(row, pa.int64()), ids, *[pa.array(n, pa.int64()) for n in numbers], pa.array(description, pa.string())]
    arrays += [pa.array(x, pa.list_(pa.int64())) for x in (pairs, times)]
    return pa.RecordBatch.from_arrays(
        arrays, names=["row", "id", "n_a", "n_b", "n_groups", "n_links", "description", "pairs", "times"])


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): how many rows hold each pair, and whether no pair of its id of A is held by more."""
    counts = linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    counts = materialise(counts, "pair-counts")
    a = F.expr(f"pair div {width}").alias("a")
    highest = counts.groupBy(a).agg(F.max("count").alias("highest"))
    rated = counts.withColumn("a", F.expr(f"pair div {width}")).join(highest, "a")
    return rated.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def scored(
    df: DataFrame, key: str, text: str, path_a: str, path_b: str, describe: Callable[[Aligned], str] | None = None,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """``links`` without the pairs, and ``n_best``, ``count_sum``: how many links have the highest count of their id of
    A, and the sum of the counts of all links. The result is a table of its own in the shared folder."""
    from sentencepiece import SentencePieceProcessor

    width = SentencePieceProcessor(model_file=path_b).get_piece_size()
    linked = materialise(links(df, key, text, path_a, path_b, describe), "links")
    rated = materialise(pair_counts(linked, width), "pair-ratings")
    if rated.count() <= broadcast_pairs:
        rated = F.broadcast(rated)
    each = linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    each = each.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")).join(rated, "pair")
    sums = each.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    out = linked.drop("pairs", "times").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
    out = materialise(out, "aligned")
    drop_tables(df.sparkSession, linked, rated)
    return out
