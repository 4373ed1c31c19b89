"""Substring deduplication with prefix-partitioned suffix trees.

A window of ``WINDOW`` words of a document is removed if the same words also start in a document of smaller id. Equal
windows are equal suffixes down to that depth, so they lie below one internal node of the suffix tree of all texts.
The tree is never built whole; suffixes are split into groups by a prefix, and each group's subtree is built alone:

* The prefix of a window is its anchor: of its runs of ``PREFIX`` words the one with the smallest hash. Equal windows
  have equal anchors at the same place, and neighbouring windows mostly share one, so the windows of one anchor
  travel together as one stretch of words.
* A text's words are hashed once, for its anchors; later steps read these. Texts move once to the stretches that repeat
  in them, and once to the words that they lose, which are told as spans.
* Anchors that occur in one document only cannot repeat, and their stretches are never moved. Anchors with their ids
  are dealt by anchor and sorted, and a pass over them keeps those that several documents have.
* Equal stretches are first counted as one, with the smallest id. Then the stretches of an anchor are one group. Where
  more than ``GROUP`` different stretches share an anchor, its windows are split by their own first words, two words more
  each time, until a group fits or the prefix is the whole window.
* In a group the suffixes that start a window are sorted; neighbours with a common prefix of ``WINDOW`` words or more are
  leaves of one deep internal node, whose smallest id decides for all of them.

Equal texts (equal word sequences) are settled first: all but the one of smallest id consist of repeats.

Hashes only choose groups and tell rows apart (64 bits each for anchors, for stretches beside them, and for texts
beside their ids); windows are compared by their words.

Defined results: NULL and empty texts, and texts of fewer than ``WINDOW`` words, lose nothing; rows without an id
are kept whole and count for nobody; rows with one id never remove words from each other; texts that keep all words
stay as they are, others are their kept words joined by spaces, which may be none. Empty tables give no rows. Only id
and text are read; filtering keeps all columns. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import bounded, drop_tables, fresh_names, materialise
from ordertide.llm.near_dedup import WordHasher, shingles
from ordertide.llm.words import spaced_words

WINDOW, PREFIX = 13, 5
GROUP = 4096
LONGER = (7, 9, 11)  # words of the prefixes that split an over-full group
BATCH_ANCHORS = 2**18


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, first window) of each anchor of a text's word hashes, in order."""
    if len(hashes) < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    runs = shingles(hashes, PREFIX)
    views = np.lib.stride_tricks.sliding_window_view(runs, WINDOW - PREFIX + 1)
    at = views.argmin(axis=1) + np.arange(len(views))
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return runs[at[first]], first


def _pack(values: np.ndarray) -> bytes:
    """48 bits of each value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<i8").ravel()


_PREPARED = "id long, h long, digest binary, n_words long, anchors binary, steps binary"


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, text) to the text's digest and its anchors: their values, and the windows from one to the next.

    Rows that cannot lose words, as they have too few or no id, have no anchors.
    """
    hasher = WordHasher()
    for batch in batches:
        out = []
        for one, text in zip(batch.column(0), batch.column(2)):
            words = spaced_words(text.as_py())
            value, first = anchors(hasher(words)) if one.is_valid and len(words) >= WINDOW else (_NONE, _NONE)
            # No anchor holds for more windows than it has places in a window.
            out.append((hashlib.sha256(b" ".join(words)).digest(), len(words), _pack(value), np.diff(first, prepend=0).astype(np.uint8).tobytes()))
        kinds = (pa.binary(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]],
            names=["id", "h", "digest", "n_words", "anchors", "steps"])


_NONE = np.zeros(0, np.int64)


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, anchors) to (anchor, id) rows, an anchor once per text."""
    values, ids, size = [], [], 0

    def rows() -> pa.RecordBatch:
        owner = np.repeat(np.array(ids, np.int64), [len(v) for v in values])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([_NONE, *values])), pa.array(owner)], names=["anchor", "id"])

    for batch in batches:
        for one, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            values.append(np.unique(_unpack(packed.as_py())))
            ids.append(one)
            size += len(values[-1])
            if size >= BATCH_ANCHORS:
                yield rows()
                values, ids, size = [], [], 0
    yield rows()


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, id), sorted, to the rows whose anchor several ids have.

    Of a run of one anchor only rows of its first id wait, until another id comes.
    """
    wait_anchor, wait_id = _NONE, _NONE
    known = None  # the anchor of the last run, once it is known to repeat
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = np.concatenate([wait_anchor, batch.column(0).to_numpy()])
        one = np.concatenate([wait_id, batch.column(1).to_numpy()])
        start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        end = np.append(start[1:], len(anchor))
        several = one[start] != one[end - 1]
        if known is not None and anchor[0] == known:
            several[0] = True
        keep = np.repeat(several, end - start)
        waits = len(anchor) if several[-1] else int(start[-1])
        known = anchor[-1] if several[-1] else None
        wait_anchor, wait_id = anchor[waits:], one[waits:]
        keep[waits:] = False
        yield pa.RecordBatch.from_arrays([pa.array(anchor[keep]), pa.array(one[keep])], names=["anchor", "id"])


_STRETCH = "anchor long, id long, h long, start int, content binary"


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, n_words, anchors, steps, repeated) to (id, h, anchors, firsts, ends) of the anchors that repeat."""
    for batch in batches:
        out = []
        for n_words, value, step, found in zip(*(batch.column(i) for i in range(2, 6))):
            value, first = _unpack(value.as_py()), np.cumsum(np.frombuffer(step.as_py(), np.uint8), dtype=np.int64)
            # The stretch of an anchor ends with the last word of its last window.
            end = np.append(first[1:], n_words.as_py() - WINDOW + 1) + WINDOW - 1
            at = np.isin(value, found.values.to_numpy())
            out.append((value[at], first[at], end[at]))
        lists = [pa.array([r[i] for r in out], pa.list_(pa.int64())) for i in range(3)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["id", "h", "anchors", "firsts", "ends"])


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, text) to (id, h, words joined by spaces and compressed), to move less."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [press.compress(b" ".join(spaced_words(t.as_py()))) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["id", "h", "packed"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, packed, anchors, firsts, ends) to the stretches of windows whose anchor repeats."""
    import zstandard

    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(batch.column(i) for i in range(6))):
            one, h, joined = row[0].as_py(), row[1].as_py(), unpress.decompress(row[2].as_py())
            value, first, end = (x.values.to_numpy() for x in row[3:])
            # Word i lies from begin[i] to before begin[i + 1] - 1.
            begin = np.concatenate([[0], np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + 1, [len(joined) + 1]])
            left, right = begin[first].tolist(), (begin[end] - 1).tolist()
            out += [(v, one, h, s, joined[x:y]) for v, s, x, y in zip(value.tolist(), first.tolist(), left, right)]
            if len(out) >= 2**15:  # a long document has many
                yield _stretch_batch(out)
                out = []
        if out:
            yield _stretch_batch(out)


def _stretch_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["anchor", "id", "h", "start", "content"])


def smallest_below(group: list[tuple[list[bytes], int]]) -> list[list[int]]:
    """For each stretch of a group (words, smallest id) the smallest id that has each of its windows.

    The subtree is its leaves in order: all suffixes that start a window, sorted. Leaves below one internal node of
    depth ``WINDOW`` or more are neighbours.
    """
    out = [[low] * (len(words) - WINDOW + 1) for words, low in group]
    leaves = sorted((words[s:], i, s) for i, (words, _) in enumerate(group) for s in range(len(words) - WINDOW + 1))
    node: list[tuple[int, int]] = []
    last: list[bytes] | None = None

    def settle() -> None:
        least = min(group[i][1] for i, _ in node)
        for i, s in node:
            out[i][s] = least

    for suffix, i, s in leaves:
        if last is None or suffix[:WINDOW] != last:
            if len(node) > 1:
                settle()
            node, last = [], suffix[:WINDOW]
        node.append((i, s))
    if len(node) > 1:
        settle()
    return out


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, mark, content, low, high), sorted by anchor, to (anchor, mark, lows) where some document loses words."""
    group: list[tuple] = []
    done: list[tuple] = []

    def settle() -> None:
        if len(group) > 1:
            lows = smallest_below([(g[2].split(), g[3]) for g in group])
        else:
            lows = [[g[3]] * (len(g[2].split()) - WINDOW + 1) for g in group]
        done.extend((g[0], g[1], low) for g, low in zip(group, lows) if min(low) < g[4])

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
            pa.array([d[2] for d in done], pa.list_(pa.int64()))], names=["anchor", "mark", "lows"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and group[0][0] != row[0]:
                settle()
                group = []
            group.append(row)
        if len(done) > 2**14:
            yield flush()
            done.clear()
    settle()
    yield flush()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of anchors that too many share, window by window, each with all its words as the prefix."""
    for batch in batches:
        out = []
        for anchor, mark, content, low, high in zip(*(c.to_pylist() for c in batch.columns)):
            words = content.split()
            out += [(anchor, mark, s, b" ".join(words[s:s + WINDOW]), low, high) for s in range(len(words) - WINDOW + 1)]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["anchor", "mark", "s", "words", "low", "high"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, parts) to (id, h, spans); ``parts`` are stretches: start, smallest id of each window."""
    for batch in batches:
        found = []
        for one, parts in zip(batch.column(0).to_pylist(), batch.column(2)):
            starts, lows = parts.values.field("start").to_numpy(), parts.values.field("lows")
            size = np.diff(lows.offsets.to_numpy())
            low = lows.values.to_numpy()[lows.offsets[0].as_py():lows.offsets[-1].as_py()]
            window = np.unique((np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(len(low)))[low < one])
            new = np.flatnonzero(np.concatenate([[True], window[1:] > window[:-1] + WINDOW]))  # windows that touch are one span
            found.append(np.stack([window[new], window[np.append(new[1:], len(window)) - 1] + WINDOW], axis=1).ravel())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["id", "h", "spans"])


def text_mark(text: str) -> Column:
    """What tells texts under one id apart."""
    return F.xxhash64(F.col(text).cast("binary"))


def removals(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, h, spans) once for each text that loses words, a table in the shared folder. Ids must be whole numbers.

    ``h`` is the text's ``text_mark``; ``spans`` are the words lost: first, end, first, end, ... in rising order.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), text_mark(text).alias("h"), F.col(text).cast("binary").alias("text"))
    seen = materialise(rows.mapInArrow(bounded(_prepared), _PREPARED), "repeats-texts")
    texts = seen.where(F.col("id").isNotNull() & (F.col("n_words") >= WINDOW)).select("id", "h", "digest", "n_words").distinct()
    texts = materialise(texts.join(texts.groupBy("digest").agg(F.min("id").alias("low")), "digest").drop("digest"), "repeats-lows")
    firsts = texts.where("id = low").select("id", "h")
    own = seen.select("id", "h", "n_words", "anchors", "steps").join(firsts, ["id", "h"], "left_semi")
    pairs = own.select("id", "anchors").mapInArrow(bounded(_exploded), "anchor long, id long")
    pairs = pairs.repartition("anchor").sortWithinPartitions("anchor", "id")
    repeated = pairs.mapInArrow(_repeated, "anchor long, id long").groupBy("id").agg(F.collect_set("anchor").alias("repeated"))
    places = own.dropDuplicates(["id", "h"]).join(repeated, "id").select("id", "h", "n_words", "anchors", "steps", "repeated").mapInArrow(
        bounded(_placed), "id long, h long, anchors array<long>, firsts array<long>, ends array<long>")
    places = materialise(places, "repeats-places")
    drop_tables(spark, seen)
    packed = rows.mapInArrow(bounded(_squeezed), "id long, h long, packed binary")
    known = packed.join(places, ["id", "h"]).dropDuplicates(["id", "h"]).select("id", "h", "packed", "anchors", "firsts", "ends")
    known = materialise(known, "repeats-candidates")
    drop_tables(spark, places)
    stretches = known.mapInArrow(bounded(_stretches), _STRETCH).withColumn("mark", F.xxhash64("content"))
    groups = stretches.groupBy("anchor", "mark", "content").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    lows = _decided(groups)
    found = stretches.select("anchor", "mark", "id", "h", "start").join(lows, ["anchor", "mark"])
    found = found.where(F.exists("lows", lambda low: low < F.col("id")))
    parts = found.groupBy("id", "h").agg(F.collect_list(F.struct("start", "lows")).alias("parts"))
    spans = parts.mapInArrow(bounded(_spans), "id long, h long, spans array<long>")
    copies = texts.where("low < id").select("id", "h", F.array(F.lit(0).cast("long"), F.col("n_words")).alias("spans"))
    out = materialise(spans.unionByName(copies), "repeats-spans")
    drop_tables(spark, texts, known, lows)
    return out


def kept_words(text: bytes | None, spans: list[int] | None) -> tuple[list[bytes], int]:
    """The words that a text keeps, and how many it loses."""
    words = spaced_words(text)
    if not spans:
        return words, 0
    kept, at = [], 0
    for first, end in zip(spans[::2], spans[1::2]):
        kept += words[at:first]
        at = end
    kept += words[at:]
    return kept, len(words) - len(kept)


def with_spans(docs: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """``docs`` with all columns, and the spans that each row's text loses, or NULL, as column ``name``."""
    lost = removals(docs, key, text)
    id_, mark = fresh_names([*docs.columns, name], "lost_id", "lost_mark")
    lost = lost.select(F.col("id").alias(id_), F.col("h").alias(mark), F.col("spans").alias(name))
    same = (F.col(key).cast("long") == F.col(id_)) & (text_mark(text) == F.col(mark))
    return docs.join(lost, same, "left").select(*[docs[c] for c in docs.columns], name)


def _decided(groups: DataFrame) -> DataFrame:
    """(anchor, mark, lows) of the stretches of which some document loses words."""
    groups = materialise(groups, "repeats-groups")
    large = groups.groupBy("anchor").count().where(F.col("count") > GROUP).select("anchor")
    large = materialise(large, "repeats-large")
    columns = ["anchor", "mark", "content", "low", "high"]
    if large.isEmpty():
        return _written(_grouped(groups.select(*columns), "anchor"), groups, large)
    small = groups.join(large, "anchor", "left_anti").select(*columns)
    windows = groups.join(large, "anchor", "left_semi").select(*columns).mapInArrow(
        bounded(_windows), "anchor long, mark long, s int, words binary, low long, high long")
    lows = _lengthened(materialise(windows, "repeats-windows")).groupBy("anchor", "mark").agg(
        F.sort_array(F.collect_list(F.struct("s", "least"))).alias("lows"), F.max("high").alias("high"))
    lows = lows.select("anchor", "mark", F.col("lows.least").alias("lows"), "high")
    lows = lows.where(F.exists("lows", lambda low: low < F.col("high"))).drop("high")
    return _written(_grouped(small, "anchor").unionByName(lows), groups, large)


def _lengthened(windows: DataFrame) -> DataFrame:
    """(anchor, mark, s, high, least): the smallest id below each window's node, over groups of ever longer prefixes."""
    settled, rest = None, windows
    for length in LONGER:
        split = rest.withColumn("prefix", F.substring_index(F.col("words").cast("string"), " ", length))
        sizes = split.groupBy("prefix").count()
        small = split.join(sizes.where(F.col("count") <= GROUP).select("prefix"), "prefix")
        least = small.repartition("prefix").sortWithinPartitions("prefix").select("prefix", "words", "low", "anchor", "mark", "s", "high")
        least = least.mapInArrow(_least, "anchor long, mark long, s int, high long, least long")
        settled = least if settled is None else settled.unionByName(least)
        rest = split.join(sizes.where(F.col("count") > GROUP).select("prefix"), "prefix").drop("prefix")
    # The whole window as the prefix: all leaves of a group lie below one node.
    whole = rest.join(rest.groupBy("words").agg(F.min("low").alias("least")), "words").select("anchor", "mark", "s", "high", "least")
    return settled.unionByName(whole)


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows, sorted by prefix, to the smallest id of the node that each lies below; a group is held at a time."""
    def settle(group: list[tuple]) -> list[tuple]:
        lows = smallest_below([(row[1].split(), row[2]) for row in group])
        return [(*row[3:], low[0]) for row, low in zip(group, lows)]

    group: list[tuple] = []
    for batch in batches:
        done: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and group[0][0] != row[0]:
                done += settle(group)
                group = []
            group.append(row)
        yield _least_batch(done)
    yield _least_batch(settle(group))


def _least_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["anchor", "mark", "s", "high", "least"])


def _written(lows: DataFrame, *used: DataFrame) -> DataFrame:
    """``lows`` as a table; the groups' words are not needed any more."""
    lows = materialise(lows, "repeats-decided")
    drop_tables(lows.sparkSession, *used)
    return lows


def _grouped(groups: DataFrame, by: str) -> DataFrame:
    return groups.repartition(by).sortWithinPartitions(by).mapInArrow(
        bounded(_subtrees), "anchor long, mark long, lows array<long>")


def cleaned(docs: DataFrame, key: str, text: str, length: str | None = None) -> DataFrame:
    """``docs`` with all columns, repeated words taken out of ``text``; ``length``, if named, is its new length."""
    columns = docs.columns
    (spans,) = fresh_names(columns, "spans")
    at, last = columns.index(text), len(columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t.as_py() if not s.is_valid else b" ".join(kept_words(t.as_py().encode(), s.as_py())[0]).decode()
                for t, s in zip(batch.column(at), batch.column(last))
            ]
            arrays = [pa.array(texts, batch.column(at).type) if i == at else batch.column(i) for i in range(last + 1)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    marked = with_spans(docs, key, text, spans)
    out = marked.mapInArrow(bounded(cut), marked.schema)
    if length:
        out = out.withColumn(length, F.when(F.col(spans).isNull(), F.col(length)).otherwise(F.length(text)))
    return out.select(*columns)
