"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of consecutive item words; an item of fewer words is one pattern. Patterns of one length share
a table set. Reading a text, the block of two words that ends the current position is looked up in the shift table:
most blocks are in no pattern and skip nearly a whole pattern's length. Where the shift is 0, the hash of the block
selects a bucket of patterns, and these are compared word by word.

The items are cut into blocks of bounded bytes, and each block of patterns is searched in all texts, with the marks
so far carried along; a benchmark of any size takes more passes, not more memory.

Defined results: NULL and empty texts have no words and no hits; items without words match nothing; repeated items
and repeated windows count once per item id; repeated documents are judged each for themselves; NULL item ids count
as no item but their words are still hit. Empty tables give no rows, or no hits. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm.common import bounded, drop_tables, materialise
from ordertide.llm.words import plain_words

WINDOW = 10
BLOCK_BYTES = 2 * 2**20  # about 200 MB of tables in a task
#: Which words are hit, as pairs of first word and end, and the items found.
MARKS = "id {id}, text binary, n_words long, spans array<int>, items array<string>"


class PatternTable:
    """Shift table and suffix buckets of patterns that have one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.skip = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[tuple[bytes, ...], tuple[str | None, ...]]] = {}

    def add(self, pattern: tuple[bytes, ...], item: str | None) -> None:
        bucket = self.buckets.setdefault(b" ".join(pattern[-self.block:]), {})
        known = bucket.get(pattern, ())
        if not known:
            for end in range(self.block, self.length + 1):
                block = b" ".join(pattern[end - self.block:end])
                self.shift[block] = min(self.shift.get(block, self.skip), self.length - end)
        if item not in known:
            bucket[pattern] = (*known, item)

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, tuple[str | None, ...]]]:
        """(first word, items) of each pattern found."""
        shift, skip, length = self.shift.get, self.skip, self.length
        two = self.block == 2
        end, last = length, len(words)
        while end <= last:
            block = words[end - 2] + b" " + words[end - 1] if two else words[end - 1]
            far = shift(block, skip)
            if far:
                end += far
                continue
            window = words[end - length:end]
            for pattern, items in self.buckets[block].items():
                if pattern[0] == window[0] and pattern == tuple(window):
                    yield end - length, items
            end += 1


def pattern_tables(items: list[tuple[str | None, bytes | None]], window: int) -> list[PatternTable]:
    """One table per pattern length."""
    tables: dict[int, PatternTable] = {}
    for item, text in items:
        words = plain_words(text)
        length = min(window, len(words))
        for at in range(len(words) - length + 1 if words else 0):
            tables.setdefault(length, PatternTable(length)).add(tuple(words[at:at + length]), item)
    return list(tables.values())


def item_blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[str | None, bytes | None]]]:
    """The items in lists of about ``block_bytes`` bytes of text."""
    block: list[tuple[str | None, bytes | None]] = []
    size = 0
    rows = items.select(F.col(key).cast("string").alias("k"), F.col(text).cast("binary").alias("t"))
    for row in rows.toLocalIterator():
        block.append((row["k"], bytes(row["t"]) if row["t"] is not None else None))
        size += len(row["t"] or b"")
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def merged(spans: list[int]) -> list[int]:
    """The spans (first, end, first, end, ...) in order, with those that touch joined."""
    out: list[int] = []
    for first, end in sorted(zip(spans[::2], spans[1::2])):
        if out and first <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [first, end]
    return out


def _search(marked: DataFrame, patterns: list[PatternTable], schema: str, keep_text: bool) -> DataFrame:
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, all_spans, all_items = [], [], []
            for text, spans, items in zip(*(batch.column(i) for i in (1, 3, 4))):
                words = plain_words(text.as_py())
                spans, items = spans.as_py(), set(items.as_py())
                for table in patterns:
                    for first, found in table.occurrences(words):
                        # Runs of overlapping windows are kept as one span.
                        if spans and spans[-2] <= first <= spans[-1]:
                            spans[-1] = max(spans[-1], first + table.length)
                        else:
                            spans += [first, first + table.length]
                        items.update(x for x in found if x is not None)
                n_words.append(len(words))
                all_spans.append(merged(spans))
                all_items.append(sorted(items))
            text = batch.column(1) if keep_text else pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), text, pa.array(n_words, pa.int64()), pa.array(all_spans, pa.list_(pa.int32())),
                pa.array(all_items, pa.list_(pa.string())),
            ], names=["id", "text", "n_words", "spans", "items"])

    return marked.mapInArrow(bounded(searched), schema)


def contamination(
    docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n_words, spans, items) of each document: words hit, as (first, end) pairs, and items found, sorted."""
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    schema = MARKS.format(id=kind)
    marked = docs.select(
        F.col(key).alias("id"), F.col(text).cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<int>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"))
    waiting, last = None, None
    for block in item_blocks(items, item_key, item_text, block_bytes):
        if waiting is not None:
            marked = materialise(_search(marked, waiting, schema, True), "decontaminate")
            if last is not None:
                drop_tables(docs.sparkSession, last)
            last = marked
        waiting = pattern_tables(block, window)
    return _search(marked, waiting or [], schema, False).drop("text")


def clean_rows(docs: DataFrame, items: DataFrame, item_key: str, item_text: str, text: str = "text",
               window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item window occurs."""
    out, waiting, last = docs, None, None
    for block in item_blocks(items, item_key, item_text, block_bytes):
        if waiting is not None:
            out = materialise(_without(out, waiting, text), "decontaminate")
            if last is not None:
                drop_tables(docs.sparkSession, last)
            last = out
        waiting = pattern_tables(block, window)
    return out if waiting is None else _without(out, waiting, text)


def _without(docs: DataFrame, patterns: list[PatternTable], text: str) -> DataFrame:
    at = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch.column(at).cast(pa.binary()))
            keep = [not any(True for p in patterns for _ in p.occurrences(plain_words(t))) for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(bounded(clean), docs.schema)
