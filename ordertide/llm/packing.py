"""Vector bin packing of token sequences.

Examples take up three resources of a sequence at once: tokens, segments and loss-bearing tokens. Whole sequences
are cut from long examples; what remains waits in a pool of bounded size. A sequence is filled with the waiting
piece whose demand has the largest dot product with the room left, in shares of each limit; when no whole piece
fits, the longest is cut to fill the room, since examples may be cut anywhere. Each input task packs its own rows
in one pass, with no shuffle, so only its last sequences can stay short. Sequence ids hold the task's number; rows
read from files fall to the same tasks again when a task is repeated.

Defined results: NULL and empty texts are the end token alone; NULL ids are kept as NULL; repeated rows are packed
each for themselves; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import bounded
from ordertide.llm.transducer import CompiledWords

if TYPE_CHECKING:
    from tokenizers import Tokenizer

MAX_TOKENS = 2048
MAX_SEGMENTS = 256
POOL = 512
CACHED_WORDS = 100_000
BLOCK = 2**18  # characters encoded at a time
TASK_SHIFT = 40
_LETTERS_AND_MARKS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#$%&)]*)")
SCHEMA = "id {id}, start long, length long, ids binary, loss_tokens long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = MAX_TOKENS
    segments: int = MAX_SEGMENTS
    loss: int = MAX_TOKENS


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write each byte: printable ones as themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordTokenizer:
    """Token ids of texts by a public tokenizer whose words never reach across white space.

    Latin texts go through the compiled machines of ``transducer``. Others are cut at spaces and line breaks, and each
    distinct word is encoded once; the cache is dropped when full. There Latin letters, with or without marks after
    them, go to the merge model directly, since nothing in them is composed, and lower-casing is plain; all other
    words pass through the whole tokenizer. Whether the loaded tokenizer does treat texts so is tried on ``PROBES``; if not,
    the machines are not used, all words pass through the whole of it, and if words do reach across white space, so do
    whole texts.
    """

    LETTERS = _byte_letters()
    PROBES = (
        "the", "The", "ABc", "naïve", "Ünïcödé", "éÀÿ", "a.", "word,", "End).", "x!?", "Straße;", "çà*#$%&)", "it's", "I'LL", "'r", "x''t",
        "12ab3", "a1.5%", "@mail.com", "<b>", "Tie", "rendous",
    )

    def __init__(self, path: str):
        self.path, self.library = path, None
        self._clear()
        alone = [self._whole(word) for word in self.PROBES]
        together = " \n".join(self.PROBES)
        self.plain = True
        self.plain = all(self._encoded(word) == ids for word, ids in zip(self.PROBES, alone))
        self.by_word = self._whole(together) == [i for ids in alone for i in ids] and not self._whole(" \n ")
        self._clear()
        try:
            self.compiled = CompiledWords(path)
        except ValueError:
            self.compiled = None
        if self.compiled and [x.tolist() for x in self.compiled.encoded([*self.PROBES, together])] != [*alone, self._whole(together)]:
            self.compiled = None
        if self.compiled:
            self.library = None  # until a text needs it

    @property
    def tokenizer(self) -> Tokenizer:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return self.library

    def _clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.marks: dict[str, list[int]] = {}
        self.ids, self.starts = array("I"), array("q", [0, 0])

    def _whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _encoded(self, word: str) -> list[int]:
        match = _LETTERS_AND_MARKS.fullmatch(word) if self.plain else None
        if not match:
            return self._whole(word)
        letters, marks = match.groups()
        letters = letters.lower()
        if not letters.isascii():
            letters = "".join(map(self.LETTERS.__getitem__, letters.encode()))
        found = [t.id for t in self.tokenizer.model.tokenize(letters)]
        if marks:
            if marks not in self.marks:
                self.marks[marks] = self._whole(marks)
            found += self.marks[marks]
        return found

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text, as unsigned 32-bit numbers."""
        block: list[str] = []
        size = 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= BLOCK:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, texts: list[str]) -> Iterator[np.ndarray]:
        readable = [self.compiled is not None and self.compiled.reads(t) for t in texts]
        quick = self.compiled.encoded([t for t, r in zip(texts, readable) if r]) if self.compiled else iter(())
        for text, r in zip(texts, readable):
            yield next(quick).astype(np.uint32) if r else self._by_word(text) if self.by_word else np.array(self._whole(text), np.uint32)

    def _by_word(self, text: str) -> np.ndarray:
        parts = text.replace("\n", " ").split(" ")
        missing = set(parts).difference(self.known)
        if len(self.known) + len(missing) > CACHED_WORDS:
            self._clear()
            missing = set(parts) - {""}
        for word in missing:
            self.known[word] = len(self.known)
            self.ids.extend(self._encoded(word))
            self.starts.append(len(self.ids))
        return self._gathered(np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts)))

    def _gathered(self, at: np.ndarray) -> np.ndarray:
        starts = np.frombuffer(self.starts, np.int64)
        first = starts[at]
        size = starts[at + 1] - first
        before = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(first - before, size)
        return np.frombuffer(self.ids, np.uint32)[place] if len(place) else np.zeros(0, np.uint32)


@lru_cache(maxsize=1)
def loaded(path: str) -> WordTokenizer:
    """One tokenizer per process, which keeps its states and words from task to task."""
    return WordTokenizer(path)


@dataclass
class Piece:
    """Consecutive tokens of one example."""

    key: object
    start: int
    ids: np.ndarray
    loss: np.ndarray | None  # running count of loss-bearing tokens, None if all are
    whole: int

    def bearing(self, length: int) -> int:
        return length if self.loss is None else int(self.loss[self.start + length] - self.loss[self.start])

    def longest(self, tokens: int, loss: int) -> int:
        """How many of the first tokens fit both limits."""
        fits = min(tokens, len(self.ids))
        if self.loss is None:
            return min(fits, loss)
        reach = int(np.searchsorted(self.loss, self.loss[self.start] + loss, side="right")) - 1 - self.start
        return min(fits, reach)

    def cut(self, length: int) -> tuple[Piece, Piece | None]:
        head = Piece(self.key, self.start, self.ids[:length], self.loss, self.whole)
        if length == len(self.ids):
            return head, None
        return head, Piece(self.key, self.start + length, self.ids[length:], self.loss, self.whole)


@dataclass
class Packer:
    """Packs pieces into sequences numbered from ``number``."""

    limits: Limits
    number: int
    pool: list[Piece] = field(default_factory=list)

    def add(self, piece: Piece) -> Iterator[tuple[Piece, int, int]]:
        rest: Piece | None = piece
        while rest is not None and len(rest.ids) >= self.limits.tokens and rest.bearing(self.limits.tokens) <= self.limits.loss:
            head, rest = rest.cut(self.limits.tokens)
            yield head, self.number, 0
            self.number += 1
        if rest is not None:
            self.pool.append(rest)
            if len(self.pool) >= POOL:
                yield from self.empty(POOL // 2)

    def empty(self, down_to: int) -> Iterator[tuple[Piece, int, int]]:
        """Fill sequences until at most ``down_to`` pieces wait."""
        limits = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        need = np.array([[len(p.ids), 1, p.bearing(len(p.ids))] for p in self.pool], float).reshape(-1, 3)
        share = need / limits
        left = len(self.pool)
        while left > down_to:
            room, offset = limits.copy(), 0
            while left and room[0] > 0 and room[1] > 0 and (room[2] > 0 or (need[:, 2] == 0).any()):
                fits = np.flatnonzero((need <= room).all(axis=1))
                if len(fits):
                    at = int(fits[(share[fits] @ (room / limits)).argmax()])
                    head, rest = self.pool[at], None
                else:
                    at = int(np.where(np.isinf(need[:, 0]), -1.0, need[:, 0]).argmax())
                    length = self.pool[at].longest(int(room[0]), int(room[2]))
                    if length == 0:
                        break
                    head, rest = self.pool[at].cut(length)
                yield head, self.number, offset
                offset += len(head.ids)
                room -= [len(head.ids), 1, head.bearing(len(head.ids))]
                if rest is None:
                    need[at] = np.inf  # placed: it fits nowhere any more
                    left -= 1
                else:
                    self.pool[at] = rest
                    need[at] = [len(rest.ids), 1, rest.bearing(len(rest.ids))]
                    share[at] = need[at] / limits
            self.number += 1
        self.pool = [p for p, n in zip(self.pool, need[:, 0]) if n < np.inf]


def pack(
    df: DataFrame, key: str, text: str, tokenizer_path: str, end_id: int, limits: Limits = Limits(), prompt: str | None = None,
) -> DataFrame:
    """Pieces of all rows: (id, start, length, ids, loss_tokens, doc_tokens, sequence_id, offset).

    ``ids`` are the tokens as little-endian unsigned 32-bit numbers. A row's tokens are those of ``prompt``, if that
    column is named, which bear no loss, then those of ``text`` and ``end_id``, which do.
    """
    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    columns = [F.col(key).alias("id"), F.col(text).alias("text")]
    columns += [F.col(prompt).alias("prompt")] if prompt else []
    schema = SCHEMA.format(id=kind)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(tokenizer_path)
        packer = Packer(limits, TaskContext.get().partitionId() << TASK_SHIFT)
        end = np.array([end_id], np.uint32)
        id_type = None
        out: list[tuple[Piece, int, int]] = []
        size = 0
        for batch in batches:
            id_type = batch.column(0).type
            texts = (t.as_py() or "" for t in batch.column(1))
            prompts = tokenizer.encode(t.as_py() or "" for t in batch.column(2)) if prompt else None
            for one, ids in zip(batch.column(0).to_pylist(), tokenizer.encode(texts)):
                ids, loss = np.concatenate([ids, end]), None
                if prompts is not None:
                    before = next(prompts)
                    bears = np.concatenate([np.zeros(len(before), np.int64), np.ones(len(ids), np.int64)])
                    ids, loss = np.concatenate([before, ids]), np.concatenate([[0], np.cumsum(bears)])
                for row in packer.add(Piece(one, 0, ids, loss, len(ids))):
                    out.append(row)
                    size += len(row[0].ids)
                if size > 2**20:
                    yield _batch(out, id_type)
                    out, size = [], 0
        out += packer.empty(0)
        if out:
            yield _batch(out, id_type)

    return df.select(*columns).mapInArrow(bounded(packed), schema)


def _batch(rows: list[tuple[Piece, int, int]], id_type: pa.DataType) -> pa.RecordBatch:
    pieces = [p for p, _, _ in rows]
    longs = lambda values: pa.array(values, pa.int64())
    lengths = [len(p.ids) for p in pieces]
    return pa.RecordBatch.from_arrays([
        pa.array([p.key for p in pieces], id_type), longs([p.start for p in pieces]), longs(lengths),
        pa.array([p.ids.astype("<u4").tobytes() for p in pieces], pa.binary()),
        longs([p.bearing(n) for p, n in zip(pieces, lengths)]), longs([p.whole for p in pieces]),
        longs([n for _, n, _ in rows]), longs([o for _, _, o in rows]),
    ], names=["id", "start", "length", "ids", "loss_tokens", "doc_tokens", "sequence_id", "offset"])
