"""Token counts by a byte-level merge tokenizer compiled to finite-state transducers.

The tokenizer file is compiled to two deterministic machines, and no text goes through the tokenizer library.

* The splitter reads classes of characters and marks where words begin, some marks one character late (an apostrophe
  may open a contraction; the last space of a run belongs to the next word). It has 13 states. A batch of texts is
  one sequence with an end mark after each text, cut into chunks of equal length. All chunks advance together,
  each from every state at once; that gives a map from entry to exit state per chunk. The maps are composed by
  a parallel prefix scan, which tells each chunk its entry state, and then the chunks are read once more for their marks.
* The counter reads bytes and its transitions carry the change of the number of tokens of the word read so far. Its
  states come from a nondeterministic machine: guess where the last token begins and follow the vocabulary's
  trie. A token may follow another where no merge crosses their border, and then a word has one valid last token at
  every byte; transitions name it, so a word's tokens are read off backwards. A deterministic state is the set of guesses still open, each with the token before it and its
  count relative to the valid one; states are made when first reached, and dropped when ``MAX_STATES`` is passed. At a
  word's start the state is known, so chunks are cut there, and any part of a text needs only its own bytes.

Classes of characters are found by probing the library's own splitter once per character on the driver, so its
version of Unicode counts; what goes to the tasks is a list of ranges. Strings of added tokens inside texts split a
text and count as one token each, as the library has it.

Defined results: NULL is empty and has no bytes and no tokens; rows are counted each for themselves, so NULL and repeated
ids stay as they are; texts of any length are read in parts of about ``PART`` characters, cut between words; an empty
table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 2**20  # characters read at a time
CHUNK = 256  # characters, or bytes, of one chunk
MAX_STATES = 40_000
MORE_STATES = 4096
SCHEMA = "id {id}, n_bytes long, n_tokens long"

# Classes of characters. SINGLE, R, E, V and LL are letters that matter after an apostrophe.
OTHER, LETTER, NUMBER, SPACE, BLANK, APOSTROPHE, SINGLE, R, E, V, LL, END = range(12)
_LETTERS = {LETTER, SINGLE, R, E, V, LL}
_AFTER_APOSTROPHE = {**dict.fromkeys("stmd", SINGLE), "r": R, "e": E, "v": V, "l": LL}

# States of the splitter: what the current word is so far.
FRESH, WORD, DIGITS, MARKS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK = range(12)
HERE, BEFORE = 1, 2  # a word begins at this character, at the one before
_FINISH = {QUOTE_R: E, QUOTE_V: E, QUOTE_L: LL}


def _step(state: int, kind: int) -> tuple[int, int]:
    """(next state, marks) of the splitter."""
    if kind == END:
        return FRESH, HERE | (BEFORE if state in _FINISH else 0)
    fresh = (
        WORD if kind in _LETTERS else
        {NUMBER: DIGITS, OTHER: MARKS, APOSTROPHE: QUOTE, SPACE: ONE_SPACE, BLANK: ONE_BLANK}[kind])
    if state in _FINISH:
        if kind == _FINISH[state]:
            return FRESH, 0
        return (WORD, BEFORE) if kind in _LETTERS else (fresh, BEFORE | HERE)
    if state == QUOTE and kind in (SINGLE, R, V, LL):
        return {SINGLE: FRESH, R: QUOTE_R, V: QUOTE_V, LL: QUOTE_L}[kind], 0
    if state in (ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK):
        if kind in (SPACE, BLANK):
            return (RUN_SPACE if kind == SPACE else RUN_BLANK), 0
        late = BEFORE if state in (RUN_SPACE, RUN_BLANK) else 0
        if state in (ONE_SPACE, RUN_SPACE):  # the space before a word belongs to it
            return (MARKS if kind == APOSTROPHE else fresh), late
        return fresh, late | HERE
    goes_on = (
        state == WORD and kind in _LETTERS or state == DIGITS and kind == NUMBER
        or state in (MARKS, QUOTE) and kind in (OTHER, APOSTROPHE))
    if goes_on:
        return (MARKS if state == QUOTE else state), 0
    return fresh, HERE


def _bare_step(state: int, kind: int) -> tuple[int, int]:
    """``_step`` where white space joins no word, and every digit and every blank is a word of its own."""
    fresh = WORD if kind in _LETTERS else {OTHER: MARKS, APOSTROPHE: QUOTE}.get(kind, FRESH)
    if state in _FINISH:
        if kind == _FINISH[state]:
            return FRESH, 0
        return fresh, BEFORE | (0 if kind in _LETTERS else HERE)
    if state == QUOTE and kind in (SINGLE, R, V, LL):
        return {SINGLE: FRESH, R: QUOTE_R, V: QUOTE_V, LL: QUOTE_L}[kind], 0
    if state == WORD and kind in _LETTERS or state in (MARKS, QUOTE) and kind in (OTHER, APOSTROPHE):
        return (MARKS if state == QUOTE else state), 0
    return fresh, HERE


_STATES, _KINDS = 12, 12


class Splitter:
    """The transitions of a splitter as tables."""

    def __init__(self, step: Callable[[int, int], tuple[int, int]]):
        edges = [step(s, k) for s in range(_STATES) for k in range(_KINDS)]
        self.next, self.marks = (np.array([e[i] for e in edges], np.uint8) for i in (0, 1))


SPACED, BARE = Splitter(_step), Splitter(_bare_step)


@lru_cache(maxsize=4)
def character_classes(path: str) -> tuple[tuple[int, int], ...]:
    """(first character, class) of each run of characters of one class, by what the library's splitter does with each."""
    from tokenizers import Tokenizer

    splitter = Tokenizer.from_file(path).pre_tokenizer
    runs: list[tuple[int, int]] = []
    for plane in (0, 1, 2, 3, 14):  # nothing is assigned to the planes between; private planes are OTHER
        points = [c for c in range(plane << 16, (plane + 1) << 16) if not 0xD800 <= c < 0xE000]
        starts = np.zeros(6 * len(points) + 1, bool)
        text = "".join(f"a{c}1{c}!\n" for c in map(chr, points))
        # Only where a word begins counts: c goes on after a letter, after a digit, before other marks, or nowhere.
        starts[[first for _, (first, _) in splitter.pre_tokenize_str(text)]] = True
        starts = starts[:-1].reshape(-1, 6)
        kinds = np.where(~starts[:, 1], LETTER, np.where(~starts[:, 3], NUMBER, np.where(starts[:, 4], BLANK, OTHER)))
        for point, kind in zip(points, kinds.tolist()):
            kind = {" ": SPACE, "'": APOSTROPHE}.get(chr(point), _AFTER_APOSTROPHE.get(chr(point), kind))
            if not runs or runs[-1][1] != kind:
                runs.append((point, kind))
        runs.append(((plane + 1) << 16, OTHER))
    return tuple(runs)


def class_table(runs: tuple[tuple[int, int], ...]) -> np.ndarray:
    """The class of every character, and of the end mark after the last."""
    table = np.zeros(0x110001, np.uint8)
    for (first, kind), (after, _) in zip(runs, [*runs[1:], (0x110000, OTHER)]):
        table[first:after] = kind
    table[0x110000] = END
    return table


def _lanes(symbols: np.ndarray) -> np.ndarray:
    """``symbols`` cut into chunks, one per column; the last is filled up with end marks."""
    chunks = max(1, -(-len(symbols) // CHUNK))
    full = np.full(chunks * CHUNK, END, np.uint8)
    full[:len(symbols)] = symbols
    return np.ascontiguousarray(full.reshape(chunks, CHUNK).T)


def chunk_maps(lanes: np.ndarray, splitter: Splitter = SPACED) -> np.ndarray:
    """For each chunk (column) the exit state of every entry state (row)."""
    states = np.repeat(np.arange(_STATES, dtype=np.uint8)[:, None], lanes.shape[1], axis=1)
    for at, row in enumerate(lanes, start=1):
        states = splitter.next[states.astype(np.intp) * _KINDS + row]
        # Two characters mostly settle the state whatever the entry; then one row stands for all.
        if len(states) > 1 and at & 3 == 0 and (states == states[0]).all():
            states = states[:1]
    return np.broadcast_to(states, (_STATES, lanes.shape[1]))


def entry_states(maps: np.ndarray) -> np.ndarray:
    """The state in which each chunk is entered: an exclusive prefix scan of ``maps`` under composition.

    Each round every map takes in the one ``far`` chunks before it, so the rounds grow with the logarithm of the chunks.
    """
    scanned, far = maps.copy(), 1
    while far < scanned.shape[1]:
        before, own = scanned[:, :-far], scanned[:, far:]
        scanned = np.concatenate([scanned[:, :far], np.take_along_axis(own, before, axis=0)], axis=1)
        far *= 2
    return np.concatenate([[np.uint8(FRESH)], scanned[FRESH, :-1]])


def word_starts(symbols: np.ndarray, splitter: Splitter = SPACED) -> np.ndarray:
    """Places where words begin, in order; end marks count as words."""
    lanes = _lanes(symbols)
    state = entry_states(chunk_maps(lanes, splitter))
    marks = np.empty(lanes.shape, np.uint8)
    for at, row in enumerate(lanes):
        edge = state.astype(np.intp) * _KINDS + row
        marks[at], state = splitter.marks[edge], splitter.next[edge]
    marks = marks.T.ravel()[:len(symbols)]
    here = (marks & HERE) > 0
    here[:-1] |= (marks[1:] & BEFORE) > 0
    return np.flatnonzero(here)


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as the characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


WORD_END = 0xFE  # in no UTF-8 text


class Merges:
    """A merge tokenizer: which tokens may stand next to each other. Tokens are numbered in the order of their bytes.

    Where the vocabulary marks the ends of words, ``WORD_END`` follows the last byte of a word, and joins it before any
    other merge.
    """

    def __init__(self, path: str, cached: int = 400):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        suffix, end = model.get("end_of_word_suffix") or "", bytes([WORD_END])

        def spelt(token: str) -> bytes:
            ends = suffix and token.endswith(suffix)
            return bytes(map(letters.__getitem__, token.removesuffix(suffix) if ends else token)) + (end if ends else b"")

        ids = {spelt(token): number for token, number in model["vocab"].items()}
        merges = [tuple(map(spelt, pair.split(" ") if isinstance(pair, str) else pair)) for pair in model["merges"]]
        if suffix:
            ids[end] = -1
            merges = [(bytes([b]), end) for b in range(256) if bytes([b, WORD_END]) in ids] + merges
        self.tokens = sorted(ids)
        self.ids = [ids[token] for token in self.tokens]
        self.sizes = np.array([len(token) for token in self.tokens])
        number = {token: i for i, token in enumerate(self.tokens)}
        self.cached = cached
        ranks: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token: its left part, right part and rank
        for rank, (left, right) in enumerate(merges):
            one, two, whole = number[left], number[right], number[left + right]
            ranks.setdefault((one, two), rank)
            self.made.setdefault(whole, (one, two, rank))
        self.last = len(merges)
        # For each left piece of a merge its right pieces with the ranks, and for each piece the tokens that began with
        # it while they were merged, with the rank that ended it.
        right = sorted((x, rank, y) for (x, y), rank in ranks.items())
        begins = sorted((y, until, t) for t in range(len(self.tokens)) for y, until in self._edge(t, 0))
        self.partner = np.array(right, np.int64).reshape(-1, 3).T.copy()
        self.begin = np.array(begins, np.int64).reshape(-1, 3).T.copy()
        pieces = np.arange(len(self.tokens) + 1)
        self.partner_at = np.searchsorted(self.partner[0], pieces)
        self.begin_at = np.searchsorted(self.begin[0], pieces)
        self._accepted: dict[int, bytes] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Each piece that was the token's first (side 0) or last (side 1) while it was merged, and the rank that ended it."""
        found, piece, until = [], token, self.last
        while True:
            found.append((piece, until))
            if piece not in self.made:
                return found
            until, piece = self.made[piece][2], self.made[piece][side]

    def accepted(self, before: int) -> bytes:
        """For each token 1 if no merge crosses the border from ``before`` to it, else 0; all 1 at a word's start (-1).

        A merge of lower rank comes first, and of equal ones the left. So a pair across the border is merged if its
        rank is lower than the one that ends its left piece, and at most the one that ends its right piece.
        """
        found = self._accepted.get(before)
        if found is None:
            open_ = np.ones(len(self.tokens), np.uint8)
            for x, until in self._edge(before, 1) if before >= 0 else ():
                first, end = self.partner_at[x], self.partner_at[x + 1]
                end = first + np.searchsorted(self.partner[1, first:end], until)
                ranks, pieces = self.partner[1:, first:end]
                low = self.begin_at[pieces]
                many = self.begin_at[pieces + 1] - low
                at = np.arange(int(many.sum())) + np.repeat(low - (np.cumsum(many) - many), many)
                open_[self.begin[2, at[self.begin[1, at] >= np.repeat(ranks, many)]]] = 0
            if len(self._accepted) >= self.cached:
                del self._accepted[next(iter(self._accepted))]
            found = self._accepted[before] = open_.tobytes()
        return found


class Counter:
    """The deterministic counter of a merge tokenizer, its states made when first reached."""

    END_BYTE = 0xFF  # in no UTF-8 text

    def __init__(self, merges: Merges, most: int = MAX_STATES):
        self.merges, self.most = merges, most
        # The trie. The tokens below a node are consecutive: those numbered from ``low`` to before ``high``.
        self.children: dict[int, int] = {}
        self.low, self.high, self.token_at = [0], [len(merges.tokens)], [-1]
        for token, data in enumerate(merges.tokens):
            node = 0
            for b in data:
                node = self.children.setdefault(node << 8 | b, len(self.low))
                if node == len(self.low):
                    self.low.append(token)
                    self.high.append(token)
                    self.token_at.append(-1)
                self.high[node] = token + 1
            self.token_at[node] = token
            self.low[node] = token + 1
        self.same: dict[bytes, int] = {}
        self.alike: dict[int, int] = {}
        self._clear()

    def _clear(self) -> None:
        # Transitions of all states in rows of 256, grown by a fixed number of states, since workers keep them.
        self.next = np.full(MORE_STATES * 256, -1, np.int32)
        self.change = np.zeros(MORE_STATES * 256, np.int16)
        self.last = np.zeros(MORE_STATES * 256, np.min_scalar_type(len(self.merges.tokens)))
        #: A state: the token before the guess that begins here, and the other open guesses, each (its count less the
        #: valid one's, trie node, which tokens below the node may follow the token before it).
        self.states: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self._state((-1,))
        self.next[self.END_BYTE] = 0

    def _state(self, state: tuple) -> int:
        number = self.known.get(state)
        if number is None:
            number = self.known[state] = len(self.states)
            self.states.append(state)
            if number * 256 >= len(self.next):
                more = MORE_STATES * 256
                self.next = np.concatenate([self.next, np.full(more, -1, np.int32)])
                self.change = np.concatenate([self.change, np.zeros(more, np.int16)])
                self.last = np.concatenate([self.last, np.zeros(more, self.last.dtype)])
        return number

    def _representative(self, token: int) -> int:
        """One token for all that accept the same followers."""
        found = self.alike.get(token)
        if found is None:
            mark = hashlib.blake2b(self.merges.accepted(token), digest_size=16).digest()
            found = self.alike[token] = self.same.setdefault(mark, token)
        return found

    def _make(self, edge: int) -> None:
        """The transition of state ``edge`` // 256 on byte ``edge`` % 256."""
        byte, open_, last, count = edge & 255, [], -1, 0
        before, *guesses = self.states[edge >> 8]
        low, high, token_at, child = self.low, self.high, self.token_at, self.children.get
        for less, parent, may in (*guesses, (0, 0, None)):
            node = child(parent << 8 | byte)
            if node is None:
                continue
            token, base = token_at[node], low[parent]
            if may is None:
                may, base = self.merges.accepted(before), 0
            if token >= 0 and may[token - base]:
                last, count = token, less + 1
            may = may[low[node] - base:high[node] - base]
            if b"\1" in may:  # some longer token may still turn out to be valid
                open_.append((less, node, may))
        if last < 0:
            raise ValueError("the vocabulary does not cover all bytes")
        guesses = ((less - count, node, may) for less, node, may in open_)
        number = self._state((self._representative(last), *guesses))
        self.next[edge], self.change[edge], self.last[edge] = number, count, last

    def changes(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each byte the change of the number of tokens; ``starts`` are the places where words begin, the first 0."""
        return self._read(data, starts, "change", np.int16)

    def token_ends(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token, place of its last byte) of all tokens in order; end marks have none."""
        last = self._read(data, starts, "last", np.int32)
        sizes = self.merges.sizes
        words = data[starts] != self.END_BYTE
        low, at = starts[words], np.append(starts[1:], len(data))[words] - 1
        ends = np.zeros(len(data), bool)
        while len(at):
            ends[at] = True
            at = at - sizes[last[at]]
            more = at >= low
            at, low = at[more], low[more]
        ends = np.flatnonzero(ends)
        return last[ends], ends

    def _read(self, data: np.ndarray, starts: np.ndarray, output: str, kind: type) -> np.ndarray:
        """What the transitions of all bytes carry."""
        out = np.zeros(len(data), kind)
        if not len(data):
            return out
        first = np.zeros(len(data), bool)
        first[starts] = True
        lanes = starts[np.unique(np.searchsorted(starts, np.arange(0, starts[-1] + 1, CHUNK)))]
        sizes = np.diff(np.append(lanes, len(data)))
        order = np.argsort(-sizes, kind="stable")  # long chunks first, so those still running are the first few
        place, sizes = lanes[order], sizes[order]
        running = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")
        state = np.zeros(len(place), np.int32)
        for step, lanes_left in enumerate(running.tolist()):
            at, state = place[:lanes_left] + step, state[:lanes_left]
            edge = (state * ~first[at]).astype(np.intp) * 256 + data[at]
            new = self.next[edge]
            if new.min() < 0:
                if len(self.states) > self.most:
                    edge = self._kept(edge)
                for missing in np.unique(edge[self.next[edge] < 0]).tolist():
                    self._make(missing)
                new = self.next[edge]
            out[at], state = getattr(self, output)[edge], new
        return out

    def _kept(self, edges: np.ndarray) -> np.ndarray:
        """Drop all states but those of ``edges``, which are renumbered."""
        states, of = np.unique(edges >> 8, return_inverse=True)
        kept = [self.states[s] for s in states.tolist()]
        self._clear()
        numbers = np.array([self._state(s) for s in kept], np.intp)
        return numbers[of] * 256 + (edges & 255)


class CompiledTokenizer:
    """Token counts, ids and ends of texts by the compiled machines."""

    #: Whatever comes before, a word begins at a space after an ASCII letter, and the word before it is complete.
    _CUT = re.compile(r"(?<=[A-Za-z]) ")

    def __init__(self, path: str, runs: tuple[tuple[int, int], ...]):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        splitter, model = whole["pre_tokenizer"] or {}, whole["model"]
        fits = (
            model["type"] == "BPE" and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space") and whole["normalizer"] is None
            and not model.get("dropout") and not model.get("ignore_merges"))
        if not fits:
            raise ValueError("only plain byte-level merge tokenizers can be compiled")
        added = whole["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        longest_first = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, longest_first))) if added else None
        self.classes = class_table(runs)
        self.counter = Counter(Merges(path))
        self.ids = np.array(self.counter.merges.ids, np.int64)

    def _segments(self, text: str, added: bool) -> tuple[list[str], int]:
        """Parts of a text that are read each for itself, and the number of added tokens between them."""
        parts = self.added.split(text) if added and self.added else [text]
        out = []
        for part in parts:
            while len(part) > PART:
                cut = self._CUT.search(part, PART)
                if not cut:
                    break
                out.append(part[:cut.start()])
                part = part[cut.start():]
            if part:
                out.append(part)
        return out, len(parts) - 1

    def _groups(self, texts: Iterable[str], added: bool) -> Iterator[tuple[list[str], list[int], list[int]]]:
        """Texts in groups of about ``PART`` characters: (parts, the text each is of, added tokens of each text)."""
        parts: list[str] = []
        owner: list[int] = []
        special: list[int] = []
        size = 0
        for text in texts:
            own, number = self._segments(text, added)
            parts += own
            owner += [len(special)] * len(own)
            special.append(number)
            size += len(text)
            if size >= PART:
                yield parts, owner, special
                parts, owner, special, size = [], [], [], 0
        yield parts, owner, special

    def _batches(self, parts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of parts, their bytes with end marks, places where words begin) of consecutive parts."""
        first = size = 0
        for last, part in enumerate(parts, start=1):
            size += len(part)
            if size < PART and last < len(parts):
                continue
            own = parts[first:last]
            points = np.frombuffer(b"".join(p.encode("utf-32-le") + b"\0\0\x11\0" for p in own), np.uint32)
            data = np.frombuffer(b"".join(p.encode() + b"\xff" for p in own), np.uint8)
            starts = word_starts(self.classes[points])
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            width[points == 0x110000] = 1
            yield last - first, data, (np.cumsum(width) - width)[starts]
            first, size = last, 0

    def counts(self, texts: Iterable[str]) -> Iterator[int]:
        """The number of tokens of each text; strings of added tokens count as one."""
        for parts, owner, totals in self._groups(texts, True):
            at = 0
            for many, data, starts in self._batches(parts):
                changes = self.counter.changes(data, starts)
                ends = np.flatnonzero(data == Counter.END_BYTE)
                sums = np.add.reduceat(changes, np.concatenate([[0], ends[:-1] + 1]), dtype=np.int64)
                for one, n in zip(owner[at:at + many], sums.tolist()):
                    totals[one] += n
                at += many
            yield from totals

    def encoded(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, byte offsets of their ends) of each text; strings of added tokens are ordinary text."""
        none = np.zeros(0, np.int64)
        for parts, owner, special in self._groups(texts, False):
            found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in special]
            lengths, at = [0] * len(special), 0
            for many, data, starts in self._batches(parts):
                tokens, places = self.counter.token_ends(data, starts)
                marks = np.flatnonzero(data == Counter.END_BYTE)
                first = np.concatenate([[0], marks[:-1] + 1])
                cut = np.searchsorted(places, np.concatenate([first, [len(data)]]))
                ids = self.ids[tokens]
                for k, one in enumerate(owner[at:at + many]):
                    own = slice(cut[k], cut[k + 1])
                    found[one].append((ids[own], places[own] + (1 - first[k] + lengths[one])))
                    lengths[one] += int(marks[k] - first[k])
                at += many
            for own in found:
                if len(own) == 1:
                    yield own[0]
                else:
                    yield np.concatenate([none, *(x for x, _ in own)]), np.concatenate([none, *(x for _, x in own)])


class CompiledWords:
    """Token ids of Latin texts by a tokenizer that lower-cases, drops white space and marks the ends of words."""

    # The settings that these machines are made for, and the characters whose lower case is one other
    # character and which never combine with their neighbours.
    NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    LATIN = re.compile("[\t\n\r\x20-\x7EÀ-ÖØ-öø-ÿ]*")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        first = (whole["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        fits = (
            whole["model"]["type"] == "BPE" and whole["model"].get("end_of_word_suffix") and not whole["model"].get("dropout")
            and (whole["normalizer"] or {}).get("normalizers") == self.NORMALIZERS
            and first.get("pattern") == {"Regex": self.PATTERN} and first.get("invert") and first.get("behavior") == "Removed")
        if not fits:
            raise ValueError("only tokenizers of lower-cased words with marked ends can be compiled")
        self.added = [t["content"] for t in whole["added_tokens"]]
        self.counter = Counter(Merges(path))
        self.ids = np.array(self.counter.merges.ids, np.int64)
        self.classes = np.full(0x110001, OTHER, np.uint8)
        for c in map(chr, range(256)):
            kind = LETTER if c.isalpha() else NUMBER if c.isdigit() else BLANK if c.isspace() else OTHER
            self.classes[ord(c)] = {"'": APOSTROPHE}.get(c, _AFTER_APOSTROPHE.get(c, kind))
        self.classes[0x110000] = END

    def reads(self, text: str) -> bool:
        """Whether the text can be read here."""
        return self.LATIN.fullmatch(text) is not None and not any(a in text for a in self.added)

    def encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; all must be readable."""
        if not texts:
            return
        lower = [t.lower() for t in texts]
        points = np.frombuffer(b"".join(t.encode("utf-32-le") + b"\0\0\x11\0" for t in lower), np.uint32)
        data = np.frombuffer(b"".join(t.encode() + b"\xff" for t in lower), np.uint8)
        kinds = self.classes[points]
        starts = word_starts(kinds, BARE)
        width = 1 + ((points >= 0x80) & (points < 0x110000)).astype(np.int64)
        first = (np.cumsum(width) - width)[starts]
        size = np.diff(np.append(first, len(data)))
        kept = kinds[starts] != BLANK
        ends = kinds[starts] == END
        text = (np.cumsum(ends) - ends)[kept & ~ends]
        words = np.repeat(kept & ~ends, size)
        size = size[kept & ~ends]
        # Every word is followed by its end mark, so each byte moves on by the number of words before its own.
        marked = np.full(int(size.sum()) + len(size), WORD_END, np.uint8)
        marked[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = data[words]
        begins = np.cumsum(size + 1) - size - 1
        tokens, places = self.counter.token_ends(marked, begins) if len(size) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        cut = np.append(begins, len(marked))[np.searchsorted(text, np.arange(len(texts) + 1))]
        cut = np.searchsorted(places, cut)
        ids = self.ids[tokens]
        for k in range(len(texts)):
            yield ids[cut[k]:cut[k + 1]]


@lru_cache(maxsize=1)
def compiled(path: str, runs: tuple[tuple[int, int], ...]) -> CompiledTokenizer:
    """One compiled tokenizer per process, which keeps its states from task to task."""
    return CompiledTokenizer(path, runs)


def token_counts(df: DataFrame, key: str, text: str, tokenizer_path: str) -> DataFrame:
    """(id, n_bytes, n_tokens) of each row: the bytes of its text in UTF-8 and the tokens without added ones around."""
    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    runs = character_classes(tokenizer_path)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(tokenizer_path, runs)
        for batch in batches:
            texts = batch.column(1)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n_tokens = pa.array(counter.counts(t.as_py() or "" for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n_tokens], names=["id", "n_bytes", "n_tokens"])

    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(counted, SCHEMA.format(id=kind))
