"""Near-duplicate documents by Order MinHash, verified by banded alignment of their words.

A text's shingles of five words are each labelled with their occurrence number, so repeats count. Each of ``SKETCHES`` hash
orders picks the ``PER_SKETCH`` smallest labelled shingles and keeps them in text order; the sketch is the hash of
that sequence. Texts that share a sketch have the same shingles in the same order there, which makes the sketch
sensitive to edit similarity. With r the share of all their shingles that two texts have in common and in order, they
share one of 40 sketches of three with probability 1 - (1 - r**3)**40. Texts at the threshold whose edits lie far apart
have r near 0.4, which is found in 93 of 100 cases, and r of 0.5 in 99.5 of 100.

Texts of at most ``EXACT`` words have no sketches, as an edit takes a large part of their shingles, but are all found by a
prefix filter: of their rarest labelled words so many are paired that two texts at the threshold share a pair.

Candidates are verified by aligning their words: with m words matched in order, the similarity is m / (a + b - m), and
it must be ``THRESHOLD`` or more. The threshold bounds how far an alignment can leave the diagonal, so only a band around it
is searched; pairs that have too few words in common in any order are not aligned.

Equal texts (equal word sequences) are one class from the start, and only one of them takes part. Candidates are
found per sketch value without listing pairs: round by round, each text is compared with one centre, the smallest
text of another component that it shares a sketch with and has not met. Pairs inside one component need no
comparison. Rounds go on while they find links; what is left shares sketches but is not similar to the centres it met:

* Where at most ``FEW`` texts share a sketch, all their pairs between different components are compared.
* Where more do, they mostly have one passage in common. Of these texts every pair is compared that can be similar, by exact
  filters, so no similar pair is left out: lengths, and counts of words by bucket, compared block by block without
  making rows of pairs. Where such texts are many, those go first that share too few runs of ``RUN`` words (of single words for
  short texts) with all others.

Components are found by hooking and pointer jumping. Only texts that share a sketch are moved, compressed.

Defined results: empty texts have no words and are equal to each other and to NULL; texts of fewer than five words
are only similar to their copies; rows without an id are in no class, and stay when filtering; different texts under
one id are of one class; the class is its smallest id. Empty tables give no rows. Only id and text are read;
filtering keeps all columns. Texts of any length are sketched and aligned whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import bounded, drop_tables, fresh_names, materialise
from ordertide.llm.words import spaced_words

SHINGLE = 5
THRESHOLD = 0.8
SKETCHES = 40
PER_SKETCH = 3
EXACT = 50  # words
LISTED = int(EXACT / THRESHOLD + 1e-9)  # no longer text reaches the threshold with one of EXACT words
FEW = 24
RUN = 3  # words; texts of more than EXACT words at the threshold share many such runs
COARSE = 32  # buckets of the outlines that are compared first
BLOCK_ROWS, BLOCK_BYTES = 2048, 2**21  # of outlines that are compared at once
DIRECT = 8 * BLOCK_ROWS  # so many texts are sooner compared than listed by their runs
WORTHWHILE = 0.05  # of a round's comparisons must find a link, or the rounds end
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHasher:
    """64-bit hashes of words, the same in every process, with a bounded cache."""

    def __init__(self, most: int = 100_000):
        self.most, self.known = most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        missing = [w for w in set(words) if w not in known]
        if missing:
            if len(known) + len(missing) > self.most:
                known.clear()
                missing = list(set(words))
            for w in missing:
                known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all windows of ``size`` words in text order; a shorter text is one window."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = _mixed(out * _MIX + hashes[i:len(hashes) - size + 1 + i] + np.uint64(1))
    return out


def labelled(values: np.ndarray) -> np.ndarray:
    """``values`` with the occurrence number mixed in, so each is distinct within its text."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(values) else np.zeros(0, int)
    number = np.empty(len(values), np.uint64)
    number[order] = np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))
    with np.errstate(over="ignore"):
        return np.where(number == 0, values, _mixed(values + number * _MIX))


def sketches(own: np.ndarray, tag: int = 0) -> np.ndarray:
    """One hash for each hash order: of the smallest of the distinct values ``own``, in their order.

    Only values below a bound that leaves a dozen of each order are sorted, or all where it leaves too few.
    """
    take, n = min(PER_SKETCH, len(own)), len(own)
    out = np.empty(SKETCHES, np.uint64)
    together = max(1, 2**18 // n)  # long texts take few orders at a time
    limit = np.uint64(min(12 / n, 1) * (2**64 - 2**12))
    with np.errstate(over="ignore"):
        for start in range(0, SKETCHES, together):
            numbers = np.arange(start, min(start + together, SKETCHES), dtype=np.uint64)
            under = own * (_mixed(numbers + _MIX) | np.uint64(1))[:, None]
            under ^= under >> np.uint64(32)
            row, place = np.nonzero(under <= limit)
            many = np.bincount(row, minlength=len(numbers))
            order = np.lexsort((under[row, place], row))
            first = np.cumsum(many) - many
            at = np.empty((len(numbers), take), np.int64)
            enough = many >= take
            at[enough] = place[order[first[enough][:, None] + np.arange(take)]]
            for r in np.flatnonzero(~enough).tolist():
                at[r] = np.argpartition(under[r], take - 1)[:take]
            at.sort(axis=1)
            value = numbers + np.uint64(tag)
            for column in own[at].T:
                value = _mixed(value * _MIX + column)
            out[start:start + len(numbers)] = value
    return out


def _bits(at: np.ndarray, width: int) -> int:
    """The number whose bits ``at`` are set."""
    if len(at) < 8:
        return sum(1 << x for x in at.tolist())
    flags = np.zeros(width, bool)
    flags[at] = True
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def matched_in_order(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The longest common subsequence of two sequences, at least as far as it lies within ``band`` of the diagonal.

    Where few pairs of places in the band are equal, the longest rising chain of them is taken (Hunt and Szymanski);
    where a passage is repeated so often that these pairs are many, whole rows are advanced as bits (Hyyrö).
    """
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    # Places of b by value and then in order, so that the equal places near one place of a are a slice.
    places = np.argsort(b, kind="stable")
    values, rank = np.unique(b, return_inverse=True)
    row = np.searchsorted(values, a)
    row = np.where(row < len(values), row, 0)
    here = np.flatnonzero(values[row] == a)
    row, step = row[here], len(b) + 1
    keys = rank[places] * step + places
    low = np.searchsorted(keys, row * step + np.clip(here - band, 0, len(b)))
    high = np.searchsorted(keys, row * step + np.clip(here + band + 1, 0, len(b)))
    if (high - low).sum() > 4 * (len(a) + len(b)):
        return head + tail + _matched_by_bits(here, row, places, keys, step, band)
    ends: list[int] = []
    for first, end in zip(low.tolist(), high.tolist()):
        for x in places[first:end][::-1].tolist():  # backwards, so that one place of a is used once
            i = bisect_left(ends, x)
            ends[i:i + 1] = [x]
    return head + tail + len(ends)


def _matched_by_bits(here: np.ndarray, row: np.ndarray, places: np.ndarray, keys: np.ndarray, step: int, band: int) -> int:
    """``matched_in_order`` for places ``here`` of one text, with ranks ``row`` among the other text's values.

    A bit of ``state`` is cleared for each place of the other text at which the matched length grows. A block of
    places is taken at a time, and only the places in its band are looked at.
    """
    last = step - 1
    state, block = (1 << last) - 1, max(64, min(1024, 2**30 // (2 * band + 1)))
    for start in range(0, len(here), block):
        own, ranks = here[start:start + block], row[start:start + block]
        left, right = max(0, int(own[0]) - band), min(last, int(own[-1]) + band + 1)
        if left >= right:
            continue
        width, masks = right - left, {}
        full = (1 << width) - 1
        part = (state >> left) & full
        for r in ranks.tolist():
            if r not in masks:
                first, end = np.searchsorted(keys, (r * step + left, r * step + right))
                masks[r] = _bits(places[first:end] - left, width)
            both = part & masks[r]
            part = ((part + both) | (part - both)) & full
        state ^= (((state >> left) & full) ^ part) << left
    return last - state.bit_count()


def in_common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sequences have in common, in any order, repeats counted."""
    one, times = np.unique(a, return_counts=True)
    two, more = np.unique(b, return_counts=True)
    at = np.searchsorted(two, one)
    at[at == len(two)] = 0
    same = two[at] == one
    return int(np.minimum(times[same], more[at[same]]).sum())


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Aligned share of two sequences, exact wherever it reaches ``threshold``; otherwise it may be lower."""
    if not len(a) and not len(b):
        return 1.0
    need = threshold / (1 + threshold) * (len(a) + len(b))
    if min(len(a), len(b)) < need - 1e-9 or in_common(a, b) < need - 1e-9:
        return 0.0
    # At most this many values of either sequence stay unmatched, so no match lies further off the diagonal.
    band = int(max(len(a), len(b)) - need + 1e-9)
    m = matched_in_order(a, b, band)
    return m / (len(a) + len(b) - m)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, hash of all words, sketches, labelled words).

    Texts of at most ``EXACT`` words have no sketches, and texts of more than ``LISTED`` no list of words.
    """
    hasher = WordHasher()
    for batch in batches:
        marks, digests, lists = [], [], []
        for text in batch.column(1):
            words = spaced_words(text.as_py())
            digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
            values = hasher(words)
            marks.append(sketches(labelled(shingles(values))).view(np.int64) if len(values) > EXACT else [])
            lists.append(labelled(values).view(np.int64) if len(values) <= LISTED else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), *[pa.array(x, pa.list_(pa.int64())) for x in (marks, lists)]],
            names=["id", "digest", "sketches", "words"])


def _prefixes(short: DataFrame) -> DataFrame:
    """(id, mark) for texts (id, digest, words): pairs of the rarest words of each, of which similar texts share one.

    Two similar texts have at least 0.8 * n of the n words of either in common, so in any order of all words they share
    two of the first n - that + 2. Words of one text only come first and are in no pair.
    """
    texts = short.dropDuplicates(["id", "digest"])
    lists = texts.select("id", "digest", F.size("words").alias("n"), F.explode("words").alias("word"))
    counts = lists.groupBy("word").agg(F.count("*").alias("texts")).where("texts > 1")
    several = lists.join(counts, "word").groupBy("id", "digest", "n").agg(
        F.sort_array(F.collect_list(F.struct("texts", "word"))).alias("rarest"))
    prefix = F.col("n") - F.ceil(F.col("n") * THRESHOLD - 1e-9) + 2
    left = (prefix - (F.col("n") - F.size("rarest"))).cast("int")
    first = several.where(left > 1).select("id", F.slice("rarest", 1, left).alias("r"))
    pairs = F.flatten(F.transform("r", lambda x, i: F.transform(
        F.slice("r", i + 2, F.size("r")), lambda y: F.xxhash64(F.least(x["word"], y["word"]), F.greatest(x["word"], y["word"])))))
    return first.select("id", F.explode(pairs).alias("mark"))


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, compressed text), to move less."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        small = [press.compress(t.as_py() or b"") for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary())], names=["id", "packed"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, packed_a, packed_b) to (a, b) of pairs that reach the threshold."""
    import zstandard

    hasher, unpress = WordHasher(), zstandard.ZstdDecompressor()
    last = (b"", hasher([]))

    def sequence(packed: bytes) -> np.ndarray:
        return hasher(spaced_words(unpress.decompress(packed)))

    for batch in batches:
        keep = []
        for one, two in zip(batch.column(2), batch.column(3)):
            one = one.as_py()
            if one != last[0]:  # pairs of one centre often come together
                last = (one, sequence(one))
            keep.append(similarity(last[1], sequence(two.as_py())) >= THRESHOLD)
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def components(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, class): each member with the smallest member it is linked to, over any number of ``links`` (a, b).

    Each round a root hooks to the smallest root next to it, then everybody jumps to the root's root. Rounds
    grow with the logarithm of the longest chain of links. Members without links are their own class. The result is a
    table of its own in the shared folder.
    """
    spark = links.sparkSession
    edges = materialise(links.where("a <> b").distinct(), "links")
    touched = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    label = materialise(touched.select("id", F.col("id").alias("class")), "labels")
    while not edges.isEmpty():
        # Edges now run between roots. Every root takes its smallest neighbour if that is smaller than itself.
        both = edges.union(edges.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("root")).agg(F.least(F.min("b"), F.first("a")).alias("to"))
        hook = table = materialise(hook, "hooks")
        moved = True
        while moved:
            far = hook.select(F.col("root").alias("to"), F.col("to").alias("far"))
            jumped = hook.join(far, "to", "left").select("root", "to", F.coalesce("far", "to").alias("far"))
            jumped = materialise(jumped, "hooks")
            drop_tables(spark, table)
            moved = not jumped.where("far <> to").isEmpty()
            hook, table = jumped.select("root", F.col("far").alias("to")), jumped
        up = hook.select(F.col("root").alias("class"), "to")
        before = label
        label = materialise(label.join(up, "class", "left").select("id", F.coalesce("to", "class").alias("class")), "labels")
        left = edges.join(hook.select(F.col("root").alias("a"), F.col("to").alias("ra")), "a", "left").join(
            hook.select(F.col("root").alias("b"), F.col("to").alias("rb")), "b", "left")
        left = left.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b")
        left = materialise(left.distinct(), "links")
        drop_tables(spark, table, before, edges)
        edges = left
    out = materialise(members.select("id").join(label, "id", "left").select("id", F.coalesce("class", "id").alias("class")), "classes")
    drop_tables(spark, edges, label)
    return out


def classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, class, links) of each id: its class, and the number of links to other texts found for its own text.

    Links within a component are not sought once it is joined, so ``links`` is at least 1 for each text that has a
    similar one, and not the count of all. Ids must be whole numbers.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text")).where("id IS NOT NULL")
    seen = materialise(rows.mapInArrow(bounded(_sketched), "id long, digest binary, sketches array<long>, words array<long>"), "near-sketches")
    equal = seen.groupBy("digest").agg(F.min("id").alias("own"))
    copies = seen.select("id", "digest").join(equal, "digest").select("id", "own").distinct()
    copies = materialise(copies, "near-copies")
    # Different texts under one id are linked through it.
    first = copies.groupBy("id").agg(F.min("own").alias("a"), F.max("own").alias("b")).where("a < b").select("id", "a")
    shared = copies.join(first, "id").select("a", F.col("own").alias("b")).where("a < b").distinct()
    alone = copies.where("id = own").select("id").distinct()
    marks = seen.select("id", "sketches").join(alone, "id").select("id", F.explode("sketches").alias("mark"))
    short = seen.where(F.size("words") > 0).select("id", "digest", "words").join(alone, "id")
    every = marks.unionByName(_prefixes(short))
    common = every.groupBy("mark").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    marks = materialise(every.join(common.select("mark"), "mark").distinct(), "near-marks")
    candidates = materialise(marks.select("id").union(shared.select("a")).union(shared.select("b")).distinct(), "near-candidates")
    known = rows.mapInArrow(bounded(_squeezed), "id long, packed binary").join(candidates, "id").dropDuplicates(["id", "packed"])
    known = materialise(known, "near-texts")
    label, links = _joined(marks, candidates, shared, known)
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    degree = ends.groupBy(F.col("a").alias("own")).agg(F.count("*").alias("links"))
    out = copies.join(label.withColumnRenamed("id", "own"), "own", "left").join(degree, "own", "left")
    out = materialise(out.groupBy("id").agg(
        F.min(F.coalesce("class", "own")).alias("class"), F.max(F.coalesce("links", F.lit(0))).cast("long").alias("links"),
    ), "near-classes")
    drop_tables(docs.sparkSession, seen, copies, marks, candidates, known, label, links)
    return out


def _joined(marks: DataFrame, candidates: DataFrame, shared: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components of the candidates, and the links that made them."""
    spark = marks.sparkSession
    links, met = materialise(shared, "near-links"), None
    label = components(candidates, links)
    while True:
        placed = _between(marks, label)
        pairs = _star(placed, met)
        pairs, found = _compared(pairs, known)
        met = pairs if met is None else met.unionByName(pairs)
        compared, linked = pairs.count(), found.count()
        if linked:
            links, label = _merged(candidates, links, label, found)
        else:
            drop_tables(spark, found)
        drop_tables(spark, placed)
        if linked <= WORTHWHILE * compared:
            break
    placed = _between(marks, label)
    counts = placed.groupBy("mark").agg(F.count("*").alias("texts"))
    few = placed.join(counts.where(F.col("texts") <= FEW).select("mark"), "mark")
    many = materialise(placed.join(counts.where(F.col("texts") > FEW).select("mark"), "mark").select("id").distinct(), "near-many")
    rest = _rest(many, known, label, met)
    pairs, found = _compared(_all_between(few.select("id", "mark", "class"), met).unionByName(rest).distinct(), known)
    links, label = _merged(candidates, links, label, found)
    drop_tables(spark, pairs, placed, many, rest, met)
    return label, links


def _between(marks: DataFrame, label: DataFrame) -> DataFrame:
    """(id, mark, class) of the marks that are still shared by different components, as a table."""
    placed = marks.join(label, "id")
    several = placed.groupBy("mark").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    return materialise(placed.join(several.select("mark"), "mark").select("id", "mark", "class"), "near-placed")


def _compared(pairs: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b), and those that are similar, as tables."""
    pairs = materialise(pairs, "near-pairs")
    one = known.select(F.col("id").alias("a"), F.col("packed").alias("packed_a"))
    two = known.select(F.col("id").alias("b"), F.col("packed").alias("packed_b"))
    full = pairs.join(two, "b").join(one, "a").select("a", "b", "packed_a", "packed_b")
    return pairs, materialise(full.mapInArrow(bounded(_verified), "a long, b long"), "near-found")


def _merged(candidates: DataFrame, links: DataFrame, label: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links with ``found`` among them, and the components they make."""
    more = materialise(links.unionByName(found), "near-links")
    classes = components(candidates, more)
    drop_tables(links.sparkSession, links, label, found)
    return more, classes


def _star(placed: DataFrame, met: DataFrame | None) -> DataFrame:
    """For each text the smallest centre, of the marks it is in, that is in another component and not yet met.

    The centre of a mark is the smallest text of its smallest component.
    """
    centre = placed.groupBy("mark").agg(F.min(F.struct("class", "id")).alias("c"))
    pairs = placed.join(centre, "mark").where("class <> c.class").select(
        F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b"), F.col("id").alias("of"))
    if met is not None:
        pairs = pairs.join(met, ["a", "b"], "left_anti")
    return pairs.groupBy("of").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b").distinct()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, packed text) to (id, text, size, words, shingle) rows, a row per labelled run of ``size`` words.

    ``text`` tells texts under one id apart, and ``words`` is how many they have.
    """
    import zstandard

    hasher, unpress = WordHasher(), zstandard.ZstdDecompressor()
    for batch in batches:
        for one, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = spaced_words(unpress.decompress(packed.as_py()))
            hashes, many = hasher(words), len(words)
            text = int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)
            for size in ([1] if 0 < many <= LISTED else []) + ([RUN] if many > EXACT else []):
                values = labelled(shingles(hashes, size)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), x, kind)) for x, kind in ((one, np.int64), (text, np.int64), (size, np.int32), (many, np.int32))]
                    + [pa.array(values)], names=["id", "text", "size", "words", "shingle"])


def _at_least(words: Column) -> Column:
    """How many runs of ``size`` words a text of so many words has in common with any similar one.

    With m words matched, an unmatched word of one text breaks at most ``size`` of its runs, and an unmatched word of the
    other at most ``size - 1``. So (2 * size - 1) * m - (size - 1) * (a + b + 1) runs are left.
    """
    size = F.col("size")
    return F.greatest(F.lit(1), F.ceil(words * (size * F.lit(THRESHOLD) - (size - 1)) - (size - 1) - 1e-6))


def _outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, packed text) to (id, text, words, outline): how many words fall into each of a power of two of buckets, a byte each.

    More than 255 words of a bucket are written as 255, which brings two outlines nearer to each other and never apart.
    """
    import zstandard

    hasher, unpress = WordHasher(), zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for one, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = spaced_words(unpress.decompress(packed.as_py()))
            text = int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)
            buckets = 1 << min(max(len(words).bit_length() - 1, COARSE.bit_length() - 1), 12)
            own = (hasher(words) & np.uint64(buckets - 1)).astype(np.int64)
            rows.append((one, text, len(words), np.minimum(np.bincount(own, minlength=buckets), 255).astype(np.uint8).tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names=["id", "text", "words", "outline"])


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, class, words, outline) with the number of the block each row is in; a block has bounded rows and bytes."""
    from pyspark import TaskContext

    block, rows, size = TaskContext.get().partitionId() << 33, 0, 0
    for batch in batches:
        numbers = []
        for outline in batch.column(4):
            if rows == BLOCK_ROWS or size >= BLOCK_BYTES:
                block, rows, size = block + 1, 0, 0
            rows, size = rows + 1, size + len(outline.as_buffer())
            numbers.append(block)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "block"])


class _Block:
    """Outlines of a block, by their number of buckets and then by words."""

    def __init__(self, rows: list[tuple]):
        self.parts = {}
        for width in {len(row[3]) for row in rows}:
            own = sorted((row for row in rows if len(row[3]) == width), key=lambda row: row[2])
            ids, classes, words = (np.array([row[k] for row in own], np.int64) for k in range(3))
            counts = np.frombuffer(b"".join(row[3] for row in own), np.uint8).reshape(len(own), width).astype(np.int32)
            self.parts[width] = ids, classes, words, counts, _folded(counts, COARSE)


def _folded(counts: np.ndarray, width: int) -> np.ndarray:
    """Outlines with fewer buckets."""
    return counts.reshape(len(counts), -1, width).sum(axis=1)


def _near_outlines(one: _Block, two: _Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of the texts of two blocks, or of one twice, that are in different components and can be similar.

    Every word that has no match in order is also missing in the other outline unless another falls into its bucket. So
    outlines of similar texts differ by no more than the words that the threshold lets two texts have unmatched.
    """
    slack = (1 - THRESHOLD) / (1 + THRESHOLD)
    for width, (ids, classes, words, counts, coarse) in one.parts.items():
        for other, (ids_b, classes_b, words_b, counts_b, coarse_b) in two.parts.items():
            least = min(width, other)
            own, its = _folded(counts, least), _folded(counts_b, least)
            low = np.searchsorted(words_b, words * THRESHOLD - 1e-6)
            high = np.searchsorted(words_b, words / THRESHOLD + 1e-6, "right")
            for i in range(len(ids)):
                at = low[i] + np.flatnonzero(classes_b[low[i]:high[i]] != classes[i])
                most = slack * (words[i] + words_b[at]) + 1e-6
                for mine, theirs in ((coarse[i], coarse_b), (own[i], its)):
                    near = np.abs(theirs[at] - mine).sum(axis=1) <= most
                    at, most = at[near], most[near]
                if len(at):
                    yield np.full(len(at), ids[i]), ids_b[at]


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (one, two, side, id, class, words, outline), sorted by the first three, to pairs (a, b) that can be similar.

    ``side`` is 0 for texts of block ``one`` and 1 for those of ``two``; a block paired with itself has only the first.
    """
    def found(sides: dict[int, list]) -> Iterator[pa.RecordBatch]:
        first = _Block(sides[0]) if sides[0] else None
        second = _Block(sides[1]) if sides[1] else first
        if first is not None:
            for a, b in _near_outlines(first, second):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    last, sides = None, {0: [], 1: []}
    for batch in batches:
        for one, two, side, *row in zip(*[column.to_pylist() for column in batch.columns]):
            if (one, two) != last:
                yield from found(sides)
                last, sides = (one, two), {0: [], 1: []}
            sides[side].append(row)
    yield from found(sides)


def _sharing_enough(texts: DataFrame, label: DataFrame) -> DataFrame:
    """Ids of the texts (id, packed) that share as many runs of words with texts of other components as a similar pair must."""
    lists = texts.mapInArrow(bounded(_listed), "id long, text long, size int, words int, shingle long").join(label, "id")
    lists = materialise(lists, "near-shingles")
    counts = lists.groupBy("size", "shingle").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    shared = lists.join(counts.select("size", "shingle"), ["size", "shingle"]).groupBy("id", "text", "size", "words").agg(F.count("*").alias("shared"))
    out = materialise(shared.where(F.col("shared") >= _at_least(F.col("words"))).select("id").distinct(), "near-sharing")
    drop_tables(texts.sparkSession, lists)
    return out


def _rest(ids: DataFrame, known: DataFrame, label: DataFrame, met: DataFrame | None) -> DataFrame:
    """Pairs (a, b) of ``ids`` in different components that can be similar: no similar pair is left out.

    Texts of like length are brought together in blocks of bounded size. Blocks that hold lengths near enough are compared as a
    whole by the outlines of their texts, so a pair becomes a row only where its outlines are near. Where texts are many,
    those that share too few runs of words with any other component are left out first.
    """
    spark = ids.sparkSession
    texts, enough = known.join(ids, "id"), None
    if ids.count() > DIRECT:
        enough = _sharing_enough(texts, label)
        texts = texts.join(enough, "id")
    outlines = texts.mapInArrow(bounded(_outlined), "id long, text long, words int, outline binary").where("words > 0").dropDuplicates(["id", "text"])
    ordered = outlines.join(label, "id").orderBy("words", "id", "text").select("id", "text", "class", "words", "outline")
    blocks = materialise(ordered.mapInArrow(
        bounded(_blocked), "id long, text long, class long, words int, outline binary, block long"), "near-blocks")
    spans = blocks.groupBy("block").agg(F.min("words").alias("low"), F.max("words").alias("high"))
    one = spans.select(F.col("block").alias("one"), F.col("high").alias("high_one"), F.col("low").alias("low_one"))
    two = spans.select(F.col("block").alias("two"), F.col("high").alias("high_two"), F.col("low").alias("low_two"))
    near = (F.col("high_one") >= F.col("low_two") * THRESHOLD - 1e-6) & (F.col("high_two") >= F.col("low_one") * THRESHOLD - 1e-6)
    pairs = materialise(one.join(two, (F.col("one") <= F.col("two")) & near).select("one", "two"), "near-blockpairs")
    rows = ["id", "class", "words", "outline"]
    left = pairs.join(blocks, F.col("one") == F.col("block")).select("one", "two", F.lit(0).alias("side"), *rows)
    right = pairs.where("one < two").join(blocks, F.col("two") == F.col("block")).select("one", "two", F.lit(1).alias("side"), *rows)
    sides = left.unionByName(right).repartition("one", "two").sortWithinPartitions("one", "two", "side")
    found = sides.mapInArrow(bounded(_paired), "a long, b long").where("a < b").distinct()
    found = materialise(found if met is None else found.join(met, ["a", "b"], "left_anti"), "near-rest")
    drop_tables(spark, blocks, pairs, *[] if enough is None else [enough])
    return found


def _all_between(placed: DataFrame, met: DataFrame | None) -> DataFrame:
    """All pairs of texts that share a mark, are in different components and have not met."""
    other = placed.select("mark", F.col("id").alias("b"), F.col("class").alias("class_b"))
    pairs = placed.withColumnRenamed("id", "a").join(other, "mark").where("a < b AND class <> class_b").select("a", "b").distinct()
    return pairs if met is None else pairs.join(met, ["a", "b"], "left_anti")


def first_of_each(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs``, all columns, that are the first of their class; rows without an id stay."""
    found = classes(docs, key, text)
    stays, number = fresh_names(docs.columns, "stays", "number")
    stay = found.where("id = class").select(F.col("id").alias(stays))
    out = docs.join(stay, F.col(key).cast("long") == F.col(stays), "left_semi")
    repeated = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).count().where("count > 1")
    if not repeated.isEmpty():
        order = Window.partitionBy(key).orderBy(text)
        out = out.withColumn(number, F.row_number().over(order)).where(F.col(number) == 1).drop(number)
    return out.unionByName(docs.where(F.col(key).isNull()))
