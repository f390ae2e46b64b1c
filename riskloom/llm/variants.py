"""Spelling variants of the words of a corpus: words at one edit, found through Bloom filters.

1. Words are counted over all texts; those of ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` occurrences are the vocabulary.
2. A word's key is a sum of random numbers, one for each (place, letter), modulo 2**64, twice. The key of an edited word
   follows from sums before and behind the edit, so an edit costs an addition, however long the word.
3. Blocked Bloom filters over the keys, a shard for each word length, are built by a grouped bitwise or and broadcast. If
   they would take more than ``FILTER_BYTES``, the vocabulary is cut into segments by key, and the next steps are
   taken a segment at a time; so the broadcast is bounded, and filters are never fuller.
4. Tasks probe the filters with every deletion and every replacement by a later letter. That gives every pair once: an
   insertion is a deletion of the other word. Only keys that pass are shuffled, to a join with the vocabulary on
   both keys (128 bits) and the length, which removes what only the filter let through.
5. The join's pairs are turned around, and each word gets the most frequent word near it. A word's form occurs ``RATIO``
   times as often, so forms have no cycles and at most ``log(greatest count) / log(RATIO)`` steps; their ends are found by
   doubling steps.

A word has at most some 90 near words a letter, so no group of pairs is larger than that.

Defined results: a run is a maximal sequence of letters of ``LETTERS``, A-Z lower-cased; others are not letters. Null and
empty texts have no runs. A null ``doc_id`` counts as an empty one in the hash that drops letters. Repeated rows count
as often as they stand there. Words of any length take part; those of ``SHARDS`` letters and more share a filter. Of near
words with the same count the first in code-point order is taken. No words: no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, task_count
from riskloom.session import stored

# The letters, which of them are dropped, and what counts as a word and as its form.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
DROP_EVERY = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
#: Distinct words (and their letters) that a task counts before it passes the counts on.
WORDS_HELD = 50_000
LETTERS_HELD = 4_000_000
#: Filters: lengths that have their own, bits a word, bits set by a word, and bytes broadcast at a time.
SHARDS = 40
BITS = 16
PROBES = 6
FILTER_BYTES = 32 << 20
BLOCK_WORDS = 8
#: Edits whose keys a task holds at a time.
EDITS_HELD = 1 << 20

_RUN = re.compile(f"[{LETTERS[:26]}{LETTERS[26]}-{LETTERS[-1]}]+")
_U = np.uint64


def perturbed(word: str, digest: int) -> str:
    """The word without a letter, if the digest says so."""
    at = digest % len(word)
    return word[:at] + word[at + 1 :] if digest % DROP_EVERY == 0 else word


def word_counts(df: DataFrame) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        held = 0

        def passed_on() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in slices(batches):
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                # Lower-casing bytes changes A-Z only.
                found = Counter(_RUN.findall((text or "").encode().lower().decode()))
                for word, n in found.items():
                    if len(word) >= LEAST_LENGTH:
                        word = perturbed(word, zlib.crc32(word.encode(), start))
                        if len(word) >= LEAST_LENGTH:
                            held += 0 if word in counts else len(word)
                            counts[word] += n
                if len(counts) >= WORDS_HELD or held >= LETTERS_HELD:
                    yield passed_on()
                    counts.clear()
                    held = 0
        yield passed_on()

    rows = df.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    counted = rows.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well spread 64-bit numbers, a different one for each value."""
    x = values.astype(_U) + _U((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shares(places: np.ndarray, letters: np.ndarray, which: int) -> np.ndarray:
    """What letters (codes) at places add to a word's first or second key."""
    return mixed(places.astype(_U) * _U(256) + letters.astype(_U), 1 + which)


#: For each edit the number of its word, and a function that gives the first or second key of some edits.
Edits = tuple[np.ndarray, Callable[[int, "np.ndarray | slice"], np.ndarray]]


class Words:
    """Words of one length as a matrix of letter codes, and the keys of their edits."""

    def __init__(self, words: list[bytes]):
        self.codes = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        self.size = self.codes.shape[1]
        places = np.arange(self.size)
        self.added = [shares(places, self.codes, which) for which in (0, 1)]
        self.keys = [a.sum(axis=1, dtype=_U) for a in self.added]

    def deletions(self) -> Iterator[Edits]:
        """Words without one letter; of equal neighbours the first goes."""
        keep = np.ones(self.codes.shape, bool)
        keep[:, 1:] = self.codes[:, 1:] != self.codes[:, :-1]
        who, at = np.nonzero(keep)

        def key(which: int, some: np.ndarray | slice) -> np.ndarray:
            # Letters behind the one that goes move to the place before theirs.
            added = self.added[which]
            moved = shares(np.arange(-1, self.size - 1).clip(0), self.codes, which)
            before = np.cumsum(added, axis=1, dtype=_U) - added
            behind = moved.sum(axis=1, dtype=_U)[:, None] - np.cumsum(moved, axis=1, dtype=_U)
            return (before + behind)[who[some], at[some]]

        yield who, key

    def replacements(self, letters: np.ndarray) -> Iterator[Edits]:
        """Words with another, later letter at one place."""
        at_a_time = max(1, EDITS_HELD // (len(self.codes) * len(letters)))
        for low in range(0, self.size, at_a_time):
            places = np.arange(low, min(low + at_a_time, self.size))
            later = np.flatnonzero(letters > self.codes[:, places, None])
            cell, letter = np.divmod(later, len(letters))
            who, place = np.divmod(cell, len(places))

            def key(which: int, some: np.ndarray | slice, places=places, cell=cell, place=place, letter=letter) -> np.ndarray:
                rest = (self.keys[which][:, None] - self.added[which][:, places]).ravel()
                new = shares(places[:, None], letters, which)
                return rest[cell[some]] + new[place[some], letter[some]]

            yield who, key


def of_each_length(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """The words of all batches, some of one length at a time."""
    for batch in slices(batches):
        by_length: dict[int, list[bytes]] = {}
        for word in batch.column(0).to_pylist():
            by_length.setdefault(len(word), []).append(word.encode("latin-1"))
        for size, words in by_length.items():
            at_a_time = max(1, EDITS_HELD // (size * len(LETTERS)))
            for low in range(0, len(words), at_a_time):
                yield Words(words[low : low + at_a_time])


def segment_of(key: np.ndarray, segments: int) -> np.ndarray:
    return mixed(key, 3) % _U(segments)


def bits_of(key: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each key in a filter, and the bits (0 to 511) that it sets there, a row a probe."""
    spread = mixed(key, 4)
    shifts = 9 * np.arange(PROBES, dtype=_U)[:, None]
    return mixed(key, 5) % _U(blocks), (spread >> shifts) & _U(511)


class Filters:
    """Blocked Bloom filters by shard, for one segment of the vocabulary."""

    def __init__(self, blocks: dict[int, np.ndarray], segment: int, segments: int):
        self.blocks, self.segment, self.segments = blocks, segment, segments

    def likely(self, key: np.ndarray, size: int) -> np.ndarray:
        """The numbers of the keys that may be those of words of this length."""
        table = self.blocks.get(min(size, SHARDS))
        if table is None:
            return np.empty(0, np.int64)
        found = np.flatnonzero(segment_of(key, self.segments) == self.segment) if self.segments > 1 else np.arange(len(key))
        block, bits = bits_of(key[found], len(table))
        for probe in range(PROBES):
            bit = bits[probe]
            hit = (table[block, bit >> _U(6)] >> (bit & _U(63))) & _U(1) == 1
            # Few are left after the first probes.
            found, block, bits = found[hit], block[hit], bits[:, hit]
        return found


def filters(vocabulary: DataFrame) -> Iterator[Filters]:
    """Filters of the whole vocabulary, segment by segment; the driver holds one segment's."""
    by_length = vocabulary.groupBy(F.least("size", F.lit(SHARDS)).alias("shard")).count()
    counts = {r["shard"]: r["count"] for r in by_length.collect()}
    segments = max(1, -(-sum(counts.values()) * BITS // (8 * FILTER_BYTES)))
    blocks = {s: -(-n * BITS // (64 * BLOCK_WORDS * segments)) for s, n in counts.items()}
    names = [f"w{i}" for i in range(BLOCK_WORDS)]
    schema = "segment int, shard int, block bigint, " + ", ".join(f"{n} bigint" for n in names)

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy().view(_U)
            shards = np.minimum(batch.column(1).to_numpy(), SHARDS)
            block, bits = bits_of(key, np.array([blocks[s] for s in shards.tolist()], _U))
            words = np.zeros((len(key), BLOCK_WORDS), _U)
            for bit in bits:
                words[np.arange(len(key)), bit >> _U(6)] |= _U(1) << (bit & _U(63))
            columns = [segment_of(key, segments).astype(np.int32), shards.astype(np.int32), block.astype(np.int64)]
            columns += list(np.ascontiguousarray(words.view(np.int64).T))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["segment", "shard", "block", *names])

    each = vocabulary.select("key", "size").mapInArrow(set_bits, schema)
    each = each.groupBy("segment", "shard", "block").agg(*[F.bit_or(n).alias(n) for n in names])
    if segments > 1:
        each = stored(each, "segment")
    for segment in range(segments):
        rows = each.filter(F.col("segment") == segment).toArrow()
        tables = {s: np.zeros((n, BLOCK_WORDS), _U) for s, n in blocks.items()}
        shards, block = rows.column("shard").to_numpy(), rows.column("block").to_numpy()
        words = np.stack([rows.column(n).to_numpy().view(_U) for n in names], axis=1)
        for s, filter_ in tables.items():
            filter_[block[shards == s]] = words[shards == s]
        yield Filters(tables, segment, segments)


def with_keys(words: DataFrame) -> DataFrame:
    """Add ``key, other`` (the two keys) and ``size``, the number of letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            keys = np.empty((2, len(words)), _U)
            sizes = np.array(list(map(len, words)), np.int32)
            for size in np.unique(sizes).tolist():
                for some in np.array_split(np.flatnonzero(sizes == size), 1 + size * len(words) // EDITS_HELD):
                    if len(some):
                        keys[:, some] = Words([words[i] for i in some]).keys
            columns = [*batch.columns, *[pa.array(k.view(np.int64)) for k in keys], pa.array(sizes)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "key", "other", "size"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, key bigint, other bigint, size int")


def likely_edits(vocabulary: DataFrame, known: Filters) -> DataFrame:
    """Edits that pass the filters: ``key, other, size`` of the edited word, and its source's ``from_key, from_other,
    from_size``."""
    shared = vocabulary.sparkSession.sparkContext.broadcast((known, codes_in(vocabulary)))
    schema = "key bigint, other bigint, size int, from_key bigint, from_other bigint, from_size int"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, letters = shared.value
        for words in of_each_length(batches):
            edits = [(words.size - 1, words.deletions()), (words.size, words.replacements(letters))]
            for size, found in edits:
                for who, key in found:
                    first = key(0, slice(None))
                    passed = known.likely(first, size)
                    keys = [first[passed], key(1, passed), *[k[who[passed]] for k in words.keys]]
                    a, b, c, d = (pa.array(k.view(np.int64)) for k in keys)
                    sizes = [pa.array(np.full(len(passed), s, np.int32)) for s in (size, words.size)]
                    yield pa.RecordBatch.from_arrays([a, b, sizes[0], c, d, sizes[1]], names=names)

    # The words are few bytes and much work, so tasks are not left to the size of the files.
    return vocabulary.select("word").repartition(task_count(vocabulary), "word").mapInArrow(run, schema)


def codes_in(vocabulary: DataFrame) -> np.ndarray:
    """The letters that some word has, in order: no edit with another one is a word."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).distinct().collect()
    return np.array(sorted(ord(r.letter) for r in letters if r.letter), np.uint8)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``key, other, size, near, near_n``: each word's key with each word at one edit, and that word's count."""
    identity = ["key", "other", "size"]
    pairs = None
    for known in filters(vocabulary):
        edits = likely_edits(vocabulary, known)
        pairs = edits if pairs is None else pairs.union(edits)
    target = vocabulary.select(*identity, F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = stored(pairs.join(target, identity))
    there = met.select(*[F.col(f"from_{c}").alias(c) for c in identity], "near", "near_n")
    turned = met.select(*identity, *[f"from_{c}" for c in identity])
    source = target.select(*[F.col(c).alias(f"from_{c}") for c in identity], "near", "near_n")
    back = turned.join(source, [f"from_{c}" for c in identity]).select(*identity, "near", "near_n")
    return there.union(back)


def ends_of(steps: DataFrame) -> DataFrame:
    """``word, root`` for rows ``word, form``, which have no cycle: where the steps from each word end."""
    ends = stored(steps.select("word", F.col("form").alias("root")))
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(ends.join(further, "root", "left").select("word", "root", "next"))
        if moved.filter("next is not null").isEmpty():
            return ends
        ends = moved.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(df: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the vocabulary."""
    vocabulary = stored(with_keys(word_counts(df)))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_words(vocabulary).groupBy("key", "other", "size").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = vocabulary.join(near, ["key", "other", "size"], "left")
    counted = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "best")
    chosen = -F.col("best.less") >= RATIO * F.col("n")
    formed = stored(
        counted.select(
            "word",
            F.when(chosen, F.col("best.near")).alias("form"),
            "n",
            "n_near",
            F.when(chosen, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = ends_of(formed.filter("form is not null"))
    named = formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return named.select("word", "form", "root", "n", "n_near", "form_n")
