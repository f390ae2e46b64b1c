"""SimHash near-duplicates, candidates from tables of distances to reference fingerprints (pivots).

A fingerprint has 64 bits; a bit is set if it is set in over half the hashes of a text's shingles.
Two fingerprints are linked if they differ in at most ``MOST_BITS`` = 2 bits.

The 33 pivots are zero and 32 masks of two bits each, which share no bit. The distances to zero and
to a mask give how many of the mask's bits are set: (d(x, 0) + 2 - d(x, mask)) / 2. Two linked
fingerprints disagree in at most two of these 32 numbers. The masks form five groups, so linked
fingerprints agree throughout at least three groups: each of the ten ways to choose three gives a
bucket key, and linked fingerprints meet in a bucket. In a bucket, pairs whose distances to any pivot
differ by more than two are discarded (triangle inequality); the rest are verified bit by bit.

Buckets of more than ``MOST_IN_BUCKET`` fingerprints are not paired. Their members are joined exactly in
another way: two fingerprints differ in at most two bits if and only if they share a value among
themselves and their 64 neighbours at one bit. That is 65 rows a fingerprint however large the
bucket, and at most 65 fingerprints share a value. So no link is lost and no group grows unbounded.

Equal fingerprints are one node from the start. Defined results: null and wordless texts have
fingerprint zero, linked like any other. Null ids never name a component that has another id. An
empty table gives no rows, repeated rows are repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, with_fields
from riskloom.llm.components import components
from riskloom.session import stored

SHINGLE = 3
MOST_BITS = 2
SEED = 42
MOST_IN_BUCKET = 512
MASKS = np.array([(1 << j) | (1 << (j + 32)) for j in range(32)], np.uint64)
PIVOTS = np.concatenate([[np.uint64(0)], MASKS])
GROUPS = np.array_split(np.arange(32), 5)
#: The masks of each choice of three groups.
CHOICES = [np.concatenate([GROUPS[i] for i in chosen]) for chosen in combinations(range(5), 3)]
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)
_OFFSETS = 256 * np.arange(8)


def simhash(text: str, size: int = SHINGLE) -> int:
    """The fingerprint of a text, unsigned. Shingles of lower-cased words, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
    raw = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.bincount((raw + _OFFSETS).ravel(), minlength=2048).reshape(8, 256)
    bits = (counts @ _BITS).ravel() * 2 > len(raw)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Replace the text by its ``fingerprint``, a signed 64-bit number; all other columns stay."""
    others = [c for c in df.columns if c not in (text, "fingerprint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([simhash(t or "", size) for t in batch.column(0).to_pylist()], np.uint64)
            found = pa.array(found.view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], found], names=[*others, "fingerprint"])

    schema = with_fields(df.select(*others), "fingerprint bigint")
    return df.select(F.col(text).cast("string"), *others).mapInArrow(run, schema)


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Distances of each fingerprint to each pivot."""
    return np.bitwise_count(prints[:, None] ^ PIVOTS).astype(np.int64)


def bucket_keys(prints: np.ndarray) -> np.ndarray:
    """The bucket of each fingerprint under each choice of groups, as signed 64-bit numbers."""
    table = pivot_table(prints)
    set_bits = (table[:, :1] + 2 - table[:, 1:]) // 2
    keys = np.empty((len(prints), len(CHOICES)), np.uint64)
    for number, chosen in enumerate(CHOICES):
        packed = set_bits[:, chosen] @ (3 ** np.arange(len(chosen)))
        keys[:, number] = packed.astype(np.uint64) * np.uint64(len(CHOICES)) + np.uint64(number)
    return keys.view(np.int64)


def linked_pairs(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints that differ in at most two bits."""
    left, right = np.triu_indices(len(prints), 1)
    table = pivot_table(prints)
    for distances in table.T:
        near = np.abs(distances[left] - distances[right]) <= MOST_BITS
        left, right = left[near], right[near]
    near = np.bitwise_count(prints[left] ^ prints[right]) <= MOST_BITS
    return left[near], right[near]


def spanning_edges(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges than fingerprints, which connect what the linked pairs connect."""
    left, right = linked_pairs(prints)
    label = np.arange(len(prints))
    while True:
        least = label.copy()
        np.minimum.at(least, left, label[right])
        np.minimum.at(least, right, label[left])
        least = least[least]
        if (least == label).all():
            moved = label != np.arange(len(prints))
            return prints[moved], prints[label[moved]]
        label = least


def links(prints: DataFrame) -> DataFrame:
    """Edges ``u, v`` that connect distinct fingerprints exactly as all pairs at two bits or less do."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            keys = bucket_keys(values.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(values, keys.shape[1]))], names=["key", "fingerprint"]
            )

    members = prints.select("fingerprint").mapInArrow(keyed, "key bigint, fingerprint bigint")
    # Stored, so that its size is known: Spark broadcasts it only if it is small, and splits the join else.
    large = stored(members.groupBy("key").count().filter(F.col("count") > MOST_IN_BUCKET).select("key"))
    small = members.join(large, "key", "left_anti")
    # Grouped by a hash of the key, so that the join before may be split and still not feed one task.
    groups = small.groupBy(F.xxhash64("key").alias("bucket")).agg(F.collect_list("fingerprint").alias("prints"))

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            found = [spanning_edges(part) for part in np.split(values, ends[:-1])]
            u = np.concatenate([e[0] for e in found] or [np.empty(0, np.uint64)])
            v = np.concatenate([e[1] for e in found] or [np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    edges = groups.filter(F.size("prints") > 1).select("prints").mapInArrow(paired, "u bigint, v bigint")

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            around = (values.view(np.uint64)[:, None] ^ flips).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(around.ravel()), pa.array(np.repeat(values, 65))], names=["near", "fingerprint"]
            )

    crowded = members.join(large, "key", "left_semi").select("fingerprint").distinct()
    around = crowded.mapInArrow(neighbours, "near bigint, fingerprint bigint")
    shared = around.groupBy("near").agg(F.collect_list("fingerprint").alias("prints")).filter(F.size("prints") > 1)
    least = shared.select(F.array_min("prints").alias("v"), F.explode("prints").alias("u")).filter("u <> v")
    return edges.union(least.select("u", "v").distinct())


def in_components(rows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The rows with their ``fingerprint`` in place of the text, the ``root`` of their component (a fingerprint) and
    ``component_id``."""
    prints = stored(fingerprints(rows, size=size))
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    stars = components(links(nodes)).select(F.col("u").alias("fingerprint"), F.col("v").alias("root"))
    rooted = nodes.join(stars, "fingerprint", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "fingerprint")))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(named, "root").select("fingerprint", "root", "component_id")
    return prints.join(found, "fingerprint")


def near_duplicates(df: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id``: the least ``doc_id`` that can be reached over links."""
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return in_components(rows, size).select("doc_id", "fingerprint", "component_id")


def one_of_each(df: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of each component, of those whose id names it that with the least digest of the text; those
    without an id stay as they are. Components that are named by the same id keep a document each."""
    name = "digest"
    while name in map(str.lower, df.columns):
        name += "_"
    # Rows of equal id and text are in the same component, so the pair stands for the row.
    digest = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", digest.alias(name))
    naming = in_components(rows, size).filter("doc_id = component_id")
    kept = naming.groupBy("root", "doc_id").agg(F.min(name).alias(name)).select("doc_id", name)
    named = df.filter("doc_id is not null").withColumn(name, digest)
    named = named.join(kept, ["doc_id", name], "left_semi").dropDuplicates(["doc_id", name])
    return named.select(*df.columns).union(df.filter("doc_id is null"))
