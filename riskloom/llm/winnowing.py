"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points is hashed; of each window of ``WINDOW`` consecutive hashes the
smallest is chosen, of equal ones the rightmost. A window that keeps its choice adds nothing. Two
texts that share ``GRAM + WINDOW - 1`` code points in a row share a chosen hash, and no match
shorter than ``GRAM`` is seen. Positions of the chosen grams are kept. With windows of 8, runs of 23 code points
are never missed and about two grams in nine are chosen.

Defined results: a null text is the empty text, whose fingerprint is empty. A text shorter than
``GRAM`` is one gram. A text with fewer grams than a window has one choice. Likeness is the share of
distinct chosen hashes that two fingerprints have in common (Jaccard), and 1 for two empty ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import bucket_of, cut_points, slices, task_count, with_fields

GRAM = 16
#: Short, so that a text of 46 code points already shares a hash with itself half replaced.
WINDOW = 8
#: Any odd constants do: the first is the base of the rolling hash, the others spread its bits.
BASE = 0x9E3779B97F4A7C15
SPREAD = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def gram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """32-bit hashes of all runs of ``size`` code points (of the whole text, if shorter).

    The hash of a run of 2n values is that of its halves: ``left * base**n + right``. So runs of
    any length take a logarithmic number of passes, and equal runs hash alike wherever they are.
    """
    size = max(1, min(size, len(points)))
    run, done, length = points.astype(np.uint64) + np.uint64(1), None, 1
    covered = 0
    while True:
        if size & length:
            # Append this power-of-two run to what the lower bits of the size have covered.
            if done is None:
                done, covered = run, length
            else:
                scale = np.uint64(pow(BASE, length, 1 << 64))
                count = len(points) - covered - length + 1
                done, covered = done[:count] * scale + run[covered : covered + count], covered + length
        length *= 2
        if length > size:
            break
        half = length // 2
        run = run[: len(run) - half] * np.uint64(pow(BASE, half, 1 << 64)) + run[half:]
    mixed = (done ^ (done >> np.uint64(30))) * np.uint64(SPREAD[0])
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(SPREAD[1])
    return (mixed >> np.uint64(32)).astype(np.uint64)


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each window, of windows of all values if there are fewer."""
    size = max(1, min(size, len(values)))
    length = 1
    while 2 * length <= size:
        values = np.minimum(values[: len(values) - length], values[length:])
        length *= 2
    rest = size - length
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions, in the order of the text."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    if not len(points):
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    hashes = gram_hashes(points, gram)
    # Hash above, distance from the end below: the smallest is the rightmost of the smallest hashes.
    last = np.uint64(0xFFFFFFFF)
    keyed = (hashes << np.uint64(32)) | (last - np.arange(len(hashes), dtype=np.uint64))
    chosen = window_minima(keyed, window)
    chosen = chosen[np.r_[True, chosen[1:] != chosen[:-1]]]
    return (chosen >> np.uint64(32)).astype(np.uint32), (last - (chosen & last)).astype(np.uint32)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    if not len(one) and not len(other):
        return 1.0
    a, b = np.unique(one), np.unique(other)
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def as_hex(hashes: np.ndarray) -> str:
    """Eight hex digits a hash, in order."""
    return hashes.astype(">u4").tobytes().hex()


def fingerprints(df: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Replace the text by ``hashes`` and ``positions`` arrays; every other column stays."""
    others = [c for c in df.columns if c not in (text, "hashes", "positions")]
    result = with_fields(df.select(*others), "hashes array<bigint>, positions array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [winnow(t or "", gram, window) for t in batch.column(0).to_pylist()]
            kinds = pa.list_(pa.int64())
            arrays = [pa.array([x[i].astype(np.int64) for x in found], kinds) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *arrays], names=[*others, "hashes", "positions"]
            )

    return df.select(F.col(text), *others).mapInArrow(run, result)


def edited(text: str, following: str) -> str:
    """The text, its last half replaced by as many code points of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared_with_next(
    df: DataFrame, key: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """Fingerprints of each text and its edited form, and likeness to the edited form and the next text.

    The next row is that of the next key (ties: by text; null keys first); after the last comes
    the first. Rows are dealt to tasks by ranges of the key. The first row of each range also goes
    to the end of the range before, so every task has all successors it needs; that is one text a task.
    """
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Before every value comes null, so the pair orders as the key does and is never null.
    rows = rows.withColumn("place", F.struct(F.col("key").isNotNull().alias("has"), "key"))
    cuts = cut_points(rows.select("key"), "key", task_count(rows))
    rows = rows.withColumn("bucket", bucket_of(F.col("key"), cuts))
    # One row a range, so the bound on ranges bounds it.
    firsts = rows.groupBy("bucket").agg(F.min("place").alias("place")).orderBy("bucket").collect()
    before = [(firsts[i - 1]["bucket"], *r["place"]) for i, r in enumerate(firsts)]
    ends = df.sparkSession.createDataFrame(before, "end_of int, has boolean, end_key bigint")
    ends = F.broadcast(ends.select("end_of", F.struct("has", F.col("end_key").alias("key")).alias("end_place")))
    marked = rows.join(ends, F.col("place") == F.col("end_place"), "left")
    where = F.array(
        F.struct("bucket", F.lit(False).alias("extra")),
        F.struct(F.col("end_of").alias("bucket"), F.lit(True).alias("extra")),
    )
    dealt = marked.select("key", "text", F.explode(where).alias("to")).select("key", "text", "to.*")
    dealt = dealt.filter("bucket is not null").repartitionById(len(cuts) + 1, "bucket")
    dealt = dealt.sortWithinPartitions("bucket", "extra", "key", "text").select("key", "text", "extra")
    schema = pa.schema(
        [
            ("key", pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, over = None, False
        for batch in slices(batches):
            out = []
            for k, t, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if over:
                    break
                own, _ = winnow(t, gram, window)
                if held is not None:
                    changed = edited(held[1], t)
                    other, _ = winnow(changed, gram, window)
                    digest = hashlib.sha256(changed.encode()).hexdigest()
                    near = (likeness(held[2], other), likeness(held[2], own))
                    out.append((held[0], len(held[1]), digest, as_hex(held[2]), as_hex(other), *near))
                held, over = (k, t, own), extra
            if out:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    result = (
        "key bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return dealt.mapInArrow(run, result).withColumnRenamed("key", key)
