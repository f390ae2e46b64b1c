"""Removal of passages that an earlier document also has, found from fixed blocks.

A window is ``WINDOW`` = 50 consecutive words of one document. Each word under a window whose words also
stand in a row in a document with a smaller id is removed.

* Index: every document is cut into blocks of ``BLOCK`` = 25 words that do not overlap. Any 50 words in a
  row hold one whole block of their document.
* Probe: every run of 25 words, at every position of every document, is looked up among the blocks. A
  run is a hit if the block stands in some document and the run in at least two.
* Extend: hits grow to all windows that hold one, and windows of equal words in a row (128 bits of hash,
  96 of them compared) give each window the least document that has it. Runs of such windows are the
  maximal exact repeats. No pair of documents is ever formed.

Work is dealt in chunks of documents of about ``CHUNK_CHARS`` characters. A chunk sends each hash once,
however many of its documents hold it, packed to four bytes, to the task that owns a range of hashes,
and gets back one bit for each. So a passage that a third of all documents share is sent at most once a
chunk, and answers are small. Both directions are plain shuffles; nothing is broadcast or collected.

Defined results: a null text has no words. Rows with equal ids never remove from each other; a row
without an id keeps all its words and removes none from others. Rows and other columns all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import task_count, with_fields

WINDOW = 50
BLOCK = 25
CHUNK_CHARS = 2_000_000
#: Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
LOW_BITS = np.uint64((1 << 30) - 1)


def rolling(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """The hash of the run of ``size`` values at each position; runs over the end are cut off.

    Runs of a power of two come from their halves, and the size is put together from such runs.
    """
    run, done, length, covered = values, None, 1, 0
    while True:
        if size & length:
            count = max(0, len(values) - covered - length + 1)
            if done is None:
                done = run[:count]
            else:
                done = done[:count] * np.uint64(pow(base, length, 1 << 64)) + run[covered : covered + count]
            covered += length
        if 2 * length > size:
            return done
        run = run[: max(0, len(run) - length)] * np.uint64(pow(base, length, 1 << 64)) + run[length:]
        length *= 2


class Chunk:
    """The words of some documents and the hashes of their runs."""

    def __init__(self, doc_ids: list, texts: list[str | None]):
        self.words = [(t or "").encode().split() for t in texts]
        self.ids = doc_ids
        sizes = [len(w) if d is not None and len(w) >= WINDOW else 0 for d, w in zip(doc_ids, self.words, strict=True)]
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        digests = b"".join(
            b"".join(map(xxhash.xxh3_128_digest, w)) for w, n in zip(self.words, sizes, strict=True) if n
        )
        self.lanes = np.frombuffer(digests, "<u8").reshape(-1, 2).T
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        self.inside = np.arange(len(self.doc)) - self.starts[self.doc]
        self.left = self.sizes[self.doc] - self.inside

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of runs of a block's length, sorted; whether each is a block here and stands in
        two documents here; and the number of the hash at each position (-1: no run starts there)."""
        places = np.nonzero(self.left >= BLOCK)[0]
        hashes = rolling(np.ascontiguousarray(self.lanes[0]), BLOCK, BASES[0])[places]
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)]
        first = np.nonzero(new)[0]
        last = np.r_[first[1:], len(ordered)][: len(first)] - 1
        docs = self.doc[places][order]
        is_block = (self.inside[places] % BLOCK == 0)[order]
        block = np.logical_or.reduceat(is_block, first) if len(first) else np.empty(0, bool)
        number = np.full(len(self.doc), -1)
        number[places[order]] = np.cumsum(new) - 1
        return ordered[first], block, docs[first] != docs[last], number

    def candidates(self, number: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows that hold a hit: their places, distinct 96-bit hashes (sorted), the least document id
        here that has each, and the number of the hash at each place."""
        at = np.nonzero(number >= 0)[0]
        at = at[hit[number[at]]]
        change = np.zeros(len(self.doc) + 1, np.int64)
        np.add.at(change, np.maximum(at - (WINDOW - BLOCK), self.starts[self.doc[at]]), 1)
        np.add.at(change, at + 1, -1)
        places = np.nonzero((np.cumsum(change[:-1]) > 0) & (self.left >= WINDOW))[0]
        high = rolling(np.ascontiguousarray(self.lanes[0]), WINDOW, BASES[0])[places]
        low = rolling(np.ascontiguousarray(self.lanes[1]), WINDOW, BASES[1])[places] >> np.uint64(32)
        order = np.lexsort((low, high))
        ordered_high, ordered_low = high[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (ordered_high[1:] != ordered_high[:-1]) | (ordered_low[1:] != ordered_low[:-1])
        first = np.nonzero(new)[0]
        ids = np.array([0 if d is None else d for d in self.ids], np.int64)[self.doc[places]]
        least = np.minimum.reduceat(ids[order], first) if len(first) else np.empty(0, np.int64)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        return places, ordered_high[first], ordered_low[first], least, which, ids


def owner(hashes: np.ndarray, owners: int) -> np.ndarray:
    """The task that owns each hash: ranges of hashes, so it rises with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _sent(chunk: int, hashes: np.ndarray, packed: np.ndarray, owners: int) -> pa.Table:
    edges = np.searchsorted(owner(hashes, owners), np.arange(owners + 1))
    full = [o for o in range(owners) if edges[o] < edges[o + 1]]
    return pa.table(
        {
            "owner": pa.array(full, pa.int32()),
            "chunk": pa.array([chunk] * len(full), pa.int64()),
            "packed": pa.array([packed[edges[o] : edges[o + 1]].tobytes() for o in full], pa.binary()),
        }
    )


def _answers(replies: pa.Table, count: int) -> np.ndarray:
    """The bits that owners sent back, in the order of the sorted hashes."""
    parts = sorted(zip(*(replies.column(c).to_pylist() for c in ("owner", "count", "bits")), strict=True))
    bits = [np.unpackbits(np.frombuffer(b, np.uint8))[:n] for _, n, b in parts]
    found = np.concatenate([*bits, np.empty(0, np.uint8)]).astype(bool)
    if len(found) != count:
        raise ValueError(f"{len(found)} answers to {count} hashes")
    return found


def _answered(sent: DataFrame, owners: int, kind: np.dtype, decide) -> DataFrame:
    """Deal packed hashes to their owners and let them answer each with a bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, parts = [], []
        for batch in batches:
            chunks += batch.column(1).to_pylist()
            parts += [np.frombuffer(p, kind) for p in batch.column(2).to_pylist()]
        if not parts:
            return
        sizes = [len(p) for p in parts]
        bits = np.split(decide(np.concatenate(parts)), np.cumsum(sizes)[:-1])
        yield pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array(chunks, pa.int64()),
                "owner": pa.array([TaskContext.get().partitionId()] * len(chunks), pa.int32()),
                "count": pa.array(sizes, pa.int64()),
                "bits": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary()),
            }
        )

    dealt = sent.repartitionById(owners, "owner")
    return dealt.mapInArrow(run, "chunk bigint, owner int, count bigint, bits binary")


def _are_hits(packed: np.ndarray) -> np.ndarray:
    """Packed runs: 30 bits of hash, then whether it is a block and whether two documents hold it."""
    order = np.argsort(packed >> 2, kind="stable")
    ordered = packed[order]
    first = np.nonzero(np.r_[True, (ordered[1:] >> 2) != (ordered[:-1] >> 2)])[0]
    size = np.diff(np.r_[first, len(ordered)])
    flags = np.bitwise_or.reduceat(ordered & 3, first)
    hit = (flags & 2 > 0) & ((flags & 1 > 0) | (size > 1))
    found = np.empty(len(packed), bool)
    found[order] = np.repeat(hit, size)
    return found


def _have_smaller(packed: np.ndarray) -> np.ndarray:
    """Packed windows: whether some chunk has the window in a document with a smaller id."""
    order = np.lexsort((packed["low"], packed["high"]))
    ordered = packed[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered["high"][1:] != ordered["high"][:-1]) | (ordered["low"][1:] != ordered["low"][:-1])
    first = np.nonzero(new)[0]
    least = np.minimum.reduceat(ordered["doc"], first)
    found = np.empty(len(packed), bool)
    found[order] = ordered["doc"] > np.repeat(least, np.diff(np.r_[first, len(order)]))
    return found


def without_repeats(df: DataFrame) -> DataFrame:
    """Every row with three more columns: ``n_words``, ``n_removed`` and ``kept``, the words that stay, joined
    by blanks. Columns of these names in ``df`` are replaced."""
    others = [c for c in df.columns if c not in ("doc_id", "text", "n_words", "n_removed", "kept")]
    owners = task_count(df)
    size = df.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    chunks = owners * max(1, -(-size // (owners * CHUNK_CHARS)))
    rows = df.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("_chunk"),
        F.col("doc_id").cast("bigint").alias("_doc_id"),
        F.col("text").cast("string").alias("_text"),
        *others,
    )
    # One shuffle of the texts, which the three passes over them share.
    dealt = rows.repartition(owners, "_chunk")
    window = np.dtype([("high", "<u8"), ("low", "<u4"), ("doc", "<i8")])

    def chunk_of(table: pa.Table) -> Chunk:
        return Chunk(table.column("_doc_id").to_pylist(), table.column("_text").to_pylist())

    def runs(key: tuple, table: pa.Table) -> pa.Table:
        hashes, block, many, _ = chunk_of(table).runs()
        packed = ((hashes & LOW_BITS) << np.uint64(2)).astype(np.uint32) | (block * 2 + many).astype(np.uint32)
        return _sent(key[0].as_py(), hashes, packed, owners)

    sent = "owner int, chunk bigint, packed binary"
    hits = _answered(dealt.groupBy("_chunk").applyInArrow(runs, sent), owners, np.dtype(np.uint32), _are_hits)

    def windows(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = chunk_of(table)
        hashes, _, _, number = chunk.runs()
        hit = _answers(replies, len(hashes))
        _, high, low, least, _, _ = chunk.candidates(number, hit)
        packed = np.empty(len(high), window)
        packed["high"], packed["low"], packed["doc"] = high, low, least
        return _sent(key[0].as_py(), high, packed, owners)

    candidates = dealt.groupBy("_chunk").cogroup(hits.groupBy("chunk")).applyInArrow(windows, sent)
    smaller = _answered(candidates, owners, window, _have_smaller)
    replies = hits.withColumn("kind", F.lit(0)).union(smaller.withColumn("kind", F.lit(1)))
    fields = with_fields(rows.drop("_chunk"), "n_words bigint, n_removed bigint, kept string")

    def removed(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = chunk_of(table)
        hashes, _, _, number = chunk.runs()
        kinds = np.array(replies.column("kind").to_pylist(), int)
        hit = _answers(replies.filter(pa.array(kinds == 0)), len(hashes))
        places, high, _, least, which, ids = chunk.candidates(number, hit)
        elsewhere = _answers(replies.filter(pa.array(kinds == 1)), len(high))
        starts = places[elsewhere[which] | (ids > least[which])]
        change = np.zeros(len(chunk.doc) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + WINDOW, -1)
        gone = np.cumsum(change[:-1]) > 0
        kept, counts = [], []
        for words, at, count in zip(chunk.words, chunk.starts.tolist(), chunk.sizes.tolist(), strict=True):
            mask = gone[at : at + count]
            lost = int(mask.sum())
            stay = [w for w, g in zip(words, mask.tolist(), strict=True) if not g] if lost else words
            kept.append(b" ".join(stay).decode())
            counts.append(lost)
        more = [[len(w) for w in chunk.words], counts]
        more = [pa.array(c, pa.int64()) for c in more] + [pa.array(kept, pa.string())]
        own = table.select(["_doc_id", "_text", *others])
        for name, column in zip(("n_words", "n_removed", "kept"), more, strict=True):
            own = own.append_column(name, column)
        return own

    done = dealt.groupBy("_chunk").cogroup(replies.groupBy("chunk")).applyInArrow(removed, fields)
    return done.withColumnsRenamed({"_doc_id": "doc_id", "_text": "text"})
