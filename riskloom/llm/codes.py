"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits, lowest first. Level 0 holds the first chunk of every id, level
n the next chunk of those ids that go on, and each level has a bitmap of which of its ids do. A
directory counts the set bits before every 512th, so the place of any id on the next level is one
look-up and a count inside one block, and no other id has to be decoded.

File, all numbers little-endian: the magic ``DAC1``; 64-bit counts of ids, documents and levels; for
each level the count of its ids; then document ids (signed 64-bit) and the position of each
document's first id and of the end (64-bit); then per level the chunks, the bitmap (lowest bit
first) and the directory (one 32-bit count a block). Every section starts at a multiple of eight.

Rows: documents in ascending ``doc_id`` order, null ids first, equal ids by text. A null text is the
empty text. Every document ends with the given id, so none is without ids. No documents: no files.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import in_order, running_starts, slices
from riskloom.llm.files import RangeFile, fresh_folder, write_file
from riskloom.llm.tokens import json_encoder
from riskloom.session import stored

MAGIC = b"DAC1\0\0\0\0"
BLOCK = 512
#: Ids in a file, about: a file ends with the document that reaches it.
FILE_IDS = 4_000_000
#: Documents whose ids are read together.
READ_DOCS = 200
#: Stands for a null document id in a file.
NO_ID = -(1 << 63)


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def encode_file(ids: np.ndarray, doc_ids: np.ndarray, starts: np.ndarray) -> bytes:
    """The file of these ids, whose documents begin at ``starts`` (one more than documents)."""
    values, counts, body = ids.astype(np.uint64), [], []
    while len(values):
        counts.append(len(values))
        goes_on = values > 255
        set_bits = np.zeros(-(-len(values) // BLOCK) * BLOCK, np.uint8)
        set_bits[: len(values)] = goes_on
        per_block = set_bits.reshape(-1, BLOCK).sum(axis=1, dtype=np.uint32)
        directory = np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype("<u4")
        chunks = (values & np.uint64(255)).astype(np.uint8)
        body += [chunks.tobytes(), np.packbits(set_bits, bitorder="little").tobytes(), directory.tobytes()]
        values = values[goes_on] >> np.uint64(8)
    head = struct.pack("<8s3Q", MAGIC, len(ids), len(doc_ids), len(counts))
    head += np.array(counts, "<u8").tobytes()
    places = [doc_ids.astype("<i8").tobytes(), starts.astype("<u8").tobytes()]
    return b"".join([head, *map(_padded, [*places, *body])])


class CodedFile:
    """Ids of such a file by position, through a function that reads a byte range."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self._read = read
        magic, self.n_ids, self.n_docs, levels = struct.unpack("<8s3Q", read(0, 32))
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        counts = np.frombuffer(read(32, 8 * levels), "<u8").tolist()
        at = 32 + 8 * levels
        self._doc_ids, self._starts = at, at + 8 * self.n_docs
        at = self._starts + 8 * (self.n_docs + 1)
        self._levels = []
        for count in counts:
            chunks, blocks = at, -(-count // BLOCK)
            bitmap = chunks + -(-count // 8) * 8
            directory = bitmap + blocks * BLOCK // 8
            self._levels.append((chunks, bitmap, directory))
            at = directory + -(-4 * blocks // 8) * 8

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """Document ids, and the positions of their first ids and of the end."""
        ids = np.frombuffer(self._read(self._doc_ids, 8 * self.n_docs), "<i8")
        return ids, np.frombuffer(self._read(self._starts, 8 * (self.n_docs + 1)), "<u8").astype(np.int64)

    def _rank(self, level: int, position: int) -> int:
        """Set bits of the level's bitmap before the position."""
        _, bitmap, directory = self._levels[level]
        block, inside = divmod(position, BLOCK)
        before = int(np.frombuffer(self._read(directory + 4 * block, 4), "<u4")[0])
        if not inside:
            return before
        data = np.frombuffer(self._read(bitmap + block * BLOCK // 8, -(-inside // 8)), np.uint8)
        return before + int(np.unpackbits(data, bitorder="little")[:inside].sum())

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from position ``start`` up to ``stop``."""
        if not 0 <= start <= stop <= self.n_ids:
            raise IndexError(f"ids {start} to {stop} of {self.n_ids}")
        found, who, shift = np.zeros(0, np.uint64), None, 0
        for level, (chunks, bitmap, _) in enumerate(self._levels):
            if start == stop:
                break
            part = np.frombuffer(self._read(chunks + start, stop - start), np.uint8).astype(np.uint64)
            if who is None:
                found = part
            else:
                found[who] |= part << np.uint64(shift)
            first = start // 8
            bits = np.frombuffer(self._read(bitmap + first, -(-stop // 8) - first), np.uint8)
            goes_on = np.unpackbits(bits, bitorder="little")[start - 8 * first :][: stop - start].astype(bool)
            who = np.flatnonzero(goes_on) if who is None else who[goes_on]
            if len(who):
                start = self._rank(level, start)
            stop = start + len(who)
            shift += 8
        return found

    def id_at(self, position: int) -> int:
        return int(self.ids(position, position + 1)[0])


def write_coded(df: DataFrame, vocabulary: str, end_id: int, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the texts' ids; one row a file in order: ``bucket, file, path, n_docs, n_tokens, before``.

    ``before`` counts the ids of all files before it. Rows are dealt to tasks by ranges of ``doc_id``; a task holds one file at a time.
    """
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt, _ = in_order(rows, "doc_id", ["text"])
    folder = fresh_folder(df.sparkSession, "codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, number = TaskContext.get().partitionId(), 0
        encode = json_encoder(vocabulary)
        end = np.array([end_id], encode.kind).tobytes()
        parts, docs, starts = [], [], [0]

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), encode.kind)
            data = encode_file(ids, np.array(docs, np.int64), np.array(starts, np.int64))
            path = write_file(folder, f"{bucket:06d}-{number:06d}.dac", data)
            row = {"bucket": bucket, "file": number, "path": path, "n_docs": len(docs), "n_tokens": len(ids)}
            return pa.RecordBatch.from_pylist([row])

        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts.append(encode(text) + end)
                docs.append(NO_ID if doc is None else doc)
                starts.append(starts[-1] + len(parts[-1]) // encode.kind.itemsize)
                if starts[-1] >= file_ids:
                    yield close()
                    parts, docs, starts, number = [], [], [0], number + 1
        if docs:
            yield close()

    schema = "bucket bigint, file bigint, path string, n_docs bigint, n_tokens bigint"
    written = stored(dealt.select("doc_id", "text").mapInArrow(run, schema))
    place = written.withColumn("place", F.struct("bucket", "file"))
    return running_starts(place, "n_tokens", "place").drop("place")


def read_coded(files: DataFrame) -> DataFrame:
    """All documents of the files: ``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit numbers)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with RangeFile(path) as file:
                    # The whole file is wanted here, so it is fetched once and addressed in memory.
                    data = file.read(0, file.size)
                coded = CodedFile(lambda at, length, data=data: data[at : at + length])
                docs, starts = coded.documents()
                for low in range(0, len(docs), READ_DOCS):
                    some = range(low, min(low + READ_DOCS, len(docs)))
                    # Documents lie side by side, so their ids are looked up together.
                    first = int(starts[some.start])
                    ids = coded.ids(first, int(starts[some.stop])).astype("<u4")
                    ends = (4 * (starts[some.start : some.stop + 1] - first)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([None if docs[i] == NO_ID else int(docs[i]) for i in some], pa.int64()),
                            pa.array(before + starts[some.start : some.stop], pa.int64()),
                            pa.array(np.diff(starts[some.start : some.stop + 1]), pa.int64()),
                            pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(ids)]),
                        ],
                        schema=schema,
                    )

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    result = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    return files.select("path", "before").repartition(tasks).mapInArrow(run, result)
