"""Mixture-controlled packing of documents into fixed-size training sequences.

Every source is a queue of tokens with a target share. Each window is filled by deficit round-robin:
a queue earns credit in proportion to its share, and every slot goes to the queue whose next token has
waited longest for its credit. What a queue is owed at the end of a window stays owed in the next
one. A queue with share p is served its token j (from 0) when the common clock shows (j + 1/2) / p,
so the tokens sent by all queues up to any slot follow from the queue lengths alone. That is how the
deficits pass from one partition to the next: each task works out the state of the windows its
documents fall into, exactly as a sequential run would have left it. A dry queue drops out.

Windows are full, so nothing is padded but the rest of the corpus; that is cut into sequences whose
lengths are powers of two. A document is cut where its window ends.

Defined results: a null text is the empty text, a null source the empty source. Every document ends
with the given id, so none is without tokens. Queues are in the order of the stored token table.

Every source is a queue. Those of the ``MOST_QUEUES`` largest (sources with a target first) are known to every
task. All others are queues under one that stands for them and has the sum of their shares; its tokens go in the
order in which they are due by the same rule, source by source. That order is a distributed sort of these tokens, so
no number of sources meets in one task. Where there are targets, sources without one are apart from those with one.
A source under the common queue that runs dry leaves its share to the others there.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import running_starts, slices, task_count
from riskloom.llm.tokens import json_encoder
from riskloom.session import stored

WINDOW = 2048
MOST_QUEUES = 256
#: Tokens of a document that are rows of one batch.
MOST_AT_ONCE = 10_000
PIECES = (
    "doc_id bigint, source string, start bigint, length bigint, ids binary, "
    "doc_tokens bigint, sequence_id bigint, offset bigint"
)


class Mixture:
    """How many tokens each queue has sent before each window."""

    def __init__(self, lengths: np.ndarray, shares: np.ndarray, window: int = WINDOW):
        self.lengths, self.shares = lengths.astype(np.float64), shares.astype(np.float64)
        self.total, self.window = int(lengths.sum()), window
        full, rest = divmod(self.total, window)
        tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        self.full, self.tail = full, np.cumsum([full * window, *tail])
        self.windows = full + len(tail)
        # The clock at which each queue runs dry, and the tokens sent by then.
        dry = self.lengths / self.shares
        self._clock = np.concatenate([[0.0], np.sort(dry)])
        self._sent = np.minimum(self.lengths, self._clock[:, None] * self.shares).sum(axis=1)

    def edge(self, windows: np.ndarray) -> np.ndarray:
        """Tokens of all queues before each window."""
        inside = np.clip(windows - self.full, 0, len(self.tail) - 1)
        return np.where(windows <= self.full, windows * self.window, self.tail[inside])

    def sent(self, windows: np.ndarray) -> np.ndarray:
        """Tokens of every queue before each window: a row a window, whose sum is its edge."""
        edges = self.edge(windows)
        clock = np.interp(edges, self._sent, self._clock)[:, None]
        sent = np.minimum(self.lengths, np.floor(clock * self.shares + 0.5))
        missing = edges - sent.sum(axis=1)
        while len(todo := np.nonzero(missing)[0]):
            first, _, last, _ = self._ends(sent[todo])
            more = missing[todo] > 0
            sent[todo, np.where(more, first, last)] += np.where(more, 1, -1)
            missing[todo] -= np.where(more, 1, -1)
        # Exchange until no token was sent before one that is due earlier.
        todo = np.arange(len(sent))
        while len(todo):
            first, due, last, done = self._ends(sent[todo])
            wrong = (done > due) | ((done == due) & (last > first))
            todo, first, last = todo[wrong], first[wrong], last[wrong]
            sent[todo, first] += 1
            sent[todo, last] -= 1
        return sent.astype(np.int64)

    def _ends(self, sent: np.ndarray) -> tuple[np.ndarray, ...]:
        """The queue whose next token is due first and when; that of the token sent last and when."""
        rows = np.arange(len(sent))
        due = np.where(sent < self.lengths, (sent + 0.5) / self.shares, np.inf)
        done = np.where(sent > 0, (sent - 0.5) / self.shares, -np.inf)
        first = due.argmin(axis=1)
        last = done.shape[1] - 1 - done[:, ::-1].argmax(axis=1)
        return first, due[rows, first], last, done[rows, last]

    def window_near(self, queue: int, token: int) -> int:
        """The window of a queue's token, but for rounding."""
        edge = np.interp((token + 0.5) / self.shares[queue], self._clock, self._sent)
        if edge < self.full * self.window:
            return int(edge // self.window)
        return min(self.windows - 1, self.full + int(np.searchsorted(self.tail[1:], edge)))

    def cover(self, queue: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that hold the queue's tokens from ``low`` to ``high``, what each queue sent before
        each of them (and before the one after), and where the queue's part begins in each."""
        first, last = self.window_near(queue, low), self.window_near(queue, max(low, high - 1)) + 1
        reach = 1
        while True:
            first, last = max(0, first - reach), min(self.windows, last + reach)
            windows = np.arange(first, last + 1)
            sent = self.sent(windows)
            if (sent[0, queue] <= low or first == 0) and (sent[-1, queue] >= high or last == self.windows):
                break
            reach *= 2
        before = np.diff(sent[:, :queue], axis=0).sum(axis=1)
        return windows, sent[:, queue], before


def tokenized(df: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Stored ``doc_id, source, part, at, n, ids``: ``at`` counts earlier tokens of the source in this part."""
    rows = df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sent = TaskContext.get().partitionId(), {}
        encode = json_encoder(vocabulary)
        end = np.array([end_id], encode.kind).tobytes()
        for batch in slices(batches):
            sources = batch.column(2).to_pylist()
            ids = [encode(text) + end for text in batch.column(1).to_pylist()]
            counts, at = [len(i) // encode.kind.itemsize for i in ids], []
            for source, count in zip(sources, counts, strict=True):
                at.append(sent.get(source, 0))
                sent[source] = at[-1] + count
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([part] * len(ids), pa.int64()),
                    pa.array(at, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "source", "part", "at", "n", "ids"],
            )

    schema = "doc_id bigint, source string, part bigint, at bigint, n bigint, ids binary"
    return stored(rows.mapInArrow(run, schema))


def queues_of(tokens: DataFrame, targets: Mapping[str, float] | None) -> tuple[DataFrame, Mixture, int]:
    """``source, part, queue, before, share`` for the stored tokens, where ``before`` counts the tokens of the source
    in earlier parts; the mixture of the queues; and the number of the first queue that sources share."""
    spark = tokens.sparkSession
    parts = stored(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")))
    sources = parts.groupBy("source").agg(F.sum("n").alias("n"))
    wanted: Column = F.col("n").cast("double")
    if targets is not None:
        given = spark.createDataFrame([(k, float(v)) for k, v in targets.items() if v > 0], "source string, wanted double")
        sources, wanted = sources.join(F.broadcast(given), "source", "left"), F.coalesce("wanted", F.lit(0.0))
    sources = stored(sources.select("source", "n", wanted.alias("wanted")))
    largest = sources.orderBy(F.desc(F.col("wanted") > 0), F.desc("n"), "source")
    names = [r["source"] for r in largest.limit(MOST_QUEUES).collect()]
    numbered = spark.createDataFrame([(name, i) for i, name in enumerate(names)], "source string, queue int")
    # At most MOST_QUEUES rows.
    queued = sources.join(F.broadcast(numbered), "source", "left")
    common = F.when(F.col("wanted") > 0, len(names)).otherwise(len(names) + 1)
    queued = queued.withColumn("queue", F.coalesce("queue", common))
    # Sources without a target are equal among themselves.
    queued = queued.withColumn("share", F.when(F.col("wanted") > 0, F.col("wanted")).otherwise(F.lit(1.0)))
    queued = stored(queued.select("source", "queue", "n", "wanted", "share"))
    # A source has a row a part at most.
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    starts = starts.select("source", "part", "before").join(queued.select("source", "queue", "share"), "source")
    lengths, shares, members = np.zeros(len(names) + 2, np.int64), np.zeros(len(names) + 2), np.ones(len(names) + 2)
    sums = queued.groupBy("queue").agg(F.sum("n").alias("n"), F.sum("wanted").alias("wanted"), F.count(F.lit(1)).alias("m"))
    for row in sums.collect():
        lengths[row["queue"]], shares[row["queue"]], members[row["queue"]] = row["n"], row["wanted"], row["m"]
    kept = max(1, int(np.nonzero(lengths)[0].max(initial=0)) + 1)
    lengths, shares, members = lengths[:kept], shares[:kept], members[:kept]
    # A source without a target is served when all others are dry.
    shares = np.where(shares > 0, shares, members * 1e-9 * (max(1e-300, shares.max()) if targets is not None else 1.0))
    return stored(starts.select("source", "part", "queue", "before", "share")), Mixture(lengths, shares), len(names)


def shared_pieces(placed: DataFrame, mixture: Mixture, first: int, kind: np.dtype) -> DataFrame:
    """Pieces of the documents whose sources share a queue (those from ``first`` on)."""
    schema = "queue int, due double, source string, j bigint, doc_id bigint, start bigint, doc_tokens bigint, id bigint"

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every token with when it is due and its place in its source."""
        for batch in slices(batches):
            for row in range(batch.num_rows):
                doc_id, source, queue, share, at, n, ids = (c[row].as_py() for c in batch.columns)
                ids = np.frombuffer(ids, kind)
                for low in range(0, n, MOST_AT_ONCE):
                    start = np.arange(low, min(n, low + MOST_AT_ONCE))
                    same = [pa.array([v] * len(start), t) for v, t in ((queue, pa.int32()), (source, pa.string()), (doc_id, pa.int64()), (n, pa.int64()))]
                    arrays = [same[0], pa.array((at + start + 0.5) / share), same[1], pa.array(at + start), same[2], pa.array(start), same[3]]
                    arrays.append(pa.array(ids[start].astype(np.int64)))
                    yield pa.RecordBatch.from_arrays(arrays, names=["queue", "due", "source", "j", "doc_id", "start", "doc_tokens", "id"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            more = [pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.arange(place, place + batch.num_rows))]
            place += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "task", "place"])

    tokens = placed.select("doc_id", "source", "queue", "share", "at", "n", "ids").mapInArrow(single, schema)
    order = ["queue", "due", "source", "j"]
    dealt = tokens.repartitionByRange(task_count(placed), *order).sortWithinPartitions(*order)
    # Stored, as ranges are drawn anew by each run.
    ordered = stored(dealt.mapInArrow(counted, f"{schema}, task int, place bigint"))
    # A row a task.
    totals = running_starts(ordered.groupBy("task").agg(F.count(F.lit(1)).alias("n")), "n", "task")
    ordered = ordered.join(F.broadcast(totals.select("task", "before")), "task")
    ordered = ordered.select("queue", "source", "j", "doc_id", "start", "doc_tokens", "id", (F.col("before") + F.col("place")).alias("place"))
    earlier = np.cumsum(mixture.lengths[first:]) - mixture.lengths[first:]

    def in_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queue, place = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 7))
            place = place - earlier[queue - first].astype(np.int64)
            window, ahead = np.empty_like(place), np.empty_like(place)
            for number in np.unique(queue):
                mine = np.nonzero(queue == number)[0]
                windows, sent, before = mixture.cover(int(number), int(place[mine].min()), int(place[mine].max()) + 1)
                at = np.searchsorted(sent, place[mine], side="right") - 1
                window[mine], ahead[mine] = windows[at], before[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], pa.array(window), pa.array(ahead)],
                names=["queue", "source", "j", "doc_id", "start", "doc_tokens", "id", "sequence_id", "ahead"],
            )

    schema = "queue int, source string, j bigint, doc_id bigint, start bigint, doc_tokens bigint, id bigint, sequence_id bigint, ahead bigint"
    found = ordered.mapInArrow(in_windows, schema)
    # A window's tokens, of which a document has some that follow each other.
    inside = F.row_number().over(Window.partitionBy("sequence_id", "queue").orderBy("source", "j"))
    found = found.withColumn("offset", F.col("ahead") + inside - 1).withColumn("begin", F.col("j") - F.col("start"))
    pieces = found.groupBy("sequence_id", "queue", "source", "begin", "doc_id", "doc_tokens").agg(
        F.min("start").alias("start"),
        F.count(F.lit(1)).alias("length"),
        F.min("offset").alias("offset"),
        F.array_sort(F.collect_list(F.struct("start", "id"))).getField("id").alias("ids"),
    )

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([np.array(x, "<u4").tobytes() for x in batch.column(4).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], ids, *batch.columns[5:]], names=batch.schema.names)

    pieces = pieces.select("doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    return pieces.mapInArrow(as_bytes, PIECES)


def pieces_of(mixture: Mixture, queue: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cut documents that lie at these places of a queue: per piece the document's index, the place in
    the queue where it begins and ends, its window and its offset there."""
    low, high = int(starts.min()), int(ends.max())
    windows, sent, before = mixture.cover(queue, low, high)
    cuts = np.unique(sent[(sent > low) & (sent < high)])
    # A cut may lie between two documents of this batch that do not touch; such pieces are empty.
    first = np.searchsorted(cuts, starts, side="right")
    last = np.searchsorted(cuts, ends, side="left")
    counts = last - first + 1
    doc = np.repeat(np.arange(len(starts)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    edges = np.concatenate([cuts, [0]])
    begin = np.where(inside == 0, starts[doc], edges[np.maximum(first[doc] + inside - 1, 0)])
    end = np.where(inside == counts[doc] - 1, ends[doc], edges[np.minimum(first[doc] + inside, len(cuts))])
    at = np.searchsorted(sent, begin, side="right") - 1
    return doc, begin, end, windows[at], before[at] + begin - sent[at]


def pack(df: DataFrame, vocabulary: str, end_id: int, targets: Mapping[str, float] | None = None) -> DataFrame:
    """Pieces of all documents: ``doc_id, source, start, length, ids, doc_tokens, sequence_id, offset``.

    ``targets`` are wanted shares of tokens by source; by default the corpus's own, so that all queues
    end together. ``ids`` are little-endian unsigned 32-bit numbers.
    """
    tokens = tokenized(df, vocabulary, end_id)
    starts, mixture, first = queues_of(tokens, targets)
    # A (source, part) group is no larger than what one task reads. The stored starts have a known
    # size, so Spark broadcasts them only if they are small.
    placed = tokens.join(starts, ["source", "part"])
    placed = placed.withColumn("at", F.col("before") + F.col("at"))
    shared = placed.filter(F.col("queue") >= first)
    placed = placed.filter(F.col("queue") < first).select("doc_id", "source", "queue", "at", "n", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = json_encoder(vocabulary).kind
        for batch in batches:
            queue, at, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4))
            ids = [np.frombuffer(x, kind).astype("<u4").tobytes() for x in batch.column(5).to_pylist()]
            for number in np.unique(queue):
                mine = np.nonzero(queue == number)[0]
                doc, begin, end, window, offset = pieces_of(mixture, int(number), at[mine], at[mine] + n[mine])
                doc = mine[doc]
                start, length = begin - at[doc], end - begin
                cut = zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(doc)),
                        batch.column(1).take(pa.array(doc)),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array([ids[d][4 * s : 4 * (s + size)] for d, s, size in cut], pa.binary()),
                        pa.array(n[doc], pa.int64()),
                        pa.array(window, pa.int64()),
                        pa.array(offset, pa.int64()),
                    ],
                    names=["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    own = placed.mapInArrow(run, PIECES)
    if len(mixture.lengths) <= first:
        return own
    return own.union(shared_pieces(shared, mixture, first, json_encoder(vocabulary).kind))
