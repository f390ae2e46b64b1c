"""Exact top-k search by inner product: histogram selection of each query's k-th best score.

1. Vectors become whole numbers and are dealt into blocks, queries of ``QUERIES`` and candidates of ``CANDIDATES``,
   or of more where there would be more than ``BLOCKS`` (up to ``CELLS`` numbers). A pass scores every block of queries
   against every block of candidates by matrix products, and only counts leave the task. Query blocks are
   dealt to the tasks of the candidate blocks, so a pair meets by the order of a task's rows, without a join.
2. The first pass gives each query's lowest and highest score, and a score that k rows of some block reach, which
   no k-th best is below. Each later one counts the scores of the interval that holds the k-th best in ``BINS``
   equal bins, summed over all blocks, and narrows the interval to the bin that holds it, until the rows
   from there up are exactly k or the bin is one value.
3. If more rows share that value than fit, the same passes over their ids find the last id that fits.
4. A last pass emits the rows at or above each query's (score, id) limit: k a query, however many tie.

Queries are rows of a table throughout, so any number of them works; the driver only asks whether
some are still open. Arithmetic is exact: floats up to 2**24 and 2**53, Python's integers beyond.

Defined results: vectors that are null, or have null or non-finite components, take no part, nor do rows
without an id. Vectors meet those of their own length only. A query's own row is every row with its id;
of several rows with a query's id, the least vector asks. Repeated candidates count as often as they stand
there. Scores beyond 64 bits are held at the ends of that range. Fewer than k candidates: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import task_count
from riskloom.session import stored

#: Rows of a block, and from how many blocks on and up to how many numbers a block of candidates has more.
CANDIDATES = 512
QUERIES = 256
BLOCKS = 128
CELLS = 1 << 20
#: Scores that a task looks at together.
SCORES = 1 << 19
BINS = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1
SCORE, TIE, DONE = 0, 1, 2
STATE = "query_id bigint, stage int, low bigint, high bigint, need bigint, value bigint, last bigint"


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _blocks(df: DataFrame, size: int, blocks: int | None = None) -> tuple[DataFrame, int]:
    """Stored ``width, block, n, ids, vectors``: rows dealt by a hash of their id, into more than ``blocks`` blocks
    only where these would have more than ``CELLS`` numbers."""
    dealt = df.withColumn("width", F.size("vector"))
    rows, widest = dealt.agg(F.count(F.lit(1)), F.max("width")).head()
    if blocks:
        size = max(size, min(-(-rows // blocks), CELLS // max(1, widest or 1)))
    count = max(1, -(-rows // size))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int"))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        limit = np.finfo(np.float64).max
        whole = np.floor(np.clip(vectors.astype(np.float64), -limit / 1024, limit / 1024) * 1024)
        return pa.table(
            {
                "width": pa.array([key[0].as_py()], pa.int32()),
                "block": pa.array([key[1].as_py()], pa.int32()),
                "n": pa.array([table.num_rows], pa.int32()),
                "ids": pa.array([table.column("vec_id").to_numpy()], pa.list_(pa.int64())),
                "vectors": pa.array([whole.astype("<f8").tobytes()], pa.binary()),
            }
        )

    schema = "width int, block int, n int, ids array<bigint>, vectors binary"
    return stored(dealt.groupBy("width", "block").applyInArrow(gather, schema)), count


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers kept as floats, exact, as 64-bit integers."""
    if not queries.size or not candidates.size:
        return np.zeros((len(queries), len(candidates)), np.int64)
    bound = float(np.abs(queries).max()) * float(np.abs(candidates).max()) * queries.shape[1]
    if bound < 2**24:
        queries, candidates = queries.astype(np.float32), candidates.astype(np.float32)
    if bound < 2**53:
        return (queries @ candidates.T).astype(np.int64)
    exact = [[[int(x) for x in row] for row in side] for side in (queries, candidates)]
    products = [[sum(a * b for a, b in zip(q, c, strict=True)) for c in exact[1]] for q in exact[0]]
    return np.array([[min(MOST, max(LEAST, p)) for p in row] for row in products], np.int64)


def bin_width(low, high):
    return (high - low) // BINS + 1


class Search:
    """The passes over all pairs of blocks."""

    def __init__(self, queries: DataFrame, candidates: DataFrame, k: int):
        self.candidates, self.parts = _blocks(candidates, CANDIDATES, BLOCKS)
        self.queries, _ = _blocks(queries, QUERIES)
        self.k, self.tasks = k, min(self.parts, task_count(queries))

    def over_pairs(self, state: DataFrame | None, make, schema: str) -> DataFrame:
        """``make(ids, scores, query_ids, states)`` for pairs of a block of candidates and some queries of a block;
        ``states`` are the columns of ``state`` for these queries, and queries that are not open are left out."""
        fields = [f.split()[0] for f in STATE.split(", ")]
        if state is None:
            asked = self.queries.withColumn("states", F.lit(None).cast(f"array<struct<{STATE}>>"))
        else:
            # Which block a query is in follows from its id, so its state finds it there.
            members = self.queries.select("width", "block", F.explode("ids").alias("query_id"))
            per_block = state.join(members, "query_id").groupBy("width", "block")
            states = per_block.agg(F.collect_list(F.struct(*fields)).alias("states"))
            asked = self.queries.join(states.hint("merge"), ["width", "block"])
        to_all = F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))).alias("block")
        asked = asked.select("width", to_all, F.lit(True).alias("asks"), "ids", "vectors", "states")
        others = self.candidates.select("width", "block", F.lit(False).alias("asks"), "ids", "vectors", F.lit(None).alias("states"))
        # A join of the two would be planned by a guess at their sizes from before the explode, and broadcast all it gives.
        dealt = others.unionByName(asked).withColumn("task", F.pmod("block", F.lit(self.tasks)))
        dealt = dealt.repartitionById(self.tasks, "task").sortWithinPartitions("width", "block", "asks")
        dealt = dealt.select("width", "block", "asks", "ids", "vectors", "states")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of, ids, vectors = None, None, None
            for batch in batches:
                for i in range(batch.num_rows):
                    width, block, asks = (batch.column(c)[i].as_py() for c in (0, 1, 2))
                    own_ids = batch.column(3)[i].values.to_numpy()
                    own = np.frombuffer(batch.column(4)[i].as_buffer(), "<f8").reshape(len(own_ids), width)
                    if not asks:
                        of, ids, vectors = (width, block), own_ids.copy(), own.copy()
                    elif of == (width, block):
                        states = batch.column(5)[i].values
                        if states is not None:
                            states = {f: states.field(n).to_numpy() for n, f in enumerate(fields)}
                            order = states["query_id"].argsort()
                            states = {f: values[order] for f, values in states.items()}
                            open_ = np.flatnonzero(np.isin(own_ids, states["query_id"]))
                            open_ = open_[own_ids[open_].argsort()]
                            own_ids, own = own_ids[open_], own[open_]
                        step = max(1, SCORES // max(1, len(ids)))
                        for start in range(0, len(own_ids), step):
                            some = slice(start, start + step)
                            mine = states and {f: values[some] for f, values in states.items()}
                            yield make(ids, scores(own[some], vectors), own_ids[some], mine)

        return dealt.mapInArrow(run, schema)

    def ranges(self) -> DataFrame:
        """Per query the number of candidates, the least and greatest score, and one that k rows reach, if that is known."""
        k, names = self.k, ("query_id", "n", "low", "high", "reached")

        def make(ids, found, query_ids, _):
            n, low = np.full(len(query_ids), len(ids)), found.min(axis=1)
            for i in np.flatnonzero(np.isin(query_ids, ids)):
                others = ids != query_ids[i]
                n[i], low[i] = others.sum(), found[i][others].min(initial=MOST)
                found[i][~others] = LEAST
            high = reached = found.max(axis=1)
            if len(ids) >= k:
                # Each of k groups has a row that reaches its greatest score.
                reached = np.maximum.reduceat(found, np.arange(k) * len(ids) // k, axis=1).min(axis=1)
            columns = [pa.array(c) for c in (query_ids, n, low, high, reached)]
            if len(ids) < k:
                columns[-1] = pa.nulls(len(query_ids), pa.int64())
            return pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(n > 0))

        each = self.over_pairs(None, make, ", ".join(f"{n} bigint" for n in names))
        sums = [F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("reached").alias("reached")]
        return each.groupBy("query_id").agg(*sums)

    def histograms(self, state: DataFrame) -> DataFrame:
        """Per open query how many of its rows fall into each bin of its interval, best bin first."""
        names = [f"b{i}" for i in range(BINS)]

        def make(ids, found, query_ids, states):
            low, high, value, tie = states["low"], states["high"], states["value"], states["stage"] == TIE
            # A query that looks for the last of equal scores looks at one score, and at ids from low to high.
            inside = (found >= np.where(tie, value, low)[:, None]) & (found <= np.where(tie, value, high)[:, None])
            q, c = np.nonzero(inside)
            kept = ids[c] != query_ids[q]
            q, c = q[kept], c[kept]
            values = np.where(tie[q], ids[c], found[q, c])
            kept = (values >= low[q]) & (values <= high[q])
            q, values = q[kept], values[kept].astype(np.uint64)
            # Distances fit 64 bits unsigned, whatever the signs.
            low, high = low.astype(np.uint64), high.astype(np.uint64)
            from_best = np.where(tie[q], values - low[q], high[q] - values)
            bins = (from_best // bin_width(low, high)[q]).astype(np.int64)
            counts = np.bincount(q * BINS + bins, minlength=len(query_ids) * BINS).reshape(-1, BINS)
            columns = [pa.array(query_ids), *[pa.array(np.ascontiguousarray(c)) for c in counts.T]]
            return pa.RecordBatch.from_arrays(columns, names=["query_id", *names])

        each = self.over_pairs(state, make, ", ".join(["query_id bigint", *[f"{n} bigint" for n in names]]))
        return each.groupBy("query_id").agg(F.array(*[F.sum(n) for n in names]).alias("counts"))

    def above(self, state: DataFrame) -> DataFrame:
        """The rows at or above each query's limit."""

        def make(ids, found, query_ids, states):
            limit, last = states["value"][:, None], states["last"][:, None]
            inside = (found > limit) | ((found == limit) & (ids <= last))
            q, c = np.nonzero(inside & (ids != query_ids[:, None]))
            columns = [pa.array(query_ids[q]), pa.array(ids[c]), pa.array(found[q, c])]
            return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

        return self.over_pairs(state, make, "query_id bigint, vec_id bigint, score bigint")


def narrowed(state: dict, counts: list[int], first_id: int, last_id: int) -> dict:
    """A query's state after a pass: the bin that holds the row looked for, or its final limit."""
    before, at = 0, 0
    while before + counts[at] < state["need"]:
        before += counts[at]
        at += 1
    width = bin_width(state["low"], state["high"])
    need, inside = state["need"] - before, counts[at]
    if state["stage"] == SCORE:
        high = state["high"] - at * width
        low = max(state["low"], high - width + 1)
        if inside == need:
            return state | {"stage": DONE, "value": low, "last": MOST}
        if low == high:
            return state | {"stage": TIE, "value": low, "low": first_id, "high": last_id, "need": need}
    else:
        low = state["low"] + at * width
        high = min(state["high"], low + width - 1)
        if inside == need or low == high:
            return state | {"stage": DONE, "last": high}
    return state | {"low": low, "high": high, "need": need}


def top_k(df: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of each query, ties to the smaller id."""
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    rows = rows.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    queries = rows.filter("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    ends = rows.agg(F.min("vec_id"), F.max("vec_id")).head()
    first_id, last_id = (ends[0] or 0), (ends[1] or 0)
    search = Search(queries, rows.select("vec_id", "vector"), k)
    few = F.col("n") <= k
    state = stored(
        search.ranges().select(
            "query_id",
            F.when(few, DONE).otherwise(SCORE).alias("stage"),
            F.greatest("low", "reached").alias("low"),
            "high",
            F.lit(k).cast("bigint").alias("need"),
            F.col("low").alias("value"),
            F.lit(MOST).alias("last"),
        )
    )
    kinds = {"int": pa.int32(), "bigint": pa.int64()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, STATE.split(", "))])

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [narrowed(r, r.pop("counts"), first_id, last_id) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(out, fields)

    names = [f.name for f in fields]
    while state.filter(F.col("stage") < DONE).limit(1).count():
        asking = state.filter(F.col("stage") < DONE)
        counted = asking.join(search.histograms(asking), "query_id").select(*names, "counts")
        state = stored(counted.mapInArrow(advance, STATE).union(state.filter(F.col("stage") == DONE)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = search.above(state).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
