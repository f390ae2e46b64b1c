"""Hard negatives by exact inner products in a residue number system.

1. Equal rows are folded with their count, vectors become whole numbers, and rows are dealt into blocks: a label falls
   into one of ``LABEL_GROUPS`` groups, each group into as many blocks as its rows need.
2. Scores of a block of anchors against a block of rows come from matrix products modulo several primes, in float32.
   Residues are symmetric, so a product of at most ``DEEPEST`` components stays below 2**24 and is exact; longer vectors
   are multiplied piece by piece. Mixed-radix digits give the signed score back. How many primes are taken follows
   from the two blocks' greatest components, so that twice the greatest possible score fits.
3. The first pass meets blocks of an anchor's own label group only and takes the best rows of its label (positives).
4. The second one meets all blocks. For each positive the rows of another label are taken whose score lies between two
   percentages of the positive's, best first: of each block the first few, of these the first few.

The set of anchors is a table like any other. A task holds two blocks at a time and gives away a few rows an anchor.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors meet
those of their own length only. Products of a component and the scale beyond a double's range are held at its ends,
scores beyond 64 bits at theirs. An anchor's own row is no candidate; other rows of its id are. Equal rows count as
candidates as often as they stand there (so a positive may come twice, each with its negatives), and ask once. Of rows
that share id and score, the order is that of a hash of the row. No positive in range of a negative, or none at all:
no rows, as for an empty table. Where a positive's score is negative, no score lies in its window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from math import isqrt, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import stored

SCALE = 256
#: Most rows and components of a block, on average over a label group.
CANDIDATES = 16_384
ANCHORS = 64
COMPONENTS = 1 << 20
LABEL_GROUPS = 16
DEEPEST = 1024
EXACT = 1 << 24
LEAST, MOST = -(1 << 63), (1 << 63) - 1
BLOCK = "width int, part int, ids array<bigint>, rows array<bigint>, labels array<bigint>, copies array<bigint>, greatest double, vectors binary"


@lru_cache(maxsize=16)
def primes_below(limit: int) -> list[int]:
    """Odd primes below the limit, greatest first."""
    sieve = np.ones(limit, bool)
    sieve[:3] = False
    sieve[4::2] = False
    for p in range(3, isqrt(limit) + 1, 2):
        sieve[p * p :: p] &= not sieve[p]
    return np.flatnonzero(sieve)[::-1].tolist()


def moduli(greatest: int, width: int) -> tuple[list[int], int]:
    """Primes whose product exceeds twice the greatest absolute score, and the components multiplied at a time."""
    depth = max(1, min(width, DEEPEST))
    while True:
        # Residues are at most half a prime, and ``depth`` products of two must stay below 2**24.
        taken, range_ = [], 1
        for p in primes_below(2 * isqrt((EXACT - 1) // depth)):
            taken.append(p)
            range_ *= p
            if range_ > 2 * greatest:
                return taken, depth
        depth = max(1, depth // 2)


def symmetric(values: np.ndarray, p: int) -> np.ndarray:
    """Remainders between -p/2 and p/2."""
    rest = np.fmod(values, p)
    return rest - p * (rest > p // 2) + p * (rest < -(p // 2))


def residue_product(left: np.ndarray, right: np.ndarray, p: int, depth: int) -> np.ndarray:
    """``left @ right.T`` modulo p for whole numbers kept as doubles, by products in float32."""
    a, b = symmetric(left, p).astype(np.float32), symmetric(right, p).astype(np.float32)
    total = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, a.shape[1], depth):
        total += (a[:, at : at + depth] @ b[:, at : at + depth].T).astype(np.int64)
    return symmetric(total, p)


def from_residues(residues: Sequence[np.ndarray], primes: Sequence[int]) -> np.ndarray:
    """The signed numbers with these remainders, held at the ends of 64 bits."""
    digits = []
    for r, p in zip(residues, primes, strict=True):
        known, weight = np.zeros_like(r), 1
        for digit, q in zip(digits, primes, strict=False):
            known += digit * weight
            known, weight = symmetric(known, p), weight * q % p
        digits.append(symmetric(symmetric(r - known, p) * pow(weight, -1, p), p))
    wide = prod(primes) >= 1 << 62
    value = np.zeros(residues[0].shape, object if wide else np.int64)
    weight = 1
    for digit, p in zip(digits, primes, strict=True):
        value = value + (digit.astype(object) if wide else digit) * weight
        weight *= p
    return np.clip(value, LEAST, MOST).astype(np.int64) if wide else value


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers kept as doubles, as 64-bit integers."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    greatest = int(np.abs(left).max()) * int(np.abs(right).max()) * left.shape[1]
    primes, depth = moduli(greatest, left.shape[1])
    return from_residues([residue_product(left, right, p, depth) for p in primes], primes)


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    limit = np.finfo(np.float64).max / scale
    return np.floor(np.clip(values.astype(np.float64), -limit, limit) * scale)


class Block:
    """A stored block: ids, row hashes, labels, copies and vectors, ordered by id and row hash."""

    def __init__(self, batch: pa.RecordBatch, i: int, names: Sequence[str]):
        self.ids, self.rows, self.labels, self.copies = (batch.column(n)[i].values.to_numpy() for n in names[:4])
        data, width = batch.column(names[4])[i].as_buffer(), batch.column("width")[i].as_py()
        kind = "<f4" if len(data) == 4 * len(self.ids) * width else "<f8"
        self.vectors = np.frombuffer(data, kind).reshape(len(self.ids), width).astype(np.float64)


class Blocks:
    """Rows dealt into blocks by label group and hash; ``frame`` is stored."""

    def __init__(self, rows: DataFrame, size: int, scale: int):
        group = F.pmod(F.xxhash64("label"), F.lit(LABEL_GROUPS)).cast("int")
        rows = rows.withColumn("group", group)
        sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("vector")).alias("components"))
        found = {r["group"]: max(-(-r["n"] // size), -(-r["components"] // COMPONENTS)) for r in sizes.collect()}
        counts = [found.get(g, 0) for g in range(LABEL_GROUPS)]
        self.total = sum(counts)
        #: First block and number of blocks of each label group.
        self.spans = [(sum(counts[:g]), n) for g, n in enumerate(counts)]

        def of_group(values: Sequence[int]) -> Column:
            return F.element_at(F.array(*map(F.lit, values)), F.col("group") + 1)

        first, number = (of_group(values) for values in zip(*self.spans, strict=True))
        part = first + F.pmod(F.xxhash64("row", F.lit(1)), F.greatest(number, F.lit(1))).cast("int")
        dealt = rows.withColumn("part", part).withColumn("width", F.size("vector"))

        def gather(key: tuple, table: pa.Table) -> pa.Table:
            table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
            vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            whole = whole_numbers(vectors, scale)
            greatest = float(np.abs(whole).max(initial=0))
            kind = "<f4" if greatest < EXACT else "<f8"
            lists = [table.column(c).to_numpy() for c in ("vec_id", "row", "label", "copies")]
            columns = [[key[0].as_py()], [key[1].as_py()], *[[x] for x in lists], [greatest], [whole.astype(kind).tobytes()]]
            types = [pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 4, pa.float64(), pa.binary()]
            names = [f.split()[0] for f in BLOCK.split(", ")]
            return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        self.frame = stored(dealt.drop("group").groupBy("width", "part").applyInArrow(gather, BLOCK))


FOUND = "anchor_id bigint, anchor_row bigint, positive bigint, positive_id bigint, positive_score bigint, vec_id bigint, row bigint, score bigint"
_FOUND = pa.schema([(f.split()[0], pa.int64()) for f in FOUND.split(", ")])


def _first(order: np.ndarray, copies: np.ndarray, k: int) -> np.ndarray:
    """The first k of the ordered rows, each as often as it stands there."""
    some = order[:k]
    return np.repeat(some, np.minimum(copies[some], k))[:k]


def _over_pairs(asked: DataFrame, rows: Blocks, take: Callable) -> DataFrame:
    """``take(asking, block, scores, states)`` over pairs of blocks gives lists of result rows."""
    fields = ["ids", "rows", "labels", "copies", "vectors"]
    left = asked.select("width", "part", *[F.col(c).alias(f"asking_{c}") for c in fields], "states")
    pairs = left.join(rows.frame.select("width", "part", *fields), ["width", "part"]).drop("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asking, block = Block(batch, i, [f"asking_{c}" for c in fields]), Block(batch, i, fields)
                found = take(asking, block, exact_scores(asking.vectors, block.vectors), batch.column("states")[i].as_py())
                columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_FOUND)

    return pairs.mapInArrow(run, FOUND)


def _best(found: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; the window is in per cent."""
    low, high = window
    label = F.col(label) if isinstance(label, str) else label
    rows = df.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        label.cast("bigint").alias("label"),
        F.col(vector).alias("vector"),
        is_anchor.alias("asks"),
    )
    rows = rows.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    folded = rows.groupBy("vec_id", "label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.max("asks").alias("asks"))
    folded = stored(folded.withColumn("row", F.xxhash64("vec_id", "label", "vector")))
    every = Blocks(folded.drop("asks"), CANDIDATES, scale)
    anchors = Blocks(folded.filter("asks").drop("asks"), ANCHORS, scale)

    def asked(of_anchors: DataFrame, places: Column) -> DataFrame:
        """The blocks of anchors, once for each block of rows that they meet."""
        return of_anchors.withColumn("part", F.explode(places))

    def best_of_label(asking: Block, block: Block, scores: np.ndarray, _: None) -> list[list[np.ndarray]]:
        out = []
        for i in range(len(asking.ids)):
            own = (block.ids == asking.ids[i]) & (block.rows == asking.rows[i])
            copies = np.where(block.labels == asking.labels[i], block.copies - own, 0)
            some = np.flatnonzero(copies > 0)
            taken = _first(some[np.argsort(~scores[i][some], kind="stable")], copies, positives)
            if len(taken):
                same = np.ones(len(taken), np.int64)
                head = [asking.ids[i] * same, asking.rows[i] * same, 0 * same, 0 * same, 0 * same]
                out.append([*head, block.ids[taken], block.rows[taken], scores[i][taken]])
        return out

    # Which blocks of rows have an anchor block's labels follows from the block's number.
    own_group = F.lit(None).cast("array<int>")
    for (first, number), (start, size) in zip(anchors.spans, every.spans, strict=True):
        if number and size:
            inside = (F.col("part") >= first) & (F.col("part") < first + number)
            own_group = F.when(inside, F.sequence(F.lit(start), F.lit(start + size - 1))).otherwise(own_group)
    first_pass = asked(anchors.frame.withColumn("states", F.lit(None).cast("array<int>")), own_group)
    near = _best(_over_pairs(first_pass, every, best_of_label), ["anchor_id", "anchor_row"], positives)
    near = stored(
        near.select(
            "anchor_id",
            "anchor_row",
            F.col("rank").cast("bigint").alias("positive"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
    )

    def in_window(asking: Block, block: Block, scores: np.ndarray, states: list[dict]) -> list[list[np.ndarray]]:
        wanted: dict[tuple[int, int], list[dict]] = {}
        for s in states:
            wanted.setdefault((s["anchor_id"], s["anchor_row"]), []).append(s)
        out = []
        for i, key in enumerate(zip(asking.ids.tolist(), asking.rows.tolist(), strict=True)):
            if key not in wanted:
                continue
            limits = [(-(-low * s["positive_score"] // 100), high * s["positive_score"] // 100) for s in wanted[key]]
            inside = (scores[i] >= min(least for least, _ in limits)) & (scores[i] <= max(most for _, most in limits))
            order = np.flatnonzero(inside & (block.labels != asking.labels[i]))
            # The complement ascends where the score descends, and does not overflow.
            order = order[np.argsort(~scores[i][order], kind="stable")]
            ranked = ~scores[i][order]
            for s, (least, most) in zip(wanted[key], limits, strict=True):
                if most < least:
                    continue
                part = slice(np.searchsorted(ranked, ~most, "left"), np.searchsorted(ranked, ~least, "right"))
                taken = _first(order[part], block.copies, negatives)
                if len(taken):
                    same = np.ones(len(taken), np.int64)
                    head = [s[c] * same for c in ("anchor_id", "anchor_row", "positive", "positive_id", "positive_score")]
                    out.append([*head, block.ids[taken], block.rows[taken], scores[i][taken]])
        return out

    members = anchors.frame.select("width", "part", F.inline(F.arrays_zip(F.col("ids"), F.col("rows"))))
    members = members.withColumnsRenamed({"ids": "anchor_id", "rows": "anchor_row"})
    states = near.join(members, ["anchor_id", "anchor_row"]).groupBy("width", "part")
    states = states.agg(F.collect_list(F.struct(*near.columns)).alias("states"))
    everywhere = F.sequence(F.lit(0), F.lit(max(0, every.total - 1)))
    second_pass = asked(anchors.frame.join(states, ["width", "part"]), everywhere)
    keys = ["anchor_id", "anchor_row", "positive", "positive_id", "positive_score"]
    return _best(_over_pairs(second_pass, every, in_window), keys, negatives).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
