"""Boosted trees of second order, grown leaf by leaf from histograms, for many settings and folds in the same passes.

A pass over the rows gives, for the nodes that the growing trees ask for, sums of gradient, second derivative and rows
in each bin of each feature. The driver keeps these histograms (a bounded number of numbers a node), finds the best cut
of each node and decides what to ask next:

* Of two new siblings only the one of fewer rows is summed; the other is the parent less that one.
* A tree grows best leaf first: of all leaves the one whose best cut gains most is cut, up to ``LEAVES`` leaves. A pass
  asks for the children of every leaf that the cuts known so far would reach; leaves only learnt of later can take such
  a place, never give one. So a tree takes as many passes as it is deep, not as many as it has cuts.
* Of a node of at most ``SMALL`` rows the bins and gradients of the rows are asked for instead; what grows below it is
  then settled at once, by the same sums.
* All models of a search ask in the same pass, each at its own tree and depth.

Gradients are rounded to whole multiples of a small unit before they are summed, so sums do not depend on the order in
which tasks end, and a lost executor changes nothing. Leaves get the Newton value, times the learning rate. A
tenth of the rows, drawn by their values, is held back; a model stops when ``PATIENCE`` rounds have not lowered its loss.

Every ``STORED_EVERY`` trees each row's margins are written to a new table, which the next passes read. Between two such
tables rows find their leaves by ``Lookup``: one gather a feature and tree, however many nodes the tree has.

Where the rows of every model are at most ``WHOLE * SMALL`` numbers, no passes are taken: the bins go once to a task for
each model, which grows all its trees by the same steps, and so the same trees. Beyond that a task's memory would grow with the rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from heapq import heappop, heappush
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.blocks import Block, blocked, blocks_of
from riskloom.session import TemporaryTables

# Bins of a feature, leaves of a tree, least second derivative of a leaf, rounds without gain.
BINS = 255
LEAVES = 31
LEAST_HESSIAN = 1e-3
PATIENCE = 10
TOLERANCE = 1e-7
#: Trees that are evaluated again in each pass, at most.
STORED_EVERY = 8
#: Rows of a node that are few enough to go to the driver: a tree has at most LEAVES such nodes at a time.
SMALL = 2048
#: A model whose rows have at most so many times SMALL numbers is grown whole in one task.
WHOLE = 1 << 14
#: Rows whose sums are taken together: exact in floating point, and few enough to stay in a core's cache.
TOGETHER = 1 << 16
#: Rows whose sums for all features are taken at once.
FEW_ROWS = 2048
#: Up to so many tasks the driver adds their sums itself; beyond, they meet in a grouped aggregate first.
FEW_TASKS = 32
#: Key of such a task's sums.
PACKED = -1
#: Unit of gradients: 2**-UNIT_BITS of the greatest weight, coarser where sums of all rows would not fit 64 bits.
UNIT_BITS = 32
HELD_BACK = 0
STATE = "rows int, bins binary, y binary, fold binary, draw binary, margins binary"


class Tree:
    """Nodes as arrays; a leaf has feature -1. Rows at or below the threshold go left."""

    def __init__(self, feature=(), threshold=(), left=(), right=(), value=()):
        self.feature, self.threshold = np.array(feature, int), np.array(threshold)
        self.left, self.right, self.value = np.array(left, int), np.array(right, int), np.array(value, float)

    def parts(self, x: np.ndarray, wanted: set[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Nodes (the leaves, or those wanted) with the numbers of the rows (columns of ``x``) in them."""
        waiting = [(0, np.arange(x.shape[1]))]
        while waiting:
            node, rows = waiting.pop()
            if node in wanted if wanted is not None else self.feature[node] < 0:
                yield node, rows
            if self.feature[node] >= 0 and len(rows):
                below = x[self.feature[node]][rows] <= self.threshold[node]
                waiting += [(self.left[node], rows[below]), (self.right[node], rows[~below])]

    def add_to(self, margin: np.ndarray, x: np.ndarray) -> None:
        for leaf, rows in self.parts(x):
            margin[rows] += self.value[leaf]

    def reachable(self) -> Tree:
        """The tree without nodes that no row reaches, numbered from the root down, left side first."""
        order, waiting = [], [0]
        while waiting:
            node = waiting.pop()
            order.append(node)
            if self.feature[node] >= 0:
                waiting += [self.right[node], self.left[node]]
        place = np.zeros(len(self.feature), int)
        place[order] = np.arange(len(order))
        inner = self.feature[order] >= 0
        left, right = (np.where(inner, place[side[order]], 0) for side in (self.left, self.right))
        return Tree(self.feature[order], self.threshold[order], left, right, self.value[order])

    def as_lists(self) -> list[list]:
        return [a.tolist() for a in (self.feature, self.threshold, self.left, self.right, self.value)]


class Lookup:
    """The leaves of rows of bins, for a tree of at most 64 leaves, without walking down.

    Leaves have a bit each, from the left. A cut that sends a row to the right rules out the leaves on its left, so a table
    for each feature says which leaves a bin leaves possible. The first one possible by all features is the row's.
    """

    def __init__(self, tree: Tree):
        feature, left, right = tree.feature.tolist(), tree.left.tolist(), tree.right.tolist()
        leaves, cuts = [], []
        waiting: list[tuple[int, int | None]] = [(0, None)]
        while waiting:
            node, low = waiting.pop()
            if low is not None:  # its left side is done
                cuts.append((node, low, len(leaves)))
            elif feature[node] < 0:
                leaves.append(node)
            else:
                waiting += [(right[node], None), (node, len(leaves)), (left[node], None)]
        self.tree, self.leaves = tree, np.array(leaves)
        self.values = tree.value[self.leaves]
        self.kind = np.uint32 if len(leaves) <= 32 else np.uint64
        every = int(np.iinfo(self.kind).max)
        self.tables: dict[int, np.ndarray] = {}
        for node, low, high in cuts if len(leaves) <= 64 else ():
            table = self.tables.setdefault(feature[node], np.full(256, every, self.kind))
            table[int(tree.threshold[node]) + 1 :] &= self.kind(every ^ ((1 << high) - (1 << low)))

    def __call__(self, bins: np.ndarray) -> np.ndarray:
        """For each row (column of ``bins``) the place of its leaf in ``leaves``."""
        if len(self.leaves) > 64:
            found, place = np.zeros(bins.shape[1], int), {n: i for i, n in enumerate(self.leaves.tolist())}
            for leaf, rows in self.tree.parts(bins):
                found[rows] = place[leaf]
            return found
        if not self.tables:
            return np.zeros(bins.shape[1], int)
        possible = None
        for feature, table in self.tables.items():
            by = table.take(bins[feature])
            possible = by if possible is None else np.bitwise_and(possible, by, out=possible)
        # A power of two has its exponent as its logarithm.
        first = possible & (~possible + self.kind(1))
        return (first.astype(np.float64).view(np.int64) >> 52) - 1023

    def add_to(self, margin: np.ndarray, bins: np.ndarray) -> None:
        margin += self.values.take(self(bins))


def trees_as_json(start: float, trees: Sequence[Tree]) -> str:
    return json.dumps([start, [t.as_lists() for t in trees]])


class TreeSum:
    """Positive probabilities by a sum of trees, for a matrix with a row a feature."""

    def __init__(self, start: float, trees: Sequence[Tree]):
        self.start, self.trees = start, trees
        self.cuts: list[np.ndarray] = []
        self.lookups: list[Lookup] | None = None

    def _prepare(self, features: int) -> None:
        """The thresholds of each feature, and the trees with places among them instead; trees as they are where there are too many."""
        used = np.concatenate([t.feature for t in self.trees]) if self.trees else np.zeros(0, int)
        at = np.concatenate([t.threshold for t in self.trees]) if self.trees else np.zeros(0)
        self.cuts, self.lookups = [np.unique(at[used == f]) for f in range(features)], []
        if max(map(len, self.cuts), default=0) <= BINS:
            for t in self.trees:
                places = [self.cuts[f].searchsorted(c) if f >= 0 else 0 for f, c in zip(t.feature.tolist(), t.threshold.tolist(), strict=True)]
                self.lookups.append(Lookup(Tree(t.feature, np.array(places, int), t.left, t.right, t.value)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.lookups is None:
            self._prepare(len(x))
        margin = np.full(x.shape[1], self.start)
        if self.lookups:
            x = np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x, strict=True)]).astype(np.uint8)
        for tree in self.lookups or self.trees:
            tree.add_to(margin, x)
        return np.exp(-np.logaddexp(0, -margin))


class BoostedTrees(Model, HasFeaturesCol, HasProbabilityCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """The sum of trees as a model on raw features, evaluated in Arrow batches."""

    trees = Param(Params._dummy(), "trees", "intercept and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees: str = "[0.0, []]"):
        super().__init__()
        self._setDefault(featuresCol="features", probabilityCol="probability", predictionCol="prediction")
        self._set(trees=trees)

    @staticmethod
    def of(start: float, trees: Sequence[Tree]) -> BoostedTrees:
        return BoostedTrees(trees=trees_as_json(start, trees))

    def scorer(self) -> TreeSum:
        start, trees = json.loads(self.getOrDefault(self.trees))
        return TreeSum(start, [Tree(*lists) for lists in trees])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scorer = self.scorer()

        @F.pandas_udf("double")
        def positive(vectors: pd.Series) -> pd.Series:
            return pd.Series(scorer(np.stack(vectors.to_numpy()).T) if len(vectors) else [], dtype="float64")

        p = positive(vector_to_array(F.col(self.getFeaturesCol())))
        scored = dataset.withColumn(self.getProbabilityCol(), array_to_vector(F.array(1 - p, p)))
        flagged = vector_to_array(F.col(self.getProbabilityCol()))[1] > 0.5
        return scored.withColumn(self.getPredictionCol(), flagged.cast("double"))


def cuts_of(rows: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Thresholds per feature: between neighbouring values where there are few, else approximate quantiles."""
    rows, x = rows.select(vector_to_array("features").alias("x")), F.col("x")
    # A finer estimate would make the aggregate's row thousands of columns wide.
    about = [F.approx_count_distinct(x[i], 0.05) for i in range(width)]
    shares = [i / bins for i in range(1, bins)]
    quantiles = [F.percentile_approx(x[i], shares, 20 * bins) for i in range(width)]
    found = rows.agg(F.array(*about), F.array(*quantiles)).first()
    few = [i for i in range(width) if found[0][i] <= 1.5 * bins]
    # Few by the estimate, which is off by a few per cent, so the sets are bounded.
    sets = rows.agg(*[F.collect_set(x[i]).alias(str(i)) for i in few]).first() if few else ()
    cuts = [np.unique(np.array(q or [], float)) for q in found[1]]
    for i, values in zip(few, sets, strict=True):
        values = np.unique(np.array(values, float))
        if len(values) <= bins:
            cuts[i] = (values[1:] + values[:-1]) / 2
    return cuts


class Node:
    def __init__(self, depth: int, sums: np.ndarray):
        self.depth, self.sums = depth, sums  # gradient, second derivative, rows
        self.histogram = self.rows = self.cut = self.left = self.right = None
        self.gain = 0.0


class Rows:
    """Bins, and gradient and second derivative, of the rows of a node (a row each): all, or those at the places ``which``.

    Row by row, for the rows of a deep node lie far apart."""

    def __init__(self, bins: np.ndarray, values: np.ndarray, which: np.ndarray | None = None):
        self.bins, self.values = bins, values
        self.which = np.arange(len(bins)) if which is None else which

    @staticmethod
    def read(data: Sequence[bytes], features: int) -> Rows:
        """From what tasks sent."""
        parts = [np.frombuffer(d, np.uint8).reshape(features + 16, -1) for d in data]
        bins = [np.ascontiguousarray(p[:features].T) for p in parts]
        values = [np.ascontiguousarray(p[features:].reshape(-1).view("<i8").reshape(2, -1).T) for p in parts]
        return Rows(
            np.concatenate(bins) if parts else np.zeros((0, features), np.uint8),
            np.concatenate(values) if parts else np.zeros((0, 2), int),
        )

    def sent(self) -> bytes:
        return self.bins[self.which].T.tobytes() + self.values[self.which].T.astype("<i8").tobytes()

    def part(self, some: np.ndarray) -> Rows:
        return Rows(self.bins, self.values, self.which[some])

    def feature(self, number: int) -> np.ndarray:
        return self.bins[self.which, number]

    def histogram(self, ends: np.ndarray) -> np.ndarray:
        """Sums of gradient, second derivative and rows in each bin of each feature, one feature after the other."""
        total, firsts = int(ends[-1]), np.r_[0, ends[:-1]]
        sums = np.zeros((3, total), np.int64)
        for start in range(0, len(self.which), TOGETHER):
            some = self.which[start : start + TOGETHER]
            bins, (g, h) = self.bins.take(some, axis=0), self.values.take(some, axis=0).T.astype(np.float64)
            if len(some) <= FEW_ROWS:
                cells = (bins + firsts).ravel()
                for i, w in enumerate((g, h, None)):
                    sums[i] += np.bincount(cells, None if w is None else np.repeat(w, len(ends)), total).astype(np.int64)
                continue
            # Exact in floating point: few rows of 32-bit numbers.
            for of_feature, first, end in zip(bins.T, firsts.tolist(), ends.tolist(), strict=True):
                cells = of_feature.astype(np.intp)
                for i, w in enumerate((g, h, None)):
                    sums[i, first:end] += np.bincount(cells, w, end - first).astype(np.int64)
        return sums


def gradients(y: np.ndarray, margin: np.ndarray, of_label: np.ndarray, unit: float) -> np.ndarray:
    """Gradient and second derivative of each row, in whole units."""
    p = np.exp(-np.logaddexp(0, -margin))
    w = of_label[(y == 1).astype(int)]
    return np.rint(np.stack([w * (p - y), w * p * (1 - p)]) / unit)


def slot_sums(into: np.ndarray, slot: np.ndarray, bins: np.ndarray, values: np.ndarray, ends: np.ndarray) -> None:
    """Add to ``into`` (slots, 3, bins of all features) the gradients, second derivatives and number of rows, by slot and bin."""
    g, h = values.astype(np.float64)
    first = 0
    for of_feature, end in zip(bins, ends.tolist(), strict=True):
        size = end - first
        cells = slot * size + of_feature
        for i, w in enumerate((g, h, None)):
            # Exact in floating point: the rows of a block, of 32-bit numbers.
            into[:, i, first:end] += np.bincount(cells, w, len(into) * size).astype(np.int64).reshape(-1, size)
        first = end


class Growing:
    """One model: its finished trees, and the tree it grows."""

    def __init__(self, params: Mapping, weights: Mapping[int, float], without: int | None, start: float, cuts, unit: float, most: int):
        self.params, self.weights, self.without = params, weights, without
        self.start, self.cuts, self.unit, self.leaves = start, cuts, unit, LEAVES
        self.sizes = np.array([len(c) + 1 for c in cuts])
        self.ends = np.cumsum(self.sizes)
        self.inside = np.ones(int(self.ends[-1]), bool)
        self.inside[self.ends - 1] = False
        self.trees: list[Tree] = []
        self.stored = 0
        self.losses: list[float] = []
        self.open = params["max_iter"] > 0
        self.nodes: list[Node] = []
        #: What the next pass gives: nodes, their parents (the root has none), and whether as rows or as sums.
        self.at_root: list[tuple[int, int | None, bool]] = [(0, None, most <= SMALL)]
        self.asked = self.at_root

    def best_cut(self, node: Node) -> None:
        """The cut of the node that gains most: feature, bin, and the left side's sums."""
        if node.depth >= (self.params["max_depth"] or 1 << 30):
            return
        g, h = node.sums[:2] * self.unit
        least = self.params["min_samples_leaf"]
        # Running sums within each feature; the last bin of a feature is no place for a cut.
        upto = np.cumsum(node.histogram, axis=1)
        left = upto - np.repeat(np.c_[np.zeros(3, np.int64), upto[:, self.ends[:-1] - 1]], self.sizes, axis=1)
        gl, hl = left[:2] * self.unit
        gr, hr = g - gl, h - hl
        fits = self.inside & (left[2] >= least) & (node.sums[2] - left[2] >= least) & (hl >= LEAST_HESSIAN) & (hr >= LEAST_HESSIAN)
        if not fits.any():
            return
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = np.where(fits, gl * gl / hl + gr * gr / hr - g * g / h, -np.inf)
        at = int(gains.argmax())
        if gains[at] > node.gain:
            feature = int(self.ends.searchsorted(at, "right"))
            node.gain, node.cut = float(gains[at]), (feature, at - int(self.ends[feature] - self.sizes[feature]), left[:, at])

    def reached(self) -> tuple[list[Node], list[Node]]:
        """Best leaf first with the cuts known: the nodes to be cut, and those of them without children yet."""
        taken, childless = [], []
        heap = [(-self.nodes[0].gain, 0)]
        while heap and len(taken) + 1 < self.leaves:
            gain, number = heappop(heap)
            if gain >= 0:
                break
            node = self.nodes[number]
            taken.append(node)
            if node.left is None:
                childless.append(node)
            else:
                for child in (node.left, node.right):
                    heappush(heap, (-self.nodes[child].gain, child))
        return taken, childless

    def take(self, found: Sequence[np.ndarray | Rows], loss: float) -> None:
        """Go on with what was asked for; ``loss`` is that of the rows held back, before this tree."""
        if self.asked is self.at_root:
            self.losses.append(loss)
            if self._stalled():
                self.open = False
                return
        for (number, parent, _), answer in zip(self.asked, found, strict=True):
            rows = answer if isinstance(answer, Rows) else None
            histogram = rows.histogram(self.ends) if rows else answer
            if parent is None:
                self.nodes = [Node(0, histogram[:, : self.ends[0]].sum(axis=1))]
            else:
                node = self.nodes[parent]
                other = node.right if number == node.left else node.left
                self._settle(other, node.histogram - histogram, None)
                node.histogram = None
            self._settle(number, histogram, rows)
        self.asked = []
        while True:
            taken, childless = self.reached()
            if not childless:
                break
            for node in childless:
                self._cut(node)
        if not self.asked:
            self._finish(taken)

    def _settle(self, number: int, histogram: np.ndarray, rows: Rows | None) -> None:
        node = self.nodes[number]
        node.histogram, node.rows = histogram, rows
        self.best_cut(node)

    def _cut(self, node: Node) -> None:
        """Give the node its children, and settle them or ask for the one with fewer rows."""
        feature, at, left = node.cut
        number, node.left, node.right = self.nodes.index(node), len(self.nodes), len(self.nodes) + 1
        right = node.sums - left
        self.nodes += [Node(node.depth + 1, left), Node(node.depth + 1, right)]
        if node.depth + 1 >= (self.params["max_depth"] or 1 << 30) or max(left[2], right[2]) < 2 * self.params["min_samples_leaf"]:
            return  # neither child can be cut
        if node.rows:
            below = node.rows.feature(feature) <= at
            parts = {node.left: node.rows.part(below), node.right: node.rows.part(~below)}
            fewer, other = sorted(parts, key=lambda child: self.nodes[child].sums[2])
            histogram = parts[fewer].histogram(self.ends)
            self._settle(fewer, histogram, parts[fewer])
            self._settle(other, node.histogram - histogram, parts[other])
            node.rows = node.histogram = None
        else:
            fewer = node.left if left[2] <= right[2] else node.right
            self.asked.append((fewer, number, int(min(left[2], right[2])) <= SMALL))

    def _finish(self, taken: Sequence[Node]) -> None:
        self.trees.append(self.partial(taken).reachable())
        self.open = len(self.trees) < self.params["max_iter"]
        self.nodes, self.asked = [], self.at_root

    def _stalled(self) -> bool:
        if len(self.losses) <= PATIENCE or not np.isfinite(self.losses[-1]):
            return False
        return min(self.losses[-PATIENCE:]) > self.losses[-PATIENCE - 1] - TOLERANCE

    def partial(self, taken: Sequence[Node] | None = None) -> Tree:
        """The tree of the nodes that are cut so far (or those taken), thresholds as bins and nodes numbered alike."""
        if taken is None:
            taken = [n for n in self.nodes if n.left is not None]
        cut = {id(n) for n in taken}
        rate = self.params["learning_rate"]
        inner = [id(n) in cut for n in self.nodes]
        return Tree(
            [n.cut[0] if i else -1 for n, i in zip(self.nodes, inner, strict=True)],
            [n.cut[1] if i else 0 for n, i in zip(self.nodes, inner, strict=True)],
            [n.left if i else 0 for n, i in zip(self.nodes, inner, strict=True)],
            [n.right if i else 0 for n, i in zip(self.nodes, inner, strict=True)],
            [0.0 if i or not n.sums[1] else -rate * n.sums[0] / n.sums[1] for n, i in zip(self.nodes, inner, strict=True)],
        )

    def as_json(self) -> str:
        """The finished trees as the model has them."""
        trees = []
        for t in self.trees:
            real = [self.cuts[f][b] if f >= 0 else 0.0 for f, b in zip(t.feature.tolist(), t.threshold.tolist(), strict=True)]
            trees.append(Tree(t.feature, np.array(real, float), t.left, t.right, t.value))
        return trees_as_json(self.start, trees)

    def grow_whole(self, bins: np.ndarray, y: np.ndarray, draw: np.ndarray) -> None:
        """All trees, from all rows that the model may see; bins row by row."""
        of_label = np.array([self.weights.get(0, 0.0), self.weights.get(1, 0.0)])
        at = [np.flatnonzero(draw != HELD_BACK), np.flatnonzero(draw == HELD_BACK)]
        (used, back), (y_used, y_back) = [bins[rows] for rows in at], [y[rows] for rows in at]
        w_back = of_label[(y_back == 1).astype(int)]
        margin, margin_back = (np.full(len(rows), self.start) for rows in at)
        weight = np.rint(w_back / (1000 * self.unit)).sum()
        while self.open:
            done = len(self.trees)
            loss = np.rint(w_back * (np.logaddexp(0, margin_back) - y_back * margin_back) / (1000 * self.unit)).sum()
            values = np.empty((len(margin), 2))
            for start in range(0, len(margin), TOGETHER):
                some = slice(start, start + TOGETHER)
                values[some] = gradients(y_used[some], margin[some], of_label, self.unit).T
            self.take([Rows(used, values)], loss / weight if weight else np.inf)
            for tree in map(Lookup, self.trees[done:]):
                for into, of in ((margin, used), (margin_back, back)):
                    for start in range(0, len(into), TOGETHER):
                        some = slice(start, start + TOGETHER)
                        tree.add_to(into[some], of[some].T)

    def model(self) -> BoostedTrees:
        return BoostedTrees(trees=self.as_json())


class _State:
    """A block of the state table."""

    def __init__(self, batch: pa.RecordBatch, i: int, models: int):
        self.n = batch.column("rows")[i].as_py()
        get = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
        self.bins = get("bins", np.uint8).reshape(-1, self.n)
        self.y, self.fold, self.draw = get("y", np.int8), get("fold", "<i4"), get("draw", np.int8)
        self.margins = get("margins", "<f8").reshape(models, self.n).copy()


def _states(batches: Iterator[pa.RecordBatch], models: int) -> Iterator[tuple[pa.RecordBatch, int, _State]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch, i, _State(batch, i, models)


def _binned(rows: DataFrame, cuts: Sequence[np.ndarray], starts: Sequence[float], label: str, seed: int) -> DataFrame:
    def of(block: Block) -> list:
        bins = np.stack([np.searchsorted(c, x, "left") for c, x in zip(cuts, block.x, strict=True)]).astype(np.uint8)
        margins = np.repeat(np.array(starts, "<f8")[:, None], block.n, axis=1)
        return [block.n, bins.tobytes(), block.y.astype(np.int8).tobytes(), block.fold.tobytes(), block.draw.astype(np.int8).tobytes(), margins.tobytes()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in STATE.split(", ")]
        for block in blocks_of(batches):
            n, *data = of(block)
            columns = [pa.array([n], pa.int32()), *[pa.array([d], pa.binary()) for d in data]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return blocked(rows, label, seed).mapInArrow(run, STATE)


def _moved_on(state: DataFrame, models: int, new: Sequence[Sequence[Tree]]) -> DataFrame:
    """The state with the margins of more trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = [[Lookup(tree) for tree in trees] for trees in new]
        for batch, i, block in _states(batches, models):
            for margin, trees in zip(block.margins, lookups, strict=True):
                for tree in trees:
                    tree.add_to(margin, block.bins)
            columns = [batch.column(c).slice(i, 1) for c in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([block.margins.tobytes()], pa.binary())], names=batch.schema.names)

    return state.mapInArrow(run, STATE)


def _pass(state: DataFrame, tasks: int, models: Sequence[Growing], unit: float, ends: np.ndarray) -> tuple[list, np.ndarray]:
    """What the models ask for, in order, and each model's loss and weight of the rows held back."""
    asked = []
    for number, m in enumerate(models):
        if m.open:
            wanted = [(node, as_rows) for node, _, as_rows in m.asked]
            tree = None if m.asked is m.at_root else m.partial()
            asked.append((number, m.without, dict(m.weights), m.trees[m.stored :], tree, wanted))
    of_slot = [as_rows for a in asked for _, as_rows in a[-1]]
    slots, per_node, count, features = len(of_slot), int(ends[-1]), len(models), len(ends)
    few = tasks <= FEW_TASKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((slots, 3, per_node), np.int64)
        losses = np.zeros((count, 3), np.int64)
        sent: list[tuple[int, bytes]] = []
        ready, slot = [], 0
        for number, without, weights, trees, tree, wanted in asked:
            # Which of the wanted nodes each leaf is; those beyond the last are none.
            leaves = Lookup(tree) if tree else None
            order = {node: i for i, (node, _) in enumerate(wanted)}
            which = np.array([order.get(n, len(wanted)) for n in (leaves.leaves.tolist() if tree else [0])])
            of_label = np.array([weights.get(0, 0.0), weights.get(1, 0.0)])
            ready.append((number, without, of_label, [Lookup(t) for t in trees], leaves, which, [r for _, r in wanted], slot))
            slot += len(wanted)
        for _, _, block in _states(batches, count):
            for number, without, of_label, trees, leaves, which, as_rows, slot in ready:
                margin = block.margins[number]
                for done in trees:
                    done.add_to(margin, block.bins)
                use = block.draw != HELD_BACK
                if without is not None:
                    use &= block.fold != without
                if leaves is None:
                    back = block.draw == HELD_BACK
                    if without is not None:
                        back &= block.fold != without
                    y, m = block.y[back], margin[back]
                    w = of_label[(y == 1).astype(int)]
                    loss = np.logaddexp(0, m) - y * m
                    # Losses are rounded as gradients are, to a thousand times their unit.
                    held = [np.rint((w * loss) / (1000 * unit)).sum(), np.rint(w / (1000 * unit)).sum(), 0]
                    losses[number] += np.array(held).astype(np.int64)
                    rows = np.flatnonzero(use)
                    at = np.zeros(len(rows), int)
                else:
                    at = which.take(leaves(block.bins))
                    rows = np.flatnonzero(use & (at < len(as_rows)))
                    at = at[rows]
                values = gradients(block.y[rows], margin[rows], of_label, unit).astype(np.int64)
                bins = block.bins[:, rows]
                for i in [i for i, whole in enumerate(as_rows) if whole]:
                    sent.append(((slot + i) * per_node, Rows(bins.T, values.T).part(at == i).sent()))
                if not all(as_rows):
                    summed = np.flatnonzero(~np.array(as_rows))
                    if len(summed) < len(as_rows):
                        place = np.full(len(as_rows), -1)
                        place[summed] = np.arange(len(summed))
                        at = place[at]
                        some = at >= 0
                        at, bins, values = at[some], bins[:, some], values[:, some]
                    part = np.zeros((len(summed), 3, per_node), np.int64)
                    slot_sums(part, at, bins, values, ends)
                    sums[slot + summed] += part
        flat = np.concatenate([sums.transpose(0, 2, 1).reshape(-1, 3), losses])
        keys = np.flatnonzero(flat.any(axis=1))
        if few:
            # As one value, for rows of numbers cost the driver more than their sums.
            sent.append((PACKED, np.c_[keys, flat[keys]].astype("<i8").tobytes()))
            keys = keys[:0]
        numbers = [pa.array(np.r_[c, np.zeros(len(sent), int)]) for c in flat[keys].T]
        key = pa.array(np.r_[keys, np.array([k for k, _ in sent], int)])
        data = pa.array([None] * len(keys) + [d for _, d in sent], pa.binary())
        yield pa.RecordBatch.from_arrays([key, *numbers, data], names=["key", "g", "h", "n", "data"])

    each = state.mapInArrow(run, "key bigint, g bigint, h bigint, n bigint, data binary")
    if not few:
        sums = [F.sum(c).alias(c) for c in ("g", "h", "n")]
        each = each.groupBy("key").agg(*sums, F.collect_list("data").alias("data"))
    else:
        each = each.withColumn("data", F.when(F.col("data").isNotNull(), F.array("data")).otherwise(F.array().cast("array<binary>")))
    rows = each.toArrow()
    flat = np.zeros((slots * per_node + count, 3), np.int64)
    keys = rows.column("key").to_numpy()
    if not few:
        flat[keys] = np.stack([rows.column(c).to_numpy() for c in ("g", "h", "n")], axis=1)
    data: dict[int, list[bytes]] = {}
    for at in np.flatnonzero(pc.list_value_length(rows.column("data")).to_numpy()).tolist():
        values = rows.column("data")[at].as_py()
        if keys[at] == PACKED:
            cells = np.frombuffer(values[0], "<i8").reshape(-1, 4)
            flat[cells[:, 0]] += cells[:, 1:]
        else:
            data.setdefault(int(keys[at]) // per_node, []).extend(values)
    sums = flat[: slots * per_node].reshape(slots, per_node, 3).transpose(0, 2, 1)
    found = [Rows.read(data.get(slot, []), features) if as_rows else sums[slot] for slot, as_rows in enumerate(of_slot)]
    return found, flat[slots * per_node :]


def _grown_whole(binned: DataFrame, models: Sequence[Growing]) -> list[BoostedTrees]:
    """The models, each grown in a task of its own; those with the most trees to grow begin first."""
    turns = sorted((i for i, m in enumerate(models) if m.open), key=lambda i: -models[i].params["max_iter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                number = turns[batch.column("turn")[i].as_py()]
                n, *data = (batch.column(c)[i] for c in ("rows", "bins", "y", "fold", "draw"))
                bins, y, fold, draw = (np.frombuffer(d.as_buffer(), kind) for d, kind in zip(data, (np.uint8, np.int8, "<i4", np.int8), strict=True))
                kept = fold != (-2 if models[number].without is None else models[number].without)
                parts.append((np.ascontiguousarray(bins.reshape(-1, n.as_py())[:, kept].T), y[kept], draw[kept]))
        if parts:
            models[number].grow_whole(*(np.concatenate(each) for each in zip(*parts, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([models[number].as_json()])], names=["number", "trees"])

    found = {}
    if turns:
        turn = F.explode(F.sequence(F.lit(0), F.lit(len(turns) - 1))).alias("turn")
        dealt = binned.select(turn, "rows", "bins", "y", "fold", "draw").repartitionById(len(turns), "turn")
        found = {r["number"]: r["trees"] for r in dealt.mapInArrow(run, "number int, trees string").collect()}
    return [BoostedTrees(trees=found[i]) if i in found else m.model() for i, m in enumerate(models)]


def fit_boosting(
    rows: DataFrame,
    settings: Sequence[tuple[Mapping, Mapping[int, float], int | None]],
    label: str,
    seed: int = 42,
    watch: Callable[[int], None] | None = None,
) -> list[BoostedTrees]:
    """A model for each (settings, weight per class, fold to leave out or None), from an assembled frame."""
    width = len(rows.select("features").first()[0])
    by = ["fold"] if "fold" in rows.columns else []
    counts = {(r["fold"] if by else None, r[label]): r["count"] for r in rows.groupBy(*by, label).count().collect()}
    cuts = cuts_of(rows, width)
    ends = np.cumsum([len(c) + 1 for c in cuts])
    greatest = max(max(weights.values()) for _, weights, _ in settings)
    unit = greatest * 2.0 ** -min(UNIT_BITS, 61 - sum(counts.values()).bit_length())
    models, most = [], 0
    for params, weights, without in settings:
        n = {c: sum(k for (fold, label_), k in counts.items() if label_ == c and (without is None or fold != without)) for c in (0, 1)}
        of = {c: n[c] * weights.get(c, 0.0) for c in (0, 1)}
        start = log(of[1] / of[0]) if of[0] and of[1] else 0.0
        models.append(Growing(params, weights, without, start, cuts, unit, sum(n.values())))
        models[-1].open &= bool(of[0] and of[1])
        most = max(most, sum(n.values()))
    if most * width <= WHOLE * SMALL:
        if watch:
            watch(1)
        return _grown_whole(_binned(rows, cuts, [], label, seed), models)
    passes = 0
    with TemporaryTables(rows.sparkSession) as tables:
        state = tables.stored(_binned(rows, cuts, [m.start for m in models], label, seed))
        tasks = state.rdd.getNumPartitions()
        while any(m.open for m in models):
            if max(len(m.trees) - m.stored for m in models) >= STORED_EVERY:
                new = [m.trees[m.stored :] if m.open else [] for m in models]
                state = tables.stored(_moved_on(state, len(models), new))
                tables.drop_all_but_last()
                for m in models:
                    m.stored = len(m.trees)
            found, losses = _pass(state, tasks, models, unit, ends)
            passes += 1
            slot = 0
            for m, (loss, weight, _) in zip(models, losses, strict=True):
                if m.open:
                    asked = len(m.asked)
                    m.take(found[slot : slot + asked], loss / weight if weight else np.inf)
                    slot += asked
    if watch:
        watch(passes)
    return [m.model() for m in models]
