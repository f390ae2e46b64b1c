"""Random forests of any depth, each tree on its own bootstrap, for many settings and folds in the same passes.

* **Bootstraps.** A tree takes each row as often as a Poisson draw of mean one says. Draws are made by block of the
  stored rows and tree, so every pass, and every repetition of a lost task, sees the same ones. ``balanced_subsample`` weighs
  the classes of each tree by that tree's own draws.
* **Top of a tree.** While a node has more than ``WHOLE`` different rows, passes over the rows sum its draws per class in
  each bin of each feature. The sums meet in a grouped aggregate, the best cut of a node is found in a task, and the
  driver gets one row a node. A pass takes up to ``MOST_NODES`` nodes of all trees of all models.
* **Rest of a tree.** The rows of a node of at most ``WHOLE`` go to one task, which grows everything below it, level by
  level over all its nodes at once, however deep. There is no deepest level.

Cuts gain most by the Gini index among the square root of the number of features, drawn a node from those that can be cut at
all; equal gains go to the feature and bin listed first. Features are counted in the order in which a node draws
them, until enough of them can be cut. A node of one class, or too small, is a leaf, whose value is the weighted share of
positives. Draws are whole numbers, so trees do not depend on the order in which tasks end.
"""

from __future__ import annotations

import base64
import io
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.blocks import blocked, blocks_of
from riskloom.operators.boosting import Tree, cuts_of
from riskloom.session import TemporaryTables

#: Rows of a node that are few enough for one task.
WHOLE = 1 << 20
#: Nodes whose histograms a task holds at a time.
MOST_NODES = 1024
#: Bins of all nodes of a level that are looked at together, of one feature.
MOST_BINS = 1 << 20
#: Nodes whose sums a task sends in one batch.
SENT = 64
STATE = "id bigint, rows int, bins binary, y binary, fold binary"
SUBSAMPLE = "balanced_subsample"
#: What a task sends of the trees it grew.
PARTS = {"feature": "<i4", "threshold": "<i4", "left": "<i4", "value": "<f8"}


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers from any."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws_of(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often a tree takes each row of a block."""
    return np.random.default_rng([seed, tree, block]).poisson(1.0, n)


def nodes_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row (column of ``x``)."""
    at, rows = np.zeros(x.shape[1], int), np.arange(x.shape[1])
    while len(rows):
        feature = tree.feature[at[rows]]
        rows, feature = rows[feature >= 0], feature[feature >= 0]
        node = at[rows]
        below = x[feature, rows] <= tree.threshold[node]
        at[rows] = np.where(below, tree.left[node], tree.right[node])
    return at


class TreeMean:
    """Positive probabilities by the mean of the trees' leaves, for a matrix with a row a feature."""

    def __init__(self, trees: Sequence[Tree]):
        self.trees = trees

    def __call__(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(x.shape[1])
        for tree in self.trees:
            total += tree.value[nodes_of(tree, x)]
        return total / max(1, len(self.trees))


class ForestTrees(Model, HasFeaturesCol, HasProbabilityCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """The trees as a model on raw features, evaluated in Arrow batches."""

    trees = Param(Params._dummy(), "trees", "arrays of all trees, base64", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees: str = ""):
        super().__init__()
        self._setDefault(featuresCol="features", probabilityCol="probability", predictionCol="prediction")
        self._set(trees=trees)

    @staticmethod
    def of(trees: Sequence[Tree]) -> ForestTrees:
        file = io.BytesIO()
        parts = {c: np.concatenate([getattr(t, c) for t in trees] or [[]]) for c in ("feature", "threshold", "left", "right", "value")}
        np.savez_compressed(file, sizes=np.array([len(t.feature) for t in trees], int), **parts)
        return ForestTrees(trees=base64.b64encode(file.getvalue()).decode())

    def scorer(self) -> TreeMean:
        with np.load(io.BytesIO(base64.b64decode(self.getOrDefault(self.trees)))) as file:
            ends = np.cumsum(file["sizes"])[:-1]
            parts = [np.split(file[c], ends) for c in ("feature", "threshold", "left", "right", "value")]
        return TreeMean([Tree(*arrays) for arrays in zip(*parts, strict=True) if len(arrays[0])])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scorer = self.scorer()

        @F.pandas_udf("double")
        def positive(vectors: pd.Series) -> pd.Series:
            return pd.Series(scorer(np.stack(vectors.to_numpy()).T) if len(vectors) else [], dtype="float64")

        p = positive(vector_to_array(F.col(self.getFeaturesCol())))
        scored = dataset.withColumn(self.getProbabilityCol(), array_to_vector(F.array(1 - p, p)))
        flagged = vector_to_array(F.col(self.getProbabilityCol()))[1] > 0.5
        return scored.withColumn(self.getPredictionCol(), flagged.cast("double"))


@dataclass
class Rules:
    """What decides a cut, besides the sums."""

    weights: tuple[float, float]  # of a row of class 0, of class 1
    least: int
    deepest: int | None

    def closed(self, n: np.ndarray, draws: np.ndarray, depth: int) -> np.ndarray:
        """Whether nodes stay leaves: of one class, too small or deep enough. ``draws`` has a row a class."""
        small = (n < 2 * self.least) | (draws.min(axis=0) == 0)
        return small | (depth >= self.deepest) if self.deepest is not None else small

    def value(self, draws: np.ndarray) -> np.ndarray:
        weight = draws * np.array(self.weights)[:, None]
        return np.divide(weight[1], weight.sum(axis=0), out=np.zeros(draws.shape[1]), where=weight.sum(axis=0) > 0)


class Sums:
    """Rows, draws of class 0 and draws of class 1 by cell, in one count of packed numbers where they fit."""

    def __init__(self, draws: np.ndarray):
        self.bits = [int(n).bit_length() for n in (draws.shape[1], *draws.sum(axis=1))]
        # Doubles are exact up to 53 bits, and no cell holds more than all rows.
        if sum(self.bits) <= 53:
            shifts = np.cumsum([0, *self.bits[:2]])
            self.of_row = (np.int64(1) + (draws.astype(np.int64) << shifts[1:, None]).sum(axis=0)).astype(np.float64)[None]
        else:
            self.of_row = np.stack([np.ones(draws.shape[1]), *draws])

    def at(self, rows: np.ndarray, cell: np.ndarray, total: int) -> np.ndarray:
        """Of these rows, by their cells: an array (3, cells)."""
        found = [np.bincount(cell, w[rows], total).astype(np.int64) for w in self.of_row]
        if len(found) > 1:
            return np.stack(found)
        n, a, _ = self.bits
        return np.stack([found[0] & ((1 << n) - 1), (found[0] >> n) & ((1 << a) - 1), found[0] >> (n + a)])

    def keep(self, rows: np.ndarray) -> None:
        self.of_row = self.of_row[:, rows]


def best_bins(cells: np.ndarray, sizes: np.ndarray, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """Gain (-inf: none) and bin of the best cut of each run of cells; runs of these sizes lie end to end, ``cells`` has
    a row each for rows, draws of class 0, draws of class 1."""
    ends = np.cumsum(sizes)
    starts, run = ends - sizes, np.repeat(np.arange(len(sizes)), sizes)
    upto = np.cumsum(cells, axis=1)
    done = upto[:, starts] - cells[:, starts]
    left = upto - done[:, run]
    right = (upto[:, ends - 1] - done)[:, run] - left
    least = max(1, rules.least)
    fits = np.flatnonzero((left[0] >= least) & (right[0] >= least))
    score = np.full(cells.shape[1], -np.inf)
    score[fits] = 0.0
    for side in (left[:, fits], right[:, fits]):
        positive = side[2] * rules.weights[1]
        weight = positive + side[1] * rules.weights[0]
        score[fits] += np.divide(positive * positive, weight, out=np.zeros(len(fits)), where=weight > 0)
    gain = np.maximum.reduceat(score, starts)
    at = np.flatnonzero(score == gain[run])
    return gain, at[at.searchsorted(starts)] - starts


def best_cuts(
    counted: Callable[[np.ndarray, np.ndarray], np.ndarray], sizes: Sequence[int], keys: np.ndarray, rules: Rules
) -> tuple[np.ndarray, np.ndarray]:
    """Feature (-1: none) and bin of the best cut of each node.

    ``counted`` gives, for nodes and a feature of each, the cells of these features end to end.
    """
    count, sizes = len(keys), np.array(sizes)
    # A node's features in an order of its own; those that cannot be cut do not count.
    features = np.arange(len(sizes), dtype=np.uint64)[:, None]
    order = mixed(keys[None, :] + (features + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)).argsort(axis=0, kind="stable")
    gain, feature, at, able = np.full(count, -np.inf), np.full(count, -1), np.zeros(count, int), np.zeros(count, int)
    for turn in order:
        nodes = np.flatnonzero(able < max(1, isqrt(len(sizes))))
        if not len(nodes):
            break
        tried = turn[nodes]
        gains, bins = best_bins(counted(nodes, tried), sizes[tried], rules)
        can = np.isfinite(gains)
        able[nodes] += can
        better = can & ((gains > gain[nodes]) | ((gains == gain[nodes]) & (tried < feature[nodes])))
        into = nodes[better]
        gain[into], feature[into], at[into] = gains[better], tried[better], bins[better]
    return feature, at


def child_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of the two children of each node, side by side."""
    two = np.repeat(keys, 2) * np.uint64(2)
    two[1::2] += np.uint64(1)
    return mixed(two + np.uint64(0x9E3779B97F4A7C15))


def grown(bins: np.ndarray, draws: np.ndarray, sizes: Sequence[int], key: int, depth: int, rules: Rules) -> Tree:
    """The whole tree below a node, of its rows' bins (a row a feature) and draws (a row a class)."""
    keys, node = np.array([key], np.uint64), np.zeros(bins.shape[1], int)
    # A row's bins lie together: each level looks at other features of each row.
    bins, held, width = np.ascontiguousarray(bins.T), Sums(draws), np.array(sizes)
    feature, threshold, left, value = [], [], [], []
    made = 1
    while len(keys):
        count = len(keys)
        n, *sums = held.at(slice(None), node, count)
        sums = np.stack(sums)
        open_ = np.flatnonzero(~rules.closed(n, sums, depth))
        cut, at = np.full(count, -1), np.zeros(count, int)
        step = max(1, MOST_BINS // max(sizes))
        for low in range(0, len(open_), step):
            some = open_[low : low + step]
            place = np.full(count, -1)
            place[some] = np.arange(len(some))
            here = place[node]
            rows = np.flatnonzero(here >= 0)
            here = here[rows]

            def counted(nodes: np.ndarray, tried: np.ndarray, of=len(some), rows=rows, here=here) -> np.ndarray:
                starts, which = np.full(of, -1), np.zeros(of, int)
                ends = np.cumsum(width[tried])
                starts[nodes], which[nodes] = ends - width[tried], tried
                if len(nodes) < of:
                    asked = starts[here] >= 0
                    rows, here = rows[asked], here[asked]
                return held.at(rows, starts[here] + bins[rows, which[here]], int(ends[-1]))

            cut[some], at[some] = best_cuts(counted, sizes, keys[some], rules)
        inner = np.flatnonzero(cut >= 0)
        first = np.zeros(count, int)
        first[inner] = made + 2 * np.arange(len(inner))
        made += 2 * len(inner)
        feature.append(cut)
        threshold.append(at)
        left.append(first)
        value.append(rules.value(sums))
        # On to the children: the rows of leaves are done.
        number = np.full(count, -1)
        number[inner] = 2 * np.arange(len(inner))
        rows = np.flatnonzero(number[node] >= 0)
        was = node[rows]
        beyond = bins[rows, cut[was]] > at[was]
        bins, node = bins[rows], number[was] + beyond
        held.keep(rows)
        keys, depth = child_keys(keys[inner]), depth + 1
    first = np.concatenate(left)
    return Tree(np.concatenate(feature), np.concatenate(threshold), first, first + (first > 0), np.concatenate(value))


@dataclass
class Planned:
    """A tree while its top grows: nodes as lists, those to be looked at, those for one task each."""

    model: int
    number: int
    without: int | None
    rules: Rules
    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    keys: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=lambda: [0])
    waiting: list[int] = field(default_factory=list)
    whole: list[int] = field(default_factory=list)

    def top(self) -> Tree:
        left = np.array(self.left)
        return Tree(self.feature, self.threshold, left, left + (left > 0), self.value)

    def place(self, node: int, n: int, draws: Sequence[int], whole: int) -> None:
        """Decide how a node goes on, once its sums are known."""
        sums = np.array(draws)[:, None]
        self.value[node] = float(self.rules.value(sums)[0])
        if not self.rules.closed(np.array([n]), sums, self.depth[node])[0]:
            (self.whole if n <= whole else self.waiting).append(node)

    def cut(self, node: int, feature: int, at: int, sides: Sequence[tuple[int, list[int]]], whole: int) -> None:
        first = len(self.feature)
        self.feature[node], self.threshold[node], self.left[node] = feature, at, first
        keys = child_keys(np.array([self.keys[node]], np.uint64)).tolist()
        for side, (n, draws) in enumerate(sides):
            for into, what in ((self.feature, -1), (self.threshold, 0), (self.left, 0), (self.value, 0.0), (self.keys, keys[side])):
                into.append(what)
            self.depth.append(self.depth[node] + 1)
            self.place(first + side, n, draws, whole)

    def joined(self, below: Mapping[int, Tree]) -> Tree:
        """The top with what grew below its nodes."""
        tops = self.top()
        parts = {c: [getattr(tops, c)] for c in ("feature", "threshold", "left", "right", "value")}
        at = len(tops.feature)
        for node, tree in below.items():
            # The part's root takes the place of the node, its other nodes come behind.
            shift = lambda a, by: np.where(a > 0, a + by, 0)
            moved = Tree(tree.feature, tree.threshold, shift(tree.left, at - 1), shift(tree.right, at - 1), tree.value)
            for c, done in parts.items():
                done[0][node] = getattr(moved, c)[0]
                done.append(getattr(moved, c)[1:])
            at += len(tree.feature) - 1
        return Tree(*[np.concatenate(done) for done in parts.values()])


def _state(rows: DataFrame, cuts: Sequence[np.ndarray], label: str, seed: int) -> DataFrame:
    """Blocks of bins, with an id that draws hang on once the frame is stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in STATE.split(", ")]
        for i, block in enumerate(blocks_of(batches)):
            bins = np.stack([np.searchsorted(c, x, "left") for c, x in zip(cuts, block.x, strict=True)]).astype(np.uint8)
            number = (TaskContext.get().partitionId() << 32) + i
            data = [pa.array([b], pa.binary()) for b in (bins.tobytes(), block.y.tobytes(), block.fold.tobytes())]
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([block.n], pa.int32()), *data], names=names)

    return blocked(rows, label, seed).mapInArrow(run, STATE)


def drawn(batches: Iterator[pa.RecordBatch], seed: int, trees: Sequence[tuple[int, int | None]]):
    """For every block and tree (number, fold left out): position of the tree, bins and draws a class of the rows it takes."""
    for batch in batches:
        for i in range(batch.num_rows):
            block, n = batch.column("id")[i].as_py(), batch.column("rows")[i].as_py()
            bins = np.frombuffer(batch.column("bins")[i].as_buffer(), np.uint8).reshape(-1, n)
            y, fold = (np.frombuffer(batch.column(c)[i].as_buffer(), "<i4") for c in ("y", "fold"))
            times: dict[int, np.ndarray] = {}
            for place, (number, without) in enumerate(trees):
                if number not in times:
                    times[number] = draws_of(seed, number, block, n)
                use = times[number] > 0
                if without is not None:
                    use &= fold != without
                some = times[number][use]
                yield place, bins[:, use], np.stack([some * (y[use] != 1), some * (y[use] == 1)])


def draw_counts(state: DataFrame, seed: int, trees: Sequence[tuple[int, int | None]]) -> np.ndarray:
    """Of each tree: different rows, draws of class 0, draws of class 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(trees), 3), np.int64)
        for place, _, draws in drawn(batches, seed, trees):
            sums[place] += [draws.shape[1], *draws.sum(axis=1)]
        columns = [pa.array(np.arange(len(trees))), *map(pa.array, sums.T)]
        yield pa.RecordBatch.from_arrays(columns, names=["tree", "n", "a", "b"])

    each = state.mapInArrow(run, "tree bigint, n bigint, a bigint, b bigint")
    found = np.zeros((len(trees), 3), np.int64)
    for r in each.groupBy("tree").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")]).collect():
        found[r["tree"]] = [r["n"], r["a"], r["b"]]
    return found


def _cut_top(state: DataFrame, seed: int, plans: Sequence[Planned], sizes: Sequence[int], whole: int) -> None:
    """One pass: cut up to ``MOST_NODES`` nodes that are too large for one task."""
    asked: list[tuple[Planned, int]] = [(p, node) for p in plans for node in p.waiting][:MOST_NODES]
    active = list({id(p): p for p, _ in asked}.values())
    slots: list[dict[int, int]] = [{} for _ in active]
    position = {id(p): i for i, p in enumerate(active)}
    for slot, (p, node) in enumerate(asked):
        slots[position[id(p)]][node] = slot
    trees, tops = [(p.number, p.without) for p in active], [p.top() for p in active]
    rules, keys = [p.rules for p, _ in asked], [p.keys[node] for p, node in asked]
    per_node, first = sum(sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(asked_slots), 3, per_node), np.int64)
        for place, bins, draws in drawn(batches, seed, trees):
            at = nodes_of(tops[place], bins)
            wanted = np.full(len(tops[place].feature), -1)
            wanted[list(slots[place])] = np.arange(len(slots[place]))
            here = wanted[at]
            rows = np.flatnonzero(here >= 0)
            into, held = list(slots[place].values()), Sums(draws)
            for b, start, size in zip(bins, first, sizes, strict=True):
                found = held.at(rows, here[rows] * size + b[rows], len(into) * size)
                sums[into, :, start : start + size] += found.reshape(3, -1, size).transpose(1, 0, 2)
        met = np.flatnonzero(sums.any(axis=(1, 2)))
        for low in range(0, len(met), SENT):
            some = met[low : low + SENT]
            columns = [pa.array(some), pa.array([sums[slot].tobytes() for slot in some], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", "sums"])

    def best(table: pa.Table) -> pa.Table:
        slot, sums = table.column("slot")[0].as_py(), np.zeros((3, per_node), np.int64)
        for data in table.column("sums"):
            sums += np.frombuffer(data.as_buffer(), np.int64).reshape(3, per_node)
        parts = [sums[:, s : s + size] for s, size in zip(first, sizes, strict=True)]
        feature, at = best_cuts(lambda _, tried: parts[tried[0]], sizes, np.array([keys[slot]], np.uint64), rules[slot])
        chosen = parts[max(0, feature[0])]
        sides = [chosen[:, : at[0] + 1].sum(axis=1).tolist(), chosen[:, at[0] + 1 :].sum(axis=1).tolist()]
        return pa.table({"slot": [slot], "feature": [int(feature[0])], "bin": [int(at[0])], "sides": [sides]})

    asked_slots = range(len(asked))
    # A task sends the sums of a node as one value, so a node's group has a row a task.
    found = state.mapInArrow(run, "slot bigint, sums binary").groupBy("slot").applyInArrow(
        best, "slot bigint, feature bigint, bin bigint, sides array<array<bigint>>"
    )
    for p, node in asked:
        p.waiting.remove(node)
    for r in found.collect():
        p, node = asked[r["slot"]]
        if r["feature"] >= 0:
            p.cut(node, r["feature"], r["bin"], [(s[0], s[1:]) for s in r["sides"]], whole)


def _finish(state: DataFrame, seed: int, plans: Sequence[Planned], sizes: Sequence[int]) -> list[dict[int, Tree]]:
    """What grows below the nodes that one task can hold, a group a node."""
    trees, tops = [(p.number, p.without) for p in plans], [p.top() for p in plans]
    whole = [p.whole for p in plans]
    settled = [{node: (p.keys[node], p.depth[node]) for node in p.whole} for p in plans]
    rules, width = [p.rules for p in plans], len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, bins, draws in drawn(batches, seed, trees):
            if not whole[place]:
                continue
            at = nodes_of(tops[place], bins)
            # Small numbers are sorted by their digits.
            order = at.astype(np.min_scalar_type(len(tops[place].feature))).argsort(kind="stable")
            data, at = np.concatenate([bins, draws.astype(np.uint8)])[:, order], at[order]
            nodes = np.array(whole[place])
            ends = zip(nodes.tolist(), at.searchsorted(nodes), at.searchsorted(nodes, "right"), strict=True)
            parts = [(node, data[:, low:high].tobytes()) for node, low, high in ends if low < high]
            if parts:
                columns = [pa.array([place] * len(parts)), pa.array([p[0] for p in parts]), pa.array([p[1] for p in parts], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "data"])

    def grow(table: pa.Table) -> pa.Table:
        tree, node = (table.column(c)[0].as_py() for c in ("tree", "node"))
        data = np.concatenate([np.frombuffer(d.as_buffer(), np.uint8).reshape(width + 2, -1) for d in table.column("data")], axis=1)
        key, depth = settled[tree][node]
        made = grown(data[:width], data[width:], sizes, key, depth, rules[tree])
        columns = {c: pa.array([getattr(made, c).astype(kind).tobytes()], pa.binary()) for c, kind in PARTS.items()}
        return pa.table({"tree": [tree], "node": [node]} | columns)

    schema = "tree bigint, node bigint, " + ", ".join(f"{c} binary" for c in PARTS)
    # The groups are small but long at work, so their tasks are not put together by size.
    tasks = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = state.mapInArrow(run, "tree bigint, node bigint, data binary").repartition(tasks, "tree", "node")
    groups = dealt.groupBy("tree", "node")
    below: list[dict[int, Tree]] = [{} for _ in plans]
    for r in sorted(groups.applyInArrow(grow, schema).toArrow().to_pylist(), key=lambda r: (r["tree"], r["node"])):
        feature, threshold, left, value = (np.frombuffer(r[c], kind) for c, kind in PARTS.items())
        below[r["tree"]][r["node"]] = Tree(feature, threshold, left, left + (left > 0), value)
    return below


def tree_weights(params: Mapping, weights: Mapping[int, float], draws: Sequence[int]) -> tuple[float, float]:
    """Weights of the classes in one tree: those of the fit, or of the tree's own bootstrap."""
    if params["class_weight"] != SUBSAMPLE:
        return float(weights.get(0, 0.0)), float(weights.get(1, 0.0))
    present = [d for d in draws if d]
    return tuple(float(sum(draws) / (len(present) * d)) if d else 0.0 for d in draws)


def each_forest(
    rows: DataFrame,
    settings: Sequence[tuple[Mapping, Mapping[int, float], int | None]],
    label: str,
    seed: int = 42,
    whole: int = WHOLE,
) -> Iterator[TreeMean]:
    """The forest of each (settings, weight per class, fold to leave out or None), from an assembled frame, one by one.

    The tops of all forests grow in the same passes, what is below them forest by forest, so the driver holds the
    nodes of one whole forest at a time, unless the caller keeps more.
    ``whole`` bounds the rows of a node that go to one task; it changes how trees are grown, never which.
    """
    width = len(rows.select("features").first()[0])
    cuts = cuts_of(rows, width)
    sizes = [len(c) + 1 for c in cuts]
    with TemporaryTables(rows.sparkSession) as tables:
        state = tables.stored(_state(rows, cuts, label, seed))
        trees = [(i, n, without) for i, (params, _, without) in enumerate(settings) for n in range(params["n_estimators"])]
        plans = []
        for (i, number, without), (n, *draws) in zip(trees, draw_counts(state, seed, [t[1:] for t in trees]).tolist(), strict=True):
            params, weights, _ = settings[i]
            rules = Rules(tree_weights(params, weights, draws), params["min_samples_leaf"], params["max_depth"])
            root = mixed(np.array([(seed << 32) + number], np.uint64))[0]
            plans.append(Planned(i, number, without, rules, keys=[int(root)]))
            plans[-1].place(0, n, draws, whole)
        while any(p.waiting for p in plans):
            _cut_top(state, seed, plans, sizes, whole)
        for i in range(len(settings)):
            yield _forest(state, seed, [p for p in plans if p.model == i], cuts)


def _forest(state: DataFrame, seed: int, plans: Sequence[Planned], cuts: Sequence[np.ndarray]) -> TreeMean:
    """One forest, thresholds as values."""
    made = []
    for p, parts in zip(plans, _finish(state, seed, plans, [len(c) + 1 for c in cuts]), strict=True):
        tree = p.joined(parts)
        real = np.zeros(len(tree.feature))
        for f, c in enumerate(cuts):
            here = tree.feature == f
            real[here] = c[tree.threshold[here]]
        made.append(Tree(tree.feature, real, tree.left, tree.right, tree.value))
    return TreeMean(made)


def fit_forest(
    rows: DataFrame,
    settings: Sequence[tuple[Mapping, Mapping[int, float], int | None]],
    label: str,
    seed: int = 42,
    whole: int = WHOLE,
) -> list[ForestTrees]:
    """The forests of ``each_forest`` as models."""
    return [ForestTrees.of(forest.trees) for forest in each_forest(rows, settings, label, seed, whole)]
