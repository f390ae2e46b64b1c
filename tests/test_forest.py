"""Forests against a grower that looks at every cut of every node, their bootstraps, weights and depth."""

import random
import weakref

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import forest, models
from riskloom.session import TemporaryTables

PARAMS = {"n_estimators": 4, "max_depth": None, "min_samples_leaf": 1, "class_weight": None}


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(7)
    data = []
    for i in range(400):
        a, b, c = draw.randrange(12), draw.gauss(0, 1), draw.randrange(3)
        data.append((int(a + 2 * b + draw.gauss(0, 1.5) > 8), float(a), float(round(b, 1)), float(c), i % 3))
    df = spark.createDataFrame(data, "isFraud int, a double, b double, c double, fold int")
    return models.assembled(df, ["a", "b", "c"], keep=["fold"]).repartition(3).cache()


def by_hand(bins, draws, sizes, key, depth, rules):
    """Nested (feature, bin, below, beyond) or leaf value, one node after the other."""
    key = np.array([key], np.uint64)
    whole = draws.sum(axis=1)
    leaf = float(whole[1] * rules.weights[1] / (whole * rules.weights).sum())
    if bins.shape[1] < 2 * rules.least or not whole.all() or (rules.deepest is not None and depth >= rules.deepest):
        return leaf
    able = {}
    for f, size in enumerate(sizes):
        for at in range(size - 1):
            below = bins[f] <= at
            if min(below.sum(), (~below).sum()) >= rules.least:
                score = 0.0
                for side in (below, ~below):
                    n = draws[:, side].sum(axis=1) * rules.weights
                    score += n[1] ** 2 / n.sum() if n.sum() else 0.0
                if f not in able or score > able[f][0]:
                    able[f] = (score, at)
    if not able:
        return leaf
    order = {f: int(forest.mixed(key + np.array([f + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]) for f in able}
    some = sorted(able, key=order.get)[: max(1, int(len(sizes) ** 0.5))]
    f = min(some, key=lambda g: (-able[g][0], g))
    at = able[f][1]
    keys = forest.child_keys(key).tolist()
    parts = [by_hand(bins[:, s], draws[:, s], sizes, k, depth + 1, rules) for s, k in zip((bins[f] <= at, bins[f] > at), keys, strict=True)]
    return (f, at, *parts)


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return float(tree.value[node])
    return (int(tree.feature[node]), int(tree.threshold[node]), nested(tree, tree.left[node]), nested(tree, tree.right[node]))


@pytest.mark.parametrize(("least", "deepest", "width"), [(1, None, 2), (4, None, 5), (1, 3, 4)])
def test_a_tree_equals_one_by_hand(least, deepest, width):
    draw = np.random.default_rng(least * 10 + width)
    bins = draw.integers(0, 9, (width, 150)).astype(np.uint8)
    times, y = draw.poisson(1, 150) + 1, draw.random(150) < 0.3
    draws, rules = np.stack([times * ~y, times * y]), forest.Rules((1.0, 3.0), least, deepest)
    got = forest.grown(bins, draws, [9] * width, 99, 0, rules)
    assert same(nested(got), by_hand(bins, draws, [9] * width, 99, 0, rules))


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3])
    return not isinstance(a, tuple) and not isinstance(b, tuple) and a == pytest.approx(b, abs=1e-12)


def test_growing_the_top_in_passes_changes_nothing(table, monkeypatch):
    settings = [(PARAMS, {0: 1.0, 1: 5.0}, None), ({**PARAMS, "min_samples_leaf": 3, "class_weight": "balanced_subsample"}, {}, 1)]
    at_once = [m.scorer() for m in forest.fit_forest(table, settings, "isFraud")]
    monkeypatch.setattr(forest, "MOST_NODES", 3)
    in_passes = [m.scorer() for m in forest.fit_forest(table, settings, "isFraud", whole=40)]
    x = np.array([r["features"].toArray() for r in table.collect()]).T
    for a, b in zip(at_once, in_passes, strict=True):
        assert len(a.trees) == len(b.trees) == 4
        for s, t in zip(a.trees, b.trees, strict=True):
            assert nested(s) == nested(t)
        assert np.array_equal(a(x), b(x)) and 0 <= a(x).min() <= a(x).max() <= 1


def test_subsample_weights_are_those_of_each_bootstrap(spark, table):
    trees = [(0, None), (1, None), (1, 2)]
    with TemporaryTables(spark) as tables:
        state = tables.stored(forest._state(table, forest.cuts_of(table, 3), "isFraud", 42))
        got = forest.draw_counts(state, 42, trees)
        blocks = state.collect()
    for (number, without), counts in zip(trees, got.tolist(), strict=True):
        want = [0, 0, 0]
        for block in blocks:
            times = forest.draws_of(42, number, block["id"], block["rows"])
            y, fold = (np.frombuffer(block[c], "<i4") for c in ("y", "fold"))
            for k, label, f in zip(times.tolist(), y.tolist(), fold.tolist(), strict=True):
                if k and f != without:
                    want = [want[0] + 1, want[1] + k * (label == 0), want[2] + k * (label == 1)]
        assert counts == want
        weights = forest.tree_weights({"class_weight": "balanced_subsample"}, {}, counts[1:])
        assert weights[0] * counts[1] == pytest.approx(weights[1] * counts[2]) == pytest.approx(sum(counts[1:]) / 2)
    assert got[0].tolist() != got[1].tolist()
    # So no two trees weigh alike, and none as the whole frame would.
    balanced = models.weight_per_class(models.class_counts(table), "balanced")
    assert forest.tree_weights({"class_weight": "balanced_subsample"}, {}, got[0, 1:].tolist()) != (balanced[0], balanced[1])


def test_depth_has_no_limit():
    # Alternating classes along one feature, heavier and heavier: each cut takes off one value.
    n = 60
    bins = np.arange(n, dtype=np.uint8)[None, :]
    times = np.array([1 << (i // 2) for i in range(n)], dtype=np.int64)
    y = np.arange(n) % 2 == 1
    tree = forest.grown(bins, np.stack([times * ~y, times * y]), [n], 1, 0, forest.Rules((1.0, 1.0), 1, None))

    def depth(node=0):
        return 0 if tree.feature[node] < 0 else 1 + max(depth(tree.left[node]), depth(tree.right[node]))

    assert depth() >= 40
    assert np.array_equal(tree.value[forest.nodes_of(tree, bins)], y.astype(float))


def test_a_fitted_forest_separates_and_is_saved(spark, table, tmp_path):
    model = models.fit_assembled(table, "random_forest", {**PARAMS, "n_estimators": 12, "class_weight": "balanced_subsample"})
    model.write().overwrite().save(str(tmp_path / "forest"))
    again = type(model).load(str(tmp_path / "forest"))
    scored = [m.transform(table).select("isFraud", models.positive_probability().alias("p")).collect() for m in (model, again)]
    assert scored[0] == scored[1]
    of = {c: np.mean([r["p"] for r in scored[0] if r["isFraud"] == c]) for c in (0, 1)}
    assert of[1] > 0.8 and of[0] < 0.2


def test_one_class_and_no_features_that_differ(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 1.0)], "isFraud int, a double")
    for rows, low, high in ((df.filter("isFraud = 0"), 0.0, 0.0), (df, 0.0, 1.0)):
        model = forest.fit_forest(models.assembled(rows, ["a"]), [(PARAMS, {0: 1.0, 1: 1.0}, None)], "isFraud")[0]
        got = model.transform(models.assembled(rows, ["a"])).select(models.positive_probability().alias("p"))
        assert got.filter(~F.col("p").between(low, high)).count() == 0


def test_a_search_holds_one_forest_at_a_time(table, monkeypatch):
    """Each forest has scored its fold and is gone before the next one grows; the scores are those of all fitted at once."""
    sample = table.select(
        "isFraud", "fold", *[models.vector_to_array("features")[i].alias(c) for i, c in enumerate("abc")]
    ).cache()
    settings = [PARAMS, {**PARAMS, "min_samples_leaf": 3}]
    held = []
    real = forest._forest

    def counted(*args):
        assert not any(r() for r in held)
        made = real(*args)
        held.append(weakref.ref(made))
        return made

    monkeypatch.setattr(forest, "_forest", counted)
    found = models.search(sample, "random_forest", settings, features=["a", "b", "c"])
    assert len(held) == 6
    monkeypatch.setattr(forest, "_forest", real)
    monkeypatch.setattr(models, "ONE_BY_ONE", {})
    assert models.search(sample, "random_forest", settings, features=["a", "b", "c"]) == found


def test_features_are_counted_in_drawn_order_until_enough_can_be_cut():
    draw = np.random.default_rng(5)
    sizes, n = [1, *[6] * 15], 400
    bins = np.stack([draw.integers(0, size, n) for size in sizes])
    node, y = draw.integers(0, 3, n), draw.random(n) < 0.4
    sums, asked = forest.Sums(np.stack([~y, y])), []

    def counted(nodes, tried):
        asked.append(list(zip(nodes.tolist(), tried.tolist(), strict=True)))
        cells = [sums.at(node == k, bins[f][node == k], sizes[f]) for k, f in asked[-1]]
        return np.concatenate(cells, axis=1)

    keys = np.array([11, 12, 13], np.uint64)
    feature, _ = forest.best_cuts(counted, sizes, keys, forest.Rules((1.0, 1.0), 1, None))
    for k in range(3):
        mine = [f for turn in asked for at, f in turn if at == k]
        order = sorted(range(16), key=lambda f: int(forest.mixed(keys[[k]] + np.array([f + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]))
        assert mine == order[: len(mine)] and sum(f != 0 for f in mine) == 4
        assert feature[k] in mine


@pytest.mark.parametrize("most", [3, 1 << 30])
def test_packed_sums_equal_those_one_by_one(most):
    draw = np.random.default_rng(6)
    draws, cell = draw.integers(0, most, (2, 500)), draw.integers(0, 7, 500)
    rows = np.flatnonzero(cell != 3)
    got = forest.Sums(draws).at(rows, cell[rows], 9)
    for found, values in zip(got, (np.ones(500, int), *draws), strict=True):
        want = [int(values[(cell == c) & (c != 3)].sum()) for c in range(9)]
        assert found.tolist() == want
