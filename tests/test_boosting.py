"""Boosting against a brute-force grower, and linear fits against Spark's own."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import boosting, models
from riskloom.operators.boosting import BoostedTrees, fit_boosting
from riskloom.operators.linear import LinearModel, fit_linear

PARAMS = {"max_iter": 6, "learning_rate": 0.3, "max_depth": 4, "min_samples_leaf": 5, "class_weight": None}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 900
    a, b, c = rng.normal(size=n).round(2), rng.integers(0, 4, n).astype(float), rng.exponential(size=n)
    label = (rng.random(n) < 1 / (1 + np.exp(-(2 * a * (b > 1) - c)))).astype(int)
    data = list(zip(range(n), (np.arange(n) % 3).tolist(), label.tolist(), a.tolist(), b.tolist(), c.tolist(), strict=True))
    frame = spark.createDataFrame(data, "txn_id long, fold int, isFraud int, a double, b double, c double").repartition(3).persist()
    return models.assembled(frame, ["a", "b", "c"], keep=["fold"]).persist()


def seen(table, without=None):
    rows = table.select(vector_to_array("features").alias("x"), "isFraud", "fold", F.pmod(F.xxhash64("features", F.lit(42)), F.lit(10)).alias("draw"))
    rows = [r for r in rows.collect() if r.fold != without]
    return np.array([r.x for r in rows]), np.array([r.isFraud for r in rows]), np.array([r.draw for r in rows])




def by_hand(x, y, used, params, weights, cuts, unit, leaves):
    w = np.where(y == 1, weights[1], weights[0]).astype(float)
    margin = np.full(len(y), np.log(w[y == 1].sum() / w[y == 0].sum()))
    for _ in range(params["max_iter"]):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint(w * (p - y) / unit) * unit, np.rint(w * p * (1 - p) / unit) * unit
        parts = [(0, np.arange(len(y)))]

        def best(depth, rows, g=g, h=h):
            """Gain and cut of a node."""
            rows = rows[used[rows]]
            found = (0.0, None)
            if depth >= params["max_depth"]:
                return found
            for f in range(x.shape[1]):
                for cut in cuts[f]:
                    left = rows[x[rows, f] <= cut]
                    right = rows[x[rows, f] > cut]
                    sides = [(g[s].sum(), h[s].sum(), len(s)) for s in (left, right)]
                    if min(s[2] for s in sides) < params["min_samples_leaf"] or min(s[1] for s in sides) < 1e-3:
                        continue
                    gain = sum(s[0] ** 2 / s[1] for s in sides) - g[rows].sum() ** 2 / h[rows].sum()
                    if gain > found[0] + 1e-9:
                        found = (gain, (f, cut))
            return found

        options = [(best(0, parts[0][1]), *parts[0])]
        done = []
        while options and len(options) + len(done) < leaves:
            at = max(range(len(options)), key=lambda i: options[i][0][0])
            (gain, cut), depth, rows = options.pop(at)
            if cut is None:
                done.append((depth, rows))
                continue
            for side in (rows[x[rows, cut[0]] <= cut[1]], rows[x[rows, cut[0]] > cut[1]]):
                options.append((best(depth + 1, side), depth + 1, side))
        for rows in [r for _, r in done] + [o[2] for o in options]:
            inside = rows[used[rows]]
            margin[rows] -= params["learning_rate"] * g[inside].sum() / h[inside].sum()
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("small, leaves, weights", [(2048, 31, {0: 1.0, 1: 1.0}), (100, 6, {0: 1.0, 1: 5.0}), (0, 9, {0: 1.0, 1: 1.0})])
def test_equals_a_grower_by_hand(table, monkeypatch, small, leaves, weights):
    monkeypatch.setattr(boosting, "SMALL", small)
    monkeypatch.setattr(boosting, "LEAVES", leaves)
    monkeypatch.setattr(boosting, "BINS", 20)
    monkeypatch.setattr(boosting, "STORED_EVERY", 2)
    monkeypatch.setattr(boosting.cuts_of, "__defaults__", (20,))
    (model,) = fit_boosting(table, [(PARAMS, weights, 1)], "isFraud")
    x, y, draw = seen(table, without=1)
    cuts = boosting.cuts_of(table, 3)
    unit = max(weights.values()) * 2.0**-32
    want = by_hand(x, y, draw != 0, PARAMS, weights, cuts, unit, leaves)
    assert model.scorer()(x.T) == pytest.approx(want, abs=1e-7)
    assert len(model.scorer().trees) == PARAMS["max_iter"]


def test_one_pass_serves_all_models_alike(table, monkeypatch):
    """Models fitted together are those fitted alone, also when the tasks' sums meet in an aggregate."""
    settings = [({**PARAMS, "max_depth": d, "learning_rate": r}, {0: 1.0, 1: w}, f) for d, r, w, f in [(2, 0.1, 1.0, 0), (None, 0.5, 1.0, 1), (3, 0.3, 9.0, None)]]
    together = [m.getOrDefault(m.trees) for m in fit_boosting(table, settings, "isFraud")]
    monkeypatch.setattr(boosting, "FEW_TASKS", 0)
    monkeypatch.setattr(boosting, "SMALL", 50)
    again = [m.getOrDefault(m.trees) for m in fit_boosting(table, settings, "isFraud")]
    assert again == together


def test_stops_when_the_held_back_rows_no_longer_gain(table):
    (model,) = fit_boosting(table, [({**PARAMS, "max_iter": 300, "learning_rate": 0.5}, {0: 1.0, 1: 1.0}, None)], "isFraud")
    assert 0 < len(model.scorer().trees) < 100


def test_saved_trees_score_alike_and_pipelines_take_them(table, tmp_path):
    model = models.with_threshold(models.fit_assembled(table.drop("fold"), "hist_gradient_boosting", PARAMS), 0.4)
    model.write().overwrite().save(str(tmp_path / "trees"))
    again = type(model).load(str(tmp_path / "trees"))
    assert isinstance(again.stages[0].stages[0], BoostedTrees)
    scores = [[tuple(r) for r in m.transform(table).select("probability", "prediction").collect()] for m in (model, again)]
    assert scores[0] == scores[1]


def test_one_class_and_no_cut(spark):
    flat = models.assembled(spark.createDataFrame([(i, i % 2, 1.0) for i in range(40)], "txn_id long, isFraud int, a double"), ["a"])
    (model,) = fit_boosting(flat, [(PARAMS, {0: 1.0, 1: 1.0}, None)], "isFraud")
    assert model.scorer()(np.ones((1, 2))) == pytest.approx([0.5, 0.5], abs=0.1)
    (none,) = fit_boosting(flat.filter("isFraud = 0"), [(PARAMS, {0: 1.0}, None)], "isFraud")
    assert none.scorer().trees == []


def test_newton_reaches_the_same_minimum_as_spark(table):
    settings = [({"C": c, "max_iter": 100}, {0: 1.0, 1: w}, f) for c in (0.01, 1.0, 100.0) for w in (1.0, 7.0) for f in (0, None)]
    for (params, weights, without), model in zip(settings, fit_linear(table, settings, "isFraud"), strict=True):
        rows = table if without is None else table.filter(F.col("fold") != without)
        rows = rows.withColumn("w", F.when(F.col("isFraud") == 1, weights[1]).otherwise(weights[0]))
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True).fit(rows)
        total = rows.agg(F.sum("w")).first()[0]
        plain = LogisticRegression(
            featuresCol="scaled", labelCol="isFraud", weightCol="w", regParam=1 / (params["C"] * total), standardization=False, tol=1e-14, maxIter=500
        ).fit(scaler.transform(rows))
        want = plain.coefficients.toArray() / scaler.std.toArray()
        assert model.getOrDefault(model.coefficients) == pytest.approx(want, abs=1e-6)
        assert model.getOrDefault(model.intercept) == pytest.approx(plain.intercept - want @ scaler.mean.toArray(), abs=1e-6)


def test_linear_models_of_separable_and_flat_features(spark, tmp_path):
    data = [(i, int(i >= 50), float(i), 3.0) for i in range(100)]
    rows = models.assembled(spark.createDataFrame(data, "txn_id long, isFraud int, a double, flat double"), ["a", "flat"])
    (model,) = fit_linear(rows, [({"C": 1e6, "max_iter": 200}, {0: 1.0, 1: 1.0}, None)], "isFraud")
    assert model.getOrDefault(model.coefficients)[1] == 0.0
    model.write().overwrite().save(str(tmp_path / "line"))
    scored = LinearModel.load(str(tmp_path / "line")).transform(rows)
    assert scored.filter("prediction = isFraud").count() == 100
    x = np.array([[r[2] for r in data], [r[3] for r in data]])
    p = [r[0] for r in scored.select(vector_to_array("probability")[1]).collect()]
    assert p == pytest.approx(model.scorer()(x).tolist())


@pytest.mark.parametrize("leaves", [1, 2, 31, 33, 64, 70])
def test_lookup_finds_the_leaves_that_walking_down_finds(leaves):
    rng = np.random.default_rng(leaves)
    feature, threshold, left, right = [-1], [0], [0], [0]
    for _ in range(leaves - 1):
        leaf = int(rng.choice([i for i, f in enumerate(feature) if f < 0]))
        feature[leaf], threshold[leaf] = int(rng.integers(0, 4)), int(rng.integers(0, 254))
        left[leaf], right[leaf] = len(feature), len(feature) + 1
        for into, what in ((feature, -1), (threshold, 0), (left, 0), (right, 0)):
            into += [what, what]
    tree = boosting.Tree(feature, threshold, left, right, rng.normal(size=len(feature)))
    bins = rng.integers(0, 255, (4, 3000)).astype(np.uint8)
    walked, looked = np.zeros(3000), np.zeros(3000)
    tree.add_to(walked, bins)
    boosting.Lookup(tree).add_to(looked, bins)
    assert walked.tolist() == looked.tolist()


def test_few_tasks_send_their_sums_as_one_value_each(table, monkeypatch):
    seen_rows = []
    real = boosting.pc.list_value_length
    monkeypatch.setattr(boosting.pc, "list_value_length", lambda c: seen_rows.append(len(c)) or real(c))
    monkeypatch.setattr(boosting, "SMALL", 0)
    fit_boosting(table, [({**PARAMS, "max_iter": 2}, {0: 1.0, 1: 1.0}, None)], "isFraud")
    assert seen_rows and max(seen_rows) <= 3


def test_a_pass_standardises_a_block_once_a_fold(table, monkeypatch):
    from riskloom.operators import linear

    calls = []
    monkeypatch.setattr(linear, "standardised", lambda block, without, *a, real=linear.standardised: calls.append(without) or real(block, without, *a))
    # In this process, over the blocks themselves.
    def summed(blocks, of_block, keys):
        rows = blocks.toArrow().to_batches()
        calls.clear()
        total = np.zeros(keys)
        found = list(linear.blocks_of(rows))
        for block in found:
            total += of_block(block)
        assert len(calls) <= 2 * len(found)
        return total

    monkeypatch.setattr(linear, "_summed", summed)
    settings = [({"C": c, "max_iter": 5}, {0: 1.0, 1: w}, f) for c in (0.1, 1.0) for w in (1.0, 3.0) for f in (0, None)]
    assert len(fit_linear(table, settings, "isFraud")) == 8


MIXED = [({**PARAMS, "max_depth": d, "learning_rate": r, "max_iter": n}, {0: 1.0, 1: w}, f) for d, r, n, w, f in [(2, 0.1, 5, 1.0, 0), (None, 0.5, 12, 1.0, 1), (3, 0.3, 0, 9.0, None), (3, 0.3, 9, 9.0, None)]]


def test_small_models_take_no_passes(table, monkeypatch):
    def none(*_):
        raise AssertionError("a pass over the rows")

    monkeypatch.setattr(boosting, "_pass", none)
    passes = []
    found = fit_boosting(table, MIXED, "isFraud", watch=passes.append)
    assert [len(m.scorer().trees) for m in found] == [5, 12, 0, 9]
    assert passes == [1]


@pytest.mark.parametrize("small, few", [(2048, 32), (50, 0), (0, 32)])
def test_models_grown_whole_are_those_of_passes(table, monkeypatch, small, few):
    whole = [m.getOrDefault(m.trees) for m in fit_boosting(table, MIXED, "isFraud")]
    for name, value in (("WHOLE", 0), ("SMALL", small), ("FEW_TASKS", few), ("STORED_EVERY", 4)):
        monkeypatch.setattr(boosting, name, value)
    passes = []
    assert [m.getOrDefault(m.trees) for m in fit_boosting(table, MIXED, "isFraud", watch=passes.append)] == whole
    assert passes[0] >= 12


def test_sums_of_rows_do_not_depend_on_how_many_are_taken_together(monkeypatch):
    rng = np.random.default_rng(1)
    bins, values = rng.integers(0, 7, (5000, 3)).astype(np.uint8), rng.integers(-(2**32), 2**32, (5000, 2))
    which, ends = np.flatnonzero(rng.random(5000) < 0.7), np.array([7, 14, 21])
    want = np.zeros((3, 21), np.int64)
    for row in which.tolist():
        for f in range(3):
            want[:, 7 * f + bins[row, f]] += [*values[row].tolist(), 1]
    for together, few in ((5000, 0), (5000, 5000), (512, 300), (3, 0)):
        monkeypatch.setattr(boosting, "TOGETHER", together)
        monkeypatch.setattr(boosting, "FEW_ROWS", few)
        assert boosting.Rows(bins, values, which).histogram(ends).tolist() == want.tolist()
    sent = boosting.Rows(bins, values, which).sent()
    assert boosting.Rows.read([sent[:0], sent], 3).histogram(ends).tolist() == want.tolist()


@pytest.mark.parametrize("thresholds, leaves", [(40, 31), (255, 70), (5000, 31)])
def test_scores_by_places_are_those_of_walking_down(thresholds, leaves):
    rng = np.random.default_rng(thresholds)
    known, trees = rng.normal(size=thresholds), []
    for _ in range(30):
        feature, threshold, left, right = [-1], [0.0], [0], [0]
        for _ in range(leaves - 1):
            leaf = int(rng.choice([i for i, f in enumerate(feature) if f < 0]))
            feature[leaf], threshold[leaf] = int(rng.integers(0, 3)), float(rng.choice(known))
            left[leaf], right[leaf] = len(feature), len(feature) + 1
            for into, what in ((feature, -1), (threshold, 0.0), (left, 0), (right, 0)):
                into += [what, what]
        trees.append(boosting.Tree(feature, threshold, left, right, rng.normal(size=len(feature))))
    x = np.concatenate([rng.normal(size=(3, 500)), rng.choice(known, (3, 200)), [[np.nan, np.inf], [0.0, -np.inf], [-0.0, np.nan]]], axis=1)
    margin = np.full(x.shape[1], -1.0)
    for tree in trees:
        tree.add_to(margin, x)
    scorer = boosting.TreeSum(-1.0, trees)
    assert scorer(x).tolist() == np.exp(-np.logaddexp(0, -margin)).tolist()
    assert scorer(x).tolist() == boosting.TreeSum(-1.0, trees)(x).tolist()
