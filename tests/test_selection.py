import pytest

from riskloom.config import TrainingSettings
from riskloom.operators import models, selection
from riskloom.plans import promotion

RUNS = "run_id string, algorithm string, metrics map<string,double>"


def test_promotion_history(rows):
    versions = rows([("m", i + 1, v) for i, v in enumerate([0.5, 0.4, 0.5, 0.7])], "model string, version int, metric double")
    got = {r["version"]: r["promoted"] for r in selection.champion_history(versions).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True}
    lower = versions.unionByName(rows([("m", 5, 0.1)], "model string, version int, metric double"))
    aliases = selection.current_aliases(selection.champion_history(lower)).first().asDict()
    assert aliases == {"model": "m", "champion": 4, "champion_metric": 0.7, "challenger": 5}


def test_a_version_without_metric_is_an_error(rows):
    versions = rows([("m", 1, None)], "model string, version int, metric double")
    with pytest.raises(Exception, match="no metric for version 1"):
        selection.champion_history(versions).collect()


def test_long_history_equals_a_plain_loop(spark):
    import random

    draw = random.Random(5)
    data = [(m, v, draw.randrange(100) / 100) for m in ("a", "b") for v in range(1, 300)]
    got = selection.champion_history(spark.createDataFrame(data, "model string, version int, metric double"))
    got = {(r["model"], r["version"]): r["promoted"] for r in got.collect()}
    for m in ("a", "b"):
        best = -1.0
        for model, v, metric in data:
            if model == m:
                assert got[(m, v)] == (metric >= best)
                best = max(best, metric)


def test_cross_environment(rows):
    schema = "model string, metric double"
    source = rows([("none", None), ("zero", 0.3), ("better", 0.3), ("alone", 0.1)], schema)
    target = rows([("none", 0.0), ("zero", 0.0), ("better", 0.4)], schema)
    got = {r["model"]: (r["promoted"], r["alias"]) for r in selection.cross_environment(source, target).collect()}
    assert got == {
        "none": (False, "challenger"),
        "zero": (True, "champion"),
        "better": (False, "challenger"),
        "alone": (True, "champion"),
    }


def test_winner_ties_go_to_configuration_order(rows):
    same = {"val_avg_precision": 0.5, "val_precision_at_80recall": 0.1}
    runs = rows([("2", "forest", same), ("1", "logistic", same)], RUNS)
    assert selection.select_winner(runs, "avg_precision", ["forest", "logistic"]).first()["algorithm"] == "forest"
    assert selection.select_winner(runs, "avg_precision", ["logistic", "forest"]).first()["algorithm"] == "logistic"


def test_gate(rows):
    runs = rows(
        [("a", "x", {"avg_precision": 0.5, "precision_at_80recall": 0.04}), ("b", "x", {"avg_precision": 0.9}), ("c", "x", {})],
        RUNS,
    )
    got = {r["run_id"]: r["eval_passed"] for r in selection.quality_gate(runs).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_settings_are_checked():
    for bad in ({"target_recall": 1.0}, {"selection_metric": "accuracy"}, {"val_fraction": 0.5}):
        with pytest.raises(ValueError):
            TrainingSettings(**bad)


def test_algorithms_and_settings():
    assert models.known_algorithms({"random_forest": {}, "svm": {}}) == (["random_forest"], ["svm"])
    with pytest.raises(ValueError):
        models.known_algorithms({"svm": {}})
    drawn = models.draw_settings({"a": [1, 2, 3], "b": [4, 5]}, 4)
    assert len({tuple(d.items()) for d in drawn}) == 4
    assert len(models.draw_settings({"a": [1, 2]}, 8)) == 2


def test_register_and_promote(spark):
    assert promotion.register(spark, "versions_test", "fraud", "r1", 0.5)
    assert not promotion.register(spark, "versions_test", "fraud", "r2", 0.4)
    assert promotion.register(spark, "versions_test", "fraud", "r3", 0.6)
    assert promotion.aliases(spark, "versions_test").first()["champion"] == 3
    moved = promotion.promote_across(spark, "versions_test", "versions_absent").first()
    assert (moved["promoted"], moved["alias"]) == (True, "champion")
    copied = spark.table("versions_absent").collect()
    assert [(r["model"], r["version"], r["run_id"], r["metric"]) for r in copied] == [("fraud", 1, "r3", 0.6)]
    promotion.register(spark, "versions_test", "fraud", "r4", 0.9)
    assert promotion.promote_across(spark, "versions_test", "versions_absent").first()["promoted"]
    assert promotion.aliases(spark, "versions_absent").first()["champion"] == 2


def test_grids_from_a_file(tmp_path):
    import json

    from riskloom.config import PARAM_GRIDS, grids_from

    path = tmp_path / "grids.json"
    path.write_text(json.dumps(PARAM_GRIDS))
    assert grids_from(str(path)) == PARAM_GRIDS
