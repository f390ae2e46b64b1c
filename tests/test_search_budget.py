"""The searches over trees try as many settings as a training run does."""

import pytest

from riskloom.catalog import load, model_checks
from riskloom.config import TrainingSettings
from riskloom.operators import models


class Tried(Exception):
    pass


@pytest.mark.parametrize("name", ["cv_search_forest", "cv_search_boosting"])
def test_trees_get_the_whole_budget(spark, monkeypatch, name):
    def search(sample, algorithm, settings):
        raise Tried(len({str(sorted(s.items(), key=str)) for s in settings}))

    monkeypatch.setattr(models, "search", search)
    monkeypatch.setattr(model_checks, "_parts", lambda *_: (spark.createDataFrame([(0, 0)], "event_id long, isFraud int"),) * 2)
    monkeypatch.setattr(model_checks, "search_sample", lambda fit: fit)
    monkeypatch.setattr(model_checks, "stratified_folds", lambda sample: sample)
    queries, sql = load()
    budget = TrainingSettings().search_n_iter
    with pytest.raises(Tried) as found:
        queries[name](spark, "")
    assert found.value.args == (budget,) == (8,)
    assert f"CAST({budget} AS INTEGER) AS settings_tried" in sql[name]
