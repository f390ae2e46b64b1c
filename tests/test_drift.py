import random
from bisect import bisect_right
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskloom.functions.columns import ks_pvalue
from riskloom.operators import drift, scoring

SCHEMA = "request_ts timestamp, model_version string, x double, y double, prediction int, isFraud int"


def ks(a, b):
    a, b = sorted(a), sorted(b)
    return max(abs(bisect_right(a, v) / len(a) - bisect_right(b, v) / len(b)) for v in {*a, *b})


@pytest.fixture()
def log(rows):
    draw = random.Random(3)
    data = []
    for day, shift in ((1, 0), (2, 0), (4, 3)):
        for i in range(150):
            x = float(draw.randrange(10) + shift)
            data.append((datetime(2024, 1, day, i % 24), str(i % 2), x, 1.0 if i % 3 else None, i % 2, int(i % 7 == 0)))
    return rows(data, SCHEMA), data


def test_ks_against_brute_force(log):
    df, data = log
    got = {(r["window"]["start"].day, r["column_name"]): r for r in drift.ks_drift(df, ["x", "y"]).collect()}
    per_day = {d: [r[2] for r in data if r[0].day == d] for d in (1, 2, 4)}
    assert got[(2, "x")]["ks_test"]["statistic"] == pytest.approx(ks(per_day[2], per_day[1]))
    assert got[(4, "x")]["ks_test"]["statistic"] == pytest.approx(ks(per_day[4], per_day[2]))
    assert got[(4, "y")]["ks_test"]["statistic"] == 0.0
    assert got[(4, "y")]["ks_test"]["pvalue"] == 1.0
    assert got[(4, "y")]["row_count"] == 100
    assert got[(4, ":table")]["ks_test"] is None
    assert (1, "x") not in got


def test_ks_per_model(log):
    df, data = log
    got = drift.ks_drift(df, ["x"], by=["model_version"]).filter("column_name = 'x'")
    for r in got.collect():
        day, before = r["window"]["start"].day, {2: 1, 4: 2}[r["window"]["start"].day]
        a, b = ([v[2] for v in data if v[0].day == d and v[1] == r["model_version"]] for d in (day, before))
        assert r["ks_test"]["statistic"] == pytest.approx(ks(a, b))


def test_verdict(log):
    df, _ = log
    table = drift.ks_drift(df, ["x", "y"])
    got = drift.drift_verdict(table).first().asDict()
    assert got == {"breached_columns": 1, "drift_detected": True, "retrain": True}
    earlier = table.filter(F.col("window.start") < datetime(2024, 1, 4))
    assert not drift.drift_verdict(earlier).first()["drift_detected"]


def test_limits_are_strict_and_missing_tests_do_not_count(rows):
    w = {"start": datetime(2024, 1, 1), "end": datetime(2024, 1, 2)}
    schema = (
        "window struct<start:timestamp,end:timestamp>, column_name string, ks_test struct<statistic:double,pvalue:double>"
    )
    cases = [("a", (0.2, 0.01)), ("b", (0.9, 0.05)), ("c", None), (":table", (0.9, 0.0)), ("d", (None, 0.0))]
    table = rows([(w, c, t) for c, t in cases], schema)
    assert drift.drift_verdict(table).first()["breached_columns"] == 0
    hit = table.unionByName(rows([(w, "e", (0.21, 0.049))], schema))
    assert [r["column_name"] for r in drift.breaches(hit).collect()] == ["e"]
    nothing = drift.drift_verdict(table.limit(0)).first()
    assert (nothing["breached_columns"], nothing["drift_detected"]) == (0, False)


def test_pvalue_series(rows):
    lam = rows([(0.0,), (0.3,), (1.0,), (2.0,)], "l double")
    got = [r[0] for r in lam.select(ks_pvalue(F.col("l"), F.lit(2), F.lit(2))).collect()]
    assert got == pytest.approx([1.0, 0.999991, 0.270000, 0.000671], abs=1e-6)


def test_windows_and_quality(log):
    df, data = log
    windows = {(r["window"]["start"].day, r["model_version"]): r["row_count"] for r in drift.payload_windows(df).collect()}
    assert windows == {(d, m): 75 for d in (1, 2, 4) for m in "01"}
    cell = drift.inference_quality(df).filter("model_version = '1'").first()
    assert cell["tp"] + cell["fp"] + cell["fn"] + cell["tn"] == 75
    assert cell["fn"] == 0


def test_simulated_windows(rows):
    sample = rows([(1.0, 2.0, 0)], "log_amount double, x double, isFraud int")
    made = scoring.simulated_payload(
        sample,
        lambda d: d.withColumn("prediction", (F.col("log_amount") > 2).cast("int")),
        datetime(2024, 3, 2, 12),
        "9",
        features=["log_amount", "x"],
    )
    got = [tuple(r) for r in made.orderBy("request_ts").collect()]
    assert got == [
        (1.0, 2.0, 0, 0, datetime(2024, 3, 1, 12), "9"),
        (3.0, 2.0, 0, 1, datetime(2024, 3, 2, 12), "9"),
    ]
    assert dict(made.dtypes)["request_ts"] == "timestamp"
    assert scoring.rows_per_window(made).count() == 2
