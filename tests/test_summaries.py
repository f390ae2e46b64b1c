"""Summaries of windows against ranks by hand, their bounds against the exact statistic, and the refresh by them."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_drift import ks

from riskloom.operators import drift, summaries
from riskloom.plans import monitoring
from riskloom.sources import tables

SCHEMA = "request_ts timestamp, x double, y double"
DAY = datetime(2024, 1, 1, 6)


def days_of(*columns):
    """Rows of consecutive days, each given as (values of x, values of y)."""
    return [
        (DAY + timedelta(days=d, seconds=i), x[i] if i < len(x) else None, y[i] if i < len(y) else None)
        for d, (x, y) in enumerate(columns)
        for i in range(max(len(x), len(y)))
    ]


def bounds_of(df, points):
    table = summaries.window_summaries(df, ["x", "y"], points=points)
    now, before = (summaries.at_window(table, s) for s in summaries.newest_windows(table))
    return {r["column_name"]: r for r in summaries.bounded_breaches(summaries.ks_bounds(now, before)).collect()}


def test_points_are_exact_ranks_by_hand(rows):
    x = [1.0, 1.0, 2.0, 3.0, 3.0, 3.0, 4.0, 5.0]
    got = summaries.window_summaries(rows(days_of((x, [])), SCHEMA), ["x", "y"], points=2).collect()
    found = {r["column_name"]: r for r in got}
    # Half of eight rows is passed at 3 (three below, six up to it), all of them at 5; y has no value.
    assert [tuple(p) for p in found["x"]["points"]] == [(3.0, 3, 6), (5.0, 7, 8)]
    assert set(found) == {"x", ":table"} and found[":table"]["row_count"] == 8 and found[":table"]["points"] is None


@pytest.mark.parametrize("points", [1, 16, 1000])
def test_bounds_hold_the_exact_statistic(rows, points):
    draw = random.Random(points)
    for spread in (0.0, 0.4):
        a = ([draw.gauss(0, 1) for _ in range(300)], [float(draw.randrange(4)) for _ in range(211)])
        b = ([draw.gauss(spread, 1) for _ in range(170)], [float(draw.randrange(3)) for _ in range(300)])
        got = bounds_of(rows(days_of(a, b), SCHEMA), points)
        for i, name in enumerate("xy"):
            exact = ks(a[i], b[i])
            assert got[name]["statistic_low"] <= exact <= got[name]["statistic_high"]
            assert (got[name]["row_count"], got[name]["previous_count"]) == (len(b[i]), len(a[i]))
            if points >= 300 or (name == "y" and points >= 16):
                assert got[name]["statistic_low"] == exact == got[name]["statistic_high"]
            if points == 16:
                assert got[name]["statistic_high"] - got[name]["statistic_low"] <= 4 / 16


def test_windows_that_do_not_overlap(rows):
    got = bounds_of(rows(days_of(([1.0, 2.0], [1.0]), ([5.0, 6.0], [])), SCHEMA), 1)
    assert got["x"]["statistic_high"] == 1.0
    # y has no value in the newer window, so there is no test.
    assert set(got) == {"x"}


def test_nan_is_the_greatest_value(rows):
    got = bounds_of(rows(days_of(([1.0, float("nan")], [1.0]), ([1.0, 2.0], [1.0])), SCHEMA), 8)
    assert got["x"]["statistic_low"] == got["x"]["statistic_high"] == 0.5
    assert got["y"]["statistic_high"] == 0.0


def test_limits_decide_only_outside_the_bounds(rows):
    schema = "column_name string, statistic_low double, statistic_high double, row_count bigint, previous_count bigint"
    cases = [("beyond", 0.3, 0.4), ("within", 0.1, 0.2), ("open", 0.19, 0.21), ("at", 0.2, 0.2)]
    df = rows([(n, low, high, 1000, 1000) for n, low, high in cases] + [("few", 0.3, 0.5, 10, 10), ("some", 0.5, 0.9, 10, 10)], schema)
    got = {r["column_name"]: r["breach"] for r in summaries.bounded_breaches(df).collect()}
    assert got == {"beyond": True, "within": False, "open": None, "at": False, "few": False, "some": None}


def exact_verdict(df):
    return sorted(r[0] for r in drift.breaches(drift.ks_drift(df, ["x", "y"])).select("column_name").collect())


def test_refresh_agrees_with_all_rows(spark, rows):
    log, table, points = "summary_log", "summary_table", 16
    draw = random.Random(5)
    every = [
        ([draw.gauss(shift, 1) for _ in range(400)], [draw.random() + lift for _ in range(400)])
        for shift, lift in ((0, 0), (0, 0.21), (2, 0.21), (2, 0.42))
    ]
    data = days_of(*every)
    exactly = []
    for day in range(4):
        tables.append_by_day(rows([r for r in data if r[0].day == day + 1], SCHEMA), log)
        got = monitoring.refresh_summaries(spark, log, table, ["x", "y"], points)
        assert got.breached == exact_verdict(spark.table(log)) and got.retrain == bool(got.breached)
        exactly.append(got.compared_exactly)
    # A lift of 0.21 is too near the limit of 0.2 for that many points; a shift of two deviations is not.
    assert "y" in exactly[1] and exactly[2] == []
    assert spark.table(table).filter("column_name = ':table'").count() == 4
    whole = summaries.window_summaries(spark.table(log), ["x", "y"], points=points)
    assert spark.table(table).select(whole.columns).exceptAll(whole).count() == 0


def test_a_refresh_reads_the_last_window_only(spark, rows):
    data = days_of(*[([float(i + 500 * (d == 2)) for i in range(200)], [1.0]) for d in range(3)])
    tables.overwrite_table(rows([r for r in data if r[0].day < 3], SCHEMA), "last_log")
    assert not monitoring.refresh_summaries(spark, "last_log", "last_summaries", ["x", "y"]).retrain
    # The first window is gone from the log and the second has grown: only its summary is made again.
    more = rows([r for r in data if r[0].day > 1] + [(DAY + timedelta(days=1, hours=1), 7.0, 1.0)], SCHEMA)
    tables.overwrite_table(more, "last_log")
    got = monitoring.refresh_summaries(spark, "last_log", "last_summaries", ["x", "y"])
    assert got == monitoring.SummaryVerdict(["x"], [])
    sizes = spark.table("last_summaries").filter("column_name = ':table'").orderBy("window_date")
    assert [r["row_count"] for r in sizes.collect()] == [200, 201, 200]


def test_empty_log_and_rows_without_a_time(spark, rows):
    tables.overwrite_table(rows([], SCHEMA), "empty_log")
    assert monitoring.refresh_summaries(spark, "empty_log", "empty_summaries", ["x", "y"]) == monitoring.SummaryVerdict([], [])
    tables.append_by_name(rows([(None, 1.0, 2.0)], SCHEMA), "empty_log")
    assert not monitoring.refresh_summaries(spark, "empty_log", "empty_summaries", ["x", "y"]).retrain
    assert spark.table("empty_summaries").filter(F.col("window").isNotNull()).count() == 0
