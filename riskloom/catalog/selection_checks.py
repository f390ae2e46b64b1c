"""Selection rules over runs and versions that are computed from the tables."""

from pyspark.sql import functions as F

from riskloom.catalog import check
from riskloom.catalog.frames import STAND_INS, history, runs, versions
from riskloom.catalog.sql import RUNS, VERSIONS
from riskloom.operators import selection

ORDER = "val_avg_precision DESC NULLS LAST, place, run_id"
SHOWN = ["avg_precision", "precision_at_80recall", "val_avg_precision", "val_precision_at_80recall"]


@check(f"WITH {RUNS} SELECT run_id, algorithm, " + ", ".join(f"round({c}, 4) AS {c}" for c in SHOWN) + " FROM runs")
def model_leaderboard(spark, folder):
    return selection.leaderboard(runs(spark, folder), SHOWN, "avg_precision", list(STAND_INS))


@check(f"WITH {RUNS} SELECT run_id, algorithm, row_number() OVER (ORDER BY {ORDER}) AS place FROM runs")
def model_leaderboard_places(spark, folder):
    """The order of the leaderboard, one row a model."""
    board = selection.leaderboard(runs(spark, folder), SHOWN, "avg_precision", list(STAND_INS)).select("run_id", "algorithm")
    return board.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


@check(f"WITH {RUNS} SELECT run_id, algorithm FROM runs ORDER BY {ORDER} LIMIT 1")
def select_winner(spark, folder):
    best = selection.select_winner(runs(spark, folder), "avg_precision", list(STAND_INS))
    return best.select("run_id", "algorithm")


@check(f"WITH {RUNS} SELECT run_id, algorithm FROM runs ORDER BY val_precision_at_80recall DESC NULLS LAST, {ORDER} LIMIT 1")
def select_winner_at_80recall(spark, folder):
    best = selection.select_winner(runs(spark, folder), "precision_at_80recall", list(STAND_INS))
    return best.select("run_id", "algorithm")


@check(
    f"""WITH {RUNS} SELECT run_id, round(coalesce(avg_precision, 0.0), 9) AS avg_precision,
round(coalesce(roc_auc, 0.0), 9) AS roc_auc, round(coalesce(precision_at_80recall, 0.0), 9) AS precision_at_80recall,
coalesce(avg_precision, 0.0) >= 0.50 AND coalesce(precision_at_80recall, 0.0) >= 0.04 AS eval_passed FROM runs"""
)
def quality_gate(spark, folder):
    gate = selection.quality_gate(runs(spark, folder))
    return gate.withColumns({c: F.round(c, 9) for c in ("avg_precision", "roc_auc", "precision_at_80recall")})


@check(
    f"""WITH {VERSIONS} SELECT model, version, round(metric, 9) AS metric, round(champion_metric, 9) AS champion_metric,
metric >= champion_metric AS promoted FROM history"""
)
def champion_history(spark, folder):
    return history(spark, folder).withColumns({c: F.round(c, 9) for c in ("metric", "champion_metric")})


@check(
    f"""WITH {VERSIONS}, promoted AS (SELECT * FROM history WHERE metric >= champion_metric)
SELECT model, (SELECT max(version) FROM promoted p WHERE p.model = h.model) AS champion,
       (SELECT round(arg_max(metric, version), 9) FROM promoted p WHERE p.model = h.model) AS champion_metric,
       max(version) AS challenger FROM history h GROUP BY model"""
)
def champion_aliases(spark, folder):
    aliases = selection.current_aliases(history(spark, folder))
    return aliases.withColumn("champion_metric", F.round("champion_metric", 9))


@check(
    f"""WITH {VERSIONS},
src AS (SELECT model, max(metric) AS m FROM versions WHERE version <= 15 GROUP BY 1),
tgt AS (SELECT model, max(metric) AS m FROM versions WHERE version > 15 AND model <> 'hour_score' GROUP BY 1)
SELECT src.model, round(src.m, 9) AS source_metric, round(tgt.m, 9) AS target_metric,
       src.m >= coalesce(nullif(tgt.m, 0.0), -1.0) AS promoted,
       CASE WHEN src.m >= coalesce(nullif(tgt.m, 0.0), -1.0) THEN 'champion' ELSE 'challenger' END AS "alias"
FROM src LEFT JOIN tgt USING (model)"""
)
def cross_env_promotion(spark, folder):
    every = versions(spark, folder)

    def champions(part):
        aliases = selection.current_aliases(selection.champion_history(part))
        return aliases.select("model", F.col("champion_metric").alias("metric"))

    source = champions(every.filter("version <= 15"))
    target = champions(every.filter("version > 15 AND model <> 'hour_score'"))
    out = selection.cross_environment(source, target)
    return out.withColumns({c: F.round(c, 9) for c in ("source_metric", "target_metric")})
