"""Building blocks of the comparison SQL, as common table expressions."""

from __future__ import annotations

from collections.abc import Sequence

from riskloom.config import FEATURES

TXN = """
ev AS (SELECT *, epoch_us(ts) // 1000000 AS s, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
       FROM events),
raw_txn AS (
  SELECT event_id, ts,
         CAST((s - (SELECT min(s) FROM ev)) // 3600 + 1 AS INTEGER) AS step,
         CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'click' THEN 'CASH_IN' WHEN 'view' THEN 'DEBIT'
                         WHEN 'signup' THEN 'TRANSFER' WHEN 'error' THEN 'CASH_OUT' END AS "type",
         value AS amount,
         'C' || CAST(user_id AS VARCHAR) AS "nameOrig",
         CASE WHEN k % 3 = 0 THEN 'M' ELSE 'C' END || CAST(k AS VARCHAR) AS "nameDest"
  FROM ev),
txn AS (
  SELECT *, CAST(CASE WHEN "type" IN ('TRANSFER', 'CASH_OUT') AND amount > 100
                       AND substr(md5(CAST(event_id AS VARCHAR)), 1, 1) < '8' THEN 1 ELSE 0 END AS INTEGER) AS "isFraud"
  FROM raw_txn)"""

SPLIT = (
    TXN
    + """,
edge AS (SELECT CAST(trunc(max(step) * CAST(0.8 AS DOUBLE)) AS INTEGER) AS edge FROM txn),
parts AS (SELECT *, CASE WHEN step <= (SELECT edge FROM edge) THEN 'train'
                         WHEN step > (SELECT edge FROM edge) THEN 'test' END AS dataset FROM txn)"""
)

FEATURE_COLUMNS = """
ln(1 + amount) AS log_amount,
CAST(amount = 0 AS INTEGER) AS amount_is_zero,
CAST((step - 1) % 24 AS INTEGER) AS hour_of_day,
CAST(floor((step - 1) / 24) AS INTEGER) + 1 AS simulation_day,
CAST(substr("nameOrig", 1, 1) = 'C' AS INTEGER) AS orig_is_customer,
CAST(substr("nameDest", 1, 1) = 'C' AS INTEGER) AS dest_is_customer,
CAST(substr("nameDest", 1, 1) = 'M' AS INTEGER) AS dest_is_merchant"""

FRAME = (
    SPLIT
    + f""",
sent AS (SELECT "nameOrig", count(*) AS n FROM parts WHERE dataset = 'train' GROUP BY 1),
received AS (SELECT "nameDest", count(*) AS n FROM parts WHERE dataset = 'train' GROUP BY 1),
frame AS (
  SELECT p.event_id, p.ts, p.dataset, {FEATURE_COLUMNS.replace('"name', 'p."name')},
         ln(1 + coalesce(s.n, 0)) AS log_orig_txn_count,
         ln(1 + coalesce(r.n, 0)) AS log_dest_txn_count,
         p."isFraud",
         CASE WHEN "type" = 'TRANSFER' THEN 1 ELSE 0 END AS "type_TRANSFER",
         CASE WHEN "type" = 'CASH_OUT' THEN 1 ELSE 0 END AS "type_CASH_OUT"
  FROM parts p LEFT JOIN sent s ON p."nameOrig" = s."nameOrig" LEFT JOIN received r ON p."nameDest" = r."nameDest"
  WHERE p.dataset IS NOT NULL)"""
)

HOLDOUT_DRAW = "md5('holdout:42:' || CAST(event_id AS VARCHAR))"
SEARCH_DRAW = "md5('search:42:' || CAST(event_id AS VARCHAR))"
SAMPLE_DRAW = "md5('sample:42:' || CAST(event_id AS VARCHAR))"
FOLD_DRAW = "substr(md5('fold:42:' || CAST(event_id AS VARCHAR)), 1, 15)"
FOLD = f'CAST((row_number() OVER (PARTITION BY "isFraud" ORDER BY {FOLD_DRAW}) - 1) % 3 AS INTEGER)'


def holdout_of(source: str, name: str) -> str:
    """CTE ``name``: ``source`` with its exact stratified hold-out of 0.12 in ``split``."""
    return f"""
{name}_sizes AS (SELECT "isFraud" AS c, count(*) AS size, CAST(sum(count(*)) OVER () AS BIGINT) AS n FROM {source} GROUP BY 1),
{name}_fits AS (SELECT *, n - CAST(ceil(n * CAST(0.12 AS DOUBLE)) AS BIGINT) AS fit_n FROM {name}_sizes),
{name}_base AS (SELECT *, (fit_n * size) // n AS base, (fit_n * size) % n AS rest FROM {name}_fits),
{name}_quotas AS (SELECT c, size - base - CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= fit_n - sum(base) OVER ()
                                   THEN 1 ELSE 0 END AS want FROM {name}_base),
{name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY "isFraud" ORDER BY {HOLDOUT_DRAW}) AS hrn FROM {source}),
{name} AS (SELECT * EXCLUDE (hrn, c, want), CASE WHEN hrn <= want THEN 'val' ELSE 'fit' END AS split
           FROM {name}_ranked JOIN {name}_quotas ON c = "isFraud")"""


FIT = (
    SPLIT
    + """,
train_period AS (SELECT * FROM parts WHERE dataset = 'train'),"""
    + holdout_of("train_period", "train")
    + """,
fit AS (SELECT * FROM train WHERE split = 'fit')"""
)


def search_of(source: str) -> str:
    """CTE ``sample``: all positives of ``source`` and 40 negatives per positive."""
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY "isFraud" ORDER BY {SEARCH_DRAW}) AS rn FROM {source}),
sample AS (SELECT * EXCLUDE (rn) FROM ranked
           WHERE "isFraud" = 1
              OR rn <= 40 * (SELECT count(*) FROM {source} WHERE "isFraud" = 1))"""


def curve_of(source: str, score: str, by: Sequence[str] = (), name: str = "curve") -> str:
    """CTE ``name``: the precision-recall curve of ``score`` over ``source``."""
    keys = "".join(f"{c}, " for c in by)
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    group = "GROUP BY " + ", ".join([*by, "threshold"])
    return f"""
{name}_points AS (
  SELECT {keys}CAST({score} AS DOUBLE) AS threshold, CAST(sum("isFraud") AS BIGINT) AS pos, count(*) AS n
  FROM {source} {group}),
{name}_runs AS (
  SELECT *, CAST(sum(pos) OVER ({part} ORDER BY threshold DESC) AS BIGINT) AS tp,
            CAST(sum(n) OVER ({part} ORDER BY threshold DESC) AS BIGINT) AS flagged,
            CAST(sum(pos) OVER ({part}) AS BIGINT) AS positives,
            CAST(sum(n) OVER ({part}) AS BIGINT) AS total
  FROM {name}_points),
{name} AS (
  SELECT *, tp / flagged AS "precision", CASE WHEN positives > 0 THEN tp / positives END AS recall
  FROM {name}_runs)"""


AP = 'sum(CASE WHEN positives > 0 THEN pos / positives END * "precision")'
AUC = (
    "CASE WHEN max(positives) > 0 AND max(total - positives) > 0 "
    "THEN sum((n - pos) * (tp - pos + pos / 2)) / (CAST(max(positives) AS DOUBLE) * max(total - positives)) END"
)


def best_precision(recall: float) -> str:
    return f'coalesce(max("precision") FILTER (recall >= {recall}), 0.0)'


def confusion_columns(flag: str, label: str = '"isFraud" = 1') -> str:
    return f"""count(*) FILTER ({flag} AND {label}) AS tp,
       count(*) FILTER ({flag} AND NOT ({label})) AS fp,
       count(*) FILTER (NOT ({flag}) AND {label}) AS fn,
       count(*) FILTER (NOT ({flag}) AND NOT ({label})) AS tn"""


CONFUSION_RATIOS = """CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 9) ELSE 0.0 END AS "precision",
       CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 9) ELSE 0.0 END AS recall,
       CASE WHEN tp > 0 THEN round((tp + fp) / tp, 9) ELSE 0.0 END AS alerts_per_fraud,
       CASE WHEN tp + fp + fn + tn > 0 THEN round((tp + fp) / (tp + fp + fn + tn), 9) ELSE 0.0 END AS flagged_rate"""

STAND_INS = (("amount_score", "log_amount"), ("sender_score", "log_orig_txn_count"), ("hour_score", "hour_of_day"))


def bake_off_of(source: str, name: str, keep: Sequence[str] = ()) -> str:
    """CTE ``name``: ``source`` scored by the three stand-ins, in long form."""
    extra = "".join(f"{c}, " for c in keep)
    parts = [
        f"SELECT event_id, \"isFraud\", {extra}'{a}' AS algorithm, CAST({c} AS DOUBLE) AS score FROM {source}"
        for a, c in STAND_INS
    ]
    return f"\n{name} AS ({' UNION ALL '.join(parts)})"


def chosen(recall: float, column: str) -> str:
    return f"arg_max({column}, threshold) FILTER (recall >= {recall})"


RUNS = (
    FRAME
    + """,
frame_train AS (SELECT * FROM frame WHERE dataset = 'train'),"""
    + holdout_of("frame_train", "ftrain")
    + """,
ffit AS (SELECT * FROM ftrain WHERE split = 'fit'),
fval AS (SELECT * FROM ftrain WHERE split = 'val'),
ftest AS (SELECT * FROM frame WHERE dataset = 'test'),"""
    + search_of("ffit")
    + f""",
folded AS (SELECT *, {FOLD} AS fold FROM sample),"""
    + bake_off_of("folded", "cv_scored", ["fold"])
    + ","
    + curve_of("cv_scored", "score", ["algorithm", "fold"], "cv_curve")
    + f""",
cv_folds AS (SELECT algorithm, fold, {AP} AS ap FROM cv_curve GROUP BY algorithm, fold),
cv AS (SELECT algorithm, avg(ap) AS cv_best_score_on_sample FROM cv_folds GROUP BY algorithm),"""
    + bake_off_of("fval", "val_scored")
    + ","
    + curve_of("val_scored", "score", ["algorithm"], "val_curve")
    + ","
    + bake_off_of("ftest", "test_scored")
    + ","
    + curve_of("test_scored", "score", ["algorithm"], "test_curve")
    + f""",
val AS (SELECT algorithm, {AP} AS val_avg_precision, {best_precision(0.8)} AS val_precision_at_80recall,
               {chosen(0.6, '"precision"')} AS val_precision_at_target_recall,
               {chosen(0.6, "recall")} AS val_recall_at_threshold,
               {chosen(0.6, "threshold")} AS decision_threshold
        FROM val_curve GROUP BY algorithm),
tst AS (SELECT algorithm, {AP} AS avg_precision, {AUC} AS roc_auc, {best_precision(0.8)} AS precision_at_80recall,
               {", ".join(f'{chosen(r / 100, chr(34) + "precision" + chr(34))} AS precision_at_recall_{r}' for r in (50, 60, 70, 80, 90))}
        FROM test_curve GROUP BY algorithm),
cm AS (SELECT t.algorithm, {confusion_columns("score >= decision_threshold")}
       FROM test_scored t JOIN val USING (algorithm) GROUP BY t.algorithm),
runs AS (
  SELECT 'run-' || algorithm AS run_id, *,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall_at_threshold,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision_at_threshold,
         CASE WHEN tp > 0 THEN (tp + fp) / tp ELSE 0.0 END AS alerts_per_fraud_at_threshold,
         (tp + fp) / (tp + fp + fn + tn) AS flagged_rate_at_threshold,
         tp AS tp_at_threshold, fp AS fp_at_threshold, fn AS fn_at_threshold,
         CASE algorithm WHEN 'amount_score' THEN 1 WHEN 'sender_score' THEN 2 ELSE 3 END AS place
  FROM val JOIN tst USING (algorithm) JOIN cm USING (algorithm) LEFT JOIN cv USING (algorithm))"""
)

# The metrics of a run, by name.
RUN_METRICS = (
    "avg_precision",
    "roc_auc",
    "precision_at_80recall",
    "cv_best_score_on_sample",
    "val_avg_precision",
    "val_precision_at_80recall",
    "val_precision_at_target_recall",
    "val_recall_at_threshold",
    "decision_threshold",
    "recall_at_threshold",
    "precision_at_threshold",
    "alerts_per_fraud_at_threshold",
    "flagged_rate_at_threshold",
    "tp_at_threshold",
    "fp_at_threshold",
    "fn_at_threshold",
    *[f"precision_at_recall_{r}" for r in (50, 60, 70, 80, 90)],
)

VERSIONS = (
    FRAME
    + ","
    + bake_off_of("frame", "daily_scored", ["simulation_day"])
    + ","
    + curve_of("daily_scored", "score", ["algorithm", "simulation_day"], "daily_curve")
    + f""",
versions AS (SELECT algorithm AS model, simulation_day AS version, {AP} AS metric
             FROM daily_curve GROUP BY algorithm, simulation_day HAVING max(positives) > 0),
history AS (SELECT *, coalesce(max(metric) OVER (PARTITION BY model ORDER BY version
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1.0) AS champion_metric
            FROM versions)"""
)

PAYLOAD = (
    FRAME
    + f""",
shifted AS (SELECT * REPLACE (CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
                                   THEN log_amount * 3 ELSE log_amount END AS log_amount) FROM frame),
payload AS (SELECT event_id, {", ".join(f'"{c}"' for c in FEATURES)}, "isFraud",
                   CAST(log_amount >= 5.0 AS INTEGER) AS prediction, ts AS request_ts,
                   strftime(ts, '%Y-%m-%d') AS day,
                   CASE WHEN event_id % 3 = 0 THEN '1' ELSE '2' END AS model_version
            FROM shifted)"""
)


def drift_of(source: str, by: Sequence[str] = ()) -> str:
    """CTE ``drift``: KS statistic and p-value per window and column, plus the table-level rows.

    ``source`` has the features, ``day`` and the ``by`` columns.
    """
    keys = "".join(f"{c}, " for c in by)
    p_keys = "".join(f"p.{c}, " for c in by)
    same = "".join(f" AND c.{c} = p.{c}" for c in by)
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    long = " UNION ALL ".join(
        f"SELECT {keys}day, '{c}' AS column_name, CAST(\"{c}\" AS DOUBLE) AS v FROM {source}" for c in FEATURES
    )
    return f"""
long AS ({long}),
c AS (SELECT {keys}day, column_name, v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY ALL),
days AS (SELECT {keys}day, count(*) AS size FROM {source} GROUP BY ALL),
p AS (SELECT {keys}day, lag(day) OVER ({part}ORDER BY day) AS prev, size,
             lag(size) OVER ({part}ORDER BY day) AS prev_size FROM days),
both_sides AS (
  SELECT {p_keys}p.day, c.column_name, c.v,
         sum(CASE WHEN c.day = p.day THEN n ELSE 0 END) AS a, sum(CASE WHEN c.day = p.prev THEN n ELSE 0 END) AS b
  FROM p JOIN c ON (c.day = p.day OR c.day = p.prev){same} WHERE p.prev IS NOT NULL GROUP BY ALL),
cum AS (
  SELECT {keys}day, column_name,
         sum(a) OVER (PARTITION BY {keys}day, column_name ORDER BY v) AS ca,
         sum(b) OVER (PARTITION BY {keys}day, column_name ORDER BY v) AS cb,
         sum(a) OVER (PARTITION BY {keys}day, column_name) AS na,
         sum(b) OVER (PARTITION BY {keys}day, column_name) AS nb
  FROM both_sides),
ks AS (SELECT {keys}day, column_name, max(abs(ca / na - cb / nb)) AS statistic,
              CAST(max(na) AS BIGINT) AS row_count, CAST(max(nb) AS BIGINT) AS previous_count
       FROM cum GROUP BY ALL),
lam AS (SELECT *, statistic * sqrt(CAST(row_count AS DOUBLE) * previous_count / (row_count + previous_count)) AS l
        FROM ks),
series AS (SELECT {keys}day, column_name, sum((CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * l * l)) AS q
           FROM lam, generate_series(1, 100) AS g(k) GROUP BY ALL),
drift AS (
  SELECT {keys}day, column_name, statistic, CASE WHEN l < 0.2 THEN 1.0 ELSE least(greatest(q, 0.0), 1.0) END AS pvalue,
         row_count, previous_count
  FROM lam JOIN series USING ({keys}day, column_name)
  UNION ALL
  SELECT {keys}day, ':table', NULL, NULL, size, prev_size FROM p WHERE prev IS NOT NULL)"""
