"""Evaluation metrics and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv
from casewright.functions import rules
from casewright.operators import metrics
from casewright.plans import flows
from workload import roles
from workload.registry import query

_SCORES = ("precision", "recall", "f1")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Raw labels with nulls filled, so truth and prediction have classes the other lacks."""
    rows = roles.phrase_tickets(spark, d)
    return metrics.as_pairs(rows, F.coalesce("pred_complaint_type", F.lit("Other")), rules.collapse_label(F.col("pred_raw")))


_PAIRS_SQL = f"""(SELECT coalesce(pred_complaint_type, 'Other') AS t, {roles.collapse_sql('pred_raw')} AS p
  FROM {roles.PHRASE_TICKETS_SQL})"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def report_sql(pairs: str, by: str | None = None, classes: str | None = None, macro_only: bool = False) -> str:
    """Report over a (by, t, p) source, class by class with joins."""
    g = f"{by}, " if by else ""
    on = f"AND c.{by} = x.{by}" if by else ""
    from_classes = classes or (f"SELECT {g} t AS class FROM x UNION SELECT {g} p FROM x")
    r = "CASE WHEN {b} = 0 THEN 0.0 ELSE {a} / {b} END"
    precision = r.format(a="CAST(hits AS DOUBLE)", b="predicted")
    recall = r.format(a="CAST(hits AS DOUBLE)", b="support")
    f1 = r.format(a="2.0::DOUBLE * hits", b="(predicted + support)")
    group = f"GROUP BY {by}" if by else ""
    head = f"""WITH x AS (SELECT * FROM {pairs}), c AS ({from_classes}),
      cnt AS (SELECT {'c.' + by + ',' if by else ''} c.class,
                CAST(count(*) FILTER (x.t = c.class) AS BIGINT) AS support,
                CAST(count(*) FILTER (x.p = c.class) AS BIGINT) AS predicted,
                CAST(count(*) FILTER (x.t = c.class AND x.p = c.class) AS BIGINT) AS hits
              FROM c LEFT JOIN x ON (x.t = c.class OR x.p = c.class) {on} GROUP BY ALL),
      s AS (SELECT {g} class, support, hits, {precision} AS precision, {recall} AS recall, {f1} AS f1 FROM cnt)"""
    if macro_only:
        return f"{head} SELECT {g} round(avg(f1), 6) AS macro_f1 FROM s {group}"
    acc = "round(sum(hits) / CAST(sum(support) AS DOUBLE), 6)"
    return f"""{head}
      SELECT {g} class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
             CAST(support AS DOUBLE) AS support FROM s
      UNION ALL SELECT {g} 'accuracy', {acc}, {acc}, {acc}, {acc} FROM s {group}
      UNION ALL SELECT {g} 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
             CAST(sum(support) AS DOUBLE) FROM s {group}
      UNION ALL SELECT {g} 'weighted avg', round(sum(precision * support) / sum(support), 6),
             round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
             CAST(sum(support) AS DOUBLE) FROM s {group}"""


@query(f"""SELECT pred_complaint_type, pred_severity, count(*) AS n FROM {roles.PHRASE_TICKETS_SQL}
  WHERE pred_complaint_type IS NOT NULL AND pred_severity IS NOT NULL GROUP BY 1, 2""")
def crosstab(spark: SparkSession, d: str) -> DataFrame:
    return metrics.crosstab(roles.phrase_tickets(spark, d), "pred_complaint_type", "pred_severity")


@query(f"""SELECT pred_complaint_type, count(*) FILTER (pred_sentiment = 'Positive') AS "Positive",
    count(*) FILTER (pred_sentiment = 'Neutral') AS "Neutral", count(*) FILTER (pred_sentiment = 'Negative') AS "Negative"
  FROM {roles.PHRASE_TICKETS_SQL} WHERE pred_complaint_type IS NOT NULL AND pred_sentiment IS NOT NULL GROUP BY 1""")
def crosstab_wide(spark: SparkSession, d: str) -> DataFrame:
    return metrics.crosstab_wide(roles.phrase_tickets(spark, d), "pred_complaint_type", "pred_sentiment", fv.SENTIMENTS)


@query(f"""WITH x AS (SELECT * FROM {_PAIRS_SQL})
  SELECT a.t AS true, b.t AS pred, count(x.t) AS n
  FROM (SELECT DISTINCT t FROM x) a CROSS JOIN (SELECT DISTINCT t FROM x) b
  LEFT JOIN x ON x.t = a.t AND x.p = b.t GROUP BY 1, 2""")
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion_matrix(_pairs(spark, d))


@query(report_sql(_PAIRS_SQL))
def classification_report(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.classification_report(_pairs(spark, d)), *_SCORES, "support")


@query(f"SELECT round(avg(CASE WHEN t = p THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM {_PAIRS_SQL}")
def accuracy(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.accuracy(_pairs(spark, d)), "accuracy")


@query(report_sql(_PAIRS_SQL, macro_only=True))
def macro_f1(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.macro_f1(_pairs(spark, d)), "macro_f1")


_FIXED_PAIRS_SQL = f"""(SELECT CASE WHEN pred_complaint_type IN ('Login', 'Account/Subscription') THEN 'Login' ELSE 'Other' END AS t,
    CASE WHEN pred_raw LIKE '%ill%' THEN 'Billing' ELSE 'Other' END AS p FROM {roles.PHRASE_TICKETS_SQL})"""
_SEVEN_SQL = "SELECT unnest([" + ", ".join(roles.text_sql(c) for c in fv.CANONICAL_LABELS) + "]) AS class"


@query(report_sql(_FIXED_PAIRS_SQL, classes=_SEVEN_SQL))
def report_fixed_labels(spark: SparkSession, d: str) -> DataFrame:
    """Four of the seven labels occur on neither side and still get a row of zeros."""
    true = F.when(F.col("pred_complaint_type").isin("Login", "Account/Subscription"), "Login").otherwise("Other")
    pred = F.when(F.col("pred_raw").contains("ill"), "Billing").otherwise("Other")
    pairs = metrics.as_pairs(roles.phrase_tickets(spark, d), true, pred)
    return _rounded(metrics.classification_report(pairs, labels=fv.CANONICAL_LABELS), *_SCORES, "support")


# ---- several runs, several tasks --------------------------------------------------------------

_RUN_NAMES = ("baseline", "zero_shot", "rag", "rag_k5")


def _run_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Four runs as they come from different writers: other column names, JSON answers, stored responses."""
    rows = roles.phrase_tickets(spark, d).withColumnRenamed("ticket_id", "row_index")
    answer = F.to_json(F.struct(F.col("clean_text").alias("complaint_type")))
    call = F.to_json(F.struct(F.array(F.struct(F.struct(F.struct(
        F.to_json(F.struct(F.col("pred_raw").alias("complaint_type"))).alias("arguments")
    ).alias("function_call")).alias("message"))).alias("choices")))
    return {
        "baseline": rows.select("row_index", F.col("pred_raw").alias("complaint_pred_raw")),
        "zero_shot": rows.select("row_index", answer.alias("llm_parsed")),
        "rag": rows.select("row_index", F.col("pred_complaint_type").alias("complaint_pred")),
        "rag_k5": rows.select("row_index", call.alias("raw_response")),
    }


_RUNS_SQL = f"""(SELECT run, {roles.collapse_sql('gold_raw')} AS t, {roles.collapse_sql('raw')} AS p FROM (
    SELECT 'baseline' AS run, gold_raw, pred_raw AS raw FROM {roles.PHRASE_TICKETS_SQL}
    UNION ALL SELECT 'zero_shot', gold_raw, clean_text FROM {roles.PHRASE_TICKETS_SQL}
    UNION ALL SELECT 'rag', gold_raw, pred_complaint_type FROM {roles.PHRASE_TICKETS_SQL}
    UNION ALL SELECT 'rag_k5', gold_raw, pred_raw FROM {roles.PHRASE_TICKETS_SQL}))"""


def _gold(spark: SparkSession, d: str) -> DataFrame:
    return roles.phrase_tickets(spark, d).select(
        F.col("ticket_id").alias("row_index"), F.col("gold_raw").alias("label_complaint_collapsed"))


@query(f"""SELECT m.run, a.accuracy, m.macro_f1, a.n
  FROM ({report_sql(_RUNS_SQL, by='run', macro_only=True)}) m
  JOIN (SELECT run, round(avg(CASE WHEN t = p THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS accuracy, count(*) AS n
        FROM {_RUNS_SQL} GROUP BY run) a ON a.run = m.run""")
def eval_runs(spark: SparkSession, d: str) -> DataFrame:
    scores, _, _ = flows.eval_runs(_gold(spark, d), _run_tables(spark, d))
    return _rounded(scores, "accuracy", "macro_f1")


_SEVEN_BY_RUN_SQL = ("SELECT run, class FROM (SELECT unnest(['" + "', '".join(_RUN_NAMES) + "']) AS run) "
                     f"CROSS JOIN ({_SEVEN_SQL})")


@query(report_sql(_RUNS_SQL, by="run", classes=_SEVEN_BY_RUN_SQL))
def eval_runs_reports(spark: SparkSession, d: str) -> DataFrame:
    _, reports, _ = flows.eval_runs(_gold(spark, d), _run_tables(spark, d))
    return _rounded(reports, *_SCORES, "support")


@query(f"SELECT run, t AS true, p AS pred, count(*) AS n FROM {_RUNS_SQL} GROUP BY 1, 2, 3")
def eval_runs_confusion(spark: SparkSession, d: str) -> DataFrame:
    _, _, confusion = flows.eval_runs(_gold(spark, d), _run_tables(spark, d))
    return confusion


_TASKS_SQL = f"""(
    SELECT 'complaint' AS task, coalesce(gold_raw, 'Unknown') AS t, coalesce(pred_complaint_type, 'Other') AS p
      FROM {roles.PHRASE_TICKETS_SQL}
    UNION ALL SELECT 'severity', coalesce(s.calib_severity, 'Unknown'), coalesce(t.pred_severity, 'Unknown')
      FROM {roles.PHRASE_TICKETS_SQL} t JOIN {roles.severity_sql(roles.PHRASE_TICKETS_SQL)} s ON s.ticket_id = t.ticket_id
    UNION ALL SELECT 'sentiment', coalesce(s.calib_sentiment, 'Unknown'), coalesce(t.pred_sentiment, 'Unknown')
      FROM {roles.PHRASE_TICKETS_SQL} t JOIN {roles.sentiment_sql(roles.PHRASE_TICKETS_SQL)} s ON s.ticket_id = t.ticket_id)"""


@query(report_sql(_TASKS_SQL, by="task"))
def multi_task_eval(spark: SparkSession, d: str) -> DataFrame:
    """Calibrated values play the truth for severity and sentiment."""
    rows = flows.calibrate(roles.phrase_tickets(spark, d)).select(
        F.col("gold_raw").alias("label_complaint_type"), F.col("pred_complaint_type").alias("complaint_pred"),
        F.col("calib_severity").alias("label_severity"), F.col("pred_severity").alias("severity_pred"),
        F.col("calib_sentiment").alias("label_sentiment"), F.col("pred_sentiment").alias("sentiment_pred"))
    return _rounded(flows.multi_task_eval(rows), *_SCORES, "support")


# ---- summaries ------------------------------------------------------------------------------------

_CALIBRATED_SQL = f"""(SELECT t.pred_complaint_type AS c, t.pred_severity AS sev0, v.calib_severity AS sev1,
    t.pred_sentiment AS sen0, s.calib_sentiment AS sen1
  FROM {roles.PHRASE_TICKETS_SQL} t
  JOIN {roles.severity_sql(roles.PHRASE_TICKETS_SQL)} v ON v.ticket_id = t.ticket_id
  JOIN {roles.sentiment_sql(roles.PHRASE_TICKETS_SQL)} s ON s.ticket_id = t.ticket_id)"""


@query(f"""WITH x AS (SELECT * FROM {_CALIBRATED_SQL}),
    v AS (SELECT 'severity' AS field, 'before' AS phase, c AS complaint, sev0 AS value FROM x
          UNION ALL SELECT 'severity', 'after', c, sev1 FROM x
          UNION ALL SELECT 'sentiment', 'before', c, sen0 FROM x
          UNION ALL SELECT 'sentiment', 'after', c, sen1 FROM x)
  SELECT 'rows' AS kind, NULL AS field, NULL AS phase, NULL AS complaint, NULL AS value, count(*) AS n FROM x
  UNION ALL SELECT 'count', field, phase, NULL, value, count(*) FROM v GROUP BY field, phase, value
  UNION ALL SELECT 'crosstab', field, phase, complaint, value, count(*) FROM v
    WHERE complaint IS NOT NULL AND value IS NOT NULL GROUP BY field, phase, complaint, value""")
def calibration_summary(spark: SparkSession, d: str) -> DataFrame:
    return metrics.calibration_summary(flows.calibrate(roles.phrase_tickets(spark, d)))


@query("""SELECT (SELECT count(*) FROM documents) AS n_input_tickets, (SELECT count(*) FROM labels) AS n_processed""")
def inference_summary(spark: SparkSession, d: str) -> DataFrame:
    return metrics.inference_summary(roles.table(spark, d, "documents"), roles.table(spark, d, "labels"))
