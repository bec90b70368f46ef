"""Metrics against published figures, copied here as numbers."""

import pytest
from pyspark.sql import functions as F

from casewright import fixed_values as fv
from casewright.operators import metrics
from casewright.plans import flows
from casewright.sources import columns

NINE = ["Account/Subscription", "Billing", "Customer Sdervice", "Customer Service", "Login", "Other", "Payment/Billing",
        "Performance/Latency", "Product Defect"]
NINE_MATRIX = [
    [2, 0, 0, 0, 0, 0, 0, 0, 0],
    [0, 0, 0, 2, 1, 0, 1, 0, 1],
    [0, 0, 0, 1, 0, 0, 0, 0, 0],
    [0, 3, 1, 0, 2, 0, 0, 1, 3],
    [3, 3, 1, 3, 2, 6, 1, 1, 6],
    [0, 0, 0, 1, 3, 2, 0, 0, 2],
    [0, 1, 0, 0, 0, 0, 0, 0, 0],
    [0, 1, 0, 0, 0, 0, 0, 0, 1],
    [9, 49, 7, 29, 25, 35, 4, 13, 24],
]
NINE_REPORT = {
    "Account/Subscription": (0.14285714285714285, 1.0, 0.25, 2.0),
    "Billing": (0.0, 0.0, 0.0, 5.0),
    "Customer Sdervice": (0.0, 0.0, 0.0, 1.0),
    "Customer Service": (0.0, 0.0, 0.0, 10.0),
    "Login": (0.06060606060606061, 0.07692307692307693, 0.06779661016949153, 26.0),
    "Other": (0.046511627906976744, 0.25, 0.0784313725490196, 8.0),
    "Payment/Billing": (0.0, 0.0, 0.0, 1.0),
    "Performance/Latency": (0.0, 0.0, 0.0, 2.0),
    "Product Defect": (0.6486486486486487, 0.12307692307692308, 0.20689655172413793, 195.0),
    "accuracy": (0.12, 0.12, 0.12, 0.12),
    "macro avg": (0.09984705333542543, 0.1611111111111111, 0.06701383716029434, 250.0),
    "weighted avg": (0.5148802054848567, 0.12, 0.17293996172402334, 250.0),
}
FOUR = ["Customer Service", "Login", "Other", "Product Defect"]
FOUR_MATRIX = [[0, 3, 4, 3], [8, 3, 8, 7], [10, 4, 1, 4], [73, 38, 48, 36]]
FOUR_REPORT = {
    "Customer Service": (0.0, 0.0, 0.0, 10.0),
    "Login": (0.0625, 0.11538461538461539, 0.08108108108108109, 26.0),
    "Other": (0.01639344262295082, 0.05263157894736842, 0.025, 19.0),
    "Product Defect": (0.72, 0.18461538461538463, 0.2938775510204082, 195.0),
    "accuracy": (0.16, 0.16, 0.16, 0.16),
    "macro avg": (0.1997233606557377, 0.0881578947368421, 0.09998965802537232, 250.0),
    "weighted avg": (0.5693459016393443, 0.16, 0.23955692222835082, 250.0),
}


def pairs_of(spark, names, matrix):
    rows = [(t, p) for t, line in zip(names, matrix) for p, n in zip(names, line) for _ in range(n)]
    return spark.createDataFrame(rows, "true string, pred string")


def report_of(df):
    return {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in df.collect()}


@pytest.mark.parametrize("names, matrix, expected", [(NINE, NINE_MATRIX, NINE_REPORT), (FOUR, FOUR_MATRIX, FOUR_REPORT)])
def test_published_baselines(spark, names, matrix, expected):
    pairs = pairs_of(spark, names, matrix)
    got = report_of(metrics.classification_report(pairs))
    assert set(got) == set(expected)
    for name, figures in expected.items():
        assert got[name] == pytest.approx(figures, abs=1e-12), name
    assert metrics.macro_f1(pairs).first()[0] == pytest.approx(expected["macro avg"][2], abs=1e-12)
    assert metrics.accuracy(pairs).first()[0] == pytest.approx(expected["accuracy"][0], abs=1e-12)
    dense = {(r["true"], r["pred"]): r.n for r in metrics.confusion_matrix(pairs).collect()}
    assert dense == {(t, p): n for t, line in zip(names, matrix) for p, n in zip(names, line)}


# Few-shot run over the same 250 rows. Only marginals and hits were published: class -> (support, predicted, hits).
TASKS = {
    "complaint": ({"Account/Subscription": (2, 0, 0), "Billing": (5, 0, 0), "Customer Sdervice": (1, 0, 0),
                   "Customer Service": (10, 0, 0), "Login": (26, 13, 1), "Other": (8, 237, 8),
                   "Payment/Billing": (1, 0, 0), "Performance/Latency": (2, 0, 0), "Product Defect": (195, 0, 0)},
                  0.036, 0.012954241525670098, 0.00742312925170068),
    "severity": ({"High": (85, 3, 1), "Low": (8, 233, 8), "Medium": (157, 14, 12)},
                 0.084, 0.07648939713801037, 0.09799210493226652),
    "sentiment": ({"Negative": (242, 3, 3), "Neutral": (8, 247, 8)},
                  0.044, 0.04361744697879152, 0.025713965586234493),
}


def pairs_from_marginals(totals):
    hits = [(c, c) for c, (_, _, h) in totals.items() for _ in range(h)]
    truths = [c for c, (s, _, h) in totals.items() for _ in range(s - h)]
    guesses = [c for c, (_, p, h) in totals.items() for _ in range(p - h)]
    shift = next(n for n in range(len(guesses)) if all(t != g for t, g in zip(truths, guesses[n:] + guesses[:n])))
    return hits + list(zip(truths, guesses[shift:] + guesses[:shift]))


def test_published_few_shot_tasks(spark):
    rows = [(task, t, p) for task, (totals, *_) in TASKS.items() for t, p in pairs_from_marginals(totals)]
    pairs = spark.createDataFrame(rows, "task string, true string, pred string")
    got = {}
    for r in metrics.classification_report(pairs, ["task"]).collect():
        got.setdefault(r.task, {})[r["class"]] = r
    for task, (_, accuracy, macro, weighted) in TASKS.items():
        assert got[task]["accuracy"].f1 == pytest.approx(accuracy, abs=1e-12)
        assert got[task]["macro avg"].f1 == pytest.approx(macro, abs=1e-12)
        assert got[task]["weighted avg"].f1 == pytest.approx(weighted, abs=1e-12)


def test_macro_uses_union_and_fixed_labels_do_not(spark):
    pairs = spark.createDataFrame([("Login", "Login"), ("Login", "Billing")], "true string, pred string")
    f1 = 2 * 1 / 3
    assert metrics.macro_f1(pairs).first()[0] == pytest.approx(f1 / 2)
    fixed = report_of(metrics.classification_report(pairs, labels=fv.CANONICAL_LABELS))
    assert fixed["macro avg"][2] == pytest.approx(f1 / 7) and fixed["Other"] == (0.0, 0.0, 0.0, 0.0)
    assert fixed["accuracy"][0] == 0.5


def test_eval_runs_reads_every_prediction_form(spark):
    gold = spark.createDataFrame([(0, "bug"), (1, "refund"), (2, None)], "row_index int, my_label string")
    plain = spark.createDataFrame([(0, "product"), (1, "login"), (2, "?")], "row_index int, prediction string")
    parsed = spark.createDataFrame([(0, '{"complaint_type": "defect"}'), (1, "{"), (2, None)],
                                   "row_index int, llm_parsed string")
    struct = plain.select("row_index", F.struct(F.col("prediction").alias("complaint_type")).alias("llm_parsed"))
    sniffed = plain.withColumnRenamed("prediction", "whatever")
    scores, reports, _ = flows.eval_runs(
        gold, {"plain": plain, "parsed": parsed, "struct": struct, "sniffed": sniffed, "absent": None})
    got = {r.run: r.accuracy for r in scores.collect()}
    assert got == pytest.approx({"plain": 2 / 3, "parsed": 2 / 3, "struct": 2 / 3, "sniffed": 2 / 3})
    assert reports.filter("run = 'plain'").count() == 10
    with pytest.raises(ValueError):
        columns.resolve_pred_col(spark.createDataFrame([(1, "zzz")], "a int, b string"))
    with pytest.raises(ValueError):
        columns.resolve_gold_col(spark.createDataFrame([(1,)], "a int"))
    response = '{"choices":[{"message":{"function_call":{"arguments":"{\\"complaint_type\\":\\"Login\\"}"}}}]}'
    stored = spark.createDataFrame([(0, response)], "row_index int, raw_response string")
    assert columns.resolve_pred_col(stored).first().complaint_pred_raw == "Login"
    empty = stored.withColumn("complaint_pred_raw", F.lit(None).cast("string"))
    assert columns.resolve_pred_col(empty).first().complaint_pred_raw == "Login"


def test_multi_task_null_rules(spark):
    df = spark.createDataFrame(
        [(None, None, None, "Low")],
        "label_complaint_type string, complaint_pred string, label_severity string, severity_pred string")
    classes = {(r.task, r["class"]) for r in flows.multi_task_eval(df).collect()}
    assert {("complaint", "Unknown"), ("complaint", "Other"), ("severity", "Unknown"), ("severity", "Low")} <= classes
    assert not any(task == "sentiment" for task, _ in classes)


def test_calibration_summary_counts(spark):
    df = spark.createDataFrame(
        [("Billing", "High", "Positive", "x"), (None, None, None, "y"), ("Other", "Low", None, "thanks")],
        "pred_complaint_type string, pred_severity string, pred_sentiment string, clean_text string")
    rows = metrics.calibration_summary(flows.calibrate(df)).collect()
    assert [r.n for r in rows if r.kind == "rows"] == [3]
    assert sum(r.n for r in rows if r.kind == "count" and r.field == "severity" and r.phase == "before") == 3
    assert sum(r.n for r in rows if r.kind == "crosstab" and r.field == "sentiment" and r.phase == "before") == 1


def test_prediction_column_by_name_and_by_value(spark):
    named = spark.createDataFrame([("Login", "q")], "raw_pred string, other string")
    assert columns.resolve_pred_col(named).first().complaint_pred_raw == "Login"
    late = spark.createDataFrame([("zzz", "zzz")] * 200 + [("zzz", "billing")], "a string, b string").repartition(4)
    assert columns.resolve_pred_col(late).columns == ["a", "complaint_pred_raw"]


def test_counts_stand_for_pairs(spark):
    pairs = spark.createDataFrame([("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")], "true string, pred string")
    counted = metrics.pair_counts(pairs)
    for f in (metrics.classification_report, metrics.macro_f1, metrics.confusion_matrix):
        assert sorted(map(tuple, f(pairs).collect()), key=repr) == sorted(map(tuple, f(counted).collect()), key=repr)
