"""Classification metrics over (true, pred) pairs, grouped by any columns.

Every metric starts from one ``groupBy(..., true, pred).count()``, which Spark
merges map-side; all that follows works on class-sized tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.rules import collapse_label
from casewright.session import stage

REPORT_COLUMNS = ["class", "precision", "recall", "f1", "support"]


def as_pairs(df: DataFrame, true: Column, pred: Column, *by: Column | str) -> DataFrame:
    return df.select(*by, true.alias("true"), pred.alias("pred"))


def pair_counts(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, true, pred, n). A table that has ``n`` already is added up, so counts can stand for pairs everywhere."""
    if "n" in pairs.columns:
        return pairs.groupBy(*by, "true", "pred").agg(F.sum("n").alias("n"))
    return pairs.groupBy(*by, "true", "pred").agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Contingency table in long form; pairs with a null are left out.

    The nulls go after the aggregation: a filter on the inputs would be pushed
    down and evaluate computed columns a second time.
    """
    both = F.col(rows).isNotNull() & F.col(columns).isNotNull()
    return df.groupBy(rows, columns).agg(F.count_if(both).alias("n")).filter(F.col("n") > 0)


def crosstab_wide(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Contingency table with one column per value; pass the domain to spare the extra job."""
    cells = [F.count_if(F.col(columns) == value).alias(value) for value in values]
    known = F.count_if(F.col(rows).isNotNull() & F.col(columns).isNotNull()).alias("__known")
    return df.groupBy(rows).agg(known, *cells).filter(F.col("__known") > 0).drop("__known")


def accuracy(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    same = F.col("true").eqNullSafe(F.col("pred")).cast("double")
    return pairs.groupBy(*by).agg(F.avg(same).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def class_totals(pairs: DataFrame, by: Sequence[str] = (), labels: Sequence[str] | None = None) -> DataFrame:
    """Support, predicted and hit counts of each class in the union of truth and prediction.

    With ``labels`` exactly those classes are listed, absent ones with zeros.
    """

    def one(name: Column, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            name.alias("class"), support.alias("support"), predicted.alias("predicted"), hits.alias("hits"))

    n, none = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("true") == F.col("pred"), n).otherwise(none)
    sides = [one(F.col("true"), n, none, hit), one(F.col("pred"), none, n, none)]
    counts = pair_counts(pairs, by)
    if labels is not None:
        sides += [one(F.lit(label), none, none, none) for label in labels]
    rows = counts.select(*by, F.explode(F.array(*sides)).alias("s")).select(*by, "s.*")
    if labels is not None:
        rows = rows.filter(F.col("class").isin(list(labels)))
    return rows.groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.when(bottom == 0, F.lit(1)).otherwise(bottom))


def per_class(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of each class; 0/0 is 0."""
    return totals.select(
        *by, "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(F.col("hits") * 2, F.col("predicted") + F.col("support")).alias("f1"),
        "support", "hits",
    )


def classification_report(
    pairs: DataFrame, by: Sequence[str] = (), labels: Sequence[str] | None = None,
) -> DataFrame:
    """Class rows plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows, in long form.

    As in the usual CSV form of such a report, the accuracy row repeats its
    value in every column. Grouping sets give the class rows and the summary
    in one pass.
    """
    scored = per_class(class_totals(pairs, by, labels), by)
    weighted = {
        f"w_{m}": F.sum(F.col(m) * F.col("support")) for m in ("precision", "recall", "f1")
    }
    keys = [F.col(c) for c in by]
    sets = scored.groupingSets([[*keys, F.col("class")], keys], *keys, F.col("class")).agg(
        F.grouping(F.col("class")).alias("is_summary"),
        *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
        F.sum("support").cast("double").alias("support"),
        F.sum("hits").alias("hits"),
        *[total.alias(name) for name, total in weighted.items()],
    )
    support = F.col("support")
    right = _ratio(F.col("hits").cast("double"), support)

    def row(name: Column, precision: Column, recall: Column, f1: Column, size: Column) -> Column:
        return F.struct(
            name.alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), size.alias("support"))

    summary = F.array(
        row(F.lit("accuracy"), right, right, right, right),
        row(F.lit("macro avg"), F.col("precision"), F.col("recall"), F.col("f1"), support),
        row(F.lit("weighted avg"), *[_ratio(F.col(f"w_{m}"), support) for m in ("precision", "recall", "f1")], support),
    )
    single = F.array(row(F.col("class"), F.col("precision"), F.col("recall"), F.col("f1"), support))
    chosen = F.when(F.col("is_summary") == 1, summary).otherwise(single)
    return sets.select(*by, F.explode(chosen).alias("r")).select(*by, "r.*")


def macro_f1(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean F1 over the union of true and predicted classes."""
    return per_class(class_totals(pairs, by), by).groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def run_scores(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Accuracy, macro F1 and row count of each group, from one aggregation."""
    return per_class(class_totals(pairs, by), by).groupBy(*by).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.sum("support").alias("n"),
    )


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """Dense (true, pred, n) over the sorted true classes; predictions outside them are left out.

    The class list is one row of K names; the result itself has K * K rows.
    """
    counts = stage(pair_counts(pairs), "pair-counts")
    classes = counts.agg(F.array_sort(F.collect_set("true")).alias("classes"))
    cells = classes.select("classes", F.explode("classes").alias("true")).select(
        "true", F.explode("classes").alias("pred"))
    return cells.join(counts, ["true", "pred"], "left").select(
        "true", "pred", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def collapsed_pairs(gold: DataFrame, runs: dict[str, DataFrame], gold_col: str, pred_col: str, key: str) -> DataFrame:
    """(run, true, pred) with both sides collapsed to the canonical labels; one union, one join."""
    parts = [
        run.select(F.lit(name).alias("run"), key, F.col(pred_col).cast("string").alias("raw"))
        for name, run in runs.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    truth = gold.select(key, collapse_label(F.col(gold_col)).alias("true"))
    return stacked.join(truth, key).select("run", "true", collapse_label(F.col("raw")).alias("pred"))


def task_pairs(df: DataFrame, tasks: dict[str, tuple[str, str]], fills: dict[str, tuple[str, str]]) -> DataFrame:
    """Stack several (true, pred) column pairs to (task, true, pred), nulls replaced per task.

    A task whose columns are missing is left out.
    """
    stacked = [
        F.struct(
            F.lit(task).alias("task"),
            F.coalesce(F.col(true), F.lit(fills[task][0])).alias("true"),
            F.coalesce(F.col(pred), F.lit(fills[task][1])).alias("pred"),
        )
        for task, (true, pred) in tasks.items() if true in df.columns and pred in df.columns
    ]
    return df.select(F.explode(F.array(*stacked)).alias("p")).select("p.*")


def calibration_summary(df: DataFrame) -> DataFrame:
    """Counts per value and per (complaint, value), before and after calibration.

    Rows: (field, phase, complaint, value, kind, n); kind is ``rows``, ``count``
    (nulls kept) or ``crosstab`` (null pairs left out).
    """

    def view(field: str, phase: str, complaint: str, value: str) -> Column:
        return F.struct(
            F.lit(field).alias("field"), F.lit(phase).alias("phase"),
            F.col(complaint).alias("complaint"), F.col(value).alias("value"))

    views = F.array(
        view("severity", "before", "_orig_pred_complaint", "_orig_pred_severity"),
        view("severity", "after", "pred_complaint_type", "calib_severity"),
        view("sentiment", "before", "_orig_pred_complaint", "_orig_pred_sentiment"),
        view("sentiment", "after", "pred_complaint_type", "calib_sentiment"),
    )
    # Pre-aggregate the stacked rows, then derive the three kinds from that small table.
    cells = (
        df.select(F.explode(views).alias("v")).select("v.*")
        .groupBy("field", "phase", "complaint", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    none = F.lit(None).cast("string")
    field, phase, complaint, value = (F.col(c) for c in ("field", "phase", "complaint", "value"))

    def row(kind: str, f: Column, p: Column, c: Column, v: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), f.alias("field"), p.alias("phase"), c.alias("complaint"), v.alias("value"))

    total = F.when((field == "severity") & (phase == "after"), row("rows", none, none, none, none))
    both = F.when(complaint.isNotNull() & value.isNotNull(), row("crosstab", field, phase, complaint, value))
    kinds = F.array_compact(F.array(total, row("count", field, phase, none, value), both))
    return (
        cells.select(F.explode(kinds).alias("k"), "n").select("k.*", "n")
        .groupBy("kind", "field", "phase", "complaint", "value").agg(F.sum("n").alias("n"))
    )


def inference_summary(tickets: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: tickets read and tickets processed."""
    inputs = tickets.select(F.lit(1).alias("input"), F.lit(0).alias("processed"))
    outputs = predictions.select(F.lit(0).alias("input"), F.lit(1).alias("processed"))
    return inputs.unionAll(outputs).agg(
        F.coalesce(F.sum("input"), F.lit(0)).alias("n_input_tickets"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("n_processed"))
