"""Gold labels: filters, rare classes, dictionary lookup and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from casewright.functions.text import strip
from casewright.operators.positions import small_side


def filter_labeled(labels: DataFrame, target: str, min_rows: int = 10) -> DataFrame:
    """Rows with a target; too few of them is an error."""
    if target not in labels.columns:
        raise ValueError(f"target column {target} not found; available columns: {labels.columns}")
    kept = labels.filter(F.col(target).isNotNull())
    if min_rows and kept.limit(min_rows).count() < min_rows:
        raise ValueError(f"too few labelled rows: at least {min_rows} are needed")
    return kept


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def small_classes(labels: DataFrame, target: str, min_count: int = 3) -> DataFrame:
    """Classes with fewer than ``min_count`` rows."""
    return value_counts(labels.filter(F.col(target).isNotNull()), target).filter(F.col("n") < min_count)


def distinct_classes(labels: DataFrame, target: str) -> DataFrame:
    return labels.filter(F.col(target).isNotNull()).select(target).distinct().orderBy(target)


def collapse_rare_classes(
    labels: DataFrame, target: str, min_count: int = 10, into: str = "Other", name: str = "label_complaint_collapsed",
) -> DataFrame:
    """Classes with fewer than ``min_count`` rows become ``into``.

    Counts are aggregated first and joined back, so a dominant class is never
    gathered in one task as a window over the class would do.
    """
    counts = value_counts(labels.filter(F.col(target).isNotNull()), target)
    rare = counts.filter(F.col("n") < min_count).select(target, F.lit(True).alias("__rare"))
    return (
        labels.join(small_side(rare), target, "left")
        .withColumn(name, F.when(F.col("__rare"), F.lit(into)).otherwise(F.col(target)))
        .drop("__rare")
    )


def class_weights(labels: DataFrame, target: str, name: str = "class_weight") -> DataFrame:
    """Balanced weight of each row: rows / (classes * rows of its class)."""
    counts = value_counts(labels.filter(F.col(target).isNotNull()), target)
    everything = W.partitionBy(F.lit(0))  # one row per class, not per label
    weights = counts.select(
        target,
        (F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))).alias(name),
    )
    return labels.join(small_side(weights), target)


def map_labels_dict(df: DataFrame, mapping: DataFrame, domain: str, column: str, name: str) -> DataFrame:
    """Canonical label by exact lookup of the stripped, lower-cased value; null if it is not listed."""
    entries = (
        mapping.filter(F.col("domain") == domain)
        .select(strip(F.col("variant")).alias("__variant"), F.col("canonical").alias(name))
        .distinct()
    )
    return (
        df.withColumn("__variant", F.lower(strip(F.col(column))))
        .join(small_side(entries), "__variant", "left")
        .drop("__variant")
    )
