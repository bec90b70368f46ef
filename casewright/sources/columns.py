"""Finding the prediction and gold columns of tables whose headers vary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright import fixed_values as fv
from casewright.functions.answers import extract_function_args, safe_parse_json


def _like_labels(df: DataFrame) -> str | None:
    """The first string column with a value that looks like a complaint type; all values count, in one job."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    if not texts:
        return None
    pattern = "|".join(fv.PREDICTION_SNIFF_WORDS)
    hits = df.agg(*[F.max(F.lower(F.col(c)).rlike(pattern)).alias(c) for c in texts]).first()
    return next((c for c in texts if hits[c]), None)


def resolve_pred_col(df: DataFrame) -> DataFrame:
    """Rename the prediction column to ``complaint_pred_raw``.

    By name from the fixed list; a JSON answer column is replaced by its
    complaint_type first. Else the first column with values that look like
    complaint types. Where that gives no value, the stored response is read.
    """
    stored = dict(df.dtypes).get("raw_response") == "string"
    named = _named_prediction(df, stored)
    if not stored:
        return named
    from_response = extract_function_args(F.col("raw_response"))["complaint_type"]
    return named.withColumn("complaint_pred_raw", F.coalesce(F.col("complaint_pred_raw").cast("string"), from_response))


def _named_prediction(df: DataFrame, stored: bool) -> DataFrame:
    found = next((c for c in fv.PREDICTION_COLUMN_NAMES if c in df.columns), None)
    if found in ("llm_parsed", "llm_parsed_json"):
        is_text = dict(df.dtypes)[found] == "string"
        kind = safe_parse_json(F.col(found))["complaint_type"] if is_text else F.col(f"{found}.complaint_type")
        return df.withColumn(found, kind).withColumnRenamed(found, "complaint_pred_raw")
    if found is None and stored:
        return df.withColumn("complaint_pred_raw", F.lit(None).cast("string"))
    if found is None:
        found = _like_labels(df)
    if found is None:
        raise ValueError(f"no prediction column among {df.columns}")
    return df.withColumnRenamed(found, "complaint_pred_raw")


def resolve_gold_col(gold: DataFrame) -> DataFrame:
    """Rename the gold column to ``label_complaint_type``; the first with complaint or label in its name will do."""
    if "label_complaint_type" in gold.columns:
        return gold
    found = next((c for c in gold.columns if "complaint" in c.lower() or "label" in c.lower()), None)
    if found is None:
        raise ValueError(f"no gold label column among {gold.columns}")
    return gold.withColumnRenamed(found, "label_complaint_type")
