"""Joins between tickets, labels, predictions and checkpoint partials."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.operators.positions import key_position, small_side

ENRICHED_NAMES = {
    "complaint_pred": "pred_complaint_type",
    "severity_pred": "pred_severity",
    "sentiment_pred": "pred_sentiment",
    "action_required_pred": "pred_action_required",
    "root_cause_pred": "pred_root_cause",
    "complaint_pred_raw": "pred_complaint_raw",
}


def join_labels_tickets(labels: DataFrame, tickets: DataFrame, row_key: str | None = None) -> DataFrame:
    """labels ⟕ tickets on ticket_id, or on ``row_key`` if a side has no id; one ``clean_text`` column."""
    both_have_id = "ticket_id" in labels.columns and "ticket_id" in tickets.columns
    key = "ticket_id" if both_have_id else row_key
    if not both_have_id and "clean_text" in labels.columns:
        return labels
    if key is None or "clean_text" not in tickets.columns:
        raise ValueError("no clean_text available in labels or tickets")
    texts = tickets.select(key, F.col("clean_text").alias("__ticket_text"))
    joined = labels.join(texts, key, "left")
    own = [F.col("clean_text")] if "clean_text" in labels.columns else []
    return joined.withColumn("clean_text", F.coalesce(*own, F.col("__ticket_text"))).drop("__ticket_text")


def join_preds_gold(gold: DataFrame, predictions: DataFrame, key: str = "row_index") -> DataFrame:
    """gold ⟕ predictions; every gold row is kept."""
    return gold.join(predictions, key, "left")


def align_by_position(gold: DataFrame, predictions: DataFrame, gold_key: str, prediction_key: str) -> DataFrame:
    """Pair the i-th gold row with the i-th prediction in key order; the longer side's tail drops out.

    For files that were written without a shared key. Where a key exists, join on it.
    """
    left = key_position(gold, gold_key, "row_position")
    right = key_position(predictions, prediction_key, "row_position")
    clash = set(left.columns) & set(right.columns) - {"row_position"}
    right = right.withColumnsRenamed({c: f"{c}_pred" for c in clash})
    return left.join(right, "row_position")


def rename_enriched(df: DataFrame) -> DataFrame:
    """Final names of the prediction columns; the helper index goes."""
    return df.withColumnsRenamed(ENRICHED_NAMES).drop("index_tmp")


def enrich_join(tickets: DataFrame, predictions: DataFrame, key: str = "ticket_id") -> DataFrame:
    """tickets ⟕ predictions; prediction columns that clash with a ticket column get the suffix ``_pred``."""
    clash = {c: f"{c}_pred" for c in predictions.columns if c in tickets.columns and c != key}
    return rename_enriched(tickets.join(predictions.withColumnsRenamed(clash), key, "left"))


def resume_anti_join(tickets: DataFrame, done: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Tickets without a finished prediction; a row that ended in an error counts as not done."""
    finished = done.filter(F.col("error").isNull()) if "error" in done.columns else done
    return tickets.join(finished.select(key), key, "left_anti")


def latest_by_key(partials: DataFrame, key: str = "ticket_id", written: str = "written_at") -> DataFrame:
    """One row per key: a success before an error, then the latest. Merged map-side, so hot keys do not pile up."""
    rest = [c for c in partials.columns if c != key]
    preference = F.struct(F.col("error").isNull(), F.col(written), F.xxhash64(*rest))
    best = F.max_by(F.struct(*rest), preference).alias("__row")
    return partials.groupBy(key).agg(best).select(key, "__row.*")


def salted_join(left: DataFrame, right: DataFrame, key: str, spread_by: str, rows_per_task: int = 1_000_000) -> DataFrame:
    """Inner join of a table with hot keys to one with a row per key.

    Rows of a key that has more than ``rows_per_task`` of them are spread by hash over
    several tasks, and only that key's row of ``right`` is copied to each. ``left``
    is read twice, so stage it if it is costly.
    """
    parts = F.ceil(F.col("n") / rows_per_task).cast("int").alias("__parts")
    hot = small_side(
        left.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows_per_task).select(key, parts))
    shares = F.coalesce("__parts", F.lit(1))
    salted = left.join(hot, key, "left").withColumn("__salt", F.pmod(F.xxhash64(spread_by), shares).cast("int"))
    copies = right.join(hot, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), shares - 1)))
    return salted.drop("__parts").join(copies.drop("__parts"), [key, "__salt"]).drop("__salt")


def union_partials(*parts: DataFrame) -> DataFrame:
    """Concatenate tables whose columns drifted; missing columns become null."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def sort_results(df: DataFrame, key: str = "index") -> DataFrame:
    return df.orderBy(key)


def snapshot_originals(df: DataFrame) -> DataFrame:
    """Copies of the three predictions before calibration; null columns where one is absent."""
    copies = {
        "_orig_pred_severity": "pred_severity",
        "_orig_pred_sentiment": "pred_sentiment",
        "_orig_pred_complaint": "pred_complaint_type",
    }
    return df.withColumns({
        new: F.col(old) if old in df.columns else F.lit(None).cast("string") for new, old in copies.items()
    })


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select([c for c in wanted if c in df.columns])
