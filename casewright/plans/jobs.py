"""The jobs from file to file: each reads its inputs, runs a flow and writes results and metrics.

``embed`` arguments take a DataFrame with ``clean_text`` and add ``embedding``
(and ``embedding_error`` where calls can fail); ``responder`` arguments take a
list of prompts and give a list of answers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv
from casewright.functions import models
from casewright.operators import baseline, joins, labels as lb, metrics, prepare, vectors
from casewright.operators.positions import file_position, limit_rows
from casewright.plans import flows
from casewright.session import stage
from casewright.sources import readers, writers

Embed = Callable[[DataFrame], DataFrame]


def hashed(df: DataFrame) -> DataFrame:
    """The offline embedder."""
    return vectors.hashed_embedding(df, "clean_text")


def embed_with(embedder: Callable, batch_size: int = 50) -> Embed:
    """An ``embed`` argument from a function list[str] -> list of vectors."""

    def embed(df: DataFrame) -> DataFrame:
        called = df.withColumn("__e", models.embed(F.col("clean_text"), embedder, batch_size))
        return called.withColumns({"embedding": F.col("__e.vector"), "embedding_error": F.col("__e.error")}).drop("__e")

    return embed


def _with_row_index(df: DataFrame) -> DataFrame:
    """The row key of a table: its own, or the position in its file."""
    if "row_index" in df.columns:
        return df.withColumn("row_index", F.col("row_index").cast("long"))
    if "index" in df.columns:
        return df.withColumn("index", F.col("index").cast("long")).withColumnRenamed("index", "row_index")
    return file_position(df, "row_index")


def _keyed_run(run: DataFrame, gold: DataFrame, path: str) -> DataFrame:
    """Predictions with the row key of the labels: by index, by ticket id, or, in a CSV file, by position.

    Parquet written after a join has no order, so its positions say nothing.
    """
    if "row_index" in run.columns or "index" in run.columns:
        return _with_row_index(run)
    if "ticket_id" in run.columns and "ticket_id" in gold.columns:
        keys = gold.select(F.col("ticket_id").cast("long").alias("ticket_id"), "row_index")
        return run.withColumn("ticket_id", F.col("ticket_id").cast("long")).join(keys, "ticket_id")
    if path.rstrip("/").endswith((".parquet", ".pq")):
        raise ValueError(f"{path} has neither an index nor a ticket id that the labels share")
    return _with_row_index(run)


def _labels(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Labels with row keys, staged: several steps read them."""
    return stage(_with_row_index(readers.read_labels_csv(spark, path, required)), "labels")


def clean_job(spark: SparkSession, raw_csv: str, out_parquet: str, multi_line: bool = True, strict: bool = True) -> None:
    raw = readers.read_tickets_csv(spark, raw_csv, multi_line)
    prepare.prepare_tickets(raw, strict=strict).write.mode("overwrite").parquet(out_parquet)


def baseline_job(
    spark: SparkSession, labels_csv: str, target: str, out_dir: str, cv: int = 3, test_size: float = 0.2,
    **fit_options,
) -> None:
    """Model, report, confusion matrix, summary and predictions; ``cv`` below 2 evaluates on a split.

    Predictions carry ``split``: ``held_out`` rows were predicted by a model that
    had not seen them, ``train`` rows by the final one that had.
    """
    rows = lb.filter_labeled(_labels(spark, labels_csv, ["clean_text", target]), target)
    key, text = "row_index", "clean_text"
    if cv >= 2:
        held_out = baseline.cross_val_predict(rows, key, text, target, cv, **fit_options)
    else:
        parts = stage(baseline.stratified_split(rows, target, key, test_size), "split")
        fitted = baseline.logreg_fit(parts.filter("split = 'train'"), key, text, target, **fit_options)
        held_out = baseline.predict(fitted, parts.filter("split = 'test'"), key, target)
    held_out = stage(held_out.select(key, target, "complaint_pred_raw"), "held-out")

    final = baseline.logreg_fit(rows, key, text, target, **fit_options)
    baseline.save_model(final, f"{out_dir}/model")
    seen = baseline.predict(final, rows, key).withColumn("split", F.lit("train"))
    both = seen.unionByName(held_out.drop(target).withColumn("split", F.lit("held_out")))
    both.withColumnRenamed(key, "index").write.mode("overwrite").option("header", True).csv(f"{out_dir}/baseline_preds.csv")

    pairs = metrics.as_pairs(held_out, F.col(target), F.col("complaint_pred_raw"))
    writers.write_metrics(metrics.classification_report(pairs), f"{out_dir}/classification_report", "csv")
    writers.write_metrics(metrics.confusion_matrix(pairs), f"{out_dir}/confusion_matrix", "csv")
    writers.write_metrics(metrics.run_scores(pairs, []), f"{out_dir}/summary")
    writers.write_metrics(lb.small_classes(rows, target), f"{out_dir}/small_classes")


def index_job(spark: SparkSession, labels_csv: str, out_path: str, embed: Embed = hashed) -> None:
    """The vector index of the labelled rows. A row that cannot be embedded fails the job."""
    embedded = embed(_labels(spark, labels_csv, ["clean_text"]))
    if "embedding_error" in embedded.columns:
        error = F.coalesce("embedding_error", F.lit("no vector"))
        embedded = embedded.withColumn("embedding", F.coalesce("embedding", F.raise_error(error)))
    vectors.build_vector_index(embedded, out_path, "row_index")


def zero_shot_job(
    spark: SparkSession, tickets_parquet: str, labels_csv: str, out_dir: str, responder: Callable,
    template: str = fv.ZERO_SHOT_TEMPLATE, batch_size: int = 20,
) -> None:
    """Classify the labelled tickets without examples; responses, comparison table and reports."""
    gold = _labels(spark, labels_csv, [])
    tickets = spark.read.parquet(tickets_parquet)
    if "ticket_id" in gold.columns:
        gold = gold.withColumn("ticket_id", F.col("ticket_id").cast("long"))
    elif "clean_text" not in gold.columns:
        tickets = _with_row_index(tickets)
    asked = joins.join_labels_tickets(gold, tickets, "row_index")
    answered = flows.classify_zero_shot(asked, template, responder, batch_size)
    writers.write_parquet_csv(answered, f"{out_dir}/responses.parquet", f"{out_dir}/responses.csv")
    written = spark.read.parquet(f"{out_dir}/responses.parquet")
    writers.write_metrics(flows.multi_task_eval(written, "zero_shot"), f"{out_dir}/summary")
    writers.write_metrics(joins.select_present(written, fv.COMPARE_COLUMNS), f"{out_dir}/evaluation", "csv")


def rag_eval_job(
    spark: SparkSession, labels_csv: str, index_path: str, out_dir: str, responder: Callable, embed: Embed = hashed,
    k: int = 3, batch_size: int = 20, exclude_self: bool = True,
) -> None:
    """Classify the labelled rows with the nearest other rows as examples; responses and reports."""
    gold = _labels(spark, labels_csv, ["clean_text"])
    answered = flows.classify_rag(
        embed(gold), readers.read_vector_index(spark, index_path), responder, k, "rag", batch_size, "row_index",
        exclude_self,
    ).withColumnRenamed("ticket_id", "index")
    writers.write_parquet_csv(answered, f"{out_dir}/responses.parquet", f"{out_dir}/responses.csv")
    written = spark.read.parquet(f"{out_dir}/responses.parquet").withColumnRenamed("index", "row_index")
    joined = joins.join_preds_gold(gold, written)
    writers.write_metrics(flows.multi_task_eval(joined, "rag"), f"{out_dir}/summary")


def enrich_job(
    spark: SparkSession, tickets_parquet: str, index_path: str, out_dir: str, responder: Callable,
    embed: Embed = hashed, k: int = 5, cheap_mode: bool = False, limit: int | None = None, batch_size: int = 20,
    slices: int = 1,
) -> None:
    """Classify all tickets, resuming from ``out_dir/partial``; enriched table and progress summary."""
    tickets = spark.read.parquet(tickets_parquet)
    if limit:
        tickets = limit_rows(tickets, limit, "ticket_id")
    index = readers.read_vector_index(spark, index_path)

    def classify(pending: DataFrame) -> DataFrame:
        mode = "cheap" if cheap_mode else "full"
        return flows.classify_rag(embed(pending), index, responder, k, mode, batch_size, exclude_self=False)

    enriched = flows.enrich_tickets(tickets, f"{out_dir}/partial", classify, slices)
    writers.write_parquet_csv(enriched, f"{out_dir}/tickets_enriched.parquet", f"{out_dir}/tickets_enriched.csv")
    done, unreadable = readers.checked_partials(spark, f"{out_dir}/partial", key="row_key")
    writers.write_metrics(metrics.inference_summary(tickets, done.select("row_key")), f"{out_dir}/inference_summary")
    writers.write_metrics(unreadable, f"{out_dir}/quarantine")


def evaluate_job(spark: SparkSession, labels_csv: str, runs: dict[str, str], out_dir: str) -> None:
    """Score the runs whose files exist against the collapsed gold labels.

    Predictions of a baseline are scored on their held-out rows.
    """
    gold, found = _labels(spark, labels_csv, []), {}
    for name, run in flows.read_runs(spark, runs).items():
        run = _keyed_run(run, gold, runs[name])
        found[name] = run.filter("split = 'held_out'") if "split" in run.columns else run
    scores, reports, confusion = flows.eval_runs(gold, found)
    writers.write_metrics(scores, f"{out_dir}/summary_all")
    writers.write_metrics(reports, f"{out_dir}/classification_reports")
    writers.write_metrics(confusion, f"{out_dir}/confusion", "csv")


def calibrate_job(spark: SparkSession, enriched_parquet: str, out_dir: str) -> None:
    """Recalibrated table and the counts before and after."""
    calibrated = flows.calibrate(spark.read.parquet(enriched_parquet))
    target = f"{out_dir}/tickets_enriched_calibrated"
    writers.write_parquet_csv(calibrated, f"{target}.parquet", f"{target}.csv")
    written = spark.read.parquet(f"{target}.parquet")
    writers.write_metrics(metrics.calibration_summary(written), f"{out_dir}/calibration_summary")
