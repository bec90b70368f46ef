"""The flows: zero-shot and few-shot classification, resumable enrichment, calibration, evaluation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv
from casewright.functions import answers, models, prompts, rules
from casewright.operators import joins, metrics
from casewright.operators.identity import with_row_key
from casewright.operators.vectors import with_snippets
from casewright.session import fresh_path, stage
from casewright.sources import readers, writers
from casewright.sources.columns import resolve_gold_col, resolve_pred_col

PREDICTION_COLUMNS = [
    "ticket_id", "input_text", "complaint_pred_raw", "complaint_pred", "severity_pred", "sentiment_pred",
    "action_required_pred", "root_cause_pred", "raw_response", "error",
]


def classify_zero_shot(
    tickets: DataFrame, template: str, responder: Callable, batch_size: int = 20, text: str = "clean_text",
) -> DataFrame:
    """Prompt, model, JSON answer, columns. Keeps the ticket columns; never fails on a failed call."""
    asked = tickets.withColumns({
        "input_text": F.coalesce(F.col(text), F.lit("")),
        "__reply": models.respond(prompts.fill_prompt(template, F.col(text)), responder, batch_size),
    })
    return (
        asked.withColumns({
            "llm_raw": F.col("__reply.raw"),
            "llm_error": F.col("__reply.error"),
            "__parsed": answers.safe_parse_json(F.col("__reply.raw")),
        })
        .select("*", *answers.parsed_to_columns(F.col("__parsed")))
        .drop("__reply", "__parsed")
    )


def rag_example(index: DataFrame) -> Column:
    """Example with the labels of the index row, for evaluation prompts."""
    def label(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in index.columns else F.lit(default)

    return prompts.example_snippet(F.col("text"), {
        "complaint_type": label("label_complaint_type", "Other"),
        "severity": label("label_severity", "Unknown"),
        "sentiment": label("label_sentiment", "Unknown"),
        "root_cause": label("label_root_cause", "Unknown"),
        "action_required": label("label_action_required", "Unknown"),
    })


def infer_example(index: DataFrame) -> Column:
    """Shorter example for inference prompts: root cause and action are fixed."""
    def label(names: list[str], default: str) -> Column:
        present = [F.col(n) for n in names if n in index.columns]
        return F.coalesce(*present, F.lit(default))

    return prompts.example_snippet(F.col("text"), {
        "complaint_type": label(["label_complaint_type", "label"], "Other"),
        "severity": label(["label_severity"], "Unknown"),
        "sentiment": label(["label_sentiment"], "Unknown"),
        "root_cause": F.lit("Unknown"),
        "action_required": F.lit("Yes"),
    })


def fewshot_prompts(
    tickets: DataFrame, index: DataFrame, k: int, mode: str | Sequence[str] = "rag", key: str = "ticket_id",
    exclude_self: bool = True, **search_options,
) -> DataFrame:
    """Add ``prompt`` to tickets that carry ``embedding``; ``mode`` is rag, full or cheap.

    With several modes there is a row for each, told apart by a column ``mode``. Modes that show the same examples share one search.
    """
    if isinstance(mode, str):
        found = _with_examples(tickets, index, k, mode, key, exclude_self, **search_options)
        return found.withColumn("prompt", prompts.fewshot_prompt(F.col("snippets"), F.col("clean_text"), mode))
    parts = []
    for same in ([m for m in mode if m == "rag"], [m for m in mode if m != "rag"]):
        if same:
            found = _with_examples(tickets, index, k, same[0], key, exclude_self, **search_options)
            filled = [F.struct(F.lit(m).alias("mode"), prompts.fewshot_prompt(F.col("snippets"), F.col("clean_text"), m).alias("prompt")) for m in same]
            parts.append(found.select("*", F.inline(F.array(*filled))))
    return reduce(DataFrame.unionByName, parts)


def _with_examples(tickets: DataFrame, index: DataFrame, k: int, mode: str, key: str, exclude_self: bool, **search_options) -> DataFrame:
    example = rag_example(index) if mode == "rag" else infer_example(index)
    return with_snippets(tickets, index, k, example, key, exclude_self, **search_options)


def classify_rag(
    tickets: DataFrame, index: DataFrame, responder: Callable, k: int = 3, mode: str = "rag", batch_size: int = 20,
    key: str = "ticket_id", exclude_self: bool = True, **search_options,
) -> DataFrame:
    """Few-shot prompt, model, answer, canonical labels. One row per ticket with the prediction columns.

    ``tickets`` has the key, clean_text and embedding; an ``embedding_error``
    column marks tickets that could not be embedded, which get the placeholders.
    A ``row_key`` is kept.
    """
    canonicalize = rules.canonicalize_complaint_rag if mode == "rag" else rules.canonicalize_complaint_infer
    prompted = fewshot_prompts(tickets, index, k, mode, key, exclude_self, **search_options)
    failed = F.col("embedding_error") if "embedding_error" in tickets.columns else F.lit(None).cast("string")
    asked = prompted.withColumn("__failed", failed)
    # A UDF inside a condition runs for every row all the same; what must not be sent is made null.
    sendable = F.when(F.col("__failed").isNull(), F.col("prompt"))
    asked = asked.withColumn("__reply", models.respond(sendable, responder, batch_size))
    read = asked.withColumns({
        "raw_response": F.col("__reply.raw"),
        "error": F.coalesce("__failed", "__reply.error"),
        "__parsed": answers.extract_function_args(F.col("__reply.raw")),
    })
    columns = answers.canonical_prediction(F.col("__parsed"), canonicalize)
    columns = answers.error_placeholder(columns, F.col("error"))
    return read.select(
        F.col(key).alias("ticket_id"), F.coalesce("clean_text", F.lit("")).alias("input_text"),
        *[column.alias(name) for name, column in columns.items()], "raw_response", "error", *_row_key(tickets),
    ).select(*PREDICTION_COLUMNS, *_row_key(tickets))


def _row_key(df: DataFrame) -> list[str]:
    return ["row_key"] if "row_key" in df.columns else []


def _known(spark: SparkSession, partial_path: str, keyed: DataFrame) -> DataFrame:
    """All partial rows with their ``row_key``. Those written without one belong to the rows that have their ticket id."""
    rows = readers.read_partials(spark, partial_path, latest=False)
    by_id = rows.filter(F.col("row_key").isNull()).drop("row_key").join(keyed.select("ticket_id", "row_key"), "ticket_id")
    return rows.filter(F.col("row_key").isNotNull()).unionByName(by_id)


def _enrich_pending(keyed: DataFrame, partial_path: str, classify: Callable[[DataFrame], DataFrame], slices: int) -> None:
    spark = keyed.sparkSession
    pending = joins.resume_anti_join(keyed, _known(spark, partial_path, keyed), "row_key")
    if slices == 1:
        writers.write_partial(classify(pending), partial_path)
        return
    path = fresh_path(spark, "pending-slices")
    pending.withColumn("__slice", F.pmod(F.xxhash64("row_key"), F.lit(slices))).write.partitionBy("__slice").parquet(path)
    for number in range(slices):
        part = spark.read.schema(pending.schema).parquet(path + f"/__slice={number}") if readers.exists(spark, f"{path}/__slice={number}") else None
        if part is not None:
            writers.write_partial(classify(part), partial_path)


def enrich_pending(
    tickets: DataFrame, partial_path: str, classify: Callable[[DataFrame], DataFrame], slices: int = 1,
) -> None:
    """Classify the tickets that have no finished row below ``partial_path`` yet; append the results.

    Each row has a key of its own (``with_row_key``), which ``classify`` must keep as ``row_key``: rows whose ticket ids are
    equal or null get an answer each. Finished work is anti-joined away before any model call. With several slices,
    each is a job of its own whose results outlast a later failure; what is pending is worked out once.
    """
    _enrich_pending(stage(with_row_key(tickets), "keyed-tickets"), partial_path, classify, slices)


def enrich_tickets(
    tickets: DataFrame, partial_path: str, classify: Callable[[DataFrame], DataFrame], slices: int = 1,
) -> DataFrame:
    """Resume, classify, and join everything finished so far back to the tickets, row by row."""
    keyed = stage(with_row_key(tickets), "keyed-tickets")
    _enrich_pending(keyed, partial_path, classify, slices)
    predictions = joins.latest_by_key(_known(tickets.sparkSession, partial_path, keyed), "row_key").drop("written_at", "ticket_id")
    return joins.enrich_join(keyed.drop("embedding", "embedding_error"), predictions, "row_key").drop("row_key")


def calibrate(enriched: DataFrame) -> DataFrame:
    """Keep the original predictions, add calibrated sentiment and severity. One projection, no shuffle."""
    df = joins.snapshot_originals(enriched)
    return rules.fill_calibrated(rules.with_calib_severity(rules.with_calib_sentiment(df)))


def eval_runs(
    gold: DataFrame, runs: dict[str, DataFrame], key: str = "row_index", labels: list[str] | None = fv.CANONICAL_LABELS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores, reports and confusion counts of several runs against collapsed gold labels, keyed by ``run``.

    The runs are read and joined once; all three follow from the counts of (run, true, pred), a class-sized table.
    """
    gold = resolve_gold_col(gold)
    resolved = {name: resolve_pred_col(run) for name, run in runs.items() if run is not None}
    pairs = metrics.collapsed_pairs(gold, resolved, "label_complaint_type", "complaint_pred_raw", key)
    counts = stage(metrics.pair_counts(pairs, ["run"]), "run-counts")
    return metrics.run_scores(counts, ["run"]), metrics.classification_report(counts, ["run"], labels), counts


def read_runs(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The runs whose files exist."""
    found = {name: readers.read_predictions(spark, path) for name, path in paths.items()}
    return {name: run for name, run in found.items() if run is not None}


_TASKS = {
    "rag": {
        "complaint": ("label_complaint_type", "complaint_pred"),
        "severity": ("label_severity", "severity_pred"),
        "sentiment": ("label_sentiment", "sentiment_pred"),
    },
    "zero_shot": {
        "complaint": ("label_complaint_type", "complaint_type_pred"),
        "severity": ("label_severity", "severity_pred"),
        "sentiment": ("label_sentiment", "sentiment_pred"),
    },
}
_FILLS = {
    "rag": {
        "complaint": ("Unknown", "Other"), "severity": ("Unknown", "Unknown"), "sentiment": ("Unknown", "Unknown"),
    },
    "zero_shot": {
        "complaint": ("NULL", "NULL"), "severity": ("NULL", "NULL"), "sentiment": ("NULL", "NULL"),
    },
}


def multi_task_eval(joined: DataFrame, style: str = "rag") -> DataFrame:
    """Reports of complaint, severity and sentiment in one aggregation; ``style`` sets columns and null rules."""
    pairs = metrics.task_pairs(joined, _TASKS[style], _FILLS[style])
    return metrics.classification_report(pairs, ["task"])
