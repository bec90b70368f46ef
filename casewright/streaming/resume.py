"""Enrichment that picks up where it stopped, takes new ticket files as they come, and tries failed rows again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from casewright.operators.identity import with_row_key
from casewright.session import stage
from casewright.sources import readers

_LETTER = [T.StructField("row_key", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("error", T.StringType())]


def _dead_path(out_path: str) -> str:
    return out_path.rstrip("/") + "-dead"


def _committed(spark: SparkSession, dead_path: str) -> list[str]:
    """Labels of the finished steps, in order. A step's dead letters are the last thing it writes."""
    names = [n.removeprefix("batch=") for n in readers.children(spark, dead_path) if n.startswith("batch=")]
    return [n for n in names if readers.exists(spark, f"{dead_path}/batch={n}/_SUCCESS")]


def dead_letters(spark: SparkSession, out_path: str, schema: T.StructType, before: str | None = None) -> DataFrame:
    """The tickets that have no result yet, with their row_key, attempts and last error (before the step of a label)."""
    labels = [n for n in _committed(spark, _dead_path(out_path)) if before is None or n < before]
    letter = T.StructType([*schema.fields, *[T.StructField(f"__{f.name}", f.dataType) for f in _LETTER]])
    if not labels:
        return spark.createDataFrame([], letter)
    return spark.read.schema(letter).parquet(f"{_dead_path(out_path)}/batch={labels[-1]}")


def _step(new: DataFrame, label: str, schema: T.StructType, out_path: str, classify: Callable[[DataFrame], DataFrame], most_attempts: int) -> None:
    """One batch: new tickets and all open dead letters are classified; results and the letters that stay open are written.

    Both outputs have the label in their path and replace what an ended try of the same step left there, so a step that
    runs twice has the effect of one. A step takes the letters of the one before and writes all that are open after it.
    """
    spark = new.sparkSession
    if label in _committed(spark, _dead_path(out_path)):
        return
    letters = dead_letters(spark, out_path, schema, label)
    fresh = with_row_key(new).withColumns({"__attempts": F.lit(0), "__error": F.lit(None).cast("string"), "__row_key": F.col("row_key")}).drop("row_key")
    again = letters.filter(F.col("__attempts") < most_attempts)
    todo = stage(fresh.unionByName(again.withColumn("__row_key", F.concat("__row_key", F.lit("+")))), "stream-todo")
    results = classify(todo.select(*schema.names, F.col("__row_key").alias("row_key")))
    error = next((c for c in ("error", "llm_error") if c in results.columns), None)
    results = stage(results.withColumn("written_at", F.current_timestamp()), "stream-results")  # so that each call is made once
    failed = results.filter(F.col(error).isNotNull()) if error else results.limit(0)
    finished = results.filter(F.col(error).isNull()) if error else results
    finished.drop("row_key").write.mode("overwrite").parquet(f"{out_path}/batch={label}")
    if error and "row_key" not in results.columns:
        raise ValueError("classify has to keep row_key where it marks errors")
    parked = letters.filter(F.col("__attempts") >= most_attempts)
    if error:
        why = failed.select(F.col("row_key").alias("__row_key"), F.col(error).alias("__why"))
        still = todo.join(why, "__row_key").withColumns({"__attempts": F.col("__attempts") + 1, "__error": F.col("__why")}).drop("__why")
        parked = parked.unionByName(still)
    parked.write.mode("overwrite").parquet(f"{_dead_path(out_path)}/batch={label}")


def retry_dead_letters(
    spark: SparkSession, schema: T.StructType, out_path: str, classify: Callable[[DataFrame], DataFrame], most_attempts: int = 5,
) -> None:
    """A step without new tickets, where there are open dead letters."""
    labels = _committed(spark, _dead_path(out_path))
    if labels and not dead_letters(spark, out_path, schema).filter(F.col("__attempts") < most_attempts).isEmpty():
        batch, run = labels[-1].split("-")
        _step(spark.createDataFrame([], schema), f"{batch}-{int(run) + 1:06d}", schema, out_path, classify, most_attempts)


def resume_incremental(
    spark: SparkSession, tickets_path: str, schema: T.StructType, out_path: str, checkpoint_path: str,
    classify: Callable[[DataFrame], DataFrame], max_files: int | None = None, most_attempts: int = 5,
) -> StreamingQuery:
    """Classify all ticket files not seen before and, again, the tickets that ended in an error; then stop.

    Results go to ``out_path`` (one folder a batch), tickets whose call failed to the dead-letter table beside it, which the next
    batch or the next run reads again, ``most_attempts`` times at most; after that they stay there. A ticket has one finished row or is a
    dead letter. Each batch counts once even if it is run twice. ``max_files`` bounds the files per batch. ``classify``
    marks failed rows in a column ``error`` or ``llm_error`` and then has to keep ``row_key``, a key that is unique in the batch.
    """
    retry_dead_letters(spark, schema, out_path, classify, most_attempts)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def step(batch: DataFrame, number: int) -> None:
        _step(batch, f"{number:012d}-000000", schema, out_path, classify, most_attempts)

    return (
        reader.parquet(tickets_path).writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
