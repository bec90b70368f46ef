"""Readers and writers, each as a round trip of a given table through the shared folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv
from casewright.functions import rules
from casewright.operators import metrics, vectors
from casewright.session import fresh_path
from casewright.sources import readers, writers
from workload import roles
from workload.q_metrics import report_sql
from workload.registry import query

_CSV = {"header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False}


@query("SELECT doc_id AS ticket_id, lang, md5(text) AS text_md5 FROM documents")
def read_tickets_csv(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "tickets-csv")
    docs = roles.table(spark, d, "documents").select("doc_id", "lang", "text")
    docs.write.options(**_CSV).csv(path)
    return readers.read_tickets_csv(spark, path).select(
        F.col("doc_id").cast("long").alias("ticket_id"), "lang", F.md5("text").alias("text_md5"))


@query(f"SELECT doc_id, label_complaint_type, md5(clean_text) AS text_md5 FROM {roles.GOLD_TEXTS_SQL}")
def read_labels_csv(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "labels-csv")
    roles.gold_texts(spark, d).write.options(**_CSV).csv(path)
    labels = readers.read_labels_csv(spark, path, ["clean_text", "label_complaint_type"])
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), "label_complaint_type",
                         F.md5("clean_text").alias("text_md5"))


@query(f"""SELECT run, doc_id, label_complaint_type AS complaint_pred_raw
  FROM {roles.GOLD_SQL}, (VALUES ('csv_run'), ('parquet_run')) r(run)""")
def read_predictions(spark: SparkSession, d: str) -> DataFrame:
    base = fresh_path(spark, "predictions")
    preds = roles.gold(spark, d).withColumnRenamed("label_complaint_type", "complaint_pred_raw")
    writers.write_parquet_csv(preds, f"{base}/run.parquet", f"{base}/run.csv")
    paths = {"parquet_run": f"{base}/run.parquet", "csv_run": f"{base}/run.csv", "absent": f"{base}/none.parquet"}
    found = {name: readers.read_predictions(spark, path) for name, path in paths.items()}
    parts = [
        run.select(F.lit(name).alias("run"), F.col("doc_id").cast("long").alias("doc_id"), "complaint_pred_raw")
        for name, run in found.items() if run is not None
    ]
    return parts[0].unionByName(parts[1])


@query(f"""SELECT row_index, CAST(len(embedding) AS BIGINT) AS dims, md5(text) AS text_md5, label_complaint_type,
    round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM {roles.INDEX_SQL}""")
def read_vector_index(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "vector-index")
    vectors.build_vector_index(roles.vector_index(spark, d), path, "row_index", "text")
    return readers.read_vector_index(spark, path).select(
        "row_index", F.size("embedding").cast("long").alias("dims"), F.md5("text").alias("text_md5"),
        "label_complaint_type", F.round(F.col("embedding")[0].cast("double"), 6).alias("first_value"))


def _partials(spark: SparkSession, d: str) -> str:
    """Three appended batches: one without an error column, one in which urgent rows fail, and some retries."""
    path = fresh_path(spark, "partials")
    rows = roles.phrase_tickets(spark, d).select(
        "ticket_id", F.col("pred_raw").alias("complaint_pred"), "pred_severity", "pred_sentiment", "pred_complaint_type")
    first = F.col("pred_sentiment").isNull()
    failed = ~first & F.col("pred_severity").eqNullSafe("Urgent")
    retried = failed & F.col("pred_complaint_type").eqNullSafe("Billing")
    extra = ("pred_severity", "pred_sentiment", "pred_complaint_type")
    writers.write_partial(rows.filter(first).drop(*extra), path)
    writers.write_partial(rows.filter(~first).select(
        "ticket_id", F.when(failed, "Other").otherwise(F.col("complaint_pred")).alias("complaint_pred"),
        F.when(failed, "timeout").alias("error")), path)
    writers.write_partial(rows.filter(retried).drop(*extra).withColumn("error", F.lit(None).cast("string")), path)
    return path


_FAILED_SQL = "(pred_sentiment IS NOT NULL AND pred_severity IS NOT DISTINCT FROM 'Urgent')"
_RETRIED_SQL = f"({_FAILED_SQL} AND pred_complaint_type IS NOT DISTINCT FROM 'Billing')"


@query(f"""SELECT ticket_id, CASE WHEN failed THEN 'Other' ELSE pred_raw END AS complaint_pred,
    CASE WHEN failed THEN 'timeout' END AS error
  FROM (SELECT ticket_id, pred_raw, {_FAILED_SQL} AND NOT {_RETRIED_SQL} AS failed FROM {roles.PHRASE_TICKETS_SQL})""")
def read_partials(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_partials(spark, _partials(spark, d)).select("ticket_id", "complaint_pred", "error")


@query(f"""SELECT ticket_id, CASE WHEN {_RETRIED_SQL} THEN 2 ELSE 1 END::BIGINT AS n_rows,
    CASE WHEN {_FAILED_SQL} THEN 1 ELSE 0 END::BIGINT AS n_errors FROM {roles.PHRASE_TICKETS_SQL}""")
def write_partial(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.read_partials(spark, _partials(spark, d), latest=False)
    return rows.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count("error").alias("n_errors"))


def _break_file(spark: SparkSession, path: str) -> None:
    """A file that has a parquet name and no parquet in it, wherever the shared folder is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(b"PAR1 cut off"))
    stream.close()


@query(f"""SELECT 'row' AS kind, CASE WHEN ticket_id % 3 = 1 AND ticket_id % 2 = 1 THEN NULL ELSE ticket_id END AS ticket_id, pred_raw AS complaint_pred,
    CAST(ticket_id AS VARCHAR) AS input_text FROM {roles.PHRASE_TICKETS_SQL}
  UNION ALL SELECT 'quarantined', NULL, NULL, 'part-broken.parquet'""")
def read_partials_drift(spark: SparkSession, d: str) -> DataFrame:
    """Batches with ids as long, string and int, some of them no numbers, and a broken file: all rows stay, the file is listed."""
    path = fresh_path(spark, "partials-drift")
    number = F.col("ticket_id")
    rows = roles.phrase_tickets(spark, d).select("ticket_id", F.col("pred_raw").alias("complaint_pred"), number.cast("string").alias("input_text"))
    text_id = F.when(number % 2 == 1, F.concat(F.lit("T-"), number)).otherwise(number.cast("string"))
    writers.write_partial(rows.filter(number % 3 == 0), f"{path}/first")
    writers.write_partial(rows.filter(number % 3 == 1).withColumn("ticket_id", text_id), f"{path}/second")
    writers.write_partial(rows.filter(number % 3 == 2).withColumn("ticket_id", number.cast("int")), f"{path}/third")
    _break_file(spark, f"{path}/second/part-broken.parquet")
    found, quarantine = readers.checked_partials(spark, path, latest=False)
    listed = quarantine.select(F.lit("quarantined").alias("kind"), F.lit(None).cast("long").alias("ticket_id"), F.lit(None).cast("string").alias("complaint_pred"),
                               F.element_at(F.split("path", "/"), -1).alias("input_text"))
    return found.select(F.lit("row").alias("kind"), "ticket_id", "complaint_pred", "input_text").unionByName(listed)


def _mapping_values() -> str:
    return ", ".join(
        f"({roles.text_sql(domain.removesuffix('_mapping'))}, {roles.text_sql(v)}, {roles.text_sql(c)})"
        for domain, pairs in fv.LABEL_DICTIONARY.items() for v, c in pairs.items())


@query(f"""SELECT m.domain, m.variant, m.canonical, count(t.ticket_id) AS n
  FROM (VALUES {_mapping_values()}) m(domain, variant, canonical)
  LEFT JOIN {roles.PHRASE_TICKETS_SQL} t ON lower(t.gold_raw) = m.variant AND m.domain = 'complaint'
  GROUP BY 1, 2, 3""")
def read_label_mappings(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "label-mappings")
    spark.createDataFrame([(json.dumps(fv.LABEL_DICTIONARY),)], "value string").write.text(path)
    used = roles.phrase_tickets(spark, d).groupBy(F.lower("gold_raw").alias("variant")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("domain", F.lit("complaint"))
    return readers.read_label_mappings(spark, path).join(used, ["domain", "variant"], "left").select(
        "domain", "variant", "canonical", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query(f"""SELECT form, ticket_id, nullif(clean_text, '') AS clean_text, pred_severity, n_words
  FROM (SELECT ticket_id, clean_text, pred_severity,
          CAST(len(string_split(clean_text, ' ')) AS BIGINT) AS n_words FROM {roles.PHRASE_TICKETS_SQL}),
       (VALUES ('csv'), ('parquet')) f(form)""")
def write_parquet_csv(spark: SparkSession, d: str) -> DataFrame:
    base = fresh_path(spark, "twice")
    rows = roles.phrase_tickets(spark, d).select(
        "ticket_id", "clean_text", "pred_severity", F.split("clean_text", " ").alias("words"))
    writers.write_parquet_csv(rows, f"{base}/parquet", f"{base}/csv")
    stored = spark.read.parquet(f"{base}/parquet").withColumn("form", F.lit("parquet"))
    text = readers.read_csv(spark, f"{base}/csv").withColumns({
        "form": F.lit("csv"), "ticket_id": F.col("ticket_id").cast("long"),
        "words": F.from_json("words", "array<string>")})
    return stored.unionByName(text).select(
        "form", "ticket_id", F.nullif("clean_text", F.lit("")).alias("clean_text"), "pred_severity",
        F.size("words").cast("long").alias("n_words"))


_WRITTEN_SQL = f"(SELECT {roles.collapse_sql('gold_raw')} AS t, {roles.collapse_sql('pred_raw')} AS p FROM {roles.PHRASE_TICKETS_SQL})"


@query(f"SELECT form, r.* FROM ({report_sql(_WRITTEN_SQL)}) r, (VALUES ('csv'), ('json')) f(form)")
def write_metrics(spark: SparkSession, d: str) -> DataFrame:
    base = fresh_path(spark, "metrics")
    pairs = metrics.as_pairs(
        roles.phrase_tickets(spark, d), rules.collapse_label(F.col("gold_raw")), rules.collapse_label(F.col("pred_raw")))
    report = metrics.classification_report(pairs)
    writers.write_metrics(report, f"{base}/json")
    writers.write_metrics(report, f"{base}/csv", "csv")
    schema = report.schema
    both = spark.read.schema(schema).json(f"{base}/json").withColumn("form", F.lit("json")).unionByName(
        spark.read.schema(schema).option("header", True).csv(f"{base}/csv").withColumn("form", F.lit("csv")))
    return both.select("form", "class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "support")])
