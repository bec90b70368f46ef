"""Filters, limits, set operations, joins and class statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.fixed_values import LABEL_DICTIONARY
from casewright.operators import baseline, joins, labels, positions
from casewright.sources import readers
from workload import roles
from workload.registry import query

# ---- filters, limits, set operations --------------------------------------------------------


@query(f"SELECT doc_id, label FROM {roles.ORIGIN_SQL} WHERE label IS NOT NULL")
def filter_labeled(spark: SparkSession, d: str) -> DataFrame:
    return labels.filter_labeled(roles.origin_classes(spark, d), "label")


@query(f"SELECT label, count(*) AS n FROM {roles.ORIGIN_SQL} WHERE label IS NOT NULL GROUP BY label HAVING count(*) < 3")
def small_classes(spark: SparkSession, d: str) -> DataFrame:
    return labels.small_classes(roles.origin_classes(spark, d), "label")


@query("SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 100")
def limit_rows(spark: SparkSession, d: str) -> DataFrame:
    return positions.limit_rows(roles.table(spark, d, "documents").select("doc_id", "lang", "source"), 100, "doc_id")


@query(f"SELECT ticket_id AS index, pred_raw AS complaint_pred_raw FROM {roles.PHRASE_TICKETS_SQL}")
def sort_results(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.phrase_tickets(spark, d).select(
        F.col("ticket_id").alias("index"), F.col("pred_raw").alias("complaint_pred_raw"))
    return joins.sort_results(rows)


@query(f"""SELECT ticket_id, pred_raw AS complaint_pred, NULL AS error, NULL AS score FROM {roles.PHRASE_TICKETS_SQL}
  UNION ALL SELECT doc_id, lang, source, NULL FROM documents
  UNION ALL SELECT vec_id, NULL, NULL, label FROM embeddings""")
def union_partials(spark: SparkSession, d: str) -> DataFrame:
    first = roles.phrase_tickets(spark, d).select("ticket_id", F.col("pred_raw").alias("complaint_pred"))
    second = roles.table(spark, d, "documents").select(
        F.col("doc_id").alias("ticket_id"), F.col("lang").alias("complaint_pred"), F.col("source").alias("error"))
    third = roles.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("ticket_id"), F.col("label").alias("score"))
    return joins.union_partials(first, second, third)


# ---- joins ----------------------------------------------------------------------------------


@query(f"""SELECT l.doc_id AS ticket_id, l.label_complaint_type, md5(t.clean_text) AS text_md5
  FROM {roles.GOLD_SQL} l LEFT JOIN {roles.TICKETS_SQL} t ON t.ticket_id = l.doc_id""")
def join_labels_tickets(spark: SparkSession, d: str) -> DataFrame:
    gold = roles.gold(spark, d).withColumnRenamed("doc_id", "ticket_id")
    joined = joins.join_labels_tickets(gold, roles.tickets(spark, d))
    return joined.select("ticket_id", "label_complaint_type", F.md5("clean_text").alias("text_md5"))


@query(f"""SELECT g.doc_id AS row_index, g.label, CAST(p.quality AS VARCHAR) AS complaint_pred
  FROM {roles.ORIGIN_SQL} g LEFT JOIN labels p ON p.doc_id = g.doc_id""")
def join_preds_gold(spark: SparkSession, d: str) -> DataFrame:
    """``labels`` cover some of the documents, so the others have no prediction."""
    preds = roles.table(spark, d, "labels").select(
        F.col("doc_id").alias("row_index"), F.col("quality").cast("string").alias("complaint_pred"))
    return joins.join_preds_gold(roles.origin_classes(spark, d).withColumnRenamed("doc_id", "row_index"), preds)


@query("""SELECT g.doc_id, g.quality, p.vec_id, p.label, g.pos AS row_position
  FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM labels) g
  JOIN (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings) p ON p.pos = g.pos""")
def align_by_position(spark: SparkSession, d: str) -> DataFrame:
    gold = roles.table(spark, d, "labels").select("doc_id", "quality")
    preds = roles.table(spark, d, "embeddings").select("vec_id", "label")
    return joins.align_by_position(gold, preds, "doc_id", "vec_id")


@query("""SELECT t.doc_id AS ticket_id, t.lang, 'row ' || p.doc_id AS input_text, CAST(p.quality AS VARCHAR) AS pred_complaint_raw,
    CAST(p.toxic AS VARCHAR) AS pred_complaint_type, t.doc_id + 1 AS index_no, p.doc_id + 2 AS index_no_pred
  FROM documents t LEFT JOIN labels p ON p.doc_id = t.doc_id""")
def enrich_join(spark: SparkSession, d: str) -> DataFrame:
    tickets = roles.table(spark, d, "documents").select(
        F.col("doc_id").alias("ticket_id"), "lang", (F.col("doc_id") + 1).alias("index_no"))
    preds = roles.table(spark, d, "labels").select(
        F.col("doc_id").alias("ticket_id"), F.concat(F.lit("row "), "doc_id").alias("input_text"),
        F.col("quality").cast("string").alias("complaint_pred_raw"), F.col("toxic").cast("string").alias("complaint_pred"),
        (F.col("doc_id") + 2).alias("index_no"))
    return joins.enrich_join(tickets, preds)


@query("""SELECT doc_id AS ticket_id, lang FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 0)""")
def resume_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """Labelled rows are done, toxic ones failed and are pending again."""
    tickets = roles.table(spark, d, "documents").select(F.col("doc_id").alias("ticket_id"), "lang")
    done = roles.table(spark, d, "labels").select(
        F.col("doc_id").alias("ticket_id"), F.when(F.col("toxic") == 1, "timeout").alias("error"))
    return joins.resume_anti_join(tickets, done)


def _dictionary_sql() -> str:
    pairs = {v.strip(): c for v, c in LABEL_DICTIONARY["complaint_mapping"].items()}
    return ", ".join(f"({roles.text_sql(v)}, {roles.text_sql(c)})" for v, c in pairs.items())


@query(f"""SELECT ticket_id, gold_raw, m.canonical FROM {roles.PHRASE_TICKETS_SQL}
  LEFT JOIN (VALUES {_dictionary_sql()}) m(variant, canonical) ON m.variant = lower(trim(gold_raw))""")
def map_labels_dict(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.phrase_tickets(spark, d).select("ticket_id", "gold_raw")
    return labels.map_labels_dict(rows, readers.label_mappings(spark), "complaint", "gold_raw", "canonical")


# ---- class statistics -------------------------------------------------------------------------


@query("""SELECT pred_severity, count(*) AS n FROM """ + roles.PHRASE_TICKETS_SQL + " GROUP BY pred_severity")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return labels.value_counts(roles.phrase_tickets(spark, d), "pred_severity")


@query(f"SELECT DISTINCT label FROM {roles.ORIGIN_SQL} WHERE label IS NOT NULL")
def distinct_classes(spark: SparkSession, d: str) -> DataFrame:
    return labels.distinct_classes(roles.origin_classes(spark, d), "label")


@query(f"""SELECT doc_id, label, CASE WHEN label IS NOT NULL AND count(*) OVER (PARTITION BY label) < 10
    THEN 'Other' ELSE label END AS label_complaint_collapsed FROM {roles.ORIGIN_SQL}""")
def collapse_rare_classes(spark: SparkSession, d: str) -> DataFrame:
    return labels.collapse_rare_classes(roles.origin_classes(spark, d), "label")


@query(f"""SELECT l.doc_id, l.label_complaint_type, round(t.n / (t.k * c.n), 6) AS class_weight
  FROM {roles.GOLD_SQL} l
  JOIN (SELECT label_complaint_type AS c, count(*) AS n FROM {roles.GOLD_SQL} GROUP BY 1) c ON c.c = l.label_complaint_type
  CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS n, count(DISTINCT label_complaint_type) AS k FROM {roles.GOLD_SQL}) t""")
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    weighted = labels.class_weights(roles.gold(spark, d), "label_complaint_type")
    return weighted.withColumn("class_weight", F.round("class_weight", 6))


# ---- folds and splits ---------------------------------------------------------------------------

_RANKED_SQL = f"""(SELECT *, row_number() OVER (PARTITION BY label_complaint_type
    ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':42')), doc_id) AS rank,
    count(*) OVER (PARTITION BY label_complaint_type) AS n FROM {roles.GOLD_SQL})"""


FOLDS_SQL = f"SELECT doc_id, label_complaint_type, CAST((rank - 1) % 3 AS INTEGER) AS fold FROM {_RANKED_SQL}"


@query(FOLDS_SQL)
def stratified_folds(spark: SparkSession, d: str) -> DataFrame:
    return baseline.stratified_folds(roles.gold(spark, d), "label_complaint_type", "doc_id", 3, 42)


@query(f"""SELECT doc_id, label_complaint_type,
    CASE WHEN rank <= floor(n * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split FROM {_RANKED_SQL}""")
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return baseline.stratified_split(roles.gold(spark, d), "label_complaint_type", "doc_id", 0.2, 42)
