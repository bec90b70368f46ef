"""Model calls, resume and the TF-IDF baseline."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv
from casewright.functions import models, rules
from casewright.functions.models import keyword_call_responder, keyword_text_responder, vote_call_responder
from casewright.functions.text import strip
from casewright.operators import baseline, labels, metrics, vectors
from casewright.plans import flows
from casewright.session import fresh_path, stage
from casewright.sources import readers
from casewright.streaming.resume import dead_letters, resume_incremental as run_stream
from workload import roles
from workload.q_labels import FOLDS_SQL
from workload.registry import query

# ---- classification ---------------------------------------------------------------------------

_URGENT_SQL = roles.any_sql("lower(clean_text)", fv.CRITICAL_WORDS)
_ASKING_SQL = roles.any_sql("lower(clean_text)", fv.NEUTRAL_WORDS)
_ANSWER_SQL = f"""{roles.infer_sql('clean_text')} AS complaint,
    CASE WHEN {_URGENT_SQL} THEN 'High' ELSE 'Medium' END AS severity,
    CASE WHEN {_ASKING_SQL} THEN 'Neutral' ELSE 'Negative' END AS sentiment,
    CASE WHEN {_URGENT_SQL} THEN 'Yes' ELSE 'No' END AS action"""


def _all_tickets(spark: SparkSession, d: str) -> DataFrame:
    """Documents, and the phrase tickets under negative numbers."""
    phrases = roles.phrase_tickets(spark, d).select((-1 - F.col("ticket_id")).alias("ticket_id"), "clean_text")
    return roles.tickets(spark, d).unionByName(phrases)


_ALL_TICKETS_SQL = f"""(SELECT ticket_id, clean_text FROM {roles.TICKETS_SQL}
  UNION ALL SELECT -1 - ticket_id, clean_text FROM {roles.PHRASE_TICKETS_SQL})"""


@query(f"""SELECT ticket_id, complaint AS complaint_type_pred, severity AS severity_pred, sentiment AS sentiment_pred,
    'Unknown' AS root_cause_pred, action AS action_required_pred, CAST(NULL AS VARCHAR) AS llm_error
  FROM (SELECT ticket_id, {_ANSWER_SQL} FROM {_ALL_TICKETS_SQL})""")
def classify_zero_shot(spark: SparkSession, d: str) -> DataFrame:
    found = flows.classify_zero_shot(_all_tickets(spark, d), fv.ZERO_SHOT_TEMPLATE, keyword_text_responder)
    return found.select("ticket_id", "complaint_type_pred", "severity_pred", "sentiment_pred", "root_cause_pred",
                        "action_required_pred", "llm_error")


def _embedded(tickets: DataFrame) -> DataFrame:
    return vectors.hashed_embedding(tickets, "clean_text")


def _labelled_index(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "labelled-index")
    vectors.build_vector_index(_embedded(roles.gold_texts(spark, d)), path, "doc_id")
    return readers.read_vector_index(spark, path)


@query(f"""SELECT ticket_id, md5(clean_text) AS text_md5, complaint AS complaint_pred_raw,
    {roles.rag_sql('complaint')} AS complaint_pred, severity AS severity_pred, sentiment AS sentiment_pred,
    action AS action_required_pred, 'Unknown' AS root_cause_pred, CAST(NULL AS VARCHAR) AS error
  FROM (SELECT ticket_id, clean_text, {_ANSWER_SQL} FROM {_ALL_TICKETS_SQL})""")
def classify_rag(spark: SparkSession, d: str) -> DataFrame:
    found = flows.classify_rag(_embedded(_all_tickets(spark, d)), _labelled_index(spark, d), keyword_call_responder, k=3)
    return found.withColumn("text_md5", F.md5("input_text")).drop("input_text", "raw_response")


_ENRICHED_SQL = f"""SELECT ticket_id, md5(clean_text) AS text_md5, md5(clean_text) AS input_md5,
    complaint AS pred_complaint_raw, {roles.infer_sql('complaint')} AS pred_complaint_type, severity AS pred_severity,
    sentiment AS pred_sentiment, action AS pred_action_required, 'Unknown' AS pred_root_cause
  FROM (SELECT ticket_id, clean_text, {_ANSWER_SQL} FROM {roles.TICKETS_SQL})"""


@query(_ENRICHED_SQL)
def enrich_tickets(spark: SparkSession, d: str) -> DataFrame:
    """A first run in two slices, then a run that finds nothing left to do."""
    path = fresh_path(spark, "enrich-partials")
    # Each run reads the tickets several times; they are cleaned once.
    tickets, index = stage(roles.tickets(spark, d), "enrich-tickets"), _labelled_index(spark, d)

    def classify(pending: DataFrame) -> DataFrame:
        return flows.classify_rag(_embedded(pending), index, keyword_call_responder, k=5, mode="cheap")

    flows.enrich_pending(tickets, path, classify, slices=2)
    enriched = flows.enrich_tickets(tickets, path, classify)
    return enriched.select(
        "ticket_id", F.md5("clean_text").alias("text_md5"), F.md5("input_text").alias("input_md5"), "pred_complaint_raw",
        "pred_complaint_type", "pred_severity", "pred_sentiment", "pred_action_required", "pred_root_cause")


@query(f"""SELECT ticket_id, complaint AS complaint_type_pred, severity AS severity_pred, CAST(1 AS BIGINT) AS n_rows
  FROM (SELECT ticket_id, clean_text, {_ANSWER_SQL} FROM {roles.TICKETS_SQL})""")
def resume_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The stream runs three times: first drop of files, second drop, nothing new."""
    base = fresh_path(spark, "stream")
    tickets = roles.tickets(spark, d)

    def classify(rows: DataFrame) -> DataFrame:
        found = flows.classify_zero_shot(rows, fv.ZERO_SHOT_TEMPLATE, keyword_text_responder)
        return found.select("ticket_id", "complaint_type_pred", "severity_pred")

    short = F.length("clean_text") < 500
    for drop in (tickets.filter(short), tickets.filter(~short), None):
        if drop is not None:
            drop.write.mode("append").parquet(f"{base}/tickets")
        run_stream(spark, f"{base}/tickets", tickets.schema, f"{base}/out", f"{base}/checkpoint", classify,
                   max_files=16).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.groupBy("ticket_id", "complaint_type_pred", "severity_pred").agg(F.count(F.lit(1)).alias("n_rows"))


_PROMPT_CHARS = len(fv.ZERO_SHOT_TEMPLATE) - len("{text}") * fv.ZERO_SHOT_TEMPLATE.count("{text}")
_SENT_SQL = f"({_PROMPT_CHARS} + {fv.ZERO_SHOT_TEMPLATE.count('{text}')} * length(clean_text))"


@query(f"""SELECT ticket_id, complaint AS complaint_type_pred, CAST(1 AS BIGINT) AS n_rows, {_SENT_SQL} % 7 = 3 AS was_dead,
    CAST(0 AS BIGINT) AS still_dead FROM (SELECT ticket_id, clean_text, {_ANSWER_SQL} FROM {roles.TICKETS_SQL})""")
def resume_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """Calls that fail in the first run succeed in the second, which finds no new files."""
    base = fresh_path(spark, "stream-dead")
    tickets = roles.tickets(spark, d)

    def run(responder) -> None:
        def classify(rows: DataFrame) -> DataFrame:
            return flows.classify_zero_shot(rows, fv.ZERO_SHOT_TEMPLATE, responder)

        run_stream(spark, f"{base}/tickets", tickets.schema, f"{base}/out", f"{base}/checkpoint", classify).awaitTermination()

    tickets.write.parquet(f"{base}/tickets")
    run(lambda ps: [RuntimeError("over quota") if len(p) % 7 == 3 else a for p, a in zip(ps, keyword_text_responder(ps))])
    dead = dead_letters(spark, f"{base}/out", tickets.schema).select("ticket_id", F.lit(True).alias("was_dead"))
    run(keyword_text_responder)
    left = dead_letters(spark, f"{base}/out", tickets.schema).count()
    out = spark.read.parquet(f"{base}/out").groupBy("ticket_id", "complaint_type_pred").agg(F.count(F.lit(1)).alias("n_rows"))
    return out.join(dead, "ticket_id", "left").select(
        "ticket_id", "complaint_type_pred", "n_rows", F.coalesce("was_dead", F.lit(False)).alias("was_dead"), F.lit(left).cast("long").alias("still_dead"))


_SHARED_IDS_SQL = f"""(SELECT CASE WHEN ticket_id % 3 > 0 THEN ticket_id % 50 END AS ticket_id, clean_text FROM {roles.PHRASE_TICKETS_SQL})"""


@query(f"""SELECT ticket_id, clean_text, {roles.infer_sql('complaint')} AS pred_complaint_type, count(*) AS n_rows, count(*) AS n_answers
  FROM (SELECT ticket_id, clean_text, {_ANSWER_SQL} FROM {_SHARED_IDS_SQL}) GROUP BY ALL""")
def enrich_row_identity(spark: SparkSession, d: str) -> DataFrame:
    """Many rows share an id, a third have none, many are equal; some calls fail in the first run. Each row is answered once."""
    path = fresh_path(spark, "identity-partials")
    number = F.col("ticket_id")
    tickets = roles.phrase_tickets(spark, d).select(F.when(number % 3 > 0, number % 50).alias("ticket_id"), "clean_text")
    index = _labelled_index(spark, d)

    def classify_with(responder):
        def classify(pending: DataFrame) -> DataFrame:
            return flows.classify_rag(_embedded(pending), index, responder, k=2, mode="cheap", exclude_self=False)
        return classify

    def flaky(prompts: list[str]) -> list:
        return [RuntimeError("down") if len(p) % 5 == 0 else a for p, a in zip(prompts, keyword_call_responder(prompts))]

    flows.enrich_pending(tickets, path, classify_with(flaky), slices=2)
    enriched = flows.enrich_tickets(tickets, path, classify_with(keyword_call_responder))
    answered = readers.read_partials(spark, path, latest=False).filter(F.col("error").isNull()).groupBy(
        F.col("ticket_id").alias("id"), F.col("input_text").alias("text")).agg(F.count(F.lit(1)).alias("n_answers"))
    rows = enriched.groupBy("ticket_id", "clean_text", "pred_complaint_type").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(answered, F.col("ticket_id").eqNullSafe(F.col("id")) & (F.col("clean_text") == F.col("text"))).drop("id", "text")


def _vote_sql(k: int) -> str:
    return f"""SELECT {k} AS k, query_id AS ticket_id, arg_max(label, struct_pack(w := weight, r := -nearest)) AS complaint_pred_raw
      FROM (SELECT n.query_id, i.label_complaint_type AS label, round(sum(1.0::DOUBLE / n.rank), 9) AS weight, min(n.rank) AS nearest
            FROM {roles.knn_sql(k)} n JOIN {roles.INDEX_SQL} i ON i.row_index = n.neighbor_id GROUP BY ALL) GROUP BY query_id"""


@query(f"{_vote_sql(1)} UNION ALL {_vote_sql(5)}")
def classify_rag_vote(spark: SparkSession, d: str) -> DataFrame:
    """Answers that follow from the retrieved examples: another k gives other rows."""
    index = roles.vector_index(spark, d)
    tickets = index.select(F.col("row_index").alias("ticket_id"), "embedding", F.col("text").alias("clean_text"))
    parts = [flows.classify_rag(tickets, index, vote_call_responder, k=k).select(F.lit(k).alias("k"), "ticket_id", "complaint_pred_raw") for k in (1, 5)]
    return parts[0].unionByName(parts[1])


@query(f"""SELECT ticket_id, complaint_pred_raw AS pred_complaint_raw, CAST(1 AS BIGINT) AS n_answers FROM ({_vote_sql(3)})""")
def enrich_tickets_vote(spark: SparkSession, d: str) -> DataFrame:
    """Resumable enrichment whose answers follow from the examples: a first run over some tickets, then over all."""
    path = fresh_path(spark, "vote-partials")
    index = stage(roles.vector_index(spark, d), "vote-index")
    tickets = index.select(F.col("row_index").alias("ticket_id"), "embedding", F.col("text").alias("clean_text"))

    def classify(pending: DataFrame) -> DataFrame:
        return flows.classify_rag(pending, index, vote_call_responder, k=3)

    flows.enrich_pending(tickets.filter(F.length("clean_text") % 2 == 0), path, classify)
    enriched = flows.enrich_tickets(tickets, path, classify)
    answers = readers.read_partials(spark, path, latest=False).groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n_answers"))
    return enriched.join(answers, "ticket_id").select("ticket_id", "pred_complaint_raw", "n_answers")


_BAD_TEXT = "length(text) % 97 = 5"


@query(f"""SELECT doc_id, {_BAD_TEXT} AS failed, CASE WHEN NOT {_BAD_TEXT} THEN CAST(length(text) AS DOUBLE) END AS first_value,
    true AS batches_full FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)""")
def embed_batches(spark: SparkSession, d: str) -> DataFrame:
    """An embedder that refuses some texts: each costs its own row, and calls are of 50 texts but for the halving."""
    calls = spark.sparkContext.accumulator(0)

    def embedder(texts: list[str]) -> list:
        calls.add(1)
        if any(len(t) % 97 == 5 for t in texts):
            raise ValueError("refused")
        return [[float(len(t)), 0.0] for t in texts]

    docs = roles.table(spark, d, "documents").select("doc_id", "text").withColumn("part", F.spark_partition_id())
    found = stage(docs.withColumn("e", models.embed(F.col("text"), embedder)).select("doc_id", "part", "e"), "embed-batches")
    plain, refused = 0, found.filter("e.error is not null").count()
    for row in found.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / 50).alias("n")).toLocalIterator():  # one row a partition
        plain += row["n"]
    full = plain <= calls.value <= plain + 12 * refused
    return found.select("doc_id", F.col("e.error").isNotNull().alias("failed"), F.col("e.vector")[0].cast("double").alias("first_value"),
                        F.lit(full).alias("batches_full"))


# ---- baseline -----------------------------------------------------------------------------------

_GRAMS_SQL = rf"""(SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))) AS term
  FROM (SELECT doc_id, regexp_extract_all(lower(clean_text), '[\p{{L}}\p{{N}}_]{{2,}}') AS w FROM {roles.GOLD_TEXTS_SQL}))"""


@query(f"""WITH g AS (SELECT doc_id, term, count(*) AS c FROM {_GRAMS_SQL} GROUP BY 1, 2),
    v AS (SELECT term, count(*) AS df FROM g GROUP BY term ORDER BY sum(c) DESC, term LIMIT 20000),
    n AS (SELECT count(*) AS n FROM {roles.GOLD_TEXTS_SQL}),
    w AS (SELECT doc_id, g.term, c * (ln((1.0::DOUBLE + n) / (1 + df)) + 1) AS x FROM g JOIN v ON v.term = g.term, n),
    u AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS x FROM w)
  SELECT d.doc_id, count(u.term) AS n_terms, coalesce(round(sum(x), 6), 0.0::DOUBLE) AS total, round(max(x), 6) AS top
  FROM {roles.GOLD_TEXTS_SQL} d LEFT JOIN u ON u.doc_id = d.doc_id GROUP BY d.doc_id""")
def tfidf(spark: SparkSession, d: str) -> DataFrame:
    rows = stage(roles.gold_texts(spark, d), "tfidf-rows")
    model = baseline.tfidf_stages(rows, "clean_text")
    weights = F.filter(vector_to_array("features"), lambda w: w != 0)
    summed = F.aggregate("w", F.lit(0.0), lambda total, w: total + w)
    return model.transform(rows).select("doc_id", weights.alias("w")).select(
        "doc_id", F.size("w").cast("long").alias("n_terms"), F.round(summed, 6).alias("total"),
        F.round(F.array_max("w"), 6).alias("top"))


def _trained(spark: SparkSession, d: str):
    rows = roles.gold_texts(spark, d)
    return rows, baseline.logreg_fit(rows, "doc_id", "clean_text", "label_complaint_type")


@query(f"""SELECT label_complaint_type, count(*) AS n, round(sum(w), 6) AS weight, true AS settled
  FROM (SELECT label_complaint_type, (SELECT count(*) FROM {roles.GOLD_TEXTS_SQL})
          / CAST((SELECT count(DISTINCT label_complaint_type) FROM {roles.GOLD_TEXTS_SQL}) * count(*) OVER (PARTITION BY label_complaint_type) AS DOUBLE) AS w
        FROM {roles.GOLD_TEXTS_SQL}) GROUP BY label_complaint_type""")
def logreg_fit(spark: SparkSession, d: str) -> DataFrame:
    """For each class its weight, and whether its intercept has settled: there the weighted sum of probability less
    indicator over all rows is zero, as the penalty leaves intercepts out."""
    rows, model = _trained(spark, d)
    rows = labels.class_weights(rows, "label_complaint_type")
    names = model.stages[-1].getLabels()
    scored = model.transform(rows).select("label_complaint_type", "class_weight", vector_to_array("probability").alias("p"))
    slopes = [F.sum(F.col("class_weight") * (F.col("p")[i] - (F.col("label_complaint_type") == name).cast("double"))) for i, name in enumerate(names)]
    total = scored.agg(F.sum("class_weight").alias("all"), F.array(*slopes).alias("slopes")).first()  # one row
    settled = [name for name, slope in zip(names, total["slopes"]) if abs(slope) < 2e-3 * total["all"]]
    return scored.groupBy("label_complaint_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("class_weight"), 6).alias("weight"),
    ).withColumn("settled", F.col("label_complaint_type").isin(settled))


@query(f"""SELECT doc_id, label_complaint_type, fold, CAST(1 AS BIGINT) AS n_predictions, true AS known
  FROM ({FOLDS_SQL}) WHERE doc_id IN (SELECT doc_id FROM {roles.GOLD_TEXTS_SQL})""")
def cross_val_predict(spark: SparkSession, d: str) -> DataFrame:
    """One prediction per row, by the model of the other folds, out of the classes of the labels."""
    rows = roles.gold_texts(spark, d)
    known = roles.gold(spark, d).select(F.col("label_complaint_type").alias("complaint_pred_raw")).distinct().withColumn("known", F.lit(True))
    found = baseline.cross_val_predict(rows, "doc_id", "clean_text", "label_complaint_type", 3)
    return found.join(known, "complaint_pred_raw", "left").groupBy("doc_id", "label_complaint_type", "fold").agg(
        F.count("complaint_pred_raw").alias("n_predictions"), F.bool_and(F.coalesce("known", F.lit(False))).alias("known"))


@query(f"""SELECT t.ticket_id AS index, CASE WHEN g.doc_id IS NULL THEN 'new' ELSE 'train' END AS split, true AS known
  FROM {roles.TICKETS_SQL} t LEFT JOIN {roles.GOLD_TEXTS_SQL} g ON g.doc_id = t.ticket_id""")
def predict_full(spark: SparkSession, d: str) -> DataFrame:
    """Predictions for every ticket, labelled or not; ``split`` tells rows the model has seen."""
    rows, model = _trained(spark, d)
    seen = rows.select("doc_id", F.lit("train").alias("split"))
    tickets = roles.tickets(spark, d).withColumnRenamed("ticket_id", "doc_id").join(seen, "doc_id", "left")
    return baseline.predict(model, tickets, "doc_id", "split").select(
        F.col("doc_id").alias("index"), F.coalesce("split", F.lit("new")).alias("split"),
        F.col("complaint_pred_raw").isin(model.stages[-1].getLabels()).alias("known"))


@query(f"SELECT doc_id, true AS same FROM {roles.GOLD_TEXTS_SQL}")
def save_model(spark: SparkSession, d: str) -> DataFrame:
    """Save and load; the loaded model says of every row what the fitted one says."""
    rows, model = _trained(spark, d)
    path = fresh_path(spark, "model")
    baseline.save_model(model, path)
    fitted = baseline.predict(model, rows, "doc_id").withColumnRenamed("complaint_pred_raw", "fitted")
    loaded = baseline.predict(baseline.load_model(path), rows, "doc_id")
    return loaded.join(fitted, "doc_id").select("doc_id", (F.col("complaint_pred_raw") == F.col("fitted")).alias("same"))


# ---- the flagship: clean, label, sentiment, severity, crosstab -----------------------------------


def flagship(spark: SparkSession, d: str) -> DataFrame:
    labelled = roles.tickets(spark, d).withColumn(
        "pred_complaint_type", rules.canonicalize_complaint_rag(strip(F.col("clean_text"))))
    scored = rules.with_calib_severity(rules.with_calib_sentiment(labelled))
    return metrics.crosstab(
        scored.withColumn("outcome", F.concat_ws("/", "calib_severity", "calib_sentiment")), "pred_complaint_type", "outcome")


_FLAGSHIP_ROWS_SQL = f"""(SELECT ticket_id, clean_text, NULL AS input_text, NULL AS pred_severity,
    {roles.rag_sql('clean_text')} AS pred_complaint_type FROM {roles.TICKETS_SQL})"""


@query(f"""SELECT r.pred_complaint_type, concat(v.calib_severity, '/', s.calib_sentiment) AS outcome, count(*) AS n
  FROM {_FLAGSHIP_ROWS_SQL} r JOIN {roles.severity_sql(_FLAGSHIP_ROWS_SQL)} v ON v.ticket_id = r.ticket_id
  JOIN {roles.sentiment_sql(_FLAGSHIP_ROWS_SQL)} s ON s.ticket_id = r.ticket_id GROUP BY 1, 2""")
def ticket_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return flagship(spark, d)
