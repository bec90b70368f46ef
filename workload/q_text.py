"""Preparation, text functions, rules, answers and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv
from casewright.functions import answers, prompts, rules, text as tx
from casewright.functions.keywords import keyword_counts
from casewright.operators import baseline, joins, prepare
from casewright.plans import flows
from workload import roles
from workload.registry import query

# ---- ids, time, text columns ---------------------------------------------------------------


@query("""SELECT doc_id AS ticket_id, CAST(doc_id AS VARCHAR) AS orig_ticket_id, lang FROM documents""")
def assign_ticket_id(spark: SparkSession, d: str) -> DataFrame:
    raw = roles.table(spark, d, "documents").select(
        F.concat(F.lit("00"), F.col("doc_id").cast("string")).alias("TicketID"), "lang")
    return prepare.assign_ticket_id(raw).select("ticket_id", "orig_ticket_id", "lang")


@query("""SELECT row_number() OVER (ORDER BY doc_id) AS ticket_id,
    CAST(row_number() OVER (ORDER BY doc_id) AS VARCHAR) AS orig_ticket_id, md5(text) AS text_md5 FROM documents""")
def assign_ticket_id_row_order(spark: SparkSession, d: str) -> DataFrame:
    raw = roles.table(spark, d, "documents").select("text")
    return prepare.assign_ticket_id(raw).select("ticket_id", "orig_ticket_id", F.md5("text").alias("text_md5"))


@query("""SELECT event_id, CASE
    WHEN event_id % 6 = 5 THEN NULL
    WHEN event_id % 6 IN (2, 3) THEN strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S')
    WHEN event_id % 6 = 4 THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
    ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS created_at FROM events""")
def parse_created_at(spark: SparkSession, d: str) -> DataFrame:
    forms = ["yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy", "MM/dd/yyyy HH:mm"]
    shown = F.array(*[F.date_format("ts", f) for f in forms], F.lit("soon"))
    raw = roles.table(spark, d, "events").select(
        "event_id", F.element_at(shown, (F.col("event_id") % 6).cast("int") + 1).alias("created_at"))
    parsed = prepare.parse_created_at(F.col("created_at"))
    return raw.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("created_at"))


def _conversations(spark: SparkSession, d: str) -> DataFrame:
    """The first turn is the subject, all later ones are the description; the event of the same number gives the time."""
    turns = roles.table(spark, d, "conversations")
    later = F.array_sort(F.collect_list(F.when(F.col("turn") > 0, F.struct("turn", "text"))))  # the turns of one conversation
    whole = turns.groupBy(F.col("conv_id").alias("id")).agg(
        F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("subject"),
        F.array_join(later.getField("text"), " ").alias("description"))
    times = roles.table(spark, d, "events").select(F.col("event_id").alias("id"), F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("created_at"))
    return whole.join(times, "id", "left")


_CONVERSATIONS_SQL = """(SELECT c.*, date_trunc('second', e.ts) AS created_at FROM (
    SELECT conv_id AS id, max(CASE WHEN turn = 0 THEN text END) AS subject,
      coalesce(string_agg(text, ' ' ORDER BY turn, text) FILTER (WHERE turn > 0), '') AS description
    FROM conversations GROUP BY conv_id) c LEFT JOIN events e ON e.event_id = c.id)"""


@query(f"""SELECT id, md5(concat(coalesce(subject, ''), ' ', coalesce(description, ''))) AS text_md5
  FROM {_CONVERSATIONS_SQL}""")
def concat_text(spark: SparkSession, d: str) -> DataFrame:
    raw = _conversations(spark, d)
    return raw.select("id", F.md5(prepare.concat_text(raw)).alias("text_md5"))


_JOINED_SQL = "concat(coalesce(subject, ''), ' ', coalesce(description, ''))"


@query(f"""SELECT id AS ticket_id, md5({roles.clean_sql(_JOINED_SQL)}) AS clean_md5,
    CAST(id AS VARCHAR) AS orig_ticket_id, md5(subject) AS subject_md5, md5(description) AS description_md5,
    strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
  FROM {_CONVERSATIONS_SQL}""")
def project_clean(spark: SparkSession, d: str) -> DataFrame:
    clean = prepare.prepare_tickets(_conversations(spark, d))
    return clean.select(
        "ticket_id", F.md5("clean_text").alias("clean_md5"), "orig_ticket_id", F.md5("subject").alias("subject_md5"),
        F.md5("description").alias("description_md5"), F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return roles.table(spark, d, "documents").select("doc_id", "text")


@query(r"""SELECT doc_id, md5(lower(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS text_md5 FROM documents""")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).select("doc_id", F.md5(tx.normalize_text(F.col("text"))).alias("text_md5"))


@query(f"""SELECT doc_id, md5(t) AS text_md5, contains(t, '{fv.EMAIL_MARK}') AS has_mark FROM (
    SELECT doc_id, regexp_replace(lower(text), '{fv.EMAIL_PATTERN}', '{fv.EMAIL_MARK}', 'g') AS t
    FROM documents)""")
def redact_email(spark: SparkSession, d: str) -> DataFrame:
    redacted = _documents(spark, d).select("doc_id", tx.redact_email(F.lower("text")).alias("t"))
    return redacted.select("doc_id", F.md5("t").alias("text_md5"), F.contains("t", F.lit(fv.EMAIL_MARK)).alias("has_mark"))


@query(f"""SELECT event_id, regexp_replace(t, '{fv.PHONE_PATTERN}', '{fv.PHONE_MARK}', 'g') AS t FROM (
    SELECT event_id, CASE event_id % 4
        WHEN 0 THEN concat('call ', lpad(CAST(user_id AS VARCHAR), 3, '5'), '-555-', lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0'))
        WHEN 1 THEN concat(lpad(CAST(user_id AS VARCHAR), 3, '5'), '.555 ', lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0'), ' now')
        WHEN 2 THEN concat('(743) 555-', lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0'))
        ELSE concat('no ', lpad(CAST(event_id AS VARCHAR), 10, '1'), ' or x', lpad(CAST(event_id AS VARCHAR), 10, '1')) END AS t
    FROM events)""")
def redact_phone(spark: SparkSession, d: str) -> DataFrame:
    area = F.lpad(F.col("user_id").cast("string"), 3, "5")
    last = F.lpad((F.col("event_id") % 10000).cast("string"), 4, "0")
    ten = F.lpad(F.col("event_id").cast("string"), 10, "1")
    forms = F.array(
        F.concat(F.lit("call "), area, F.lit("-555-"), last), F.concat(area, F.lit(".555 "), last, F.lit(" now")),
        F.concat(F.lit("(743) 555-"), last), F.concat(F.lit("no "), ten, F.lit(" or x"), ten))
    text = F.element_at(forms, (F.col("event_id") % 4).cast("int") + 1)
    return roles.table(spark, d, "events").select("event_id", tx.redact_phone(text).alias("t"))


# ---- label rules ------------------------------------------------------------------------------


def _labels_and_texts(spark: SparkSession, d: str, rule) -> DataFrame:
    raw = roles.phrase_tickets(spark, d).select("ticket_id", F.concat_ws(" ", "pred_raw", "clean_text").alias("free"),
                                                "gold_raw")
    return raw.select("ticket_id", rule(F.col("gold_raw")).alias("from_label"), rule(F.col("free")).alias("from_text"))


def _labels_sql(rule) -> str:
    return f"""SELECT ticket_id, {rule('gold_raw')} AS from_label, {rule('free')} AS from_text
      FROM (SELECT ticket_id, gold_raw, concat_ws(' ', pred_raw, clean_text) AS free FROM {roles.PHRASE_TICKETS_SQL})"""


@query(_labels_sql(roles.collapse_sql))
def collapse_label(spark: SparkSession, d: str) -> DataFrame:
    return _labels_and_texts(spark, d, rules.collapse_label)


@query(_labels_sql(roles.rag_sql))
def canonicalize_complaint_rag(spark: SparkSession, d: str) -> DataFrame:
    return _labels_and_texts(spark, d, rules.canonicalize_complaint_rag)


@query(_labels_sql(roles.infer_sql))
def canonicalize_complaint_infer(spark: SparkSession, d: str) -> DataFrame:
    return _labels_and_texts(spark, d, rules.canonicalize_complaint_infer)


@query(f"""SELECT ticket_id, CASE WHEN trim(pred_severity) IN ('Low', 'Medium', 'High') THEN trim(pred_severity)
    ELSE 'Unknown' END AS severity FROM {roles.PHRASE_TICKETS_SQL}""")
def canonicalize_simple(spark: SparkSession, d: str) -> DataFrame:
    return roles.phrase_tickets(spark, d).select(
        "ticket_id", rules.canonicalize_simple(F.col("pred_severity"), fv.SEVERITIES).alias("severity"))


@query(f"""SELECT ticket_id, {roles.any_sql('lower(clean_text)', fv.MAJOR_FAULT_WORDS)} AS major,
    {roles.any_sql('lower(clean_text)', fv.CRITICAL_WORDS)} AS critical FROM {roles.TICKETS_SQL}""")
def contains_any(spark: SparkSession, d: str) -> DataFrame:
    return roles.tickets(spark, d).select(
        "ticket_id", rules.contains_any(F.lower("clean_text"), fv.MAJOR_FAULT_WORDS).alias("major"),
        rules.contains_any(F.lower("clean_text"), fv.CRITICAL_WORDS).alias("critical"))


@query(f"""SELECT ticket_id, CAST({roles.count_sql('t', fv.POSITIVE_WORDS)} AS BIGINT) AS positive,
    CAST({roles.count_sql('t', fv.NEUTRAL_WORDS)} AS BIGINT) AS neutral,
    CAST({roles.count_sql('t', fv.NEGATIVE_WORDS)} AS BIGINT) AS negative
  FROM (SELECT ticket_id, lower(clean_text) AS t FROM {roles.TICKETS_SQL})""")
def count_occurrences(spark: SparkSession, d: str) -> DataFrame:
    lists = {"positive": fv.POSITIVE_WORDS, "neutral": fv.NEUTRAL_WORDS, "negative": fv.NEGATIVE_WORDS}
    counted = roles.tickets(spark, d).withColumn("n", keyword_counts(F.lower("clean_text"), lists))
    return counted.select("ticket_id", "n.positive", "n.neutral", "n.negative")


_ALL_TEXTS_SQL = f"""(SELECT ticket_id, clean_text, input_text FROM {roles.PHRASE_TICKETS_SQL}
  UNION ALL SELECT -1 - ticket_id, clean_text, NULL FROM {roles.TICKETS_SQL})"""


@query(f"SELECT ticket_id, calib_sentiment FROM {roles.sentiment_sql(_ALL_TEXTS_SQL)}")
def sentiment_by_lexicon(spark: SparkSession, d: str) -> DataFrame:
    phrases = roles.phrase_tickets(spark, d).select("ticket_id", "clean_text", "input_text")
    docs = roles.tickets(spark, d).select((-1 - F.col("ticket_id")).alias("ticket_id"), "clean_text",
                                          F.lit(None).cast("string").alias("input_text"))
    return rules.with_calib_sentiment(phrases.unionByName(docs)).select("ticket_id", "calib_sentiment")


@query(f"SELECT ticket_id, calib_severity FROM {roles.severity_sql(roles.PREDICTED_SQL)}")
def calibrate_severity(spark: SparkSession, d: str) -> DataFrame:
    return rules.with_calib_severity(roles.predicted(spark, d)).select("ticket_id", "calib_severity")


@query(f"""SELECT ticket_id, coalesce(pred_sentiment, 'Negative') AS calib_sentiment,
    coalesce(pred_severity, 'Medium') AS calib_severity FROM {roles.PHRASE_TICKETS_SQL}""")
def fill_calibrated(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.phrase_tickets(spark, d).select(
        "ticket_id", F.col("pred_sentiment").alias("calib_sentiment"), F.col("pred_severity").alias("calib_severity"))
    return rules.fill_calibrated(rows)


@query(f"""SELECT ticket_id, pred_severity AS "_orig_pred_severity", pred_sentiment AS "_orig_pred_sentiment",
    CAST(NULL AS VARCHAR) AS "_orig_pred_complaint" FROM {roles.PHRASE_TICKETS_SQL}""")
def snapshot_originals(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.phrase_tickets(spark, d).drop("pred_complaint_type")
    return joins.snapshot_originals(rows).select(
        "ticket_id", "_orig_pred_severity", "_orig_pred_sentiment", "_orig_pred_complaint")


@query(f"""SELECT ticket_id, pred_raw AS pred_complaint_raw, pred_complaint_type, pred_severity, pred_sentiment,
    gold_raw AS pred_root_cause, input_text AS pred_action_required FROM {roles.PHRASE_TICKETS_SQL}""")
def rename_enriched(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.phrase_tickets(spark, d).select(
        "ticket_id", F.col("ticket_id").alias("index_tmp"), F.col("pred_raw").alias("complaint_pred_raw"),
        F.col("pred_complaint_type").alias("complaint_pred"), F.col("pred_severity").alias("severity_pred"),
        F.col("pred_sentiment").alias("sentiment_pred"), F.col("gold_raw").alias("root_cause_pred"),
        F.col("input_text").alias("action_required_pred"))
    return joins.rename_enriched(rows)


# ---- answers ------------------------------------------------------------------------------------

_FIELDS = fv.RESPONSE_FIELDS
_PARSED_SQL = rf"""(SELECT row_index, raw, CASE
      WHEN json_valid(raw) THEN CASE WHEN json_type(raw) = 'OBJECT' THEN raw END
      WHEN json_valid(regexp_extract(raw, '(\{{(?:.|\n)*\}})', 1)) THEN regexp_extract(raw, '(\{{(?:.|\n)*\}})', 1)
    END AS j FROM {roles.ANSWERS_SQL})"""


@query("SELECT row_index, j IS NOT NULL AS is_object, "
       + ", ".join(f"json_extract_string(j, '$.{f}') AS {f}" for f in _FIELDS) + f" FROM {_PARSED_SQL}")
def safe_parse_json(spark: SparkSession, d: str) -> DataFrame:
    parsed = roles.answers(spark, d).withColumn("p", answers.safe_parse_json(F.col("raw")))
    return parsed.select("row_index", F.col("p").isNotNull().alias("is_object"), *[f"p.{f}" for f in _FIELDS])


@query("SELECT row_index, " + ", ".join(f"json_extract_string(j, '$.{f}') AS {f}_pred" for f in _FIELDS)
       + f" FROM {_PARSED_SQL}")
def parsed_to_columns(spark: SparkSession, d: str) -> DataFrame:
    parsed = roles.answers(spark, d).withColumn("p", answers.safe_parse_json(F.col("raw")))
    return parsed.select("row_index", *answers.parsed_to_columns(F.col("p")))


_CALL_SQL = rf"""(SELECT row_index, CASE
      WHEN json_valid(raw) AND json_type(raw) = 'OBJECT' THEN raw
      WHEN starts_with(raw, '{{''') THEN replace(replace(raw, '''', '"'), ': None', ': null') END AS j
  FROM {roles.ANSWERS_SQL})"""


@query("SELECT row_index, " + ", ".join(f"json_extract_string(j, '$.{f}') AS {f}" for f in _FIELDS)
       + f" FROM {_CALL_SQL}")
def extract_function_args(spark: SparkSession, d: str) -> DataFrame:
    """Arguments as text for most rows; where they parse and the row number is even, as a nested object."""
    rows = roles.answers(spark, d)
    call = F.to_json(F.struct(F.lit("classify_ticket").alias("name"), F.col("raw").alias("arguments")))
    good = F.col("raw").startswith('{"') & F.col("raw").endswith("}") & ~F.col("raw").contains(" tail ")
    nested = F.concat(F.lit('{"name":"classify_ticket","arguments":'), F.col("raw"), F.lit("}"))
    chosen = F.when(good & (F.col("row_index") % 4 == 0), nested).otherwise(call)
    response = F.concat(F.lit('{"choices":[{"message":{"function_call":'), chosen, F.lit("}}]}"))
    parsed = rows.withColumn("p", answers.extract_function_args(response))
    return parsed.select("row_index", *[f"p.{f}" for f in _FIELDS])


@query(f"""SELECT row_index,
    CASE WHEN failed THEN NULL ELSE ct END AS complaint_pred_raw,
    CASE WHEN failed THEN 'Other' ELSE {roles.rag_sql('ct')} END AS complaint_pred,
    CASE WHEN NOT failed AND sv IN ('Low', 'Medium', 'High') THEN sv ELSE 'Unknown' END AS severity_pred,
    CASE WHEN NOT failed AND st IN ('Positive', 'Neutral', 'Negative') THEN st ELSE 'Unknown' END AS sentiment_pred,
    CASE WHEN NOT failed AND ar IN ('Yes', 'No') THEN ar ELSE 'Unknown' END AS action_required_pred,
    CASE WHEN failed THEN 'Unknown' ELSE coalesce(rc, 'Unknown') END AS root_cause_pred,
    CASE WHEN failed THEN 'timeout' END AS error
  FROM (SELECT row_index, row_index % 7 = 0 AS failed, json_extract_string(j, '$.complaint_type') AS ct,
          json_extract_string(j, '$.severity') AS sv, json_extract_string(j, '$.sentiment') AS st,
          json_extract_string(j, '$.action_required') AS ar, json_extract_string(j, '$.root_cause') AS rc
        FROM {_PARSED_SQL})""")
def error_placeholder(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.answers(spark, d).withColumns({
        "p": answers.safe_parse_json(F.col("raw")), "error": F.when(F.col("row_index") % 7 == 0, "timeout")})
    columns = answers.canonical_prediction(F.col("p"), rules.canonicalize_complaint_rag)
    columns = answers.error_placeholder(columns, F.col("error"))
    return rows.select("row_index", *[c.alias(n) for n, c in columns.items()], "error")


# ---- prompts --------------------------------------------------------------------------------------


@query(f"""SELECT ticket_id, md5(replace({roles.text_sql(fv.ZERO_SHOT_TEMPLATE)}, '{{text}}', clean_text)) AS prompt_md5
  FROM {roles.TICKETS_SQL}""")
def fill_prompt(spark: SparkSession, d: str) -> DataFrame:
    prompt = prompts.fill_prompt(fv.ZERO_SHOT_TEMPLATE, F.col("clean_text"))
    return roles.tickets(spark, d).select("ticket_id", F.md5(prompt).alias("prompt_md5"))


# ---- calibration flow -------------------------------------------------------------------------------


@query(f"""SELECT s.ticket_id, v.calib_severity, s.calib_sentiment
  FROM {roles.sentiment_sql(roles.PREDICTED_SQL)} s
  JOIN {roles.severity_sql(roles.PREDICTED_SQL)} v ON v.ticket_id = s.ticket_id""")
def calibrate_tickets(spark: SparkSession, d: str) -> DataFrame:
    return flows.calibrate(roles.predicted(spark, d)).select("ticket_id", "calib_severity", "calib_sentiment")


# ---- terms --------------------------------------------------------------------------------------------

_WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"


@query(rf"""SELECT term, count(*) AS n, count(DISTINCT doc_id) AS n_docs
  FROM (SELECT doc_id, unnest({_WORDS_SQL}) AS term FROM documents) GROUP BY term""")
def tokenize(spark: SparkSession, d: str) -> DataFrame:
    terms = _documents(spark, d).select(tx.tokens(F.col("text")).alias("terms"))
    return baseline.term_statistics(terms).withColumnsRenamed({"tf": "n", "df": "n_docs"})


_NGRAMS_SQL = rf"""(SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))) AS term
  FROM (SELECT doc_id, {_WORDS_SQL} AS w FROM documents))"""


@query(f"""SELECT d.doc_id, count(term) AS n_terms, count(DISTINCT term) AS n_distinct
  FROM documents d LEFT JOIN {_NGRAMS_SQL} g ON g.doc_id = d.doc_id GROUP BY d.doc_id""")
def ngrams_1_2(spark: SparkSession, d: str) -> DataFrame:
    terms = _documents(spark, d).select("doc_id", tx.unigrams_and_bigrams(tx.tokens(F.col("text"))).alias("t"))
    return terms.select(
        "doc_id", F.size("t").cast("long").alias("n_terms"),
        F.size(F.array_distinct("t")).cast("long").alias("n_distinct"))


@query(f"""SELECT term, tf, df FROM (
    SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM {_NGRAMS_SQL} GROUP BY term)
  ORDER BY tf DESC, term LIMIT 20000""")
def count_vectorize(spark: SparkSession, d: str) -> DataFrame:
    """The vocabulary: top 20,000 terms by corpus frequency, with their document frequency."""
    docs = _documents(spark, d)
    return baseline.document_frequency(docs, "text", baseline.vocabulary(docs, "text"))
