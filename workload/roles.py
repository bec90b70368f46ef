"""How the shared tables play the parts of tickets, labels, predictions and answers.

``documents`` are the tickets, ``labels`` the gold labels, ``embeddings`` the
vector index. Invented words hardly touch the keyword rules, so ``events``
carry a bank of phrases, chosen by a formula over the row. Each role comes as a
DataFrame and as a SQL fragment that says the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv
from casewright.functions.text import clean_text

PHRASES = [
    "my account locked after update", "question about a charge", "invoice copy please",
    "payment page looks odd", "screen not working", "colour differs from photo", "unable to login",
    "forgot my name", "parcel never arrived", "when does it ship", "app timeout", "pages feel heavy",
    "rude agent", "hello", "thanks, great", "could you clarify details", "please help",
    "it is broken", "", "it works, thanks. question: info", "card declined at checkout",
    "there was a data loss on the server", "i was charged twice", "battery died after a day",
    "the firmware update failed", "box damaged and item missing", "delivered to wrong house",
    "total outage since monday", "invalid credentials shown", "cannot access my files",
    "please assist with the tracking number", "awesome support, very happy and satisfied",
    "slow slow slow, so slow", "does not work, no sound and no display", "security breach, we were hacked",
    "i need information on how to return this", "refund was unauthorized", "thank you, issue resolved and fixed",
    "kindly help me change the delivery address of my order please", "payment failed again",
    "website is down",
]
RAW_LABELS = [
    "Payment/Billing", "Customer Sdervice", "Performance/Latency", "Account/Subscription", "N/A",
    "support issue", "product latency", "not received", "order not received", "ux", "quick reply",
    " Authentication ", "Technical Issue", "", None, "Product Defect", "Product Defect", "Login", "refund request",
    "Delivery", "Customer Service", "billing payment", "Product Defect", "product-defect", "Other",
]
COMPLAINTS = [
    "Billing", "Payment/Billing", "Product Defect", "Login", "Account/Subscription", "Delivery", "Performance",
    "Customer Service", "Customer Sdervice", "Other", "Refund", None,
]
SEVERITY_VALUES = ["Low", "High", "Medium", None, " High ", "Urgent", "low"]
SENTIMENT_OF_EVENT = {"purchase": "Positive", "click": "Neutral", "view": "Neutral", "error": "Negative"}
CLASS_NAMES = [
    "Product Defect", "Login", "Billing", "Customer Service", "Delivery", "Performance", "Other", "Refund",
    "Payment/Billing", "Account/Subscription",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: list, number: Column) -> Column:
    literals = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(literals, (number % len(values)).cast("int") + 1)


def text_sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick_sql(values: list, number: str) -> str:
    listed = ", ".join(text_sql(v) for v in values)
    return f"list_extract([{listed}], CAST(({number}) % {len(values)} AS INTEGER) + 1)"


# ---- tickets ------------------------------------------------------------------------------


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return docs.select(F.col("doc_id").alias("ticket_id"), clean_text(F.col("text")).alias("clean_text"))


def clean_sql(text: str) -> str:
    spaced = rf"lower(trim(regexp_replace({text}, '\s+', ' ', 'g')))"
    no_email = f"regexp_replace({spaced}, '{fv.EMAIL_PATTERN}', '{fv.EMAIL_MARK}', 'g')"
    return f"regexp_replace({no_email}, '{fv.PHONE_PATTERN}', '{fv.PHONE_MARK}', 'g')"


TICKETS_SQL = f"(SELECT doc_id AS ticket_id, {clean_sql('text')} AS clean_text FROM documents)"

# ---- phrase tickets with predictions --------------------------------------------------------


def phrase_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """One enriched ticket per event: phrase, raw labels, and three predictions with nulls among them."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    number, user = F.col("event_id"), F.col("user_id")
    sentiment = F.when(F.lit(False), F.lit(""))
    for event_type, value in SENTIMENT_OF_EVENT.items():
        sentiment = sentiment.when(F.col("event_type") == event_type, F.lit(value))
    return events.select(
        number.alias("ticket_id"),
        pick(PHRASES, number + user).alias("clean_text"),
        F.concat_ws(" ", pick(PHRASES, number + user), "event_type").alias("input_text"),
        pick(RAW_LABELS, number).alias("gold_raw"),
        pick(RAW_LABELS, user).alias("pred_raw"),
        pick(COMPLAINTS, number * 3 + user * 5).alias("pred_complaint_type"),
        pick(SEVERITY_VALUES, number).alias("pred_severity"),
        sentiment.alias("pred_sentiment"),
    )


_SENTIMENT_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SENTIMENT_OF_EVENT.items())
PHRASE_TICKETS_SQL = f"""(
  SELECT ticket_id, clean_text, concat(clean_text, ' ', event_type) AS input_text, gold_raw, pred_raw,
         pred_complaint_type, pred_severity, pred_sentiment
  FROM (SELECT event_id AS ticket_id, event_type,
               {pick_sql(PHRASES, 'event_id + user_id')} AS clean_text,
               {pick_sql(RAW_LABELS, 'event_id')} AS gold_raw,
               {pick_sql(RAW_LABELS, 'user_id')} AS pred_raw,
               {pick_sql(COMPLAINTS, 'event_id * 3 + user_id * 5')} AS pred_complaint_type,
               {pick_sql(SEVERITY_VALUES, 'event_id')} AS pred_severity,
               CASE event_type {_SENTIMENT_CASE} END AS pred_sentiment
        FROM events))"""



def predicted(spark: SparkSession, folder: str) -> DataFrame:
    """The phrase tickets, and all documents under negative numbers with predictions by number."""
    docs, number = tickets(spark, folder), F.col("ticket_id")
    null = F.lit(None).cast("string")
    columns = ["ticket_id", "clean_text", "input_text", "pred_complaint_type", "pred_severity", "pred_sentiment"]
    return phrase_tickets(spark, folder).select(columns).unionByName(docs.select(
        (-1 - number).alias("ticket_id"), "clean_text", null.alias("input_text"), pick(COMPLAINTS, number).alias("pred_complaint_type"),
        pick(SEVERITY_VALUES, number).alias("pred_severity"), null.alias("pred_sentiment")))


PREDICTED_SQL = f"""(
  SELECT ticket_id, clean_text, input_text, pred_complaint_type, pred_severity, pred_sentiment FROM {PHRASE_TICKETS_SQL}
  UNION ALL SELECT -1 - ticket_id, clean_text, NULL, {pick_sql(COMPLAINTS, 'ticket_id')}, {pick_sql(SEVERITY_VALUES, 'ticket_id')}, NULL
  FROM {TICKETS_SQL})"""

# ---- gold labels on documents ---------------------------------------------------------------


def gold(spark: SparkSession, folder: str) -> DataFrame:
    """Four classes, one of them with three quarters of the rows."""
    kind = F.concat(F.lit("q"), F.col("quality"), F.lit("t"), F.col("toxic"))
    return table(spark, folder, "labels").select("doc_id", kind.alias("label_complaint_type"))


GOLD_SQL = "(SELECT doc_id, concat('q', quality, 't', toxic) AS label_complaint_type FROM labels)"


def gold_texts(spark: SparkSession, folder: str) -> DataFrame:
    texts = tickets(spark, folder).withColumnRenamed("ticket_id", "doc_id")
    return gold(spark, folder).join(texts, "doc_id")


GOLD_TEXTS_SQL = f"""(SELECT l.doc_id, l.label_complaint_type, t.clean_text
  FROM {GOLD_SQL} l JOIN {TICKETS_SQL} t ON t.ticket_id = l.doc_id)"""

# ---- classes on documents with a long tail --------------------------------------------------


def origin_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Source and language as a class: a few large, many small."""
    docs = table(spark, folder, "documents")
    name = F.when(F.col("source") == "src3", None).otherwise(F.concat_ws("-", "source", "lang"))
    return docs.select("doc_id", name.alias("label"))


ORIGIN_SQL = """(SELECT doc_id, CASE WHEN source = 'src3' THEN NULL ELSE concat(source, '-', lang) END AS label
  FROM documents)"""

# ---- vector index -----------------------------------------------------------------------------


def vector_index(spark: SparkSession, folder: str) -> DataFrame:
    """embeddings as the index, with the ticket of the same number as text and class names as labels."""
    vectors = table(spark, folder, "embeddings")
    texts = tickets(spark, folder)
    named = vectors.select(
        F.col("vec_id").alias("row_index"), "embedding",
        pick(CLASS_NAMES, F.col("label").cast("long")).alias("label_complaint_type"),
        pick(["Low", "Medium", "High"], F.col("label").cast("long")).alias("label_severity"),
        pick(["Negative", "Neutral"], F.col("label").cast("long")).alias("label_sentiment"),
    )
    return named.join(texts.withColumnRenamed("ticket_id", "row_index"), "row_index", "left").withColumnRenamed(
        "clean_text", "text")


INDEX_SQL = f"""(SELECT e.vec_id AS row_index, e.embedding, t.clean_text AS text,
         {pick_sql(CLASS_NAMES, 'e.label')} AS label_complaint_type,
         {pick_sql(['Low', 'Medium', 'High'], 'e.label')} AS label_severity,
         {pick_sql(['Negative', 'Neutral'], 'e.label')} AS label_sentiment
  FROM embeddings e LEFT JOIN {TICKETS_SQL} t ON t.ticket_id = e.vec_id)"""


def knn_sql(k: int, exclude_self: bool = True) -> str:
    apart = "AND q.vec_id <> i.vec_id" if exclude_self else ""
    return f"""(SELECT query_id, rank, neighbor_id, distance FROM (
    SELECT query_id, neighbor_id, distance,
           row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 12), neighbor_id) AS rank
    FROM (SELECT q.vec_id AS query_id, i.vec_id AS neighbor_id,
                 1 - list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS distance
          FROM embeddings q, embeddings i WHERE true {apart})) WHERE rank <= {k})"""


# ---- model answers ----------------------------------------------------------------------------

ANSWER_FORMS = 14


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """One raw model answer per event in many good and bad forms; the values come from the event."""
    number = F.col("event_id")
    kind = pick([c for c in COMPLAINTS if c], number + F.col("user_id"))
    whole = F.concat(
        F.lit('{"complaint_type": "'), kind, F.lit('", "severity": "'), pick(["Low", "High", "Urgent"], number),
        F.lit('", "sentiment": "'), pick(["Negative", "Neutral", "mixed"], number),
        F.lit('", "root_cause": "'), F.col("event_type"), F.lit('", "action_required": "Yes"}'))
    single = F.concat(F.lit("{'complaint_type': '"), kind, F.lit("', 'root_cause': None}"))
    forms = [
        whole,
        F.concat(F.lit("Sure, here it is:\n```json\n"), whole, F.lit("\n```\nAnything else?")),
        F.lit("not json"),
        F.concat(F.lit("{bad "), kind),
        F.concat(F.lit("["), whole, F.lit("]")),
        F.concat(whole, F.lit(" tail "), whole),
        single,
        F.concat(whole, F.lit(" trailing text")),
        F.concat(F.lit('{"complaint_type": null, "severity": "'), kind, F.lit('"}')),
        F.concat(F.lit('{"complaint_type": '), number.cast("string"), F.lit("}")),
        F.lit(None).cast("string"),
        F.lit(""),
        F.concat(F.lit("\n  "), whole, F.lit("\n")),
        F.lit("{}"),
    ]
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    raw = F.element_at(F.array(*forms), (number % ANSWER_FORMS).cast("int") + 1)
    return events.select(F.col("event_id").alias("row_index"), raw.alias("raw"))


def _answers_sql() -> str:
    kind = pick_sql([c for c in COMPLAINTS if c], "event_id + user_id")
    whole = (
        f"""concat('{{"complaint_type": "', {kind}, '", "severity": "', {pick_sql(['Low', 'High', 'Urgent'], 'event_id')},
        '", "sentiment": "', {pick_sql(['Negative', 'Neutral', 'mixed'], 'event_id')},
        '", "root_cause": "', event_type, '", "action_required": "Yes"}}')"""
    )
    forms = [
        "whole",
        "concat('Sure, here it is:', chr(10), '```json', chr(10), whole, chr(10), '```', chr(10), 'Anything else?')",
        "'not json'", "concat('{bad ', kind)", "concat('[', whole, ']')", "concat(whole, ' tail ', whole)",
        "concat('{''complaint_type'': ''', kind, ''', ''root_cause'': None}')", "concat(whole, ' trailing text')",
        """concat('{"complaint_type": null, "severity": "', kind, '"}')""",
        """concat('{"complaint_type": ', CAST(event_id AS VARCHAR), '}')""", "NULL", "''",
        "concat(chr(10), '  ', whole, chr(10))", "'{}'",
    ]
    cases = " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(forms))
    return f"""(SELECT event_id AS row_index, CASE event_id % {ANSWER_FORMS} {cases} END AS raw
  FROM (SELECT event_id, event_type, {kind} AS kind, {whole} AS whole FROM events))"""


ANSWERS_SQL = _answers_sql()


# ---- rules as SQL: word lists are shared data, order and logic are written out here -------------


def any_sql(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {text_sql(w)})" for w in words) + ")"


def count_sql(text: str, words: list[str]) -> str:
    return " + ".join(
        f"(length({text}) - length(replace({text}, {text_sql(w)}, ''))) // {len(w)}" for w in words)


def _chain_sql(text: str, chain: list[tuple[str, list[str]]]) -> str:
    whens = " ".join(f"WHEN {any_sql(f'lower({text})', words)} THEN '{label}'" for label, words in chain)
    return f"CASE {whens} ELSE 'Other' END"


def _ordered(rules: list[tuple[str, list[str]]], *labels: str) -> list[tuple[str, list[str]]]:
    words = dict(rules)
    return [(label, words[label]) for label in labels]


def collapse_sql(text: str) -> str:
    return _chain_sql(text, _ordered(
        fv.COLLAPSE_RULES, "Billing", "Login", "Delivery", "Performance", "Customer Service", "Product Defect"))


def rag_sql(text: str) -> str:
    return _chain_sql(text, _ordered(
        fv.RAG_RULES, "Billing", "Login", "Delivery", "Product Defect", "Performance", "Customer Service"))


def infer_sql(text: str) -> str:
    return _chain_sql(text, _ordered(
        fv.INFER_RULES, "Billing", "Login", "Delivery", "Product Defect", "Performance", "Customer Service"))


def sentiment_sql(source: str, key: str = "ticket_id") -> str:
    """(key, text, pos, neu, neg, calib_sentiment) for a source with key, clean_text and input_text."""
    return rf"""(SELECT *, CASE
      WHEN pos > greatest(neg, neu) THEN 'Positive'
      WHEN neu > greatest(pos, neg) AND neg = 0 THEN 'Neutral'
      WHEN neg >= greatest(pos, neu) THEN
        CASE WHEN len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '')) <= 6 AND contains(t, 'help')
               OR len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '')) <= 6
                  AND contains(t, 'please assist') THEN 'Neutral' ELSE 'Negative' END
      ELSE 'Negative' END AS calib_sentiment
    FROM (SELECT {key}, t, {count_sql('t', fv.POSITIVE_WORDS)} AS pos, {count_sql('t', fv.NEUTRAL_WORDS)} AS neu,
                 {count_sql('t', fv.NEGATIVE_WORDS)} AS neg
          FROM (SELECT {key}, lower(coalesce(nullif(clean_text, ''), input_text, '')) AS t FROM {source})))"""


def severity_sql(source: str, key: str = "ticket_id") -> str:
    """(key, calib_severity) for a source with key, texts and predictions."""
    def high(words):
        return f"CASE WHEN {any_sql('t', words)} THEN 'High' ELSE 'Medium' END"

    return f"""(SELECT {key}, CASE
      WHEN {any_sql('t', fv.CRITICAL_WORDS)} THEN 'High'
      WHEN c IN ('billing', 'payment', 'payment/billing') OR contains(t, 'payment') THEN
        {high(fv.BILLING_HIGH_WORDS)}
      WHEN contains(c, 'product') THEN {high(fv.MAJOR_FAULT_WORDS)}
      WHEN c IN ('login', 'account/subscription') THEN
        {high(fv.LOGIN_HIGH_WORDS)}
      WHEN c = 'delivery' THEN
        {high(fv.DELIVERY_HIGH_WORDS)}
      WHEN c = 'performance' THEN {high(fv.PERFORMANCE_HIGH_WORDS)}
      WHEN c IN ('customer service', 'customer sdervice') THEN 'Medium'
      WHEN trim(pred_severity) = 'Low' THEN 'Low'
      ELSE 'Medium' END AS calib_severity
    FROM (SELECT {key}, lower(concat(coalesce(clean_text, ''), ' ', coalesce(input_text, ''))) AS t,
                 lower(coalesce(pred_complaint_type, '')) AS c, pred_severity FROM {source}))"""
