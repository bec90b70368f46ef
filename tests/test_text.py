"""Text, rules, answers and prompts on hand-made rows; expected values follow from the rules."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from casewright import fixed_values as fv
from casewright.functions import answers, prompts, rules, text as tx
from casewright.functions.keywords import keyword_counts
from casewright.operators import prepare


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_normalize(spark):
    values = ["  A\t\nB  ", "x  y", "\x1cQ\x1f", "", None, "STRASSE ß", "a\u0085b"]
    assert column(spark, values, tx.normalize_text) == ["a b", "x y", "q", "", None, "strasse ß", "a b"]


def test_redact(spark):
    values = [
        "mail a.b-c@d-e.co.uk now", "josé@mañana.es", "x@y.c", "a@b.com, c@d.org", "-x@y.com",
        "555-123-4567", "555.123 4567", "5551234567", "x5551234567", "5551234567x", "(743) 555-3824", "٥٥٥-١٢٣-٤٥٦٧",
        "12345678901",
    ]
    assert column(spark, values, tx.redact) == [
        "mail [REDACTED_EMAIL] now", "[REDACTED_EMAIL]", "x@y.c", "[REDACTED_EMAIL], [REDACTED_EMAIL]",
        "-[REDACTED_EMAIL]", "[REDACTED_PHONE]", "[REDACTED_PHONE]", "[REDACTED_PHONE]", "x5551234567", "5551234567x",
        "(743) 555-3824", "[REDACTED_PHONE]", "12345678901",
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB é@.-1234567890 \t\n ", max_size=40), min_size=1, max_size=30))
def test_cleaning_twice_changes_nothing(spark, values):
    once = column(spark, values, tx.clean_text)
    assert column(spark, once, tx.normalize_text) == [v.lower() for v in once]
    assert column(spark, once, tx.redact) == once


def test_words_and_terms(spark):
    assert column(spark, ["", " a  b c ", None], tx.word_count) == [0, 3, None]
    assert column(spark, ["It's a b2b día"], tx.tokens) == [["it", "b2b", "día"]]
    assert column(spark, ["one two three"], lambda c: tx.unigrams_and_bigrams(tx.tokens(c))) == [
        ["one", "two", "three", "one two", "two three"]]
    assert column(spark, ["one", ""], lambda c: tx.unigrams_and_bigrams(tx.tokens(c))) == [["one"], []]


LABELS = [
    # raw, collapse, rag, infer
    ("Payment/Billing", "Billing", "Billing", "Billing"),
    ("Customer Sdervice", "Customer Service", "Customer Service", "Customer Service"),
    ("Performance/Latency", "Performance", "Performance", "Performance"),
    ("Account/Subscription", "Other", "Other", "Other"),
    ("N/A", "Other", "Other", "Other"),
    ("support issue", "Customer Service", "Product Defect", "Product Defect"),
    ("product latency", "Performance", "Product Defect", "Product Defect"),
    ("not received", "Delivery", "Other", "Delivery"),
    ("order not received", "Delivery", "Delivery", "Delivery"),
    ("ux", "Other", "Product Defect", "Other"),
    ("quick reply", "Customer Service", "Product Defect", "Product Defect"),
    (" Authentication ", "Login", "Login", "Login"),
    ("Technical Issue", "Product Defect", "Product Defect", "Product Defect"),
    ("", "Other", "Other", "Other"),
    (None, "Other", "Other", "Other"),
]


@pytest.mark.parametrize("place, rule", [
    (1, rules.collapse_label), (2, rules.canonicalize_complaint_rag), (3, rules.canonicalize_complaint_infer)])
def test_label_rules(spark, place, rule):
    assert column(spark, [r[0] for r in LABELS], rule) == [r[place] for r in LABELS]


def test_canonicalize_simple(spark):
    values = ["Low", " High ", "low", "", None, "Medium "]
    assert column(spark, values, lambda c: rules.canonicalize_simple(c, fv.SEVERITIES)) == [
        "Low", "High", "Unknown", "Unknown", "Unknown", "Medium"]


SEVERITY = [
    # text, complaint, predicted, expected
    ("my account locked after update", "Login", None, "High"),
    ("question about a charge", "Billing", "Low", "High"),
    ("invoice copy please", "Billing", "High", "Medium"),
    ("payment page looks odd", "Other", "Low", "Medium"),
    ("screen not working", "Product Defect", None, "High"),
    ("colour differs from photo", "Product Defect", "High", "Medium"),
    ("unable to login", "Login", None, "High"),
    ("forgot my name", "account/subscription", None, "Medium"),
    ("parcel never arrived", "Delivery", None, "High"),
    ("when does it ship", "Delivery", None, "Medium"),
    ("app timeout", "Performance", None, "High"),
    ("pages feel heavy", "Performance", None, "Medium"),
    ("rude agent", "Customer Service", "Low", "Medium"),
    ("rude agent", "Customer Sdervice", "Low", "Medium"),
    ("hello", "Other", "Low", "Low"),
    ("hello", "Other", " Low ", "Low"),
    ("hello", "Other", "High", "Medium"),
    ("hello", "Other", "Medium", "Medium"),
    ("hello", None, None, "Medium"),
    (None, None, "low", "Medium"),
]


def test_severity(spark):
    rows = [(i, t, None, c, p) for i, (t, c, p, _) in enumerate(SEVERITY)]
    df = spark.createDataFrame(
        rows, "i int, clean_text string, input_text string, pred_complaint_type string, pred_severity string")
    got = [r.calib_severity for r in rules.with_calib_severity(df).orderBy("i").collect()]
    assert got == [s[3] for s in SEVERITY]


SENTIMENT = [
    ("thanks, great", None, "Positive"),
    ("could you clarify details", None, "Neutral"),
    ("please help", None, "Neutral"),
    ("please help me with this very long request today", None, "Negative"),
    ("it is broken", None, "Negative"),
    ("", None, "Negative"),
    (None, "Thank you", "Positive"),
    ("", "Thank you", "Positive"),
    ("it works, thanks. question: info", None, "Negative"),
]


def test_sentiment(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(SENTIMENT)],
                               "i int, clean_text string, input_text string")
    got = [r.calib_sentiment for r in rules.with_calib_sentiment(df).orderBy("i").collect()]
    assert got == [s[2] for s in SENTIMENT]


def test_count_occurrences(spark):
    texts = ["not not nothing", "crashes crash", "aaa"]
    expected = [[t.count(w) for w in fv.NEGATIVE_WORDS] for t in texts]
    assert column(spark, texts, lambda c: rules.count_occurrences(c, fv.NEGATIVE_WORDS)) == [sum(e) for e in expected]


def test_keyword_counts(spark):
    lists = {"a b": ["no", "not", "cannot", "aa", "é", "日本"], "two": ["not", "not", "a"], "none": []}
    texts = ["cannot", "aaaaa", "no not nnot", "", None, "é日本日本 é", "x" * 100_000 + "aa" * 50_000, "NOT"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.n for r in df.select("i", keyword_counts(F.col("t"), lists).alias("n")).orderBy("i").collect()]
    assert [None if n is None else list(n) for n in got] == [None if t is None else [sum(t.count(w) for w in words) for words in lists.values()] for t in texts]
    assert df.limit(0).select(keyword_counts(F.col("t"), lists)).count() == 0
    plan = df.select(keyword_counts(F.col("t"), lists).alias("n")).select("n.two", "n.none")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    with pytest.raises(ValueError):
        keyword_counts(F.col("t"), {"x": [""]})


def python_parse(text):
    """What a strict parse with the braces fallback gives; None unless an object."""
    import re
    try:
        value = json.loads(text)
    except Exception:
        found = re.search(r"(\{.*\})", text, flags=re.DOTALL)
        try:
            value = json.loads(found.group(1)) if found else None
        except Exception:
            value = None
    return value if isinstance(value, dict) else None


def test_safe_parse_json(spark):
    good = '{"complaint_type": "A", "severity": "Low"}'
    texts = [
        good, f"Sure:\n```json\n{good}\n```", "not json", "{bad", f"[{good}]", f"{good} tail {good}", f"{good} tail",
        "{'complaint_type': 'A'}", '{"complaint_type": null}', "", "{}", f"\n {good}\n", '"{}"', "null", "7",
        '{"complaint_type": "a\nb"}', f"{good},{good}", f'{good},"x":{good}', '{"complaint_type": "a", "complaint_type": "b"}',
        '{"complaint_type": "say \\"hi\\" \\u00e9"}', "[1] {" + good[1:],
    ]
    got = column(spark, texts, answers.safe_parse_json)
    for text, row in zip(texts, got):
        expected = python_parse(text)
        assert (row is None) == (expected is None), text
        if expected is not None:
            assert row.complaint_type == expected.get("complaint_type"), text
            assert row.severity == expected.get("severity"), text


def test_extract_function_args(spark):
    def response(arguments):
        return json.dumps({"choices": [{"message": {"function_call": {"name": "f", "arguments": arguments}}}]})

    texts = [
        response('{"complaint_type": "A"}'), response({"complaint_type": "B"}), response("{'complaint_type': 'C'}"),
        response("{'complaint_type': 'D', 'root_cause': None}"), response("nothing"), response(None), "{}", None, "bad",
        json.dumps({"choices": []}),
    ]
    got = column(spark, texts, lambda c: answers.extract_function_args(c)["complaint_type"])
    assert got == ["A", "B", "C", "D", None, None, None, None, None, None]


def test_prompts(spark):
    assert column(spark, ["hi", None], lambda c: prompts.fill_prompt("<{text}>", c)) == ["<hi>", "<>"]
    with pytest.raises(ValueError):
        prompts.fill_prompt("no slot", F.lit("x"))
    labels = {"complaint_type": "Billing", "severity": "Low", "sentiment": "Neutral", "root_cause": 'say "x"',
              "action_required": "No"}
    snippet = column(spark, ["a ```b``` c"], lambda c: prompts.example_snippet(c, {k: F.lit(v) for k, v in labels.items()}))
    assert snippet == [f"Ticket:\n```a b c```\nOutput:\n{json.dumps(labels)}\n"]
    whole = column(spark, ["t```"], lambda c: prompts.fewshot_prompt(F.array(F.lit("one"), F.lit("two")), c, "rag"))
    assert whole == [fv.RAG_HEADER + "\nonetwo\nNow classify:\n```t```\n"]


def test_json_text_cannot_close_what_surrounds_it(spark):
    tricks = ['{"a":1}],"v":[{"complaint_type":"x"}', '{"a":1}],"end":1,"v":[{"complaint_type":"x"}', '{"complaint_type":"x"},{"a":1}', '{"complaint_type":"x"}]']
    got = column(spark, [*tricks[:2], '{"complaint_type":"x"}'], answers.safe_parse_json)
    assert [g and g["complaint_type"] for g in got] == [None, None, "x"]
    assert column(spark, tricks, answers._one_value) == [None] * 4


def test_ticket_id_before_other_ids(spark):
    raw = spark.createDataFrame([("7", 70, "a"), ("8", 80, "b")], "id string, ticket_id int, text string")
    rows = prepare.assign_ticket_id(raw).orderBy("ticket_id").collect()
    assert [(r.ticket_id, r.orig_ticket_id, r.id) for r in rows] == [(70, "70", "7"), (80, "80", "8")]
    numbered = spark.createDataFrame([(None, "x"), (5, "y"), (None, "z")], "k int, text string")
    assert sorted(r.ticket_id for r in prepare.assign_ticket_id(numbered, order_key="k").collect()) == [1, 2, 3]


def test_row_text_is_whole_unless_asked(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").withColumn("a", F.lit(10**9)).select(*[F.col("a").alias(f"c{i}") for i in range(300)])
    assert len(df.select(prepare.concat_text(df)).first()[0]) == 300 * 10 + 299
    assert len(df.select(prepare.concat_text(df, row_chars=1000)).first()[0]) == 1000
