"""Reading model answers: strict JSON, JSON inside prose, and function-call arguments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from casewright import fixed_values as fv
from casewright.functions.binding import let
from casewright.functions.rules import canonicalize_simple

ANSWER = T.StructType([T.StructField(name, T.StringType()) for name in fv.RESPONSE_FIELDS])
_ARGUMENTS_PATH = "$.choices[0].message.function_call.arguments"


def _one_value(text: Column, single_quotes: bool = False) -> Column:
    """The text, re-serialised, if it is exactly one JSON value, else null.

    ``from_json`` stops after the first value. With the text placed inside a
    larger object that must itself parse to its end, trailing text makes it fail.
    The names in that object are made from a hash of the text, so no text can
    contain them and close the object early.
    """
    def read(name: Column) -> Column:
        wrapped = F.concat(F.lit('{"'), name, F.lit('v":['), text, F.lit('],"'), name, F.lit('end":1}'))
        whole = F.from_json(wrapped, "map<string,string>", {"allowSingleQuotes": str(single_quotes).lower()})
        return let(whole, lambda m: F.when(
            (F.size(m) == 2) & F.map_contains_key(m, F.concat(name, F.lit("v"))) & (F.element_at(m, F.concat(name, F.lit("end"))) == "1"),
            let(F.from_json(F.element_at(m, F.concat(name, F.lit("v"))), "array<string>"),
                lambda values: F.when(F.size(values) == 1, F.coalesce(values[0], F.lit("null"))))))

    return let(F.md5(text), read)


def _as_answer(value: Column, text: Column) -> Column:
    """Answer struct of a JSON value that is an object; null for arrays, strings and numbers."""
    return F.when(text.rlike(r"^\s*\{"), F.from_json(value, ANSWER))


def safe_parse_json(text: Column) -> Column:
    """Parse the text as JSON; if it is none, the span from the first ``{`` to the last ``}``; else null.

    Valid JSON that is no object gives null.
    """

    def by_braces(t: Column) -> Column:
        braces = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
        return _as_answer(_one_value(braces), braces)

    return let(text, lambda t: let(
        _one_value(t), lambda value: F.when(value.isNotNull(), _as_answer(value, t)).otherwise(by_braces(t))))


def extract_function_args(response: Column) -> Column:
    """Arguments of the first choice's function call, given as JSON text, an object or a Python literal."""

    def plain_words(t: Column) -> Column:
        for word, plain in (("None", "null"), ("True", "true"), ("False", "false")):
            t = F.regexp_replace(t, rf"([:,\[]\s*){word}(?=\s*[,}}\]])", f"$1{plain}")
        return t

    def read(arguments: Column) -> Column:
        value = F.coalesce(
            _one_value(arguments),
            _one_value(arguments, single_quotes=True),
            _one_value(plain_words(arguments), single_quotes=True),
        )
        return _as_answer(value, arguments)

    return let(F.get_json_object(response, _ARGUMENTS_PATH), read)


def parsed_to_columns(parsed: Column) -> list[Column]:
    """Five prediction columns of the zero-shot table; null where the answer is no object."""
    names = {
        "complaint_type": "complaint_type_pred",
        "severity": "severity_pred",
        "sentiment": "sentiment_pred",
        "root_cause": "root_cause_pred",
        "action_required": "action_required_pred",
    }
    return [parsed[field].alias(name) for field, name in names.items()]


def canonical_prediction(parsed: Column, canonicalize) -> dict[str, Column]:
    """Prediction columns from an answer struct; empty and missing fields get the placeholders."""

    def present(field: str) -> Column:
        return F.when(parsed[field] != "", parsed[field])

    return {
        "complaint_pred_raw": present("complaint_type"),
        "complaint_pred": canonicalize(present("complaint_type")),
        "severity_pred": canonicalize_simple(present("severity"), fv.SEVERITIES),
        "sentiment_pred": canonicalize_simple(present("sentiment"), fv.SENTIMENTS),
        "action_required_pred": canonicalize_simple(present("action_required"), fv.YES_NO),
        "root_cause_pred": F.coalesce(present("root_cause"), F.lit("Unknown")),
    }


def error_placeholder(prediction: dict[str, Column], error: Column) -> dict[str, Column]:
    """Where the call failed, the fixed placeholder values; never an exception."""
    fixed = {
        "complaint_pred_raw": F.lit(None).cast("string"),
        "complaint_pred": F.lit("Other"),
        "severity_pred": F.lit("Unknown"),
        "sentiment_pred": F.lit("Unknown"),
        "action_required_pred": F.lit("Unknown"),
        "root_cause_pred": F.lit("Unknown"),
    }
    return {
        name: F.when(error.isNotNull(), fixed[name]).otherwise(column) for name, column in prediction.items()
    }
