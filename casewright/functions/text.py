"""Text normalisation, redaction and tokens, with Unicode-aware character classes.

Java regexes are ASCII by default. The classes below spell out what a Unicode
word character and whitespace are, so that NBSP, accented addresses and
non-Latin digits are handled.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casewright.fixed_values import EMAIL_MARK, PHONE_MARK
from casewright.functions.binding import let

_SPACE = r"(?U)[\s\x1c-\x1f]+"
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_NOT_SPACE = r"(?U)[^\s\x1c-\x1f]+"
_W = r"\p{L}\p{N}_"
_EMAIL = (
    rf"(?:(?<![{_W}])(?=[{_W}])|(?<=[{_W}])(?=[.-]))"
    rf"[{_W}.-]+@[{_W}.-]+\.[{_W}]{{2,}}(?![{_W}])"
)
_PHONE = (
    rf"(?U)(?=\p{{Nd}})(?<![{_W}])\p{{Nd}}{{3}}[-.\s]?\p{{Nd}}{{3}}[-.\s]?\p{{Nd}}{{4}}(?![{_W}])"
)
TOKEN_PATTERN = rf"[{_W}]{{2,}}"


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` knows only the ASCII space)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def normalize_text(text: Column) -> Column:
    """Collapse whitespace runs to one space, strip, lower-case."""
    return F.lower(F.trim(F.regexp_replace(text, _SPACE, " ")))


def redact_email(text: Column) -> Column:
    # The plain substring test spares most texts the regex.
    return F.when(text.contains("@"), F.regexp_replace(text, _EMAIL, EMAIL_MARK)).otherwise(text)


def redact_phone(text: Column) -> Column:
    return F.regexp_replace(text, _PHONE, PHONE_MARK)


def redact(text: Column) -> Column:
    return redact_phone(redact_email(text))


def clean_text(text: Column) -> Column:
    """Normalise, then redact e-mail addresses, then phone numbers."""
    return redact(normalize_text(text))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for an empty text."""
    return F.regexp_count(text, F.lit(_NOT_SPACE))


def tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def unigrams_and_bigrams(words: Column) -> Column:
    """The words, then each adjacent pair joined by a space."""

    def both(w: Column) -> Column:
        pairs = F.greatest(F.size(w) - 1, F.lit(0))
        return F.concat(w, F.zip_with(
            F.slice(w, F.lit(1), pairs), F.slice(w, F.lit(2), pairs), lambda a, b: F.concat_ws(" ", a, b)))

    return let(words, both)
