"""From raw tickets to the clean ticket table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from casewright import fixed_values as fv
from casewright.functions import text as tx
from casewright.operators.positions import file_position, key_position

TIMESTAMP_FORMATS = [
    "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm", "MM/dd/yyyy",
]


def detect_id_col(columns: Sequence[str]) -> str | None:
    """First column, in the given order, that is named like an id."""
    return next((c for c in columns if c.lower() in fv.ID_COLUMN_NAMES), None)


def _whole_number(raw: Column, strict: bool) -> Column:
    """Text to bigint; "12.0" is 12. A bad value fails the job, or is null if not strict."""
    wide = T.DecimalType(38, 10)
    number = raw.cast(wide) if strict else raw.try_cast(wide)
    return (number.cast("long") if strict else number.try_cast("long"))


def assign_ticket_id(raw: DataFrame, order_key: str | None = None, strict: bool = True) -> DataFrame:
    """Add ``ticket_id`` (bigint) and ``orig_ticket_id`` (string).

    The id column is used if there is one, ``ticket_id`` before any other. Otherwise rows are numbered from 1 in
    file order, or in the order of ``order_key`` for data that no longer knows
    its file. With ``strict=False`` a bad id gives a null to quarantine.
    """
    named = next((c for c in raw.columns if c.lower() == "ticket_id"), None)  # before any other id column
    found = named or detect_id_col(raw.columns)
    if found:
        text = F.col(found).cast("string")
        as_number = text.try_cast("long")
        return raw.withColumn("orig_ticket_id", F.coalesce(as_number.cast("string"), text)).withColumn(
            found, _whole_number(text, strict)).withColumnRenamed(found, "ticket_id")
    placed = key_position(raw, order_key, "__row") if order_key else file_position(raw, "__row")
    return (
        placed.withColumn("ticket_id", F.col("__row") + 1)
        .withColumn("orig_ticket_id", F.col("ticket_id").cast("string"))
        .drop("__row")
    )


def parse_created_at(value: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Lenient timestamp: ISO forms, then the formats in order; null if none fits."""
    return F.coalesce(F.try_to_timestamp(value), *[F.try_to_timestamp(value, F.lit(f)) for f in formats])


def select_text_cols(df: DataFrame) -> list[str]:
    """The known text columns in their fixed order, else the first two string columns that are no ids."""
    known = [c for c in fv.TEXT_COLUMN_NAMES if c in df.columns]
    if known:
        return known
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return [c for c in strings if c not in ("ticket_id", "orig_ticket_id")][:2]


def concat_text(df: DataFrame, columns: Sequence[str] | None = None, row_chars: int | None = None) -> Column:
    """Text columns joined by one space, nulls as empty; with no text column, the row as text.

    ``row_chars`` cuts that row text; 1000 gives the results of the original, which cuts it there.
    """
    columns = select_text_cols(df) if columns is None else columns
    if columns:
        return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in df.columns]
    whole = F.concat_ws(" ", *cells)
    return whole if row_chars is None else F.substring(whole, 1, row_chars)


def project_clean(df: DataFrame) -> DataFrame:
    optional = [c for c in ("created_at", "subject", "description") if c in df.columns]
    return df.select("ticket_id", "clean_text", "orig_ticket_id", *optional)


def prepare_tickets(raw: DataFrame, order_key: str | None = None, strict: bool = True) -> DataFrame:
    """Ids, timestamps, joined and cleaned text, final columns. One projection; a shuffle only without an id."""
    df = assign_ticket_id(raw, order_key, strict)
    if "created_at" in df.columns and not isinstance(df.schema["created_at"].dataType, T.TimestampType):
        df = df.withColumn("created_at", parse_created_at(F.col("created_at")))
    return project_clean(df.withColumn("clean_text", tx.clean_text(concat_text(df))))
