"""Encoding and decoding of one series point as a keyed JSON message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import MESSAGE_SCHEMA
from tidemark.functions import calendar, typing

# How the message key is rendered.
KEY_SEPARATOR = "|"
MISSING_PART = "None"


def message_key(*parts: Column) -> Column:
    """Parts joined by the separator; a missing part keeps its place.

    ``concat_ws`` alone would skip a NULL and so make different keys collide.
    """
    shown = [F.coalesce(p.cast("string"), F.lit(MISSING_PART)) for p in parts]
    return F.concat_ws(KEY_SEPARATOR, *shown)


def footnote_texts(footnotes: Column) -> Column:
    """Texts of an ``array<map<string,string>>``; NULL and key-less notes are dropped.

    A note that has keys but no text keeps its place as NULL. No array at all
    gives an empty list.
    """
    notes = F.coalesce(footnotes, F.array().cast("array<map<string,string>>"))
    kept = F.filter(notes, lambda note: F.size(note) > 0)
    return F.transform(kept, lambda note: note["text"])


def latest_flag(col: Column) -> Column:
    """Flag as the publisher writes it: only the words true and 1 count."""
    return F.coalesce(F.lower(col.cast("string")).isin("true", "1"), F.lit(False))


def encode_points(points: DataFrame, ts_ingested: Column | None = None) -> DataFrame:
    """Payload points to ``key, value`` messages, all stamped with one instant.

    ``ts_ingested`` is ISO-8601 text. Pass a literal for a repeatable run; the
    default is the start of the query.
    """
    if ts_ingested is None:
        ts_ingested = calendar.iso_text(calendar.utc_wall_clock(F.current_timestamp()))
    body = F.struct(
        ts_ingested.alias("ts_ingested"),
        F.col("seriesID").alias("series_id"),
        "year",
        "period",
        "periodName",
        "value",
        footnote_texts(F.col("footnotes")).alias("footnotes"),
        latest_flag(F.col("latest")).alias("is_latest"),
    )
    return points.select(
        message_key(F.col("seriesID"), F.col("year"), F.col("period")).alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """Binary message bodies to typed bronze rows.

    A corrupt or NULL body becomes an all-NULL row with a false flag; it is kept
    here and turned away later by the contract of the serving table. The body comes
    out of a generator, through which no later filter is pushed: it is parsed once.
    """
    body = F.from_json(typing.utf8(F.col("value")), MESSAGE_SCHEMA)
    return (
        messages.select(F.inline(F.array(body)))
        .withColumns(
            {
                "year": typing.integer(F.col("year")),
                "value": typing.number(F.col("value")),
                "is_latest": typing.flag_or_false(F.col("is_latest")),
            }
        )
    )


def type_points(bronze: DataFrame) -> DataFrame:
    """Bronze rows to silver rows: instant, typed fields, month and first of month.

    Accepts the declared bronze schema as well as the all-text fallback.
    """
    month = calendar.period_to_month(F.col("period"))
    typed = bronze.select(*MESSAGE_SCHEMA.names).withColumns(
        {
            "ts_ingested": calendar.instant(F.col("ts_ingested").cast("string")),
            "year": typing.integer(F.col("year")),
            "value": typing.number(F.col("value")),
            "is_latest": F.col("is_latest").try_cast("boolean"),
        }
    )
    return typed.withColumns(
        {"month": month, "dt": calendar.first_of_month(F.col("year"), month)}
    )
