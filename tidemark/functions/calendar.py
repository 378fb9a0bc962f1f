"""Calendar periods and instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_MONTH = r"(?s)^(?!0000)\d{4}.\d{2}"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def year_month_to_date(col: Column) -> Column:
    """First day of a ``yyyy-MM`` month; anything else is NULL.

    Four digits, any separator and two digits count; what follows is ignored. The
    test by pattern is cheaper than letting a date parser fail on odd text.
    """
    text = F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 6, 2), F.lit("01"))
    return F.when(col.rlike(YEAR_MONTH), text.try_cast("date"))


def period_to_month(period: Column) -> Column:
    """Number in a monthly code ``Mnn``; other codes are NULL. ``M13`` gives 13."""
    return F.when(period.startswith("M"), F.substring(period, 2, 2).try_cast("int"))


def first_of_month(year: Column, month: Column) -> Column:
    """First day of the month, NULL when the month or year is out of range.

    ``make_date`` throws under ANSI mode, so the range is checked before the call.
    """
    in_range = month.between(1, 12) & year.between(1, 9999)
    return F.when(in_range, F.make_date(year, month, F.lit(1)))


def instant(col: Column) -> Column:
    """ISO-8601 text, with or without offset, to a timestamp."""
    return F.try_to_timestamp(col)


def utc_wall_clock(col: Column) -> Column:
    """The instant as a zone-less UTC clock reading, whatever the session zone is."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), col.cast("timestamp_ntz")
    )


def iso_text(wall_clock: Column) -> Column:
    """ISO-8601 text with a UTC offset for a zone-less UTC clock reading."""
    return F.concat(F.date_format(wall_clock, ISO_MICROS), F.lit("+00:00"))


def month_abbr(day: Column) -> Column:
    return F.date_format(day, "MMM")


def year_month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
