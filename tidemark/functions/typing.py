"""Tolerant typing: text that does not parse becomes NULL, under ANSI mode too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a flag column may hold.
TRUE_WORDS = ("yes", "y", "true", "t", "1")
FALSE_WORDS = ("no", "n", "false", "f", "0")


def flag_or_null(col: Column) -> Column:
    """True, false, or NULL for any other word; blanks and case do not matter."""
    word = F.lower(F.trim(col))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def flag_or_false(col: Column) -> Column:
    """True or false; every word that is not a true word, and NULL, is false.

    Spark's own text-to-boolean cast knows the same words in any case.
    """
    return F.coalesce(col.try_cast("boolean"), F.lit(False))


def amount(col: Column) -> Column:
    """Number from text with thousands separators."""
    return F.replace(col, F.lit(","), F.lit("")).try_cast("double")


def integer(col: Column) -> Column:
    return col.try_cast("int")


def number(col: Column) -> Column:
    return col.try_cast("double")


def utf8(col: Column) -> Column:
    """Text held in a binary message part."""
    return col.cast("string")
