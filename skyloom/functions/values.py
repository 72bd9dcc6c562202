"""Text to value conversion and the null rules of the training data."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grammar of numbers: blanks around the text, digits that
# may be grouped with single underscores, infinities and a signed nan. Type suffixes
# and hexadecimal floats, which the JVM parser would take, are not numbers.
_BLANK = r"[ \t\n\r\x0b\x0c]*"
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = (
    rf"[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)"
)
# The sign of a nan stays outside the group that is converted.
_TEXT = rf"^{_BLANK}(?:[+-](?=[nN]))?({_NUMBER}|[nN][aA][nN]){_BLANK}$"


def parse_double(text: Column) -> Column:
    """Text to double; null when the text is not a number.

    The JVM cast agrees with the grammar on texts without letters other than the
    exponent's, so only a text with such a letter or an underscore is matched.
    """
    matched = F.translate(F.regexp_extract(text, _TEXT, 1), "_", "").try_cast("double")
    return F.when(text.rlike("[_a-zA-Z&&[^eE]]"), matched).otherwise(text.try_cast("double"))


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def exceeds(value: Column, limit: float) -> Column:
    """``value > limit`` where a missing or NaN value compares as false."""
    return F.coalesce(nan_to_null(value) > F.lit(float(limit)), F.lit(False))


def text_or_empty(text: Column) -> Column:
    """The CSV reader gives null for an empty field; identifiers keep the empty text."""
    return F.coalesce(text, F.lit(""))


def departure_time(flight_date: Column, wheels_off: Column) -> Column:
    """Date ``yyyy-MM-dd`` and clock ``HHmm`` to a UTC timestamp; null when invalid."""
    clock = F.concat(F.substring(wheels_off, 1, 2), F.lit(":"), F.substring(wheels_off, 3, 2))
    text = F.concat(flight_date, F.lit("T"), clock, F.lit(":00"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss"))


def iso_utc(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc(moment: datetime) -> datetime:
    """A ``datetime`` without a zone is UTC, whatever the zone of the driver's machine."""
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)
