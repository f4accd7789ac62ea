"""Batch timestamps, dates and date parts.

Feed times are UTC digits, so they are read as ``timestamp_ntz``: a session time
zone with daylight saving cannot move them.
"""

from datetime import date, datetime

from pyspark.sql import Column, functions as F

BATCH_DIGITS = r"(?:^|/)(\d{14})[^/]*$"


def batch_digits(name: Column) -> Column:
    """The ``YYYYMMDDHHMMSS`` digits that start the base name of a feed file, or ''."""
    return F.regexp_extract(name, BATCH_DIGITS, 1)


def batch_ts(digits: Column) -> Column:
    """``YYYYMMDDHHMMSS`` digits (text or number) as ``timestamp_ntz``; NULL when invalid."""
    iso = F.regexp_replace(
        digits.cast("string"),
        r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$",
        "$1-$2-$3 $4:$5:$6",
    )
    return F.when(F.length(iso) == 19, iso.try_cast("timestamp_ntz"))


def batch_label(ts: Column) -> Column:
    """The ``YYYYMMDDHHMMSS`` label of a batch timestamp (no detour over a time zone)."""
    return F.translate(F.substring(ts.cast("string"), 1, 19), "-: ", "")


def _iso(stamp: Column) -> Column:
    text = stamp.cast("string")
    dash = F.lit("-")
    return F.concat(
        F.substring(text, 1, 4), dash, F.substring(text, 5, 2), dash, F.substring(text, 7, 2)
    )


def strict_date(ymd: Column) -> Column:
    """``YYYYMMDD`` as a date; under ANSI mode (the default) a bad value fails the job."""
    return F.when(F.length(ymd.cast("string")) > 8, F.lit("")).otherwise(_iso(ymd)).cast("date")


def lenient_date(stamp: Column) -> Column:
    """First eight digits of a number or text as a date; NULL when invalid or before year 2.

    A cast from ISO text: a format-based parse would raise and catch an error per bad row.
    """
    return F.when(F.substring(stamp.cast("string"), 1, 4) > "0001", _iso(stamp).try_cast("date"))


def date_parts(day: Column) -> list[Column]:
    """``year``, ``month`` and ``day`` columns of a date."""
    return [F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day")]


def month_label(month: Column) -> Column:
    """Month number as two digits."""
    return F.lpad(month.cast("string"), 2, "0")


def partition_columns(day: Column) -> list[Column]:
    """The ``year``/``month``/``ymd`` text columns by which tables are laid out."""
    text = day.cast("string")
    return [
        F.substring(text, 1, 4).alias("year"),
        F.substring(text, 6, 2).alias("month"),
        F.replace(text, F.lit("-"), F.lit("")).alias("ymd"),
    ]


def check_ymd(ymd: str) -> date:
    """Check a ``YYYYMMDD`` job argument and return it as a date."""
    if len(ymd) != 8 or not (ymd.isascii() and ymd.isdigit()):
        raise ValueError(f"expected a date as YYYYMMDD, got {ymd!r}")
    return datetime.strptime(ymd, "%Y%m%d").date()
