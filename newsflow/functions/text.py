"""Text expressions."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsflow.functions.arrays import bind


def clean_text(text: Column) -> Column:
    """Tabs and line breaks become blanks. (``replace`` scans bytes; ``translate`` is slower.)"""
    for char in "\n\r\t":
        text = F.replace(text, F.lit(char), F.lit(" "))
    return text


def plain_spaces(text: Column) -> Column:
    """Non-breaking blanks become blanks."""
    return F.replace(text, F.lit("\u00a0"), F.lit(" "))


def has_text(text: Column) -> Column:
    """1 where the text has at least one character (a blank counts), else 0."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0).otherwise(1)


def unicode_escape(text: Column) -> Column:
    r"""Backslash escapes for everything outside printable ASCII: ``\t \xe9 \u65e5 \U0001f600``.

    The text is cut into runs of plain characters and single other ones, so work per
    element is done only for characters that need an escape.
    """

    def padded_hex(code: Column, width: int) -> Column:
        return F.lpad(F.lower(F.hex(code)), width, "0")

    def escape_one(char: Column) -> Column:
        return bind(
            F.ascii(char),
            lambda code: F.when(char == "\\", F.lit("\\\\"))
            .when(char == "\t", F.lit("\\t"))
            .when(char == "\n", F.lit("\\n"))
            .when(char == "\r", F.lit("\\r"))
            .when(code < 256, F.concat(F.lit("\\x"), padded_hex(code, 2)))
            .when(code < 65536, F.concat(F.lit("\\u"), padded_hex(code, 4)))
            .otherwise(F.concat(F.lit("\\U"), padded_hex(code, 8))),
        )

    def escape(run: Column) -> Column:
        return F.when((run >= " ") & (run < "\x7f") & (run != "\\"), run).otherwise(escape_one(run))

    runs = F.regexp_extract_all(text, F.lit(r"[ -\[\]-~]+|[^ -\[\]-~]"), F.lit(0))
    return F.array_join(F.transform(runs, escape), "")


def null_to_empty(df: DataFrame) -> DataFrame:
    """NULL becomes '' in every string column."""
    return df.na.fill("", [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])


def readable_locations(packed: Column) -> Column:
    """Names and codes of a packed location string, distinct, sorted, ``;``-joined.

    Numbers are removed first, then each ``#`` part is cut at its first ``;``.
    """
    without_numbers = F.regexp_replace(packed, r"-?[0-9]+\.?[0-9]?", "")
    parts = F.filter(F.split(without_numbers, "#"), lambda p: p != "")
    heads = F.transform(parts, lambda p: F.regexp_replace(p, "(?d);.*", ""))
    return F.array_join(F.array_sort(F.array_distinct(heads)), ";")
