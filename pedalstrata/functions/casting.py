"""Casts that give null instead of an error, and one meaning of "missing" for NaN and null.

ANSI mode makes a plain ``cast`` of bad text fail the whole job, so raw data only ever
passes through ``try_cast``. Every function returns a ``Column`` of built-ins, so it stays
inside whole-stage code generation.

A failing numeric ``try_cast`` of text raises and catches an error inside the task: about
10 microseconds, some forty times a good cell, so a column of the wrong kind would dominate
the job. A pattern test comes first, and only text that looks like a number is cast. ISO dates
need none: their parser fails without an error; that of eight digits does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.schemas import NA_TOKENS

# Nothing to go back for in numbers: each part ends where the next begins.
_INTEGER = r"^\s*+[+-]?+\d++\s*+$"
# Also keeps out "1d", "1f" and hexadecimal floats, which Java's parser would take.
_DOUBLE = r"^\s*+[+-]?+(?:(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+|(?i:inf(?:inity)?+))\s*+$"
# Year, month and day, alone or before a time of day; also without separators.
_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?\s*$"
# Only with a month and a day that there are: the parser of a given format fails with an error inside, and
# any number of eight digits would come to it.
_COMPACT_DATE = r"^\s*\d{4}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\s*$"
# The texts pandas reads as booleans by default.
_BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def is_missing(c: Column, dtype: T.DataType) -> Column:
    """Null, or NaN in a floating column."""
    return (c.isNull() | F.isnan(c)) if is_floating(dtype) else c.isNull()


def null_if_missing(c: Column, dtype: T.DataType) -> Column:
    return nan_to_null(c) if is_floating(dtype) else c


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column by its exact name, whatever characters are in it."""
    return F.col(quoted(name))


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until none of the columns has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def _text_list(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def na_to_null(name: str, tokens: Sequence[str] = NA_TOKENS) -> str:
    """SQL for a text column with every missing-value token turned into null."""
    c = quoted(name)
    return f"CASE WHEN {c} NOT IN ({_text_list(tokens)}) THEN {c} END"


def normalise_na(name: str, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """A text column with every missing-value token turned into null."""
    return F.expr(na_to_null(name, tokens))


def normalise_na_columns(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    return df.select(
        *[
            normalise_na(f.name, tokens).alias(f.name) if isinstance(f.dataType, T.StringType) else column(f.name)
            for f in df.schema
        ]
    )


# What a text cell can be read as, narrowest first.
INTEGER, DOUBLE, BOOLEAN, TEXT = 1, 2, 3, 4


def literal_kind(name: str, tokens: Sequence[str] = ()) -> Column:
    """The narrowest kind each cell of a text column fits, null for a null cell and one of ``tokens``.

    No token may be a number or a boolean.
    """
    c = quoted(name)
    text = f"{c} NOT IN ({_text_list(tokens)})" if tokens else f"{c} IS NOT NULL"
    return F.expr(
        f"""CASE WHEN octet_length({c}) = 1 AND {c} BETWEEN '0' AND '9' THEN {INTEGER}
            WHEN NOT contains({c}, '.') AND {c} RLIKE r'{_INTEGER}'
              THEN IF(length({c}) < 19 OR try_cast({c} AS bigint) IS NOT NULL, {INTEGER}, {TEXT})
            WHEN {c} RLIKE r'{_DOUBLE}' THEN {DOUBLE}
            WHEN {c} IN ({_text_list(_BOOLEANS)}) THEN {BOOLEAN}
            WHEN {text} THEN {TEXT} END"""
    )


def safe_int(c: Column, dtype: T.DataType) -> Column:
    """64-bit integer or null. Text must be an integer literal; floats round half away from zero."""
    if isinstance(dtype, T.StringType):
        return F.when(c.rlike(_INTEGER), c.try_cast("bigint"))
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.round(c).try_cast("bigint")
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    return c.try_cast("bigint")


def safe_double(c: Column, dtype: T.DataType) -> Column:
    """Double or null; NaN counts as null."""
    if isinstance(dtype, T.StringType):
        return F.when(c.rlike(_DOUBLE), c.try_cast("double"))
    if is_floating(dtype):
        return nan_to_null(c.cast("double"))
    return c.try_cast("double")


def parse_date(c: Column, dtype: T.DataType, fmt: str | None = None) -> Column:
    """Date or null: ISO text with or without a time of day, ``yyyyMMdd`` as text or number, or
    exactly ``fmt`` when given. Anything behind a date that is no time of day makes it null."""
    if fmt is not None and isinstance(dtype, T.StringType):
        return F.try_to_date(c, fmt)
    if isinstance(dtype, T.IntegralType):
        c, dtype = c.cast("string"), T.StringType()
    if isinstance(dtype, T.StringType):
        compact = F.when(c.rlike(_COMPACT_DATE), F.try_to_date(F.trim(c), "yyyyMMdd"))
        return F.when(c.rlike(_DATE), c.try_cast("date")).otherwise(compact)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    return F.lit(None).cast("date")


def safe_cast(c: Column, dtype: T.DataType, target: str) -> Column:
    if target == "bigint":
        return safe_int(c, dtype)
    if target == "double":
        return safe_double(c, dtype)
    if target == "date":
        return parse_date(c, dtype)
    return c.try_cast(target)


def int_truncate(c: Column) -> Column:
    """Drop the fraction, toward zero."""
    return c.try_cast("bigint")


def round_half_even(c: Column, digits: int = 6) -> Column:
    return F.bround(c, digits)
