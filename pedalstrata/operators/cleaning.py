"""Row cleaning: required columns, missing values, dates that do not parse.

All but ``split``, which stores the rows, is a narrow projection or filter: no shuffle, and the
null filter reaches the file scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.errors import DatasetError
from pedalstrata.functions.aggregates import row_count
from pedalstrata.functions.casting import column as _named
from pedalstrata.functions.casting import free_name, is_missing, normalise_na, parse_date
from pedalstrata.schemas import REQUIRED_COLUMNS
from pedalstrata.sources.staging import stage


def check_required(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """The frame unchanged, or an error that names the missing and the available columns."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise DatasetError(f"required columns missing: {absent}; available: {df.columns}")
    return df


def _value(df: DataFrame, name: str) -> Column:
    return normalise_na(name) if isinstance(df.schema[name].dataType, T.StringType) else _named(name)


def _absent(df: DataFrame, required: Sequence[str]) -> Column:
    flags = [is_missing(_value(df, c), df.schema[c].dataType) for c in required]
    out = flags[0]
    for flag in flags[1:]:
        out = out | flag
    return out


def drop_missing(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Rows that have a value in every required column."""
    return df.where(~_absent(df, required))


def drop_bad_dates(df: DataFrame, column: str = "dteday", fmt: str | None = None) -> DataFrame:
    """The date column parsed, without the rows where it does not parse."""
    parsed = parse_date(_named(column), df.schema[column].dataType, fmt)
    return df.withColumn(column, parsed).where(_named(column).isNotNull())


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows that belong to some group; Spark would otherwise keep a group for the null key."""
    return df.where(~is_missing(_named(key), df.schema[key].dataType))


def clean(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    date_column: str = "dteday",
    fmt: str | None = None,
) -> DataFrame:
    return drop_bad_dates(drop_missing(check_required(df, required), required), date_column, fmt)


#: What becomes of a row.
KEPT, MALFORMED, MISSING, BAD_DATE = "kept", "malformed", "missing", "bad_date"


def _status(df: DataFrame, required: Sequence[str], date_column: str, fmt: str | None, fault: str | None) -> Column:
    bad = parse_date(_named(date_column), df.schema[date_column].dataType, fmt).isNull()
    malformed = F.lit(False) if fault is None else _named(fault).isNotNull()
    told = F.when(malformed, MALFORMED).when(_absent(df, required), MISSING).when(bad, BAD_DATE)
    return told.otherwise(KEPT)


REPORT_COLUMNS = ("rows_in", "dropped_null", "dropped_bad_date", "rows_out")


def _report(status: Column) -> list[Column]:
    """Rows in, dropped for each reason, and out."""
    return [
        row_count().alias("rows_in"),
        F.count_if(status == MISSING).alias("dropped_null"),
        F.count_if(status == BAD_DATE).alias("dropped_bad_date"),
        F.count_if(status == KEPT).alias("rows_out"),
    ]


def status_counts(
    df: DataFrame, prefix: str = "", required: Sequence[str] = REQUIRED_COLUMNS, date_column: str = "dteday"
) -> list[Column]:
    """The columns of ``cleaning_report`` as aggregates over rows of ``df``, to go with others."""
    counts = _report(_status(check_required(df, required), required, date_column, None, None))
    return [c.alias(f"{prefix}{n}") for c, n in zip(counts, REPORT_COLUMNS, strict=True)]


@dataclass(frozen=True)
class Split:
    """What cleaning made of a table; all three read one stored copy, so they agree.

    ``rows`` are the cleaned ones, ``rejected`` the others as they came, with ``status``, ``every`` all rows as they came;
    ``report`` has the rows in, dropped for each reason, and out.
    """

    rows: DataFrame
    rejected: DataFrame
    every: DataFrame
    report: DataFrame


def split(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    date_column: str = "dteday",
    fmt: str | None = None,
    line: str | None = None,
    fault: str | None = None,
) -> Split:
    """Clean a table and account for every row, from one pass over it.

    Rows are stored with their status, and the counts are taken from the stored rows: a task that
    runs twice leaves one copy of its rows, where a counter would have counted them twice. With ``line``
    and ``fault``, columns of ``readers.Told``, lines that did not fit are set aside as well.
    """
    check_required(df, required)
    status = free_name(df.columns, "status")
    stored = stage(df.withColumn(status, _status(df, required, date_column, fmt, fault)))
    told = [c for c in (line, fault) if c is not None]
    data = [_named(c) for c in df.columns if c not in told]
    kept = stored.where(_named(status) == KEPT).select(*data)
    parsed = parse_date(_named(date_column), df.schema[date_column].dataType, fmt)
    malformed = F.count_if(_named(status) == MALFORMED).alias("dropped_malformed")
    first, *rest = _report(_named(status))
    return Split(
        rows=kept.withColumn(date_column, parsed),
        rejected=stored.where(_named(status) != KEPT),
        every=stored.select(*data),
        report=stored.agg(first, malformed, *rest),
    )


def cleaning_report(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    date_column: str = "dteday",
    fmt: str | None = None,
) -> DataFrame:
    """One row: rows in, dropped for a missing value, dropped for a bad date, rows out.

    One pass over the required columns only, for a report without cleaning; ``split`` does both in
    one. An ``Observation`` would count twice where a lost executor makes a shuffle stage run again.
    """
    check_required(df, required)
    return df.select(_status(df, required, date_column, fmt, None).alias("status")).agg(*_report(F.col("status")))
