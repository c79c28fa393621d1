"""Data-quality reports: each is one aggregate pass that returns rows, not log lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalstrata.errors import DatasetError
from pedalstrata.functions.aggregates import missing_cells, row_count
from pedalstrata.functions.casting import column, is_missing
from pedalstrata.functions.labels import calendar_season, month_day
from pedalstrata.schemas import DOMAIN_RULES, MIN_COLUMNS, MIN_ROWS, REQUIRED_COLUMNS


def _unpivot(row: DataFrame, names: Sequence[str], name: str, value: str) -> DataFrame:
    """A one-row frame as one (name, value) row per listed column."""
    return row.unpivot([], [column(n) for n in names], name, value)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(row_count().alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def count_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.agg(missing_cells(df, columns).alias("n_nulls"))


def verdict(
    profile: DataFrame, dataset: str, n_cols: int, min_rows: int = MIN_ROWS, min_cols: int = MIN_COLUMNS
) -> DataFrame:
    """The validation row from a one-row frame with ``n_rows`` and ``n_nulls``."""
    rows_ok, cols_ok = F.col("n_rows") >= min_rows, F.lit(n_cols >= min_cols)
    return profile.select(
        F.lit(dataset).alias("dataset"),
        "n_rows",
        F.lit(n_cols).cast("bigint").alias("n_cols"),
        "n_nulls",
        rows_ok.alias("rows_ok"),
        cols_ok.alias("cols_ok"),
        (rows_ok & cols_ok).alias("valid"),
    )


def validate_dataset(
    df: DataFrame, dataset: str, min_rows: int = MIN_ROWS, min_cols: int = MIN_COLUMNS
) -> DataFrame:
    """Size gate (inclusive thresholds); missing cells are reported, never fatal."""
    profile = df.agg(row_count().alias("n_rows"), missing_cells(df).alias("n_nulls"))
    return verdict(profile, dataset, len(df.columns), min_rows, min_cols)


def require_valid(*reports: DataFrame) -> None:
    """Raise once, naming every failed threshold of every report (one row per dataset)."""
    problems = []
    for report in reports:
        for r in report.collect():
            if not r.rows_ok:
                problems.append(f"{r.dataset}: too few rows ({r.n_rows})")
            if not r.cols_ok:
                problems.append(f"{r.dataset}: too few columns ({r.n_cols})")
    if problems:
        raise DatasetError("; ".join(problems))


def require_rows(df: DataFrame, dataset: str) -> DataFrame:
    """The frame unchanged, or an error if it has no row; reads at most one row."""
    if df.isEmpty():
        raise DatasetError(f"{dataset}: no rows")
    return df


def required_columns_report(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Per required column: whether it exists, and how many rows lack a value."""
    counts = [
        F.count_if(is_missing(column(c), df.schema[c].dataType)).alias(c)
        if c in df.columns
        else row_count().alias(c)
        for c in required
    ]
    long = _unpivot(df.agg(*counts), required, "column", "n_missing")
    return long.select("column", F.col("column").isin(*df.columns).alias("present"), "n_missing")


def schema_report(df: DataFrame) -> DataFrame:
    """Per column: position, name, type and number of present values."""
    counts = [F.count_if(~is_missing(column(f.name), f.dataType)).alias(f.name) for f in df.schema]
    long = _unpivot(df.agg(*counts), df.columns, "name", "n_values")
    names = F.array(*[F.lit(c) for c in df.columns])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in df.schema])
    position = F.array_position(names, F.col("name"))
    return long.select(
        position.cast("bigint").alias("position"),
        "name",
        F.element_at(types, position.cast("int")).alias("type"),
        "n_values",
    )


def check_total(df: DataFrame) -> DataFrame:
    """Rows where the total is not the sum of its two parts."""
    return total_report(df).select("n_rows", "n_violations")


def total_report(df: DataFrame) -> DataFrame:
    """Rows where the total is not the sum of its two parts, and apart from those, rows where that
    cannot be told because the total or a part is missing."""
    total = F.col("total_rides")
    parts = F.col("casual_users") + F.col("registered_users")
    return df.agg(
        row_count().alias("n_rows"),
        F.count_if(total != parts).alias("n_violations"),
        F.count_if(total.isNull()).alias("n_null_totals"),
        F.count_if(total.isNotNull() & parts.isNull()).alias("n_null_parts"),
    )


def check_domains(
    df: DataFrame, rules: Sequence[tuple[str, str, int, int]] = DOMAIN_RULES
) -> DataFrame:
    """Violations per rule ``(name, column, lowest, highest)``; a null violates nothing.

    A rule on a column that is not there is an error: it must not pass for a kept one.
    """
    if absent := [(rule, c) for rule, c, _, _ in rules if c not in df.columns]:
        raise DatasetError(f"rules on missing columns: {absent}; available: {df.columns}")
    counts = [F.count_if(~column(c).between(lo, hi)).alias(rule) for rule, c, lo, hi in rules]
    return _unpivot(df.agg(*counts), [r[0] for r in rules], "rule", "n_violations")


def season_calendar_check(df: DataFrame) -> DataFrame:
    """Per season code: first and last month-day and rows off the calendar season."""
    md = month_day(F.col("ride_date"))
    expected = calendar_season(F.col("ride_date"))

    def text(c: str) -> Column:
        return F.format_string("%02d-%02d", (F.col(c) / 100).cast("int"), F.col(c) % 100)

    return (
        df.where(F.col("ride_date").isNotNull())
        .groupBy("season")
        .agg(
            F.min(md).alias("_first"),
            F.max(md).alias("_last"),
            row_count().alias("n_records"),
            F.count_if(F.col("season") != expected).alias("n_mismatches"),
        )
        .select(
            "season",
            text("_first").alias("first_month_day"),
            text("_last").alias("last_month_day"),
            "n_records",
            "n_mismatches",
        )
    )
