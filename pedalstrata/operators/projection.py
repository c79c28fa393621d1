"""Column projections of the silver layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from pedalstrata.functions.casting import column, safe_cast
from pedalstrata.schemas import FIELDS, Field


def cast_and_rename(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Safe-cast every listed column to its silver type under its silver name."""
    return df.select(
        *[safe_cast(column(f.raw), df.schema[f.raw].dataType, f.type).alias(f.silver) for f in fields]
    )


def project_silver(df: DataFrame, grain: str) -> DataFrame:
    return cast_and_rename(df, FIELDS[grain])


def rename_only(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under new names, values and types untouched."""
    return df.select(*[column(old).alias(new) for old, new in names.items()])


def with_leading(df: DataFrame, name: str, value: Column) -> DataFrame:
    """All columns with a new one in front."""
    return df.select(value.alias(name), "*")
