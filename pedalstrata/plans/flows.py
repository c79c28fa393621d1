"""End-to-end flows: extract, clean, silver, load, and all of them in a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.functions.aggregates import missing_cells, row_count
from pedalstrata.functions.casting import column
from pedalstrata.operators.cleaning import REPORT_COLUMNS, clean, drop_null_keys, split
from pedalstrata.operators.quality import require_rows, require_valid, verdict
from pedalstrata.operators.rollup import number_days, rollup_day_profiled
from pedalstrata.plans.gold import gold_tables
from pedalstrata.plans.silver import silver
from pedalstrata.schemas import MIN_COLUMNS, MIN_ROWS, RAW_DAY_COLUMNS
from pedalstrata.sources.readers import Told, scan_by_format, scan_optional_told
from pedalstrata.sources.staging import stage
from pedalstrata.sources.tables import TableLoad
from pedalstrata.sources.writers import layer_tables, load_layers, publish_raw, write_layers


@dataclass(frozen=True)
class RawLayer:
    """Both raw tables, one validation row for each, and what cleaning would do to the hours."""

    day: DataFrame
    hour: DataFrame
    report: DataFrame
    hour_cleaning: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"day": self.day, "hour": self.hour}


def build_raw(
    hours: DataFrame, strict: bool = False, min_rows: int = MIN_ROWS, min_cols: int = MIN_COLUMNS
) -> RawLayer:
    """Hourly table, daily table and their validation, from one roll-up of the hours."""
    grouped = stage(rollup_day_profiled(hours, strict))
    require_rows(grouped, "hour")  # without hours there is no group
    counts = [f"_{c}" for c in REPORT_COLUMNS]
    days = drop_null_keys(grouped, "dteday").drop("_rows", "_missing", *counts)
    zero = F.lit(0).cast("bigint")
    hour_profile = grouped.agg(
        F.coalesce(F.sum("_rows"), zero).alias("n_rows"), F.coalesce(F.sum("_missing"), zero).alias("n_nulls")
    )
    # The number that days get later is never missing, so they can be profiled without it.
    day_profile = days.agg(row_count().alias("n_rows"), missing_cells(days).alias("n_nulls"))
    return RawLayer(
        day=number_days(days),
        hour=hours,
        report=verdict(day_profile, "day", len(RAW_DAY_COLUMNS), min_rows, min_cols).unionByName(
            verdict(hour_profile, "hour", len(hours.columns), min_rows, min_cols)
        ),
        hour_cleaning=grouped.agg(*[F.coalesce(F.sum(c), zero).alias(c[1:]) for c in counts]),
    )


def extract(
    hours: DataFrame,
    base: str,
    fmt: str = "csv",
    publish_to: str | None = None,
    skip_publish: bool = False,
    strict: bool = False,
) -> dict[str, str]:
    """Build, validate both tables, only then write both, and publish if a target is set.

    Both copies of the days are written from one stored table, and both of the hours from the
    source, so nothing is read back from text.
    """
    raw = build_raw(hours, strict)
    require_valid(raw.report)
    tables = {"day": stage(raw.day), "hour": raw.hour}
    paths = write_layers(tables, base, fmt)
    publish_raw(tables, publish_to, fmt, skip_publish)
    return paths


@dataclass(frozen=True)
class Cleaned:
    """Where each cleaned table was written, per table the rows in, dropped and out, and the rows
    set aside, with their ``status`` and, from CSV, the ``line`` and ``fault`` of those that did not fit."""

    paths: dict[str, str]
    report: DataFrame
    rejected: dict[str, DataFrame]


def accounting(reports: Mapping[str, DataFrame]) -> DataFrame:
    """The cleaning report of every table, under its name."""
    named = [df.select(F.lit(name).alias("dataset"), "*") for name, df in reports.items()]
    return reduce(DataFrame.unionByName, named)


def clean_files(
    spark: SparkSession,
    base_in: str,
    base_out: str,
    fmt: str = "csv",
    schemas: dict[str, T.StructType] | None = None,
) -> Cleaned:
    """Clean whichever raw tables exist and write them in the same format, with the accounting.

    Every file is read once; rows, counts and rejected rows come from the stored copy of that read.
    """
    # What is split is stored there, with its status.
    found = scan_optional_told(spark, base_in, fmt=fmt, schemas=schemas, staged=False)
    parts = {n: split(t.df, line=t.line, fault=t.fault) if isinstance(t, Told) else split(t) for n, t in found.items()}
    paths = write_layers({n: p.rows for n, p in parts.items()}, base_out, fmt)
    return Cleaned(paths, accounting({n: p.report for n, p in parts.items()}), {n: p.rejected for n, p in parts.items()})


def load(
    spark: SparkSession,
    base: str,
    layer: str,
    database: str,
    schemas: dict[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Load processed files into ``silver``, ``gold`` or ``both``.

    Silver gets one table per grain; gold gets the daily table and the aggregates of the
    hourly one. A Parquet file wins over a CSV file of the same table. The rows are those of the
    files, under raw names and with repeated records; the tables are therefore called
    ``loaded_...`` and leave those of ``medallion`` alone.
    """
    files = scan_by_format(spark, base, schemas=schemas)
    tables = {name.split(".")[0]: df for name, df in files.items()}
    gold = {"day": tables["day"]} if "day" in tables else {}
    if layer != "silver" and "hour" in tables:
        gold |= gold_tables(silver(tables["hour"], "hour"))
    return load_layers(layer, {"silver": tables, "gold": gold}, database, prefix="loaded_")


def medallion(hours: DataFrame, database: str, partition_by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Raw hours to gold tables: validate, clean, silver, aggregate.

    Besides the tables, ``cleaning`` accounts for the rows that cleaning dropped. All tables are
    replaced together, or none.

    The hours are read by the roll-up, which takes their profile and the accounting along, and by
    silver. Gold reads the stored silver table, and only the columns it needs. Large silver tables
    can be partitioned, say by ``year_flag``, for later queries to prune.
    """
    raw = build_raw(hours)
    require_valid(raw.report)
    day = split(raw.day)
    with TableLoad(hours.sparkSession) as load:
        stored = {
            f"silver_{grain}": load.add(silver(df, grain), f"{database}.silver_{grain}", partition_by)
            for grain, df in (("day", day.rows), ("hour", clean(hours)))
        }
        gold = {"day": stored["silver_day"], **gold_tables(stored["silver_hour"])}
        for name, df in layer_tables("gold", {"gold": gold}):
            stored[name] = load.add(df, f"{database}.{name}")
        reports = {"day": day.report.drop("dropped_malformed"), "hour": raw.hour_cleaning}
        stored["cleaning"] = load.add(accounting(reports), f"{database}.cleaning")
        load.commit()
    return {name: hours.sparkSession.table(f"{database}.{name}").select(*[column(c) for c in df.columns]) for name, df in stored.items()}
