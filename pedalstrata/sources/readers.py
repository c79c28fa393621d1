"""File scans and external tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.errors import DatasetError
from pedalstrata.functions.casting import (
    BOOLEAN,
    DOUBLE,
    INTEGER,
    TEXT,
    column,
    free_name,
    literal_kind,
    na_to_null,
    parse_date,
    quoted,
)
from pedalstrata.operators.quality import require_rows
from pedalstrata.schemas import NA_TOKENS
from pedalstrata.sources.layers import current
from pedalstrata.sources.staging import stage
from pedalstrata.sources.writers import CSV_TEXT

log = logging.getLogger(__name__)

TABLES = ("day", "hour")
FORMATS = ("csv", "parquet")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """CSV with a header and a given schema.

    The header must match the schema: by default Spark assigns by position and would put
    reordered columns under wrong names without an error. A cell that does not fit its type is
    null and a row of another length is cut or filled, unless ``strict``: then a row of another
    length fails every query, and a bad cell every query that reads its column. ``scan_csv_told``
    accounts for both.
    """
    reader = spark.read.options(**CSV_TEXT)
    if strict:
        reader = reader.option("mode", "FAILFAST").option("columnPruning", "false")
    return reader.csv(current(spark, path), schema=schema, header=True, enforceSchema=False)


#: What can be wrong with a line: too few cells, too many, or a cell that does not fit its type.
FAULTS = ("short", "long", "unfit")


@dataclass(frozen=True)
class Told:
    """A tolerant read. ``df`` has, besides the data, the column ``line`` with the text of a line that
    does not fit and ``fault`` with what is wrong with it, both null in good rows."""

    df: DataFrame
    line: str
    fault: str

    def rows(self) -> DataFrame:
        """Good rows, data columns only."""
        return self.df.where(column(self.fault).isNull()).drop(column(self.line), column(self.fault))

    def aside(self) -> DataFrame:
        """``line`` and ``fault`` of every other row."""
        bad = self.df.where(column(self.fault).isNotNull())
        return bad.select(column(self.line).alias("line"), column(self.fault).alias("fault"))

    def counts(self) -> DataFrame:
        """``fault`` and ``n_rows`` for every kind of fault, and for the good rows."""
        kinds = self.df.sparkSession.createDataFrame([("none",), *[(f,) for f in FAULTS]], "fault string")
        found = self.df.groupBy(F.coalesce(column(self.fault), F.lit("none")).alias("fault")).agg(F.count(F.lit(1)).alias("n"))
        return kinds.join(F.broadcast(found), "fault", "left").select("fault", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"))


def scan_csv_told(
    spark: SparkSession, path: str, schema: T.StructType | None = None, dates: bool = False, staged: bool = True
) -> Told:
    """CSV with a header, every line accounted for. The files are read once and kept as a staged copy.

    With a schema and not ``staged``, the caller keeps the copy, of all columns.

    Without a schema the types are inferred from the lines that have a cell for every column.
    """
    where, typed = current(spark, path), schema
    if typed is None:
        names = spark.read.options(**CSV_TEXT).csv(where, header=True).columns
        typed = T.StructType([T.StructField(n, T.StringType()) for n in names])
    line, fault = (free_name(typed.names, n) for n in ("line", "fault"))
    # Without pruning every cell is parsed, whatever is selected.
    reader = spark.read.options(**CSV_TEXT, columnPruning="false", columnNameOfCorruptRecord=line)
    read = reader.csv(where, schema=T.StructType([*typed, T.StructField(line, T.StringType())]), header=True, enforceSchema=False)
    # Separators outside quotes; a doubled quote is two quoted parts next to each other.
    cells = F.regexp_count(F.regexp_replace(column(line), '"[^"]*"', ""), F.lit(",")) + 1
    kind = F.when(cells < len(typed), FAULTS[0]).when(cells > len(typed), FAULTS[1]).otherwise(FAULTS[2])
    told = read.withColumn(fault, F.when(column(line).isNotNull(), kind))
    if staged or schema is None:
        told = stage(told)
    if schema is None:
        exprs = inferred(told.where(column(fault).isNull()).select(*[column(c) for c in typed.names]), dates)
        told = told.select(*[F.expr(e).alias(n) for n, e in exprs.items()], column(line), column(fault))
    return Told(told, line, fault)


def scan_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A raw CSV that must exist and hold rows, all of which must fit the schema."""
    try:
        return require_rows(scan_csv(spark, path, schema, strict=True), path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise DatasetError(f"no such dataset: {path}") from e


def cell_kinds(df: DataFrame, dates: bool) -> DataFrame:
    """Per cell of a text table the number of its column, its kind and, if asked for, whether it is a date.

    The cells of a row are tested one after another by the same few expressions: tests of all
    columns side by side make a method so long that the JVM does not compile it.
    """
    cells = df.select(F.posexplode(F.array(*[column(c) for c in df.columns])).alias("at", "cell"))
    kinds = cells.select("at", "cell", literal_kind("cell", NA_TOKENS).alias("kind"))
    # Of the numbers only eight digits are a date.
    maybe = (F.col("kind") == TEXT) | ((F.col("kind") == INTEGER) & (F.length("cell") >= 8))
    is_date = parse_date(F.col("cell"), T.StringType()).isNotNull() & (F.length(F.trim("cell")) <= 10)
    # A missing cell has no kind, and says nothing about dates.
    dated = F.when(F.col("kind").isNull(), None).when(maybe, is_date).otherwise(False) if dates else F.lit(False)
    return kinds.select("at", "kind", dated.alias("dated"))


def inferred(df: DataFrame, dates: bool) -> dict[str, str]:
    """Per text column a SQL expression that reads it as the narrowest of integer, double, boolean,
    date if asked for, or text that fits every value; missing-value tokens are null.

    Detection tests every cell, so the casts need no test of their own. A column is of dates if none
    of them has a time of day.
    """
    kinds = cell_kinds(df, dates).groupBy("at").agg(F.min("kind"), F.max("kind"), F.bool_and("dated"))
    found = {r[0]: r[1:] for r in kinds.collect()}  # one row per column
    out = {}
    for i, name in enumerate(df.columns):
        c, (low, high, all_dated) = na_to_null(name), found.get(i, (None, None, None))
        if high == INTEGER:
            out[name] = f"try_cast({c} AS bigint)"
        elif high == DOUBLE:
            out[name] = f"nullif(try_cast({c} AS double), double('NaN'))"
        elif low == high == BOOLEAN:
            out[name] = f"try_cast({c} AS boolean)"
        elif high is not None and all_dated:
            out[name] = f"coalesce(try_cast({c} AS date), try_to_date(trim({c}), 'yyyyMMdd'))"
        else:
            out[name] = c
    return out


def scan_csv_inferred(spark: SparkSession, path: str, dates: bool = False) -> DataFrame:
    """CSV without a schema: missing-value tokens become null first, then types are inferred.

    Spark's own inference knows a single null token, so one stray ``NA`` would turn a number
    column into text. Inference is one full aggregate pass; give ``scan_csv`` a schema where
    one is known. Dates stay text, for the cleaning step to parse, unless ``dates`` is set.
    """
    # Without inferSchema only the header line is read here.
    text = spark.read.options(**CSV_TEXT).csv(current(spark, path), header=True)
    return text.select(*[F.expr(e).alias(n) for n, e in inferred(text, dates).items()])


def _open(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | None, dates: bool = False
) -> DataFrame | None:
    try:
        if fmt == "parquet":
            return spark.read.parquet(current(spark, path))
        return scan_csv(spark, path, schema) if schema is not None else scan_csv_inferred(spark, path, dates)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


Opened = TypeVar("Opened")


def _present(base: str, names: Sequence[str], fmt: str, opened: Callable[[str], Opened | None]) -> dict[str, Opened]:
    """Those inputs that exist, with a warning for each that does not; an error if none does."""
    found = {n: opened(n) for n in names}
    present = {n: df for n, df in found.items() if df is not None}
    if not present:
        raise DatasetError(f"no {fmt} input among {list(names)} in {base}")
    for name in found.keys() - present.keys():
        log.warning("no %s/%s.%s; skipped", base, name, fmt)
    return present


def scan_optional(
    spark: SparkSession,
    base: str,
    names: Sequence[str] = TABLES,
    fmt: str = "csv",
    schemas: dict[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Those of ``base/<name>.<fmt>`` that exist; an error if none does."""
    schemas = schemas or {}
    return _present(base, names, fmt, lambda n: _open(spark, f"{base}/{n}.{fmt}", fmt, schemas.get(n)))


def scan_optional_told(
    spark: SparkSession,
    base: str,
    names: Sequence[str] = TABLES,
    fmt: str = "csv",
    schemas: dict[str, T.StructType] | None = None,
    staged: bool = True,
) -> dict[str, DataFrame | Told]:
    """The same with CSV lines accounted for (see ``scan_csv_told``); Parquet has none that do not fit."""
    if fmt == "parquet":
        return scan_optional(spark, base, names, fmt)
    schemas = schemas or {}

    def opened(name: str) -> Told | None:
        try:
            return scan_csv_told(spark, f"{base}/{name}.{fmt}", schemas.get(name), staged=staged)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    return _present(base, names, fmt, opened)


def scan_by_format(
    spark: SparkSession,
    base: str,
    names: Sequence[str] = TABLES,
    schemas: dict[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Every ``<name>.csv`` and ``<name>.parquet`` that exists, keyed by file name; an error if none.

    Types of a CSV without a schema, dates included, are detected.
    """
    schemas = schemas or {}
    out = {}
    for fmt in FORMATS:
        for name in names:
            df = _open(spark, f"{base}/{name}.{fmt}", fmt, schemas.get(name), dates=True)
            if df is not None:
                out[f"{name}.{fmt}"] = df
    if not out:
        raise DatasetError(f"no processed files in {base}")
    return out


def external_csv_table(
    spark: SparkSession, table: str, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """(Re)create a catalog table over CSV files with a header line.

    Only definitions are stored; rows stay in the files and are read when queried. With a
    ``schema`` it is a table. Without one, ``<table>_text`` is a table of text columns, and ``table`` a view
    on it that casts each to the type that ``scan_csv_inferred`` would find, dates included:
    missing-value tokens are null, and whole numbers 64-bit, so the type does not change with the
    largest value seen. Detection reads every file once. A layer with versions is bound to the
    committed one; create the table again after a refresh.
    """
    where = current(spark, path)
    _drop_definition(spark, table)
    options = {"header": "true", "enforceSchema": "false", **CSV_TEXT}
    if schema is not None:
        spark.catalog.createTable(table, path=where, source="csv", schema=schema, **options)
        return spark.table(table)
    names = spark.read.options(**CSV_TEXT).csv(where, header=True).columns
    text = f"{table}_text"
    _drop_definition(spark, text)
    strings = T.StructType([T.StructField(n, T.StringType()) for n in names])
    spark.catalog.createTable(text, path=where, source="csv", schema=strings, **options)
    casts = [f"{e} AS {quoted(n)}" for n, e in inferred(spark.table(text), dates=True).items()]
    spark.sql(f"CREATE VIEW {table} AS SELECT {', '.join(casts)} FROM {text}")
    return spark.table(table)


def _drop_definition(spark: SparkSession, table: str) -> None:
    if spark.catalog.tableExists(table):
        kind = "VIEW" if spark.catalog.getTable(table).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {table}")
