"""Layer files and tables. Every write is a full refresh."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.functions.casting import column
from pedalstrata.sources.layers import replace_all
from pedalstrata.sources.tables import TableLoad

LAYERS = {"silver": ("silver",), "gold": ("gold",), "both": ("silver", "gold")}


# Blanks stay, and a quote is doubled, so that every text without a line break comes back as it
# was; only an empty one comes back as null.
CSV_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _one_line(df: DataFrame) -> DataFrame:
    """Fails on text with a line break: files that may hold one cannot be split on reading."""
    fault = F.raise_error(F.lit("line break in a CSV text")).cast("string")
    return df.select(
        *[
            F.when(column(f.name).contains("\n") | column(f.name).contains("\r"), fault).otherwise(column(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else column(f.name)
            for f in df.schema
        ]
    )


def _writer(df: DataFrame, fmt: str) -> Callable[[str], None]:
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format: {fmt}")
    if fmt == "csv":
        return lambda path: _one_line(df).write.format(fmt).option("header", True).options(**CSV_TEXT).save(path)
    return lambda path: df.write.format(fmt).save(path)


def write_layers(tables: Mapping[str, DataFrame], base: str, fmt: str = "csv") -> dict[str, str]:
    """Write a new version of ``base/<name>.<fmt>`` for each table, as part files (CSV with a header).

    Returns the folders of the versions. They take effect together, once all are complete; a failure at
    any step leaves the old ones. Readers find the committed version by ``layers.current``, which
    those of this package do themselves.
    """
    if not tables:
        return {}
    layers = {name: f"{base}/{name}.{fmt}" for name in tables}
    writes = {layers[name]: _writer(df, fmt) for name, df in tables.items()}
    paths = replace_all(next(iter(tables.values())).sparkSession, writes)
    return {name: paths[layer] for name, layer in layers.items()}


def write_layer(df: DataFrame, base: str, name: str, fmt: str = "csv") -> str:
    return write_layers({name: df}, base, fmt)[name]


def publish_raw(
    tables: Mapping[str, DataFrame], target: str | None, fmt: str = "csv", skip: bool = False
) -> dict[str, str]:
    """Write each table under ``<target>/raw/``; nothing without a target or when skipped.

    ``target`` is any URI Spark can write to. Executors write their own part files.
    """
    if not target or skip:
        return {}
    return write_layers(tables, f"{target}/raw", fmt)


def load_truncate(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table, rows and schema, and return it; also serves create-or-replace from a query.

    A write or a definition that fails leaves the old table (see ``tables``), and a frame may read
    the table it replaces.
    """
    with TableLoad(df.sparkSession) as load:
        load.add(df, table, partition_by)
        load.commit()
    return df.sparkSession.table(table).select(*[column(c) for c in df.columns])


def load_layers(
    layer: str, layers: Mapping[str, Mapping[str, DataFrame]], database: str, prefix: str = ""
) -> dict[str, DataFrame]:
    """Load the tables of ``silver``, ``gold`` or ``both`` (silver first) as ``<prefix><layer>_<name>``.

    Hourly data never goes to gold. All tables are replaced together, or none.
    """
    tables = dict(layer_tables(layer, layers, prefix))
    if not tables:
        return {}
    with TableLoad(next(iter(tables.values())).sparkSession) as load:
        stored = {table: load.add(df, f"{database}.{table}") for table, df in tables.items()}
        load.commit()
    return {t: df.sparkSession.table(f"{database}.{t}").select(*[column(c) for c in df.columns]) for t, df in stored.items()}


def layer_tables(layer: str, layers: Mapping[str, Mapping[str, DataFrame]], prefix: str = "") -> Iterator[tuple[str, DataFrame]]:
    """Table names of a layer and their frames."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer: {layer}")
    for part in LAYERS[layer]:
        for name, df in layers.get(part, {}).items():
            if part != "gold" or name != "hour":
                yield f"{prefix}{part}_{name}", df
