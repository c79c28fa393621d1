"""Hourly and daily demand tables derived from the ``lineitem`` table.

Stands in for a bike-rental feed: same columns and types, any number of rows. ``hour_dirty``
adds faults (bad keys, bad dates, NaN, nulls) for the operators to handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalstrata.operators.rollup import rollup_day
from pedalstrata.schemas import RAW_HOUR_COLUMNS

_CHRISTMAS = "(month(l_shipdate) = 12 and day(l_shipdate) = 25)"
_HOUR_RAW = (
    "cast(l_orderkey * 10 + l_linenumber as string) as instant",
    "cast(cast(l_shipdate as date) as string) as dteday",
    "cast(quarter(l_shipdate) as int) as season",
    "cast(year(l_shipdate) - 1995 as int) as yr",
    "cast(month(l_shipdate) as int) as mnth",
    "cast((l_orderkey * 7 + l_linenumber) % 24 as int) as hr",
    f"case when {_CHRISTMAS} then 1 else 0 end as holiday",
    "cast(dayofweek(l_shipdate) - 1 as int) as weekday",
    f"case when dayofweek(l_shipdate) - 1 between 1 and 5 and not {_CHRISTMAS} then 1 else 0 end as workingday",
    "cast(1 + l_partkey % 4 as int) as weathersit",
    "l_discount * 10 as temp",
    "l_tax * 10 as atemp",
    "l_quantity / 50 as hum",
    "cast(l_suppkey % 50 as double) / 50 as windspeed",
    "cast(l_quantity as bigint) as casual",
    "l_partkey % 100 as registered",
    "cast(l_quantity as bigint) + l_partkey % 100 as cnt",
)


# Naming the columns saves a look into the files' footers.
_LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_discount double, l_tax double, l_shipdate timestamp_ntz"
)
_FAULTS = {
    "instant": "case when endswith(instant, '7') then 'bad' else instant end",
    "dteday": "case when endswith(instant, '6') then 'not-a-date' else dteday end",
    "temp": "case when registered % 50 = 0 then double('NaN') when registered % 50 = 1 then null else temp end",
    "cnt": "case when endswith(instant, '5') then null else cnt end",
}


def hour_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_LINEITEM).parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*_HOUR_RAW)


def hour_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_raw(spark, sf_dir).selectExpr(*[f"{_FAULTS.get(c, c)} as {c}" for c in RAW_HOUR_COLUMNS])


# More faults, for the operators that look for them: bad tails, compact and impossible dates, no
# date, totals that are no sum, missing parts.
_MORE_FAULTS = {
    "dteday": """case when endswith(instant, '0') then concat(dteday, ' garbage')
      when endswith(instant, '1') then concat(dteday, 'Tfoo')
      when endswith(instant, '2') then concat(dteday, ' 10:20:30')
      when endswith(instant, '3') then replace(dteday, '-', '')
      when endswith(instant, '4') then null
      when endswith(instant, '5') then concat('99999', substring(dteday, 5))
      when endswith(instant, '6') then 'not-a-date' else dteday end""",
    "cnt": "case when l % 7 = 0 then cnt + 1 when l % 7 = 1 then null else cnt end",
    "casual": "case when l % 7 = 2 then null else casual end",
}


def hour_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hour_raw`` with faults in dates and totals; record numbers are whole."""
    hours = hour_raw(spark, sf_dir).withColumn("l", F.col("registered"))
    return hours.selectExpr(*[f"{_MORE_FAULTS.get(c, c)} as {c}" for c in RAW_HOUR_COLUMNS])


def day_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_day(hour_raw(spark, sf_dir))


def day_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_dirty(spark, sf_dir).drop("hr")


def with_tokens(df: DataFrame) -> DataFrame:
    """All columns as text, with a token for a missing value in some cells of some of them."""
    cells = {
        "dteday": "case when registered % 10 = 3 then 'None' else dteday end",
        "temp": "case when registered % 10 = 4 then 'NA' when registered % 10 = 5 then 'n/a' else string(temp) end",
        "weathersit": "case when registered % 10 = 6 then 'NULL' else string(weathersit) end",
        "casual": "case when registered % 10 = 7 then '' when registered % 10 = 8 then '#N/A' else string(casual) end",
    }
    return df.selectExpr(*[f"{cells.get(c, f'string({c})')} as {c}" for c in df.columns])


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hour_raw`` as lines of CSV, under a header line, some of which do not fit."""
    hours = hour_raw(spark, sf_dir)
    cells = {c: F.col(c).cast("string") for c in hours.columns}
    cells["hum"] = F.when(F.col("registered") % 20 == 9, "damp").otherwise(F.col("hum").cast("decimal(4,2)").cast("string"))
    cells["instant"] = F.when(F.col("registered") % 20 == 11, F.concat(F.lit('"'), "instant", F.lit('"'))).otherwise(F.col("instant"))
    for name in ("temp", "atemp", "windspeed"):
        cells[name] = F.col(name).cast("decimal(4,2)").cast("string")
    names = list(cells)
    whole = F.concat_ws(",", *cells.values())
    short = F.concat_ws(",", *[cells[c] for c in names[:-1]])
    line = F.when(F.col("registered") % 20 == 7, short).when(F.col("registered") % 20 == 8, F.concat(whole, F.lit(',"a,b"'))).otherwise(whole)
    return hours.select(line.alias(",".join(names)))
