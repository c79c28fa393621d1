"""The registered queries. Each reads whole tables; sinks write to fresh shared folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.functions import aggregates as agg
from pedalstrata.functions import casting, labels, udaf
from pedalstrata.operators import cleaning, dedup, numbering, ordering, projection, quality, rollup
from pedalstrata.plans import demand, flows, gold
from pedalstrata.plans.lineitem_feed import (
    damaged_lines,
    day_dirty,
    day_raw,
    hour_dirty,
    hour_faulty,
    hour_raw,
    with_tokens,
)
from pedalstrata.plans.silver import KEY, ORDER, silver
from pedalstrata.schemas import bronze_schema, raw_schema
from pedalstrata.sources import layers, readers, writers
from pedalstrata.sources.staging import own_database, shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The feed's years run past the dictionary's two.
FEED_RULES = (
    ("season_1_4", "season", 1, 4),
    ("year_flag_0_6", "year_flag", 0, 6),
    ("month_1_12", "month", 1, 12),
    ("hour_0_11", "ride_hour", 0, 11),
    ("holiday_0_1", "holiday", 0, 1),
    ("weekday_0_6", "weekday", 0, 6),
    ("workingday_0_1", "workingday", 0, 1),
    ("weather_1_3", "weather_situation", 1, 3),
)


# Blanks at both ends or alone, quotes, a separator, backslashes.
AWKWARD_NOTE = r"""case registered % 4 when 0 then concat('  "', instant, '", x ')
  when 1 then concat('a\\\\b\\\\"', instant, '\\\\') when 2 then ' ' end"""


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _database(spark: SparkSession) -> str:
    """A fresh database whose tables live in the shared folder."""
    name = own_database(f"pedalstrata_{uuid.uuid4().hex}")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}'")
    return name


def _silver_hour(spark: SparkSession, sf: str) -> DataFrame:
    return silver(hour_dirty(spark, sf), "hour")


def _projected_hour(spark: SparkSession, sf: str) -> DataFrame:
    return projection.project_silver(hour_dirty(spark, sf), "hour")


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


# --- sources -------------------------------------------------------------------------------


@query
def scan_hour_raw(spark, sf):
    path = writers.write_layer(hour_raw(spark, sf), shared_dir(spark), "hour")
    return readers.scan_raw(spark, path, raw_schema("hour"))


@query
def bronze_external_hour(spark, sf):
    path = writers.write_layer(hour_raw(spark, sf), shared_dir(spark), "hour")
    return readers.external_csv_table(spark, f"{_database(spark)}.bronze_hour", path)


@query
def bronze_external_day(spark, sf):
    path = writers.write_layer(day_raw(spark, sf), shared_dir(spark), "day")
    return readers.external_csv_table(spark, f"{_database(spark)}.bronze_day", path)


def _bronze_external_tokens(grain: str, spark: SparkSession, sf: str) -> DataFrame:
    """Missing values as several tokens, in number, date and text columns."""
    path = writers.write_layer(with_tokens({"day": day_raw, "hour": hour_raw}[grain](spark, sf)), shared_dir(spark), grain)
    return readers.external_csv_table(spark, f"{_database(spark)}.bronze_{grain}", path)


QUERIES["bronze_external_day_tokens"] = partial(_bronze_external_tokens, "day")
QUERIES["bronze_external_hour_tokens"] = partial(_bronze_external_tokens, "hour")


def _damaged(spark: SparkSession, sf: str) -> str:
    """A CSV folder with lines that lack a cell, have one more or one that is no number."""
    path, lines = shared_dir(spark), damaged_lines(spark, sf)
    lines.write.options(header="true", sep="\u0001", quote="").csv(path)
    return path


@query
def scan_fault_counts(spark, sf):
    return readers.scan_csv_told(spark, _damaged(spark, sf), raw_schema("hour")).counts()


@query
def scan_set_aside(spark, sf):
    return readers.scan_csv_told(spark, _damaged(spark, sf), raw_schema("hour")).aside()


@query
def scan_told_inferred(spark, sf):
    """Types from the lines that are whole; a cell that is no number makes its column text."""
    return readers.scan_csv_told(spark, _damaged(spark, sf)).rows()


@query
def scan_csv_inferred(spark, sf):
    path = writers.write_layer(hour_dirty(spark, sf), shared_dir(spark), "hour")
    return readers.scan_csv_inferred(spark, path)


@query
def scan_optional_inputs(spark, sf):
    base = shared_dir(spark)
    writers.write_layer(hour_raw(spark, sf), base, "hour")
    found = readers.scan_optional(spark, base, schemas={"hour": raw_schema("hour")})
    return found["hour"]


@query
def scan_by_format(spark, sf):
    base = shared_dir(spark)
    writers.write_layer(day_raw(spark, sf), base, "day", "csv")
    writers.write_layer(hour_raw(spark, sf), base, "hour", "parquet")
    found = readers.scan_by_format(spark, base, schemas={"day": raw_schema("day")})
    return _contents(found)


# --- sinks ---------------------------------------------------------------------------------


@query
def sink_raw_csv(spark, sf):
    source = hour_raw(spark, sf).withColumn("note", F.expr(AWKWARD_NOTE))
    path = writers.write_layer(source, shared_dir(spark), "hour", "csv")
    return readers.scan_csv(spark, path, source.schema)


@query
def sink_raw_parquet(spark, sf):
    return spark.read.parquet(writers.write_layer(hour_raw(spark, sf), shared_dir(spark), "hour", "parquet"))


@query
def sink_processed_csv(spark, sf):
    cleaned = cleaning.clean(hour_dirty(spark, sf)).withColumn("note", F.expr(AWKWARD_NOTE))
    path = writers.write_layer(cleaned, shared_dir(spark), "hour", "csv")
    return readers.scan_csv(spark, path, cleaned.schema).withColumn("temp", casting.nan_to_null(F.col("temp")))


@query
def sink_processed_parquet(spark, sf):
    cleaned = cleaning.clean(hour_dirty(spark, sf))
    path = writers.write_layer(cleaned, shared_dir(spark), "hour", "parquet")
    return spark.read.parquet(path).withColumn("temp", casting.nan_to_null(F.col("temp")))


@query
def publish_raw(spark, sf):
    paths = writers.publish_raw({"hour": hour_raw(spark, sf)}, shared_dir(spark), "parquet")
    return spark.read.parquet(paths["hour"])


@query
def load_truncate(spark, sf):
    table = f"{_database(spark)}.demand"
    writers.load_truncate(hour_raw(spark, sf).select("instant", "cnt"), table)
    return writers.load_truncate(hour_raw(spark, sf), table, partition_by=["yr"])


def _cell(df: DataFrame, name: str) -> Column:
    """A cell as text that SQL engines agree on: six digits of a double, ``-`` for a missing value."""
    c, dtype = casting.column(name), _dtype(df, name)
    if casting.is_floating(dtype):
        c = F.round(casting.nan_to_null(c) * 1e6).cast("bigint")
    return F.coalesce(c.cast("string"), F.lit("-"))


def _checksum(df: DataFrame) -> Column:
    """Sum over all rows of a number from the MD5 of all cells, columns in order of their names."""
    row = F.concat_ws("|", *[_cell(df, c) for c in sorted(df.columns)])
    return F.sum(F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint"))


def _contents(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table its rows, columns, and a checksum over all cells."""
    rows = [
        df.agg(
            F.lit(name).alias("table_name"),
            agg.row_count().alias("n_rows"),
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
            _checksum(df).alias("checksum"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _load_route(layer: str, spark: SparkSession, sf: str) -> DataFrame:
    database = _database(spark)
    silver_tables = {"day": silver(day_dirty(spark, sf), "day"), "hour": silver(hour_dirty(spark, sf), "hour")}
    loaded = {}
    if layer != "gold":
        loaded = writers.load_layers("silver", {"silver": silver_tables}, database)
        # Gold reads what was loaded, so each silver table is computed once.
        silver_tables = {name.removeprefix("silver_"): df for name, df in loaded.items()}
    if layer != "silver":
        gold_tables = silver_tables | {"monthly": gold.monthly(silver_tables["hour"])}
        loaded |= writers.load_layers("gold", {"gold": gold_tables}, database)
    return _contents(loaded)


QUERIES["load_route_silver"] = partial(_load_route, "silver")
QUERIES["load_route_gold"] = partial(_load_route, "gold")
QUERIES["load_route_both"] = partial(_load_route, "both")


@query
def silver_ctas_day(spark, sf):
    return writers.load_truncate(silver(day_dirty(spark, sf), "day"), f"{_database(spark)}.silver_day")


@query
def silver_ctas_hour(spark, sf):
    return writers.load_truncate(silver(hour_dirty(spark, sf), "hour"), f"{_database(spark)}.silver_hour")


# --- projections ---------------------------------------------------------------------------


@query
def project_silver_day(spark, sf):
    return projection.project_silver(day_dirty(spark, sf), "day")


@query
def project_silver_hour(spark, sf):
    return projection.project_silver(hour_dirty(spark, sf), "hour")


@query
def project_passthrough(spark, sf):
    return projection.rename_only(hour_dirty(spark, sf), {"dteday": "ride_date"})


@query
def project_star_plus(spark, sf):
    projected = projection.project_silver(hour_dirty(spark, sf), "hour")
    return dedup.rank_all(projected, KEY, ORDER).withColumn("rn", F.col("rn").cast("bigint"))


@query
def project_star_except(spark, sf):
    projected = projection.project_silver(hour_dirty(spark, sf), "hour")
    return dedup.rank_latest(projected, KEY, ORDER).where("rn = 1").drop("rn")


@query
def project_leading_column(spark, sf):
    return projection.with_leading(hour_raw(spark, sf), "row_key", F.col("instant").try_cast("bigint"))


@query
def project_day_columns(spark, sf):
    return day_raw(spark, sf)


@query
def cte_chain(spark, sf):
    """Named steps, each a frame that the next one reads: Catalyst plans them as one query."""
    hours = hour_dirty(spark, sf)
    typed = hours.select(
        casting.safe_int(F.col("instant"), _dtype(hours, "instant")).alias("ride_id"),
        casting.parse_date(F.col("dteday"), _dtype(hours, "dteday")).alias("ride_date"),
        F.col("hr").cast("bigint").alias("ride_hour"),
        F.col("cnt").alias("total_rides"),
    )
    newest = dedup.rank_latest(typed, KEY, ORDER, "place").where("place = 1")
    return newest.drop("place")


# --- filters -------------------------------------------------------------------------------


@query
def filter_required_not_null(spark, sf):
    return _nan_free(cleaning.drop_missing(hour_faulty(spark, sf)))


@query
def filter_bad_dates(spark, sf):
    return _nan_free(cleaning.drop_bad_dates(hour_faulty(spark, sf)))


def _nan_free(df: DataFrame) -> DataFrame:
    return df.withColumn("temp", casting.nan_to_null(F.col("temp")))


@query
def filter_rank_one(spark, sf):
    projected = projection.project_silver(hour_dirty(spark, sf), "hour")
    ranked = dedup.rank_latest(projected, KEY, ORDER).where("rn = 1")
    return ranked.select("ride_id", "ride_date", "ride_hour", "total_rides")


@query
def check_required_columns(spark, sf):
    return quality.required_columns_report(hour_dirty(spark, sf), ("dteday", "cnt", "station"))


@query
def filter_null_group_key(spark, sf):
    # Bad dates become null keys, which form no group.
    hours = hour_dirty(spark, sf)
    keyed = hours.withColumn("dteday", casting.parse_date(F.col("dteday"), _dtype(hours, "dteday")))
    return cleaning.drop_null_keys(keyed, "dteday").groupBy("dteday").agg(agg.row_count().alias("n_rows"))


# --- aggregations --------------------------------------------------------------------------


@query
def rollup_day(spark, sf):
    return rollup.rollup_day(hour_raw(spark, sf))


def _per_day(df: DataFrame, *columns) -> DataFrame:
    return cleaning.drop_null_keys(df, "dteday").groupBy("dteday").agg(*columns)


@query
def agg_first_non_null(spark, sf):
    # Record numbers repeat and may be missing; the rows with a bad date are one large group.
    hours = cleaning.drop_null_keys(hour_dirty(spark, sf), "dteday")
    names = ("season", "yr", "mnth", "holiday", "weekday", "workingday", "hr", "temp", "cnt")
    return rollup.first_values(hours, "dteday", names, "instant")


@query
def agg_half_up_mean(spark, sf):
    hours = hour_raw(spark, sf)
    return _per_day(hours, agg.half_up_mean(F.col("weathersit"), _dtype(hours, "weathersit")).alias("weathersit"))


@query
def agg_mean_round6(spark, sf):
    hours = hour_dirty(spark, sf)
    names = ("temp", "atemp", "hum", "windspeed")
    return _per_day(hours, *[agg.mean_rounded(F.col(n), _dtype(hours, n)).alias(n) for n in names])


@query
def agg_sum_zero(spark, sf):
    hours = hour_dirty(spark, sf)
    names = ("casual", "registered", "cnt")
    return _per_day(hours, *[agg.sum_or_zero(F.col(n), _dtype(hours, n)).alias(n) for n in names])


@query
def agg_shape(spark, sf):
    return quality.shape(hour_dirty(spark, sf))


@query
def agg_null_cells(spark, sf):
    return quality.count_missing(hour_dirty(spark, sf))


@query
def udaf_half_up_mean(spark, sf):
    return udaf.aggregate_with(hour_raw(spark, sf), "dteday", "weathersit", udaf.HALF_UP_MEAN)


@query
def udaf_exact_median(spark, sf):
    # Days whose text is no date are one large group.
    hours = hour_dirty(spark, sf).where("cnt is not null")
    return udaf.aggregate_slices(hours, "dteday", ["cnt"], udaf.exact_median, T.DoubleType(), "cnt", ["cnt"])


# --- windows, order, top-k -----------------------------------------------------------------


@query
def dedup_latest_day(spark, sf):
    return silver(day_dirty(spark, sf), "day", method="window")


@query
def dedup_latest_hour(spark, sf):
    return silver(hour_dirty(spark, sf), "hour", method="window")


@query
def sequence_id(spark, sf):
    hours = hour_raw(spark, sf)
    dated = hours.select(casting.parse_date(F.col("dteday"), _dtype(hours, "dteday")).alias("ride_date"), "cnt")
    days = dated.groupBy("ride_date").agg(F.sum("cnt").alias("total_rides"))
    return numbering.sequence_id(days, ["ride_date"])


@query
def sequence_id_distributed(spark, sf):
    hours = hour_raw(spark, sf).select("dteday", "instant", "hr", "cnt")
    return numbering.sequence_id_distributed(hours, ["dteday", "instant"], "position")


@query
def sort_by_date(spark, sf):
    return day_raw(spark, sf).orderBy("dteday")


@query
def sort_desc_nulls_last(spark, sf):
    projected = projection.project_silver(hour_dirty(spark, sf), "hour")
    rides = projected.select("ride_id", "ride_date", "ride_hour", "total_rides")
    return ordering.newest_first(rides, ["ride_date", "ride_id"])


@query
def top1_per_key(spark, sf):
    projected = projection.project_silver(hour_dirty(spark, sf), "hour")
    return dedup.latest_per_key(projected, KEY, ORDER, method="aggregate")


@query
def preview_head(spark, sf):
    return day_raw(spark, sf).orderBy("instant").limit(3)


# --- scalar functions ----------------------------------------------------------------------


@query
def safe_cast_int(spark, sf):
    hours = hour_dirty(spark, sf)
    return hours.select(
        "instant",
        casting.safe_int(F.col("instant"), _dtype(hours, "instant")).alias("ride_id"),
        casting.safe_int(F.col("hum") * 50 + 0.25, _dtype(hours, "hum")).alias("quantity"),
    )


@query
def safe_cast_double(spark, sf):
    hours = hour_dirty(spark, sf)
    return hours.select(
        "instant",
        casting.safe_double(F.col("instant"), _dtype(hours, "instant")).alias("id_value"),
        casting.safe_double(F.col("temp"), _dtype(hours, "temp")).alias("temperature"),
    )


@query
def parse_date_lenient(spark, sf):
    hours = hour_faulty(spark, sf)
    number = (F.col("yr") + 1995) * 10_000 + F.col("mnth") * 100 + F.col("hr")  # no date where hr is 0
    return hours.select(
        "instant",
        "dteday",
        casting.parse_date(F.col("dteday"), _dtype(hours, "dteday")).alias("ride_date"),
        casting.parse_date(number, T.IntegerType()).alias("number_date"),
    )


@query
def int_truncate(spark, sf):
    shifted = F.col("hum") * 10 - 4.75
    return hour_raw(spark, sf).select("instant", "hum", casting.int_truncate(shifted).alias("truncated"))


@query
def round_half_even(spark, sf):
    # Halves of whole numbers are exact in binary, so every second row is a true tie.
    return hour_raw(spark, sf).select("instant", casting.round_half_even(F.col("cnt") / 2, 0).alias("rounded"))


@query
def is_missing(spark, sf):
    hours = hour_dirty(spark, sf)
    return hours.select(
        "instant",
        casting.is_missing(F.col("temp"), _dtype(hours, "temp")).alias("temp_missing"),
        casting.is_missing(F.col("cnt"), _dtype(hours, "cnt")).alias("cnt_missing"),
    )


# --- data quality --------------------------------------------------------------------------


@query
def validate_dataset(spark, sf):
    return quality.validate_dataset(hour_dirty(spark, sf), "hour")


@query
def cleaning_report(spark, sf):
    return cleaning.cleaning_report(hour_faulty(spark, sf))


@query
def schema_report(spark, sf):
    return quality.schema_report(hour_dirty(spark, sf))


@query
def check_total_invariant(spark, sf):
    return quality.total_report(silver(hour_faulty(spark, sf), "hour"))


@query
def season_calendar_check(spark, sf):
    return quality.season_calendar_check(_silver_hour(spark, sf))


@query
def check_domains(spark, sf):
    # Narrower hour and weather ranges than the dictionary's, so that violations exist.
    return quality.check_domains(_silver_hour(spark, sf), FEED_RULES)


# --- gold ----------------------------------------------------------------------------------


@query
def gold_monthly(spark, sf):
    return gold.monthly(_silver_hour(spark, sf))


@query
def gold_yearly(spark, sf):
    return gold.yearly(_silver_hour(spark, sf))


@query
def gold_rental_metrics(spark, sf):
    return gold.rental_metrics(_silver_hour(spark, sf))


@query
def gold_weather_metrics(spark, sf):
    return gold.weather_metrics(_silver_hour(spark, sf))


# --- demand --------------------------------------------------------------------------------


@query
def demand_by_season(spark, sf):
    return demand.demand_by(_silver_hour(spark, sf), "season")


@query
def demand_by_hour(spark, sf):
    return demand.demand_by(_silver_hour(spark, sf), "ride_hour")


@query
def demand_by_weekday(spark, sf):
    return demand.demand_by(_silver_hour(spark, sf), "weekday")


@query
def temp_vs_rides(spark, sf):
    return demand.relation_to_rides(_silver_hour(spark, sf), "temperature")


@query
def temp_bins(spark, sf):
    return demand.binned_rides(_silver_hour(spark, sf), "temperature")


@query
def humidity_vs_rides(spark, sf):
    return demand.relation_to_rides(_silver_hour(spark, sf), "humidity")


@query
def humidity_bins(spark, sf):
    return demand.binned_rides(_silver_hour(spark, sf), "humidity")


@query
def demand_by_weather_season(spark, sf):
    return demand.demand_by(_silver_hour(spark, sf), "weather_situation", "season")


@query
def monthly_evolution(spark, sf):
    return demand.monthly_evolution(_silver_hour(spark, sf))


@query
def demand_filtered(spark, sf):
    chosen = demand.filter_demand(_silver_hour(spark, sf), season=[2, 3], weekday=range(1, 6), weather=1)
    return demand.demand_by(chosen, "ride_hour")


@query
def peak_hours(spark, sf):
    return demand.top_demand(_silver_hour(spark, sf), "ride_hour", 2)


@query
def workingday_vs_weekend(spark, sf):
    return demand.demand_by(_silver_hour(spark, sf), "workingday")


@query
def peak_weekday(spark, sf):
    return demand.top_demand(_silver_hour(spark, sf), "weekday", 1)


@query
def peak_month(spark, sf):
    return demand.top_demand(_silver_hour(spark, sf), "month", 1)


@query
def trough_month(spark, sf):
    return demand.top_demand(_silver_hour(spark, sf), "month", 1, lowest=True)


@query
def season_ranking(spark, sf):
    return demand.season_ranking(_silver_hour(spark, sf))


# --- data dictionary -----------------------------------------------------------------------


@query
def denormalize_temp(spark, sf):
    rides = _projected_hour(spark, sf)
    return rides.select("ride_id", casting.round_half_even(labels.celsius(F.col("temperature"))).alias("celsius"))


@query
def label_season(spark, sf):
    rides = _projected_hour(spark, sf)
    return rides.select("ride_id", "season", labels.season_label(F.col("season")).alias("season_name"))


@query
def label_year(spark, sf):
    rides = _projected_hour(spark, sf)
    return rides.select("ride_id", "year_flag", labels.calendar_year(F.col("year_flag"), 1995).alias("year"))


@query
def label_weather(spark, sf):
    rides = _projected_hour(spark, sf)
    code = F.col("weather_situation")
    return rides.select("ride_id", code, labels.weather_label(code).alias("weather_name"))


# --- flows ---------------------------------------------------------------------------------


@query
def flow_extract_day(spark, sf):
    """Both written tables and both published ones."""
    base, target = shared_dir(spark), shared_dir(spark)
    paths = flows.extract(hour_raw(spark, sf), base, "parquet", publish_to=target)
    written = {name: spark.read.parquet(path) for name, path in paths.items()}
    published = {f"published_{n}": spark.read.parquet(layers.current(spark, f"{target}/raw/{n}.parquet")) for n in written}
    return _contents(written | published)


def _flow_clean(grain: str, spark: SparkSession, sf: str) -> DataFrame:
    source = {"day": day_dirty, "hour": hour_dirty}[grain](spark, sf)
    raw, processed = shared_dir(spark), shared_dir(spark)
    writers.write_layer(source, raw, grain)
    cleaned = flows.clean_files(spark, raw, processed, schemas={grain: bronze_schema(grain)})
    written = readers.scan_csv(spark, cleaned.paths[grain], raw_schema(grain))
    return written.withColumn("temp", casting.nan_to_null(F.col("temp")))


QUERIES["flow_clean_day"] = partial(_flow_clean, "day")
QUERIES["flow_clean_hour"] = partial(_flow_clean, "hour")


def _flow_silver(grain: str, spark: SparkSession, sf: str) -> DataFrame:
    source = {"day": day_dirty, "hour": hour_dirty}[grain](spark, sf)
    path = writers.write_layer(source, shared_dir(spark), grain)
    database = _database(spark)
    # Silver casts safely from text, so the types need no detection.
    bronze = readers.external_csv_table(spark, f"{database}.bronze_{grain}", path, bronze_schema(grain))
    return writers.load_truncate(silver(bronze, grain), f"{database}.silver_{grain}")


QUERIES["flow_silver_day"] = partial(_flow_silver, "day")
QUERIES["flow_silver_hour"] = partial(_flow_silver, "hour")


@query
def flow_load(spark, sf):
    """Every table that the load writes, from files of both grains."""
    tables = {"day": cleaning.clean(day_dirty(spark, sf)), "hour": cleaning.clean(hour_dirty(spark, sf))}
    base = shared_dir(spark)
    writers.write_layers(tables, base, "parquet")
    return _contents(flows.load(spark, base, "both", _database(spark)))


@query
def flow_clean_accounting(spark, sf):
    """What cleaning a damaged CSV file did to its lines."""
    base = shared_dir(spark)
    damaged_lines(spark, sf).write.options(header="true", sep="\u0001", quote="").csv(f"{base}/hour.csv")
    return flows.clean_files(spark, base, shared_dir(spark), schemas={"hour": raw_schema("hour")}).report


@query
def flow_medallion(spark, sf):
    """Every table that the flow writes, the accounting among them."""
    return _contents(flows.medallion(hour_dirty(spark, sf), _database(spark)))
