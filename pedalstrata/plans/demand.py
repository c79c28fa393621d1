"""The queries behind a demand dashboard, over silver hours.

Each is one hash aggregate whose group count is bounded by the dictionary's codes; ordering,
ranking and top-k run on the aggregated rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalstrata.functions.aggregates import row_count
from pedalstrata.functions.casting import round_half_even
from pedalstrata.functions.labels import meteorological_season
from pedalstrata.plans.gold import monthly

Choice = int | Iterable[int] | None


def demand_by(silver: DataFrame, *keys: str) -> DataFrame:
    """Records and mean rentals per key."""
    return silver.groupBy(*keys).agg(
        row_count().alias("n_records"),
        round_half_even(F.avg("total_rides")).alias("avg_rides"),
    )


def filter_demand(
    silver: DataFrame,
    season: Choice = None,
    weekday: Choice = None,
    hour: Choice = None,
    weather: Choice = None,
) -> DataFrame:
    """The dashboard's controls: each one, if set, keeps a value or any of several."""
    controls = {"season": season, "weekday": weekday, "ride_hour": hour, "weather_situation": weather}
    for column, choice in controls.items():
        if choice is not None:
            values = [choice] if isinstance(choice, int) else list(choice)
            silver = silver.where(F.col(column).isin(values))
    return silver


def relation_to_rides(silver: DataFrame, column: str) -> DataFrame:
    """Correlation and least-squares line of rentals over a weather column; null without variance.

    The correlation is spelled out because ``corr`` divides by zero, an error in ANSI mode,
    when a side does not vary.
    """
    x, y = F.col(column), F.col("total_rides")
    pairs = silver.where(x.isNotNull() & y.isNotNull())
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return pairs.agg(
        row_count().alias("n_pairs"),
        round_half_even(F.try_divide(F.covar_pop(x, y), spread)).alias("correlation"),
        round_half_even(F.regr_slope(y, x)).alias("slope"),
        round_half_even(F.regr_intercept(y, x)).alias("intercept"),
    )


def binned_rides(silver: DataFrame, column: str, per_unit: int = 10) -> DataFrame:
    """Mean rentals per bin of width ``1 / per_unit``: the trend without a point cloud."""
    bins = F.floor(F.col(column) * per_unit).cast("bigint").alias("bin")
    return demand_by(silver.where(F.col(column).isNotNull()).select(bins, "total_rides"), "bin")


def monthly_evolution(silver: DataFrame) -> DataFrame:
    return monthly(silver).orderBy("year_flag", "month")


def top_demand(silver: DataFrame, key: str, k: int, lowest: bool = False) -> DataFrame:
    """The ``k`` keys with the highest (or lowest) mean rentals; ties go to the smaller key."""
    by = F.asc_nulls_last("avg_rides") if lowest else F.desc_nulls_last("avg_rides")
    return demand_by(silver, key).orderBy(by, F.asc_nulls_last(key)).limit(k)


def season_ranking(silver: DataFrame) -> DataFrame:
    """Seasons by whole months, ranked by mean rentals."""
    named = silver.select(meteorological_season(F.col("month")).alias("season_name"), "total_rides")
    # At most five rows reach this window: four seasons and rows without a month.
    order = Window.orderBy(F.desc_nulls_last("avg_rides"), F.asc_nulls_last("season_name"))
    return demand_by(named, "season_name").withColumn("position", F.row_number().over(order).cast("bigint"))
