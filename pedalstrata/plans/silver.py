"""Silver layer: safe cast, rename, keep the latest row per ride."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pedalstrata.operators.dedup import latest_per_key
from pedalstrata.operators.projection import project_silver

KEY = "ride_id"
ORDER = ("ride_date",)


def dedup_rides(projected: DataFrame, null_keys: str = "collapse", method: str = "aggregate") -> DataFrame:
    return latest_per_key(projected, KEY, ORDER, null_keys, method)


def silver(bronze: DataFrame, grain: str, null_keys: str = "collapse", method: str = "aggregate") -> DataFrame:
    """One narrow projection and one shuffle on the ride key."""
    return dedup_rides(project_silver(bronze, grain), null_keys, method)
