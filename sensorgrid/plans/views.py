"""The three read views over the two tables, for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sensorgrid.operators.latest import latest_sensor_readings, latest_zone_averages
from sensorgrid.operators.zones import daily_zone_stats
from sensorgrid.streaming.changelog import keep_last

WINDOW_KEY = ("window_start", "zone_id", "zone_name")


def current_zone_windows(zone_table: DataFrame, lazy: bool = False) -> DataFrame:
    """The zone table with one row per window, whether or not it is a changelog."""
    return keep_last(zone_table, WINDOW_KEY, lazy=lazy) if "batch_id" in zone_table.columns else zone_table


def register_views(reading_table: DataFrame, zone_table: DataFrame) -> None:
    """latest_sensor_readings, latest_zone_averages and daily_zone_stats, evaluated when they are read."""
    zones = current_zone_windows(zone_table, lazy=True)
    latest_sensor_readings(reading_table, lazy=True).createOrReplaceTempView("latest_sensor_readings")
    latest_zone_averages(zones, lazy=True).createOrReplaceTempView("latest_zone_averages")
    daily_zone_stats(zones).createOrReplaceTempView("daily_zone_stats")
