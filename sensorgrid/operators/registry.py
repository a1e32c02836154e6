"""The station registry: nested network description to one row per station."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sensorgrid.fixed_values import STATION_NETWORK
from sensorgrid.schemas import DOUBLE, STATION, TEXT, row

ZONE_ATTRIBUTES = ("zone_name", "pm_factor", "variability", "rush_hour_boost", "night_reduction")

_STATION = row(id=TEXT, lat=DOUBLE, lon=DOUBLE, variation=DOUBLE)
_ZONE = row(
    zone_name=TEXT,
    pm_factor=DOUBLE,
    variability=DOUBLE,
    rush_hour_boost=DOUBLE,
    night_reduction=DOUBLE,
    stations=T.ArrayType(_STATION),
)
NETWORK = row(zones=T.MapType(TEXT, _ZONE))


def network_frame(spark: SparkSession, network: dict[str, Any] = STATION_NETWORK) -> DataFrame:
    """A nested network description as one row with a ``zones`` map."""
    return spark.createDataFrame([(network,)], NETWORK)


def registry_flatten(networks: DataFrame) -> DataFrame:
    """Station rows of nested networks; zone attributes repeat per station."""
    zones = networks.select(F.explode("zones").alias("zone_id", "zone"))
    stations = zones.select("zone_id", "zone", F.explode("zone.stations").alias("station"))
    return stations.select(
        F.col("station.id").alias("sensor_id"),
        "zone_id",
        F.col("zone.zone_name").alias("zone_name"),
        F.col("station.lat").alias("latitude"),
        F.col("station.lon").alias("longitude"),
        F.col("station.variation").alias("sensor_variation"),
        *[F.col(f"zone.{a}").alias(a) for a in ZONE_ATTRIBUTES[1:]],
    )


def registry_table(spark: SparkSession, network: dict[str, Any] = STATION_NETWORK) -> DataFrame:
    """The registry of a network description, as a table of station rows."""
    return spark.createDataFrame(station_rows(network), STATION)


def station_rows(network: dict[str, Any] = STATION_NETWORK) -> list[dict[str, Any]]:
    """Station rows of a network description that is part of the configuration."""
    return [
        {
            "sensor_id": sensor_id,
            "zone_id": zone_id,
            "latitude": latitude,
            "longitude": longitude,
            "sensor_variation": variation,
            **{a: zone[a] for a in ZONE_ATTRIBUTES},
        }
        for zone_id, zone in network.items()
        for sensor_id, latitude, longitude, variation in zone["stations"]
    ]


def registry_summary(registry: DataFrame) -> DataFrame:
    """Stations per zone, with the totals over the whole registry on each row."""
    per_zone = registry.groupBy("zone_id", "zone_name", "pm_factor").agg(
        F.count("*").alias("stations")
    )
    totals = {
        "total_stations": per_zone.agg(F.sum("stations")),
        "total_zones": per_zone.agg(F.count_distinct("zone_id")),
    }
    return per_zone.withColumns({name: total.scalar() for name, total in totals.items()})
