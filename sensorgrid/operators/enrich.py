"""From raw records to scored readings of every station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.functions import aqi as A
from sensorgrid.functions.calendar import night, rush_hour, time_enrichment
from sensorgrid.functions.numeric import half_up, keyed_jitter, truncated_int
from sensorgrid.operators.fanout import Registry, station_fanout
from sensorgrid.schemas import READING

# Reading column <- raw value.
PM_COLUMNS = {"pm1_0_atm": "pm1_raw", "pm2_5_atm": "pm25_raw", "pm10_atm": "pm10_raw"}
PARTICLE_COLUMNS = {
    "particles_03": "gr03um",
    "particles_05": "gr05um",
    "particles_10": "gr10um",
    "particles_25": "gr25um",
    "particles_50": "gr50um",
    "particles_100": "gr100um",
}


def time_flags(df: DataFrame) -> DataFrame:
    """Adds is_rush_hour and is_night from ``hour``; both false without a time."""
    hour = F.col("hour")
    return df.withColumns({"is_rush_hour": rush_hour(hour), "is_night": night(hour)})


def _noise(label: str, seed: int | None) -> Column:
    if seed is None:
        return F.lit(1.0)
    keys = [F.col("sensor_id"), F.col("datetime"), F.lit(label)]
    return keyed_jitter(keys, F.col("variability"), seed)


def _daytime_factor() -> Column:
    boost = F.when(F.col("is_rush_hour"), F.col("rush_hour_boost")).otherwise(F.lit(1.0))
    return F.col("pm_factor") * F.col("sensor_variation") * boost


def station_factor(df: DataFrame, seed: int | None = None) -> DataFrame:
    """Adds ``total_factor``, what a station's PM values are multiplied by."""
    dimmed = F.when(F.col("is_night"), F.col("night_reduction")).otherwise(F.lit(1.0))
    return df.withColumn("total_factor", _daytime_factor() * dimmed * _noise("pm", seed))


def scale_pm(df: DataFrame) -> DataFrame:
    """Adds the three PM columns, one decimal."""
    scaled = df.withColumns(
        {out: F.col(raw) * F.col("total_factor") for out, raw in PM_COLUMNS.items()}
    )
    return scaled.withColumns({out: half_up(F.col(out), 1) for out in PM_COLUMNS})


def scale_particles(df: DataFrame, seed: int | None = None) -> DataFrame:
    """Adds the six particle bins; counts are cut off, not rounded, and know no night."""
    return df.withColumns(
        {
            out: truncated_int(F.col(raw) * _daytime_factor() * _noise(raw, seed))
            for out, raw in PARTICLE_COLUMNS.items()
        }
    )


def score(df: DataFrame, null_aqi: bool = False) -> DataFrame:
    """Adds the index of pm2_5_atm, its three labels, the percentage and sport_ok."""
    aqi = F.col("aqi")
    return df.withColumn("aqi", A.aqi_from_pm25(F.col("pm2_5_atm"), null_aqi)).withColumns(
        {
            "aqi_category": A.aqi_category(aqi),
            "aqi_color": A.aqi_color(aqi),
            "aqi_recommendation": A.aqi_recommendation(aqi),
            "air_quality_percent": A.air_quality_percent(aqi),
            "sport_ok": A.sport_ok(aqi),
        }
    )


def select_reading(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*READING.fieldNames(), *extra)


def enrich(
    raw: DataFrame,
    registry: Registry,
    jitter_seed: int | None = None,
    null_aqi: bool = False,
) -> DataFrame:
    """Readings (29 columns) of every station for every raw record.

    ``jitter_seed`` turns on replayable noise within each zone's variability.
    What depends on time alone is computed before the fan-out, once per record.
    """
    stations = station_fanout(time_flags(time_enrichment(raw)), registry)
    scaled = scale_particles(scale_pm(station_factor(stations, jitter_seed)), jitter_seed)
    return select_reading(score(scaled, null_aqi))
