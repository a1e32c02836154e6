"""The serving queries, as lazy functions of the readings feed.

``feed`` has the reading columns and the arrival order of its messages. Capping
by arrival comes before filtering by event time throughout. A maintained history
(streaming.jobs.history_sink) may stand in for the whole feed: its last rows are
the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorgrid.fixed_values import (
    DEFAULT_HOURS,
    HISTORY_SIZE,
    OVERVIEW_SIZE,
    PAGE_SIZE,
    UNKNOWN_COLOR,
    UNKNOWN_LABEL,
)
from sensorgrid.functions.calendar import hours_before
from sensorgrid.functions.numeric import exact_avg
from sensorgrid.operators.latest import ARRIVAL, last_n, latest_by_arrival, tail


def recent(df: DataFrame, as_of: datetime | Column, hours: int | None = DEFAULT_HOURS) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of``; all rows for ``hours=None``.

    A table partitioned by ``event_date`` is read from the first day on only.
    """
    if hours is None:
        return df
    now = as_of if isinstance(as_of, Column) else F.lit(as_of.isoformat())
    since = hours_before(now.cast("timestamp_ntz"), hours)
    rows = df.where(F.col("datetime") >= since)
    if "event_date" in df.columns:
        rows = rows.where(F.col("event_date") >= since.cast("date"))
    return rows


def in_zone(df: DataFrame, zone_id: str | None) -> DataFrame:
    """Rows of a zone; none named, or an empty name, is no filter."""
    return df.where(F.col("zone_id") == zone_id) if zone_id else df


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of several feeds; a column some feed lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def kept_history(feed: DataFrame, size: int, order: Sequence[str]) -> DataFrame:
    """The last ``size`` arrived rows of every zone."""
    return last_n(_tail(feed, size, order), ["zone_id"], order, size)


def latest_of_zones(
    feed: DataFrame, order: Sequence[str], cols: Sequence[str] | None = None
) -> DataFrame:
    """The last arrived row of every zone."""
    return latest_by_arrival(feed, order, cols)


def _tail(feed: DataFrame, size: int, order: Sequence[str]) -> DataFrame:
    timed = isinstance(feed.schema[order[0]].dataType, (T.TimestampType, T.TimestampNTZType))
    return tail(feed, ["zone_id"], order[0], size) if timed and not feed.isStreaming else feed


def _or(column: str, default: object, kind: str | None = None) -> Column:
    value = F.coalesce(F.col(column), F.lit(default))
    return value.cast(kind) if kind else value


def _number(column: str, kind: str = "double") -> Column:
    return _or(column, 0, kind)


LATEST_COLUMNS = (
    "zone_id", "zone_name", "latitude", "longitude", "aqi", "aqi_category", "aqi_color",
    "aqi_recommendation", "pm2_5_atm", "pm10_atm", "datetime",
)


def zones_list(feed: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Every zone with its last arrived index, nested."""
    return latest_of_zones(feed, order, LATEST_COLUMNS).select(
        "zone_id",
        _or("zone_name", UNKNOWN_LABEL).alias("zone_name"),
        _number("latitude").alias("latitude"),
        _number("longitude").alias("longitude"),
        F.struct(
            _number("aqi", "int").alias("aqi"),
            _or("aqi_category", UNKNOWN_LABEL).alias("category"),
            _or("aqi_color", UNKNOWN_COLOR).alias("color"),
            _number("pm2_5_atm").alias("pm2_5"),
            _number("pm10_atm").alias("pm10"),
        ).alias("latest_aqi"),
        "datetime",
    )


def map_data(feed: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Every zone with its last arrived values, flat."""
    return latest_of_zones(feed, order, LATEST_COLUMNS).select(
        "zone_id",
        "zone_name",
        _number("latitude").alias("latitude"),
        _number("longitude").alias("longitude"),
        _number("aqi", "int").alias("aqi"),
        "aqi_category",
        "aqi_color",
        _number("pm2_5_atm").alias("pm2_5"),
        _number("pm10_atm").alias("pm10"),
        "datetime",
        _or("aqi_recommendation", "").alias("recommendation"),
    )


def zone_history(
    feed: DataFrame,
    as_of: datetime | Column,
    zone_id: str,
    hours: int = DEFAULT_HOURS,
    order: Sequence[str] = ARRIVAL,
    size: int = HISTORY_SIZE,
) -> DataFrame:
    """Last arrived rows of one zone within the period, newest first."""
    kept = kept_history(in_zone(feed, zone_id), size, order)
    return recent(kept, as_of, hours).orderBy(F.desc("datetime"))


def measurements_list(
    feed: DataFrame,
    as_of: datetime | Column,
    zone_id: str | None = None,
    hours: int | None = DEFAULT_HOURS,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """The newest page of one zone's history, or of the short history of all zones."""
    size = HISTORY_SIZE if zone_id else OVERVIEW_SIZE
    kept = kept_history(in_zone(feed, zone_id), size, order)
    return recent(kept, as_of, hours).orderBy(F.desc("datetime")).limit(PAGE_SIZE)


def latest_measurements(feed: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The last arrived row of every zone, newest event first."""
    return latest_of_zones(feed, order).orderBy(F.desc_nulls_last("datetime"))


def recent_stats(
    feed: DataFrame,
    as_of: datetime | Column,
    hours: int = DEFAULT_HOURS,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Index range and averages per zone over the recent part of its history."""
    kept = recent(kept_history(feed, HISTORY_SIZE, order), as_of, hours)
    named = kept.where(F.col("zone_id").isNotNull() & F.col("zone_name").isNotNull())
    return (
        named.groupBy("zone_id", "zone_name")
        .agg(
            F.avg("aqi").alias("avg_aqi"),
            F.min("aqi").alias("min_aqi"),
            F.max("aqi").alias("max_aqi"),
            exact_avg("pm2_5_atm").alias("avg_pm2_5"),
            exact_avg("pm10_atm").alias("avg_pm10"),
        )
        .orderBy("zone_id", "zone_name")
    )
