"""Columns derived from event time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.fixed_values import (
    DAY_NAMES,
    DAY_PERIODS,
    NIGHT_FROM,
    NIGHT_PERIOD,
    NIGHT_TO,
    RUSH_HOURS,
    WEEKEND_DAYS,
)


def event_time(date: Column, time: Column) -> Column:
    """Zone-less timestamp of separate date and time texts; NULL unless both parse."""
    return F.concat(date, F.lit(" "), time).try_cast("timestamp_ntz")


def _epochs() -> tuple[Column, Column]:
    """1970 as an instant and as zone-less time."""
    return F.timestamp_seconds(F.lit(0)), F.lit("1970-01-01").cast("timestamp_ntz")


def as_instant(ts: Column) -> Column:
    """Zone-less time read as UTC, whatever the session's zone."""
    instant, zoneless = _epochs()
    return instant + (ts - zoneless)


def as_zoneless(ts: Column) -> Column:
    """The UTC reading of an instant, whatever the session's zone."""
    instant, zoneless = _epochs()
    return zoneless + (ts - instant)


def rush_hour(hour: Column) -> Column:
    within = reduce(lambda a, b: a | b, [hour.between(*span) for span in RUSH_HOURS])
    return F.coalesce(within, F.lit(False))


def night(hour: Column) -> Column:
    return F.coalesce((hour >= NIGHT_FROM) | (hour <= NIGHT_TO), F.lit(False))


def day_period(hour: Column) -> Column:
    return reduce(
        lambda earlier, entry: F.when(hour >= entry[0], F.lit(entry[1])).otherwise(earlier),
        DAY_PERIODS,
        F.lit(NIGHT_PERIOD),
    )


def day_name(day_of_week: Column) -> Column:
    """English name, Monday = 0; a missing day reads as the last name."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.coalesce(F.get(names, day_of_week), F.lit(DAY_NAMES[-1]))


def is_weekend(day_of_week: Column) -> Column:
    return F.coalesce(day_of_week.isin(*WEEKEND_DAYS), F.lit(False)).cast("int")


def iso_timestamp(ts: Column) -> Column:
    """ISO 8601 text with microseconds, without zone."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def hours_before(as_of: Column, hours: int) -> Column:
    return as_of - F.make_dt_interval(hours=F.lit(hours))


def time_enrichment(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Adds hour, day_of_week, day_name, month, is_weekend and period."""
    hour, day = F.hour(ts), F.weekday(F.col(ts))
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": day,
            "day_name": day_name(day),
            "month": F.month(ts),
            "is_weekend": is_weekend(day),
            "period": day_period(hour),
        }
    )
