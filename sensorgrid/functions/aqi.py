"""Air-quality index of a PM2.5 concentration, its labels and its percentage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession, functions as F

from sensorgrid.fixed_values import (
    AQI_BREAKPOINTS,
    AQI_CATEGORIES,
    AQI_CLASS_BOUNDS,
    AQI_COLORS,
    AQI_MAX,
    AQI_RECOMMENDATIONS,
    PERCENT_EXPONENT,
    PERCENT_ZERO_AT,
    SPORT_MAX_AQI,
)
from sensorgrid.functions.numeric import whole_half_up


def aqi_from_pm25(pm: Column, null_aqi: bool = False) -> Column:
    """Piecewise-linear index of a concentration with one decimal.

    A missing concentration falls through to the maximum, as above the last
    breakpoint; ``null_aqi=True`` gives NULL for it instead.
    """

    def segment(rest: Column, row: tuple[float, float, float, float]) -> Column:
        pm_from, pm_to, aqi_from, aqi_to = row
        slope = (aqi_to - aqi_from) / (pm_to - pm_from)
        return F.when(pm <= pm_to, (pm - pm_from) * slope + aqi_from).otherwise(rest)

    index = reduce(segment, reversed(AQI_BREAKPOINTS), F.lit(float(AQI_MAX)))
    aqi = whole_half_up(index).cast("int")
    return F.when(pm.isNotNull(), aqi) if null_aqi else aqi


def label_by_bound(value: Column, bounds: tuple, labels: tuple[str, ...]) -> Column:
    """Label of the first inclusive upper bound the value stays within, else the last.

    The class number is one expression however many labels are asked for, which
    the generated code evaluates once per row.
    """
    number = reduce(
        lambda rest, i: F.when(value <= bounds[i], F.lit(i)).otherwise(rest),
        reversed(range(len(bounds))),
        F.lit(len(bounds)),
    )
    return F.get(F.array(*[F.lit(text) for text in labels]), number)


def aqi_category(aqi: Column) -> Column:
    return label_by_bound(aqi, AQI_CLASS_BOUNDS, AQI_CATEGORIES)


def aqi_color(aqi: Column) -> Column:
    return label_by_bound(aqi, AQI_CLASS_BOUNDS, AQI_COLORS)


def aqi_recommendation(aqi: Column) -> Column:
    return label_by_bound(aqi, AQI_CLASS_BOUNDS, AQI_RECOMMENDATIONS)


def air_quality_percent(aqi: Column) -> Column:
    """100 for clean air down to 0; a missing index stays missing."""
    share = F.pow(aqi.cast("double") / float(PERCENT_ZERO_AT), F.lit(PERCENT_EXPONENT))
    return (
        F.when(aqi <= 0, F.lit(100.0))
        .when(aqi >= PERCENT_ZERO_AT, F.lit(0.0))
        .otherwise(F.round((F.lit(1.0) - share) * 100.0, 1))
    )


def sport_ok(aqi: Column) -> Column:
    return F.coalesce(aqi <= SPORT_MAX_AQI, F.lit(False))


def _sql_case(bounds: tuple, labels: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN aqi_value <= {b} THEN '{text}'" for b, text in zip(bounds, labels))
    return f"CASE {arms} ELSE '{labels[-1]}' END"


def register_sql_functions(spark: SparkSession) -> None:
    """``get_aqi_category(int)`` and ``get_aqi_color(int)`` for SQL users.

    SQL functions are inlined by the optimizer, so they cost no more than the
    CASE expression itself.
    """
    for name, labels in (("get_aqi_category", AQI_CATEGORIES), ("get_aqi_color", AQI_COLORS)):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(aqi_value INT) RETURNS STRING "
            f"RETURN {_sql_case(AQI_CLASS_BOUNDS, labels)}"
        )
