"""Zone averages over event-time windows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.fixed_values import ZONE_WINDOW as ZONE_WINDOW_LENGTH
from sensorgrid.functions import aqi as A
from sensorgrid.functions.numeric import average_of, exact_avg, sum_parts
from sensorgrid.schemas import ZONE_WINDOW

ZONE_KEYS = ("window_start", "window_end", "zone_id", "zone_name")

# Stations of a zone that get a counter column of their own; the ids of any others
# are listed.
COUNTERS_PER_ZONE = 64

# Registers of a sensor sketch, as a power of two: 4 kB.
SKETCH_LG_K = 12

# Column, name and digits of the averages.
MEANS = (
    ("latitude", "zone_latitude", 4),
    ("longitude", "zone_longitude", 4),
    ("pm1_0_atm", "avg_pm1_0", 1),
    ("pm2_5_atm", "avg_pm2_5", 1),
    ("pm10_atm", "avg_pm10", 1),
    ("air_quality_percent", "avg_air_quality_percent", 1),
)


def _window_keys(length: str) -> list[Column]:
    return [F.window("datetime", length).alias("window"), F.col("zone_id"), F.col("zone_name")]


def _unnest(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "zone_id",
        "zone_name",
        *columns,
    )


def zone_label(df: DataFrame, aqi: str = "avg_aqi") -> DataFrame:
    """Adds category, colour and recommendation of a zone's average index."""
    value = F.col(aqi)
    return df.withColumns(
        {
            "zone_aqi_category": A.aqi_category(value),
            "zone_aqi_color": A.aqi_color(value),
            "zone_recommendation": A.aqi_recommendation(value),
        }
    )


def _aggregates() -> list[Column]:
    return [
        F.count("sensor_id").alias("active_sensors"),
        *[F.round(exact_avg(column), digits).alias(name) for column, name, digits in MEANS],
        F.round(F.min("pm2_5_atm"), 1).alias("min_pm2_5"),
        F.round(F.max("pm2_5_atm"), 1).alias("max_pm2_5"),
        F.round(F.avg("aqi"), 0).alias("avg_aqi"),
        F.min("aqi").alias("min_aqi"),
        F.max("aqi").alias("max_aqi"),
    ]


def _sensor_parts() -> list[Column]:
    """What a window needs to know of one of its sensors."""
    sums = [v.alias(f"_{c}_{k}") for c, _, _ in MEANS for k, v in sum_parts(c).items()]
    return [
        F.count("sensor_id").alias("readings"), *sums,
        F.min("pm2_5_atm").alias("_min_pm"), F.max("pm2_5_atm").alias("_max_pm"),
        F.sum("aqi").alias("_aqi"), F.count("aqi").alias("_aqi_n"),
        F.min("aqi").alias("_min_aqi"), F.max("aqi").alias("_max_aqi"),
    ]


def _merged_parts() -> list[Column]:
    """``_aggregates`` from the parts of all sensors."""
    means = [
        F.round(average_of({k: F.sum(f"_{c}_{k}") for k in sum_parts(c)}), digits).alias(name)
        for c, name, digits in MEANS
    ]
    return [
        F.sum("readings").alias("active_sensors"), *means,
        F.round(F.min("_min_pm"), 1).alias("min_pm2_5"), F.round(F.max("_max_pm"), 1).alias("max_pm2_5"),
        F.round(F.sum("_aqi") / F.nullif(F.sum("_aqi_n"), F.lit(0)), 0).alias("avg_aqi"),
        F.min("_min_aqi").alias("min_aqi"), F.max("_max_aqi").alias("max_aqi"),
    ]


MEASURES = [n for n in ZONE_WINDOW.fieldNames() if n not in (*ZONE_KEYS, "sensor_ids")]


def zone_measures(readings: DataFrame, length: str = ZONE_WINDOW_LENGTH) -> DataFrame:
    """One row per window and zone: all columns of a zone window but the id list.

    Every aggregate has a fixed-size buffer, so the map side reduces a hot zone
    to one row per task before the shuffle, and streaming state stays flat.
    """
    grouped = readings.groupBy(*_window_keys(length)).agg(*_aggregates())
    return _unnest(zone_label(grouped), *MEASURES)


def _expanded(entries: Column) -> Column:
    """Every id as often as it was counted."""
    return F.flatten(F.transform(entries, lambda e: F.array_repeat(e["sensor_id"], e["readings"].cast("int"))))


def known_station_windows(
    readings: DataFrame, length: str, stations: Sequence[dict[str, Any]], only_known: bool = False
) -> DataFrame:
    """Zone windows with ``sensor_ids`` in one aggregation, where the stations are known.

    A zone's stations share counters by their place in the zone, so there are as many
    as the largest zone has stations. Readings of other sensors, and of stations
    beyond ``COUNTERS_PER_ZONE``, are listed one by one beside the counters.
    ``only_known`` promises that there are no others, as behind a fan-out over the same
    stations: a reading that breaks the promise is an error, however many stations a zone
    has, and up to ``COUNTERS_PER_ZONE`` of them state is counters only.
    """
    zones: dict[str, list[str]] = {}
    for s in sorted({(s["zone_id"], s["sensor_id"]) for s in stations}):
        zones.setdefault(s[0], []).append(s[1])
    counted = {z: ids[:COUNTERS_PER_ZONE] for z, ids in zones.items()}
    width = max((len(ids) for ids in counted.values()), default=0)
    listing = not only_known or any(len(ids) > COUNTERS_PER_ZONE for ids in zones.values())
    none = F.array().cast("array<string>")
    names = F.coalesce(
        *[F.when(F.col("zone_id") == z, F.array(*map(F.lit, ids))) for z, ids in counted.items()], none
    )
    place = F.coalesce(
        *[F.when(F.col("zone_id") == z, F.array_position(F.array(*map(F.lit, ids)), F.col("sensor_id")))
          for z, ids in counted.items()], F.lit(0)
    )
    placed = readings.withColumn("_place", place)
    strangers = []
    if only_known and listing:
        known = F.coalesce(
            *[F.when(F.col("zone_id") == z, F.coalesce(F.col("sensor_id").isin(ids), F.lit(True))) for z, ids in zones.items()],
            F.lit(False),
        )
        strangers = [F.count_if(~known).alias("_strangers")]
    counters = [F.count_if(F.col("_place") == i + 1).alias(f"_n{i}") for i in range(width)]
    others = F.collect_list(F.when(F.col("_place") == 0, F.col("sensor_id"))).alias("_others")
    grouped = placed.groupBy(*_window_keys(length)).agg(*_aggregates(), *counters, *([others] if listing else []), *strangers)
    counts = F.array(*[F.col(f"_n{i}") for i in range(width)]) if width else F.array().cast("array<bigint>")
    pairs = F.zip_with(names, F.slice(counts, 1, F.size(names)), lambda n, c: F.array_repeat(n, c.cast("int")))
    ids = F.flatten(pairs)
    if listing:
        ids = F.array_sort(F.concat(ids, "_others"))
    if only_known:
        all_known = F.col("_strangers") == 0 if strangers else F.size(ids) == F.col("active_sensors")
        unknown = F.raise_error(F.lit("a reading of a sensor that is no known station"))
        ids = F.when(all_known, ids).otherwise(unknown.cast("array<string>"))
    return _unnest(zone_label(grouped).withColumn("sensor_ids", ids), *MEASURES, "sensor_ids")


def zone_window_sensors(readings: DataFrame, length: str = ZONE_WINDOW_LENGTH) -> DataFrame:
    """Which sensors a zone window is made of, one row each with its reading count."""
    grouped = (
        readings.where(F.col("sensor_id").isNotNull())
        .groupBy(*_window_keys(length), "sensor_id")
        .agg(F.count("*").alias("readings"))
    )
    return _unnest(grouped, "sensor_id", "readings")


def attach_sensor_ids(zones: DataFrame, sensors: DataFrame) -> DataFrame:
    """Zone windows with ``sensor_ids``, one id per reading, sorted, from ``zone_window_sensors``.

    What is gathered per window are its sensors with their counts.
    """
    entry = F.struct("sensor_id", "readings")
    lists = sensors.groupBy(*ZONE_KEYS).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    z, s = zones.alias("z"), lists.alias("s")
    same = [F.col("z.window_start") == F.col("s.window_start")]
    same += [F.col(f"z.{k}").eqNullSafe(F.col(f"s.{k}")) for k in ("zone_id", "zone_name")]
    listed = F.coalesce(_expanded(F.col("_entries")), F.array().cast("array<string>"))
    return z.join(s, same, "left").select("z.*", listed.alias("sensor_ids"))


def zone_window_agg(
    readings: DataFrame,
    length: str = ZONE_WINDOW_LENGTH,
    stations: Sequence[dict[str, Any]] | None = None,
    only_known: bool = False,
) -> DataFrame:
    """Zone windows, 20 columns. ``active_sensors`` counts readings, as the id list does.

    One scan: readings are reduced to one row per window and sensor before the first
    shuffle, those to one row per window before the second. With ``stations`` (see
    ``known_station_windows``) one shuffle does, and streams can run it.
    """
    if stations is not None:
        return known_station_windows(readings, length, stations, only_known).select(*ZONE_WINDOW.fieldNames())
    parts = readings.groupBy(*_window_keys(length), "sensor_id").agg(*_sensor_parts())
    # collect_list leaves out nulls: readings without a sensor count, but are not listed.
    entry = F.when(F.col("sensor_id").isNotNull(), F.struct("sensor_id", "readings"))
    zones = parts.groupBy("window", "zone_id", "zone_name").agg(
        *_merged_parts(), F.sort_array(F.collect_list(entry)).alias("_entries")
    )
    listed = zone_label(zones).withColumn("sensor_ids", _expanded(F.col("_entries")))
    return _unnest(listed, *MEASURES, "sensor_ids").select(*ZONE_WINDOW.fieldNames())


def with_distinct_sensors(zones: DataFrame) -> DataFrame:
    """Adds ``distinct_sensors`` beside ``active_sensors``, which counts readings."""
    return zones.withColumn("distinct_sensors", F.size(F.array_distinct("sensor_ids")).cast("bigint"))


def sensor_sketches(readings: DataFrame, length: str = ZONE_WINDOW_LENGTH, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Which sensors a zone window has, as a sketch of bounded size that can be merged.

    Batch or streaming, where the state of a window is its sketch, however many readings
    or sensors it has. ``distinct_sensors`` counts what it holds.
    """
    sketch = F.hll_sketch_agg("sensor_id", lg_k).alias("sensors")
    present = readings.where(F.col("sensor_id").isNotNull())
    return _unnest(present.groupBy(*_window_keys(length)).agg(sketch), "sensors")


def distinct_sensors(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """``distinct_sensors`` of the merged sketches per ``by``.

    An estimate: off by one at most for a few hundred sensors, beyond with a relative
    standard error of about 1.04 / sqrt(2 ** lg_k): 1.6 %.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("sensors"))
    return sketches.groupBy(*by).agg(merged.cast("bigint").alias("distinct_sensors"))


def counted_sensors(sensors: DataFrame, *by: str | Column) -> DataFrame:
    """``distinct_sensors`` per ``by``, exactly, from rows that name a sensor each.

    Rows may repeat, such as versions of a changelog. Repeats go before the shuffle, and a
    group of any size is counted by as many tasks as its sensors are dealt to.
    """
    return sensors.groupBy(*by).agg(F.count_distinct("sensor_id").alias("distinct_sensors"))


def array_to_csv(df: DataFrame, src: str = "sensor_ids", dst: str = "sensor_ids_str") -> DataFrame:
    """Replaces an array of texts by its comma-separated text."""
    text = F.when(F.col(src).isNotNull(), F.concat_ws(",", src))
    return df.withColumn(dst, text).drop(src)


def to_zone_table(zones: DataFrame) -> DataFrame:
    """Zone windows in the column types of the zone table."""
    flat = array_to_csv(zones) if "sensor_ids" in zones.columns else zones
    return flat.withColumns(
        {c: F.col(c).try_cast("int") for c in ("active_sensors", "avg_aqi")}
    )


def daily_zone_stats(zones: DataFrame) -> DataFrame:
    """Per zone and day: windows, average of the window averages, index range.

    Expects one row per window and zone (see streaming.changelog.keep_last).
    """
    return (
        zones.groupBy("zone_id", "zone_name", F.to_date("window_start").alias("date"))
        .agg(
            F.count("*").alias("readings_count"),
            F.round(exact_avg("avg_pm2_5"), 1).alias("daily_avg_pm25"),
            F.round(exact_avg("avg_aqi"), 0).alias("daily_avg_aqi"),
            F.min("min_aqi").alias("daily_min_aqi"),
            F.max("max_aqi").alias("daily_max_aqi"),
        )
        .orderBy(F.desc("date"), "zone_id")
    )
