"""The driver's tables in the shapes the operators take.

``events`` stands in for the sensor feed: a user is a sensor, an event type a
zone, the value a PM2.5 concentration and ``props.k`` a particle count. Messages
arrive ``k`` minutes after their event, so arrival and event order differ.
``supplier`` stands in for a network of zones with three stations each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorgrid.functions.calendar import time_enrichment
from sensorgrid.operators.enrich import score, select_reading
from sensorgrid.operators.latest import ARRIVAL
from sensorgrid.schemas import RAW

RAW_TOPIC = "raw"
EVENT_COLUMNS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream (a stream reads a folder, not a file)."""
    reader = spark.readStream.schema(EVENT_COLUMNS).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf_dir)


def _k() -> Column:
    return F.from_json("props", "k int")["k"]


def _arrival() -> dict[str, Column]:
    return {
        "timestamp": (F.col("ts") + F.make_dt_interval(mins=_k())).cast("timestamp"),
        "partition": (F.col("user_id") % 8).cast("int"),
        "offset": F.col("event_id"),
    }


def _raw_fields() -> dict[str, Column]:
    value, k = F.col("value"), _k()
    pm1, pm10 = value * 0.6, value * 1.4
    return {
        "date": F.date_format("ts", "yyyy-MM-dd"),
        "time": F.date_format("ts", "HH:mm:ss"),
        "pm10_cf1": pm1.cast("int"),
        "pm25_cf1": value.cast("int"),
        "pm100_cf1": pm10.cast("int"),
        "pm10_std": pm1.cast("int"),
        "pm25_std": value.cast("int"),
        "pm100_std": pm10.cast("int"),
        "gr03um": k * 30,
        "gr05um": k * 9,
        "gr10um": k * 3,
        "gr25um": k,
        "gr50um": F.floor(k / 3).cast("int"),
        "gr100um": F.floor(k / 9).cast("int"),
    }


def _as_messages(rows: DataFrame, value: Column) -> DataFrame:
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(RAW_TOPIC).alias("topic"),
        *[c.alias(n) for n, c in _arrival().items()],
    ).select("key", "value", "topic", "partition", "offset", "timestamp")


def raw_feed(rows: DataFrame) -> DataFrame:
    """Messages of raw records, one per event."""
    fields = _raw_fields()
    return _as_messages(rows, F.to_json(F.struct(*[fields[f.name].alias(f.name) for f in RAW])))


def faulty_raw_feed(rows: DataFrame) -> DataFrame:
    """The same with faults: no JSON (k < 10), no date (k >= 90), decimals (k = 50..59)."""
    fields = _raw_fields()
    k = _k()
    whole = F.to_json(F.struct(*[fields[f.name].alias(f.name) for f in RAW]))
    dateless = F.to_json(F.struct(*[fields[f.name].alias(f.name) for f in RAW if f.name != "date"]))
    fields["pm25_cf1"] = fields["pm25_cf1"].cast("double")
    decimals = F.to_json(F.struct(*[fields[f.name].alias(f.name) for f in RAW]))
    value = (
        F.when(k < 10, F.lit("no json"))
        .when(k >= 90, dateless)
        .when(k.between(50, 59), decimals)
        .otherwise(whole)
    )
    return _as_messages(rows, value)


def readings(rows: DataFrame) -> DataFrame:
    """Readings, one per event, with the arrival order of their messages."""
    value, k = F.col("value"), _k()
    base = rows.select(
        F.col("user_id").cast("string").alias("sensor_id"),
        F.col("event_type").alias("zone_id"),
        F.upper("event_type").alias("zone_name"),
        (F.lit(47.5) + (F.col("user_id") % 10) / 1000).alias("latitude"),
        (F.lit(6.8) + (F.col("user_id") % 7) / 1000).alias("longitude"),
        F.col("ts").alias("datetime"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
        F.round(value * 0.6, 1).alias("pm1_0_atm"),
        F.round(value, 1).alias("pm2_5_atm"),
        F.round(value * 1.4, 1).alias("pm10_atm"),
        (k * 30).alias("particles_03"),
        (k * 9).alias("particles_05"),
        (k * 3).alias("particles_10"),
        k.alias("particles_25"),
        F.floor(k / 3).cast("int").alias("particles_50"),
        F.floor(k / 9).cast("int").alias("particles_100"),
        *[c.alias(n) for n, c in _arrival().items()],
    )
    return select_reading(time_enrichment(score(base)), ARRIVAL)


def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested network descriptions, one per supplier: a zone with three stations."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    nation = F.col("s_nationkey")

    def station(number: int, variation: float) -> Column:
        return F.struct(
            F.concat("s_name", F.lit(f"/{number}")).alias("id"),
            (F.lit(47.0) + nation / 100).alias("lat"),
            (F.lit(6.0) + nation / 100).alias("lon"),
            F.lit(variation).alias("variation"),
        )

    zone = F.struct(
        F.upper("s_name").alias("zone_name"),
        (F.lit(0.5) + nation / 20).alias("pm_factor"),
        F.lit(0.1).alias("variability"),
        F.lit(1.3).alias("rush_hour_boost"),
        F.lit(0.85).alias("night_reduction"),
        F.array(station(1, 1.0), station(2, 1.05), station(3, 0.95)).alias("stations"),
    )
    return supplier.select(F.create_map("s_name", zone).alias("zones"))
