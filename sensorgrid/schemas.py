"""Row shapes that travel between the operators."""

from __future__ import annotations

from pyspark.sql import types as T

from sensorgrid.fixed_values import RAW_COUNT_FIELDS, RAW_TEXT_FIELDS

RAW = T.StructType(
    [T.StructField(f, T.StringType()) for f in RAW_TEXT_FIELDS]
    + [T.StructField(f, T.IntegerType()) for f in RAW_COUNT_FIELDS]
)

# Same fields, all as text: lets a lenient parse accept 12.0, "12" and NaN.
RAW_AS_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW])

TEXT, BYTES, BOOL = T.StringType(), T.BinaryType(), T.BooleanType()
INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
TIME, INSTANT = T.TimestampNTZType(), T.TimestampType()


def row(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


STATION = row(
    sensor_id=TEXT,
    zone_id=TEXT,
    zone_name=TEXT,
    latitude=DOUBLE,
    longitude=DOUBLE,
    sensor_variation=DOUBLE,
    pm_factor=DOUBLE,
    variability=DOUBLE,
    rush_hour_boost=DOUBLE,
    night_reduction=DOUBLE,
)

READING = row(
    sensor_id=TEXT,
    zone_id=TEXT,
    zone_name=TEXT,
    latitude=DOUBLE,
    longitude=DOUBLE,
    datetime=TIME,
    date=TEXT,
    time=TEXT,
    hour=INT,
    pm1_0_atm=DOUBLE,
    pm2_5_atm=DOUBLE,
    pm10_atm=DOUBLE,
    particles_03=INT,
    particles_05=INT,
    particles_10=INT,
    particles_25=INT,
    particles_50=INT,
    particles_100=INT,
    aqi=INT,
    aqi_category=TEXT,
    aqi_color=TEXT,
    aqi_recommendation=TEXT,
    air_quality_percent=DOUBLE,
    day_of_week=INT,
    day_name=TEXT,
    month=INT,
    is_weekend=INT,
    period=TEXT,
    sport_ok=BOOL,
)

ZONE_WINDOW = row(
    window_start=TIME,
    window_end=TIME,
    zone_id=TEXT,
    zone_name=TEXT,
    active_sensors=LONG,
    zone_latitude=DOUBLE,
    zone_longitude=DOUBLE,
    avg_pm1_0=DOUBLE,
    avg_pm2_5=DOUBLE,
    avg_pm10=DOUBLE,
    min_pm2_5=DOUBLE,
    max_pm2_5=DOUBLE,
    avg_aqi=DOUBLE,
    min_aqi=INT,
    max_aqi=INT,
    zone_aqi_category=TEXT,
    zone_aqi_color=TEXT,
    zone_recommendation=TEXT,
    avg_air_quality_percent=DOUBLE,
    sensor_ids=T.ArrayType(TEXT),
)

# The envelope of a message, as the Kafka source delivers it.
MESSAGE = row(
    key=BYTES,
    value=BYTES,
    topic=TEXT,
    partition=INT,
    offset=LONG,
    timestamp=INSTANT,
)
