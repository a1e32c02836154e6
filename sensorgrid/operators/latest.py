"""Latest row and last rows per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sensorgrid.session import new_path

# Order of arrival of messages: offsets order only within a partition.
ARRIVAL = ("timestamp", "partition", "offset")

SENSOR_VIEW = (
    "sensor_id", "zone_id", "zone_name", "latitude", "longitude", "datetime",
    "pm1_0_atm", "pm2_5_atm", "pm10_atm", "aqi", "aqi_category", "aqi_color",
    "air_quality_percent", "sport_ok",
)
ZONE_VIEW = (
    "zone_id", "zone_name", "window_start", "window_end", "active_sensors",
    "zone_latitude", "zone_longitude", "avg_pm2_5", "avg_aqi", "zone_aqi_category",
    "zone_aqi_color", "avg_air_quality_percent",
)


#: Keys whose newest rows are looked up in a broadcast table; more are reduced by map tasks.
FEW_KEYS = 100_000

_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _named(keys: Sequence[str]) -> list[str]:
    return [f"_key{i}" for i in range(len(keys))]


def _same(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Equality of the keys, nulls too, with a frame that has them as ``_named``."""
    return [df[k].eqNullSafe(other[n]) for k, n in zip(keys, _named(keys))]


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, list[str]] | None:
    """The greatest leading ``order`` columns of every key, and which columns these are.

    They lead up to the first of a fixed width, whose maximum Spark keeps in a hash table;
    texts before it are grouped by. Reads keys and these columns only. None if no column
    has a fixed width.
    """
    kinds = [isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in order]
    if True not in kinds:
        return None
    leading = list(order[: kinds.index(True) + 1])
    texts, fixed = leading[:-1], leading[-1]
    newest = df.groupBy(*keys, *texts).agg(F.max(fixed).alias(fixed))
    if texts:
        newest = _first(newest, keys, leading)
    return newest.toDF(*_named(keys), *leading), leading


def _first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str] | None = None, lazy: bool = False
) -> DataFrame:
    """The row with the greatest ``order`` per key.

    Two passes: the first finds every key's greatest ``order`` from those columns alone,
    the second picks the rows that reach it, so wide rows are neither sorted nor sent. The
    first pass runs when this is called, and what it finds is written; rows that come later
    are not seen. With more than ``FEW_KEYS`` keys, on a stream, or if ``lazy`` asks for a
    frame that is evaluated anew whenever it is read (a view), it is one aggregate instead:
    each map task then sorts its rows and sends one per key.

    Of rows equal in keys and ``order`` one is returned.
    """
    cols = list(cols or df.columns)
    found = None if lazy or df.isStreaming else newest_per_key(df, keys, order)
    if found:
        newest, leading = _written(found[0], "newest"), found[1]
        if newest.count() <= FEW_KEYS:
            reach = [*_same(df, newest, keys), *(df[c].eqNullSafe(newest[c]) for c in leading)]
            return _first(df.join(F.broadcast(newest), reduce(and_, reach), "left_semi"), keys, order).select(*cols)
    rest = [c for c in cols if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*cols)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tail(df: DataFrame, keys: Sequence[str], time: str, n: int, bucket: str = "hour") -> DataFrame:
    """Rows that can be among the last ``n`` of their key by ``time``, and few others.

    Counts rows per key and ``bucket`` of time first, which reads two columns and sends
    one number per bucket; then reads on from the bucket in which each key reaches ``n``.
    A key with fewer rows is read whole and holds no other key back. The cut-offs are
    found and written when this is called; the earliest of them reaches the scan as a
    plain filter, so a table in order of time is read from there on.
    """
    counts = df.groupBy(*keys, F.date_trunc(bucket, time).alias("_bucket")).agg(F.count("*").alias("_rows"))
    newer_rows = F.sum("_rows").over(
        Window.partitionBy(*keys).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    )
    needed = counts.withColumn("_newer", F.coalesce(newer_rows, F.lit(0))).where(F.col("_newer") < n)
    kind = df.schema[time].dataType
    since = needed.groupBy(*keys).agg(F.min("_bucket").cast(kind).alias("_since"))
    since = _written(since.toDF(*_named(keys), "_since"), "since")
    late = since["_since"].isNull() | df[time].isNull() | (df[time] >= since["_since"])
    rows = df.join(since, [*_same(df, since, keys), late], "left_semi")
    if since.where(F.col("_since").isNull()).isEmpty() and not since.isEmpty():
        first = since.agg(F.min("_since").cast("timestamp_ntz").cast("string")).first()[0]
        rows = rows.where((F.col(time) >= F.lit(first).cast("timestamp_ntz").cast(kind)) | F.col(time).isNull())
    return rows


def last_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, salts: int = 16
) -> DataFrame:
    """The ``n`` rows with the greatest ``order`` per key.

    Ranks within (key, salt) first and within the key second: the planner cuts
    both ranks off before their shuffle. The salt is the map task's, so a task sends
    ``n`` rows per key, and a hot key ends in one task with at most ``n * salts`` rows.
    Which salt a row gets does not change the result.
    """
    latest_first = [F.desc(c) for c in order]
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))

    def cut(rows: DataFrame, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*latest_first))
        return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

    return cut(cut(salted, *keys, "_salt"), *keys).drop("_salt")


def latest_sensor_readings(readings: DataFrame, tiebreak: Sequence[str] = (), lazy: bool = False) -> DataFrame:
    """Last reading of every sensor by event time."""
    return latest_by(readings, ["sensor_id"], ["datetime", *tiebreak], SENSOR_VIEW, lazy)


def latest_zone_averages(zones: DataFrame, tiebreak: Sequence[str] = (), lazy: bool = False) -> DataFrame:
    """Last window of every zone."""
    return latest_by(zones, ["zone_id"], ["window_start", *tiebreak], ZONE_VIEW, lazy)


def latest_by_arrival(
    feed: DataFrame, order: Sequence[str] = ARRIVAL, cols: Sequence[str] | None = None
) -> DataFrame:
    """Last arrived row of every zone, whatever its event time."""
    return latest_by(feed, ["zone_id"], order, cols)


def history_size(history: DataFrame) -> DataFrame:
    """How many rows each zone keeps."""
    return history.groupBy("zone_id").agg(F.count("*").alias("kept"))
