"""Message sources: topics of JSON values, bounded or unbounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sensorgrid.fixed_values import RAW_COUNT_FIELDS
from sensorgrid.functions.calendar import event_time, iso_timestamp
from sensorgrid.functions.numeric import truncated_int
from sensorgrid.schemas import MESSAGE, RAW, RAW_AS_TEXT, READING


CORRUPT = "_corrupt_record"


def kafka_source(
    spark: SparkSession,
    topic: str,
    options: dict[str, str] | None = None,
    streaming: bool = True,
    fmt: str = "kafka",
    path: str | None = None,
) -> DataFrame:
    """One topic as (key, value, topic, partition, offset, timestamp).

    ``options`` are connector options (servers, security, offsets, rate limits)
    and are passed through. The default start is the earliest offset and lost
    offsets are tolerated. With ``fmt`` other than ``kafka`` the messages come
    from files of the same columns below ``path``.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt)
    if fmt == "kafka":
        defaults = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
        return reader.options(**{**defaults, **(options or {})}).option("subscribe", topic).load()
    files = reader.schema(MESSAGE).options(**(options or {})).load(path)
    return files.where(F.col("topic") == topic)


def sasl_options(servers: str, username: str, password: str) -> dict[str, str]:
    """Connector options of a broker behind SASL_SSL with PLAIN credentials."""
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'{login} required username="{username}" password="{password}";',
    }


def _lenient_int(text: Column) -> Column:
    """12.0 and "12" as 12; NaN and anything else as missing."""
    number = text.try_cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number), truncated_int(number))


def ingest_json(feed: DataFrame, mode: str = "strict", message: bool = False) -> DataFrame:
    """Messages of the raw topic as typed columns with event time and PM values.

    Every message is kept; one that does not parse has NULL data fields. With ``message``
    each row carries the whole message as it came, so that a refused one can be replayed,
    and ``malformed``: whether its text is no JSON object or has a field of another type.
    ``strict`` takes integers only. ``lenient`` also takes 12.0 and "12" (what a
    table with blanks turns integers into) and reads NaN as missing.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError(f"unknown mode {mode!r}")
    schema, options = RAW if mode == "strict" else RAW_AS_TEXT, {}
    beside = [F.col("timestamp").alias("kafka_timestamp")]
    if message:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"columnNameOfCorruptRecord": CORRUPT}
        beside.append(F.struct(*[c for c in MESSAGE.fieldNames() if c in feed.columns]).alias("message"))
    record = F.from_json(F.col("value").cast("string"), schema, options)
    raw = _unpack(feed, record, *beside)
    if message:
        no_text = F.col("message.value").isNull()
        raw = raw.withColumn("malformed", F.col(CORRUPT).isNotNull() | no_text).drop(CORRUPT)
    if mode == "lenient":
        raw = raw.withColumns({c: _lenient_int(F.col(c)) for c in RAW_COUNT_FIELDS})
    return with_event_time(raw)


def _unpack(feed: DataFrame, record: Column, *beside: Column | str) -> DataFrame:
    """The fields of a parsed record as columns, parsed once.

    Out of a plain projection the optimizer copies the parse into every filter
    on a field, once per field; it does not look through a generator.
    """
    return feed.select(F.inline(F.array(record)), *beside)


def with_event_time(raw: DataFrame) -> DataFrame:
    """Adds datetime, hour and the three PM values as doubles."""
    return raw.withColumn("datetime", event_time(F.col("date"), F.col("time"))).withColumns(
        {
            "hour": F.hour("datetime"),
            "pm1_raw": F.col("pm10_cf1").cast("double"),
            "pm25_raw": F.col("pm25_cf1").cast("double"),
            "pm10_raw": F.col("pm100_cf1").cast("double"),
        }
    )


def key_present(df: DataFrame, key: str = "zone_id") -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.col(key) != ""))


def feed_ingest(
    feed: DataFrame, received_at: Column | None = None, schema: T.StructType = READING
) -> DataFrame:
    """Messages of the readings topic as rows, stamped with their time of receipt.

    Empty, malformed and zone-less messages are dropped. Arrival order stays
    available as (timestamp, partition, offset). ``received_at`` defaults to the
    processing time. Event time may be written with blank or T, with or without
    fraction and zone.
    """
    stamp = received_at if received_at is not None else F.current_timestamp()
    as_sent = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "datetime" else f.dataType) for f in schema]
    )
    record = F.from_json(F.col("value").cast("string"), as_sent)
    rows = _unpack(feed, record, "timestamp", "partition", "offset")
    if "datetime" in schema.fieldNames():
        rows = rows.withColumn("datetime", F.col("datetime").try_cast("timestamp_ntz"))
    return key_present(rows).withColumn("received_at", iso_timestamp(stamp))


def replay(refused: DataFrame) -> DataFrame:
    """Refused messages as a feed again: the columns of a message and nothing else."""
    return refused.select(*[c for c in MESSAGE.fieldNames() if c in refused.columns])


def feed_inspect(feed: DataFrame) -> DataFrame:
    """Message text with its position in the topic."""
    return feed.select(F.col("value").cast("string").alias("value"), "partition", "offset")
