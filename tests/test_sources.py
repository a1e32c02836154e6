from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sensorgrid.operators.quality import dq_split
from sensorgrid.sources import messages as M
from sensorgrid.sources.csv_files import csv_scan
from sensorgrid.sinks.writers import write_csv


def feed(spark, *values):
    rows = [(None, None if v is None else bytearray(v, "utf8"), "t", 0, i) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint")
    return frame.withColumn("timestamp", F.timestamp_seconds("offset"))


GOOD = '{"date":"2024-01-01","time":"10:00:00","pm25_cf1":12,"gr03um":5}'


def test_strict_and_lenient(spark):
    values = [GOOD, GOOD.replace("12", "12.0"), GOOD.replace(":12", ":NaN"), GOOD.replace(":12", ':"12"')]
    frame = feed(spark, *values)
    strict = [r.pm25_raw for r in M.ingest_json(frame).collect()]
    lenient = [r.pm25_raw for r in M.ingest_json(frame, "lenient").collect()]
    assert strict == [12.0, None, None, None]
    assert lenient == [12.0, 12.0, None, 12.0]
    with pytest.raises(ValueError):
        M.ingest_json(frame, "loose")


def test_every_message_is_kept_and_bad_ones_quarantined(spark):
    no_date = '{"time":"10:00:00","pm25_cf1":1}'
    bad_date = '{"date":"foo","time":"10:00:00","pm25_cf1":1}'
    rows = M.ingest_json(feed(spark, GOOD, "nope", "{}", None, no_date, bad_date))
    assert rows.count() == 6
    valid, quarantine = dq_split(rows, "raw")
    assert valid.count() == 1
    reasons = sorted(r.reasons[0] for r in quarantine.collect())
    assert reasons == ["no event time"] * 2 + ["no field parsed"] * 3


def test_messages_are_parsed_once(spark):
    valid, _ = dq_split(M.ingest_json(feed(spark, GOOD)), "raw")
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_feed_keeps_zones_only_and_reads_several_time_formats(spark):
    frame = M.feed_ingest(
        feed(
            spark,
            '{"zone_id":"a","datetime":"2024-01-01 10:00:00","aqi":5}',
            '{"zone_id":"b","datetime":"2024-01-01T10:00:00.000Z"}',
            '{"zone_id":"c","datetime":"2024-01-01T10:00:00.123456"}',
            '{"zone_id":""}',
            '{"aqi":5}',
            "nope",
            None,
        ),
        F.lit("2024-02-01").cast("timestamp_ntz"),
    )
    rows = {r.zone_id: r for r in frame.collect()}
    assert sorted(rows) == ["a", "b", "c"]
    assert {str(r.datetime)[:19] for r in rows.values()} == {"2024-01-01 10:00:00"}
    assert rows["c"].datetime.microsecond == 123456
    assert rows["a"].received_at == "2024-02-01T00:00:00.000000" and rows["a"].aqi == 5


def test_connector_options():
    options = M.sasl_options("host:9092", "user", "secret")
    assert options["kafka.bootstrap.servers"] == "host:9092"
    assert 'username="user"' in options["kafka.sasl.jaas.config"]


def test_csv_round_trip_with_quotes(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.sql("""SELECT 1 AS id, 'a "quoted", text' AS t, timestamp_ntz'2024-01-01 00:00:00.5' AS datetime""")
    write_csv(rows, path)
    assert csv_scan(spark, path, rows.schema).collect() == rows.collect()
    assert csv_scan(spark, path).dtypes[0][1] == "int"


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id\nnot a number\n")
    with pytest.raises(Exception):
        csv_scan(spark, str(tmp_path / "x.csv"), "id int").collect()
