from __future__ import annotations

import glob
import os
import shutil
from collections import Counter

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter, Window, functions as F
from test_operators import same

from sensorgrid.operators import latest as L, registry as R, zones as Z
from sensorgrid.plans import bindings as B, serving as S
from sensorgrid.plans.registered import QUERIES
from sensorgrid.plans.views import current_zone_windows, register_views
from sensorgrid.schemas import MESSAGE, READING
from sensorgrid.sinks.payload import to_payload
from sensorgrid.sinks.writers import (
    BatchId, compact, jdbc_sink, multi_sink, read_routed, routed_sink, split_sink, table_sink, topic_sink,
)
from sensorgrid.sources import messages as M
from sensorgrid.streaming import history, jobs as J
from sensorgrid.streaming.app import database_sinks, start_feed, start_service
from sensorgrid.streaming.changelog import keep_last
from sensorgrid.streaming.history import keyed_history, read_history

LENGTH = "1 hour"


@pytest.fixture(scope="module")
def quarters(spark, sf_dir, tmp_path_factory):
    """The events cut into four files by time."""
    folder = tmp_path_factory.mktemp("quarters")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cut = events.withColumn("q", F.ntile(4).over(Window.orderBy("ts")))
    files = []
    for q in range(1, 5):
        out = str(folder / f"q{q}")
        cut.where(f"q = {q}").drop("q").coalesce(1).write.parquet(out)
        files.append(glob.glob(f"{out}/*.parquet")[0])
    return files


def deliver(files, folder, order):
    """A source folder that hands out the quarters one by one in this order."""
    os.makedirs(folder)
    for i, q in enumerate(order):
        target = f"{folder}/{i}.parquet"
        shutil.copy(files[q - 1], target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def stream(spark, folder):
    reader = spark.readStream.schema(B.EVENT_COLUMNS).option("maxFilesPerTrigger", "1")
    return reader.parquet(folder)


def zone_changelog(spark, folder, out, watermark="1 hour"):
    rows = B.readings(stream(spark, folder))
    query = J.run_available(
        J.zone_stream(rows, LENGTH, watermark), table_sink(out), "update", out + "-state", state_partitions=4
    )
    return J.read_versions(spark, out), query


def test_in_order_stream_equals_batch(spark, sf_dir, quarters, tmp_path):
    log, query = zone_changelog(spark, deliver(quarters, tmp_path / "in", [1, 2, 3, 4]), str(tmp_path / "out"))
    batch = Z.zone_measures(B.readings(B.events(spark, sf_dir)), LENGTH)
    assert same(current_zone_windows(log), batch)
    assert log.count() >= batch.count() and J.late_rows(query) == 0


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York"])
def test_session_zone_does_not_move_windows(spark, sf_dir, quarters, tmp_path, zone):
    batch = Z.zone_measures(B.readings(B.events(spark, sf_dir)), LENGTH).collect()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        log, _ = zone_changelog(spark, deliver(quarters, tmp_path / "in", [1, 2, 3, 4]), str(tmp_path / "out"))
        assert sorted(current_zone_windows(log).select(*batch[0].__fields__).collect()) == sorted(batch)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_one_batch_late_is_accepted(spark, sf_dir, quarters, tmp_path):
    log, query = zone_changelog(spark, deliver(quarters, tmp_path / "in", [1, 3, 2, 4]), str(tmp_path / "out"))
    batch = Z.zone_measures(B.readings(B.events(spark, sf_dir)), LENGTH)
    assert J.late_rows(query) == 0
    # A window may have been evicted between its parts, but no reading is lost.
    assert log.select("window_start", "zone_id").distinct().count() == batch.count()


def test_late_quarter_is_dropped(spark, sf_dir, quarters, tmp_path):
    log, query = zone_changelog(spark, deliver(quarters, tmp_path / "in", [2, 3, 4, 1]), str(tmp_path / "out"))
    on_time = spark.read.parquet(*quarters[1:])
    assert J.late_rows(query) > 0
    assert same(current_zone_windows(log), Z.zone_measures(B.readings(on_time), LENGTH))


def test_append_mode_emits_closed_windows_once(spark, quarters, tmp_path):
    rows = B.readings(stream(spark, deliver(quarters, tmp_path / "in", [1, 2, 3, 4])))
    out = str(tmp_path / "out")
    J.run_available(J.zone_stream(rows, LENGTH, "1 hour"), table_sink(out), "append", out + "-state", state_partitions=4)
    closed = J.read_versions(spark, out).drop("run", "batch_id")
    batch = Z.zone_measures(B.readings(spark.read.parquet(*quarters)), LENGTH)
    assert closed.exceptAll(batch).isEmpty() and 0 < batch.count() - closed.count() < 20


def test_restart_goes_on_where_it_stopped(spark, quarters, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    deliver(quarters, source, [1, 2])
    zone_changelog(spark, str(source), out)
    for i, q in ((2, 3), (3, 4)):
        target = f"{source}/{i}.parquet"
        shutil.copy(quarters[q - 1], target)
        os.utime(target, (1_700_000_100 + i, 1_700_000_100 + i))
    log, _ = zone_changelog(spark, str(source), out)
    assert same(current_zone_windows(log), Z.zone_measures(B.readings(spark.read.parquet(*quarters)), LENGTH))


def test_failed_batch_is_retried_without_duplicates(spark, quarters, tmp_path):
    source, out, topic = deliver(quarters, tmp_path / "in", [1, 2, 3, 4]), str(tmp_path / "out"), str(tmp_path / "topic")
    failures = []

    def fails_once(batch, batch_id):
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise RuntimeError("sink down")

    sink = multi_sink(table_sink(out, event_date="datetime"), fails_once, topic_sink("t", fmt="json", path=topic))
    rows = B.readings(stream(spark, source)).select(*READING.fieldNames())
    with pytest.raises(Exception, match="sink down"):
        J.run_available(rows, sink, "append", out + "-state")
    J.run_available(rows, sink, "append", out + "-state")
    want = B.readings(spark.read.parquet(*quarters)).select(*READING.fieldNames())
    assert same(spark.read.parquet(out).select(*READING.fieldNames()), want)
    sent = spark.read.json(topic, schema="value string, topic string")
    assert same(sent.select(F.from_json("value", READING).alias("d")).select("d.*"), want)


def test_latest_stream_equals_batch(spark, quarters, tmp_path):
    rows = B.readings(stream(spark, deliver(quarters, tmp_path / "in", [3, 1, 4, 2])))
    out = str(tmp_path / "out")
    J.run_available(J.latest_stream(rows), table_sink(out), "update", out + "-state", state_partitions=4)
    batch = L.latest_by_arrival(B.readings(spark.read.parquet(*quarters)))
    assert same(keep_last(J.read_versions(spark, out), ["zone_id"]), batch)


@pytest.mark.parametrize("keep", [2, 8])
def test_history_snapshots_equal_batch(spark, quarters, tmp_path, keep):
    rows = B.readings(stream(spark, deliver(quarters, tmp_path / "in", [3, 1, 4, 2])))
    out = str(tmp_path / "out")
    sink = J.history_sink(out, n=60, keep=keep)
    J.run_available(rows, sink, "append", out + "-state")
    want = L.last_n(B.readings(spark.read.parquet(*quarters)), ["zone_id"], L.ARRIVAL, 60)
    assert same(J.latest_snapshot(spark, out), want)
    assert len(glob.glob(f"{out}/run=*/batch_id=*")) <= keep
    # The last batch again, as after a failed commit: same snapshot.
    run = J.run_label(spark, out + "-state")
    sink(B.readings(spark.read.parquet(quarters[1])), BatchId(3, run))
    assert same(J.latest_snapshot(spark, out), want)


def test_history_goes_on_under_a_new_checkpoint(spark, quarters, tmp_path):
    out = str(tmp_path / "out")
    assert J.latest_snapshot(spark, out).isEmpty()
    sink = J.history_sink(out, n=60)
    for k, part in enumerate(([1, 2], [3, 4])):
        rows = B.readings(stream(spark, deliver(quarters, tmp_path / f"in{k}", part))).select(*READING.fieldNames(), *L.ARRIVAL)
        J.run_available(rows, sink, "append", f"{out}-state{k}")
    whole = B.readings(spark.read.parquet(*quarters)).select(*READING.fieldNames(), *L.ARRIVAL)
    assert same(J.latest_snapshot(spark, out), L.last_n(whole, ["zone_id"], L.ARRIVAL, 60))


def test_unreadable_history_is_an_error(spark, tmp_path):
    (tmp_path / "out" / "run=1-a" / "batch_id=0").mkdir(parents=True)
    (tmp_path / "out" / "run=1-a" / "batch_id=0" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        J.latest_snapshot(spark, str(tmp_path / "out"))


def test_second_checkpoint_keeps_the_first_runs_rows(spark, quarters, tmp_path):
    out = str(tmp_path / "out")
    for k, part in enumerate(([1, 2, 3], [4])):
        rows = B.readings(stream(spark, deliver(quarters, tmp_path / f"in{k}", part)))
        J.run_available(rows, table_sink(out), "append", f"{out}-state{k}")
    stored = J.read_versions(spark, out)
    assert same(stored.drop("run", "batch_id"), B.readings(spark.read.parquet(*quarters)))
    assert stored.select("run").distinct().count() == 2


def test_station_job_with_ids(spark, quarters, tmp_path):
    stations = R.station_rows()
    feed = B.raw_feed(stream(spark, deliver(quarters, tmp_path / "in", [1, 2, 3, 4])))
    rows = J.readings_stream(feed, stations)
    zones = J.zone_stream(rows, LENGTH, "1 hour", stations=stations, only_known=True)
    out = str(tmp_path / "out")
    J.run_available(zones, table_sink(out), "update", out + "-state", state_partitions=4)
    batch = Z.zone_window_agg(
        J.readings_stream(B.raw_feed(spark.read.parquet(*quarters)), stations), LENGTH
    )
    assert same(current_zone_windows(J.read_versions(spark, out)), batch)


def test_two_queries_end_together(spark, quarters, tmp_path):
    rows = B.readings(stream(spark, deliver(quarters, tmp_path / "in", [1, 2, 3, 4])))
    # A query that ended before, and one that is not waited for, do not matter.
    J.run_available(rows, table_sink(str(tmp_path / "e")), "append", str(tmp_path / "se"))
    other = J.start(rows, table_sink(str(tmp_path / "o")), "append", str(tmp_path / "so"))
    a = J.start(rows, table_sink(str(tmp_path / "a")), "append", str(tmp_path / "sa"), {"availableNow": True})
    b = J.start(rows, table_sink(str(tmp_path / "b")), "append", str(tmp_path / "sb"))
    try:
        J.await_any([a, b])
        assert not a.isActive and not b.isActive and other.isActive
        assert same(J.read_versions(spark, str(tmp_path / "a")).drop("run", "batch_id"), B.readings(spark.read.parquet(*quarters)))
    finally:
        other.stop()


def test_failure_of_one_query_is_raised_and_stops_the_other(spark, quarters, tmp_path):
    rows = B.readings(stream(spark, deliver(quarters, tmp_path / "in", [1])))

    def fails(batch, batch_id):
        raise RuntimeError("sink down")

    a = J.start(rows, table_sink(str(tmp_path / "a")), "append", str(tmp_path / "sa"))
    b = J.start(rows, fails, "append", str(tmp_path / "sb"))
    with pytest.raises(Exception, match="sink down"):
        J.await_any([a, b])
    assert not a.isActive and not b.isActive


def test_late_rows_of_all_batches(spark, quarters, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        _, query = zone_changelog(spark, deliver(quarters, tmp_path / "in", [4, 1, 2, 3]), str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    _, whole = zone_changelog(spark, deliver(quarters, tmp_path / "in2", [4, 1, 2, 3]), str(tmp_path / "out2"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert len(query.recentProgress) <= 2 and J.late_rows(query) == J.late_rows(whole) > 0


def test_service_of_many_stations(spark, quarters, tmp_path):
    stations = [s | {"sensor_id": f"{s['sensor_id']}-{k:02d}"} for s in R.station_rows()[:3] for k in range(67)]
    feed = B.raw_feed(stream(spark, deliver(quarters, tmp_path / "in", [1])))
    out, zones = str(tmp_path / "readings"), str(tmp_path / "zones")
    for q in start_service(feed, stations, [table_sink(out)], [table_sink(zones)], str(tmp_path / "state"), {"availableNow": True}, state_partitions=2):
        q.awaitTermination()
    batch = Z.zone_window_agg(J.readings_stream(B.raw_feed(spark.read.parquet(quarters[0])), stations))
    assert len(stations) == 201 and same(current_zone_windows(J.read_versions(spark, zones)), batch)


def test_feed_of_the_serving_side(spark, quarters, tmp_path):
    messages = to_payload(B.readings(spark.read.parquet(*quarters)), keep=L.ARRIVAL)
    messages.withColumns({"key": F.lit(None).cast("binary"), "value": F.col("value").cast("binary"), "topic": F.lit("r")}).select(
        *MESSAGE.fieldNames()).write.parquet(str(tmp_path / "topic"))
    feed = spark.readStream.schema(MESSAGE).parquet(str(tmp_path / "topic"))
    latest, history = str(tmp_path / "latest"), str(tmp_path / "history")
    for q in start_feed(feed, table_sink(latest), history, str(tmp_path / "state"), {"availableNow": True}, 60, 2):
        q.awaitTermination()
    rows = M.feed_ingest(spark.read.parquet(str(tmp_path / "topic")))
    last = keep_last(J.read_versions(spark, latest), ["zone_id"])
    assert same(last.drop("received_at"), L.latest_by_arrival(rows).drop("received_at"))
    assert same(J.latest_snapshot(spark, history).drop("received_at"), L.last_n(rows, ["zone_id"], L.ARRIVAL, 60).drop("received_at"))


def test_files_follow_size_not_tasks(spark, sf_dir, tmp_path):
    rows = B.readings(B.events(spark, sf_dir)).repartition(16)
    out, compacted = str(tmp_path / "out"), str(tmp_path / "compacted")
    days = rows.select(F.to_date("datetime")).distinct().count()
    for k in range(3):
        table_sink(out, event_date="datetime", created_at="created_at")(rows, k)
    assert len(glob.glob(f"{out}/run=*/batch_id=0/event_date=*/*.parquet")) <= 2 * days
    compact(spark, out, compacted, event_date="datetime")
    assert len(glob.glob(f"{compacted}/*/*/event_date=*/*.parquet")) <= 2 * days
    assert J.read_versions(spark, compacted).count() == 3 * rows.count()
    assert J.read_versions(spark, out).where("created_at IS NULL").isEmpty()


def test_rows_that_break_the_contract_reach_the_quarantine_only(spark, sf_dir, tmp_path, folder_database):
    rows = B.readings(B.events(spark, sf_dir)).select(*READING.fieldNames()).limit(20)
    poison = rows.withColumn("time", F.lit("12:00:00.123"))
    valid, refused = str(tmp_path / "valid"), str(tmp_path / "refused")
    sink = database_sinks(table_sink(valid), table_sink(refused), "jdbc:x", "r", {}, "reading")
    stored = multi_sink(sink, topic_sink("t", fmt="json", path=str(tmp_path / "topic")))(rows.unionByName(poison), 0)
    assert spark.read.parquet(folder_database).count() == spark.read.parquet(valid).count() == 20
    assert spark.read.parquet(refused).count() == 20 and stored is None or stored.count() == 40
    assert spark.read.json(str(tmp_path / "topic")).count() == 40
    zones = Z.zone_window_agg(B.readings(B.events(spark, sf_dir)), LENGTH).limit(3)
    long = zones.withColumn("zone_name", F.repeat(F.lit("z"), 101))
    out = str(tmp_path / "zones")
    split_sink("zone", table_sink(out, shape=Z.array_to_csv), table_sink(out + "-refused"))(zones.unionByName(long), 0)
    assert spark.read.parquet(out).count() == spark.read.parquet(out + "-refused").count() == 3


def test_empty_batch_reaches_no_sink(spark):
    def never(batch, batch_id):
        raise AssertionError("called")

    multi_sink(never)(spark.range(0), 0)


def test_kafka_connector_gets_its_options(spark, monkeypatch):
    seen = {}

    def fake_save(self, path=None, **kwargs):
        seen["saved"] = True

    monkeypatch.setattr(DataFrameWriter, "save", fake_save)
    topic_sink("zones", {"kafka.bootstrap.servers": "h:1"})(spark.range(1), 0)
    assert seen["saved"]
    with pytest.raises(Exception, match="kafka"):
        M.kafka_source(spark, "raw", {"kafka.bootstrap.servers": "h:1"})


@pytest.fixture
def folder_database(spark, monkeypatch, tmp_path):
    """Stands in for a database: jdbc reads and writes go to a folder. No driver runs."""
    path = str(tmp_path / "table")

    def fake_read(self, url, table, properties=None):
        where = table.split("WHERE")[1].split(")")[0]
        return spark.read.parquet(path).where(where)

    def fake_write(self, url, table, mode=None, properties=None):
        assert mode == "append"
        self.mode("append").parquet(path)

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_read)
    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_write)
    return path


def test_jdbc_sink_writes_what_a_failed_attempt_left_out(spark, folder_database):
    # Ten rows, each twice; the failed attempt committed some, one of them once.
    batch = spark.range(20).selectExpr("CAST(id % 10 AS STRING) AS sensor_id", "timestamp_ntz'2024-01-01' AS datetime")
    part = batch.where("sensor_id < '3'").unionByName(batch.where("sensor_id = '7'").limit(1))
    part.withColumn("batch", F.lit("1-a/5")).write.parquet(folder_database)
    sink = jdbc_sink("jdbc:x", "sensor_readings", {}, batch_column="batch")
    sink(batch, BatchId(5, "1-a"))
    sink(batch, BatchId(6, "1-a"))
    sink(batch, BatchId(5, "2-b"))  # the same number under another checkpoint
    stored = spark.read.parquet(folder_database)
    for label in ("1-a/5", "1-a/6", "2-b/5"):
        assert same(stored.where(F.col("batch") == label).drop("batch"), batch)


def test_jdbc_sink_of_zone_rows(spark, sf_dir, folder_database):
    zones = Z.zone_window_agg(B.readings(B.events(spark, sf_dir)), LENGTH)
    jdbc_sink("jdbc:x", "zone_averages", {}, shape=Z.to_zone_table)(zones, 0)
    assert same(spark.read.parquet(folder_database), Z.to_zone_table(zones))


def test_views(spark, sf_dir):
    rows = B.readings(B.events(spark, sf_dir))
    zones = Z.zone_measures(rows, LENGTH)
    twice = zones.withColumn("batch_id", F.lit(0).cast("bigint")).unionByName(
        zones.withColumn("batch_id", F.lit(1).cast("bigint"))
    )
    register_views(rows, twice)
    assert spark.table("latest_sensor_readings").columns == list(L.SENSOR_VIEW)
    assert spark.table("latest_zone_averages").columns == list(L.ZONE_VIEW)
    assert same(spark.table("daily_zone_stats"), Z.daily_zone_stats(zones))


def test_payload_keeps_columns_beside_the_message(spark):
    row = spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b, 'x' AS k")
    got = to_payload(row, key=F.col("k"), keep=["k"]).first()
    assert tuple(got) == ("x", '{"a":1}', "x")


def test_union_of_unlike_feeds(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS x")
    assert sorted(map(str, S.union_feeds(a, b).collect())) == ["Row(x=1, y=2)", "Row(x=3, y=None)"]


# --- state per key, dead letters, one evaluation


def test_keyed_history_changes_only_its_zones(spark, quarters, tmp_path):
    out, source, n = str(tmp_path / "out"), tmp_path / "in", 20
    whole = B.readings(spark.read.parquet(*quarters))
    schema = whole.schema

    def run():
        J.run_available(keyed_history(B.readings(stream(spark, str(source))), n), table_sink(out), "update", out + "-state", state_partitions=4)

    deliver(quarters, source, [3, 1])
    run()
    want = L.last_n(B.readings(spark.read.parquet(quarters[2], quarters[0])), ["zone_id"], L.ARRIVAL, n)
    assert same(read_history(spark, out, schema), want)
    # A restart goes on with the kept rows; the next files hold one zone and all zones.
    shutil.copy(quarters[1], source / "all.parquet")
    one = str(tmp_path / "one")
    spark.read.parquet(quarters[3]).where("event_type = 'view'").coalesce(1).write.parquet(one)
    shutil.copy(glob.glob(f"{one}/*.parquet")[0], source / "one.parquet")
    for k, name in enumerate(("one", "all")):
        os.utime(source / f"{name}.parquet", (1_800_000_000 + k, 1_800_000_000 + k))
    run()
    rest = spark.read.parquet(*quarters[:3]).unionByName(spark.read.parquet(one))
    assert same(read_history(spark, out, schema), L.last_n(B.readings(rest), ["zone_id"], L.ARRIVAL, n))
    versions = J.read_versions(spark, out)
    # The zone that all new rows of the third batch belong to is all that batch has written;
    # rows older than what is kept change nothing.
    third = versions.where("batch_id = 2").select("zone_id").distinct().collect()
    assert [r.zone_id for r in third] == ["view"]
    assert versions.where("batch_id = 1").isEmpty()
    assert versions.groupBy("batch_id", "zone_id").count().where(f"count > {n}").isEmpty()


def test_refused_messages_can_be_replayed(spark, quarters, tmp_path):
    feed = B.faulty_raw_feed(stream(spark, deliver(quarters, tmp_path / "in", [1, 2, 3, 4])))
    dead, out = str(tmp_path / "dead"), str(tmp_path / "out")
    stations = R.station_rows()
    J.run_available(feed, J.ingest_sink(dead, stations, table_sink(out)), "append", out + "-state")
    sent = B.faulty_raw_feed(spark.read.parquet(*quarters))
    refused = M.replay(J.dead_letters(spark, dead))
    assert refused.columns == MESSAGE.fieldNames() and 0 < refused.count() < sent.count()
    # What is refused and what is stored are together what was sent.
    stored = spark.read.parquet(out).count()
    assert stored == len(stations) * (sent.count() - refused.count())
    assert sent.select("value", "partition", "offset").exceptAll(refused.select("value", "partition", "offset")).count() * len(stations) == stored
    # Mended messages go through.
    mended = refused.withColumn("value", F.lit('{"date":"2024-01-01","time":"10:00:00","pm25_cf1":1}').cast("binary"))
    again, more = str(tmp_path / "again"), str(tmp_path / "more")
    J.ingest_sink(again, stations, table_sink(more))(mended, 0)
    assert J.dead_letters(spark, again).isEmpty() and spark.read.parquet(more).count() == len(stations) * refused.count()


@pytest.mark.parametrize("split", [True, False])
def test_a_batch_is_judged_once(spark, sf_dir, tmp_path, split):
    """Rows that would be judged otherwise the next time are neither lost nor there twice."""
    rows = B.readings(B.events(spark, sf_dir)).select(*READING.fieldNames())
    rows = rows.withColumn("zone_name", F.when(F.rand() < 0.5, F.col("zone_name")))
    if split:
        valid, refused = str(tmp_path / "valid"), str(tmp_path / "refused")
        stored = split_sink("reading", table_sink(valid), table_sink(refused))(rows, 0)
        halves = spark.read.parquet(valid), spark.read.parquet(refused)
        assert stored.count() == rows.count()
    else:
        path = str(tmp_path / "routed")
        assert routed_sink("reading", path)(rows, 0).columns == rows.columns
        halves = read_routed(spark, path), read_routed(spark, path, refused=True)
    ids = halves[0].select("sensor_id", "datetime").unionByName(halves[1].select("sensor_id", "datetime"))
    assert same(ids, rows.select("sensor_id", "datetime"))
    assert halves[0].where("zone_name IS NULL").isEmpty() and halves[1].where("zone_name IS NOT NULL").isEmpty()


def test_sensors_of_a_day_are_counted_exactly(spark, tmp_path):
    """More sensors of a zone and day than a sketch counts without error."""
    rows = spark.range(9000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id % 24 AS INT)) AS ts",
        "id * 7919 % 6007 AS user_id", "'view' AS event_type", "1.5D AS value", "'{\"k\": 1}' AS props",
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "rows"))
    os.makedirs(tmp_path / "in")
    shutil.copy(glob.glob(f"{tmp_path}/rows/*.parquet")[0], tmp_path / "in" / "events.parquet")
    found = QUERIES["stream_distinct_sensors"](spark, str(tmp_path / "in")).collect()
    assert [tuple(r) for r in found] == [("view", "2024-01-01", 6007)]


def test_history_state_gets_few_rows_of_a_zone(spark, sf_dir):
    """Before the shuffle every task leaves the rows of a zone that may be among its last n, in one batch or many."""
    rows = B.readings(B.events(spark, sf_dir)).repartition(3)
    nowhere = rows.limit(40).withColumn("zone_id", F.lit(None).cast("string"))
    timeless = rows.where("zone_id = 'view'").limit(40).withColumn("timestamp", F.lit(None).cast("timestamp"))
    entries = history.entries(rows.unionByName(nowhere).unionByName(timeless).coalesce(2), L.ARRIVAL)
    order = [F.desc_nulls_last(c) for c in ("arrived", "part", "place", "payload")]
    last = Window.partitionBy("zone_id").orderBy(*order)
    for n in (7, 100_000):
        cut = history.last_entries(entries, n, held_rows=500)
        assert cut.groupBy(F.spark_partition_id(), "zone_id").count().where(f"count > {n}").isEmpty()
        want = entries.withColumn("rank", F.row_number().over(last)).where(f"rank <= {n}")
        assert same(cut.withColumn("rank", F.row_number().over(last)).where(f"rank <= {n}"), want)


def test_a_large_batch_is_dealt_out_in_parts(spark, tmp_path, monkeypatch):
    """Rows go to their days a part at a time: all of them, each file in order, a retry leaves none twice."""
    from sensorgrid.sinks import writers

    monkeypatch.setattr(writers, "DEAL_ROWS", 150, raising=False)
    monkeypatch.setattr(writers, "FILE_ROWS", 40, raising=False)
    parts, settle = [], writers.settle
    monkeypatch.setattr(writers, "settle", lambda spark: (parts.append(1), settle(spark)))
    rows = spark.range(1000).repartition(4).selectExpr(
        "id", "cast(id % 7 as string) zone_id",
        "if(id % 50 = 0, null, timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(id % 3, 0, id % 11)) datetime",
    )
    sink = table_sink(str(tmp_path / "t"), event_date="datetime", sort_by=("zone_id", "datetime"))
    for _ in range(2):
        stored = sink(rows, 3)
        assert Counter(map(tuple, stored.drop("event_date").collect())) == Counter(map(tuple, rows.collect()))
    assert 2 * 7 <= len(parts) <= 2 * 16, len(parts)
    for file in glob.glob(f"{tmp_path}/t/*/*/event_date=*/*.parquet"):
        held = [(r["zone_id"], r["datetime"]) for r in spark.read.parquet(file).collect()]
        key = lambda x: (x[0], x[1] is not None, x[1] and x[1].isoformat())
        assert held == sorted(held, key=key)
    # A batch without rows gives a table without rows, and one part needs no clearing.
    parts.clear()
    assert sink(rows.where("id < 0"), 4).count() == 0 and sink(rows.where("id < 20"), 5).count() == 20 and not parts
    assert not glob.glob(f"{writers.new_path(spark, 'undealt').rpartition('undealt')[0]}undealt*")
