from __future__ import annotations

import glob
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sensorgrid.operators import enrich as E, latest as L, registry as R, zones as Z
from sensorgrid.operators.fanout import station_fanout
from sensorgrid.operators.ordering import sort_by_time, with_row_index
from sensorgrid.operators.quality import dq_split
from sensorgrid.plans import bindings as B, serving as S
from sensorgrid.schemas import READING, STATION, ZONE_WINDOW
from sensorgrid.sinks.writers import write_csv
from sensorgrid.sources import messages as M
from sensorgrid.sources.csv_files import csv_scan
from sensorgrid.streaming.changelog import keep_last


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return M.ingest_json(B.raw_feed(B.events(spark, sf_dir)))


@pytest.fixture(scope="module")
def readings(spark, sf_dir):
    return B.readings(B.events(spark, sf_dir)).cache()


# --- registry and fan-out


def test_network_shapes_agree(spark):
    flat = R.registry_flatten(R.network_frame(spark))
    assert same(flat, R.registry_table(spark)) and flat.count() == 14
    assert R.registry_summary(flat).first().total_zones == 5


def test_fanout_of_a_large_registry_equals_the_inline_one(spark, sf_dir, raw):
    registry = R.registry_flatten(B.networks(spark, sf_dir))
    inline = station_fanout(raw, registry)
    blocks = station_fanout(raw, registry, max_bytes=0, block=3)
    assert inline.count() == raw.count() * registry.count()
    assert same(inline, blocks)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fanout_needs_stations(spark, raw):
    with pytest.raises(ValueError):
        station_fanout(raw, [])
    assert station_fanout(raw, spark.createDataFrame([], STATION)).isEmpty()


def test_enrich_shape_and_bounds(spark, raw):
    rows = E.enrich(raw, R.station_rows())
    assert rows.columns == READING.fieldNames()
    assert [f.dataType for f in rows.schema] == [f.dataType for f in READING]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


def test_jitter_stays_within_variability_and_replays(spark, raw):
    rows = E.time_flags(station_fanout(raw, R.station_rows()))
    plain, noisy = E.station_factor(rows), E.station_factor(rows, seed=5)
    both = noisy.withColumnRenamed("total_factor", "noisy")
    both = E.station_factor(both).withColumn("ratio", F.col("noisy") / F.col("total_factor"))
    assert both.where(F.abs(F.col("ratio") - 1) > F.col("variability") + 1e-9).isEmpty()
    assert both.where("ratio > 1.01").count() > 0 and both.where("ratio < 0.99").count() > 0
    assert same(noisy, E.station_factor(rows, seed=5)) and not same(noisy, plain)


def test_reading_contract(spark, readings):
    valid, bad = dq_split(readings.withColumn("zone_id", F.expr("nullif(zone_id, 'view')")), "reading")
    assert valid.count() + bad.count() == readings.count()
    assert {tuple(r.reasons) for r in bad.collect()} == {("zone_id is null",)}


# --- zone windows


def test_zone_window_columns(readings):
    zones = Z.zone_window_agg(readings, "1 hour")
    assert zones.columns == ZONE_WINDOW.fieldNames()
    bad = "min_pm2_5 > avg_pm2_5 + 0.05 OR avg_pm2_5 > max_pm2_5 + 0.05 OR size(sensor_ids) <> active_sensors"
    assert zones.where(bad).isEmpty()


def hot(spark):
    """90 % of all readings in one window of one zone, many of one sensor."""
    return spark.range(5000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE CAST(id % 400 AS STRING) END AS sensor_id",
        "CASE WHEN id % 10 = 0 THEN 'b' ELSE 'a' END AS zone_id", "'z' AS zone_name",
        "CAST(1 AS DOUBLE) AS latitude", "CAST(2 AS DOUBLE) AS longitude",
        "timestamp_ntz'2024-01-01 00:00:00' AS datetime",
        "CAST(1 AS DOUBLE) AS pm1_0_atm", "CAST(id % 7 AS DOUBLE) AS pm2_5_atm", "CAST(3 AS DOUBLE) AS pm10_atm",
        "CAST(id % 7 AS INT) AS aqi", "CAST(99 AS DOUBLE) AS air_quality_percent",
    )


def test_hot_window_lists_every_reading(spark):
    rows = hot(spark)
    want = Counter((r.zone_id, r.sensor_id) for r in rows.where("sensor_id IS NOT NULL").collect())
    known = [{"zone_id": z, "sensor_id": s} for z, s in want]
    few = [{"zone_id": "a", "sensor_id": "hot"}, {"zone_id": "a", "sensor_id": "never seen"}]
    for zones in (Z.zone_window_agg(rows), Z.zone_window_agg(rows, stations=known), Z.zone_window_agg(rows, stations=few)):
        zones = {r.zone_id: r for r in zones.collect()}
        for zone, r in zones.items():
            assert Counter(r.sensor_ids) == Counter({s: n for (z, s), n in want.items() if z == zone})
            assert r.sensor_ids == sorted(r.sensor_ids) and len(r.sensor_ids) == r.active_sensors
        assert zones["a"].active_sensors > 1000 and zones["b"].sensor_ids == ["hot"] * 500
    members = Z.zone_window_sensors(rows).collect()
    assert {(r.zone_id, r.sensor_id): r.readings for r in members} == want


def test_windows_of_the_registered_query_are_above_a_thousand(spark, sf_dir):
    from sensorgrid.plans.registered import QUERIES

    assert QUERIES["zone_window_agg_days"](spark, "/root/testdata/sf0.01").where("active_sensors > 1000").count() > 5


def test_missing_names_group_and_missing_times_drop(spark):
    rows = hot(spark).withColumn("zone_name", F.lit(None).cast("string"))
    assert Z.zone_window_agg(rows).where("zone_name IS NULL AND sensor_ids[0] = 'hot'").count() == 1
    assert Z.zone_window_agg(rows.withColumn("datetime", F.lit(None).cast("timestamp_ntz"))).isEmpty()


def test_station_counters_equal_the_list(raw):
    stations = R.station_rows()
    rows = E.enrich(raw, stations)
    whole = Z.zone_window_agg(rows, "1 hour")
    counted = Z.zone_window_agg(rows, "1 hour", stations, only_known=True)
    assert same(counted, whole)
    assert plan(counted).count("hashpartitioning") == 1
    # Unknown sensors, and ids that are named twice, change nothing.
    assert same(Z.zone_window_agg(rows, "1 hour", stations[3:] + stations[5:]), whole)
    with pytest.raises(Exception, match="no known station"):
        Z.zone_window_agg(rows, "1 hour", stations[1:], only_known=True).collect()


def test_zones_with_more_stations_than_counters(raw):
    stations = [s | {"sensor_id": f"{s['sensor_id']}-{k:03d}"} for s in R.station_rows()[:2] for k in range(101)]
    rows = E.enrich(raw.limit(40), stations)
    whole = Z.zone_window_agg(rows, "1 day")
    assert same(Z.zone_window_agg(rows, "1 day", stations, only_known=True), whole)
    assert whole.agg(F.max("active_sensors")).first()[0] > 1000


def test_unknown_sensor_is_an_error_however_many_stations(raw, monkeypatch):
    stations = R.station_rows()
    rows = E.enrich(raw, stations)
    stray = rows.limit(1).withColumn("sensor_id", F.lit("nobody"))
    for counters in (64, 2, 0):
        monkeypatch.setattr(Z, "COUNTERS_PER_ZONE", counters)
        known = Z.zone_window_agg(rows, "1 hour", stations, only_known=True)
        assert same(Z.array_to_csv(known), Z.array_to_csv(Z.zone_window_agg(rows, "1 hour")))
        with pytest.raises(Exception, match="no known station"):
            Z.zone_window_agg(rows.unionByName(stray), "1 hour", stations, only_known=True).collect()
        assert Z.zone_window_agg(rows.unionByName(stray), "1 hour", stations).where("array_contains(sensor_ids, 'nobody')").count() == 1


def test_sensor_sketches_merge_within_their_error(spark):
    """Thousands of sensors; the error bound is five standard errors."""
    n = 20_000
    rows = spark.range(3 * n).selectExpr(
        f"CAST(id % {n} AS STRING) AS sensor_id", "'z' AS zone_id", "'Z' AS zone_name",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id % 24 AS INT)) AS datetime",
    ).unionByName(spark.sql("SELECT NULL, 'z', 'Z', timestamp_ntz'2024-01-01'").toDF("sensor_id", "zone_id", "zone_name", "datetime"))
    sketches = Z.sensor_sketches(rows, "1 hour")
    assert sketches.select(F.max(F.octet_length("sensors"))).first()[0] < 5000
    day = Z.distinct_sensors(sketches, "zone_id").first()["distinct_sensors"]
    assert abs(day - n) < 5 * 0.0163 * n
    few = Z.sensor_sketches(rows.where("CAST(sensor_id AS INT) < 400"), "1 hour")
    assert abs(Z.distinct_sensors(few, "zone_id").first()["distinct_sensors"] - 400) <= 1


def test_zone_table_types(readings):
    types = dict(Z.to_zone_table(Z.zone_window_agg(readings)).dtypes)
    assert types["active_sensors"] == types["avg_aqi"] == "int"
    assert types["sensor_ids_str"] == "string" and "sensor_ids" not in types


# --- latest and last rows


def test_last_n_of_a_hot_key_equals_brute_force(spark):
    rows = spark.range(20000).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 'hot' ELSE CAST(id % 11 AS STRING) END AS zone_id",
        "CASE WHEN id % 97 > 0 THEN timestamp_seconds((id * 7919) % 20011) END AS timestamp",
        "CAST(id % 4 AS INT) AS partition", "id AS offset",
    )
    lowest = -1
    by_zone = defaultdict(list)
    for r in rows.collect():
        by_zone[r.zone_id].append((r.timestamp.timestamp() if r.timestamp else lowest, r.partition, r.offset))
    for n in (1, 10, 500):
        want = {(z, o) for z, v in by_zone.items() for _, _, o in sorted(v, reverse=True)[:n]}
        plain = L.last_n(rows, ["zone_id"], L.ARRIVAL, n)
        assert {(r.zone_id, r.offset) for r in plain.collect()} == want
        assert same(S.kept_history(rows, n, L.ARRIVAL), plain)
    newest = {(z, max(v)[2]) for z, v in by_zone.items()}
    assert {(r.zone_id, r.offset) for r in S.latest_of_zones(rows, L.ARRIVAL).collect()} == newest


@pytest.mark.parametrize("few", [100_000, 0])
def test_latest_row_of_any_key_and_order(spark, monkeypatch, few):
    """Hot keys, ties of any length, nulls, texts in the order; by either way the same."""
    monkeypatch.setattr(L, "FEW_KEYS", few)
    rows = spark.range(5000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE CAST(id % 40 AS STRING) END AS k",
        "CASE WHEN id % 7 > 0 THEN CONCAT('run', id % 3) END AS run", "CASE WHEN id % 11 > 0 THEN id % 5 END AS a",
        "CASE WHEN id % 40 = 5 THEN NULL ELSE CAST(id * 7919 % 5003 AS INT) END AS b", "id AS v",
    )
    for order in (["a", "b", "v"], ["run", "a", "b", "v"], ["b", "v"], ["run", "v"]):
        best: dict = {}
        for r in rows.collect():
            rank = tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in order)
            if r.k not in best or rank > best[r.k][0]:
                best[r.k] = rank, r.v
        got = L.latest_by(rows, ["k"], order)
        assert got.columns == rows.columns and {r.k: r.v for r in got.collect()} == {k: v for k, (_, v) in best.items()}
        lazy = L.latest_by(rows, ["k"], order, ["k", "v"], lazy=True)
        assert {tuple(r) for r in lazy.collect()} == {(k, v) for k, (_, v) in best.items()}
    assert L.latest_by(rows.limit(0), ["k"], ["a"]).isEmpty()
    # Whole ties give one row, and texts alone as order work too.
    assert L.latest_by(spark.range(9).selectExpr("'k' AS k", "1 AS a"), ["k"], ["a"]).count() == 1
    assert L.latest_by(rows, ["k"], ["run"]).select("k").distinct().count() == len(best)


def test_tail_keeps_whole_history_of_short_zones(spark):
    rows = spark.sql(
        "SELECT 'old' AS zone_id, timestamp'2020-01-01' AS timestamp, 0 AS partition, 0L AS offset "
        "UNION ALL SELECT 'none', CAST(NULL AS TIMESTAMP), 0, 1L "
        "UNION ALL SELECT 'new', timestamp'2024-01-01' + make_dt_interval(0, id), 0, id FROM range(100)"
    )
    kept = S.kept_history(rows, 5, L.ARRIVAL).groupBy("zone_id").count().collect()
    assert {r.zone_id: r["count"] for r in kept} == {"old": 1, "none": 1, "new": 5}


def test_keep_last(spark):
    log = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 3, 0), ("a", 9, 2)], "k string, v int, batch_id bigint")
    assert {tuple(r) for r in keep_last(log, ["k"]).collect()} == {("a", 9), ("b", 3)}


def test_newest_version_is_of_the_latest_run(spark):
    log = spark.createDataFrame([("a", 1, "1-x", 9), ("a", 2, "2-y", 0), ("b", 3, "1-x", 4)], "k string, v int, run string, batch_id bigint")
    assert {tuple(r) for r in keep_last(log, ["k"]).collect()} == {("a", 2), ("b", 3)}


def test_empty_zone_name_is_no_filter(readings):
    from sensorgrid.plans.registered import AS_OF

    assert same(S.measurements_list(readings, AS_OF, "", hours=None), S.measurements_list(readings, AS_OF, None, hours=None))


def test_a_dead_zone_does_not_hold_the_others_back(spark):
    rows = spark.range(5000).selectExpr(
        "'busy' AS zone_id", "timestamp'2024-01-01' + make_dt_interval(0, id) AS timestamp", "0 AS partition", "id AS offset"
    ).unionByName(spark.sql("SELECT 'dead' AS zone_id, timestamp'2020-01-01' AS timestamp, 0 AS partition, 7L AS offset"))
    kept = L.tail(rows, ["zone_id"], "timestamp", 10).groupBy("zone_id").count().collect()
    assert {r.zone_id: r["count"] for r in kept} == {"busy": 10, "dead": 1}


# --- order


def test_row_index_follows_the_order_and_splits_ties(spark):
    # Two thirds of all rows share one time; the tiebreak keeps them apart.
    rows = spark.range(30000).selectExpr(
        "(id * 7919) % 30011 AS n",
        "CASE WHEN id % 3 < 2 THEN timestamp_ntz'2024-01-01' ELSE timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id - 15000) END AS datetime",
    )
    got = with_row_index(sort_by_time(rows, tiebreak=["n"])).orderBy("row_index").collect()
    assert [r.row_index for r in got] == list(range(30000))
    keys = [(r.datetime, r.n) for r in got]
    assert keys == sorted(keys)


def test_copies_are_split_across_tasks(spark, tmp_path):
    rows = spark.range(60000).selectExpr(
        "CASE WHEN id % 3 < 2 THEN timestamp_ntz'2024-01-01' ELSE timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id - 30000) END AS datetime"
    )
    rows.write.parquet(str(tmp_path / "rows"))
    ordered = sort_by_time(spark.read.parquet(str(tmp_path / "rows")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
        written = str(tmp_path / "sorted")
        write_csv(ordered, written)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 60000 and max(sizes) < 15000
    times = []
    for file in sorted(glob.glob(f"{written}/*.csv")):
        times += [r.datetime for r in csv_scan(spark, file, "datetime timestamp_ntz").collect()]
    assert times == sorted(times) and len(times) == 60000


# --- serving


def test_serving_of_unknown_zone_is_empty(readings, sf_dir):
    from sensorgrid.plans.registered import AS_OF

    assert S.zone_history(readings, AS_OF, "nowhere").isEmpty()
    assert S.measurements_list(readings, AS_OF, "nowhere").isEmpty()


def test_page_is_newest_first(readings):
    from sensorgrid.plans.registered import AS_OF

    times = [r.datetime for r in S.measurements_list(readings, AS_OF, hours=None).collect()]
    assert len(times) == 100 and times == sorted(times, reverse=True)
    assert S.measurements_list(readings, AS_OF, hours=0).where(F.col("datetime") < F.lit(AS_OF)).isEmpty()


# --- plans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, readings, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "readings")
    readings.withColumn("event_date", F.to_date("datetime")).write.partitionBy("event_date").parquet(path)
    return spark.read.parquet(path)


def test_ranks_are_cut_off_before_the_shuffle(table):
    text = plan(L.last_n(table, ["zone_id"], L.ARRIVAL, 500))
    assert text.count("WindowGroupLimit") == 4 and text.count("Partial") == 2
    assert plan(Z.zone_window_agg(table)).count("FileScan") == 1


def test_latest_rows_are_not_sorted_below_the_shuffle(table):
    """One pruned pass finds the newest, one scan picks the rows; wide rows are neither sorted nor all sent."""
    text = plan(S.zones_list(table))
    assert "SortAggregate" not in text and "BroadcastHashJoin" in text and "WindowGroupLimit" in text
    assert text.count("FileScan") == 2 and text.count("Exchange hashpartitioning") == 1
    first, leading = L.newest_per_key(table, ["zone_id"], L.ARRIVAL)
    text = plan(first)
    assert leading == ["timestamp"] and "SortAggregate" not in text and "aqi" not in text.split("ReadSchema")[1]


def test_cut_offs_reach_the_scan(table):
    text = plan(S.kept_history(table, 5, L.ARRIVAL))
    assert text.count("FileScan") == 2
    assert "GreaterThanOrEqual(timestamp" in text


def test_aggregates_stay_in_hash_aggregation(table):
    text = plan(Z.zone_measures(table))
    assert "partial_count" in text and "SortAggregate" not in text and "ObjectHash" not in text
    assert text.count("Exchange") == 1


def test_top_page_needs_no_full_sort(table):
    from sensorgrid.plans.registered import AS_OF

    assert "TakeOrderedAndProject" in plan(S.measurements_list(table, AS_OF))


def test_period_prunes_days_and_columns(table):
    from sensorgrid.plans.registered import AS_OF

    text = table.select("zone_id", "datetime", "event_date")
    text = S.recent(text, AS_OF, 24).groupBy("zone_id").count()._jdf.queryExecution().toString()
    assert "event_date" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(datetime" in text.split("PushedFilters: [")[1]
    assert "pm2_5_atm" not in text.split("ReadSchema")[1]
