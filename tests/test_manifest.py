"""Tables whose readers see whole changes only, and changelogs merged batch by batch."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F
from test_operators import same

from sensorgrid.sinks.manifest import Manifest, committed_sink, read_committed
from sensorgrid.sinks.writers import BatchId, table_sink
from sensorgrid.streaming.changelog import keep_last, read_versions
from sensorgrid.streaming.compaction import merge_changes, read_merged


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def read(spark, path) -> set:
    return {(r.run, r.batch_id, r.v) for r in read_committed(spark, path).collect()}


def test_a_reader_during_a_retry_sees_the_old_or_the_new_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_committed(spark, path, rows(spark, 1).schema).isEmpty()
    sink = committed_sink(path)
    sink(rows(spark, 1, 2), BatchId(0, "1-a"))
    sink(rows(spark, 3), BatchId(1, "1-a"))
    old = {("1-a", 0, 1), ("1-a", 0, 2), ("1-a", 1, 3)}
    begun = read_committed(spark, path)
    # A second attempt that dies half way: its files lie there, and nobody sees them.
    dying = rows(spark, 7, 8).repartition(2).withColumn("v", F.when(F.col("v") == 8, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        sink(dying, BatchId(0, "1-a"))
    assert read(spark, path) == old
    sink(rows(spark, 5), BatchId(0, "1-a"))
    assert read(spark, path) == {("1-a", 0, 5), ("1-a", 1, 3)}
    # What was begun before goes on with what it has begun with.
    assert {r.v for r in begun.collect()} == {1, 2, 3}


def test_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    sink = committed_sink(path, keep=2)
    for k in range(6):
        sink(rows(spark, k), BatchId(k % 2, "1-a"))
    assert read(spark, path) == {("1-a", 0, 4), ("1-a", 1, 5)}
    assert len(Manifest(spark, path).versions()) == 2
    assert len(glob.glob(f"{path}/data/run=*/batch_id=*/attempt=*")) == 3


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    committed_sink(path)(rows(spark, 1), 0)
    late = Manifest(spark, path)
    monkeypatch.setattr(late, "versions", lambda: [])
    with pytest.raises(RuntimeError, match="another writer"):
        late.publish({}, {})
    assert read(spark, path) == {("0-direct", 0, 1)}


def changes(spark, *values):
    frame = spark.createDataFrame(list(values), "day string, k string, v int")
    return frame.select(F.col("day").cast("timestamp_ntz").alias("at"), "k", "v")


def test_merge_follows_new_batches(spark, tmp_path):
    log, base = str(tmp_path / "log"), str(tmp_path / "base")
    sink = table_sink(log)
    want = lambda: keep_last(read_versions(spark, log), ["at", "k"])
    sink(changes(spark, ("2024-01-01", "a", 1), ("2024-01-02", "a", 2), (None, "a", 3)), BatchId(0, "1-a"))
    sink(changes(spark, ("2024-01-01", "b", 4)), BatchId(1, "1-a"))
    assert merge_changes(spark, log, base, ["at", "k"], "at") == 2
    assert same(read_merged(spark, base), want())
    before = Manifest(spark, base).read()[0]
    # The next batches have rows of one old day and of a new one; the others' folders stay.
    sink(changes(spark, ("2024-01-02", "a", 5), ("2024-01-03", "c", 6)), BatchId(2, "1-a"))
    sink(changes(spark, ("2024-01-02", "a", 7)), BatchId(0, "2-b"))
    assert merge_changes(spark, log, base, ["at", "k"], "at") == 2
    after = Manifest(spark, base).read()[0]
    assert same(read_merged(spark, base), want())
    assert {d for d in after if after[d] != before.get(d)} == {"2024-01-02", "2024-01-03"}
    # Nothing new, nothing done.
    assert merge_changes(spark, log, base, ["at", "k"], "at") == 0
    assert Manifest(spark, base).read()[0] == after


def test_a_failed_merge_changes_nothing(spark, tmp_path, monkeypatch):
    log, base = str(tmp_path / "log"), str(tmp_path / "base")
    table_sink(log)(changes(spark, ("2024-01-01", "a", 1)), 0)
    merge_changes(spark, log, base, ["at", "k"], "at")
    table_sink(log)(changes(spark, ("2024-01-01", "a", 2)), 1)
    with monkeypatch.context() as m:
        m.setattr(Manifest, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            merge_changes(spark, log, base, ["at", "k"], "at")
    assert [r.v for r in read_merged(spark, base).collect()] == [1]
    assert merge_changes(spark, log, base, ["at", "k"], "at") == 1
    assert [r.v for r in read_merged(spark, base).collect()] == [2]
