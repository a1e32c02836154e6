"""A changelog merged into a table of newest versions, batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.sinks.manifest import Manifest, folders
from sensorgrid.streaming.changelog import VERSION, keep_last, read_versions


def merge_changes(
    spark: SparkSession, path: str, base: str, keys: Sequence[str], time: str, keep: int = 16
) -> int:
    """Merges the changelog's new batches into ``base``; returns how many batches these were.

    ``base`` has one row per key, kept by the day of ``time``, one of the keys. Only batches
    behind the last merged one are read, and of ``base`` only the days that these have rows
    of are rewritten, so the cost follows the new batches. The days' new folders and the
    last merged batch are published together: a merge that fails leaves ``base`` as it was,
    and one that is repeated finds nothing to do.

    Rows whose ``time`` is null are a day of their own.
    """
    manifest = Manifest(spark, base)
    parts, notes = manifest.read()
    rows = read_versions(spark, path)
    upto = notes.get("upto")
    if upto:
        later = (F.col("run") > upto[0]) | ((F.col("run") == upto[0]) & (F.col("batch_id") > upto[1]))
        rows = rows.where(later)
    # Partition columns only: as many rows as there are new batches.
    fresh = sorted(tuple(r) for r in rows.select(*VERSION).distinct().collect())
    if not fresh:
        return 0
    day = F.coalesce(F.to_date(time).cast("string"), F.lit("none"))
    new = rows.withColumn("_day", day)
    days = sorted(r[0] for r in new.select("_day").distinct().collect())
    held = [parts[d] for d in days if d in parts]
    if held:
        before = folders(spark, base, held).drop("attempt", "day").withColumn("_day", day)
        new = new.unionByName(before, allowMissingColumns=True)
    merged = keep_last_with_version(new, [*keys, "_day"])
    label = f"merge={len(manifest.versions()):06d}"
    folder = manifest.new_folder(label)
    merged.withColumnRenamed("_day", "day").hint("rebalance", "day").write.partitionBy("day").parquet(f"{base}/{folder}")
    parts |= {d: f"{folder}/day={d}" for d in days}
    manifest.publish(parts, {"upto": list(fresh[-1])})
    manifest.expire(keep)
    return len(fresh)


def keep_last_with_version(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keep_last`` whose rows still have their version, so that they can be merged again."""
    version = [c for c in rows.columns if c in VERSION]
    kept = rows.withColumns({f"_{c}": F.col(c) for c in version})
    return keep_last(kept, keys).withColumnsRenamed({f"_{c}": c for c in version})


def read_merged(spark: SparkSession, base: str) -> DataFrame:
    """One row per key: the newest version of those batches that are merged."""
    parts, _ = Manifest(spark, base).read()
    return folders(spark, base, list(parts.values())).drop("attempt", "day", "merge", *VERSION)
