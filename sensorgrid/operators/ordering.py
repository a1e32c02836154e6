"""Global order and row numbers without a single-task step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sensorgrid.session import new_path

POSITION_BITS = 33


def sort_by_time(df: DataFrame, col: str = "datetime", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Ascending by time: range-partitioned, so files in name order are sorted.

    Rows that tie keep the order they are scanned in. Their place in the scan is
    the last sort key, so that many rows of one time, even whole copies, are
    split across tasks. A scan that runs again gives the same places; for other
    frames write the table first.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    return placed.orderBy(col, *tiebreak, "_place").drop("_place")


def with_row_index(sorted_df: DataFrame, name: str = "row_index") -> DataFrame:
    """Numbers the rows of a sorted frame from 0 in their order.

    The sorted rows are written once with their partition and position, which
    fixes both against a re-run of the sort after a lost executor. A row's number
    is its position plus the row counts of earlier partitions.
    """
    spark = sorted_df.sparkSession
    path = new_path(spark, "sorted")
    sorted_df.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND((1 << POSITION_BITS) - 1).alias("_pos"),
    ).write.parquet(path)

    rows = spark.read.parquet(path)
    # One row per partition of the sort: as many as the shuffle has partitions.
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(offsets), "_part").select(
        *sorted_df.columns, (F.col("_before") + F.col("_pos")).alias(name)
    )
