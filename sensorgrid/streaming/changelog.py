"""Tables that hold several versions of a row, one per run and micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.operators.latest import latest_by

VERSION = ("run", "batch_id")


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """A table written batch by batch, with its ``run`` and ``batch_id``."""
    rows = spark.read.parquet(path)
    return rows.withColumns({"run": F.col("run").cast("string"), "batch_id": F.col("batch_id").cast("bigint")})


def keep_last(
    changelog: DataFrame, keys: Sequence[str], version: Sequence[str] = VERSION, lazy: bool = False
) -> DataFrame:
    """The newest version of every row: of the latest run, in it of the latest batch."""
    order = [c for c in version if c in changelog.columns]
    rest = [c for c in changelog.columns if c not in order]
    return latest_by(changelog, keys, order, [*rest, *order], lazy).drop(*order)
