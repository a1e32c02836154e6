"""CSV with a header line, as one file or a folder of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# Quotes inside a quoted field are doubled, as most CSV writers do.
OPTIONS = {
    "header": "true",
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def csv_scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Typed rows; a malformed line fails the read.

    Without ``schema`` the types are inferred, which costs one more pass.
    """
    reader = spark.read.options(**OPTIONS).option("mode", "FAILFAST")
    if schema is None:
        return reader.option("inferSchema", "true").option("preferDate", "false").csv(path)
    return reader.schema(schema).csv(path)
