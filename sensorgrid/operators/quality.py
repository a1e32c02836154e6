"""Table contracts as row checks: required columns and text lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.fixed_values import (
    RAW_COUNT_FIELDS,
    RAW_TEXT_FIELDS,
    READING_REQUIRED,
    READING_TEXT_LENGTHS,
    ZONE_REQUIRED,
    ZONE_TEXT_LENGTHS,
)


def _violations(required: tuple[str, ...], lengths: dict[str, int]) -> list[Column]:
    missing = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    too_long = [
        F.when(F.char_length(c) > size, F.lit(f"{c} longer than {size}"))
        for c, size in lengths.items()
    ]
    return missing + too_long


def _nothing_parsed(columns: list[str]) -> list[Column]:
    empty = F.coalesce(*[F.col(c).cast("string") for c in RAW_TEXT_FIELDS + RAW_COUNT_FIELDS]).isNull()
    no_time = F.col("datetime").isNull()
    reasons = [
        F.when(empty, F.lit("no field parsed")),
        F.when(~empty & no_time, F.lit("no event time")),
    ]
    # Known where the messages are carried along; a field of another type alone is no reason.
    return reasons + [F.when((empty | no_time) & F.col("malformed"), F.lit("malformed text"))] * ("malformed" in columns)


def check_rows(df: DataFrame, contract: str) -> DataFrame:
    """Adds ``reasons``: why a row breaks the contract (empty when it does not).

    Contracts: ``raw`` (ingested raw records), ``reading`` and ``zone`` (the two
    tables).
    """
    checks = {
        "raw": lambda: _nothing_parsed(df.columns),
        "reading": lambda: _violations(READING_REQUIRED, READING_TEXT_LENGTHS),
        "zone": lambda: _violations(ZONE_REQUIRED, ZONE_TEXT_LENGTHS),
    }[contract]()
    return df.withColumn("reasons", F.array_compact(F.array(*checks)))


def dq_split(df: DataFrame, contract: str) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the contract, and the others with their ``reasons``."""
    checked = check_rows(df, contract)
    return (
        checked.where(F.size("reasons") == 0).drop("reasons"),
        checked.where(F.size("reasons") > 0),
    )
