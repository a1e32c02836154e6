"""What the operators share: tables, keys of documents, written intermediate results."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorgrid.session import new_path, remove_path, settle

BATCH_BYTES = "4194304b"
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts lineage: a lost executor costs no more than the tasks that read from
    here, and the optimizer knows the true size, so that it broadcasts a small
    table and shuffles a large one.
    """
    path = new_path(frame.sparkSession, label)
    frame.write.parquet(path)
    held = frame.sparkSession.read.schema(frame.schema).parquet(path)
    held.saved_at = path
    return held


def discard(*frames: DataFrame) -> None:
    """Deletes tables that ``saved`` has written, once nothing will be read from them again."""
    for frame in frames:
        remove_path(frame.sparkSession, frame.saved_at)
    if frames:
        settle(frames[0].sparkSession)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until the frame has no column of theirs."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def set_aside(frame: DataFrame, prefix: str) -> tuple[DataFrame, list[Column]]:
    """The frame with columns of that prefix under other names, and what selects them under their own again."""
    names = {c: fresh(frame, f"own_{c}")[0] for c in frame.columns if c.lower().startswith(prefix)}
    back = [F.col(names[c]).alias(c) if c in names else F.col(c) for c in frame.columns]
    return frame.withColumnsRenamed(names), back


def text_digest(text: str = "text") -> Column:
    """128 bits that stand for a text; a null text counts as an empty one."""
    return F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"))


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of the columns in which two nulls are equal."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def utf8_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


def arrow_map(
    frame: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` whose tasks can import this package.

    Batches are limited to ``BATCH_BYTES``, for this session, as a task holds a batch
    and what it makes of it, on the JVM's side too.
    """
    _ship(frame.sparkSession)
    conf = frame.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) != BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return frame.mapInArrow(task, schema)


def _ship(spark: SparkSession) -> None:
    """Hands the package to Spark once per application; executors fetch it from the driver."""
    context = spark.sparkContext
    if getattr(context, "_sensorgrid_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    name = os.path.join(tempfile.mkdtemp(prefix="sensorgrid-"), "sensorgrid.zip")
    with zipfile.ZipFile(name, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(name)
    context._sensorgrid_shipped = True
