"""Lists of what belongs to a table, published as a whole: readers see a change entirely or not at all.

A table is a folder with ``data`` and ``_manifest``. Every write goes to a new folder below
``data``; a version of the manifest then says which folders make the table. A version is
written under another name and renamed, so it is there whole or not there, and the
highest one holds. Folders are never changed: a reader goes on with what its version
names, also while a batch is written anew or a partition is merged.

One writer at a time; a second one that publishes the same version is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sensorgrid.session import remove_path
from sensorgrid.sinks.writers import BatchId, Sink

_DIGITS = 12


class Manifest:
    """The versions of one table's list: names of its parts and the folder of each, and notes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._files = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._paths.Path(path)

    def versions(self) -> list[int]:
        folder = self._at(f"{self.path}/_manifest")
        if not self._files.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version: int | None = None) -> tuple[dict[str, str], dict]:
        """(folder of each part, notes) of a version, by default the highest; empty before the first."""
        kept = self.versions()
        if not kept:
            return {}, {}
        file = f"{self.path}/_manifest/{kept[-1] if version is None else version:0{_DIGITS}d}.json"
        told = json.loads("".join(r[0] for r in self.spark.read.text(file, wholetext=True).collect()))
        return told["parts"], told["notes"]

    def new_folder(self, name: str) -> str:
        return f"data/{name}/attempt={uuid.uuid4().hex}"

    def publish(self, parts: dict[str, str], notes: dict) -> int:
        """Writes the next version."""
        kept = self.versions()
        version = kept[-1] + 1 if kept else 0
        target = f"{self.path}/_manifest/{version:0{_DIGITS}d}.json"
        draft = f"{target}.{uuid.uuid4().hex}"
        self._files.mkdirs(self._at(f"{self.path}/_manifest"))
        out = self._files.create(self._at(draft), False)
        out.write(bytearray(json.dumps({"parts": parts, "notes": notes}), "utf8"))
        out.close()
        if self._files.exists(self._at(target)) or not self._files.rename(self._at(draft), self._at(target)):
            self._files.delete(self._at(draft), False)
            raise RuntimeError(f"another writer has published version {version} of {self.path}")
        return version

    def expire(self, keep: int) -> None:
        """Removes versions but the last ``keep``, and folders that none of these names."""
        kept = self.versions()
        old, rest = kept[:-keep], kept[-keep:]
        named = {f for v in rest for f in self.read(v)[0].values()}
        gone = {f for v in old for f in self.read(v)[0].values()} - named
        for folder in gone:
            remove_path(self.spark, f"{self.path}/{folder}")
        for version in old:
            remove_path(self.spark, f"{self.path}/_manifest/{version:0{_DIGITS}d}.json")


def committed_sink(
    path: str, shape: Callable[[DataFrame], DataFrame] | None = None, keep: int = 16
) -> Sink:
    """A Parquet table of batches whose readers never see half of one.

    A batch that is written again gets a folder of its own, which replaces the earlier one
    in the list when it is whole. Folders stay as long as one of the last ``keep`` versions
    names them.
    """

    def write(batch: DataFrame, batch_id: int) -> DataFrame:
        rows = shape(batch) if shape else batch
        manifest, label = Manifest(batch.sparkSession, path), BatchId.of(batch_id).folder
        folder = manifest.new_folder(label)
        rows.write.parquet(f"{path}/{folder}")
        parts, notes = manifest.read()
        manifest.publish({**parts, label: folder}, notes)
        manifest.expire(keep)
        return batch.sparkSession.read.schema(rows.schema).parquet(f"{path}/{folder}")

    write.stores = not shape
    return write


def read_committed(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table as its last version lists it, with ``run`` and ``batch_id``; no rows of ``schema`` before the first."""
    parts, _ = Manifest(spark, path).read()
    if not parts:
        if schema is None:
            raise ValueError(f"nothing is committed in {path}")
        return spark.createDataFrame([], schema)
    return folders(spark, path, list(parts.values())).drop("attempt")


def folders(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    rows = spark.read.option("basePath", f"{path}/data").parquet(*[f"{path}/{n}" for n in names])
    kinds = {"run": "string", "batch_id": "bigint"}
    return rows.withColumns({c: rows[c].cast(k) for c, k in kinds.items() if c in rows.columns})
