"""The last rows per key as state of a stream: a batch touches only the keys it has rows of."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from sensorgrid.fixed_values import HISTORY_SIZE
from sensorgrid.operators.latest import ARRIVAL
from sensorgrid.streaming.changelog import VERSION, read_versions

_ENTRY = "arrived long, part int, place long, payload string"
_ORDER = ("arrived", "part", "place", "payload")
#: Rows that a task gathers before it cuts them to the last of every key.
HELD_ROWS = 50_000
_FORMATS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _processor(n: int) -> StatefulProcessor:
    # Defined here, so that tasks get the class itself and need no module of this package.
    import pandas as pd

    order = list(_ORDER)

    class LastRows(StatefulProcessor):
        """A list of the last ``n`` rows of a key, newest first."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.kept = handle.getListState("kept", _ENTRY)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            held = pd.DataFrame([tuple(r) for r in self.kept.get()], columns=order)
            before = list(held.itertuples(index=False, name=None))
            for part in rows:
                part = part[order]
                held = part if held.empty else pd.concat([held, part])
                # Cut after each part, so memory holds n rows and one part. A missing time comes last.
                held = held.sort_values(order, ascending=False, kind="stable").head(n)
            entries = [tuple(None if pd.isna(v) else v for v in r) for r in held.itertuples(index=False, name=None)]
            entries = [(None if a is None else int(a), int(b), int(c), d) for a, b, c, d in entries]
            if entries != before:
                self.kept.put(entries)
                yield pd.DataFrame({"zone_id": [key[0]] * len(entries), "payload": [e[3] for e in entries]})

        def close(self) -> None:
            pass

    return LastRows()


def keyed_history(rows: DataFrame, n: int = HISTORY_SIZE, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """(zone_id, payload) of the last ``n`` rows of every zone that a batch changes; for update mode.

    State is one list of ``n`` rows per zone. A zone without new rows is neither read nor
    written, and one whose new rows are all older than what it keeps gives no output.
    Before they are sent to their zone's task, every task of a batch cuts its rows to the
    last ``n`` of each zone, so a zone's task gets ``n`` rows from each at most.
    ``payload`` is the whole row as JSON; ``history_table`` reads it back. ``order`` is a
    time and two whole numbers, as messages arrive. Ties go by the row's text.
    """
    return last_entries(entries(rows, order), n).groupBy("zone_id").transformWithStateInPandas(
        statefulProcessor=_processor(n), outputStructType="zone_id string, payload string", outputMode="Update", timeMode="None"
    )


def entries(rows: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """(zone_id, arrived, part, place, payload) of the rows."""
    time, part, place = order
    return rows.select(
        F.col("zone_id").cast("string").alias("zone_id"), F.unix_micros(F.col(time).cast("timestamp")).alias("arrived"),
        F.col(part).cast("int").alias("part"), F.col(place).cast("long").alias("place"),
        F.to_json(F.struct(*rows.columns), _FORMATS).alias("payload"),
    )


def last_entries(rows: DataFrame, n: int, held_rows: int = HELD_ROWS) -> DataFrame:
    """The rows of ``entries`` without those that are not among the last ``n`` of their zone in their task.

    A task holds ``held_rows`` new rows and what is left of the earlier ones. Where that is
    no less than ``held_rows`` itself, as with very many zones, it is handed on, uncut by what
    follows: a zone's task cuts it once more.
    """
    by = [(c, "descending") for c in _ORDER]

    def cut(table: pa.Table) -> pa.Table:
        # A missing time comes last, as in the state.
        table = table.take(pc.sort_indices(table, sort_keys=by, null_placement="at_end"))
        zone = table.column("zone_id").combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        place = np.argsort(zone, kind="stable")
        first = np.flatnonzero(np.diff(zone[place], prepend=-1) != 0)
        rank = np.arange(len(place)) - np.repeat(first, np.diff(first, append=len(place)))
        return table.take(pa.array(np.sort(place[rank < n])))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        new = 0
        for batch in batches:
            held.append(batch)
            new += batch.num_rows
            if new >= held_rows:
                left = cut(pa.Table.from_batches(held))
                held, new = left.to_batches(), 0
                if left.num_rows >= held_rows:
                    yield from held
                    held = []
        if held:
            yield from cut(pa.Table.from_batches(held)).to_batches()

    return rows.mapInArrow(task, rows.schema)


def history_table(changes: DataFrame, schema: StructType) -> DataFrame:
    """The rows every zone keeps, from the stored output of ``keyed_history`` with its versions.

    A zone's rows are those of the last batch that has any; versions are compared, not rows.
    """
    version = F.struct(*VERSION)
    last = changes.groupBy("zone_id", *VERSION).agg(F.count("*").alias("kept"))
    last = last.groupBy("zone_id").agg(F.max(version).alias("last")).select(F.col("zone_id").alias("zone"), "last")
    rows = changes.join(last, changes["zone_id"].eqNullSafe(last["zone"]) & (version == F.col("last")))
    return rows.select(F.from_json("payload", schema, _FORMATS).alias("row")).select("row.*")


def read_history(spark, path: str, schema: StructType) -> DataFrame:
    """``history_table`` of a folder that a ``table_sink`` has written."""
    return history_table(read_versions(spark, path), schema)
