"""Sinks of a micro-batch: callables ``(rows, batch_id) -> None``.

A batch that is retried must not leave its rows twice. File sinks replace the
batch's own folder; the JDBC sink can skip rows that are already there; a topic
is written at least once, as brokers offer no more to a batch writer. Errors are
raised, so Spark retries the batch instead of losing it.

Batch numbers start again with a new checkpoint, so a batch is known by its run as
well: one run per checkpoint, in order of their beginnings. ``batch_id`` may be a plain
number where there is no stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sensorgrid.operators.quality import check_rows
from sensorgrid.session import new_path, remove_path, settle
from sensorgrid.sinks.payload import to_payload
from sensorgrid.sources.csv_files import OPTIONS as CSV_OPTIONS
from sensorgrid.streaming.changelog import keep_last, read_versions

# A sink may return the rows it has stored, for others to read instead of computing them again.
Sink = Callable[[DataFrame, int], DataFrame | None]

NO_RUN = "0-direct"

#: Rows that are dealt out at a time, at least; how many times at most; rows of a file that waits for it.
DEAL_ROWS, DEALS, FILE_ROWS = 1 << 22, 16, 1 << 19


class BatchId(int):
    """The number of a batch, and the run it belongs to."""

    run = NO_RUN

    def __new__(cls, number: int, run: str = NO_RUN) -> BatchId:
        self = super().__new__(cls, number)
        self.run = run
        return self

    @property
    def folder(self) -> str:
        return f"run={self.run}/batch_id={int(self)}"

    @classmethod
    def of(cls, number: int) -> BatchId:
        return number if isinstance(number, cls) else cls(number)


def _replace(rows: DataFrame, folder: str, day: str | None = None, sort_by: Sequence[str] = ()) -> None:
    """Writes a folder anew. With ``day`` the rows are first dealt out by day, in parts
    of a size that adaptive execution chooses, so files follow size and not tasks.

    Dealing out takes many times the bytes that the table has. So the rows are written as
    they come, and files of ``DEAL_ROWS`` rows or a ``DEALS``-th of all, which is more, are
    dealt out at a time; what has been shuffled for them goes before the next ones."""
    spark = rows.sparkSession
    if not day:
        ordered = rows.sortWithinPartitions(*sort_by) if sort_by else rows
        ordered.write.mode("overwrite").parquet(folder)
        return
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    stage = new_path(spark, "undealt")
    spark.conf.set(key, "true")  # streams run without it
    try:
        rows.write.option("maxRecordsPerFile", FILE_ROWS).parquet(stage)
        staged = spark.read.schema(rows.schema).parquet(stage)
        files = staged.groupBy(F.input_file_name().alias("at")).agg(F.count("*").alias("n")).collect()
        most = max(DEAL_ROWS, -(-sum(f["n"] for f in files) // DEALS))
        deals: list[list[str]] = [[]]
        held = 0
        for file in sorted(files):
            if deals[-1] and held + file["n"] > most:
                deals.append([])
                held = 0
            deals[-1].append(f"{stage}/{file['at'].rpartition('/')[2]}")
            held += file["n"]
        for k, deal in enumerate(deals):
            # Without any row there is no file, and the empty table is written.
            some = spark.read.schema(rows.schema).parquet(*(deal or [stage])).hint("rebalance", day)
            if sort_by:
                some = some.sortWithinPartitions(day, *sort_by)
            some.write.mode("append" if k else "overwrite").partitionBy(day).parquet(folder)
            if len(deals) > 1:
                settle(spark)
    finally:
        spark.conf.set(key, before)
        remove_path(spark, stage)


def table_sink(
    path: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    event_date: str | None = None,
    sort_by: Sequence[str] = (),
    created_at: str | None = None,
) -> Sink:
    """Parquet table with one folder per run and batch; returns the rows as stored.

    ``event_date`` names the timestamp whose day becomes a partition column, so that
    period queries read only their days; ``sort_by`` orders each file for min/max
    skipping; ``created_at`` names a column for the time of writing.
    """

    def write(batch: DataFrame, batch_id: int) -> DataFrame | None:
        rows = shape(batch) if shape else batch
        if created_at:
            rows = rows.withColumn(created_at, F.current_timestamp())
        day = "event_date" if event_date else None
        if day:
            rows = rows.withColumn(day, F.to_date(event_date))
        folder = f"{path}/{BatchId.of(batch_id).folder}"
        _replace(rows, folder, day, sort_by)
        if shape:
            return None
        return batch.sparkSession.read.schema(batch.schema).parquet(folder)

    write.stores = not shape
    return write


def compact(
    spark: SparkSession, path: str, target: str, keys: Sequence[str] = (), event_date: str | None = None
) -> None:
    """Rewrites a table's batches as one, in files that follow size; ``keys`` reduce a changelog.

    The source stays as it is: readers change over to ``target`` when it is whole.
    """
    rows = read_versions(spark, path)
    if keys:
        rows = keep_last(rows, keys)
    rows = rows.drop("run", "batch_id", "event_date")
    table_sink(target, event_date=event_date)(rows if event_date else rows.hint("rebalance"), 0)


def topic_sink(
    topic: str,
    options: dict[str, str] | None = None,
    payload: Callable[[DataFrame], DataFrame] = to_payload,
    fmt: str = "kafka",
    path: str | None = None,
) -> Sink:
    """Messages to a topic; with another ``fmt`` to files of one folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        messages = payload(batch).withColumn("topic", F.lit(topic))
        if fmt == "kafka":
            messages.write.format("kafka").options(**(options or {})).save()
        else:
            folder = f"{path}/{BatchId.of(batch_id).folder}"
            messages.write.format(fmt).mode("overwrite").options(**(options or {})).save(folder)

    return write


def jdbc_sink(
    url: str,
    table: str,
    properties: dict[str, str],
    shape: Callable[[DataFrame], DataFrame] | None = None,
    batch_column: str | None = None,
    connections: int = 16,
    batch_size: int = 10_000,
) -> Sink:
    """Appends to a database table over at most ``connections`` connections.

    With ``batch_column`` (a text column of the table, best indexed) the batch's run
    and number are written as well, and rows that a failed attempt of the same batch
    has already committed are left out, counted one by one. Without it a retried
    batch may leave rows twice.
    """

    def missing(rows: DataFrame, label: str) -> DataFrame:
        attempt = f"(SELECT * FROM {table} WHERE {batch_column} = '{label}') attempt"
        done = rows.sparkSession.read.jdbc(url, attempt, properties=properties)
        if done.isEmpty():
            return rows
        typed = [F.col(f.name).cast(f.dataType) for f in rows.schema]
        return rows.exceptAll(done.select(*typed))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        if batch_column:
            label = f"{BatchId.of(batch_id).run}/{int(batch_id)}"
            rows = missing(rows, label).withColumn(batch_column, F.lit(label))
        # A shuffle, so that only the writing is done over few connections.
        rows.repartition(connections).write.option("batchsize", batch_size).jdbc(
            url, table, mode="append", properties=properties
        )

    return write


def multi_sink(*sinks: Sink) -> Sink:
    """One micro-batch to several sinks: computed once, skipped when empty.

    If the first sink stores the rows themselves, the others read what it wrote, and
    nothing is kept in memory; otherwise the batch is persisted while it is written.
    """

    def write(batch: DataFrame, batch_id: int) -> DataFrame | None:
        stores = len(sinks) > 1 and getattr(sinks[0], "stores", False)
        rows = batch if stores or len(sinks) == 1 else batch.persist()
        stored = None
        try:
            if not rows.isEmpty():
                for sink in sinks:
                    out = sink(rows, batch_id)
                    if stores and sink is sinks[0]:
                        rows = stored = out
        finally:
            if not stores and len(sinks) > 1:
                batch.unpersist()
        return stored

    write.stores = bool(sinks) and getattr(sinks[0], "stores", False)
    return write


def _route(batch: DataFrame, contract: str, folder: str) -> None:
    """Writes a batch once, with its verdict as the partition ``refused``."""
    checked = check_rows(batch, contract).withColumn("refused", F.size("reasons") > 0)
    checked.write.mode("overwrite").partitionBy("refused").parquet(folder)


def _routed(batch: DataFrame, folder: str, refused: bool) -> DataFrame:
    judged = [T.StructField("reasons", T.ArrayType(T.StringType())), T.StructField("refused", T.BooleanType())]
    schema = T.StructType([*batch.schema.fields, *judged])
    rows = batch.sparkSession.read.schema(schema).parquet(folder).where(F.col("refused") == refused)
    return rows.drop("refused") if refused else rows.drop("refused", "reasons")


def routed_sink(contract: str, path: str) -> Sink:
    """One table for all rows of a batch, judged and written once, partitioned by ``refused``.

    ``read_routed`` gives either half, the refused one with ``reasons``. Returns the rows
    as stored.
    """

    def write(batch: DataFrame, batch_id: int) -> DataFrame:
        folder = f"{path}/{BatchId.of(batch_id).folder}"
        _route(batch, contract, folder)
        return batch.sparkSession.read.schema(batch.schema).parquet(folder).select(*batch.columns)

    write.stores = True
    return write


def read_routed(spark: SparkSession, path: str, batch_id: int | None = None, refused: bool = False) -> DataFrame:
    """The valid or the refused rows of a ``routed_sink``, of one batch or of all."""
    folder = path if batch_id is None else f"{path}/{BatchId.of(batch_id).folder}"
    rows = spark.read.parquet(folder).where(F.col("refused").cast("boolean") == refused)
    return rows.drop("refused") if refused else rows.drop("refused", "reasons")


def split_sink(contract: str, valid: Sink, quarantine: Sink) -> Sink:
    """Rows that meet a table contract to one sink, the others with reasons to another.

    The batch is judged and written once below the shared folder, where both sinks read
    their half; that copy goes when they have ended. If both store what they get, the
    whole batch can be read from them.
    """
    both = getattr(valid, "stores", False) and getattr(quarantine, "stores", False)

    def write(batch: DataFrame, batch_id: int) -> DataFrame | None:
        spark = batch.sparkSession
        stage = new_path(spark, "routed")
        try:
            _route(batch, contract, stage)
            kept = valid(_routed(batch, stage, False), batch_id)
            refused = quarantine(_routed(batch, stage, True), batch_id)
        finally:
            remove_path(spark, stage)
        parts = [kept, refused and refused.drop("reasons")]
        parts = [p.select(*batch.columns) for p in parts if p is not None]
        return reduce(DataFrame.unionByName, parts) if both and parts else None

    write.stores = both
    return write


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; a sorted frame gives files whose name order is the row order."""
    df.write.options(**CSV_OPTIONS).csv(path)
