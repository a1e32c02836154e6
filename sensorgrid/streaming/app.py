"""The whole service as one Spark application: raw topic to tables and topics.

    spark-submit --packages <kafka connector>,<jdbc driver> sensorgrid/streaming/app.py \\
        --topic raw --checkpoints /lake/checkpoints \\
        --readings-table /lake/readings --zones-table /lake/zones

Credentials come from the environment: BROKER_SERVERS, BROKER_USER,
BROKER_PASSWORD and, with ``--jdbc-url``, DB_USER and DB_PASSWORD.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sensorgrid.fixed_values import HISTORY_SIZE, ZONE_WATERMARK, ZONE_WINDOW
from sensorgrid.operators.registry import station_rows
from sensorgrid.operators.zones import array_to_csv, to_zone_table
from sensorgrid.session import build_session
from sensorgrid.sinks.payload import to_payload, zones_payload
from sensorgrid.sinks.writers import Sink, jdbc_sink, multi_sink, split_sink, table_sink, topic_sink
from sensorgrid.sources.messages import feed_ingest, kafka_source, sasl_options
from sensorgrid.streaming import jobs


def start_service(
    feed: DataFrame,
    stations: Sequence[dict[str, Any]],
    reading_sinks: Sequence[Sink],
    zone_sinks: Sequence[Sink],
    checkpoints: str,
    trigger: dict | None = None,
    length: str = ZONE_WINDOW,
    watermark: str = ZONE_WATERMARK,
    state_partitions: int | None = None,
    spread: int | None = None,
) -> list[StreamingQuery]:
    """Two queries over one feed: readings in append mode, zone windows in update mode."""
    readings = jobs.readings_stream(feed, stations, spread=spread)
    zones = jobs.zone_stream(readings, length, watermark, stations, only_known=True)
    return [
        jobs.start(
            readings, multi_sink(*reading_sinks), "append", f"{checkpoints}/readings", trigger,
            name="readings",
        ),
        jobs.start(
            zones, multi_sink(*zone_sinks), "update", f"{checkpoints}/zones", trigger,
            state_partitions=state_partitions, name="zones",
        ),
    ]


def start_feed(
    feed: DataFrame,
    latest: Sink,
    history_path: str,
    checkpoints: str,
    trigger: dict | None = None,
    size: int = HISTORY_SIZE,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """The serving side's feed: readings messages to the last row and the last rows per zone."""
    rows = feed_ingest(feed)
    return [
        jobs.start(
            jobs.latest_stream(rows), latest, "update", f"{checkpoints}/latest", trigger,
            state_partitions=state_partitions, name="latest",
        ),
        jobs.start(
            rows, jobs.history_sink(history_path, size), "append", f"{checkpoints}/history", trigger,
            name="history",
        ),
    ]


def database_sinks(
    valid: Sink, quarantine: Sink, url: str, table: str, login: dict[str, str], contract: str,
    shape: Callable[[DataFrame], DataFrame] | None = None, batch_column: str | None = None,
) -> Sink:
    """A contract's valid rows to a table and a database, the others to the quarantine only."""
    database = jdbc_sink(url, table, login, shape=shape, batch_column=batch_column)
    return split_sink(contract, multi_sink(valid, database), quarantine)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--topic", required=True)
    args.add_argument("--readings-topic", default="readings")
    args.add_argument("--zones-topic", default="zones")
    args.add_argument("--checkpoints", required=True)
    args.add_argument("--readings-table", required=True)
    args.add_argument("--zones-table", required=True)
    args.add_argument("--jdbc-url")
    args.add_argument("--jdbc-batch-column", help="text column that makes retries leave no duplicates")
    args.add_argument("--jdbc-readings", help="table of readings in the database")
    args.add_argument("--jdbc-zones", help="table of zone averages in the database")
    args.add_argument("--latest-table", help="with --history-table also runs the feed of the serving side")
    args.add_argument("--history-table")
    args.add_argument("--starting-offsets", default="latest")
    args.add_argument("--max-offsets-per-trigger", default="1000000")
    args.add_argument("--state-partitions", type=int, default=16)
    opts = args.parse_args()

    env = os.environ
    broker = sasl_options(env["BROKER_SERVERS"], env["BROKER_USER"], env["BROKER_PASSWORD"])
    source = {
        "startingOffsets": opts.starting_offsets,
        "maxOffsetsPerTrigger": opts.max_offsets_per_trigger,
    }
    spark = build_session("sensorgrid")
    feed = kafka_source(spark, opts.topic, {**broker, **source})

    valid = table_sink(
        opts.readings_table, event_date="datetime", sort_by=("zone_id", "datetime"), created_at="created_at"
    )
    zones = table_sink(opts.zones_table, shape=array_to_csv, created_at="created_at")
    refused = table_sink(opts.readings_table + "_quarantine")
    refused_zones = table_sink(opts.zones_table + "_quarantine")
    if opts.jdbc_url:
        login = {"user": env["DB_USER"], "password": env["DB_PASSWORD"]}
        mark = opts.jdbc_batch_column
        stored = database_sinks(valid, refused, opts.jdbc_url, opts.jdbc_readings, login, "reading", batch_column=mark)
        stored_zones = database_sinks(
            zones, refused_zones, opts.jdbc_url, opts.jdbc_zones, login, "zone", to_zone_table, mark
        )
    else:
        stored, stored_zones = split_sink("reading", valid, refused), split_sink("zone", zones, refused_zones)
    queries = start_service(
        feed, station_rows(),
        [stored, topic_sink(opts.readings_topic, broker, to_payload)],
        [stored_zones, topic_sink(opts.zones_topic, broker, zones_payload)],
        opts.checkpoints, state_partitions=opts.state_partitions,
    )
    if opts.latest_table and opts.history_table:
        messages = kafka_source(spark, opts.readings_topic, {**broker, **source})
        queries += start_feed(
            messages, table_sink(opts.latest_table), opts.history_table, opts.checkpoints,
            state_partitions=opts.state_partitions,
        )
    jobs.await_any(queries)


if __name__ == "__main__":
    main()
