"""Run a job on topics: ``spark-submit ... -m paneflow`` or ``python -m paneflow``.

    python -m paneflow table --servers h:9092 --topics 'events_.*' --checkpoint /shared/c
    python -m paneflow jdbc  ... --url jdbc:... --driver org.example.Driver
    python -m paneflow keyed ... --store /shared/user_info

A password is read from the environment variable PANEFLOW_PASSWORD.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .functions import FIXED_PATTERN, PARITY_PATTERN
from .plans.jobs import SideOutputs
from .schema import APPEND_TABLE, JDBC_JOB_WINDOW, JDBC_TABLE, KEYED_JOB_WINDOW, TABLE_JOB_CADENCE
from .session import SETTINGS, STREAM_SETTINGS
from .sinks.jdbc import JdbcTarget
from .sinks.table import create_append_table
from .sources import kafka
from .streaming import jobs


#: Panes of a micro-batch that are printed one by one.
PANES_SHOWN = 20


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="paneflow", description="Load messages of topics.")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, cadence in (
        ("table", TABLE_JOB_CADENCE),
        ("jdbc", JDBC_JOB_WINDOW),
        ("keyed", None),
    ):
        job = commands.add_parser(name)
        job.add_argument("--servers", required=True)
        job.add_argument("--topics", required=True, help="pattern of whole topic names")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--cadence", default=cadence)
        job.add_argument("--dead-letters")
        job.add_argument("--tap")
        job.add_argument("--max-offsets", type=int)
        job.add_argument("--min-partitions", type=int)
        job.add_argument("--quiet", action="store_true", help="do not print the counts of writes and panes")
        if name == "table":
            job.add_argument("--table", default=APPEND_TABLE)
        elif name == "jdbc":
            job.add_argument("--url", required=True)
            job.add_argument("--driver", required=True)
            job.add_argument("--user")
            job.add_argument("--table", default=JDBC_TABLE)
        else:
            job.add_argument("--store", required=True)
            job.add_argument("--fire-by-count", action="store_true", help="put every 10 rows, the rest at the window's end")
            job.add_argument("--plain-clock", action="store_true", help="24-hour row keys with minutes")
    return parser


def print_report(batch_id: int, counts: dict[str, int]) -> None:
    print(f"batch {batch_id}:", ", ".join(f"{n} {verdict}" for verdict, n in sorted(counts.items())) or "nothing", flush=True)


def print_panes(batch_id: int, panes: DataFrame) -> None:
    """How many panes and rows, and the first panes."""
    found = panes.agg(F.count(F.lit(1)).alias("panes"), F.sum("n").alias("rows")).first()
    print(f"batch {batch_id}: {found.panes} panes of {found.rows or 0} rows", flush=True)
    for row in panes.orderBy(*[c for c in panes.columns if c != "n"]).take(PANES_SHOWN):
        print("  " + ", ".join(f"{name} {value}" for name, value in row.asDict().items()), flush=True)


def start(spark: SparkSession, given: argparse.Namespace) -> StreamingQuery:
    options = kafka.consumer_options(
        given.servers,
        given.topics,
        max_offsets_per_trigger=given.max_offsets,
        min_partitions=given.min_partitions,
    )
    messages = kafka.topic_stream(spark, options)
    told = (None, None) if given.quiet else (print_report, print_panes)
    sides = SideOutputs(given.dead_letters, given.tap, *told)
    if given.job == "table":
        create_append_table(spark, given.table)
        return jobs.start_table_job(messages, given.checkpoint, given.table, sides, given.cadence)
    if given.job == "jdbc":
        password = os.environ.get("PANEFLOW_PASSWORD")
        target = JdbcTarget(given.url, given.driver, given.user, password, given.table)
        return jobs.start_jdbc_job(messages, given.checkpoint, target, sides, given.cadence)
    pattern = FIXED_PATTERN if given.plain_clock else PARITY_PATTERN
    how = {"pattern": pattern, "order": kafka.TOPIC_ARRIVAL}
    if not given.fire_by_count:
        cadence = given.cadence or KEYED_JOB_WINDOW
        return jobs.start_keyed_job(messages, given.checkpoint, given.store, sides, cadence, **how)
    cadence = given.cadence or TABLE_JOB_CADENCE
    return jobs.start_keyed_job_by_count(messages, given.checkpoint, given.store, sides, cadence, **how)


def main(argv: Sequence[str] | None = None) -> None:
    given = arguments().parse_args(argv)
    builder = SparkSession.builder.appName(f"paneflow-{given.job}")
    for key, value in (SETTINGS | STREAM_SETTINGS).items():
        builder = builder.config(key, value)
    start(builder.getOrCreate(), given).awaitTermination()


if __name__ == "__main__":
    main()
