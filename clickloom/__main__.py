"""The two jobs on the command line: ``session`` and ``monitor``.

    python -m clickloom session --task-id 1 --tasks task --actions user_visit_action \\
        --users user_info --output /shared/results --hive
    python -m clickloom monitor --servers host:9092 --topics clicks --root /shared/ads

With spark-submit: ``spark-submit --py-files clickloom.zip clickloom/__main__.py session ...``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from clickloom.plans import run_session_analysis, start_ad_monitor
from clickloom.schemas import BLACKLIST_THRESHOLD, SAMPLE_TOTAL
from clickloom.session import build_session
from clickloom.sinks import CROWDED, jdbc_results, parquet_results
from clickloom.sources import load_task, read_file_lines, read_jdbc, read_kafka_lines
from clickloom.sources.adlog import AHEAD
from clickloom.streaming import AVAILABLE_NOW


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    session = jobs.add_parser("session", help="run one session analysis task")
    session.add_argument("--task-id", type=int, required=True)
    for name in ("tasks", "actions", "users"):
        session.add_argument(
            f"--{name}",
            required=True,
            help="folder of Parquet files, name of a table, or for tasks jdbc:<url>#<table>",
        )
    session.add_argument("--output", required=True, help="folder, or jdbc:<url>")
    session.add_argument("--sample-total", type=int, default=SAMPLE_TOTAL)
    session.add_argument("--seed", type=int, default=0)
    session.add_argument("--connections", type=int, help="database connections at a time")
    session.add_argument("--count-scope", choices=("all", "filtered"), default="all")
    session.add_argument("--input-gb", type=float, help="size of the actions, for the shuffles")
    session.add_argument("--hive", action="store_true", help="tables are in a Hive metastore")

    monitor = jobs.add_parser("monitor", help="run the ad click streams")
    source = monitor.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka servers")
    source.add_argument("--lines", help="folder in which text files of log lines appear")
    monitor.add_argument("--topics", help="comma list of Kafka topics")
    monitor.add_argument("--root", required=True, help="shared folder for tables and checkpoints")
    monitor.add_argument("--threshold", type=int, default=BLACKLIST_THRESHOLD)
    monitor.add_argument("--ahead", default=AHEAD, help="how far a click may be in the future")
    monitor.add_argument(
        "--rewrite-every", type=int, default=CROWDED, help="files of a date that make it rewritten"
    )
    monitor.add_argument("--available-now", action="store_true", help="stop at the input's end")
    return parser


def _table(spark: SparkSession, name: str) -> DataFrame:
    if name.startswith("jdbc:"):
        url, _, table = name.partition("#")
        return read_jdbc(spark, url, table)
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(arguments)
    if args.job == "session":
        size = None if args.input_gb is None else int(args.input_gb * 2**30)
        spark = spark or build_session("clickloom session", hive=args.hive, input_bytes=size)
        to_database = args.output.startswith("jdbc:")
        run_session_analysis(
            _table(spark, args.actions),
            _table(spark, args.users),
            load_task(_table(spark, args.tasks), args.task_id),
            jdbc_results(args.output, args.connections)
            if to_database
            else parquet_results(args.output),
            args.sample_total,
            args.seed,
            args.count_scope,
        )
        return
    spark = spark or build_session("clickloom monitor")
    lines = (
        read_kafka_lines(spark, args.servers, args.topics)
        if args.servers
        else read_file_lines(spark, args.lines)
    )
    trigger = AVAILABLE_NOW if args.available_now else None
    queries = start_ad_monitor(
        lines,
        args.root,
        args.threshold,
        args.ahead,
        "timestamp" if args.servers else None,
        trigger,
        args.rewrite_every,
    )
    if args.available_now:
        for query in queries:
            query.awaitTermination()
    else:
        # ends, with its error, when any of them fails
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
