"""Batch and continuous jobs from the command line: `python -m eventmart.plans.cli daily-logins --dt 2024-01-15 ...`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from eventmart.operators import identity
from eventmart.plans import jobs
from eventmart.session import create_session, table
from eventmart.streaming.sinks import overwrite_partitions


def daily_logins(spark: SparkSession, login_table: str, signup_table: str, output_table: str, dt: str) -> None:
    """Write the day's partition; a rerun replaces that partition only."""
    rows = identity.daily_login_aggregates(table(spark, login_table), table(spark, signup_table), dt)
    overwrite_partitions(rows, output_table, "dt")


def backfill_logins(spark: SparkSession, login_table: str, signup_table: str, output_table: str) -> None:
    """Write every day's partition in one job."""
    rows = identity.login_aggregates_backfill(table(spark, login_table), table(spark, signup_table))
    overwrite_partitions(rows.hint("rebalance", "dt"), output_table, "dt")


STREAMS = {"move-saga": jobs.start_move_saga, "credit-check": jobs.start_credit_check,
           "upload-ttl": jobs.start_upload_ttl, "echo": jobs.start_echo, "olap": jobs.start_olap,
           "projections": jobs.start_projections}


def run_stream(spark: SparkSession, job: str, source: str, target: str, checkpoints: str,
               interval: str | None = None) -> None:
    """One continuous job: at an interval until stopped, or until it has caught up if none is given."""
    started = STREAMS[job](spark, source, target, checkpoints, interval=interval)
    for query in started if isinstance(started, list) else [started]:
        query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="eventmart")
    parser.add_argument("--catalog")
    commands = parser.add_subparsers(dest="job", required=True)
    for name in ("daily-logins", "backfill-logins"):
        job = commands.add_parser(name)
        for option in ("--login-table", "--signup-table", "--output-table"):
            job.add_argument(option, required=True)
        if name == "daily-logins":
            job.add_argument("--dt", required=True)
    for name in STREAMS:
        job = commands.add_parser(name)
        for option in ("--source", "--target", "--checkpoints"):
            job.add_argument(option, required=True)
        job.add_argument("--interval", help="trigger, such as '10 seconds'")
    args = parser.parse_args(argv)
    spark = create_session(f"eventmart.{args.job}", args.catalog)
    if args.job in STREAMS:
        run_stream(spark, args.job, args.source, args.target, args.checkpoints, args.interval)
    elif args.job == "daily-logins":
        daily_logins(spark, args.login_table, args.signup_table, args.output_table, args.dt)
    else:
        backfill_logins(spark, args.login_table, args.signup_table, args.output_table)


if __name__ == "__main__":
    main()
