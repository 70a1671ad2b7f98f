"""The flows as jobs for ``spark-submit``.

    spark-submit --py-files millrace.zip millrace/jobs.py ingest --to PATH --checkpoint PATH
    spark-submit --py-files millrace.zip millrace/jobs.py prepare --streaming PATH --data PATH
    spark-submit --py-files millrace.zip millrace/jobs.py publish --data PATH --database NAME --table NAME

With ``--state PATH``, prepare reads only the records that are new since its last run and keeps marks and
summary there, and publish reads that summary in place of the table.

Brokers, databases and their credentials come from the session's settings, never from arguments.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from millrace.operators.suite import run_checks
from millrace.plans import customers, maintenance, weather
from millrace.session import build_session, setting
from millrace.sinks import overwrite
from millrace.sources.tables import DEFAULT_FORMAT, read_json, read_table
from millrace.streaming.ingest import ingest, open_files, open_topic

# Session settings that name the database, its user, and the table to maintain.
DATABASE_SETTINGS = {"url": "spark.postgresql_url", "user": "spark.postgresql_usr", "password": "spark.postgresql_pwd"}
DRIVER = "org.postgresql.Driver"
MAINTENANCE_SETTING = "spark.deltalake.maintenance"


def run_ingest(spark: SparkSession, args) -> None:
    """Topic, or a folder of envelope files, to a lake table."""
    if args.source:
        messages = open_files(spark, args.source, files_per_batch=args.files_per_batch)
    else:
        messages = open_topic(spark, offsets_per_batch=args.offsets_per_batch)
    query = ingest(messages, args.to, args.checkpoint, codec=args.codec, fmt=args.format,
                   until_caught_up=args.until_caught_up)
    query.awaitTermination()


def run_prepare(spark: SparkSession, args) -> None:
    """Newer records into the partitioned table."""
    if args.state is None:
        weather.load_new(spark, args.streaming, args.data, args.new_keys, args.format)
        return
    loads = weather.kept_loads(spark, args.data, args.state, args.new_keys, args.format)
    weather.load_stream_of_records(spark, args.streaming, loads, f"{args.state}/checkpoint",
                                   files_per_batch=args.files_per_batch).awaitTermination()


def run_publish(spark: SparkSession, args) -> None:
    """Summary of the partitioned table into a database table."""
    given = {option: setting(spark, name) for option, name in DATABASE_SETTINGS.items()}
    url = f"{given.pop('url')}/{args.database}"
    database = {"url": url, "table": args.table, "driver": DRIVER, **given}
    if args.state is None:
        weather.publish(spark, args.data, args.format, **database)
    else:
        weather.publish_kept(weather.kept_loads(spark, args.data, args.state, fmt=args.format), **database)


def run_land(spark: SparkSession, args) -> None:
    """JSON documents to a lake table, replacing it."""
    overwrite(read_json(spark, args.source), args.to, args.format)


def run_mart(spark: SparkSession, args) -> int:
    """Customer mart, then its checks; the exit status is 1 when a check fails."""
    mart = customers.build_customer_mart(spark, read_table(spark, args.customers, args.format), args.to, args.format)
    report = run_checks(customers.customer_mart_checks(mart)).collect()  # one row per check
    for line in report:
        print(f"{line.status}: {line.check_name}, {line.failures} failures")
    return int(any(line.status == "error" for line in report))


def run_compact(spark: SparkSession, args) -> None:
    """Fewer, larger files; without a path, of the table the settings name."""
    if not args.to and args.format != "delta":
        raise SystemExit("compact needs --to, a new folder for the merged files")
    path = args.path or setting(spark, MAINTENANCE_SETTING)
    maintenance.compact(spark, path, args.to, args.partition_by, args.format)


def run_stale(spark: SparkSession, args) -> None:
    """List of the files no live path holds, as a table."""
    overwrite(maintenance.stale_files(spark, args.root, args.live, retention_hours=args.hours), args.to)


def parser() -> argparse.ArgumentParser:
    commands = argparse.ArgumentParser(prog="millrace.jobs")
    commands.add_argument("--format", default=DEFAULT_FORMAT, help="format of the lake tables")
    jobs = commands.add_subparsers(required=True)

    def job(name: str, run, **arguments) -> None:
        command = jobs.add_parser(name, help=run.__doc__.splitlines()[0])
        command.set_defaults(run=run)
        for option, details in arguments.items():
            command.add_argument(f"--{option.replace('_', '-')}", **details)

    needed, number = {"required": True}, {"type": int}
    job("ingest", run_ingest, to=needed, checkpoint=needed, source={}, until_caught_up={"action": "store_true"},
        codec={"default": "avro", "choices": ["avro", "json"]}, files_per_batch=number, offsets_per_batch=number)
    job("prepare", run_prepare, streaming=needed, data=needed, state={}, files_per_batch=number,
        new_keys={"default": "drop", "choices": ["drop", "keep"]})
    job("publish", run_publish, data=needed, database=needed, table=needed, state={})
    job("land", run_land, source=needed, to=needed)
    job("mart", run_mart, customers=needed, to=needed)
    job("compact", run_compact, path={}, to={}, partition_by={"nargs": "*"})
    job("stale", run_stale, root=needed, live={"nargs": "+", "required": True}, to=needed,
        hours={"type": int, "default": maintenance.RETENTION_HOURS})
    return commands


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    return args.run(build_session(), args) or 0


if __name__ == "__main__":
    sys.exit(main())
