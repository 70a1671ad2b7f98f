"""Weather pipeline: nested records to a partitioned table to a published summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.functions.columns import quoted
from millrace.plans.incremental import Loads, newer_than_target
from millrace.plans.kept import marks, summaries
from millrace.sinks import append_partitioned, write_jdbc
from millrace.sources.feed import WEATHER
from millrace.sources.tables import DEFAULT_FORMAT, read_table, read_table_if_exists, refresh
from millrace.streaming.ingest import load_stream, open_files

KEYS = ["country", "region", "city"]
MEASURES = ["temperature", "windspeed"]

# Nested field of a weather record, and its column in the prepared table.
PREPARED_FIELDS = {
    "location.name": "city",
    "location.region": "region",
    "location.country": "country",
    "current.temp_c": "temperature",
    "current.wind_kph": "windspeed",
    "current.last_updated": "modifiedon",
}
PREPARED_SCHEMA = (
    "city string, region string, country string, temperature double, windspeed double, modifiedon string"
)
COUNTRIES = ["Netherlands", "Belgium"]


def select_nested(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Nested fields, by dotted path, as flat columns."""
    return df.select([F.col(path).alias(name) for path, name in fields.items()])


def prepare(records: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """Flat columns of the records of the given countries."""
    wanted = COUNTRIES if countries is None else countries
    return select_nested(records, PREPARED_FIELDS).where(F.col("country").isin(wanted))


def summarise(df: DataFrame, keys: list[str], averages: list[str], stamp: str) -> DataFrame:
    """Per key: the averages, the number of stamped rows, the latest stamp."""
    return df.groupBy(*[quoted(k) for k in keys]).agg(
        *[F.avg(quoted(c)).alias(c) for c in averages],
        F.count(quoted(stamp)).alias("number_of_rows"),
        F.max(quoted(stamp)).alias(stamp),
    )


def _prepared_schema(fmt: str) -> str | None:
    """Delta keeps the schema itself; for folders of files it has to be given."""
    return None if fmt == "delta" else PREPARED_SCHEMA


def load_new(spark: SparkSession, streaming_path: str, data_path: str, new_keys: str = "drop",
             fmt: str = DEFAULT_FORMAT) -> None:
    """Append the streamed records that are newer than what the prepared table holds for their city.

    The table's files are listed before the append starts, so reading and appending do not mix.
    """
    staged = prepare(read_table(spark, streaming_path, fmt))
    target = read_table_if_exists(spark, data_path, fmt, _prepared_schema(fmt))
    fresh = newer_than_target(staged, target, KEYS, "modifiedon", new_keys)
    append_partitioned(fresh, data_path, KEYS, fmt)
    refresh(spark, data_path)


def kept_loads(spark: SparkSession, data_path: str, state_path: str, new_keys: str = "drop", fmt: str = DEFAULT_FORMAT) -> Loads:
    """The prepared table as numbered loads, with its marks and its summary kept below ``state_path``."""
    return Loads(
        data_path, marks(spark, f"{state_path}/marks", KEYS, fmt), "modifiedon", tuple(KEYS), new_keys, fmt=fmt,
        summary=summaries(spark, f"{state_path}/summary", KEYS, MEASURES, "modifiedon", fmt), averages=tuple(MEASURES))


def load_stream_of_records(spark: SparkSession, streaming_path: str, loads: Loads, checkpoint: str, schema: StructType = WEATHER,
                           files_per_batch: int | None = None) -> StreamingQuery:
    """What ``load_new`` does, from the files that have come since the last run, until it has caught up."""
    records = open_files(spark, streaming_path, schema, loads.fmt, files_per_batch)
    return load_stream(prepare(records), loads.load, checkpoint, until_caught_up=True)


def publish(spark: SparkSession, data_path: str, fmt: str = DEFAULT_FORMAT, **database) -> DataFrame:
    """Summary of the prepared table; written to a database table where one is named."""
    refresh(spark, data_path)
    prepared = read_table(spark, data_path, fmt, schema=_prepared_schema(fmt))
    return _published(summarise(prepared, KEYS, MEASURES, "modifiedon"), database)


def publish_kept(loads: Loads, **database) -> DataFrame:
    """The same summary from what was kept with each load, without a look at the table."""
    return _published(loads.summarised(), database)


def _published(summary: DataFrame, database: dict) -> DataFrame:
    if database:
        write_jdbc(summary, **database)
    return summary
