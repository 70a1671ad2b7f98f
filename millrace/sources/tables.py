"""Tables and files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DEFAULT_FORMAT = "parquet"


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, merge_schema: bool = False,
               schema: StructType | str | None = None) -> DataFrame:
    """Lake table by path.

    ``merge_schema`` reads Parquet whose files gained columns over time. A ``schema`` keeps the
    values of partition folders from being taken for numbers or dates.
    """
    reader = spark.read.format(fmt) if schema is None else spark.read.format(fmt).schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def read_table_if_exists(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT,
                         schema: StructType | str | None = None) -> DataFrame | None:
    try:
        return read_table(spark, path, fmt, schema=schema)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"):
            return None
        raise


def refresh(spark: SparkSession, path: str) -> None:
    """Forget cached file listings and metadata below ``path``."""
    spark.catalog.refreshByPath(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multi_line: bool = False) -> DataFrame:
    """JSON documents, one per line. Without a schema the nested one found in the data applies, at the
    price of reading the data twice. With ``multi_line`` a file holds one document, or an array of them,
    over any number of lines, and is read by one task."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", str(multi_line).lower()).json(path)


def read_seed(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multi_line: bool = True) -> DataFrame:
    """CSV with a header line. An empty field is NULL; without a schema every column is text.

    Fields may stand between double quotes, a doubled quote being one. A quoted field may hold line
    breaks unless ``multi_line`` is off, which lets a large file be read by several tasks.
    """
    reader = spark.read.option("header", "true").option("nullValue", "").option("encoding", "UTF-8").option(
        "quote", '"').option("escape", '"').option("multiLine", str(multi_line).lower())
    return reader.schema(schema).csv(path) if schema is not None else reader.csv(path)


@dataclass(frozen=True)
class Source:
    """A declared source: table names that resolve to paths below one folder."""

    spark: SparkSession
    folder: str
    tables: tuple[str, ...] = ()
    fmt: str = DEFAULT_FORMAT
    suffix: str = ".parquet"

    def table(self, name: str) -> DataFrame:
        if self.tables and name not in self.tables:
            raise KeyError(f"{name!r} is not declared, tables are {list(self.tables)}")
        return read_table(self.spark, f"{self.folder.rstrip('/')}/{name}{self.suffix}", self.fmt)

    def register(self) -> None:
        """Make every declared table a temporary view of the same name."""
        for name in self.tables:
            self.table(name).createOrReplaceTempView(name)
