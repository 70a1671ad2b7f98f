"""Finding tables by name in the session catalog.

Names are metadata: their number is bounded by the catalog, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The catalog's table types and the names reported for them.
TABLE_TYPES = {
    "BASE TABLE": "table",
    "MANAGED": "table",
    "EXTERNAL": "external",
    "EXTERNAL TABLE": "external",
    "FOREIGN": "external",
    "MATERIALIZED VIEW": "materializedview",
}

RELATIONS = StructType([StructField(n, StringType()) for n in ("table_schema", "table_name", "table_type")])


def normal_table_type(table_type: Column) -> Column:
    name = F.lower(table_type)
    for raw, normal in TABLE_TYPES.items():
        name = F.when(table_type == raw, normal).otherwise(name)
    return name


def relations(spark: SparkSession, schema_pattern: str = "%", database: str | None = None) -> DataFrame:
    """Tables and views of all matching schemas; temporary views have the empty schema name.

    ``database`` is a catalog of the session, by default the current one. A pattern that no schema matches finds
    nothing but temporary views.
    """
    catalog = "" if database is None else f"`{database.replace('`', '``')}`."
    listed: set[tuple] = set()
    schemas = spark.sql(f"SHOW SCHEMAS{'' if database is None else ' IN ' + catalog[:-1]}").toDF("name")
    for row in schemas.where(F.col("name").ilike(schema_pattern)).collect():
        name = row["name"].replace("`", "``")
        listed |= {(".".join(t.namespace or []), t.name, t.tableType) for t in spark.catalog.listTables(f"{catalog}`{name}`")}
    if database is None:
        listed |= {("", t.name, t.tableType) for t in spark.catalog.listTables() if t.isTemporary}
    return spark.createDataFrame(sorted(listed), RELATIONS)


def relations_by_pattern(spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "",
                         database: str | None = None) -> DataFrame:
    """Relations whose schema and name match LIKE patterns, in any letter case, minus ``exclude``; ``database`` names their catalog."""
    return (
        relations(spark, schema_pattern, database)
        .where(F.col("table_schema").ilike(schema_pattern))
        .where(F.col("table_name").ilike(table_pattern) & ~F.col("table_name").ilike(exclude))
        .select("table_schema", "table_name", normal_table_type(F.col("table_type")).alias("table_type"))
        .distinct()
    )


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "", database: str | None = None) -> DataFrame:
    """Relations whose name starts with ``prefix``, itself a LIKE pattern: ``_`` is any character."""
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude, database)


def open_relations(spark: SparkSession, found: DataFrame) -> dict[str, DataFrame]:
    """The relations of a search as DataFrames, by qualified name, in name order."""
    names = [".".join(p for p in (r["table_schema"], r["table_name"]) if p) for r in found.collect()]
    return {name: spark.table(name) for name in sorted(names)}
