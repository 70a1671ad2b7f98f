"""The weather feed: message envelope, record schema and its decoding."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

ENVELOPE = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("timestampType", IntegerType()),
])

# Names, types and order of the fields of a weather message, record by record.
CONDITION = StructType([
    StructField("text", StringType()),
    StructField("icon", StringType()),
    StructField("code", DoubleType()),
])
LOCATION = StructType([
    StructField("name", StringType()),
    StructField("region", StringType()),
    StructField("country", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("tz_id", StringType()),
    StructField("localtime_epoch", LongType()),
    StructField("localtime", StringType()),
])
CURRENT = StructType([
    StructField("last_updated_epoch", LongType()),
    StructField("last_updated", StringType()),
    StructField("temp_c", DoubleType()),
    StructField("temp_f", DoubleType()),
    StructField("is_day", DoubleType()),
    StructField("condition", CONDITION),
    StructField("wind_mph", DoubleType()),
    StructField("wind_kph", DoubleType()),
    StructField("wind_degree", DoubleType()),
    StructField("wind_dir", StringType()),
    StructField("pressure_mb", DoubleType()),
    StructField("pressure_in", DoubleType()),
    StructField("precip_mm", DoubleType()),
    StructField("precip_in", DoubleType()),
    StructField("humidity", DoubleType()),
    StructField("cloud", DoubleType()),
    StructField("feelslike_c", DoubleType()),
    StructField("feelslike_f", DoubleType()),
    StructField("vis_km", DoubleType()),
    StructField("vis_miles", DoubleType()),
    StructField("uv", DoubleType()),
    StructField("gust_mph", DoubleType()),
    StructField("gust_kph", DoubleType()),
])
DAY = StructType([
    StructField("maxtemp_c", DoubleType()),
    StructField("maxtemp_f", DoubleType()),
    StructField("mintemp_c", DoubleType()),
    StructField("mintemp_f", DoubleType()),
    StructField("avgtemp_c", DoubleType()),
    StructField("avgtemp_f", DoubleType()),
    StructField("maxwind_mph", DoubleType()),
    StructField("maxwind_kph", DoubleType()),
    StructField("totalprecip_mm", DoubleType()),
    StructField("totalprecip_in", DoubleType()),
    StructField("totalsnow_cm", DoubleType()),
    StructField("avgvis_km", DoubleType()),
    StructField("avgvis_miles", DoubleType()),
    StructField("avghumidity", DoubleType()),
    StructField("daily_will_it_rain", DoubleType()),
    StructField("daily_chance_of_rain", DoubleType()),
    StructField("daily_will_it_snow", DoubleType()),
    StructField("daily_chance_of_snow", DoubleType()),
    StructField("condition", CONDITION),
    StructField("uv", DoubleType()),
])
ASTRO = StructType([
    StructField("sunrise", StringType()),
    StructField("sunset", StringType()),
    StructField("moonrise", StringType()),
    StructField("moonset", StringType()),
    StructField("moon_phase", StringType()),
    StructField("moon_illumination", DoubleType()),
    StructField("is_moon_up", DoubleType()),
    StructField("is_sun_up", DoubleType()),
])
HOUR = StructType([
    StructField("time_epoch", LongType()),
    StructField("time", StringType()),
    StructField("temp_c", DoubleType()),
    StructField("temp_f", DoubleType()),
    StructField("is_day", DoubleType()),
    StructField("condition", CONDITION),
    StructField("wind_kph", DoubleType()),
    StructField("wind_mph", DoubleType()),
    StructField("wind_degree", DoubleType()),
    StructField("wind_dir", StringType()),
    StructField("pressure_mb", DoubleType()),
    StructField("pressure_in", DoubleType()),
    StructField("precip_mm", DoubleType()),
    StructField("precip_in", DoubleType()),
    StructField("snow_cm", DoubleType()),
    StructField("humidity", DoubleType()),
    StructField("cloud", DoubleType()),
    StructField("feelslike_c", DoubleType()),
    StructField("feelslike_f", DoubleType()),
    StructField("windchill_c", DoubleType()),
    StructField("windchill_f", DoubleType()),
    StructField("heatindex_c", DoubleType()),
    StructField("heatindex_f", DoubleType()),
    StructField("dewpoint_c", DoubleType()),
    StructField("dewpoint_f", DoubleType()),
    StructField("will_it_rain", DoubleType()),
    StructField("chance_of_rain", DoubleType()),
    StructField("will_it_snow", DoubleType()),
    StructField("chance_of_snow", DoubleType()),
    StructField("vis_km", DoubleType()),
    StructField("vis_miles", DoubleType()),
    StructField("gust_mph", DoubleType()),
    StructField("gust_kph", DoubleType()),
    StructField("uv", DoubleType()),
])
FORECAST_DAY = StructType([
    StructField("date", StringType()),
    StructField("date_epoch", LongType()),
    StructField("day", DAY),
    StructField("astro", ASTRO),
    StructField("hour", ArrayType(HOUR)),
])
FORECAST = StructType([
    StructField("forecastday", ArrayType(FORECAST_DAY)),
])
WEATHER = StructType([
    StructField("location", LOCATION),
    StructField("current", CURRENT),
    StructField("forecast", FORECAST),
])


def avro_schema(schema: StructType, name: str = "Record") -> str:
    """Avro schema text of a record, for decoding Avro messages with ``from_avro``."""
    primitives = {"string": "string", "double": "double", "bigint": "long", "int": "int", "boolean": "boolean",
                  "binary": "bytes", "float": "float"}

    def of(data_type, path: str):
        if isinstance(data_type, StructType):
            fields = [{"name": f.name, "type": of(f.dataType, f"{path}_{f.name}")} for f in data_type.fields]
            return {"type": "record", "name": path, "fields": fields}
        if isinstance(data_type, ArrayType):
            return {"type": "array", "items": of(data_type.elementType, f"{path}_item")}
        return primitives[data_type.simpleString()]

    return json.dumps(of(schema, name))


def decoded(value: Column, schema: StructType, codec: str = "json", avro_text: str | None = None) -> Column:
    """The record held in a message; NULL fields where the message cannot be read.

    ``codec="avro"`` needs the spark-avro package on the cluster.
    """
    permissive = {"mode": "PERMISSIVE"}
    if codec == "json":
        return F.from_json(value.cast("string"), schema, permissive)
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(value, avro_text or avro_schema(schema), permissive)
    raise ValueError(f"unknown codec {codec!r}")


def decode_messages(messages: DataFrame, schema: StructType, codec: str = "json",
                    avro_text: str | None = None) -> DataFrame:
    """Envelope rows to one column per record field."""
    return messages.select(decoded(F.col("value"), schema, codec, avro_text).alias("record")).select("record.*")
