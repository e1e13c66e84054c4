"""Type drift of payloads against the contract (Q10, S3).

A payload is parsed once as VARIANT.  Its members are listed by path, nested objects to
``max_depth`` levels, each with the type that it has in this message.  A partial aggregate per
(path, type) then tells how often a type occurs, when it was first and last seen, and
whether the contract expects it: a number where text is due, an object where a number was,
or a path that the contract does not know.

Payloads that are not JSON, and JSON that is not an object, have no members.  JSON null is
a type of its own (``null``) and is expected everywhere.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DEPTH = 4
#: The types that the payload contract expects of each field.
CONTRACT_TYPES: dict[str, tuple[str, ...]] = {
    "vehicle_id": ("string",), "road_id": ("string",), "city_zone": ("string",), "speed": ("integer", "number"),
    "congestion_level": ("integer",), "weather": ("string",), "vehicle_type": ("string",), "sensor_id": ("string",),
    "latitude": ("number",), "longitude": ("number",), "event_time": ("string",), "raw": ("string",),
}


def json_type(value: Column) -> Column:
    """The JSON type of a VARIANT: string, integer, number, boolean, null, object or array."""
    kind = F.schema_of_variant(value)
    return (F.when(kind.startswith("OBJECT"), F.lit("object")).when(kind.startswith("ARRAY"), F.lit("array"))
            .when(kind == "VOID", F.lit("null")).when(kind == "STRING", F.lit("string"))
            .when(kind == "BOOLEAN", F.lit("boolean")).when(kind == "BIGINT", F.lit("integer"))
            # written with a fraction (13.000, too), an exponent or beyond 64 bits
            .otherwise(F.lit("number")))


def typed_paths(bronze: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(path, type, kafka_timestamp): a row per member of every payload."""
    spark = bronze.sparkSession
    level = bronze.select("kafka_timestamp", F.try_parse_json("raw_payload").alias("value"), F.lit("").alias("prefix"))
    level = level.where(F.schema_of_variant("value").startswith("OBJECT"))
    out = None
    for depth in range(max_depth):
        members = level.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).select(
            F.col("key"), F.col("value").alias("member"))).select(
            "kafka_timestamp", F.concat("prefix", "key").alias("path"), "member")
        typed = members.withColumn("type", json_type(F.col("member")))
        found = typed.select("path", "type", "kafka_timestamp")
        out = found if out is None else out.unionByName(found)
        if depth + 1 < max_depth:
            level = typed.where("type = 'object'").select(
                "kafka_timestamp", F.col("member").alias("value"), F.concat("path", F.lit(".")).alias("prefix"))
    return out


def schema_type_drift(bronze: DataFrame, contract: Mapping[str, tuple[str, ...]] = CONTRACT_TYPES,
                      max_depth: int = MAX_DEPTH) -> DataFrame:
    """Per path and type: rows, first and last arrival, and whether it departs from the contract."""
    expected = F.lit(False)
    for path, kinds in contract.items():
        expected = expected | ((F.col("path") == path) & F.col("type").isin(*kinds))
    known = F.col("path").isin(*contract)
    return typed_paths(bronze, max_depth).groupBy("path", "type").agg(
        F.count(F.lit(1)).alias("rows"), F.min("kafka_timestamp").alias("first_seen"),
        F.max("kafka_timestamp").alias("last_seen")).withColumn(
        "drift", F.when(~known, F.lit("new path")).when(expected | (F.col("type") == "null"), F.lit("none"))
        .otherwise(F.lit("new type")))
