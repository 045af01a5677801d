"""Input schemas, type hints over inference, and the stored schema of a dataset."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the order events.
ORDER_EVENTS = (
    "rating_key STRING, restaurant_key STRING, order_id STRING, driver_key STRING, "
    "order_date TIMESTAMP, user_key STRING, total_amount DECIMAL(12,2), payment_key STRING, "
    "dt_current_timestamp TIMESTAMP"
)
STATUS_EVENTS = (
    "status_id BIGINT, order_identifier STRING, "
    "status STRUCT<status_name: STRING, timestamp: BIGINT>, dt_current_timestamp STRING"
)
RESTAURANTS = (
    "restaurant_id BIGINT, name STRING, cnpj STRING, cuisine_type STRING, country STRING, "
    "city STRING, address STRING, phone_number STRING, opening_time STRING, "
    "closing_time STRING, average_rating DOUBLE, num_reviews BIGINT"
)
RATINGS = (
    "rating_id BIGINT, restaurant_identifier STRING, rating DOUBLE, timestamp TIMESTAMP"
)
PRODUCTS = (
    "product_id BIGINT, restaurant_id BIGINT, name STRING, product_type STRING, "
    "cuisine_type STRING, price DOUBLE, unit_cost DOUBLE, calories BIGINT, "
    "prep_time_min BIGINT, is_vegetarian BOOLEAN, is_gluten_free BOOLEAN"
)
INVENTORY = (
    "stock_id BIGINT, restaurant_id BIGINT, product_id BIGINT, quantity_available BIGINT, "
    "last_updated TIMESTAMP"
)
DELIVERY_USERS = (
    "cpf STRING, user_id STRING, uuid STRING, email STRING, delivery_address STRING, "
    "city STRING, phone_number STRING, country STRING, dt_current_timestamp STRING"
)
PROFILE_USERS = (
    "cpf STRING, user_id STRING, uuid STRING, first_name STRING, last_name STRING, "
    "birthday STRING, job STRING, company_name STRING, phone_number STRING, country STRING, "
    "dt_current_timestamp STRING"
)
DELIVERY_CHANGES = (
    "cpf STRING, user_id BIGINT, email STRING, delivery_address STRING, city STRING, "
    "operation STRING, sequenceNum BIGINT, dt_current_timestamp TIMESTAMP"
)
PROFILE_CHANGES = (
    "cpf STRING, user_id BIGINT, first_name STRING, last_name STRING, job STRING, "
    "operation STRING, sequenceNum BIGINT, dt_current_timestamp TIMESTAMP"
)

ORDER_HINTS = "order_date TIMESTAMP, dt_current_timestamp TIMESTAMP, total_amount DECIMAL(10,2)"


Schema = T.StructType | str


def as_struct(schema: Schema) -> T.StructType:
    """A schema given as fields or as DDL text."""
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def with_hints(schema: T.StructType, hints: str | None) -> T.StructType:
    """Replace the types of named fields; hinted fields not in the schema are added."""
    if not hints:
        return schema
    hinted = {field.name: field for field in T.StructType.fromDDL(hints).fields}
    kept = [hinted.pop(field.name, field) for field in schema.fields]
    return T.StructType(kept + list(hinted.values()))


class ChangedTypeError(Exception):
    """A field arrived with values that its stored type can't hold."""


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def holds(stored: T.DataType, found: T.DataType) -> bool:
    """Whether values of the found type can be read as the stored one without loss."""
    if stored == found or isinstance(stored, T.StringType) or isinstance(found, T.NullType):
        return True
    if isinstance(stored, T.StructType) and isinstance(found, T.StructType):
        known = {f.name: f.dataType for f in stored.fields}
        return all(f.name not in known or holds(known[f.name], f.dataType) for f in found.fields)
    if isinstance(stored, T.ArrayType) and isinstance(found, T.ArrayType):
        return holds(stored.elementType, found.elementType)
    if isinstance(stored, (T.DoubleType, T.DecimalType, T.LongType)) and isinstance(found, _WHOLE):
        return True
    # Inference reads hinted decimals, dates and times as numbers or text.
    return isinstance(stored, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)) and isinstance(
        found, (T.StringType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType))


def merged(stored: T.StructType, found: T.StructType) -> T.StructType:
    """The stored fields, then the new ones. A stored type that can't hold what was found raises."""
    known = {f.name: f.dataType for f in stored.fields}
    changed = [f.name for f in found.fields if f.name in known and not holds(known[f.name], f.dataType)]
    if changed:
        raise ChangedTypeError(f"values of another type in {changed}: give a wider type as a hint")
    return T.StructType(stored.fields + [f for f in found.fields if f.name not in known])


@dataclass(frozen=True)
class SchemaStore:
    """A schema kept as text in a shared folder, beside the checkpoint of its stream."""

    spark: SparkSession
    path: str

    def load(self) -> tuple[T.StructType, str] | None:
        """The schema and the time up to which files were looked at."""
        try:
            row = self.spark.read.text(self.path).first()
        except AnalysisException:
            return None
        if row is None:
            return None
        kept = json.loads(row[0])
        return T.StructType.fromJson(kept["schema"]), kept["seen_until"]

    def save(self, schema: T.StructType, seen_until: str) -> None:
        text = json.dumps({"schema": schema.jsonValue(), "seen_until": seen_until})
        self.spark.range(1, numPartitions=1).select(F.lit(text).alias("value")).write.mode(
            "overwrite").text(self.path)
