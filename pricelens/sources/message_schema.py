"""Message schemas read from a record schema file in Avro's JSON form.

``{"type": "record", "fields": [{"name": ..., "type": ..., "default": ...}]}``
gives the columns, the keys that a message must carry (those without a
default), the keys whose value may not be null (those whose type is no union
with null) and the values that absent keys take.  Messages stay JSON text.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "int": IntegerType(), "long": LongType(), "float": FloatType(), "double": DoubleType(), "boolean": BooleanType()}


@dataclass
class MessageSchema:
    columns: StructType
    required: list[str]
    not_null: list[str]
    defaults: dict


def _column(name: str, kind) -> tuple[DataType, bool]:
    """(type, whether null is a value of it)."""
    options = kind if isinstance(kind, list) else [kind]
    plain = [k for k in options if k != "null"]
    if len(plain) != 1 or not isinstance(plain[0], str) or plain[0] not in _TYPES:
        raise ValueError(f"field {name!r}: {kind!r} is no primitive type or union of one with null")
    return _TYPES[plain[0]], len(plain) < len(options)


def message_schema(text: str) -> MessageSchema:
    record = json.loads(text)
    if not isinstance(record, dict) or record.get("type") != "record":
        raise ValueError("not a record schema")
    found = MessageSchema(StructType(), [], [], {})
    for field in record["fields"]:
        kind, nullable = _column(field["name"], field["type"])
        found.columns.add(StructField(field["name"], kind, True))
        if not nullable:
            found.not_null.append(field["name"])
        if "default" not in field:
            found.required.append(field["name"])
        elif field["default"] is not None:
            found.defaults[field["name"]] = field["default"]
        elif not nullable:
            raise ValueError(f"field {field['name']!r}: its default null is no value of its type")
    return found


def read_message_schema(spark: SparkSession, path: str) -> MessageSchema:
    """From a file in any store that Spark reads; a schema is small, so its text comes to the driver."""
    return message_schema(spark.read.text(path, wholetext=True).first()["value"])
