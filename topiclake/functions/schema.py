"""Declared topic schemas: JSON text to Spark struct types."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

_SPARK_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES.get(self.type, T.StringType())


def parse_schema(schema_json: str) -> list[Field]:
    """Fields of `{"fields":[...]}` or of a bare array, in declared order."""
    doc = json.loads(schema_json)
    items = doc if isinstance(doc, list) else doc["fields"]
    return [Field(f["name"], f["type"], f.get("nullable", True)) for f in items]


def to_struct(fields: list[Field]) -> T.StructType:
    """The Spark struct; columns stay nullable because Spark writes do not enforce the flag."""
    return T.StructType([T.StructField(f.name, f.spark_type, True) for f in fields])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
