"""Tolerant JSON casts. A field is parsed to VARIANT, so its JSON type is known when it is cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topiclake.functions.schema import Field, quoted

CORRUPT = "__corrupt_text"


def json_variants(value: Column, fields: list[Field]) -> Column:
    """Parse `value` once to a struct with one VARIANT per declared field plus the corrupt text."""
    columns = ", ".join(f"{quoted(f.name)} variant" for f in fields)
    ddl = f"{columns}, {CORRUPT} string" if columns else f"{CORRUPT} string"
    return F.from_json(value, ddl, {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"})


def as_text(v: Column) -> Column:
    """Text of any JSON value; nested values as JSON."""
    return F.try_variant_get(v, "$", "string")


def _number(v: Column, target: str) -> Column:
    # A plain variant cast turns true into 1; the declared types accept numbers and numeric text only.
    return F.when(F.schema_of_variant(v) != "BOOLEAN", F.try_variant_get(v, "$", target))


def as_long(v: Column) -> Column:
    return _number(v, "bigint")


def as_int(v: Column) -> Column:
    return _number(v, "int")


def as_double(v: Column) -> Column:
    return _number(v, "double")


def as_float(v: Column) -> Column:
    return _number(v, "float")


def as_boolean(v: Column) -> Column:
    """True only for the text "true" in any case; every other non-null value is false."""
    return F.lower(as_text(v)) == F.lit("true")


_CASTS = {"LONG": as_long, "INT": as_int, "DOUBLE": as_double, "FLOAT": as_float, "BOOLEAN": as_boolean}


def cast_field(v: Column, field_type: str) -> Column:
    """Cast one VARIANT to a declared type; unknown types are text."""
    return _CASTS.get(field_type, as_text)(v)


def typed_row(variants: Column, fields: list[Field]) -> Column:
    """The declared fields, in order, as one typed struct."""
    return F.struct(*[cast_field(variants[f.name], f.type).alias(f.name) for f in fields])


def payload_bytes(value: Column) -> Column:
    return F.octet_length(value).cast("bigint")
