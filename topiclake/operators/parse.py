"""Parsing of envelope values against a declared schema, with the rejected rows as side outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclake import constants as C
from topiclake.functions.casts import CORRUPT, json_variants, typed_row
from topiclake.functions.schema import Field

ROW = "row"
REASON = "reason"


def parse_json(envelope: DataFrame, fields: list[Field]) -> DataFrame:
    """Add `row` (typed struct in declared order, null when unparseable) and `reason`.

    The JSON text is parsed once per record: the one-element generator keeps Catalyst from pushing
    later filters below the parse, which would repeat it.
    """
    parsed = envelope.select("*", F.explode(F.array(json_variants(F.col("value"), fields))).alias("__json"))
    bad = F.col("__json").isNull() | F.col("__json")[CORRUPT].isNotNull()
    empty = F.coalesce(F.col("value"), F.lit("")) == ""
    return parsed.select(
        *envelope.columns,
        F.when(~bad, typed_row(F.col("__json"), fields)).alias(ROW),
        F.when(empty, "empty or null record").when(bad, "not a JSON object").alias(REASON),
    )


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REASON).isNull()).drop(REASON)


def sample_text(value: Column) -> Column:
    """The record cut to a short sample for the quarantine table."""
    cut = F.concat(F.substring(value, 1, C.SAMPLE_CHARS), F.lit("..."))
    return F.when(F.length(value) > C.SAMPLE_CHARS, cut).otherwise(value)


def quarantine(parsed: DataFrame) -> DataFrame:
    """Unparseable records: where they were, why, and a sample."""
    return parsed.filter(F.col(REASON).isNotNull()).select(
        "topic", "partition", "offset", "timestamp", REASON, sample_text(F.col("value")).alias("sample")
    )


def missing_required(fields: list[Field], row: Column) -> Column:
    """Names of the required fields that are null in `row`."""
    checks = [F.when(row[f.name].isNull(), F.lit(f.name)) for f in fields if not f.nullable]
    return F.array_compact(F.array(*checks)) if checks else F.expr("cast(array() as array<string>)")


def check_required(parsed: DataFrame, fields: list[Field]) -> DataFrame:
    """Turn rows that lack a required field into rejected rows with a reason that names the fields."""
    missing = missing_required(fields, F.col(ROW))
    reason = F.concat(F.lit("missing required: "), F.concat_ws(",", missing))
    return parsed.withColumn(
        REASON, F.coalesce(F.col(REASON), F.when(F.col(ROW).isNotNull() & (F.size(missing) > 0), reason))
    )


def project(parsed: DataFrame, *keep: str) -> DataFrame:
    """The declared fields of the valid rows as top-level columns, after the columns of `keep`."""
    return valid_rows(parsed).select(*keep, f"{ROW}.*")
