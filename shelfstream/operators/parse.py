"""JSON lines to typed rows against a fixed schema, with an error row for every line that does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstream.functions.scalars import CORRUPT, with_json_fields
from shelfstream.schemas import ERROR_MSG

PREFIX = "json_"
BLANK_ERROR = "Empty message"
JSON_ERROR = "Message does not match the schema"


def parse_json(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Add the fields of ``schema`` and ``error`` (null where the line fits the schema).

    ``value`` and all other columns stay, so good and bad rows can be told apart by one filter.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = with_json_fields(df, value_col, with_corrupt, PREFIX)
    # A blank or null line yields nulls only, without a corrupt record.
    blank = F.col(value_col).isNull() | (F.trim(value_col) == "")
    error = F.when(blank, BLANK_ERROR).when(F.col(PREFIX + CORRUPT).isNotNull(), JSON_ERROR)
    kept = [c for c in df.columns if c == value_col or c not in schema.names]
    return parsed.select(*kept, *[F.col(PREFIX + name).alias(name) for name in schema.names], error.alias("error"))


def good_rows(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    return parsed.filter("error is null").drop("error", value_col)


def failed_lines_only(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """``parsed`` with the line of error rows alone: the fields of good rows say it, and it need not be shuffled or kept."""
    return parsed.withColumn(value_col, F.when(F.col("error").isNotNull(), F.col(value_col)))


def parse_errors(parsed: DataFrame, arrival: Column | None = None, value_col: str = "value") -> DataFrame:
    """Error rows of :func:`parse_json` in the dead-letter layout; the transform field stays null."""
    bad = parsed.filter("error is not null").select(
        F.lit(None).cast("string").alias("transform"),
        "error",
        F.col(value_col).alias("data"),
        (F.current_timestamp() if arrival is None else arrival).cast("timestamp").alias("timestamp"),
    )
    return bad.select(*ERROR_MSG.names)


def with_failure_count(parsed: DataFrame) -> tuple[DataFrame, Observation]:
    """``parsed`` and an observation that has ``rows`` and ``json_parse_failures`` once the frame has been written."""
    counted = Observation()
    failures = F.count_if(F.col("error").isNotNull()).alias("json_parse_failures")
    return parsed.observe(counted, F.count(F.lit(1)).alias("rows"), failures), counted


def observe_failures(parsed: DataFrame, name: str = "json_conversion") -> DataFrame:
    """Count parse failures while the rows pass; read them from an Observation or a query listener."""
    return parsed.observe(name, F.count(F.when(F.col("error").isNotNull(), 1)).alias("json_parse_failures"))
