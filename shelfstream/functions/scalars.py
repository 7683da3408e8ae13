"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "corrupt"


def opt_string(text: Column, default: str) -> Column:
    """JSON text field with a default where it is missing or null."""
    return F.coalesce(text, F.lit(default))


def opt_long(text: Column) -> Column:
    """JSON text field as a long: fractions are cut off, anything unreadable is 0."""
    whole = text.try_cast("bigint")
    fraction = text.try_cast("double").try_cast("bigint")
    return F.coalesce(whole, fraction, F.lit(0).cast("bigint"))


def opt_int(text: Column) -> Column:
    """As :func:`opt_long`, kept to 32 bits by dropping the high bits."""
    return F.shiftright(F.shiftleft(opt_long(text), 32), 32)


def event_key(store: Column, product: Column) -> Column:
    return F.concat_ws("-", store, product)


def as_event_time(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def parse_event_datetime(text: Column) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd HH:mm:ss`` (UTC) or the same with a zone offset, else null."""
    # A bare time gets an explicit +0000, so the session time zone plays no part.
    zoned = F.when(text.rlike(r":\d{2}$") & ~text.rlike(r"[+-]\d{2}:\d{2}$"), F.concat(text, F.lit("+0000"))).otherwise(
        F.regexp_replace(text, r"([+-]\d{2}):(\d{2})$", "$1$2")
    )
    return F.unix_millis(F.try_to_timestamp(zoned, F.lit("yyyy-MM-dd HH:mm:ssZ")))


def div(value: Column, divisor: int) -> Column:
    """Integer division of longs (``/`` would go through doubles)."""
    return F.call_function("div", value, F.lit(divisor))


def long_bytes(value: Column) -> Column:
    """A long as 8 big-endian bytes."""
    return F.unhex(F.lpad(F.hex(value), 16, "0"))


def with_json_fields(df: DataFrame, text: str, schema: T.StructType, prefix: str) -> DataFrame:
    """Add every field of the JSON text column as ``prefix + name``.

    A generator instead of a projection, because the optimizer copies a projected ``from_json`` into
    every filter and column that uses it, and each copy parses the line again.
    """
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.select("*", F.inline_outer(F.array(parsed)).alias(*[prefix + name for name in schema.names]))


def conform(df, schema: T.StructType):
    """Select exactly the fields of ``schema``, cast to its types; absent ones become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def duration_suffix(millis: int) -> str:
    """Table suffix of a duration: hours, minutes, seconds and milliseconds, zero parts left out."""
    parts = []
    for size, unit in ((3_600_000, "H"), (60_000, "M"), (1_000, "S"), (1, "MS")):
        amount, millis = divmod(millis, size)
        if amount:
            parts.append(f"{amount}{unit}")
    return "".join(parts) or "0MS"
