"""Dead letters as table rows and as log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The time range a warehouse timestamp can hold.
MAX_DATE = "9999-12-31 00:00:00"
MIN_DATE = "0001-01-01 00:00:00"
# Fixed value: data, error, time and transform of a log line.
LINE_FORMAT = "%s failed with %s at %s in %s"


def dead_letter(letters: DataFrame) -> DataFrame:
    """Error rows with a storable time: missing or out-of-range times become the latest one."""
    latest = F.to_timestamp(F.lit(f"{MAX_DATE}+0000"), "yyyy-MM-dd HH:mm:ssZ")
    earliest = F.to_timestamp(F.lit(f"{MIN_DATE}+0000"), "yyyy-MM-dd HH:mm:ssZ")
    time = F.col("timestamp")
    return letters.withColumn("timestamp", F.when(time.isNull() | (time > latest) | (time < earliest), latest).otherwise(time))


def dead_letter_lines(letters: DataFrame) -> DataFrame:
    """One log line per error row in ``line``; absent parts read ``null``."""

    def text(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("null"))

    # date_format writes in the session time zone, so shift the instant to show UTC.
    utc = F.to_utc_timestamp("timestamp", F.current_timezone())
    at = F.coalesce(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit("null"))
    line = F.format_string(LINE_FORMAT, text("data"), text("error"), at, text("transform"))
    return letters.select(line.alias("line"))
