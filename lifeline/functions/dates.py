"""Date helpers over UTC wall-clock ``timestamp_ntz`` columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_date(ts_utc: Column, zone: str) -> Column:
    """Calendar day of a UTC instant in ``zone`` (``DATE(ts, zone)``)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc))


def shard_suffix(day: Column) -> Column:
    """``yyyyMMdd`` shard name of a date."""
    return F.date_format(day, "yyyyMMdd")


def date_text(day: Column) -> Column:
    """ISO ``yyyy-MM-dd`` text of a date (null stays null)."""
    return F.date_format(day, "yyyy-MM-dd")
