"""Declared schemas of the logical inputs.

Timestamps are ``timestamp_ntz`` holding UTC wall-clock time, so no result
depends on the session time zone.  The readers declare these schemas: a
Parquet timestamp stored zoned (UTC-adjusted) reads back as its UTC wall
time whatever the session zone, and range filters on it still reach the
scan.  Frames handed over with zoned timestamp columns are converted by
``conform`` (``to_utc_wall``).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("calendar_date", T.DateType()),
        T.StructField("base_group", T.StringType()),
        T.StructField("subscription_start_date", T.DateType()),
        T.StructField("subscription_cancel_dts", T.TimestampNTZType()),
        T.StructField("billing_cycle_start_date", T.DateType()),
        T.StructField("billing_cycle_end_date", T.DateType()),
        T.StructField("churn_type", T.StringType()),
        T.StructField("subscription_month", T.LongType()),
        T.StructField("gift_card_code", T.StringType()),
        T.StructField("payment_vendor", T.StringType()),
    ]
)

#: Partition column of subscription events that are stored by UTC day.
EVENT_DAY = "event_day"

SUBSCRIPTION_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("subscription_id", T.StringType()),
        T.StructField("offer_type", T.StringType()),
    ]
)

APP_INFO = T.StructType([T.StructField("firebase_app_id", T.StringType())])

ANALYTICS_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("app_info", APP_INFO),
        T.StructField("suffix", T.StringType()),
    ]
)


def to_utc_wall(df: DataFrame, name: str) -> Column:
    """``name`` as UTC wall-clock ``timestamp_ntz`` whatever its stored type."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(name)
    if isinstance(dtype, T.TimestampType):
        # zoned instant -> its wall clock in the session zone -> in UTC:
        # the UTC wall clock of the instant, whatever the session zone
        return F.convert_timezone(None, F.lit("UTC"), F.col(name))
    raise TypeError(f"{name}: expected a timestamp, got {dtype.simpleString()}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (column pruning stays intact:
    only the declared columns are referenced)."""
    cols = []
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            cols.append(to_utc_wall(df, f.name).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)
