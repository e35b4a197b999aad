"""The hashed user key that links warehouse users to analytics users."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hashed_user_key(raw_user_id: Column, prefix: str) -> Column:
    """Lower-case hex SHA-256 of ``prefix || raw_user_id`` (null in, null out)."""
    return F.sha2(F.concat(F.lit(prefix), raw_user_id), 256)
