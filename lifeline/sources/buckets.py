"""Parquet folders bucketed by a key, read back as such without a catalog.

Spark only takes a bucketed layout from a catalog table, so a table is named for
the moment of writing or reading and dropped at once; the files stay, and a
DataFrame that was made from the table keeps its layout.  Joins on the key with a
bucketed side need no exchange of that side.  (Don't union bucketed frames ahead of a
grouping by their key: Spark 4.1 plans that without an exchange too, and the
groups then come out in several parts.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` below the new folder ``path``, one sorted file for each bucket of ``key``."""
    spark, table = df.sparkSession, f"lifeline_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A folder of ``write_bucketed``."""
    table = f"lifeline_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out
