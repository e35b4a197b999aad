"""Day-sharded analytics events.

The warehouse keeps one table per day with a ``yyyyMMdd`` suffix; on Spark
that is one Parquet dataset partitioned by a string ``suffix`` column, and
a suffix range is a partition filter.  When the suffix is derived from the
event timestamp (the test bindings), the same range is also stated on the
timestamp so it reaches the Parquet scan as a pushed filter.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeline.sources.schemas import ANALYTICS_EVENT_SCHEMA, conform


def _day(suffix: str) -> dt.date:
    return dt.datetime.strptime(suffix, "%Y%m%d").date()


def changed_shards(stored: DataFrame | None, now: DataFrame) -> list[str]:
    """Shards that are new, or hold something else, since the fingerprints
    ``stored`` were taken; one name a day at most."""
    if stored is not None:
        now = now.exceptAll(stored.select(now.columns))
    return sorted(r["suffix"] for r in now.select("suffix").distinct().collect())


@dataclass(frozen=True)
class ShardedEvents:
    df: DataFrame
    # the dataset's folder, if it was read from one
    path: str | None = None
    # set when ``suffix`` = yyyyMMdd of this UTC wall-clock column
    derived_from: str | None = None

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "ShardedEvents":
        """A dataset written with ``partitionBy("suffix")``.  The schema is
        declared, so the suffix stays a string (inference would make it an
        integer and the range compare numeric)."""
        df = spark.read.schema(ANALYTICS_EVENT_SCHEMA).parquet(path)
        return cls(conform(df, ANALYTICS_EVENT_SCHEMA), path)

    def all(self) -> DataFrame:
        return self.df

    def between(
        self, lo: str | None, hi: str | None, low_inclusive: bool = True
    ) -> DataFrame:
        """Shards from ``lo`` (inclusive unless ``low_inclusive`` is false)
        through ``hi``, both ``yyyyMMdd``; ``None`` leaves a side open."""
        sfx = F.col("suffix")
        cond = F.lit(True)
        if lo is not None:
            cond = cond & ((sfx >= F.lit(lo)) if low_inclusive else (sfx > F.lit(lo)))
        if hi is not None:
            cond = cond & (sfx <= F.lit(hi))
        if self.derived_from is not None:
            ts = F.col(self.derived_from)
            if lo is not None:
                first = _day(lo) + (dt.timedelta(0) if low_inclusive else dt.timedelta(days=1))
                start = dt.datetime.combine(first, dt.time())
                cond = (ts >= F.lit(start.isoformat(" ")).cast("timestamp_ntz")) & cond
            if hi is not None:
                end = dt.datetime.combine(_day(hi) + dt.timedelta(days=1), dt.time())
                cond = (ts < F.lit(end.isoformat(" ")).cast("timestamp_ntz")) & cond
        return self.df.where(cond)

    def only(self, suffixes: list[str]) -> DataFrame:
        """The named shards; others are not read."""
        if not suffixes:
            return self.df.where(F.lit(False))
        return self.between(min(suffixes), max(suffixes)).where(F.col("suffix").isin(suffixes))

    def fingerprints(self, through: str) -> DataFrame:
        """What each shard through ``through`` holds: (suffix, n_files, n_bytes,
        n_rows, last_event_id, digest).  A stored dataset is described by its files'
        names, sizes, times and footers, without reading a column; other frames by
        their rows."""
        if self.path is None:
            return self.between(None, through).groupBy("suffix").agg(
                F.lit(0).cast("long").alias("n_files"),
                F.lit(0).cast("long").alias("n_bytes"),
                F.count(F.lit(1)).alias("n_rows"),
                F.max("event_id").alias("last_event_id"),
                F.bit_xor(F.xxhash64("event_id", "user_id", "user_pseudo_id", "event_timestamp")).alias("digest"),
            )
        rows = self.df.sparkSession.read.schema(ANALYTICS_EVENT_SCHEMA).parquet(self.path).where(F.col("suffix") <= F.lit(through))
        meta = F.col("_metadata")
        files = rows.groupBy(
            "suffix", meta["file_path"].alias("file"), meta["file_size"].alias("bytes"), meta["file_modification_time"].alias("time")
        ).agg(F.count(F.lit(1)).alias("rows"))
        return files.groupBy("suffix").agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("bytes").alias("n_bytes"),
            F.sum("rows").alias("n_rows"),
            F.lit(None).cast("long").alias("last_event_id"),
            F.bit_xor(F.xxhash64("file", "bytes", "time")).alias("digest"),
        )

    def write(self, path: str, mode: str = "errorifexists") -> None:
        """Materialise as a suffix-partitioned dataset (one folder per day)."""
        self.df.write.mode(mode).partitionBy("suffix").parquet(path)
