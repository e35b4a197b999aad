"""Cumulative identity as a bucketed base and a delta, updated without a rewrite.

Below ``path``: ``base-<n>`` and ``delta-<n>``, states (one row per user) bucketed by
user, and ``versions``, a row per version that names the two, the last shard they
cover, and the fingerprints of the shards folded (``fingerprints-<n>``).  A version
is visible once its row is written; readers of an older one are not disturbed.

A daily update folds the new and the changed shards and writes one more delta: the
last one merged with that fold.  The base is written again only when the delta
has grown to ``COMPACT_SHARE`` of it.  A lookup joins the wanted users to base and
delta by bucket: neither is shuffled, and the smaller key of the two is taken.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeline.operators.identity import first_touch_state, merge_first_touch
from lifeline.sources.buckets import read_bucketed, write_bucketed
from lifeline.sources.shards import ShardedEvents, changed_shards

_FIRST = T.StructType([T.StructField("key", T.DecimalType(38, 0)), T.StructField("value", T.StringType())])
STATE_SCHEMA = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("first_client", _FIRST), T.StructField("first_app", _FIRST)])
VERSION_DDL = "version int, base string, delta string, fingerprints string, through string, buckets int, base_rows bigint, delta_rows bigint"
#: Rows of the delta, as a share of the base's, at which they become a new base.
COMPACT_SHARE = 0.2


@dataclass(frozen=True)
class Version:
    version: int
    base: str
    delta: str
    fingerprints: str
    through: str
    buckets: int
    base_rows: int
    delta_rows: int


def _lesser(a: str, b: str) -> F.Column:
    """The smaller of two ``(key, value)`` structs, the other where one is null."""
    return F.least(F.col(a), F.col(b))


class IdentityStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, analytics: ShardedEvents, through: str, buckets: int | None = None) -> "IdentityStore":
        """A new store of all shards through ``through``.  Take at least as many
        buckets as shuffle partitions (the default), or joins move the state."""
        store = cls(spark, path)
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        write_bucketed(first_touch_state(analytics.between(None, through)), f"{store.path}/base-0", "user_id", buckets)
        write_bucketed(spark.createDataFrame([], STATE_SCHEMA), f"{store.path}/delta-0", "user_id", buckets)
        store._commit(0, "base-0", "delta-0", analytics, through, buckets)
        return store

    def current(self) -> Version:
        row = self.spark.read.schema(VERSION_DDL).parquet(f"{self.path}/versions").orderBy(F.col("version").desc()).first()
        return Version(**row.asDict())

    def _commit(self, version: int, base: str, delta: str, analytics: ShardedEvents, through: str, buckets: int) -> None:
        prints = f"fingerprints-{version}"
        analytics.fingerprints(through).coalesce(1).write.parquet(f"{self.path}/{prints}")
        counts = (self._read(name, buckets).count() for name in (base, delta))
        new = Version(version, base, delta, prints, through, buckets, *counts)
        self.spark.createDataFrame([asdict(new)], VERSION_DDL).coalesce(1).write.mode("append").parquet(f"{self.path}/versions")

    def _read(self, name: str, buckets: int) -> DataFrame:
        return read_bucketed(self.spark, f"{self.path}/{name}", STATE_SCHEMA, "user_id", buckets)

    def update(self, analytics: ShardedEvents, through: str) -> list[str]:
        """Fold the shards through ``through`` that are new, or hold something
        else than when they were folded; returns their names."""
        now = self.current()
        changed = changed_shards(self.spark.read.parquet(f"{self.path}/{now.fingerprints}"), analytics.fingerprints(through))
        if not changed:
            return []
        n = now.version + 1
        base, delta = now.base, f"delta-{n}"
        # the delta as plain files: it is merged by a union
        last = self.spark.read.schema(STATE_SCHEMA).parquet(f"{self.path}/{now.delta}")
        write_bucketed(merge_first_touch(last, first_touch_state(analytics.only(changed))), f"{self.path}/{delta}", "user_id", now.buckets)
        if self._read(delta, now.buckets).count() > COMPACT_SHARE * now.base_rows:
            base = f"base-{n}"
            write_bucketed(self._merged(now.base, delta, now.buckets), f"{self.path}/{base}", "user_id", now.buckets)
            delta = f"delta-{n}-none"
            write_bucketed(self.spark.createDataFrame([], STATE_SCHEMA), f"{self.path}/{delta}", "user_id", now.buckets)
        self._commit(n, base, delta, analytics, max(through, now.through), now.buckets)
        return changed

    def _both(self, base: str, delta: str, buckets: int) -> tuple[DataFrame, DataFrame]:
        later = self._read(delta, buckets).select("user_id", F.col("first_client").alias("later_client"), F.col("first_app").alias("later_app"))
        return self._read(base, buckets), later

    @staticmethod
    def _reduced(rows: DataFrame) -> DataFrame:
        return rows.select("user_id", _lesser("first_client", "later_client").alias("first_client"), _lesser("first_app", "later_app").alias("first_app"))

    def _merged(self, base: str, delta: str, buckets: int) -> DataFrame:
        old, later = self._both(base, delta, buckets)
        return self._reduced(old.join(later, "user_id", "full_outer"))

    def state(self) -> DataFrame:
        """The state of every user, joined by bucket."""
        now = self.current()
        return self._merged(now.base, now.delta, now.buckets)

    def lookup(self, users: DataFrame) -> DataFrame:
        """The state of the users (distinct ``user_id``) that the store has; only
        ``users`` are shuffled."""
        now = self.current()
        old, later = self._both(now.base, now.delta, now.buckets)
        rows = users.select("user_id").join(old, "user_id", "left").join(later, "user_id", "left")
        return self._reduced(rows).where(F.col("first_app").isNotNull())
