"""Packing payloads into bounded batches.

The number of buckets N comes from the total payload count and the target
batch size (banker's rounding, at least 1); each app's payloads are then
split into N ntile buckets, and every (app, bucket) becomes one JSON array.

``ntile`` over ``PARTITION BY app_id`` runs each app in one task, which is
only acceptable while an app's payload count is small: ``ntile`` counts the
largest app first and uses the window only under that bound.  Beyond it the
distributed form range-partitions by (app, order key), numbers rows inside
each range partition, adds the counts of the preceding partitions of the
same app, and applies the ntile arithmetic.  Both give the same buckets as
``ntile(N) OVER (PARTITION BY app ORDER BY key)``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifeline.config import SyncConfig
from lifeline.session import reliable_checkpoint

# a per-(range partition, app) count table larger than this is joined
# without a broadcast
OFFSETS_BROADCAST_MAX = 2_000_000


def bucket_count(n: Column, target: int) -> Column:
    """max(1, round-half-even(n / target)); exact for counts below 2^53."""
    q = F.floor(n / target).cast("long")
    r = n - q * target
    up = (2 * r > target) | ((2 * r == target) & (q % 2 == 1))
    return F.greatest(F.lit(1).cast("long"), q + F.when(up, 1).otherwise(0))


def bucket_count_value(n: int, target: int) -> int:
    """Driver-side twin of ``bucket_count`` (Python's ``round`` is
    half-even too)."""
    return max(1, round(n / target))


def ntile_of(i: Column, n: Column, b: Column) -> Column:
    """1-based ntile bucket of 0-based row ``i`` among ``n`` rows, ``b``
    buckets: the first n mod b buckets hold one extra row."""
    q = F.floor(n / b).cast("long")
    m = n - q * b
    big = m * (q + 1)
    return (
        F.when(q == 0, i + 1)
        .when(i < big, F.floor(i / (q + 1)) + 1)
        .otherwise(m + F.floor((i - big) / q) + 1)
    ).cast("int")


def ntile(
    df: DataFrame,
    group_col: str,
    order_cols: list[str],
    target: int,
    partitions: int | None = None,
    rows_per_partition: int = 500_000,
) -> DataFrame:
    """``df`` plus ``bucket``: ntile over ``group_col`` ordered by
    ``order_cols`` (a total order within the group), with N =
    bucket_count(total rows, target).

    One pass over the (persisted) input yields the largest group and the
    total.  When every group is within ``rows_per_partition`` rows, a group
    fits one task and the plain ``ntile`` window is used; otherwise, or when
    ``partitions`` is given, ``distributed_ntile``.  Both give the same
    buckets.  The result is checkpointed (window path) or built on a
    checkpoint (range path); the persisted input is released either way.
    """
    source = df.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = source.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"))
    stats = sizes.agg(F.max("n").alias("biggest"), F.sum("n").alias("total")).first()
    biggest, total = int(stats.biggest or 0), int(stats.total or 0)
    if partitions is None and biggest <= rows_per_partition:
        w = Window.partitionBy(group_col).orderBy(*[F.col(k).asc_nulls_first() for k in order_cols])
        numbered = source.withColumn("bucket", F.ntile(bucket_count_value(total, target)).over(w))
        # materialise in the shared folder, then release the cached input
        out = reliable_checkpoint(numbered)
        source.unpersist()
        return out
    parts = partitions or max(1, -(-total // rows_per_partition))
    out = distributed_ntile(
        source, group_col, order_cols, target, parts, bucket_count_value(total, target)
    )
    source.unpersist()
    return out


def distributed_ntile(
    df: DataFrame,
    group_col: str,
    order_cols: list[str],
    target: int,
    partitions: int,
    n_buckets: int | None = None,
) -> DataFrame:
    """``df`` plus ``bucket`` (and ``n_buckets``, ``n_group``): ntile over
    ``group_col`` ordered by ``order_cols`` (which must make a total order
    within the group), with N = bucket_count(total rows, target).

    Runs on ``partitions`` range partitions, so a group holding most rows is
    spread over many tasks.  The input is persisted first, so the range-bound
    sampling and the range shuffle compute the upstream plan once.  The
    numbered frame is checkpointed to the shared folder: partition ids and
    row sequence must not change between the count pass and the numbering
    pass, even if executors are lost.  The per-(partition, group) offsets
    table is small and recomputed exactly from that checkpoint.
    Pass ``n_buckets`` when the total is known (``ntile`` does): the bucket
    count then needs no global window over the offsets table.
    """
    keys = [group_col, *order_cols]
    source = df.persist(StorageLevel.MEMORY_AND_DISK)
    ranged = (
        source.repartitionByRange(partitions, *[F.col(k).asc_nulls_first() for k in keys])
        .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    ranged = reliable_checkpoint(ranged)
    source.unpersist()

    counts = ranged.groupBy(group_col, "_pid").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_seq").alias("_seq0")
    )
    # counts has at most (range partitions + groups - 1) rows: each group
    # covers a contiguous run of range partitions
    before = Window.partitionBy(group_col).orderBy("_pid")
    offsets = counts.select(
        group_col,
        "_pid",
        "_seq0",
        (F.sum("_cnt").over(before) - F.col("_cnt")).alias("_before"),
        F.sum("_cnt").over(Window.partitionBy(group_col)).alias("n_group"),
        (
            F.lit(n_buckets).cast("long")
            if n_buckets is not None
            else bucket_count(F.sum("_cnt").over(Window.partitionBy()), target)
        ).alias("n_buckets"),
    )
    if offsets.count() <= OFFSETS_BROADCAST_MAX:
        offsets = F.broadcast(offsets)
    i = F.col("_before") + F.col("_seq") - F.col("_seq0")
    return (
        ranged.join(offsets, [group_col, "_pid"], "inner")
        .withColumn("bucket", ntile_of(i, F.col("n_group"), F.col("n_buckets")))
        .drop("_pid", "_seq", "_seq0", "_before")
    )


def bucket_plan(payloads: DataFrame, cfg: SyncConfig) -> DataFrame:
    """One row: payload count and bucket count."""
    return payloads.agg(F.count(F.lit(1)).alias("n_payloads")).select(
        "n_payloads", bucket_count(F.col("n_payloads"), cfg.target_batch_size).alias("n_buckets")
    )


def assign_buckets(payloads: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Payload rows (``app_id``, ``user_id``, ``payload_json``) with their
    bucket; the order inside an app is (user_id, payload_json), a total
    order since payloads are distinct per user."""
    return ntile(
        payloads,
        "app_id",
        ["user_id", "payload_json"],
        cfg.target_batch_size,
        cfg.bucket_partitions,
        cfg.rows_per_range_partition,
    )


def batches(bucketed: DataFrame) -> DataFrame:
    """One row per (app, bucket): the payloads as one JSON array, in
    (user_id, payload_json) order, and their count.

    Each group holds about ``target`` payloads (N is derived from the total,
    so a group never exceeds ceil(rows_app / N) <= about target + 1 rows).
    """
    item = F.struct(F.col("user_id"), F.col("payload_json"))
    ordered = F.array_sort(F.collect_list(item))
    return bucketed.groupBy("app_id", "bucket").agg(
        F.count(F.lit(1)).alias("n_payloads"),
        F.concat(
            F.lit("["),
            F.array_join(F.transform(ordered, lambda x: x["payload_json"]), ","),
            F.lit("]"),
        ).alias("payload_array"),
    )
