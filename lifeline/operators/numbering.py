"""Row numbers within groups of any size, without a task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifeline.session import reliable_checkpoint

_PART, _LOCAL = "_part", "_local"


def number_rows(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... over all rows in the order of the columns
    or sort expressions ``order``, as a ``row_number()`` over one partition would
    give, but range-partitioned: rows are numbered where they are sorted, and one
    row a partition tells the others how many come before.  The sorted rows are
    checkpointed, so the numbers can't change when a task runs again."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    local = reliable_checkpoint(ranged.withColumn(_PART, F.spark_partition_id()).withColumn(_LOCAL, F.monotonically_increasing_id()))
    counts = local.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"), F.min(_LOCAL).alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # at most one row a partition: a bounded table in one task, and in the broadcast
    offsets = counts.select(F.col(_PART).alias("_in"), (before - F.col("_first") + 1).alias("_offset"))
    return local.join(F.broadcast(offsets), local[_PART] == F.col("_in")).select(*df.columns, (F.col(_LOCAL) + F.col("_offset")).alias(name))


def number_in_groups(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... per ``group`` in the order of the
    columns ``order`` (nulls first), as ``row_number()`` would give.

    Rows are range-partitioned by (group, order) and numbered inside each
    partition; the numbering is checkpointed, so it can't change when a task
    runs again.  Only a group that goes on from one partition into the next
    needs an offset: at most one per partition, so that table is broadcast.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = Window.partitionBy(_PART, group).orderBy(*order)
    ranged = df.repartitionByRange(n, group, *order).withColumn(_PART, F.spark_partition_id())
    local = reliable_checkpoint(ranged.withColumn(_LOCAL, F.row_number().over(inside)))
    counts = local.groupBy(group, _PART).agg(F.max(_LOCAL).cast("long").alias("n"))
    before = Window.partitionBy(group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.withColumn("_offset", F.sum("n").over(before))
        .where(F.col("_offset").isNotNull())
        .select(F.col(group).alias("_group"), F.col(_PART).alias("_in"), "_offset")
    )
    same = local[group].eqNullSafe(F.col("_group")) & (local[_PART] == F.col("_in"))
    return local.join(F.broadcast(offsets), same, "left").select(
        *df.columns, (F.col(_LOCAL) + F.coalesce("_offset", F.lit(0))).alias(name)
    )
