"""Sharding by fixed virtual slots.

Every record is hashed into one of ``SLOTS`` slots, for good.  A versioned map
assigns slots to shards; only the map is edited when shards are to be
rebalanced or added.  Bytes are aggregated per slot (map-side first), so
planning sees at most ``SLOTS`` numbers however large the corpus is; records
are placed by joining the map, a table of ``SLOTS`` rows.

Law of the placement: ``bytes`` (sizes of shards near equal).  The hash takes
the doc_id and the text's checksum, so copies of a text or rows of a doc_id
don't pile up in a slot; identical rows share one.

Defined results: a null text has size 1 and checksum 0; null doc_ids are hashed
like any value; rows of a slot are numbered by (doc_id, checksum, size), ties
in any order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lifeline.llm.tables import save, scratch_path

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """``shards[s]`` is the shard of slot s."""

    version: int
    n_shards: int
    shards: tuple[int, ...]

    @staticmethod
    def initial(n_shards: int, slots: int = SLOTS) -> SlotMap:
        return SlotMap(1, n_shards, tuple(s % n_shards for s in range(slots)))

    def rebalanced(self, weight: list[int]) -> SlotMap:
        """The next version: slots move to the smallest shard from the largest
        one that has a slot which brings the two closer, until none has."""
        shards, load = list(self.shards), [0] * self.n_shards
        own: list[list[tuple[int, int]]] = [[] for _ in range(self.n_shards)]
        for slot, shard in enumerate(shards):
            load[shard] += weight[slot]
            own[shard].append((weight[slot], slot))
        for x in own:
            x.sort()
        # shards without such a slot; the smallest load never falls, so they stay so until they get one
        stuck: set[int] = set()
        while len(stuck) < self.n_shards:
            top, low = max((s for s in range(self.n_shards) if s not in stuck), key=load.__getitem__), load.index(min(load))
            half = (load[top] - load[low]) / 2
            # moving less than twice the half narrows the gap; the closest to the half narrows it most
            fits = [x for x in own[top] if 0 < x[0] < 2 * half]
            if not fits:
                stuck.add(top)
                continue
            best = min(fits, key=lambda x: (abs(x[0] - half), x[1]))
            own[top].remove(best)
            own[low].append(best)
            shards[best[1]] = low
            load[top] -= best[0]
            load[low] += best[0]
            stuck.discard(low)
        return SlotMap(self.version + 1, self.n_shards, tuple(shards))

    def grown(self, weight: list[int]) -> SlotMap:
        """The next version with one more shard, which takes slots from the
        largest shards; no slot moves between the old ones."""
        shards, load, own = list(self.shards), [0] * self.n_shards, [[] for _ in range(self.n_shards)]
        for slot, shard in enumerate(shards):
            load[shard] += weight[slot]
            heapq.heappush(own[shard], (-weight[slot], slot))
        share, new = sum(load) / (self.n_shards + 1), 0
        while new < share and any(own):
            top = max((s for s in range(self.n_shards) if own[s]), key=load.__getitem__)
            minus, slot = heapq.heappop(own[top])
            load[top] += minus
            if new - minus <= share + max(weight) / 2:
                shards[slot] = self.n_shards
                new -= minus
        return SlotMap(self.version + 1, self.n_shards + 1, tuple(shards))

    def frame(self, spark: SparkSession) -> DataFrame:
        """(version, vslot, shard)."""
        listed = F.split(F.lit(",".join(map(str, self.shards))), ",")
        return spark.range(0, len(self.shards), 1, 1).select(
            F.lit(self.version).alias("version"),
            F.col("id").cast("int").alias("vslot"),
            F.get(listed, F.col("id").cast("int")).cast("int").alias("shard"),
        )


def store_maps(spark: SparkSession, maps: list[SlotMap], path: str | None = None) -> DataFrame:
    """Append versions to the map table and read it back."""
    path = path or scratch_path(spark, "slot-map")
    for m in maps:
        m.frame(spark).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot) per row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("vslot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_weights(rows: DataFrame, slots: int = SLOTS) -> list[int]:
    out = [0] * slots
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect():
        out[r["vslot"]] = r["bytes"]
    return out


def assign(docs: DataFrame, n_shards: int, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, version):
    ``slot`` numbers the rows of a shard from 0."""
    spark = docs.sparkSession
    rows = save(records(docs, slots), "shard-records")
    first = SlotMap.initial(n_shards, slots)
    maps = store_maps(spark, [first, first.rebalanced(slot_weights(rows, slots))], path)
    current = maps.where(F.col("version") == first.version + 1)
    counts = rows.groupBy("vslot").agg(F.count("*").alias("n"))
    # at most one row per virtual slot from here
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    placed = current.join(F.broadcast(counts), "vslot").select(
        "version", "vslot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    own = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("k", F.row_number().over(own).cast("long"))
        .join(F.broadcast(placed), "vslot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("base") + F.col("k") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "version",
        )
    )


def write_shards(docs: DataFrame, slot_map: SlotMap, out: str, files_per_shard: int = 1) -> None:
    """Write ``docs`` partitioned by shard, each shard in ``files_per_shard`` files."""
    base = [c for c in docs.columns if c != "shard"]
    text = F.coalesce("text", F.lit("")).cast("binary")
    vslot = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.crc32(text)), F.lit(len(slot_map.shards))).cast("int")
    spark = docs.sparkSession
    (
        docs.withColumn("__vslot", vslot)
        .join(F.broadcast(slot_map.frame(spark).select(F.col("vslot").alias("__vslot"), F.col("shard").alias("__shard"))), "__vslot")
        .select(*base, F.col("__shard").alias("shard"), F.pmod("__vslot", F.lit(files_per_shard)).alias("__file"))
        .repartition(slot_map.n_shards * files_per_shard, "shard", "__file")
        .drop("__file")
        .write.partitionBy("shard")
        .parquet(out)
    )
