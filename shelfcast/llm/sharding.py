"""Sharding by fixed virtual slots and a versioned slot-to-shard map; sizes of shards come out nearly equal.

Every document hashes into one of SLOTS virtual slots, for good.  Bytes are summed by slot, and a map of SLOTS rows says
which shard holds which slot.  Rebalancing edits that map: it moves the slots that it takes, and no others,
from full shards to shards below their share, and gives the map the next version, which is written below the maps before it.  So documents follow sizes and not
ids, and adding a shard moves about one share of the bytes.  The only thing that is gathered is the map and the bytes
by slot, SLOTS rows whatever the corpus holds.

A document's position in its shard is the number of documents in the shard's earlier slots plus its
rank in its own slot, so no task sorts a whole shard.

Defined results.  Size is the bytes of the text plus 1; a null or empty text has size 1.  Rows without doc_id hash by their
text.  Equal rows are separate documents with positions of their own.  Empty table: no rows, and a map with every slot dealt
round.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.sources.files import names, version_path, versions

SLOTS = 4096
SHARDS = 8
TOLERANCE = 0.001
"""A shard this close to its share is left alone."""


@dataclass(frozen=True)
class SlotMap:
    """Shard of every virtual slot.  Editing gives a new map of the next version."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    @classmethod
    def fresh(cls, shards: int, slots: int = SLOTS) -> SlotMap:
        return cls(1, shards, tuple(slot % shards for slot in range(slots)))

    def edited(self, sizes: Sequence[int], shards: int | None = None) -> SlotMap:
        """The map for ``shards`` shards whose sums of ``sizes`` (by slot) are nearly equal.

        The largest slot that helps goes from the fullest shard to the emptiest, until none helps.
        Slots of a shard that is no longer there are dealt first, largest first.
        """
        shards = self.shards if shards is None else shards
        shard_of, held, load = list(self.shard_of), [[] for _ in range(shards)], [0] * shards
        homeless = []
        for slot, shard in enumerate(shard_of):
            if shard < shards:
                held[shard].append((sizes[slot], slot))
                load[shard] += sizes[slot]
            else:
                homeless.append((sizes[slot], slot))
        heap = [(total, shard) for shard, total in enumerate(load)]
        heapq.heapify(heap)
        for size, slot in sorted(homeless, reverse=True):
            total, shard = heapq.heappop(heap)
            held[shard].append((size, slot))
            load[shard] = total + size
            shard_of[slot] = shard
            heapq.heappush(heap, (load[shard], shard))
        share = sum(load) / shards
        for _ in range(len(shard_of)):
            full, empty = max(range(shards), key=load.__getitem__), min(range(shards), key=load.__getitem__)
            gap = load[full] - load[empty]
            if gap <= TOLERANCE * share:
                break
            room = max(share - load[empty], gap / 2)
            movable = [x for x in held[full] if 0 < x[0] <= room and x[0] < gap]
            if not movable:
                break
            size, slot = max(movable)
            held[full].remove((size, slot))
            held[empty].append((size, slot))
            load[full], load[empty] = load[full] - size, load[empty] + size
            shard_of[slot] = empty
        return SlotMap(self.version + 1, shards, tuple(shard_of))

    def rows(self, spark: SparkSession) -> DataFrame:
        """vslot, shard, version: the map as a table, to be stored beside the shards."""
        rows = [(slot, shard, self.version) for slot, shard in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "vslot int, shard int, version int")


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.xxhash64(F.when(F.col("doc_id").isNotNull(), F.col("doc_id").cast("long"))), F.lit(0))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(key)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.pmod(key, F.lit(slots)).cast("int").alias("vslot"))


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and documents of every virtual slot: ``slots`` numbers each."""
    sizes, counts = [0] * slots, [0] * slots
    for slot, size, count in rows.groupBy("vslot").agg(F.sum("size"), F.count(F.lit(1))).collect():
        sizes[slot], counts[slot] = int(size), int(count)
    return sizes, counts


def write_map(spark: SparkSession, plan: SlotMap, path: str) -> None:
    """Store a map beside those before it.  A version is written once."""
    plan.rows(spark).coalesce(1).write.parquet(f"{path.rstrip('/')}/v{plan.version}")


def stored_map(spark: SparkSession, path: str) -> SlotMap | None:
    """The newest map that is stored whole at ``path``, or None: as many rows as there are virtual slots."""
    for version in reversed(versions(spark, path)):
        folder = version_path(path.rstrip("/"), version)
        if "_SUCCESS" not in names(spark, folder):  # a job died while it wrote this one
            continue
        rows = spark.read.schema("vslot int, shard int, version int").parquet(folder).orderBy("vslot").collect()
        return SlotMap(version, max(row.shard for row in rows) + 1, tuple(row.shard for row in rows))
    return None


def into_shards(docs: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS) -> tuple[DataFrame, SlotMap]:
    """Every document with its shard and its position there, and the map that was used.

    The newest map stored at ``path`` is edited for the sizes of today and stored as the next version; where there is none the
    slots are dealt round first.  Documents are placed by the map as it is read back.
    """
    spark = docs.sparkSession
    rows = sized(docs, slots)
    sizes, counts = slot_sizes(rows, slots)
    current = stored_map(spark, path) or SlotMap.fresh(shards, slots)
    if len(current.shard_of) != slots:
        raise ValueError(f"the map at {path} has {len(current.shard_of)} slots, not {slots}")
    write_map(spark, current.edited(sizes, shards), path)
    plan = stored_map(spark, path)
    before, seen = [], [0] * shards
    for slot, shard in enumerate(plan.shard_of):
        before.append((slot, shard, seen[shard], plan.version))
        seen[shard] += counts[slot]
    table = F.broadcast(spark.createDataFrame(before, "vslot int, shard int, before long, version int"))
    ranked = rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("vslot").orderBy(F.col("doc_id").asc_nulls_last(), "size", "text_crc32")) - 1)
    placed = ranked.join(table, "vslot").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank")).alias("slot"), "vslot", "version")
    return placed, plan
