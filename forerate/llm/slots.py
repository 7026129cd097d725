"""Operator 8: shards by fixed virtual slots.

A record hashes into one of thousands of virtual slots, for good. Only the small slot-to-shard map
changes: it is built from the bytes of each slot, stored under a version, and edited when shards are
added or have grown apart. The law kept is ``bytes``: shards have nearly equal sizes, as far as
single slots allow.

Results for odd input: a null text has no bytes; null ids hash like any value; repeated rows share a
virtual slot. An empty table gives an empty map of empty slots and no rows. Other columns of the
input are ignored.
"""

from __future__ import annotations

import bisect
import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forerate.sources.staging import new_path, staged

SLOTS = 8192
#: Bytes a record takes besides its text.
OVERHEAD = 16
MAP = "version int, vslot int, shard int, bytes long, records long"


def slot_records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Per record: id, size, checksum of the text and virtual slot."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return rows.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(slots)).cast("int"))


def slot_sizes(records: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(bytes, records) of every slot; as many as there are slots, whatever the input."""
    sums = records.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    found = {r["vslot"]: (int(r["b"]), int(r["n"])) for r in sums}
    return [found.get(i, (0, 0)) for i in range(slots)]


def balanced(sizes: list[tuple[int, int]], shards: int) -> list[int]:
    """A first map: slots from the largest down, each to the shard with the fewest bytes."""
    heap = [(0, s) for s in range(shards)]
    out = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda i: (-sizes[i][0], i)):
        held, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (held + sizes[slot][0], shard))
    return out


def rebalanced(old: list[int], sizes: list[tuple[int, int]], shards: int, slack: float = 0.01) -> list[int]:
    """The map edited for ``shards`` shards, moving few slots.

    Slots of shards that no longer exist go to the lightest ones. Then the lightest shard takes from
    the heaviest that has one the largest slot of at most half their difference, until what could be
    gained is within ``slack`` of the mean. Every move brings the two shards closer.
    """
    out = list(old)
    held = [0] * shards
    members: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(old):
        if shard >= shards:
            homeless.append(slot)
        else:
            held[shard] += sizes[slot][0]
            bisect.insort(members[shard], (sizes[slot][0], slot))

    def give(slot: int, shard: int) -> None:
        out[slot] = shard
        held[shard] += sizes[slot][0]
        bisect.insort(members[shard], (sizes[slot][0], slot))

    for slot in sorted(homeless, key=lambda i: (-sizes[i][0], i)):
        give(slot, min(range(shards), key=lambda s: (held[s], s)))
    least = slack * sum(held) / shards
    while True:
        light = min(range(shards), key=lambda s: (held[s], s))
        for heavy in sorted(range(shards), key=lambda s: (-held[s], s)):
            gap = held[heavy] - held[light]
            at = bisect.bisect_right(members[heavy], (gap // 2, len(sizes))) - 1
            if gap <= least or at >= 0 and members[heavy][at][0]:
                break
        if gap <= least or at < 0 or not members[heavy][at][0]:
            return out
        size, slot = members[heavy].pop(at)
        held[heavy] -= size
        give(slot, light)


def store_map(spark: SparkSession, folder: str, version: int, shard_of: list[int], sizes: list[tuple[int, int]]) -> DataFrame:
    """Write one version of the map, a row per slot, beside the earlier ones."""
    rows = [(i, s, *sizes[i]) for i, s in enumerate(shard_of)]
    table = spark.createDataFrame(rows, "vslot int, shard int, bytes long, records long")
    table.coalesce(1).write.parquet(f"{folder}/version={version}")
    return read_map(spark, folder, version)


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/version={version}").selectExpr(f"{version} version", "vslot", "shard", "bytes", "records")


def positions(records: DataFrame, shard_map: DataFrame) -> DataFrame:
    """Records with their shard and gapless position in it.

    A record's position is the records of its shard in lower virtual slots, known from the map, plus
    its rank in its own slot: no task sorts more than one slot.
    """
    lower = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = shard_map.select("vslot", "shard", F.coalesce(F.sum("records").over(lower), F.lit(0)).alias("slot_start"))
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    ranked = records.withColumn("rank", F.row_number().over(within) - 1)
    joined = ranked.join(F.broadcast(starts), "vslot")
    return joined.withColumn("slot", (F.col("slot_start") + F.col("rank")).cast("long"))


def shard(docs: DataFrame, shards: int, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, vslot, shard, slot`` by version 1 of a new map in ``folder``."""
    spark = docs.sparkSession
    records = staged(slot_records(docs, slots), "slot-records")
    sizes = slot_sizes(records, slots)
    shard_map = store_map(spark, folder or new_path(spark, "slot-map"), 1, balanced(sizes, shards), sizes)
    return positions(records, shard_map).select("doc_id", "size", "text_crc32", "vslot", "shard", "slot")


def write_shards(docs: DataFrame, shard_map: DataFrame, path: str, slots: int = SLOTS) -> str:
    """Write whole documents into one folder per shard, split by virtual slot on the way."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long") + OVERHEAD
    key = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), size, F.crc32(text.cast("binary"))), F.lit(slots)).cast("int")
    named = shard_map.select(F.col("vslot").alias("_vslot"), F.col("shard").alias("_shard"))
    rows = docs.withColumn("_vslot", key).join(F.broadcast(named), "_vslot")
    rows.repartition("_shard", "_vslot").drop("_vslot").write.partitionBy("_shard").parquet(path)
    return path
