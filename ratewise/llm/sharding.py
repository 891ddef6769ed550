"""Byte-balanced sharding by Karmarkar-Karp differencing (operator 2).

Rows with equal texts form a group that stays together. A partial partition gives every shard a number of bytes; each
group begins as one that puts all its bytes into one shard. The two partial partitions with the largest spread are
combined again and again, the fullest shard of one with the emptiest of the other, until one is left.

At scale the differencing works on a bounded list. Groups above ``total / (shards * lumps_per_shard)`` bytes enter one
by one (there are fewer than ``shards * lumps_per_shard`` of them); the smaller ones are first joined by a hash of
their digest into ``shards * lumps_per_shard`` lumps. So the list has at most twice that many entries whatever the
input, and only this list reaches the driver. Texts are never shuffled, only their digests.

Defined cases: null text counts as empty (16 bytes with the fixed row cost); repeated rows are copies and stay
together; an empty table gives an empty result; extra columns are ignored. A group larger than a fair share fills its
shard alone and the others share the rest.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratewise.llm.scratch import written

SHARDS = 40
LUMPS_PER_SHARD = 100
ROW_BYTES = 16
#: Rows of a shard are numbered within this many hash slices, so that no task holds a whole shard.
SLICES = 1024


def difference(sizes: dict[object, int], ways: int) -> dict[object, int]:
    """Shard of each key: Karmarkar-Karp multi-way differencing of ``sizes``.

    The heap holds partial partitions as (-spread, order, sums ascending, members per sum). Only the non-zero part of
    a partition is stored, so that single items stay small.
    """
    heap = [(-n, i, [n], [[k]]) for i, (k, n) in enumerate(sorted(sizes.items(), key=lambda x: (-x[1], str(x[0]))))]
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        full = [0] * (ways - len(sums)) + sums
        kept = [[]] * (ways - len(sums)) + members
        merged = [(s, m) for s, m in zip(full, kept)]
        for k, (n, m) in enumerate(zip(reversed(other), reversed(others))):
            merged[k] = (merged[k][0] + n, merged[k][1] + m)
        merged = sorted((x for x in merged if x[1]), key=lambda x: x[0])
        least = merged[0][0] if len(merged) == ways else 0
        heapq.heappush(heap, (least - merged[-1][0], order, [x[0] for x in merged], [x[1] for x in merged]))
        order += 1
    if not heap:
        return {}
    return {key: shard for shard, m in enumerate(reversed(heap[0][3])) for key in m}


def numbered(df: DataFrame, group: str, slice_key: Column, order: list[Column], name: str) -> DataFrame:
    """Gapless numbers from 0 within ``group``, in the order (hash slice, ``order``), without a whole group in a task."""
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(slice_key), F.lit(SLICES)).cast("int"))
    counts = sliced.groupBy(group, "_slice").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(group, "_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy(group, "_slice").orderBy(*order))
    return (sliced.withColumn("_k", within).join(offsets, [group, "_slice"])
            .withColumn(name, F.col("_before") + F.col("_k") - 1).drop("_slice", "_k", "_before"))


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                  lumps_per_shard: int = LUMPS_PER_SHARD, keep: list[str] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null), one row per document.

    ``keep`` names columns of ``docs`` to return as well, except those named like the columns above.
    """
    own = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    keep = [c for c in keep or [] if c not in own]
    text = F.coalesce(F.col(text_col), F.lit(""))
    facts = [F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
             F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("_digest")]
    rows = written(docs.select(*facts), "shard-rows")
    spark = docs.sparkSession
    groups = rows.groupBy("_digest").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = total / (shards * lumps_per_shard)
    lump = F.pmod(F.xxhash64("_digest"), F.lit(shards * lumps_per_shard)).cast("int")
    keyed = groups.select(F.when(F.col("bytes") > limit, F.col("_digest")).alias("_digest"),
                          F.when(F.col("bytes") <= limit, lump).alias("_lump"), "bytes")
    # At most 2 * shards * lumps_per_shard rows, by the choice of the limit.
    items = keyed.groupBy("_digest", "_lump").agg(F.sum("bytes").alias("bytes")).collect()
    shard_of = difference({(bytes(r[0]) if r[0] is not None else r[1]): r[2] for r in items}, shards)
    heavy = spark.createDataFrame([(bytearray(k), s) for k, s in shard_of.items() if isinstance(k, bytes)],
                                  "_digest binary, _heavy int")
    lumps = spark.createDataFrame([(k, s) for k, s in shard_of.items() if not isinstance(k, bytes)], "_lump int, _light int")
    if keep:
        rows = docs.select(*facts, F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_keep"))
    kept = ["_keep"] if keep else []
    placed = (rows.withColumn("_lump", lump).join(F.broadcast(heavy), "_digest", "left")
              .join(F.broadcast(lumps), "_lump", "left")
              .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                      F.coalesce("_heavy", "_light").alias("shard"), *kept))
    out = numbered(placed, "shard", F.struct("doc_id", "text_crc32"), [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("bigint").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"), *([F.col("_keep.*")] if keep else []))
