"""Sharding by Karmarkar-Karp differencing.

Equal texts are a group that no shard boundary may cut. Differencing keeps partial partitions of the groups, each a
vector of shard loads, and repeatedly combines the two with the largest spread in opposite order, the fullest part of one
with the emptiest of the other, until one partition is left.

One heap cannot hold all groups of a large corpus, so it is applied in levels. The groups are dealt by hash
into blocks of about BLOCK; differencing splits each block into WAYS bundles of nearly equal bytes,
and the bundles are the next level's groups, until at most FINAL are left, which one last differencing deals to the shards.
Two kinds of groups go to the last one as they are: those with at least 1 / HEAVY of all bytes (at most HEAVY, whatever
the data), which only the whole corpus can level out, and the first block of each level, whose finer and finer sizes fill
what coarser ones leave uneven.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewright.llm.common import spread_lookup, staged

SHARDS = 40
#: Bytes that a document takes besides its text.
OVERHEAD = 16
BLOCK, WAYS, FINAL, HEAVY = 4096, 8, 1 << 15, 1 << 13
#: Rows numbered together within a shard, and the fewest parts into which rows are dealt for that.
SLOT_ROWS, SLOT_PARTS = 1 << 16, 256


def difference(sizes: list[int], ways: int) -> np.ndarray:
    """The part (0 to ways - 1) of each size by Karmarkar-Karp differencing; earlier sizes win ties."""
    n = len(sizes)
    if n == 0:
        return np.zeros(0, np.int32)
    loads: list = []
    for s in sizes:
        v = np.zeros(ways, np.int64)
        v[0] = s
        loads.append(v)
    made: list[tuple[int, int, np.ndarray]] = []  # of each combination: its two parts and the order of its loads
    heap = [(-s, i) for i, s in enumerate(sizes)] if ways > 1 else [(0, i) for i in range(n)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        v = loads[a] + loads[b][::-1]
        order = np.argsort(-v, kind="stable")
        v = v[order]
        loads[a] = loads[b] = None
        made.append((a, b, order))
        loads.append(v)
        heapq.heappush(heap, (int(v[-1] - v[0]), len(loads) - 1))
    parts: dict[int, np.ndarray] = {len(loads) - 1: np.arange(ways, dtype=np.int32)}
    out = np.zeros(n, np.int32)
    for at in range(len(loads) - 1, n - 1, -1):
        own = parts.pop(at)
        a, b, order = made[at - n]
        back = np.empty(ways, np.int32)
        back[order] = own
        parts[a], parts[b] = back, back[::-1]
    for i in range(n):
        out[i] = parts[i][0]
    return out


def _split(ways: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("item", "ascending")])
        part = difference(table.column("size").to_pylist(), ways)
        return pa.table({"item": table.column("item"), "block": table.column("block"), "size": table.column("size"), "part": pa.array(part, pa.int32())})
    return run


def _parted(items: DataFrame, ways: int) -> DataFrame:
    """``items`` (item, size, block) with the part that differencing gives each within its block."""
    return items.groupBy("block").applyInArrow(_split(ways), "item string, block long, size long, part int")


def shards_of(groups: DataFrame, shards: int = SHARDS, block: int = BLOCK, ways: int = WAYS, final: int = FINAL, heavy: int = HEAVY) -> DataFrame:
    """(item, size) -> (item, shard): indivisible items dealt to shards of nearly equal total size."""
    items = groups.select("item", "size")
    total = items.agg(F.sum("size").alias("s")).first().s or 0
    bundled, last = [], []
    n, level = items.count(), 0
    while n > final:
        level += 1
        blocks = -(-n // block)
        dealt = items.withColumn("block", F.when(F.col("size") * heavy >= total, F.lit(-1)).otherwise(F.pmod(F.xxhash64("item"), F.lit(blocks))))
        last.append(dealt.where("block <= 0").select("item", "size"))
        name = F.concat_ws(":", F.lit(level), "block", "part")
        split = staged(_parted(dealt.where("block > 0"), ways).select("item", "size", name.alias("bundle")), "sharding-bundles")
        bundled.append(split.select("item", "bundle"))
        items = staged(split.groupBy("bundle").agg(F.sum("size").alias("size")).select(F.col("bundle").alias("item"), "size"), "sharding-items")
        n = items.count()
    for x in last:
        items = items.unionByName(x)
    # at most final + heavy items and a block a level, whatever the data: one task
    out = staged(_parted(items.withColumn("block", F.lit(0).cast("long")), shards).select("item", F.col("part").alias("shard")), "sharding-last")
    for split in reversed(bundled):
        below = split.join(out.select(F.col("item").alias("bundle"), "shard"), "bundle").select("item", "shard")
        out = staged(out.unionByName(below), "sharding-shards")
    return out


def _slotted(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (with shard, doc_id and a unique _uid) with ``slot``, gapless from 0 within each shard: rows are dealt to
    parts by hash, numbered there, and a part starts where the shard's earlier parts end."""
    parts = max(SLOT_PARTS, n // SLOT_ROWS)
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "_uid"), F.lit(parts)))
    sizes = dealt.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("doc_id", "_uid")) - 1
    return dealt.withColumn("_place", place).join(starts, ["shard", "_part"]).withColumn("slot", F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")


def _sized(docs: DataFrame) -> list:
    text = F.coalesce("text", F.lit(""))
    return [F.sha2(text, 256).alias("item"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]


def _dealt(rows: DataFrame, shards: int, **levels) -> DataFrame:
    """``rows`` (staged, with item, size, doc_id and _uid) with shard and slot."""
    groups = staged(rows.groupBy("item").agg(F.sum("size").alias("size")), "sharding-groups")
    found = spread_lookup(rows, shards_of(groups, shards, **levels), "item")
    return _slotted(staged(found, "sharding-dealt"), rows.count())


def shard(docs: DataFrame, shards: int = SHARDS, **levels) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A document's size is its text's UTF-8 bytes plus OVERHEAD. The law that holds is ``bytes``: shard sizes are near equal.
    Equal texts (null counts as empty) stay in one shard, so a group larger than the mean makes its shard that
    large and the others share the rest. Repeated rows are documents of their own, a null doc_id is numbered first,
    other columns are not read, and an empty table gives no rows. ``grown_shard`` is null: another number of shards deals anew.
    Only digests and sizes are shuffled, groups are summed map-side, and a hot group's rows find their shard by a spread lookup.
    """
    rows = staged(docs.select("doc_id", *_sized(docs), F.monotonically_increasing_id().alias("_uid")), "sharding-rows")
    return _dealt(rows, shards, **levels).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                                                 F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, **levels) -> DataFrame:
    """Write whole rows, each with its ``slot``, into folders ``shard=N`` below ``path``; returns (shard, rows, bytes) as written.

    The texts are shuffled once, in the parts in which rows are numbered, so a shard of any size is written by many tasks.
    """
    spark = docs.sparkSession
    rows = staged(docs.select(F.struct("*").alias("_row"), "doc_id", *_sized(docs), F.monotonically_increasing_id().alias("_uid")), "sharding-rows")
    whole = _dealt(rows, shards, **levels).select(F.col("_row").alias("row"), "size", "slot", "shard")
    whole.write.partitionBy("shard").mode("overwrite").parquet(path)
    back = spark.read.schema(whole.schema).parquet(path)
    return back.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
