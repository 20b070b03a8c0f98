"""Shards of near equal bytes by Karmarkar-Karp differencing over groups that must stay together."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import copied
from starload.session import written

BUNDLES = 4096
SLOTS_PER_BUCKET = 100_000


def differencing(sizes: Sequence[int], ways: int) -> list[int]:
    """Bin of each item: combine the two partial partitions of largest spread, oppositely ordered."""
    heap = [(-size, i, [size] + [0] * (ways - 1), [i] + [None] * (ways - 1)) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, sums, held = heapq.heappop(heap)
        _, _, other_sums, other_held = heapq.heappop(heap)
        merged = sorted(
            (
                (a + b, k, x if y is None else y if x is None else (x, y))
                for k, (a, b, x, y) in enumerate(zip(sums, reversed(other_sums), held, reversed(other_held)))
            ),
            key=lambda m: (-m[0], m[1]),
        )
        least = merged[-1][0]
        heapq.heappush(
            heap, (least - merged[0][0], made, [m[0] - least for m in merged], [m[2] for m in merged])
        )
        made += 1
    bins = [0] * len(sizes)
    for number, held in enumerate(heap[0][3] if heap else []):
        stack = [held]
        while stack:
            item = stack.pop()
            if isinstance(item, tuple):
                stack.extend(item)
            elif item is not None:
                bins[item] = number
    return bins


def measured(docs: DataFrame) -> DataFrame:
    """Id, size, checksum and group key of each row; the text is left behind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("key"),
    )


def assign_shards(docs: DataFrame, shards: int = 8, bundles: int = BUNDLES) -> DataFrame:
    """Every row with its shard and its slot, 0, 1, ... within the shard.

    Rows of equal text are one indivisible group. A group of at least 1/bundles of all bytes stands
    alone, so there are at most ``bundles`` of those; all smaller groups are summed into ``bundles``
    hash bundles. The at most ``2 * bundles`` sums, whatever the input, are differenced in one task,
    and the assignment goes back to the rows by broadcast joins of that proven size.

    Null and empty texts are one group of size 1 a row. Repeated rows each get a slot. A group larger
    than a shard's share decides the balance, as it may not be split. An empty table gives no rows;
    other columns are ignored.
    """
    rows = written(measured(docs), "shard-rows")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    bundle = F.pmod(F.xxhash64("key"), F.lit(bundles)).cast("int")
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    is_large = F.col("bytes") * bundles >= total
    large = groups.where(is_large).select("key", F.lit(None).cast("int").alias("bundle"), "bytes")
    small = groups.where(~is_large).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes"))
    items = large.unionByName(small.select(F.lit(None).cast("binary").alias("key"), "bundle", "bytes"))

    def balance(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [f for f in frames if len(f)]
        if got:
            held = pd.concat(got)
            held["order"] = [k.hex() if k is not None else "" for k in held["key"]]
            held = held.sort_values(["bytes", "order", "bundle"], ascending=[False, True, True])
            held["shard"] = differencing([int(b) for b in held["bytes"]], shards)
            yield held[["key", "bundle", "shard"]]

    placed = written(items.repartition(1).mapInPandas(balance, "key binary, bundle int, shard int"), "shard-plan")
    by_key = placed.where(F.col("key").isNotNull()).select("key", F.col("shard").alias("own_shard"))
    by_bundle = placed.where(F.col("key").isNull()).select("bundle", F.col("shard").alias("bundle_shard"))
    homed = (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(by_key), "key", "left")
        .join(F.broadcast(by_bundle), "bundle", "left")
        .withColumn("shard", F.coalesce("own_shard", "bundle_shard"))
        .drop("own_shard", "bundle_shard", "bundle")
    )
    return with_slots(homed, -(-count // SLOTS_PER_BUCKET))


def with_slots(homed: DataFrame, buckets: int) -> DataFrame:
    """Number the rows of each shard without bringing a shard together: bucket counts, then rows of a bucket.

    Rows equal in id and text differ in nothing but their slots. They are counted in every task first and take
    the slots after each other, so no bucket holds them one by one.
    """
    kinds = homed.groupBy("shard", "doc_id", "key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    spread = kinds.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "key"), F.lit(max(buckets, 1))).cast("int"))
    spread = written(spread, "shard-kinds")
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = spread.groupBy("shard", "bucket").agg(F.sum("n").alias("n"))
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("shard", "bucket").orderBy("doc_id", "key").rowsBetween(W.unboundedPreceding, -1)
    placed = spread.withColumn("place", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, ["shard", "bucket"])
    start = (F.col("offset") + F.col("place")).alias("start")
    ranges = copied(placed.select("doc_id", "size", "text_crc32", "shard", start, "n"))
    return ranges.select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth")).cast("long").alias("slot"))


