"""SimHash near-duplicates: fingerprints in shards of bounded size, each shard searched through a BK-tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import UPPER_TO_LOWER, batches_of, column_bytes
from starload.llm.graph import components
from starload.session import written

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
SHARD = 1_024
"""Fingerprints of a shard; a larger one is split again by bits that it does not share yet."""
_BATCH_BYTES = 1 << 20
_AT_ONCE = 1 << 16
"""Shingles whose bits are counted at once."""
_VISITS = 1 << 21
"""Tree nodes that may be looked at together, by all queries worked on at once."""

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_bounds(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Words joined by one space each, and where the shingles start and end in that."""
    data = np.frombuffer(text.translate(UPPER_TO_LOWER), np.uint8)
    space = _SPACE[data]
    first_space = space.copy()
    first_space[1:] &= ~space[:-1]
    joined = np.where(space, np.uint8(0x20), data)[~space | first_space].tobytes().strip(b" ")
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = np.concatenate([[0], gaps + 1]) if joined else np.zeros(0, np.int64)
    ends = np.concatenate([gaps, [len(joined)]]) if joined else starts
    run = min(SHINGLE, len(starts))
    return joined, starts[: len(starts) - run + 1 if run else 0], ends[run - 1 if run else 0 :]


def fingerprint(text: bytes | None) -> int:
    """The bits set in over half of the shingles' hashes; 0 without words."""
    joined, starts, ends = shingle_bounds(text or b"")
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(starts), _AT_ONCE):
        spans = zip(starts[k : k + _AT_ONCE].tolist(), ends[k : k + _AT_ONCE].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint's 64 bits as a signed long, for every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, _BATCH_BYTES):
                found = np.array([fingerprint(t) for t in column_bytes(batch.column("text"))], np.uint64)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(found.view(np.int64))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, "doc_id long, fp long")


# -- shards -------------------------------------------------------------------------------------


def split_masks(mask: int, radius: int) -> list[int]:
    """``mask`` with each of ``radius + 1`` even parts of the other bits added."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(free), radius + 1)]


def masks_after(splits: int, radius: int) -> list[int]:
    """All masks that so many splits can lead to; they follow from the radius alone."""
    masks = {0}
    for _ in range(splits):
        masks = {after for mask in masks for after in split_masks(mask, radius)}
    return sorted(masks)


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def shards(distinct: DataFrame, radius: int = RADIUS, limit: int = SHARD) -> DataFrame:
    """(mask, value, fp): fingerprints that agree in the bits of a mask, in shards of ``limit`` or fewer.

    Two fingerprints within the radius differ in at most that many bits, so of ``radius + 1`` parts of the bits
    they agree in one. A shard too large for one tree is dealt out again by the same rule over the bits that
    it does not share, and so on until each fits: no pair within the radius is lost, and no group of near
    copies, however large, stays together. Each split takes its share of the bits left, so with radius 3 six
    splits leave 11 bits, 2048 members at most, and the masks that a split can meet are 4^6 at most: that
    table is broadcast.
    """
    spark = distinct.sparkSession
    limit = max(limit, 1 << 2 * (radius + 1))  # enough free bits for a split to leave none of its parts empty
    rest = distinct.select(F.lit(0).cast("long").alias("mask"), "fp")
    out: DataFrame | None = None
    for level in range(BITS):
        ways = [(signed(m), [signed(after) for after in split_masks(m, radius)]) for m in masks_after(level, radius)]
        masks = F.broadcast(spark.createDataFrame(ways, "mask long, masks array<long>"))
        dealt = rest.join(masks, "mask").select("fp", F.explode("masks").alias("mask")).distinct() if level else (
            rest.select("fp", F.explode(F.array(*[F.lit(m) for m in ways[0][1]])).alias("mask"))
        )
        dealt = dealt.withColumn("value", F.col("fp").bitwiseAND(F.col("mask"))).select("mask", "value", "fp")
        sizes = dealt.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("members"))
        large = written(sizes.where(F.col("members") > limit).drop("members"), "bk-large")
        last = large.isEmpty()
        fits = dealt if last else dealt.join(large, ["mask", "value"], "left_anti")
        out = fits if out is None else out.unionByName(fits)
        if last:
            break
        rest = written(dealt.join(large, ["mask", "value"], "left_semi").select("mask", "fp"), "bk-rest")
    return out


# -- trees --------------------------------------------------------------------------------------


class Forest:
    """BK-trees of many shards. Node ``i`` hangs under ``parent[i]`` on the edge ``edge[i]``, its distance to it.

    ``starts`` holds where each shard begins among ``points``; its first point is the root. All trees
    grow together: points that hang under one node at one distance stay together, the first of them becomes the
    child, and the others go on below it.
    """

    def __init__(self, points: np.ndarray, starts: np.ndarray):
        self.points = points
        n = len(points)
        sizes = np.diff(np.append(starts, n))
        self.root = np.repeat(starts, sizes)
        self.size = np.repeat(sizes, sizes)
        parent = np.full(n, -1)
        edge = np.zeros(n, np.int64)
        waiting = np.setdiff1d(np.arange(n), starts, assume_unique=True)
        above = self.root[waiting]
        while len(waiting):
            distance = np.bitwise_count(points[waiting] ^ points[above]).astype(np.int64)
            _, first, group = np.unique(above * (BITS + 1) + distance, return_index=True, return_inverse=True)
            child = waiting[first]
            parent[child], edge[child] = above[first], distance[first]
            left = np.ones(len(waiting), bool)
            left[first] = False
            waiting, above = waiting[left], child[group][left]
        self.children = np.flatnonzero(parent >= 0)
        place = parent[self.children] * (BITS + 1) + edge[self.children]
        order = np.argsort(place, kind="stable")
        self.children, self.place = self.children[order], place[order]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) pairs within the radius, query before node: every point is looked up in its own tree.

        From a node at distance d only the edges d - radius to d + radius can lead to a match.
        """
        cost = np.cumsum(self.size)
        begin = 0
        while begin < len(self.points):
            spent = cost[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(cost, spent + _VISITS, side="right")))
            query = np.arange(begin, end)
            node = self.root[query]
            while len(query):
                distance = np.bitwise_count(self.points[query] ^ self.points[node]).astype(np.int64)
                met = (distance <= radius) & (query < node)
                yield query[met], node[met]
                base = node * (BITS + 1)
                low = np.searchsorted(self.place, base + np.maximum(distance - radius, 0), side="left")
                high = np.searchsorted(self.place, base + np.minimum(distance + radius, BITS), side="right")
                each = high - low
                offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                query, node = np.repeat(query, each), self.children[np.repeat(low, each) + offset]
            begin = end


def least_labels(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least member of each point's group, the groups being joined by the links."""
    label = np.arange(n)
    for a, b in links:
        while len(a):
            la, lb = label[a], label[b]
            open_ = la != lb
            if not open_.any():
                break
            a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while (label[label] != label).any():
                label = label[label]
    return label


def shard_links(sharded: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): each fingerprint that links to another of its shard, beside the first of its group there.

    A shard yields fewer links than it has members, whatever the number of pairs within the radius.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:  # a shard may go on in the next batch: only those that have ended are searched
            held.append(batch)
            count += batch.num_rows
            if count >= 1 << 16:
                ready, rest = _ended(pa.Table.from_batches(held))
                held, count = rest.to_batches(), rest.num_rows
                yield from _searched(ready, radius)
        if held:
            yield from _searched(pa.Table.from_batches(held), radius)

    laid = sharded.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
    return laid.select("mask", "value", "fp").mapInArrow(search, "a long, b long")


def _ended(rows: pa.Table) -> tuple[pa.Table, pa.Table]:
    starts = _starts(rows)
    return rows.slice(0, starts[-1]), rows.slice(starts[-1])


def _starts(rows: pa.Table) -> np.ndarray:
    mask, value = (rows.column(c).to_numpy() for c in ("mask", "value"))
    new = np.ones(len(mask), bool)
    new[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
    return np.flatnonzero(new)


def _searched(rows: pa.Table, radius: int) -> Iterator[pa.RecordBatch]:
    if not rows.num_rows:
        return
    points = rows.column("fp").to_numpy().view(np.uint64)
    label = least_labels(len(points), Forest(points, _starts(rows)).links(radius))
    linked = np.flatnonzero(label != np.arange(len(points)))
    signed_points = points.view(np.int64)
    yield pa.RecordBatch.from_pydict({"a": pa.array(signed_points[label[linked]]), "b": pa.array(signed_points[linked])})


# -- documents ----------------------------------------------------------------------------------


def linked_documents(docs: DataFrame, radius: int = RADIUS, limit: int = SHARD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row.

    Fingerprints link at ``radius`` differing bits or fewer; ``component_id`` is the least doc_id that links
    reach, the row's own included. Equal fingerprints are one node, so a group of copies costs one search.

    A null or empty text, or one of blanks, has the fingerprint zero, which links like any other; texts
    of any length are read whole, in bounded pieces. A null doc_id is the least of nothing: a component
    without any id has none. Repeated rows come out each, an empty table gives no rows, other columns are ignored.
    """
    every = written(fingerprints(docs), "bk-fingerprints")
    distinct = written(every.groupBy("fp").agg(F.min("doc_id").alias("least")), "bk-distinct")
    links = written(shard_links(shards(distinct, radius, limit), radius), "bk-shard-links")
    of_node = components(links).withColumnRenamed("node", "fp")
    rooted = distinct.join(of_node, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "bk-rooted")
    ids = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "bk-ids")
    of_fp = written(rooted.join(ids, "root").select("fp", "component_id"), "bk-components")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return every.join(of_fp, "fp").select("doc_id", digits, "component_id")
