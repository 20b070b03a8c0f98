"""Mixing sources to target weights by cube-method balanced sampling."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import copied, words
from starload.session import written

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_ROWS = 20_000
"""Rows a task handles in one flight; a larger source flies in several blocks."""
MERGED_BLOCKS = 5_000
"""Blocks whose few open rows meet in one block of the next round."""
LANDING = 12
"""Open rows left to the landing, which tries all 2**LANDING outcomes."""
DRAW, DRAWS = 11, 64
"""Seed and number of the draws that part rows equal in id, source and text."""
BROADCAST_SOURCES = 100_000
"""Sources whose shares are sent to every task, a few MB; more are joined by shuffle."""


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """One row per source of ``sizes(source, size)``: docs, source_size, target.

    Sources take the weights in turn, by code point, null last, and share ``share`` of all sizes. A
    target stops at ``cap`` times its source's size; the excess goes to the others by weight. Sources
    ordered by what a unit of weight may hold fill up in that order, so the level at which the first
    one is not full is everyone's.
    """
    per_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    ranked = per_source.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1)
    most = F.col("source_size") * F.lit(cap)
    filling = W.orderBy(F.col("most") / F.col("weight"), "rank")
    earlier = filling.rowsBetween(W.unboundedPreceding, -1)
    budget = F.sum("source_size").over(W.partitionBy()) * F.lit(share)
    levels = ranked.withColumn("weight", weight).withColumn("most", most).withColumn(
        "level",
        (budget - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
        / F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing)),
    )
    level = F.min(F.when(F.col("most") / F.col("weight") > F.col("level"), F.struct("rank_in", "level")))
    levels = levels.withColumn("rank_in", F.row_number().over(filling)).withColumn(
        "final", level.over(W.partitionBy())["level"]
    )
    target = F.coalesce(F.least("most", F.col("final") * F.col("weight")), F.col("most"))
    return levels.select("source", "rank", "docs", "source_size", target.alias("target"))


def fly(
    sizes: np.ndarray, chance: np.ndarray, rng: np.random.Generator, open_rows: int
) -> tuple[np.ndarray, list[int]]:
    """Move the chances through the null space of (1, size) until at most ``open_rows`` are open.

    Three rows at a time: a step along the direction that keeps their count and size total takes one
    of them to 0 or 1, and the next row joins. Returns the chances and the rows still open.
    """
    p = chance.tolist()
    s = sizes.tolist()
    queue = [i for i, x in enumerate(p) if 0.0 < x < 1.0]
    draws = rng.random(len(queue)).tolist()
    window, at, step = [], 0, 0
    while True:
        while len(window) < 3 and at < len(queue):
            window.append(queue[at])
            at += 1
        if len(window) < 3 or len(window) + len(queue) - at <= open_rows:
            break
        a, b, c = window
        u = (s[c] - s[b], s[a] - s[c], s[b] - s[a])
        if u == (0, 0, 0):
            u = (1, -1, 0)
        forth = back = float("inf")
        for i, x in zip(window, u):
            if x > 0:
                forth, back = min(forth, (1 - p[i]) / x), min(back, p[i] / x)
            elif x < 0:
                forth, back = min(forth, p[i] / -x), min(back, (1 - p[i]) / -x)
        move = forth if draws[step] * (forth + back) < back else -back
        step += 1
        for i, x in zip(window, u):
            p[i] += move * x
            if p[i] < 1e-9:
                p[i] = 0.0
            elif p[i] > 1 - 1e-9:
                p[i] = 1.0
        window = [i for i in window if 0.0 < p[i] < 1.0]
    return np.array(p), window + queue[at:]


def land(sizes: np.ndarray, chance: np.ndarray, rows: list[int]) -> np.ndarray:
    """Settle the last open rows: of all outcomes the one nearest to their expected size, then count."""
    if rows:
        s, p = sizes[rows].astype(float), chance[rows]
        outcomes = (np.arange(2 ** len(rows))[:, None] >> np.arange(len(rows))) & 1
        off = outcomes - p
        cost = np.abs(off @ s) + 0.01 * (s.mean() + 1) * np.abs(off.sum(axis=1))
        chance[rows] = outcomes[int(np.argmin(cost))]
    return chance


_ROUND = "doc_id long, source string, rank int, size long, source_size long, target double, n long, base int, whole long, " \
    "blocks int, block int, chance double"


def _flight(frame: pd.DataFrame) -> pd.DataFrame:
    """One block: sorted by size so that the rows left for the landing are the large ones."""
    frame = frame.sort_values(["size", "doc_id"], kind="stable").reset_index(drop=True)
    first = frame.iloc[0]
    last = int(first["blocks"]) <= 1
    seed = zlib.crc32(f"{first['source']}|{first['blocks']}|{first['block']}".encode())
    sizes = frame["size"].to_numpy()
    chance, left = fly(sizes, frame["chance"].to_numpy(), np.random.default_rng(seed), LANDING if last else 2)
    frame["chance"] = land(sizes, chance, left) if last else chance
    return frame


def taken(docs: DataFrame, size: Column | None = None, weights: Sequence[float] = WEIGHTS, share: float = 1.5,
          cap: float = 2.0) -> DataFrame:
    """Per distinct (doc_id, source, size) of ``docs``, with its ``n`` rows: source_size, target, base and more.

    Each of the rows is taken ``base`` times, and ``more`` of them once more.

    A source with rate r = target / source_size takes floor(r) copies of every document and a
    balanced sample of the rest: inclusion chance c = r - floor(r), the source's size and document totals
    held while the chances move to 0 or 1. Rows equal in id, source and size are one unit of the sample: floor(n c)
    of them are sure, and what is left, below one, is the unit's chance. So they cost one row, however many
    they are. A source flies in blocks of some ``BLOCK_ROWS`` units. Each leaves at most two units open; these
    meet in blocks of the next round, and the last block of a source lands. So a source of any size passes through
    no single task, and the driver sees the number of rows of the largest source. Only the sources themselves, a
    row each, are ranked in one task.
    """
    size = F.size(words(F.col("text"))) if size is None else size
    sized = written(docs.select("doc_id", "source", size.cast("long").alias("size")), "mix-sizes")
    shares = written(source_targets(sized, weights, share, cap), "mix-sources")
    sources, largest = shares.agg(F.count(F.lit(1)), F.max("docs")).first()
    named = shares.withColumnRenamed("source", "_source")
    if sources <= BROADCAST_SOURCES:
        named = F.broadcast(named)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    rated = units.join(named, units["source"].eqNullSafe(named["_source"])).withColumn("rate", rate)
    blocks = F.ceil(F.col("docs") / BLOCK_ROWS).cast("int")
    part = (F.col("rate") - F.floor("rate")) * F.col("n")
    opened = rated.select(
        "doc_id", "source", "rank", "size", "source_size", "target", "n",
        F.floor("rate").cast("int").alias("base"),
        F.floor(part).alias("whole"),
        blocks.alias("blocks"),
        F.pmod(F.xxhash64("doc_id", "size"), blocks).cast("int").alias("block"),
        (part - F.floor(part)).alias("chance"),
    )
    settled = []
    remaining = -(-(largest or 0) // BLOCK_ROWS)
    while True:
        done = written(opened.groupBy("rank", "block").applyInPandas(_flight, _ROUND), "mix-flight")
        is_open = (F.col("chance") > 0) & (F.col("chance") < 1)
        settled.append(done.where(~is_open))
        if remaining <= 1:
            break
        remaining = -(-remaining // MERGED_BLOCKS)
        opened = done.where(is_open).withColumns({
            "block": F.floor(F.col("block") / MERGED_BLOCKS).cast("int"),
            "blocks": F.ceil(F.col("blocks") / MERGED_BLOCKS).cast("int"),
        })
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionByName(more)
    more = (F.col("whole") + F.col("chance")).cast("long").alias("more")
    return rows.select("doc_id", "source", "size", "source_size", "target", "n", "base", more)


def mix(docs: DataFrame, **how) -> DataFrame:
    """Per row of ``docs(doc_id, source, ...)``: doc_id, source, size, source_size, target, copies; see ``taken``.

    ``size`` defaults to the number of words. Null text has size 0, and rows of size 0 are sampled by
    the document total alone. Null sources are one source. Repeated rows are separate rows. An empty
    table gives no rows. Other columns are ignored, texts of any length are read. Equal inputs give equal results in
    any partitioning.
    """
    rows = copied(taken(docs, **how))
    copies = F.col("base") + (F.col("nth") < F.col("more")).cast("int")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """``docs`` itself, each row as often as the mix takes it.

    Rows meet their copies by a 128-bit hash of id, source and size; the texts are shuffled once, by that hash.
    Where not all rows of a hash take one copy more, those of the least text hashes do (see ``chosen``), so equal
    inputs give equal rows, but for rows that differ only in columns the mix does not look at.

    Null ids, sources and texts are values like any other; repeated rows count each; an empty table gives no rows;
    all columns stay as they are.
    """
    key = F.unhex(F.md5(F.to_json(F.struct("_id", "_source", "_size")))).alias("_key")
    decided = taken(docs, **how).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "n", "base", "more"
    ).select(key, F.col("n").alias("_n"), F.col("base").alias("_base"), F.col("more").alias("_more"))
    decided = written(decided, "mix-decided")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")).select(
        "_row", F.col("_row.doc_id").alias("_id"), F.col("_row.source").alias("_source"),
        F.size(words(F.col("_row.text"))).cast("long").alias("_size"), F.xxhash64("_row.text").alias("_text"),
    ).select("_row", "_text", key)
    split = (F.col("_more") > 0) & (F.col("_more") < F.col("_n"))
    joined = rows.join(decided, "_key")
    copies = F.col("_base") + (F.col("_more") > 0).cast("int")
    counted = joined.where(~split).select("_row", copies.alias("_copies"))
    if not decided.where(split).isEmpty():
        undecided = written(joined.where(split).withColumn("_draw", F.floor(F.rand(DRAW) * DRAWS)), "mix-undecided")
        counted = counted.unionByName(chosen(undecided))
    return counted.where(F.col("_copies") > 0).select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


def before(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """``rows`` with ``_before``, the sum of ``value`` over those of the group that come earlier."""
    earlier = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("_before", F.coalesce(F.sum(value).over(earlier), F.lit(0)))


def chosen(rows: DataFrame) -> DataFrame:
    """_row and _copies for rows of which, per ``_key``, only ``_more`` are taken once more: those of the least text hash.

    The rows are counted per text, in every task first; the counts are added up over ranges of hashes and then
    within each, so no task sees all texts of a key. Of one text at most, rows are to be told apart at random;
    they are numbered within ``_draw``.
    """
    texts = rows.groupBy("_key", "_text").agg(F.count(F.lit(1)).alias("_same"), F.first("_more").alias("_of"))
    texts = written(texts.withColumn("_range", F.shiftrightunsigned("_text", 52)), "mix-texts")
    ranges = texts.groupBy("_key", "_range").agg(F.sum("_same").alias("_held"))
    ranges = written(before(ranges, ["_key"], ["_range"], "_held").withColumnRenamed("_before", "_start"), "mix-ranges")
    placed = before(texts, ["_key", "_range"], ["_text"], "_same").join(ranges.select("_key", "_range", "_start"), ["_key", "_range"])
    left = F.col("_of") - F.col("_start") - F.col("_before")
    extra = F.greatest(F.lit(0), F.least(F.col("_same"), left)).alias("_extra")
    shares = written(placed.select("_key", "_text", "_same", extra), "mix-shares")
    told = rows.join(shares, ["_key", "_text"])
    partly = (F.col("_extra") > 0) & (F.col("_extra") < F.col("_same"))
    whole = told.where(~partly).select("_row", (F.col("_base") + (F.col("_extra") > 0).cast("int")).alias("_copies"))
    group = ["_key", "_text"]
    draws = written(before(told.where(partly).groupBy(*group, "_draw").agg(F.count(F.lit(1)).alias("_drawn")), group, ["_draw"], "_drawn"), "mix-draws")
    nth = F.row_number().over(W.partitionBy(*group, "_draw").orderBy(F.lit(0)))
    some = told.where(partly).withColumn("_nth", nth).join(draws.drop("_drawn"), [*group, "_draw"])
    more = (F.col("_before") + F.col("_nth") <= F.col("_extra")).cast("int")
    return whole.unionByName(some.select("_row", (F.col("_base") + more).alias("_copies")))
