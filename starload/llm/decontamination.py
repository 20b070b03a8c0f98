"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import words
from starload.session import written

SHINGLE = 5
THRESHOLD = 0.8
BITS = 64
RADIUS = 4
"""Hamming distance within which the blocks, of 12 bits or 13, find every pair; unrelated ones seldom share a block.
Pairs beyond it are found by their rarest shingles."""
BROADCAST_SHINGLES = 500_000
"""Benchmark shingles sent to every task, some 20 MB; more are met by a shuffle of the documents' shingles."""


def plain_words(text: Column) -> Column:
    """Words of the lower-case text without punctuation around or inside them."""
    bare = F.translate(F.lower(F.coalesce(text, F.lit(""))), ".,;:!?\"'()[]{}", "")
    return words(bare)


def shingles(held: Column, size: int) -> Column:
    """Hash of each run of ``size`` words; none for a shorter text."""
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(held) - (size - 1), F.lit(1))),
        lambda i: F.xxhash64(*[F.get(held, i + (k - 1)) for k in range(size)]),
    )
    return F.when(F.size(held) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def own_shingles(held: Column, n_words: Column) -> Column:
    """Shingles as an item of ``n_words`` words has them: five words each, or all of a shorter item's."""
    found = F.array().cast("array<bigint>")
    for size in range(1, SHINGLE + 1):
        found = F.when(F.least(n_words, F.lit(SHINGLE)) == size, shingles(held, size)).otherwise(found)
    return found


def weighted_shingles(texts: DataFrame, key: list[str]) -> DataFrame:
    """``texts(*key, n_words, words)`` as rows (*key, shingle, weight); the weight is the number of occurrences."""
    rows = texts.select(*key, F.explode(own_shingles(F.col("words"), F.col("n_words"))).alias("shingle"))
    return rows.groupBy(*key, "shingle").agg(F.count(F.lit(1)).alias("weight"))


def fingerprints(weighted: DataFrame, key: list[str]) -> DataFrame:
    """SimHash per key: bit b is set when the shingles with that bit outweigh the others."""
    sums = [
        F.sum(F.when(F.getbit("shingle", F.lit(b)) == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"_{b}")
        for b in range(BITS)
    ]
    set_bits = [F.when(F.col(f"_{b}") > 0, F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)) for b in range(BITS)]
    fingerprint = set_bits[0].cast("long")
    for bit in set_bits[1:]:
        fingerprint = fingerprint.bitwiseOR(bit.cast("long"))
    per_key = weighted.groupBy(*key).agg(*sums, F.sum("weight").alias("total"))
    return per_key.select(*key, "total", fingerprint.alias("fingerprint"))


def blocks(fingerprint: Column, radius: int) -> Column:
    """The fingerprint cut into radius + 1 blocks: within that distance at least one block is equal."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[
        F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for low, high in zip(edges, edges[1:])
    ])


def rarest(of_items: DataFrame, threshold: float) -> DataFrame:
    """Of each item the shingles that the fewest items have, with more than 1 - threshold of its weight.

    A text as similar as the threshold shares at least that part of the item's weight, so it shares one of these.
    A shingle that many items have in common is seldom among them.
    """
    held = of_items.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"))
    item = W.partitionBy("item")
    earlier = item.orderBy("held", "shingle").rowsBetween(W.unboundedPreceding, -1)
    ranked = of_items.join(held, "shingle").withColumns({
        "before": F.coalesce(F.sum("weight").over(earlier), F.lit(0)), "total": F.sum("weight").over(item),
    })
    return ranked.where(F.col("before") <= (1 - threshold) * F.col("total") + 1e-9)


def row_name(doc_id: Column, text: Column) -> Column:
    """128 bits that name a row by its id and text."""
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), doc_id, text)), 16, "0") for k in (1, 2)])


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """Windows of documents that are nearly a benchmark item.

    Rows: doc_id, item_id, start (word of the document, from 0), n_words, distance, similarity.

    1. The shingles of all documents meet those of the items. A window that shares none has
       similarity 0, so this loses nothing.
    2. Each meeting lays an item-sized window where the two places coincide. Windows are
       fingerprinted by SimHash over their weighted shingles, as are the items.
    3. A multi-index join on (item size, block number, block) proposes every pair within ``radius``. A similar
       pair may be further apart, as when one shingle is repeated often; those share one of the item's
       rarest shingles, and are proposed by that (see ``rarest``).
    4. Of the pairs proposed, those whose weighted Jaccard similarity, sum of least over sum of greatest
       weights, is at least ``threshold`` are returned: none is lost, whatever the radius.

    An item or document without words matches nothing. An item of fewer than five words is one
    shingle of all its words, and is looked for as such.
    Null ids stay null. Repeated rows of a document give one row per window. Empty tables give no
    rows; other columns are ignored.
    """
    items = written(
        benchmark.select("item_id", plain_words(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("item", F.xxhash64(F.col("item_id"), F.array_join("words", " ")))
        .withColumn("n_words", F.size("words"))
        .dropDuplicates(["item"]),
        "leak-items",
    )
    item_shingles = written(
        items.select(
            "item", "n_words", F.posexplode(own_shingles(F.col("words"), F.col("n_words"))).alias("item_at", "shingle")
        ),
        "leak-shingles",
    )
    sizes = [r["size"] for r in items.select(F.least("n_words", F.lit(SHINGLE)).alias("size")).distinct().collect()]

    wanted = F.broadcast(item_shingles) if item_shingles.count() <= BROADCAST_SHINGLES else item_shingles

    row = row_name(F.col("doc_id"), F.col("text")).alias("row")
    split = docs.select("doc_id", row, plain_words(F.col("text")).alias("words"))
    runs = F.flatten(F.array(*[
        F.transform(shingles(F.col("words"), k), lambda h, i: F.struct(i.alias("at"), h.alias("shingle"))) for k in sizes
    ])) if len(sizes) > 1 else None
    counted = split.select("row", F.size("words").alias("doc_words"), "words")
    if runs is None:  # all items have five words or more, as a rule
        places = F.posexplode(shingles(F.col("words"), (sizes or [SHINGLE])[0])).alias("at", "shingle")
    else:
        places = F.inline(runs)
    spread = counted.select("row", "doc_words", places)
    met = spread.join(wanted, "shingle")
    last = F.greatest(F.col("doc_words") - F.col("n_words"), F.lit(0))
    start = F.least(F.greatest(F.col("at") - F.col("item_at"), F.lit(0)), last)
    places = written(met.select("row", start.alias("start"), "n_words").distinct(), "leak-places")

    texts = docs.select("doc_id", row, plain_words(F.col("text")).alias("all_words"))
    wide = texts.join(places, "row").select(
        "doc_id", "row", "start", "n_words", F.slice("all_words", F.col("start") + 1, F.col("n_words")).alias("words")
    )
    key = ["row", "start", "n_words"]
    windows = written(wide.dropDuplicates(key), "leak-windows")
    of_windows = written(weighted_shingles(windows, key), "leak-window-shingles")
    of_items = written(weighted_shingles(items, ["item", "n_words"]), "leak-item-shingles")

    window_prints = written(fingerprints(of_windows, key), "leak-window-prints")
    item_prints = written(fingerprints(of_items, ["item", "n_words"]).withColumnsRenamed(
        {"fingerprint": "item_print", "total": "item_total"}
    ), "leak-item-prints")
    near = (
        window_prints.select("*", F.posexplode(blocks(F.col("fingerprint"), radius)).alias("block", "bits"))
        .join(
            item_prints.select("*", F.posexplode(blocks(F.col("item_print"), radius)).alias("block", "bits")),
            ["n_words", "block", "bits"],
        )
        .withColumn("distance", F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))))
        .where(F.col("distance") <= radius)
        .groupBy(*key, "item")
        .agg(*[F.first(c).alias(c) for c in ("distance", "total", "item_total")])
    )
    prints = item_prints.select("item", "item_print", "item_total")
    beyond = (
        of_windows.select(*key, "shingle")
        .join(rarest(of_items, threshold).select("item", "n_words", "shingle"), ["n_words", "shingle"])
        .select(*key, "item").distinct()
        .join(window_prints, key).join(prints, "item")
        .withColumn("distance", F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))))
        .where(F.col("distance") > radius)
    )
    near = written(near.unionByName(beyond.select(near.columns)), "leak-near")
    shared = (
        near.join(of_windows.withColumnRenamed("weight", "window_weight"), key)
        .join(of_items.drop("n_words").withColumnRenamed("weight", "item_weight"), ["item", "shingle"])
        .groupBy(*key, "item", "distance", "total", "item_total")
        .agg(F.sum(F.least("window_weight", "item_weight")).alias("least"))
    )
    similarity = F.col("least") / (F.col("total") + F.col("item_total") - F.col("least"))
    found = shared.withColumn("similarity", similarity).where(F.col("similarity") >= threshold)
    return (
        found.join(windows.select("doc_id", *key), key)
        .join(items.select("item", "item_id"), "item")
        .select("doc_id", "row", "item_id", "start", "n_words", F.col("distance").cast("int").alias("distance"), "similarity")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` without a leak, all columns as they are.

    Null, empty and blank texts hold no leak and stay, as all rows do when there are no items. Repeated rows stay or
    go together; columns of any name may be there. Texts of any length are read whole.
    """
    caught = written(leaks(docs, benchmark, **how).select(F.col("row").alias("_row")).distinct(), "leak-rows")
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")).withColumn(
        "_row", row_name(F.col("_doc.doc_id"), F.col("_doc.text"))
    )
    return kept.join(caught, "_row", "left_anti").select("_doc.*")
