"""Near-duplicates by ProbMinHash over weighted word shingles, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import batches_of, column_bytes, split_words
from starload.llm.graph import components
from starload.session import written

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 40
ROWS = 6
"""A pair of similarity 0.8 shares no band with probability (1 - 0.8**6)**40, about 6e-6."""
COMMON = 50
"""Nodes of a hub that may share a shingle the hub lacks before it counts as common to them all."""
PIECE = 2_000
"""Texts that meet one text in a task; those of a larger hub are dealt out, with the hub's text once per piece."""
_BATCH_BYTES = 1 << 20
_BATCH_COMPONENTS = 1 << 18
_KNOWN_WORDS = 1 << 16
"""Text and signature components worked on at once, and word hashes remembered."""


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: independent looking 64-bit values from counters."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """64-bit hashes of five-word runs; a text of one to four words is one run of all its words."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def word_hashes(self, held: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > _KNOWN_WORDS:
            known.clear()
        for word in set(held).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, held), np.uint64, len(held))

    def runs(self, held: list[bytes]) -> np.ndarray:
        hashes = self.word_hashes(held)
        size = min(SHINGLE, len(held))
        if not size:
            return hashes
        n = len(held) - size + 1
        run = np.zeros(n, np.uint64)
        for k in range(size):
            run = mixed(run + hashes[k : k + n] + np.uint64(0x9E3779B97F4A7C15))
        return run

    def weighted(self, held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles in order with their numbers of occurrences."""
        return np.unique(self.runs(held), return_counts=True)


def signatures(shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, size: int) -> np.ndarray:
    """ProbMinHash of ``n`` texts: (n, size) ids of the shingle that arrived first at each component.

    A shingle of weight w sends arrivals as a Poisson process of rate w, each to a random component.
    Round by round every live shingle makes its next arrival; one later than the latest first arrival
    of its text can change nothing any more, nor can those after it, so the shingle ends there.
    Equal shingles draw equal numbers in every text, so a component agrees with the probability
    Jaccard similarity.
    """
    best = np.full((n, size), np.inf)
    winner = np.zeros((n, size), np.uint64)
    time = np.zeros(len(shingles))
    live = np.arange(len(shingles))
    number = 0
    latest = np.full(n, np.inf)
    while len(live):
        number += 1
        draw = mixed(shingles[live] + np.uint64((number * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        step = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time[live] -= np.log(step) / weights[live]
        if number in (2, 3, 5) or number % 8 == 0:  # an older, later bound only ends shingles later
            texts = np.unique(owner[live])
            latest[texts] = best[texts].max(axis=1)
        live = live[time[live] < latest[owner[live]]]
        draw = mixed(shingles[live] ^ np.uint64((number * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF))
        place = owner[live] * size + (draw % np.uint64(size)).astype(np.int64)
        flat, won = best.reshape(-1), winner.reshape(-1)
        np.minimum.at(flat, place, time[live])
        first = flat[place] == time[live]
        won[place[first]] = shingles[live[first]]
    return winner


def band_hashes(winner: np.ndarray, bands: int, rows: int) -> np.ndarray:
    n = len(winner)
    parts = winner.reshape(n, bands, rows)
    hashed = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (n, 1))
    for k in range(rows):
        hashed = mixed(hashed * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return hashed.view(np.int64)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Sum over shared d of 1 / sum over e of max(x_e / x_d, y_e / y_d), for distinct ordered shingles."""
    shared, at, by = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    both_x, both_y = x[at].astype(float), y[by].astype(float)
    if both_x.max() == both_x.min() and both_y.max() == both_y.min():
        ratio_x, ratio_y = both_x[0], both_y[0]
        return len(shared) / (len(shared) + (x.sum() - both_x.sum()) / ratio_x + (y.sum() - both_y.sum()) / ratio_y)
    ratio = both_x / both_y
    order = np.argsort(ratio, kind="stable")
    ratio, sx, sy = ratio[order], both_x[order], both_y[order]
    # e with a greater ratio than d counts x_e / x_d, any other y_e / y_d
    x_after = np.concatenate([np.cumsum(sx[::-1])[::-1], [0.0]])
    y_until = np.concatenate([[0.0], np.cumsum(sy)])
    cut = np.searchsorted(ratio, ratio, side="right")
    alone_x, alone_y = x.sum() - both_x.sum(), y.sum() - both_y.sum()
    return float(np.sum(1.0 / ((x_after[cut] + alone_x) / sx + (y_until[cut] + alone_y) / sy)))


def row_hash() -> Column:
    """Names a row by its id and text."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, row, key (hash of the words) and the band hashes of every row; no bands without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        at_once = max(1, _BATCH_COMPONENTS // (bands * rows))
        for whole in batches:
            parts = (whole.slice(i, at_once) for i in range(0, whole.num_rows, at_once))
            for batch in (b for part in parts for b in batches_of(part, _BATCH_BYTES)):
                held = [split_words(t) for t in column_bytes(batch.column("text"))]
                weighted = [shingler.weighted(h) for h in held]
                owner = np.repeat(np.arange(len(held)), [len(s) for s, _ in weighted])
                winner = signatures(
                    np.concatenate([s for s, _ in weighted]), np.concatenate([w for _, w in weighted]).astype(float),
                    owner, len(held), bands * rows,
                )
                hashed = band_hashes(winner, bands, rows)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"),
                    "row": batch.column("row"),
                    "key": pa.array([xxhash.xxh3_128_digest(b" ".join(h)) for h in held], pa.binary()),
                    "bands": pa.array([b if h else [] for b, h in zip(hashed, held)], pa.list_(pa.int64())),
                })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("row"), "text").mapInArrow(
        sign, "doc_id long, row long, key binary, bands array<long>"
    )


def beside(members: DataFrame, group: str, member: str, texts: DataFrame, kept: list[str]) -> DataFrame:
    """Rows (group, kind, *kept, text): per group its own text (kind 0), then its members with theirs (kind 1).

    Rows come sorted so, a group of more than ``PIECE`` members in pieces of some ``PIECE``: each piece begins with
    the group's text, which is thus sent and split once per piece and not once per member, and no group, however
    large, is one task's. There are at most members / ``PIECE`` groups in pieces.
    """
    sizes = members.groupBy(F.col(group).alias("_large")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > PIECE)
    large = written(sizes.select("_large", F.ceil(F.col("_n") / PIECE).alias("_pieces")), "near-large")
    piece = F.coalesce(F.pmod(F.xxhash64(member), F.col("_pieces")), F.lit(0)).cast("int")
    dealt = members.join(large, F.col(group) == F.col("_large"), "left").withColumn("piece", piece).drop("_large", "_pieces")
    heads = written(dealt.select(group, "piece").distinct(), "near-heads")
    nothing = [F.lit(None).cast(members.schema[c].dataType).alias(c) for c in kept]
    heads = heads.join(texts.select(F.col("node").alias(group), "text"), group).select(
        group, "piece", F.lit(0).alias("kind"), *nothing, "text"
    )
    rows = dealt.join(texts.select(F.col("node").alias(member), "text"), member).select(
        group, "piece", F.lit(1).alias("kind"), *kept, "text"
    )
    laid = heads.unionByName(rows).repartition(group, "piece").sortWithinPartitions(group, "piece", "kind")
    return laid.select(group, "kind", *kept, "text")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts have at least that probability Jaccard similarity."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        of_b: tuple[np.ndarray, np.ndarray] | None = None
        for whole in batches:
            for batch in batches_of(whole, _BATCH_BYTES):
                kept = []
                for kind, text in zip(batch.column("kind").to_pylist(), column_bytes(batch.column("text"))):
                    weighted = shingler.weighted(split_words(text))
                    if kind == 0:
                        of_b = weighted
                    kept.append(kind == 1 and probability_jaccard(*weighted, *of_b) >= threshold)
                yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return beside(pairs.select("a", "b"), "b", "a", texts, ["a"]).select("a", "b", "kind", "text").mapInArrow(verify, "a long, b long")


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, row, class_id and root for every row.

    ``root`` names the class: the least row hash of its nodes. ``class_id`` is the least doc_id of the class,
    null when it has none; classes that would share one, as ids repeat or several have none, take their root instead.

    Rows of the same words are one node. Nodes that share a band are candidates, verified on their
    whole texts; classes are the connected components of the verified pairs.

    In a bucket of n nodes first only the n - 1 pairs with its hub are looked at, the node that shares
    most buckets with others, and of all hubs of a node first the one that shares most. Pairs that are
    already in one class need no more work. Nodes of a bucket that still spans several classes go
    through ``prefix_pairs``, which finds every pair across classes that can reach the threshold: a
    large group of copies costs its size, and texts somewhat like it are not compared pair by pair.

    Texts without words form one class; long ones are read whole. A null doc_id is not the least of a class that has
    others. Repeated rows share a class. An empty table gives no rows; other columns are ignored.
    """
    every = written(signed(docs, bands, rows), "near-signed")
    keys = written(every.groupBy("key").agg(F.min("row").alias("node")), "near-keys")
    members = every.join(keys.select(F.col("node").alias("row")), "row", "left_semi").dropDuplicates(["row"]).select(
        F.col("row").alias("node"), F.explode("bands").alias("bucket")
    )
    members = written(members, "near-members")
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(members.join(written(shared, "near-shared"), "bucket"), "near-buckets")
    degrees = buckets.groupBy("node").agg(F.sum(F.col("n") - 1).alias("degree"))
    ranked = buckets.join(degrees, "node").select("bucket", "node", F.struct("degree", "node").alias("rank"))
    ranked = written(ranked, "near-ranked")
    hubs = written(ranked.groupBy("bucket").agg(F.max("rank").alias("hub")), "near-hubs")
    stars = ranked.join(hubs, "bucket").where("rank <> hub").select(F.col("node").alias("a"), "hub").distinct()
    stars = written(stars.select("a", F.col("hub.node").alias("b"), "hub"), "near-stars")
    involved = written(stars.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "near-involved")
    texts = docs.select(row_hash().alias("row"), "text").join(involved, "row").dropDuplicates(["row"])
    texts = written(texts.select(F.col("row").alias("node"), "text"), "near-texts")

    first = written(stars.groupBy("a").agg(F.max("hub").alias("hub")).select("a", F.col("hub.node").alias("b")), "near-first")
    linked = written(verified(first, texts, threshold), "near-links")
    roots = components(linked)
    again = written(apart(stars.select("a", "b").join(first, ["a", "b"], "left_anti"), roots), "near-again")
    if not again.isEmpty():
        linked = written(linked.unionByName(verified(again, texts, threshold)), "near-links")
        roots = components(linked)

    placed = with_root(buckets, "node", roots, "root")
    torn = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    torn = written(torn.select("bucket"), "near-torn")
    if not torn.isEmpty():
        apart_still = written(placed.join(torn, "bucket").select("node", "root").distinct(), "near-apart")
        ties = stars.select(F.col("a").alias("node"), F.col("b").alias("hub"))
        cross = prefix_pairs(texts, ties, apart_still, threshold)
        stars_by_order = stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        rest = written(cross.join(stars_by_order, ["a", "b"], "left_anti"), "near-rest")
        if not rest.isEmpty():
            linked = written(linked.unionByName(verified(rest, texts, threshold)), "near-links")
            roots = components(linked)

    of_key = written(with_root(keys, "node", roots, "root").select("key", "root"), "near-roots")
    rooted = every.select("doc_id", "row", "key").join(of_key, "key")
    least = written(rooted.groupBy("root").agg(F.min("doc_id").alias("least")), "near-least")
    repeated = least.where("least is not null").groupBy("least").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = written(repeated.select(F.col("least").alias("_least")), "near-repeated")
    without = least.where("least is null").limit(2).count()
    named = least.join(repeated, F.col("least") == F.col("_least"), "left").select(
        "root", F.when(F.col("_least").isNotNull() | (F.col("least").isNull() & F.lit(without > 1)), F.col("root"))
        .otherwise(F.col("least")).alias("class_id"),
    )
    return rooted.join(named, "root").select("doc_id", "row", "class_id", "root")


def prefix_pairs(texts: DataFrame, stars: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of different roots, both tied to one hub, that may reach the threshold; none is lost.

    ``texts(node, text)``, ``stars(node, hub)``, ``roots(node, root)``. Within a hub, a shingle is private
    when it is neither in the hub's text nor held by more than ``COMMON`` nodes. All texts order their
    shingles alike, private ones first, rare ones before frequent ones.

    Let X and Y be what is left of each text's weight (of 1) from the first shared shingle on. What
    lies before is not shared, and then the probability Jaccard is at most XY / (X + Y - XY): each
    shared d contributes at most x_d y_d / (x_d + q_x y_d), a concave and homogeneous term, so the sum
    is bounded by its value at the sums. Hence a similar pair first meets where 1/X + 1/Y <= 1 + 1/threshold.

    If it first meets at a shingle that is not private, it shares no private one. For texts that
    repeat no shingle at most k = min(k_x, k_y) can then be shared, with k_x the number of x's shingles
    that are not private, so k >= threshold * (n_x + n_y - k). This spares the copies of a hub that
    each went their own way the comparison with all others. Only nodes outside the hub's most frequent
    root look for partners.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        of_hub = np.zeros(0, np.uint64)
        names = ("hub", "node", "root", "shingle", "mass", "own", "n")
        for whole in batches:
            for batch in batches_of(whole, _BATCH_BYTES):
                columns: dict[str, list] = {c: [] for c in names}
                rows = zip(*(batch.column(c).to_pylist() for c in ("hub", "kind", "node", "root")), column_bytes(batch.column("text")))
                for hub, kind, node, root, text in rows:
                    shingles, weights = shingler.weighted(split_words(text))
                    if kind == 0:
                        of_hub = shingles
                        continue
                    n = len(shingles)
                    for name, value in (("hub", hub), ("node", node), ("root", root)):
                        columns[name].append(np.full(n, value, np.int64))
                    columns["shingle"].append(shingles.view(np.int64))
                    columns["mass"].append(weights / weights.sum())
                    columns["own"].append(~np.isin(shingles, of_hub))
                    columns["n"].append(np.full(n, n if weights.max() == 1 else -1, np.int64))
                if columns["n"]:
                    yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate(v)) for c, v in columns.items()})

    tied = written(stars.join(roots, "node").select("hub", "node", "root"), "near-tied")
    rows = beside(tied, "hub", "node", texts, ["node", "root"]).mapInArrow(
        spread, "hub long, node long, root long, shingle long, mass double, own boolean, n long"
    )
    rows = written(rows, "near-shingles")
    held = written(rows.groupBy("hub", "shingle").agg(F.count(F.lit(1)).alias("held")), "near-held")
    of_node = W.partitionBy("hub", "node")
    earlier = of_node.orderBy(F.desc("private"), "held", "shingle").rowsBetween(W.unboundedPreceding, -1)
    front = (
        rows.join(held, ["hub", "shingle"])
        .withColumn("private", F.col("own") & (F.col("held") <= COMMON))
        .withColumn("left", 1 - F.coalesce(F.sum("mass").over(earlier), F.lit(0.0)))
        .withColumn("k", F.count_if(~F.col("private")).over(of_node))
    )
    meets = F.col("private") | (F.col("n") < 0) | (F.col("k") >= threshold * F.col("n"))
    front = front.where((F.col("held") > 1) & (F.col("left") >= threshold - 1e-9) & meets)
    front = written(front.select("hub", "node", "root", "shingle", "left", "private", "n", "k"), "near-front")
    per_root = tied.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("nodes"))
    most = per_root.groupBy("hub").agg(F.max(F.struct("nodes", "root")).alias("most")).select("hub", F.col("most.root").alias("_root"))
    most = written(most, "near-most")
    seeking = written(front.join(most, "hub").where("root <> _root").drop("_root"), "near-seeking")
    x, y = seeking.alias("x"), front.alias("y")
    k = F.least("x.k", "y.k")
    near = (1 / F.col("x.left") + 1 / F.col("y.left")) <= 1 + 1 / threshold + 1e-9
    enough = F.col("x.private") | (F.col("x.n") < 0) | (F.col("y.n") < 0) | (k >= threshold * (F.col("x.n") + F.col("y.n") - k))
    met = x.join(
        y, (F.col("x.hub") == F.col("y.hub")) & (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.root") != F.col("y.root")) & near & enough,
    )
    return met.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def with_root(rows: DataFrame, column: str, roots: DataFrame, name: str) -> DataFrame:
    """``rows`` plus the component of a node; a node without links is its own."""
    own = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return rows.join(own, F.col(column) == F.col("_node"), "left").withColumn(
        name, F.coalesce("_root", column)
    ).drop("_node", "_root")


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different components so far."""
    return with_root(with_root(pairs, "a", roots, "ra"), "b", roots, "rb").where("ra <> rb").select("a", "b")


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """One row of ``docs`` per class, that of the least doc_id, all columns as they are.

    A null id comes last. Of several texts with that id the least row hash stays; of rows that repeat it in full, one.
    """
    found = classes(docs, **how)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = written(found.groupBy("root").agg(F.min(rank).alias("first")).select(F.col("first.row").alias("_row")), "near-first-rows")
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")).withColumn(
        "_row", F.xxhash64(F.col("_doc.doc_id"), F.col("_doc.text"))
    )
    return kept.join(first, "_row", "left_semi").dropDuplicates(["_row"]).select("_doc.*")
