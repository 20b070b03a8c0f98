"""Language-model scores: prediction by partial matching over bytes, beside a smoothed unigram of words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import UPPER_TO_LOWER, batches_of, column_bytes
from starload.session import written

ORDER = 5
"""Longest context in bytes."""
EDGE = 256
"""Symbol before the first byte and after the last."""
SYMBOLS = 257
WIDTH = 9
"""Bits of a symbol within a key."""
KEPT = 1 << 20
"""A word goes to every task when it holds at least 1/KEPT of all training tokens, so at most KEPT do."""
KEPT_GRAMS = 1 << 22
"""A gram's score goes to every task when it holds at least 1/KEPT_GRAMS of all symbols; other grams meet theirs in a join."""
SHARED = 2
"""Longest context whose entries all go to every task that works out scores: at most 257**3 by the alphabet."""
_BATCH_BYTES = 1 << 20
_FLUSH = 1 << 18
_FLUSH_GRAMS = 1 << 20
_SCORED_GRAMS = 1 << 19
_OUT_ROWS = 100_000


def lowered(text: bytes | None) -> bytes:
    return (text or b"").translate(UPPER_TO_LOWER)


def contexts(texts: list[bytes], order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of (context, symbol) at every byte and end of each text, with the text's number.

    A key packs the last ``order`` symbols before it and the symbol. Long texts come in pieces that
    start from the bytes before them, so no more than a batch is held at a time.
    """
    for first, group in _grouped([(i, t, a) for i, t in enumerate(texts) for a in range(0, len(t) + 1, _BATCH_BYTES)]):
        parts, owners, sizes, edges, before_text, at = [], [], [], [], [], 0
        for i, text, start in group:
            before = text[max(0, start - order) : start]
            piece = text[start : start + _BATCH_BYTES]
            last = start + _BATCH_BYTES > len(text)
            pad = order - len(before)
            parts.append(b"\0" * pad + before + piece + b"\0" * last)
            edges.extend(range(at, at + pad))
            if last:
                edges.append(at + len(parts[-1]) - 1)
            before_text.extend(range(at, at + order))
            owners.append(i)
            sizes.append(len(piece) + last)
            at += len(parts[-1])
        symbols = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
        symbols[edges] = EDGE
        key = symbols.copy()
        for k in range(1, order + 1):
            key[k:] |= symbols[:-k] << (WIDTH * k)
        yield np.delete(key, before_text), np.repeat(owners, sizes)


def _grouped(pieces: list[tuple[int, bytes, int]]) -> Iterator[tuple[int, list]]:
    group, held = [], 0
    for piece in pieces:
        size = min(len(piece[1]) - piece[2], _BATCH_BYTES)
        if group and held + size > _BATCH_BYTES:
            yield group[0][0], group
            group, held = [], 0
        group.append(piece)
        held += size
    if group:
        yield group[0][0], group


def training(doc_id: Column, folds: int, held_out: int) -> Column:
    """Whether a row is learned from: crc32 of the id's text, a null id counting as the empty text."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(folds)) != held_out


def partial_counts(docs: DataFrame) -> DataFrame:
    """(gram, word, n, learned): counts of byte grams of all texts, apart for those ``learned`` from, and of the words of these.

    Added up per task as far as memory goes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        parts: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {True: [], False: []}
        sizes = {True: 0, False: 0}
        docs_seen = 0
        for whole in batches:
            for batch in batches_of(whole, _BATCH_BYTES):
                texts = [lowered(t) for t in column_bytes(batch.column("text"))]
                learned = batch.column("learned").to_pylist()
                docs_seen += sum(learned)
                for text, of_training in zip(texts, learned):
                    if of_training:
                        words.update(text.split())
                    if len(words) > _FLUSH:
                        yield _words(words)
                        words = Counter()
                for kind in (True, False):
                    for keys, _ in contexts([t for t, k in zip(texts, learned) if k == kind]):
                        parts[kind].append(np.unique(keys, return_counts=True))
                        sizes[kind] += len(parts[kind][-1][0])
                        if sizes[kind] > 2 * _FLUSH_GRAMS:
                            parts[kind] = [_added(parts[kind])]
                            sizes[kind] = len(parts[kind][0][0])
                            if sizes[kind] > _FLUSH_GRAMS:
                                yield from _grams(*parts[kind][0], kind)
                                parts[kind], sizes[kind] = [], 0
        yield _words(words)
        for kind in (True, False):
            yield from _grams(*_added(parts[kind]), kind)
        yield _rows([None], [None], [docs_seen], True)

    return docs.select("text", "learned").mapInArrow(count, "gram long, word binary, n long, learned boolean")


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.array([], np.int64), np.array([], np.int64)
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")  # a merge, as every part is in order
    keys, n = keys[order], np.concatenate([n for _, n in parts])[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))  # keys are not negative
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _rows(grams: list, words: list, n: list, learned: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "gram": pa.array(grams, pa.int64()), "word": pa.array(words, pa.binary()), "n": pa.array(n, pa.int64()),
        "learned": pa.array([learned] * len(n), pa.bool_()),
    })


def _words(words: Counter) -> pa.RecordBatch:
    return _rows([None] * len(words), list(words), list(words.values()), True)


def _grams(grams: np.ndarray, n: np.ndarray, learned: bool) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(grams), _OUT_ROWS):
        part = grams[at : at + _OUT_ROWS]
        yield _rows(part, [None] * len(part), n[at : at + _OUT_ROWS], learned)


class Trie:
    """A trained byte-context trie: per order the (context, symbol) entries with their counts, or a part closed under contexts.

    The escape estimate is that of method C: a context seen n times with d symbols escapes with
    d / (n + d). A context that escapes excludes its symbols from the shorter one. As counts only grow when a
    context is cut short, the symbols of a context are among those of the shorter one, and what is left
    there after exclusion is fixed by the context that was left.
    """

    def __init__(self, entries: list[tuple[np.ndarray, np.ndarray]]):
        self.entries = entries
        self.keys, self.counts, self.contexts, self.seen, self.distinct, self.escapes = [], [], [], [], [], []
        for k, (key, count) in enumerate(entries):
            order = np.argsort(key)
            key, count = key[order], count[order].astype(np.float64)
            context, start = np.unique(key >> WIDTH, return_index=True)
            self.keys.append(key)
            self.counts.append(count)
            self.contexts.append(context)
            self.seen.append(np.add.reduceat(count, start) if len(key) else count)
            self.distinct.append(np.diff(np.append(start, len(key))).astype(np.float64))
            occurred = self.seen[k].copy()
            if k:
                entry, known = self._find(self.keys[k - 1], context)
                occurred[known] = self.counts[k - 1][entry[known]]
            self.escapes.append(self.distinct[k] + np.maximum(occurred - self.seen[k], 0))
        self.left_seen, self.left_escapes = [None], [None]
        for k in range(1, len(entries)):
            mask = (1 << (WIDTH * k)) - 1
            shorter = np.searchsorted(self.keys[k - 1], self.keys[k] & mask)
            own = np.searchsorted(self.contexts[k], self.keys[k] >> WIDTH)
            taken = np.bincount(own, self.counts[k - 1][shorter], minlength=len(self.contexts[k]))
            parent = np.searchsorted(self.contexts[k - 1], self.contexts[k] & (mask >> WIDTH))
            self.left_seen.append(self.seen[k - 1][parent] - taken)
            self.left_escapes.append(self.escapes[k - 1][parent] - self.distinct[k])

    @staticmethod
    def _find(held: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(held):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
        return at, held[at] == wanted

    def log10(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol of each key after its context."""
        total = np.zeros(len(key))
        open_ = np.arange(len(key))
        left = np.full(len(key), -1)
        for k in range(len(self.keys) - 1, -1, -1):
            wanted = key[open_] & ((1 << (WIDTH * (k + 1))) - 1)
            entry, found = self._find(self.keys[k], wanted)
            context, known = self._find(self.contexts[k], wanted >> WIDTH)
            entered = left[open_] >= 0
            seen, escapes = np.ones(len(open_)), np.zeros(len(open_))
            new = known & ~entered
            seen[new], escapes[new] = self.seen[k][context[new]], self.escapes[k][context[new]]
            if k + 1 < len(self.keys):
                above = left[open_[entered]]
                seen[entered], escapes[entered] = self.left_seen[k + 1][above], self.left_escapes[k + 1][above]
            hit = found & known
            share = np.ones(len(open_))
            share[hit] = self.counts[k][entry[hit]] / (seen[hit] + escapes[hit])
            miss = known & ~found & (escapes > 0)
            share[miss] = escapes[miss] / (seen[miss] + escapes[miss])
            total[open_] += np.log10(share)
            left[open_[known]] = context[known]
            open_ = open_[~hit]
        used = self.distinct[0][0] if len(self.distinct[0]) else 0
        total[open_] -= math.log10(SYMBOLS - used) if used < SYMBOLS else 0.0
        return total


def orders(keys: np.ndarray, n: np.ndarray, wanted: range) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of the entries of each wanted order, from whole grams and their counts."""
    entries = []
    for k in wanted:
        found, cut = pd.factorize(keys & ((1 << (WIDTH * (k + 1))) - 1))
        entries.append((cut, np.bincount(found, n, len(cut)).astype(np.int64)))
    return entries


def gram_scores(counts: DataFrame) -> DataFrame:
    """(gram, asked, log_p): occurrences in all texts and log10 probability of the symbol, for every gram that occurs.

    The probability follows from the gram and the counts of its contexts and theirs alone. Grams of the
    same last SHARED + 1 context symbols hold all counts of the orders beyond SHARED that they need, so
    they are dealt out by these and a trie is made for some such groups at a time; no entry is left out.
    """
    grams = counts.where("gram is not null").groupBy("gram").agg(
        F.sum("n").alias("asked"), F.sum(F.when(F.col("learned"), F.col("n")).otherwise(0)).alias("n")
    )
    grams = written(grams, "lm-grams")
    low = []
    for k in range(SHARED + 1):
        cut = F.col("gram").bitwiseAND(F.lit((1 << (WIDTH * (k + 1))) - 1)).alias("gram")
        kept = grams.where("n > 0").groupBy(cut).agg(F.sum("n").alias("n")).toPandas()
        low.append((kept["gram"].to_numpy(np.int64), kept["n"].to_numpy(np.int64)))
    shared = counts.sparkSession.sparkContext.broadcast(low)
    mask = (1 << (WIDTH * (SHARED + 1))) - 1

    def work_out(grams: np.ndarray, asked: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        seen = n > 0
        model = Trie(shared.value + orders(grams[seen], n[seen], range(SHARED + 1, ORDER + 1)))
        for at in range(0, len(grams), _OUT_ROWS):
            part = slice(at, at + _OUT_ROWS)
            yield pa.RecordBatch.from_pydict({"gram": grams[part], "asked": asked[part], "log_p": model.log10(grams[part])})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size, enough = 0, _SCORED_GRAMS
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("gram", "asked", "n")])
            size += batch.num_rows
            if size < enough:
                continue
            whole = [np.concatenate(c) for c in zip(*held)]
            group = (whole[0] >> WIDTH) & mask
            at = int(np.argmax(group == group[-1]))  # the last group may go on in the next batch
            if at:
                yield from work_out(*(c[:at] for c in whole))
            held = [[c[at:] for c in whole]]
            size -= at
            enough = max(_SCORED_GRAMS, 2 * size)
        if size:
            yield from work_out(*(np.concatenate(c) for c in zip(*held)))

    dealt = grams.withColumn("group", F.shiftright("gram", WIDTH).bitwiseAND(F.lit(mask)))
    dealt = dealt.repartition("group").sortWithinPartitions("group").select("gram", "asked", "n")
    return dealt.mapInArrow(work, "gram long, asked long, log_p double")


def scored(docs: DataFrame, folds: int = 7, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    All texts are lowered (A-Z) and scored whole. Rows whose fold is not ``held_out`` are counted:
    their words, and the byte contexts of the trie. ``score`` is the trie's log10 probability of the
    text's bytes and its end; ``base_score`` that of words and end under add-one unigram counts.

    Frequent words and grams are looked up in every task. The rest, whose number grows with the corpus,
    meet their counts and scores in a join, which no frequent one can weigh down. Nothing counted is dropped.

    Null text is the empty text: one token, the end. A null id is the empty id text. Repeated rows are
    scored each. Without training rows every count is 0 and bytes are equally likely. An empty table
    gives no rows; other columns are ignored.
    """
    counts = written(
        partial_counts(docs.select("text", training(F.col("doc_id"), folds, held_out).alias("learned"))), "lm-partial"
    )
    by_gram = written(gram_scores(counts), "lm-gram-scores")
    asked = by_gram.agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]
    is_frequent = F.col("asked") * KEPT_GRAMS >= asked
    frequent = by_gram.where(is_frequent).select("gram", "log_p").toPandas().sort_values("gram")
    vocabulary = counts.where("word is not null").groupBy("word").agg(F.sum("n").alias("c"))
    vocabulary = written(vocabulary, "lm-words")
    kinds, in_words = vocabulary.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    ends = counts.where("gram is null and word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tokens, kinds = in_words + ends, kinds + (ends > 0)
    is_common = F.col("c") * KEPT >= tokens
    common = vocabulary.where(is_common).toPandas()
    shared = docs.sparkSession.sparkContext.broadcast(
        (frequent["gram"].to_numpy(np.int64), frequent["log_p"].to_numpy(float),
         dict(zip(common["word"].map(bytes), np.log10(common["c"].to_numpy(float) + 1))))
    )
    end_log, below = math.log10(ends + 1), math.log10(tokens + kinds + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, log_p, logs = shared.value
        number = TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in batches_of(whole, _BATCH_BYTES):
                texts = [lowered(t) for t in column_bytes(batch.column("text"))]
                scores = np.zeros(len(texts))
                asked_of: list[tuple] = []
                for keys, owner in contexts(texts):
                    found, seen = pd.factorize(keys)
                    held, of_seen = np.zeros(len(seen), bool), np.zeros(len(seen))
                    if len(frequent):
                        order = np.argsort(seen)  # asked in order, a search stays near the last one
                        at = np.minimum(np.searchsorted(frequent, seen[order]), len(frequent) - 1)
                        held[order] = frequent[at] == seen[order]
                        of_seen[order] = np.where(held[order], log_p[at], 0.0)
                    scores += np.bincount(owner, of_seen[found], minlength=len(texts))
                    open_ = ~held[found]
                    pair, pairs = pd.factorize(owner[open_] * len(seen) + found[open_])
                    asked_of.append((pairs // len(seen), seen[pairs % len(seen)], np.bincount(pair, minlength=len(pairs))))
                n_tokens, known, base, rare = [], [], [], []
                for text in texts:
                    words = text.split()
                    unusual = Counter(w for w in words if w not in logs)
                    n_tokens.append(len(words) + 1)
                    known.append(len(words) - unusual.total() + (ends > 0))
                    base.append(math.fsum(logs[w] for w in words if w in logs) + end_log - below * (len(words) + 1))
                    rare.append([{"word": w, "n": n} for w, n in unusual.items()])
                yield pa.RecordBatch.from_pydict({
                    "place": pa.array(range(number, number + len(texts)), pa.int64()),
                    "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                    "n_tokens": pa.array(n_tokens, pa.int64()), "known": pa.array(known, pa.int64()),
                    "base": pa.array(base, pa.float64()), "score": pa.array(scores),
                    "grams": _per_text(asked_of, len(texts)),
                    "rare": pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
                })
                number += len(texts)

    asked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (~training(F.col("doc_id"), folds, held_out)).alias("held_out")
    )
    schema = "place long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, " \
        "grams array<struct<gram: long, n: int>>, rare array<struct<word: binary, n: long>>"
    rows = written(asked.mapInArrow(score, schema), "lm-rows")
    rare = rows.select("place", F.inline("rare"))
    zero, nought = F.lit(0).cast("long"), F.lit(0.0)
    of_words = rare.join(vocabulary.where(~is_common), "word").select(
        "place", F.col("n").alias("known"), (F.col("n") * F.log10(F.col("c") + 1)).alias("base"), nought.alias("score")
    )
    of_grams = rows.select("place", F.inline("grams")).join(by_gram.where(~is_frequent), "gram").select(
        "place", zero.alias("known"), nought.alias("base"), (F.col("n") * F.col("log_p")).alias("score")
    )
    met = of_words.groupBy("place").agg(*[F.sum(c).alias(c) for c in ("known", "base", "score")]).unionByName(
        of_grams.groupBy("place").agg(*[F.sum(c).alias(c) for c in ("known", "base", "score")])
    )
    met = met.groupBy("place").agg(*[F.sum(c).alias(f"rare_{c}") for c in ("known", "base", "score")])
    return rows.drop("rare", "grams").join(met, "place", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", nought)).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", nought)).alias("score"),
    )


def _per_text(found: list[tuple], n_texts: int) -> pa.Array:
    """Lists of (gram, n), one per text, from (text, gram, n) arrays."""
    owner, gram, n = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.argsort(owner, kind="stable")
    pairs = pa.StructArray.from_arrays([pa.array(gram[order]), pa.array(n[order].astype(np.int32))], names=["gram", "n"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[order], np.arange(n_texts + 1)).astype(np.int32)), pairs)
