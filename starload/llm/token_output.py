"""Documents as token ids in compressed block files, and back.

The files are Parquet rows, one per segment of consecutive documents: their ids and lengths, and the
ids cut into blocks of ``segment_codec.BLOCK`` with a checksum each, coded side by side by one model.
Files of before, whose blocks are coded one by one from an empty model, are read as well.
Segments are ordered by (part, segment), documents within by doc_id.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starload.llm import segment_codec, token_codec
from starload.llm.common import batches_of

END = 0
DRAW = 7
"""Seed of the draw that deals out rows equal in id and text."""
SHARED = 2
"""``codec`` of segments in ``segment_codec``; those of ``token_codec``, whose blocks each have a model of their own, have none."""
SEGMENT_IDS = segment_codec.BLOCK * segment_codec.LANES
_BATCH_BYTES = 4 << 20
_MEMO, _LONG = 100_000, 64
"""Pieces that are listed by name, and the bytes of the longest that is: longer ones are encoded each time."""
_SHORT, _SHORT_IDS = 16, 8
"""Bytes and ids of a piece that goes into the table."""
_SLOT_BITS = 21
_LOWEST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_JOINED = 256
"""New pieces that one call of the tokenizer encodes."""

_WORD = re.compile(r" ?(?:[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f\u0400-\u0481]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)")
"""A piece that the tokenizer gives to its model whole."""
_LINE = re.compile(r" ?(?:[!-~]|[^\W_])(?:[^\n]*(?:[!-~]|[^\W_]))?")
"""A piece that keeps its ids as a line among others."""

# Kinds of bytes: 1 blank, 2 letter, 3 digit, 4 mark, 5 mark of a contraction or special token, 6 last byte of a longer
# character, 7 line break or tab; 0 is never cut beside.
_KIND = bytearray(256)
for _first, _end, _kind in ((33, 127, 4), (65, 91, 2), (97, 123, 2), (48, 58, 3), (128, 192, 6), (9, 14, 7), (32, 33, 1)):
    _KIND[_first:_end] = bytes([_kind]) * (_end - _first)
for _mark in b"'<|>":
    _KIND[_mark] = 5
# Byte-level BPE never joins what stands on both sides of these: a word and the blank after it, letters, digits and marks.
_CUT = bytearray(256)
for _left, _right in [(c, s) for c in range(2, 7) for s in (1, 7)] + [(a, b) for a in (2, 3, 4) for b in (2, 3, 4) if a != b]:
    _CUT[_left << 3 | _right] = 1

SCHEMA = "part int, segment int, doc_ids array<long>, lengths array<long>, " \
    "blocks array<struct<n: int, crc32: long, data: binary>>, codec int"


def _piece_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where UTF-8 texts that start at ``starts`` may be cut, the starts included, without change to their ids."""
    kind = np.frombuffer(data.tobytes().translate(_KIND), np.uint8)
    cut = np.zeros(len(data), bool)
    cut[1:] = np.frombuffer((kind[:-1] << 3 | kind[1:]).tobytes().translate(_CUT), bool)
    # Before a blank, a longer character must not be one itself: all those begin with C2, E1, E2 or E3.
    long = np.flatnonzero(cut[1:] & (kind[:-1] == 6)) + 1
    one, two = data[long - 2], data[long - 3]
    cut[long] = ((one >= 0xC3) & (one < 0xE0)) | ((one < 0xC0) & (two >= 0xE4) & (two < 0xF0))
    # After a single line break or tab.
    after = np.flatnonzero(kind[:-1] == 7) + 1
    after = after[after > 1]
    sides = np.stack([kind[after - 2], kind[after]])
    cut[after[((sides > 1) & (sides < 6)).all(axis=0)]] = True
    cut[starts] = True
    return np.flatnonzero(cut)


def _strings(values: pa.LargeBinaryArray) -> tuple[np.ndarray, bytes]:
    _, ends, data = values.buffers()
    return np.frombuffer(ends, np.int64, len(values) + 1, 8 * values.offset), data.to_pybytes()


class _Keys:
    """Strings of up to 16 bytes as two numbers and a length each, and their slots in a table."""

    def __init__(self, starts: np.ndarray, sizes: np.ndarray, data: bytes):
        at = np.ndarray(len(data) + 9, "<u8", data + bytes(16), 0, (1,))
        self.low = at[starts] & _LOWEST[np.minimum(sizes, 8)]
        self.high = at[starts + 8] & _LOWEST[np.maximum(sizes - 8, 0)]
        self.sizes = sizes.astype(np.uint8)
        mixed = (self.low ^ self.high * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        self.slots = (mixed >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


class _Table:
    """Ids of short pieces, one in each slot; a new one takes the place of the one that is there."""

    def __init__(self):
        self.low, self.high = np.zeros(1 << _SLOT_BITS, np.uint64), np.zeros(1 << _SLOT_BITS, np.uint64)
        self.sizes = np.zeros(1 << _SLOT_BITS, np.uint8)
        self.lengths = np.zeros(1 << _SLOT_BITS, np.uint8)
        self.ids = np.zeros((1 << _SLOT_BITS, _SHORT_IDS), np.uint16)

    def held(self, keys: _Keys) -> np.ndarray:
        at = keys.slots
        return (self.low[at] == keys.low) & (self.high[at] == keys.high) & (self.sizes[at] == keys.sizes)

    def put(self, keys: _Keys, flat: np.ndarray, lengths: np.ndarray) -> None:
        ids = np.zeros((len(lengths), _SHORT_IDS), np.uint16)
        ids[np.arange(_SHORT_IDS) < lengths[:, None]] = flat
        slots, one = np.unique(keys.slots, return_index=True)
        self.low[slots], self.high[slots], self.sizes[slots] = keys.low[one], keys.high[one], keys.sizes[one]
        self.lengths[slots], self.ids[slots] = lengths[one], ids[one]


class Encoder:
    """Token ids of whole texts, as the tokenizer gives them; pieces met before are not encoded again.

    New pieces that are a word, a number or marks go to the tokenizer's model, in its letters for bytes. The others are
    encoded many in one text, a line each: a single line break is always a token of its own.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spelled = {ord(x): x for x in map(chr, (*range(33, 127), *range(161, 173), *range(174, 256)))}
        others = iter(range(256, 512))
        self.letters = {b: spelled.get(b) or chr(next(others)) for b in range(256)}
        (self.line_break,) = self._plain("\n")
        self.table = _Table()
        self.known: dict[bytes, np.ndarray] = {}
        """Pieces that the table has no room for."""

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces in another order, how many each has, and that order."""
        words, lines, others = [], [], []
        for i, piece in enumerate(pieces):
            text = piece.decode()
            (words if _WORD.fullmatch(text) else lines if _LINE.fullmatch(text) else others).append(i)
        spelled = b"\n".join([pieces[i] for i in words]).decode("latin-1").translate(self.letters)
        ids, lengths = [], []
        for word in spelled.split(self.letters[10]) if words else []:
            found = self.model.tokenize(word)
            lengths.append(len(found))
            ids.extend([token.id for token in found])
        flat, sizes = [np.array(ids, np.uint16)], [np.array(lengths, np.int64)]
        for at in range(0, len(lines), _JOINED):
            ids = np.array(self._plain(b"\n".join([pieces[i] for i in lines[at : at + _JOINED]]).decode()), np.uint16)
            breaks = ids == self.line_break
            flat.append(ids[~breaks])
            sizes.append(np.diff(np.flatnonzero(breaks), prepend=-1, append=len(ids)) - 1)
        for i in others:
            flat.append(np.array(self._plain(pieces[i].decode()), np.uint16))
            sizes.append(np.array([len(flat[-1])]))
        return np.concatenate(flat), np.concatenate(sizes), np.array(words + lines + others, np.int64)

    def _found(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces in another order, and of each where they start and how many there are."""
        ends, data = _strings(pieces)
        sizes = np.diff(ends)
        firsts, lengths = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        missing = sizes > 0
        short = np.flatnonzero(sizes <= _SHORT)
        keys = _Keys(ends[short], sizes[short], data)
        held = self.table.held(keys)
        known, at = short[held], keys.slots[held]
        lengths[known] = self.table.lengths[at]
        missing[known] = False
        flat = [self.table.ids[at][np.arange(_SHORT_IDS) < lengths[known][:, None]]]
        order = [known]
        for i in np.flatnonzero(sizes > _SHORT).tolist() if self.known else []:
            if (ids := self.known.get(data[ends[i] : ends[i + 1]])) is not None:
                flat.append(ids)
                order.append([i])
                lengths[i], missing[i] = len(ids), False
        new = np.flatnonzero(missing)
        if len(new):
            spans = zip(ends[new].tolist(), ends[new + 1].tolist())
            found, counts, which = self._encode([data[a:b] for a, b in spans])
            new = new[which]
            lengths[new] = counts
            fits = (sizes[new] <= _SHORT) & (counts <= _SHORT_IDS)
            self.table.put(_Keys(ends[new[fits]], sizes[new[fits]], data), found[np.repeat(fits, counts)], counts[fits])
            upto = np.cumsum(counts)
            for i in np.flatnonzero(~fits & (sizes[new] <= _LONG)).tolist():
                self.known[data[ends[new[i]] : ends[new[i] + 1]]] = found[upto[i] - counts[i] : upto[i]].copy()
            flat.append(found)
            order.append(new)
        order = np.concatenate(order)
        firsts[order] = np.cumsum(lengths[order]) - lengths[order]
        return np.concatenate(flat), firsts, lengths

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has, the end id included."""
        if len(self.known) > _MEMO:
            self.known.clear()
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, ends, data = texts.buffers()
        ends = np.frombuffer(ends, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
        held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        at = _piece_starts(held, ends[:-1][ends[1:] > ends[:-1]])
        offsets = np.append(at, len(held))
        cut = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
        cut = cut.dictionary_encode()
        flat, firsts, sizes = self._found(cut.dictionary)
        flat, firsts, sizes = np.append(flat, np.uint16(END)), np.append(firsts, len(flat)), np.append(sizes, 1)
        last = np.searchsorted(at, ends[1:]) + np.arange(len(texts))
        every = np.full(len(at) + len(texts), len(sizes) - 1)
        piece = np.ones(len(every), bool)
        piece[last] = False
        every[piece] = cut.indices.to_numpy()
        sizes = sizes.take(every)
        upto = np.cumsum(sizes)
        place = np.repeat(firsts.take(every) - upto + sizes, sizes)
        place += np.arange(len(place))
        return flat.take(place), np.diff(upto[last], prepend=0)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """One array per text, the end id included."""
        flat, sizes = self.encoded(pa.array(texts, pa.string()))
        return np.split(flat, np.cumsum(sizes)[:-1])


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """A worker keeps its encoder, and the pieces it knows, for its next task."""
    return Encoder(path)


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str) -> None:
    """Write ``docs(doc_id, text)`` to ``path`` in ascending doc_id order, null ids first, ties by text hash.

    Documents are dealt out by ranges of doc_id and, where one id or none has very many rows, of text hash and
    then of a draw, so that such rows, equal ones included, do not gather in one task. They are encoded where
    they land, each text whole, as the tokenizer itself does: a special token's literal is that token.
    Null text is empty: the end id alone. Repeated rows are written each. Ids must fit 16 bits. Other
    columns are ignored.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = encoder_of(tokenizer_path)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = segment = 0
        for whole in batches:
            for batch in batches_of(whole, _BATCH_BYTES):
                found = encoder.encoded(batch.column("text"))
                if held and size + len(found[0]) > SEGMENT_IDS:
                    yield _segment(part, segment, held)
                    held, size, segment = [], 0, segment + 1
                held.append((batch.column("doc_id"), *found))
                size += len(found[0])
        if held:
            yield _segment(part, segment, held)

    order = ["doc_id", "_hash", "_draw"]
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"), F.rand(DRAW).alias("_draw")
    )
    ordered = named.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("doc_id", "text").mapInArrow(write, SCHEMA).write.parquet(path)


def _segment(part: int, segment: int, held: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    doc_ids, ids, lengths = zip(*held)
    ids = np.concatenate(ids)
    cut = [ids[i : i + segment_codec.BLOCK] for i in range(0, len(ids), segment_codec.BLOCK)]
    blocks = pa.StructArray.from_arrays([
        pa.array([len(c) for c in cut], pa.int32()), pa.array([token_codec.checksum(c) for c in cut], pa.int64()),
        pa.array(segment_codec.encode(ids), pa.binary()),
    ], ["n", "crc32", "data"])
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.RecordBatch.from_pydict({
        "part": pa.array([part], pa.int32()), "segment": pa.array([segment], pa.int32()),
        "doc_ids": one(pa.concat_arrays(doc_ids)), "lengths": one(pa.array(np.concatenate(lengths), pa.int64())),
        "blocks": one(blocks), "codec": pa.array([SHARED], pa.int32()),
    })


def read_tokens(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before) and ids of every document in the files.

    The ids are an array or, ``packed``, binary: four bytes each, little-endian. A block whose ids do not
    give its checksum raises. Starts are summed in two steps, over the parts and within a part, so that no
    task sees all segments, and are sent to the blocks: a row for some million ids.
    """
    stored = spark.read.schema(SCHEMA).parquet(path)
    sizes = stored.select("part", "segment", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", before(W.orderBy("part")).alias("part_start"))
    starts = sizes.select("part", "segment", before(W.partitionBy("part").orderBy("segment")).alias("segment_start"))
    starts = starts.join(parts, "part").select(
        "part", "segment", (F.col("part_start") + F.col("segment_start")).alias("start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1)
                part, segment, start, codec = (row.column(c)[0].as_py() for c in ("part", "segment", "start", "codec"))
                doc_ids, lengths, blocks = (row.column(c).flatten() for c in ("doc_ids", "lengths", "blocks"))
                sizes, sums, data = (column.to_pylist() for column in blocks.flatten())
                if codec == SHARED:
                    ids = segment_codec.decode(data, sum(sizes))
                else:
                    ids = np.concatenate(token_codec.decode(data, sizes))
                ids = ids.astype("<i4")
                block_ends = np.cumsum(sizes).tolist()
                for end, size, crc in zip(block_ends, sizes, sums):
                    if zlib.crc32(ids[end - size : end]) != crc:
                        raise ValueError(f"damaged block in segment {part}.{segment}")
                sizes = lengths.to_numpy()
                ends = np.cumsum(sizes)
                for first in range(0, len(ends), 1000):
                    held = slice(first, first + 1000)
                    begin = ends[first] - sizes[first]
                    offsets = np.append(begin, ends[held]) - begin
                    flat = ids[begin : ends[held][-1]]
                    if packed:
                        buffers = [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(flat)]
                        found = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)
                    else:
                        found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": doc_ids[first : first + 1000], "start": pa.array((start + ends - sizes)[held], pa.int64()), "ids": found,
                    })

    kind = "binary" if packed else "array<int>"
    return stored.join(F.broadcast(starts), ["part", "segment"]).mapInArrow(read, f"doc_id long, start long, ids {kind}")


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, over the ids as little-endian 32-bit numbers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [ids.values.to_numpy(zero_copy_only=False).astype("<i4").tobytes() for ids in batch.column("ids")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "start": batch.column("start"), "ids": pa.array(packed, pa.binary()),
            })

    if tokens.schema["ids"].dataType.typeName() == "array":
        tokens = tokens.mapInArrow(pack, "doc_id long, start long, ids binary")
    return tokens.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
