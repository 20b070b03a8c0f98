"""Adaptive context-mixing range coder for 16-bit token ids; the blocks of a segment share one model.

A segment is cut into blocks, and step t codes id t of every block, each into bytes of its own. Order 2
and order 1 each guess the next id from what followed the same context last; order 0 counts ids. Whether
the order-2 guess is right is coded with a probability mixed from how far either guess is trusted, whether
they agree and how frequent the guessed id is, then whether the order-1 guess is, and an id that nobody
guessed is coded from the order-0 counts. What all blocks have coded in a step teaches the model that
they code the next ones with, so each profits from the whole segment and a step is a few calls on arrays
as long as there are blocks. All arithmetic is in whole numbers, so that any machine decodes what
another has encoded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

BLOCK = 1024
LANES = 8192
_IDS = 1 << 16
_SLOTS = 1 << 20
_STRETCH = np.array([round(256 * math.log((p + 0.5) / (4095.5 - p))) for p in range(4096)], np.int64)
_SQUASH = np.array([
    min((1 << 16) - 128, max(128, round((1 << 16) / (1 + math.exp(-x / 256))))) for x in range(-2200, 2201)
], np.int64)
_TRUSTS, _BINS = 8, 16
_SHAPE = (_TRUSTS, _TRUSTS, 2, _BINS)
_CONTEXTS = math.prod(_SHAPE)
_MORE = np.array([1 << 16] * (_TRUSTS - 1) + [0], np.int32)
_LESS = np.array([t - (t >> 1) << 16 for t in range(_TRUSTS)], np.int32)
"""What a trust rises and falls by, where a guess is held."""
_EVERY = 16
"""Steps from one lesson of the mixed chances and the counts to the next; the first steps have one each."""
_STEP, _LIMIT = 32, 1 << 24
_KEPT = 1 << 16
"""A context's cases are halved beyond so many."""
_WHOLE, _WHOLE_BITS = np.uint64(1 << 20), np.uint64(20)
"""What the chances of the guesses and of neither add up to."""
_COUNTED, _COUNTED_BITS = 1 << 24, np.uint64(24)
"""What the counts are scaled to add up to, at most."""
_BUCKET_BITS = 9
_WORD = np.uint64(32)
_SMALL = np.uint64(1 << 32)


class _Mixer:
    """Chances that a guess is right, by trust of order 2 and 1, agreement and frequency of the guessed id."""

    def __init__(self):
        self.hits = np.zeros(_CONTEXTS, np.int64)
        self.cases = np.zeros(_CONTEXTS, np.int64)
        self.weights = np.repeat([[16384], [8192], [8192], [40960]], 2, axis=1)
        self.new: list[np.ndarray] = []
        """Contexts, doubled, and one more where the guess was right."""
        self._mix()

    def _mix(self) -> None:
        hits, cases = self.hits.reshape(_SHAPE), self.cases.reshape(_SHAPE)
        held = []
        for over in ((1, 2, 3), (0, 3), (0, 1, 2), ()):
            h, n = hits.sum(axis=over, keepdims=True), cases.sum(axis=over, keepdims=True)
            held.append(np.broadcast_to(_STRETCH[(2 * h + 1) * 4096 // (2 * n + 2)], _SHAPE))
        self.inputs = np.stack(held)
        mixed = (self.inputs * self.weights[:, None, None, :, None]).sum(axis=0) >> 16
        self.chances = _SQUASH[np.clip(mixed, -2200, 2200) + 2200].reshape(-1).astype(np.uint64)

    def learn(self, agreeing: bool) -> None:
        """From the cases since the last lesson; the weights go down the gradient of their cost in bits."""
        if not self.new:
            return
        found = np.bincount(np.concatenate(self.new), minlength=2 * _CONTEXTS).reshape(*_SHAPE, 2)
        self.new = []
        if not agreeing:
            found[:, :, 1] = 0
        hits, cases = found[..., 1], found.sum(axis=-1)
        error = (hits << 16) - cases * self.chances.astype(np.int64).reshape(_SHAPE)
        slope = (self.inputs * error).sum(axis=(1, 2, 4)) // max(1, int(cases.sum()))
        self.weights = np.clip(self.weights + (slope >> 10), -(1 << 18), 1 << 18)
        self.hits += hits.reshape(-1)
        self.cases += cases.reshape(-1)
        full = self.cases > _KEPT
        self.hits[full] >>= 1
        self.cases[full] >>= 1
        self._mix()


class _Counts:
    """Order-0 counts; of them scaled, ``upto`` holds the sum before an id. ``bins`` is how rare an id is."""

    def __init__(self, searched: bool):
        self.counts = np.ones(_IDS, np.int64)
        self.upto = np.zeros(_IDS + 1, np.int64)
        self.searched = searched
        self.new: list[np.ndarray] = []
        self._scale(True)

    def _scale(self, bins: bool) -> None:
        total = int(self.counts.sum())
        if total > _LIMIT:
            self.counts = (self.counts + 1) >> 1
            total = int(self.counts.sum())
        sizes = self.counts * ((_COUNTED << 16) // total) >> 16
        np.cumsum(sizes, out=self.upto[1:])
        self.sizes = sizes.astype(np.uint64)
        self.starts = self.upto[:-1].astype(np.uint64)
        if bins:
            self.bins = np.minimum(np.frexp(total // self.counts)[1], _BINS) - 1
        if self.searched:
            buckets = (_COUNTED >> _BUCKET_BITS) + 1
            first = self.upto[:-1] + ((1 << _BUCKET_BITS) - 1) >> _BUCKET_BITS
            self.first = np.cumsum(np.bincount(first, minlength=buckets + 1)) - 1

    def learn(self, bins: bool) -> None:
        if self.new:
            self.counts += _STEP * np.bincount(np.concatenate(self.new), minlength=_IDS)
            self.new = []
        self._scale(bins)

    def find(self, offset: np.ndarray) -> np.ndarray:
        """The ids that the offsets lie in: at once where all of a bucket of offsets lies in one id, else by search."""
        offset = np.minimum(offset, np.uint64(int(self.upto[-1]) - 1)).astype(np.int64)
        bucket = offset >> _BUCKET_BITS
        found = self.first.take(bucket)
        open_ = np.flatnonzero(found != self.first.take(bucket + 1))
        found[open_] = np.searchsorted(self.upto, offset[open_], "right") - 1
        return found


class _Encoder:
    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.out = np.zeros((lanes, 256), np.uint32)
        self.at = np.zeros(lanes, np.int64)
        self.most = 0
        """No lane has put out more."""

    def put(self, lane: np.ndarray | slice, start: np.ndarray, size: np.ndarray, unit: np.ndarray) -> None:
        low, width = self.low[lane], size * unit
        sums = low + start * unit
        over = np.flatnonzero(sums < low)
        if len(over):
            self._carry(over if isinstance(lane, slice) else lane[over])
        go = np.flatnonzero(width < _SMALL)
        if len(go):
            self._emit(go if isinstance(lane, slice) else lane[go], sums[go])
            sums[go] <<= _WORD
            width[go] <<= _WORD
        self.low[lane], self.range[lane] = sums, width

    def _emit(self, lane: np.ndarray, low: np.ndarray) -> None:
        self.most += 1
        if self.most > self.out.shape[1]:
            self.most = int(self.at.max()) + 1
            if self.most > self.out.shape[1]:
                self.out = np.concatenate([self.out, np.zeros_like(self.out)], axis=1)
        at = self.at[lane]
        self.out[lane, at] = low >> _WORD
        self.at[lane] = at + 1

    def _carry(self, lane: np.ndarray) -> None:
        """One more in the last word put out, and where that turns zero in the one before."""
        at = self.at[lane] - 1
        while len(lane):
            self.out[lane, at] += np.uint32(1)
            more = self.out[lane, at] == 0
            lane, at = lane[more], at[more] - 1

    def end(self) -> list[bytes]:
        """A last word that lies in the range, whatever is read after it."""
        lanes = np.arange(len(self.low))
        last = self.low + (_SMALL - np.uint64(1))
        self._carry(np.flatnonzero(last < self.low))
        self._emit(lanes, last)
        return [row[:n].astype("<u4").tobytes() for row, n in zip(self.out, self.at.tolist())]


class _Decoder:
    def __init__(self, blocks: Sequence[bytes]):
        width = max((len(b) for b in blocks), default=0) // 4 + 3
        held = b"".join(b.ljust(4 * width, b"\0") for b in blocks)
        self.flat = np.frombuffer(held, "<u4").astype(np.uint64)
        self.at = np.arange(len(blocks)) * width + 2
        self.code = (self.flat[self.at - 2] << _WORD) | self.flat[self.at - 1]
        self.range = np.full(len(blocks), np.uint64(0xFFFFFFFFFFFFFFFF))

    def take(self, lane: np.ndarray | slice, start: np.ndarray, size: np.ndarray, unit: np.ndarray) -> None:
        code, width = self.code[lane] - start * unit, size * unit
        go = np.flatnonzero(width < _SMALL)
        if len(go):
            of = go if isinstance(lane, slice) else lane[go]
            at = self.at[of]
            # A damaged block may ask for more words than there are; its checksum tells.
            code[go] = (code[go] << _WORD) | self.flat.take(at, mode="clip")
            self.at[of] = at + 1
            width[go] <<= _WORD
        self.code[lane], self.range[lane] = code, width


def _lockstep(lengths: np.ndarray, coder: _Encoder | _Decoder, ids: np.ndarray) -> None:
    """Walk all lanes id by id; ``ids[t, lane]`` is read or, when decoding, written. No lane is longer than one before it."""
    decoding = isinstance(coder, _Decoder)
    follow = coder.take if decoding else coder.put
    mixer2, mixer1, counts = _Mixer(), _Mixer(), _Counts(decoding)
    two_of, one_of = np.zeros(_SLOTS, np.int32), np.zeros(_IDS, np.int32)
    """The id guessed, and above its 16 bits how far it is trusted, 0 to 7."""
    last, before = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for t in range(int(lengths.max(initial=0))):
        n = int(np.searchsorted(-lengths, -t))
        if t < _EVERY or t % _EVERY == 0:
            mixer2.learn(True)
            mixer1.learn(False)
            counts.learn(t < _EVERY or t % (4 * _EVERY) == 0)
        last, before = last[:n], before[:n]
        slot = (last * 40503 ^ before * 2654435761) >> 7 & (_SLOTS - 1)
        two, one = two_of.take(slot), one_of.take(last)
        guess2, guess1 = two & 65535, one & 65535
        trust2, trust1 = two >> 16, one >> 16
        agree = guess2 == guess1
        both = (trust2 << 3 | trust1) << 5
        context2 = (both | agree * np.int32(_BINS)) + counts.bins.take(guess2)
        context1 = both + counts.bins.take(guess1)
        chance2 = mixer2.chances.take(context2)
        chance1 = mixer1.chances.take(context1)
        chance1[agree] = 0
        size2 = chance2 << np.uint64(4)
        upto1 = size2 + ((np.uint64(1 << 16) - chance2) * chance1 >> np.uint64(12))
        unit = coder.range[:n] >> _WHOLE_BITS
        if decoding:
            right2 = coder.code[:n] < size2 * unit
            right = coder.code[:n] < upto1 * unit
        else:
            token = ids[t, :n].astype(np.int32)
            right2 = guess2 == token
            right = right2 | (guess1 == token)
        start = np.where(right, size2, upto1)
        size = np.where(right, upto1, _WHOLE) - start
        np.copyto(start, np.uint64(0), where=right2)
        np.copyto(size, size2, where=right2)
        follow(slice(0, n), start, size, unit)

        left = np.flatnonzero(~right)
        unit = coder.range[left] >> _COUNTED_BITS
        if decoding:
            token = np.where(right2, guess2, guess1)
            missed = counts.find(coder.code[left] // unit)
            token[left] = missed
            ids[t, :n] = token
        else:
            missed = token[left]
        follow(left, counts.starts.take(missed), counts.sizes.take(missed), unit)
        right1 = guess1 == token
        mixer2.new.append(context2 << 1 | right2)
        mixer1.new.append((context1 | (right2 | agree) * np.int32(_BINS)) << 1 | right1)
        counts.new.append(missed)
        for table, at, held, trust, hit in ((two_of, slot, two, trust2, right2), (one_of, last, one, trust1, right1)):
            kept = np.where(trust > 1, held - _LESS.take(trust), token)
            table[at] = np.where(hit, held + _MORE.take(trust), kept)
        before, last = last, token.astype(np.int64)


def _lengths(n: int) -> np.ndarray:
    lanes = -(-n // BLOCK)
    lengths = np.full(lanes, BLOCK)
    lengths[-1:] = n - BLOCK * (lanes - 1)
    return lengths


def encode(ids: np.ndarray) -> list[bytes]:
    """The ids (uint16) of a segment as the bytes of each of its blocks; every LANES blocks have a model of their own."""
    out: list[bytes] = []
    for i in range(0, len(ids), BLOCK * LANES):
        lengths = _lengths(len(ids[i : i + BLOCK * LANES]))
        held = np.zeros((len(lengths), BLOCK), np.uint16)
        held.reshape(-1)[: lengths.sum()] = ids[i : i + BLOCK * LANES]
        coder = _Encoder(len(lengths))
        _lockstep(lengths, coder, np.ascontiguousarray(held.T))
        out.extend(coder.end())
    return out


def decode(blocks: Sequence[bytes], n: int) -> np.ndarray:
    """The ``n`` ids of a segment."""
    out = np.zeros(len(blocks) * BLOCK, np.uint16)
    for i in range(0, len(blocks), LANES):
        lengths = _lengths(min(n - i * BLOCK, BLOCK * LANES))
        ids = np.zeros((BLOCK, len(lengths)), np.uint16)
        _lockstep(lengths, _Decoder(blocks[i : i + LANES]), ids)
        out[i * BLOCK : (i + len(lengths)) * BLOCK] = ids.T.reshape(-1)
    return out[:n]
