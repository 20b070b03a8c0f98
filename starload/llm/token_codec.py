"""Adaptive context-mixing range coder for 16-bit token ids, many independent blocks side by side.

A block starts from an empty model. Order 2 and order 1 each guess the next id from what followed the
same context last; order 0 counts ids. Whether the order-2 guess is right is coded with a probability
mixed from all three, then whether the order-1 guess is, and an id that nobody guessed is coded from
the order-0 counts, four bits at a time. All arithmetic is in whole numbers, so that any machine
decodes what another has encoded.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np

BLOCK = 8192
LANES = 512
_SLOTS = 1 << 13
_FULL = np.int64(0xFFFFFFFF)
_TOP, _BOTTOM = np.int64(1 << 24), np.int64(1 << 16)
_ONE = 4096
_STRETCH = np.array([round(256 * math.log((p + 0.5) / (_ONE - p - 0.5))) for p in range(_ONE)], np.int64)
_SQUASH = np.array([
    min(_ONE - 1, max(1, round(_ONE / (1 + math.exp(-x / 256))))) for x in range(-2200, 2201)
], np.int64)
_STEP, _LIMIT = 24, 1 << 15
_BASES = (0, 1, 17, 273)
_NODES = 4369


class _Model:
    """State of all lanes in flat tables; a lane's part starts at its number times the size."""

    def __init__(self, lanes: int):
        self.guess = [np.zeros(lanes * _SLOTS, np.int32) for _ in range(2)]
        """The id guessed, and above its 16 bits how far it is trusted, 0 to 7."""
        self.right = [np.full(lanes * 8, _ONE * 8, np.int64) for _ in range(3)]
        self.weight = [np.full((lanes * 2, 3), 1 << 14, np.int64) for _ in range(2)]
        self.counts = np.ones((lanes * _NODES, 16), np.uint16)
        self.count_of = self.counts.reshape(-1)
        self.totals = np.full(lanes * _NODES, 16, np.int32)
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)

    def look(self, lane: np.ndarray) -> None:
        """Guesses of order 2 and 1 for the next id of each lane."""
        one, two = self.last[lane], self.before[lane]
        of = lane * _SLOTS
        self.slot = [
            of + ((one * 40503 + two * 10007 + (two >> 5)) & (_SLOTS - 1)), of + ((one * 9973 + (one >> 3)) & (_SLOTS - 1))
        ]
        held = [g.take(s).astype(np.int64) for g, s in zip(self.guess, self.slot)]
        self.guesses = [h & 65535 for h in held]
        self.trusts = [h >> 16 for h in held]

    def seen(self, lane: np.ndarray, token: np.ndarray) -> None:
        for k in range(2):
            hit = self.guesses[k] == token
            trust = self.trusts[k]
            firm = trust > 1
            kept = np.where(hit | firm, self.guesses[k], token)
            trust = np.where(hit, np.minimum(trust + 1, 7), (trust >> 1) * firm)
            self.guess[k][self.slot[k]] = kept | trust << 16
        self.before[lane] = self.last[lane]
        self.last[lane] = token

    def order0(self, lane: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Chance of the id by the counts, of 4096."""
        chance = _ONE << 8
        of = lane * _NODES
        for k in range(4):
            node = of + (_BASES[k] + (token >> (16 - 4 * k)))
            chance = chance * self.count_of.take((node << 4) + ((token >> (12 - 4 * k)) & 15)).astype(np.int64)
            chance = chance // self.totals.take(node)
        return np.clip(chance >> 8, 1, _ONE - 1)

    def chance(self, which: int, lane: np.ndarray, pick: np.ndarray) -> np.ndarray:
        """Mixed chance, of 4096, that guess ``which`` of the picked lanes is right."""
        trust2, trust1 = self.trusts[0][pick], self.trusts[1][pick]
        self.agree = (self.guesses[0][pick] == self.guesses[1][pick]).astype(np.int64)
        self.places = [(lane << 3) + (trust1 if which else trust2), (lane << 3) + trust1]
        self.was = [self.right[which].take(self.places[0]), self.right[2].take(self.places[1])]
        self.inputs = np.empty((len(lane), 3), np.int64)
        self.inputs[:, 0] = _STRETCH.take(self.was[0] >> 4)
        short = _STRETCH.take(self.was[1] >> 4)
        self.inputs[:, 1] = short if which else short * (2 * self.agree - 1)
        self.inputs[:, 2] = _STRETCH.take(self.order0(lane, self.guesses[which][pick]))
        self.place = (lane << 1) + self.agree
        self.mix = self.weight[which].take(self.place, axis=0)
        mixed = np.einsum("ij,ij->i", self.mix, self.inputs) >> 15
        self.mixed = _SQUASH.take(np.minimum(np.maximum(mixed, -2200), 2200) + 2200)
        return self.mixed

    def learn(self, which: int, hit: np.ndarray) -> None:
        error = (hit * _ONE - self.mixed)[:, None]
        self.weight[which][self.place] = np.minimum(np.maximum(self.mix + ((self.inputs * error) >> 8), -(1 << 18)), 1 << 18)
        for row, place, p, was in zip((which, 2), self.places, self.was, (hit, hit if which else hit * self.agree)):
            self.right[row][place] = np.minimum(np.maximum(p + ((was * 65535 - p) >> 5), 16), 65519)

    def count(self, node: np.ndarray, digit: np.ndarray, size: np.ndarray, total: np.ndarray) -> None:
        """Add to a digit of a node, whose count and total were ``size`` and ``total``."""
        self.count_of[(node << 4) + digit] = size + _STEP
        total = total + _STEP
        self.totals[node] = total
        full = total > _LIMIT
        if full.any():
            at = node[full]
            self.counts[at] = (self.counts[at] + 1) >> 1
            self.totals[at] = self.counts[at].sum(axis=1)


def _unsettled(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Where the top byte is known, or the range too small to go on."""
    return ((low ^ (low + width)) < _TOP) | (width < _BOTTOM)


def _moved_on(low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low end and range without their top byte; a small range across a carry is cut at it first."""
    width = np.where((low ^ (low + width)) >= _TOP, -low & (_BOTTOM - 1), width)
    return (low << 8) & _FULL, (width << 8) & _FULL


class _Encoder:
    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, _FULL)
        self.out = np.zeros((lanes, 1 << 14), np.uint8)
        self.at = np.zeros(lanes, np.int64)
        self.most = 0
        """No lane has put out more."""

    def put(self, lane: np.ndarray, start: np.ndarray, size: np.ndarray, total: np.ndarray | int) -> None:
        unit = self.range[lane] // total
        low, width = (self.low[lane] + start * unit) & _FULL, size * unit
        go = np.flatnonzero(_unsettled(low, width))
        while len(go):
            of, cut = lane[go], low[go]
            self._room()
            at = self.at[of]
            self.out.reshape(-1)[of * self.out.shape[1] + at] = cut >> 24
            self.at[of] = at + 1
            cut, span = _moved_on(cut, width[go])
            low[go], width[go] = cut, span
            go = go[_unsettled(cut, span)]
        self.low[lane], self.range[lane] = low, width

    def _room(self) -> None:
        """Room for one more byte in every lane."""
        self.most += 1
        if self.most > self.out.shape[1]:
            self.most = int(self.at.max()) + 1
            if self.most > self.out.shape[1]:
                self.out = np.concatenate([self.out, np.zeros_like(self.out)], axis=1)

    def end(self) -> list[bytes]:
        lanes = np.arange(len(self.low))
        for _ in range(4):
            self._room()
            self.out[lanes, self.at] = self.low >> 24
            self.at += 1
            self.low = (self.low << 8) & _FULL
        return [row[:n].tobytes() for row, n in zip(self.out, self.at)]


class _Decoder:
    def __init__(self, blocks: Sequence[bytes]):
        self.data = np.zeros((len(blocks), max(map(len, blocks)) + 8), np.uint8)
        for row, block in zip(self.data, blocks):
            row[: len(block)] = np.frombuffer(block, np.uint8)
        lanes = len(blocks)
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, _FULL)
        self.code = np.zeros(lanes, np.int64)
        for k in range(4):
            self.code = (self.code << 8) | self.data[:, k]
        self.flat = self.data.reshape(-1)
        self.at = np.arange(lanes) * self.data.shape[1] + 4

    def offset(self, lane: np.ndarray, total: np.ndarray | int) -> np.ndarray:
        self.from_low, self.of_code = self.low[lane], self.code[lane]
        self.unit = self.range[lane] // total
        return np.minimum(((self.of_code - self.from_low) & _FULL) // self.unit, np.asarray(total) - 1)

    def take(self, lane: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Follows ``offset`` of the same lanes."""
        low, width, code = (self.from_low + start * self.unit) & _FULL, size * self.unit, self.of_code
        go = np.flatnonzero(_unsettled(low, width))
        while len(go):
            of = lane[go]
            at = self.at[of]
            code[go] = ((code[go] << 8) & _FULL) | self.flat.take(at)
            self.at[of] = at + 1
            cut, span = _moved_on(low[go], width[go])
            low[go], width[go] = cut, span
            go = go[_unsettled(cut, span)]
        self.low[lane], self.range[lane], self.code[lane] = low, width, code


def _lockstep(lengths: np.ndarray, coder, read, write) -> None:
    """Walk all lanes token by token. ``read(lane, t)`` gives the token or None when decoding."""
    model = _Model(len(lengths))
    decoding = read is None
    every = np.arange(len(lengths))
    shortest = lengths.min(initial=0)
    for t in range(int(lengths.max(initial=0))):
        lane = every if t < shortest else np.flatnonzero(lengths > t)
        model.look(lane)
        token = np.full(len(lane), -1) if decoding else read(lane, t)
        left = every[: len(lane)]
        for which in range(2):
            of = lane[left]
            guess = model.guesses[which][left]
            chance = model.chance(which, of, left)
            if decoding:
                right = coder.offset(of, _ONE) < chance
                token[left[right]] = guess[right]
            else:
                right = guess == token[left]
            start, size = np.where(right, 0, chance), np.where(right, chance, _ONE - chance)
            coder.take(of, start, size) if decoding else coder.put(of, start, size, _ONE)
            model.learn(which, right.astype(np.int64))
            missed = left[~right]
            if which == 0:
                same = model.guesses[0][missed] == model.guesses[1][missed]
                left, agreed = missed[~same], missed[same]
            else:
                left = missed
            if not len(left):
                break
        left = np.sort(np.concatenate([left, agreed])) if len(agreed) else left
        if len(left):
            of = lane[left]
            known = token[left]
            at = of * _NODES
            row = every[: len(left)]
            prefix = np.zeros(len(left), np.int64)
            for k in range(4):
                node = at + (_BASES[k] + prefix)
                upto = np.cumsum(model.counts.take(node, axis=0), axis=1, dtype=np.int32)
                total = model.totals.take(node).astype(np.int64)
                if decoding:
                    digit = (upto <= coder.offset(of, total)[:, None]).sum(axis=1)
                else:
                    digit = (known >> (12 - 4 * k)) & 15
                size = model.count_of.take((node << 4) + digit).astype(np.int64)
                start = upto[row, digit] - size
                coder.take(of, start, size) if decoding else coder.put(of, start, size, total)
                model.count(node, digit, size, total)
                prefix = (prefix << 4) | digit
            token[left] = prefix
        model.seen(lane, token)
        if decoding:
            write(lane, t, token)


def encode(blocks: Sequence[np.ndarray]) -> list[bytes]:
    """Each block of ids (uint16) as bytes of its own."""
    out: list[bytes] = []
    for i in range(0, len(blocks), LANES):
        group = blocks[i : i + LANES]
        lengths = np.array([len(b) for b in group])
        ids = np.zeros((lengths.max(initial=0), len(group)), np.uint16)
        for n, block in enumerate(group):
            ids[: len(block), n] = block
        coder = _Encoder(len(group))
        _lockstep(lengths, coder, lambda lane, t: ids[t, lane].astype(np.int64), None)
        out.extend(coder.end())
    return out


def decode(blocks: Sequence[bytes], lengths: Sequence[int]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for i in range(0, len(blocks), LANES):
        group, sizes = blocks[i : i + LANES], np.array(lengths[i : i + LANES])
        ids = np.zeros((len(group), sizes.max(initial=0)), np.uint16)

        def write(lane: np.ndarray, t: int, token: np.ndarray) -> None:
            ids[lane, t] = token

        _lockstep(sizes, _Decoder(group), None, write)
        out.extend(row[:n] for row, n in zip(ids, sizes))
    return out


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
