"""Adaptive context-mixing range coder for token ids, many blocks at a time in numpy.

Each block is coded on its own from an empty model. All blocks of a call advance together, an id a
step, so every numpy operation works on one id of each block. Only integers are used: a decoder on any
machine repeats the encoder's model exactly.

The model of a block:

* order 2 and order 1: tables that remember, for the last two ids and for the last one, which id came next
  and how often in a row that was right.
* two yes/no decisions, "is it the order-2 id" and "is it the order-1 id". The chance of yes is a mixture of
  three adaptive estimates (by the confidence of order 2, of order 1, and overall), whose weights follow
  how well each has predicted this block so far.
* order 0: otherwise the id is spelled in two halves by its frequency in the block. The frequency tables
  are renewed at steps that double, and then every ``RENEW`` steps.

The range coder works on 48 bits and emits 16-bit words. Ids are below 65,536.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096
LANES = 1024  # blocks that advance together
RENEW = 1024
SLOTS = 1024
LEVELS = 8  # of confidence
LOW_CLASSES = 8  # the low half is spelled by the class of the high half
_ONE = 1 << 16
_WINDOW = np.uint64((1 << 48) - 1)
_SETTLED, _SMALL = np.uint64(1 << 32), np.uint64(1 << 24)
_16, _32 = np.uint64(16), np.uint64(32)


class _Encoder:
    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, _WINDOW, np.uint64)
        self.words = np.zeros((lanes, 4 * steps + 8), np.uint16)
        self.at = np.zeros(lanes, np.int64)

    def put(self, lanes: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Narrow to the part [start, start + size) of 65,536."""
        part = self.range[lanes] >> _16
        low = self.low[lanes] + part * start.astype(np.uint64)
        self._settle(lanes, low, part * size.astype(np.uint64))

    def _settle(self, lanes, low, rng) -> None:
        self.low[lanes], self.range[lanes] = low, rng
        while True:
            settled = ((low ^ (low + rng)) & _WINDOW) < _SETTLED
            settled &= (low + rng) <= _WINDOW
            short = ~settled & (rng < _SMALL)
            move = np.flatnonzero(settled | short)
            if not len(move):
                return
            lanes, low, rng, short = lanes[move], low[move], rng[move], short[move]
            rng = np.where(short, (~low + np.uint64(1)) & (_SMALL - np.uint64(1)), rng)
            self.words[lanes, self.at[lanes]] = (low >> _32).astype(np.uint16)
            self.at[lanes] += 1
            low, rng = (low << _16) & _WINDOW, rng << _16
            self.low[lanes], self.range[lanes] = low, rng

    def finish(self) -> list[bytes]:
        lanes = np.arange(len(self.low))
        for _ in range(3):
            self.words[lanes, self.at] = (self.low >> _32).astype(np.uint16)
            self.at += 1
            self.low = (self.low << _16) & _WINDOW
        return [self.words[i, : self.at[i]].astype("<u2").tobytes() for i in range(len(self.low))]


class _Decoder:
    def __init__(self, payloads: list[bytes]):
        lanes = len(payloads)
        width = max(len(p) // 2 for p in payloads) + 8
        self.words = np.zeros((lanes, width), np.uint64)
        for i, p in enumerate(payloads):
            own = np.frombuffer(p, "<u2")
            self.words[i, : len(own)] = own
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, _WINDOW, np.uint64)
        self.code = (self.words[:, 0] << _32) | (self.words[:, 1] << _16) | self.words[:, 2]
        self.at = np.full(lanes, 3, np.int64)

    def where(self, lanes: np.ndarray) -> np.ndarray:
        part = self.range[lanes] >> _16
        return np.minimum((self.code[lanes] - self.low[lanes]) // part, np.uint64(_ONE - 1)).astype(np.int64)

    def take(self, lanes: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        part = self.range[lanes] >> _16
        low, rng = self.low[lanes] + part * start.astype(np.uint64), part * size.astype(np.uint64)
        self.low[lanes], self.range[lanes] = low, rng
        while True:
            settled = ((low ^ (low + rng)) & _WINDOW) < _SETTLED
            settled &= (low + rng) <= _WINDOW
            short = ~settled & (rng < _SMALL)
            move = np.flatnonzero(settled | short)
            if not len(move):
                return
            lanes, low, rng, short = lanes[move], low[move], rng[move], short[move]
            rng = np.where(short, (~low + np.uint64(1)) & (_SMALL - np.uint64(1)), rng)
            self.code[lanes] = ((self.code[lanes] << _16) & _WINDOW) | self.words[lanes, self.at[lanes]]
            self.at[lanes] += 1
            low, rng = (low << _16) & _WINDOW, rng << _16
            self.low[lanes], self.range[lanes] = low, rng


class _Mixed:
    """A yes/no chance from three adaptive estimates, mixed by adaptive weights; in 65,536ths."""

    def __init__(self, lanes: int, contexts: tuple[int, int, int]):
        self.tables = [np.full(lanes * n, _ONE // 2, np.int32) for n in contexts]
        self.sizes = contexts
        self.weights = np.full((3, lanes), _ONE // 4, np.int32)

    def chance(self, lanes: np.ndarray, contexts: tuple[np.ndarray, ...]) -> np.ndarray:
        self._lanes = lanes
        self._slots = [lanes * n + c for n, c in zip(self.sizes, contexts)]
        self._parts = [t[s] for t, s in zip(self.tables, self._slots)]
        self._weights = [w[lanes].astype(np.int64) for w in self.weights]
        total = self._weights[0] + self._weights[1] + self._weights[2]
        mixed = sum(w * p for w, p in zip(self._weights, self._parts)) // total
        return np.clip(mixed, 32, _ONE - 32)

    def learn(self, yes: np.ndarray) -> None:
        goal = np.where(yes, _ONE - 1, 0)
        for table, slot, part, weight, old in zip(self.tables, self._slots, self._parts, self.weights, self._weights):
            table[slot] = part + ((goal - part) >> 4)
            gave = np.where(yes, part, _ONE - part)
            weight[self._lanes] = np.maximum(old + ((gave - old) >> 5), 64)


class _Spelling:
    """Frequencies of 256 symbols in each of some classes, renewed now and then."""

    def __init__(self, lanes: int, classes: int):
        self.classes = classes
        self.counts = np.zeros((lanes * classes, 256), np.uint16)  # up to BLOCK
        self.upto = np.zeros((lanes * classes, 257), np.int32)
        self.upto[:] = np.arange(257) * 256

    def renew(self) -> None:
        total = np.cumsum(self.counts, axis=1, dtype=np.int64)
        whole = np.maximum(total[:, -1:], 1)
        seen = total[:, -1:] > 0
        share = np.where(seen, total * (_ONE - 256) // whole, np.arange(1, 257) * 255)
        self.upto[:, 1:] = share + np.arange(1, 257)

    def bounds(self, rows: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = self.upto[rows, symbol]
        return start, self.upto[rows, symbol + 1] - start

    def find(self, rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(rows), np.int64)
        for step in (128, 64, 32, 16, 8, 4, 2, 1):
            symbol += step * (self.upto[rows, symbol + step] <= point)
        return symbol

    def learn(self, rows: np.ndarray, symbol: np.ndarray) -> None:
        self.counts[rows, symbol] += 1


class _Model:
    def __init__(self, lanes: int):
        self.next = [np.zeros(lanes * SLOTS, np.uint16) for _ in range(2)]
        self.sure = [np.zeros(lanes * SLOTS, np.int8) for _ in range(2)]
        self.last = np.zeros((2, lanes), np.int64)
        self.decide = [_Mixed(lanes, (LEVELS, 2 * LEVELS, 1)), _Mixed(lanes, (LEVELS, LEVELS, 1))]
        self.high, self.low = _Spelling(lanes, 1), _Spelling(lanes, LOW_CLASSES)

    def begin(self, lanes: np.ndarray, step: int) -> None:
        """Look up what the contexts of these lanes predict."""
        if step and (step % RENEW == 0 or step < RENEW and step >= 64 and step & (step - 1) == 0):
            self.high.renew()
            self.low.renew()
        one, two = self.last[0][lanes], self.last[1][lanes]
        base = lanes * SLOTS
        self.slots = [base + (((one * 40503 + two * 24593) >> 3) ^ one) % SLOTS, base + one % SLOTS]
        self.guess = [n[s].astype(np.int64) for n, s in zip(self.next, self.slots)]
        self.level = [c[s].astype(np.int64) for c, s in zip(self.sure, self.slots)]
        self.same = (self.guess[0] == self.guess[1]).astype(np.int64)

    def contexts(self, order: int, some: np.ndarray) -> tuple[np.ndarray, ...]:
        a, b = self.level[0][some], self.level[1][some]
        zero = np.zeros(len(some), np.int64)
        return (a, 2 * b + self.same[some], zero) if order == 0 else (a, b, zero)

    def end(self, lanes: np.ndarray, ids: np.ndarray) -> None:
        for table, sure, slot, guess, level in zip(self.next, self.sure, self.slots, self.guess, self.level):
            right = guess == ids
            sure[slot] = np.where(right, np.minimum(level + 1, LEVELS - 1), level >> 1)
            table[slot] = np.where(right | (level > 1), guess, ids)
        self.last[1][lanes] = self.last[0][lanes]
        self.last[0][lanes] = ids


def _lengths_sorted(lengths: np.ndarray) -> np.ndarray:
    return np.argsort(-lengths, kind="stable")


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Code each array of ids. Payloads come in the order of the blocks."""
    out: list[bytes] = [b""] * len(blocks)
    for at in range(0, len(blocks), LANES):
        group = blocks[at : at + LANES]
        order = _lengths_sorted(np.array([len(b) for b in group]))
        for i, payload in zip(order.tolist(), _encode([group[i] for i in order])):
            out[at + i] = payload
    return out


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    lengths = np.array([len(b) for b in blocks])
    steps = int(lengths[0])
    ids = np.zeros((steps, len(blocks)), np.int64)
    for i, b in enumerate(blocks):
        ids[: len(b), i] = b
    if steps and ids.max() >= _ONE:
        raise ValueError("ids are below 65,536")
    coder, model = _Encoder(len(blocks), steps), _Model(len(blocks))
    for step in range(steps):
        lanes = np.arange(np.searchsorted(-lengths, -step))  # blocks longer than ``step``
        x = ids[step, : len(lanes)]
        model.begin(lanes, step)
        left, hit = lanes, np.zeros(len(lanes), bool)
        for order in range(2):
            ask = left if order == 0 else left[model.same[left] == 0]
            yes = model.guess[order][ask] == x[ask]
            p = model.decide[order].chance(ask, model.contexts(order, ask))
            coder.put(ask, np.where(yes, 0, p), np.where(yes, p, _ONE - p))
            model.decide[order].learn(yes)
            hit[ask] = yes
            left = left[~hit[left]]
        high, low = x[left] >> 8, x[left] & 255
        coder.put(left, *model.high.bounds(left, high))
        model.high.learn(left, high)
        rows = left * LOW_CLASSES + high % LOW_CLASSES
        coder.put(left, *model.low.bounds(rows, low))
        model.low.learn(rows, low)
        model.end(lanes, x)
    return coder.finish()


def decode_blocks(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each payload, whose number of ids is given."""
    out: list[np.ndarray] = [None] * len(payloads)
    for at in range(0, len(payloads), LANES):
        sizes = np.array(lengths[at : at + LANES])
        order = _lengths_sorted(sizes)
        ids = _decode([payloads[at + i] for i in order], sizes[order])
        for n, i in enumerate(order.tolist()):
            out[at + i] = ids[: sizes[i], n].astype(np.uint32)
    return out


def _decode(payloads: list[bytes], lengths: np.ndarray) -> np.ndarray:
    steps = int(lengths[0])
    ids = np.zeros((steps, len(payloads)), np.int64)
    coder, model = _Decoder(payloads), _Model(len(payloads))
    for step in range(steps):
        lanes = np.arange(np.searchsorted(-lengths, -step))
        x = np.zeros(len(lanes), np.int64)
        model.begin(lanes, step)
        left, hit = lanes, np.zeros(len(lanes), bool)
        for order in range(2):
            ask = left if order == 0 else left[model.same[left] == 0]
            p = model.decide[order].chance(ask, model.contexts(order, ask))
            yes = coder.where(ask) < p
            coder.take(ask, np.where(yes, 0, p), np.where(yes, p, _ONE - p))
            model.decide[order].learn(yes)
            x[ask[yes]] = model.guess[order][ask[yes]]
            hit[ask] = yes
            left = left[~hit[left]]
        high = model.high.find(left, coder.where(left))
        coder.take(left, *model.high.bounds(left, high))
        model.high.learn(left, high)
        rows = left * LOW_CLASSES + high % LOW_CLASSES
        low = model.low.find(rows, coder.where(left))
        coder.take(left, *model.low.bounds(rows, low))
        model.low.learn(rows, low)
        x[left] = (high << 8) | low
        model.end(lanes, x)
        ids[step, : len(lanes)] = x
    return ids


def checksum(payload: bytes, ids: np.ndarray) -> int:
    """Over the payload and the ids it stands for."""
    return zlib.crc32(ids.astype("<u4").tobytes(), zlib.crc32(payload))
