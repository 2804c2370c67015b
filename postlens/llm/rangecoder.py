"""Adaptive context-mixing range coder for token ids, in blocks that stand alone.

A block's ids are cut into up to 4096 lanes that are coded side by side, one step taking one id of each lane, with one
model for the block. The model predicts an id from the two ids before (order 2) and one from the id before (order 1).
The coder sends, under probabilities mixed from what both orders were worth so far, whether the order-2 or else
the order-1 prediction is right; if neither is, the id itself under order-0 frequencies. Everything adapts after
each step to the ids seen; all of it is integer arithmetic, so the reader repeats it exactly.

Fixed values of the format are the constants below. A block is
``magic, ids, lanes, crc32 of the ids, crc32 of the rest, words per lane, words``.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

MAGIC = b"CMR1"
_HEAD = struct.Struct("<4sIIII")
#: Coder: 64-bit low and range, emitted in words of 32 bits. Probabilities of 16 bits, id counts below 2^24.
WORD, PROB, TOTAL = np.uint64(32), 16, 24
_LOW = np.uint64((1 << 32) - 1)
_LEAST = np.uint64(1 << 32)
MAX_LANES, IDS_PER_LANE = 4096, 64
ORDER1_BITS, ORDER2_BITS, MOST = 16, 18, 15
#: Steps between sums over the id counts, what an occurrence adds to a count, steps between mixings.
REFRESH, GAIN, REMIX = 8, 32, 4
#: Logistic tables in 1/256 of a nat, probabilities in 1/4096.
SQUASH = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-(x - 2047) / 256))))) for x in range(4095)], np.int64)
STRETCH = np.array([min(2047, max(-2047, round(256 * math.log(p / (4096 - p))))) if p else -2047 for p in range(4096)], np.int64)


STATES = (MOST + 1) ** 2
#: How sure order 1 and order 2 are in each state; how sure an order is after a right and after a wrong guess. A
#: guess that was wrong when hardly sure is replaced by what was seen.
SURE = (np.arange(STATES) % (MOST + 1), np.arange(STATES) // (MOST + 1))
SURER = np.minimum(np.arange(MOST + 1) + 1, MOST).astype(np.uint8)
LESS_SURE = np.maximum(np.arange(MOST + 1) >> 1, 1).astype(np.uint8)
#: Both in one, those after a right guess from ``MOST + 1`` on.
NEXT_SURE = np.concatenate([LESS_SURE, SURER]).astype(np.int64)


class ChecksumError(ValueError):
    """A block whose bytes or ids are not those that were written."""


class _Model:
    """What writer and reader keep alike: predictions, their worth, and id counts.

    How often a prediction was right is counted by state, that is by how sure both orders are, so mixing is
    done once for each of the 256 states and not for each lane.
    """

    def __init__(self, vocabulary: int):
        # A slot has the predicted id and, in its last four bits, how sure it is.
        self.table = [np.zeros(1 << bits, np.int64 if vocabulary >> 27 else np.int32) for bits in (ORDER1_BITS, ORDER2_BITS)]
        self.tries = np.full((2, STATES), 8, np.int64)
        self.hits = np.full((2, STATES), 4, np.int64)
        self.weights = np.full((2, 2), 1 << 15, np.int64)
        self.counts = np.ones(vocabulary, np.int64)
        self.sums = np.arange(vocabulary + 1, dtype=np.int64)
        self.recent: list[np.ndarray] = []
        self.step = 0
        self._mix()

    def _mix(self) -> None:
        """Per state and order: what the state's own record and the record of the order's sureness alone say,
        weighed by what each was worth; then the bounds of the three cases on the coder's scale."""
        self.inputs, self.chance = [], []
        for order in (0, 1):
            tries, hits = (x[order].reshape(MOST + 1, MOST + 1) for x in (self.tries, self.hits))
            alone = STRETCH[hits.sum(axis=order) * 4096 // tries.sum(axis=order)]
            alone = alone[SURE[order]]
            joint = STRETCH[self.hits[order] * 4096 // self.tries[order]]
            mix = (self.weights[order, 0] * joint + self.weights[order, 1] * alone) >> 16
            self.inputs.append((joint, alone))
            self.chance.append(SQUASH[np.clip(mix, -2047, 2047) + 2047])
        # A prediction never made is given no chance worth having, but the coder needs one above 0.
        self.top = np.where(SURE[1] > 0, self.chance[1] << 4, 1)
        self.middle = self.top + np.where(SURE[0] > 0, np.maximum(((1 << PROB) - self.top) * self.chance[0] >> 12, 1), 1)

    def predict(self, last: np.ndarray, before: np.ndarray) -> None:
        """Slots, predicted ids and bounds for lanes with these last two ids."""
        one = last & ((1 << ORDER1_BITS) - 1)
        two = ((last * 2654435761 + before * 40499) >> 7) & ((1 << ORDER2_BITS) - 1)
        self.slots = (one, two)
        found = (self.table[0][one].astype(np.int64), self.table[1][two].astype(np.int64))
        self.guess = (found[0] >> 4, found[1] >> 4)
        self.trust = (found[0] & MOST, found[1] & MOST)
        self.state = self.trust[1] * (MOST + 1) + self.trust[0]
        top = self.top[self.state]
        middle = np.where(self.guess[0] == self.guess[1], top + 1, self.middle[self.state])
        self.bounds = (top, middle)

    def learn(self, seen: np.ndarray) -> None:
        right = [guess == seen for guess in self.guess]
        cases = (self.state << 2) + right[0] + 2 * right[1].view(np.uint8)
        neither, first, second, both = np.bincount(cases, minlength=4 * STATES).reshape(STATES, 4).T
        tried = (neither + first, neither + first + second + both)
        hit = (first, second + both)
        for order in (0, 1):
            known = SURE[order] > 0
            miss = ((hit[order] << 12) - tried[order] * self.chance[order]) * known
            asked = max(1, int((tried[order] * known).sum())) << 6
            for k, value in enumerate(self.inputs[order]):
                change = int(miss @ value) // asked
                self.weights[order, k] = min(1 << 18, max(0, int(self.weights[order, k]) + change))
            self.tries[order] += tried[order]
            self.hits[order] += hit[order]
            slot, trust = self.slots[order], self.trust[order]
            found = np.where(right[order] | (trust > 1), self.guess[order], seen)
            self.table[order][slot] = (found << 4) | NEXT_SURE[trust + (MOST + 1) * right[order].view(np.uint8)]
        if self.step % 16 == 15:
            large = self.tries > 1 << 14
            self.tries[large] >>= 1
            self.hits[large] >>= 1
        self.recent.append(seen)
        self.step += 1
        if self.step % REMIX == 0 or self.step < 16:
            self._mix()
        if self.step % REFRESH == 0:
            self.counts += GAIN * np.bincount(np.concatenate(self.recent), minlength=len(self.counts))
            self.recent = []
            if int(self.counts.sum()) >= 1 << TOTAL:
                self.counts = (self.counts + 1) >> 1
            np.cumsum(self.counts, out=self.sums[1:])


class _Writer:
    def __init__(self, lanes: int, steps: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
        # Lanes are about as far as each other, so a step writes to few rows.
        self.words, self.at = np.zeros((2 * steps + 4, lanes), np.uint32), np.zeros(lanes, np.int64)

    def code(self, lanes, start: np.ndarray, size: np.ndarray, total) -> None:
        """``lanes`` is a slice or an array of places; ``total`` the scale of start and size."""
        part = self.range[lanes] >> np.uint64(PROB) if total == 1 << PROB else self.range[lanes] // total
        low, wide = self.low[lanes] + part * start.view(np.uint64), part * size.view(np.uint64)
        high, self.low[lanes], self.range[lanes], out = low >> WORD, *_settled(low, wide)
        done = out if isinstance(lanes, slice) else lanes[out]
        high = high[out]
        at = self.at[done]
        self.words[at, done] = high.astype(np.uint32)
        self.at[done] = at + 1

    def finish(self) -> tuple[np.ndarray, bytes]:
        every = np.arange(len(self.low))
        for word in (self.low >> WORD, self.low & _LOW):
            self.words[self.at, every] = word.astype(np.uint32)
            self.at += 1
        lanes = np.ascontiguousarray(self.words[: int(self.at.max())].T)
        return self.at, lanes[np.arange(lanes.shape[1]) < self.at[:, None]].astype("<u4").tobytes()


class _Reader:
    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.words, self.at = words, np.cumsum(sizes) - sizes
        self.ends = self.at + sizes
        self.low, self.range = np.zeros(len(sizes), np.uint64), np.full(len(sizes), (1 << 64) - 1, np.uint64)
        every = np.arange(len(sizes))
        self.value = self._next(every) << WORD
        self.value |= self._next(every)

    def _next(self, lanes: np.ndarray) -> np.ndarray:
        found = self.words[np.minimum(self.at[lanes], len(self.words) - 1)].astype(np.uint64)
        self.at[lanes] += 1
        return found

    def ask(self, lanes, total) -> np.ndarray:
        self.part = self.range[lanes] >> np.uint64(PROB) if total == 1 << PROB else self.range[lanes] // total
        return np.minimum((self.value[lanes] - self.low[lanes]) // self.part, total - np.uint64(1)).view(np.int64)

    def take(self, lanes, start: np.ndarray, size: np.ndarray) -> None:
        low, wide = self.low[lanes] + self.part * start.view(np.uint64), self.part * size.view(np.uint64)
        self.low[lanes], self.range[lanes], out = _settled(low, wide)
        done = out if isinstance(lanes, slice) else lanes[out]
        self.value[done] = (self.value[done] << WORD) | self._next(done)


def _settled(low: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Low and range after at most one word is emitted, and the places of the lanes for which one is.

    A word is due when all of the range has it in common. A small range across two words is cut to the part in the
    first, so that no carry ever reaches what was emitted.
    """
    same = (low ^ (low + (wide - np.uint64(1)))) < _LEAST
    out = np.flatnonzero(same | (wide < _LEAST))
    to_edge = (_LOW - (low[out] & _LOW)) + np.uint64(1)
    wide[out] = np.minimum(np.where(same[out], wide[out], to_edge), _LOW) << WORD
    low[out] <<= WORD
    return low, wide, out


def _lanes(n: int) -> np.ndarray:
    """Ids per lane: the longer lanes first, so that the lanes of each step are the first so many."""
    lanes = max(1, min(MAX_LANES, n // IDS_PER_LANE))
    return n // lanes + (np.arange(lanes) < n % lanes)


def _blocks(ids: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The ids of the longer lanes and those of the others, a row for each lane."""
    least, longer = int(sizes[-1]), int((sizes > sizes[-1]).sum())
    cut = longer * (least + 1)
    return [ids[:cut].reshape(longer, least + 1), ids[cut:].reshape(len(sizes) - longer, least)]


def _blocks_of_steps(steps: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The parts of ``steps`` that have the ids of :func:`_blocks`, a column for each lane."""
    least, longer = int(sizes[-1]), int((sizes > sizes[-1]).sum())
    return [steps[: least + 1, :longer], steps[:least, longer:]]


def _steps(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids, a row for each step, in which a lane has its column."""
    steps = np.zeros((int(sizes[-1]) + 1, len(sizes)), "<u4")
    for lanes, of_step in zip(_blocks(ids, sizes), _blocks_of_steps(steps, sizes), strict=True):
        of_step[:] = lanes.T
    return steps


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    """The block of ``ids`` (each below ``vocabulary``); no ids are a block as well."""
    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) and int(ids.max()) >= vocabulary:
        raise ValueError(f"id {int(ids.max())} is outside a vocabulary of {vocabulary}")
    sizes = _lanes(len(ids))
    steps, longer = _steps(ids, sizes), int((sizes > sizes[-1]).sum())
    model, coder = _Model(vocabulary), _Writer(len(sizes), int(sizes.max()))
    last, before = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    with np.errstate(over="ignore"):
        for step in range(int(sizes.max()) if len(ids) else 0):
            active = slice(0, len(sizes) if step < sizes[-1] else longer)
            seen = steps[step, active].astype(np.int64)
            model.predict(last[active], before[active])
            top, middle = model.bounds
            second = (seen == model.guess[1]) & (model.trust[1] > 0)
            first = (seen == model.guess[0]) & (model.trust[0] > 0) & (model.guess[0] != model.guess[1])
            start = np.where(second, 0, np.where(first, top, middle))
            end = np.where(second, top, np.where(first, middle, 1 << PROB))
            coder.code(active, start, end - start, np.uint64(1 << PROB))
            rest = np.flatnonzero(~(second | first))
            if len(rest):
                low = model.sums[seen[rest]]
                coder.code(rest, low, model.sums[seen[rest] + 1] - low, np.uint64(model.sums[-1]))
            model.learn(seen)
            before[active], last[active] = last[active], seen
    counts, words = coder.finish()
    body = counts.astype("<u4").tobytes() + words
    return _HEAD.pack(MAGIC, len(ids), len(sizes), zlib.crc32(ids.tobytes()), zlib.crc32(body)) + body


def decode(block: bytes, vocabulary: int) -> np.ndarray:
    """The ids of a block; :class:`ChecksumError` if it was damaged."""
    magic, n, lanes, ids_crc, body_crc = _HEAD.unpack_from(block) if len(block) >= _HEAD.size else (b"", 0, 0, 0, 0)
    body = memoryview(block)[_HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != body_crc:
        raise ChecksumError("the bytes of the block are damaged")
    counts = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    reader = _Reader(counts, np.frombuffer(body, "<u4", offset=4 * lanes))
    sizes = _lanes(n)
    model, ids = _Model(vocabulary), np.zeros(n, "<u4")
    steps, longer = _steps(ids, sizes), int((sizes > sizes[-1]).sum())
    last, before = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    with np.errstate(over="ignore"):
        for step in range(int(sizes.max()) if n else 0):
            active = slice(0, len(sizes) if step < sizes[-1] else longer)
            model.predict(last[active], before[active])
            top, middle = model.bounds
            value = reader.ask(active, np.uint64(1 << PROB))
            second, rest = value < top, value >= middle
            start = np.where(second, 0, np.where(rest, middle, top))
            end = np.where(second, top, np.where(rest, 1 << PROB, middle))
            reader.take(active, start, end - start)
            seen = np.where(second, model.guess[1], model.guess[0]).astype(np.int64)
            rest = np.flatnonzero(rest)
            if len(rest):
                value = reader.ask(rest, np.uint64(model.sums[-1]))
                order = np.argsort(value)
                found = np.empty(len(rest), np.int64)
                # In order, a search starts where the one before it ended.
                found[order] = np.searchsorted(model.sums, value[order], side="right") - 1
                reader.take(rest, model.sums[found], model.sums[found + 1] - model.sums[found])
                seen[rest] = found
            model.learn(seen)
            steps[step, active] = seen
            before[active], last[active] = last[active], seen
    for lanes, of_step in zip(_blocks(ids, sizes), _blocks_of_steps(steps, sizes), strict=True):
        lanes[:] = of_step.T
    if zlib.crc32(ids.tobytes()) != ids_crc:
        raise ChecksumError("the ids of the block are damaged")
    return ids
