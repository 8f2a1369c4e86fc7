"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks. A block starts from nothing and carries checksums, so any block
can be read alone. Within a block, three predictions are mixed:

* order 2: the id that followed the last two ids when they were met before,
* order 1: the id that followed the last id,
* order 0: the ids met so far in a list in which each use moves an id halfway to the front;
  the list's ranks, by powers of two, and ids not met yet have adaptive frequencies.

The weights of the mix are the chances of each prediction to come true, learnt for each
state of confidence of the two contexts. What comes true is coded by a range coder.

Blocks are coded in step: each numpy operation works on one id of many blocks.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a block. Longer ones are smaller by a tenth at 4096, but fewer fit into memory together.
BLOCK = 1 << 10
CONTEXTS = 1 << 9
LONGEST = 1 << 12
CLASSES = 16  # of ranks: 0, 1, 2-3, 4-7, ...; the last class is ids not met yet
NEW = CLASSES - 1
STATES = 32
RATE = 5
BITS = 12  # the weights of the mix add up to 2**12

_MASK = np.int64((1 << 48) - 1)
_ONE = np.int64(1)
_CLASS = np.array([int(r + 1).bit_length() - 1 for r in range(LONGEST)], np.int64)
_GAIN = 24
_HEADER = struct.Struct("<IIII")  # ids, bytes of code, crc32 of the ids, crc32 of the code
# for each class: the gain at the bounds above it
_ABOVE = (_GAIN * np.triu(np.ones((CLASSES, CLASSES + 1)), 1)).astype(np.int16)


class RangeEncoder:
    """48-bit range coders, one for each row. Carries are added to the words put out before."""

    def __init__(self, rows: int, room: int):
        self.low = np.zeros(rows, np.int64)
        self.range = np.full(rows, 1 << 48, np.int64)
        self.room = room
        self.words = np.zeros(rows * room, np.int32)
        self.end = np.arange(rows, dtype=np.int64) * room

    def _move(self, low: np.ndarray, rng: np.ndarray, at: np.ndarray | None) -> None:
        carry = np.flatnonzero(low > _MASK)
        if len(carry):
            self.words[self.end[carry if at is None else at[carry]] - 1] += 1
            low[carry] &= _MASK
        short = np.flatnonzero(rng < 1 << 32)
        if len(short):
            some = short if at is None else at[short]
            l, end = low[short], self.end[some]
            self.words[end] = l >> 32
            self.end[some] = end + 1
            low[short] = (l << 16) & _MASK
            rng[short] <<= 16

    def mixed(self, n: int, start: np.ndarray, width: np.ndarray) -> None:
        """Code an interval of 2**BITS for each of the first ``n`` rows."""
        low, rng = self.low[:n], self.range[:n]
        rng >>= BITS
        low += rng * start
        rng *= width
        self._move(low, rng, None)

    def code(self, at: np.ndarray, start: np.ndarray, width: np.ndarray, total: np.ndarray) -> None:
        """Code an interval of ``total`` for the rows ``at``."""
        step = quotient(self.range[at], total)
        low, rng = self.low[at] + step * start, step * width
        self._move(low, rng, at)
        self.low[at], self.range[at] = low, rng

    def bits(self, at: np.ndarray, value: np.ndarray, count: np.ndarray) -> None:
        """Code numbers of ``count`` bits, all as likely."""
        rng = self.range[at] >> count
        low = self.low[at] + rng * value
        self._move(low, rng, at)
        self.low[at], self.range[at] = low, rng

    def finish(self) -> list[bytes]:
        """The code of each row. What a decoder reads beyond its end is zero."""
        # the interval is at least 2**32 wide, so one word tells a number in it
        self.words[self.end] = (self.low + (1 << 32) - 1) >> 32
        self.end += 1
        sizes = self.end - np.arange(len(self.low)) * self.room
        words = self.words.reshape(len(self.low), self.room)[:, :int(sizes.max(initial=0))].copy()
        while len(over := np.flatnonzero(words > 0xFFFF)):
            row, column = np.unravel_index(over, words.shape)
            words[row, column] -= 1 << 16
            np.add.at(words, (row, column - 1), 1)
        out = words.astype("<u2")
        return [out[i, :n].tobytes() for i, n in enumerate(sizes)]


def quotient(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a // b for a below 2**48 and b up to 2**16, or a multiple of b less than 2**16 times it."""
    q = (a / b).astype(np.int64)
    q -= q * b > a
    return q


class RangeDecoder:
    def __init__(self, codes: list[bytes]):
        # a decoder reads two words beyond the code, which are zero
        self.room = max(map(len, codes), default=0) // 2 + 4
        words = np.zeros((len(codes), self.room), np.int64)
        for i, c in enumerate(codes):
            words[i, :len(c) // 2] = np.frombuffer(c, "<u2")
        self.value = (words[:, 0] << 32) | (words[:, 1] << 16) | words[:, 2]
        self.range = np.full(len(codes), 1 << 48, np.int64)
        self.words = words.ravel()
        self.next = np.arange(len(codes), dtype=np.int64) * self.room + 3

    def _move(self, value: np.ndarray, rng: np.ndarray, at: np.ndarray | None) -> None:
        short = np.flatnonzero(rng < 1 << 32)
        if len(short):
            some = short if at is None else at[short]
            place = self.next[some]
            value[short] = (value[short] << 16) | self.words[place]
            self.next[some] = place + 1
            rng[short] <<= 16

    def mixed(self, n: int) -> np.ndarray:
        """Where the next symbols of the first ``n`` rows lie, of 2**BITS; ``take_mixed`` comes next."""
        rng = self.range[:n]
        rng >>= BITS
        return quotient(self.value[:n], rng)

    def take_mixed(self, n: int, start: np.ndarray, width: np.ndarray) -> None:
        value, rng = self.value[:n], self.range[:n]
        value -= rng * start
        rng *= width
        self._move(value, rng, None)

    def place(self, at: np.ndarray, total) -> np.ndarray:
        """Where the next symbols of the rows ``at`` lie, of ``total``; ``take`` comes next."""
        self.step = quotient(self.range[at], total)
        self.here = self.value[at]
        return np.minimum(quotient(self.here, self.step), total - 1)

    def take(self, at: np.ndarray, start: np.ndarray, width) -> None:
        value, rng = self.here - self.step * start, self.step * width
        self._move(value, rng, at)
        self.value[at], self.range[at] = value, rng


    def take_bits(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Numbers of ``count`` bits."""
        rng, value = self.range[at] >> count, self.value[at]
        found = quotient(value, rng)
        value -= rng * found
        self._move(value, rng, at)
        self.value[at], self.range[at] = value, rng
        return found


class Mixer:
    """The predictions of many blocks and what they have learnt."""

    def __init__(self, rows: int, length: int):
        self.length = length
        self.base = np.arange(rows, dtype=np.int64)
        # an entry is 0, or four times the id plus one, and the confidence from 1 to 3
        self.next1 = np.zeros(rows * CONTEXTS, np.int32)
        self.next2 = np.zeros(rows * CONTEXTS, np.int32)
        self.contexts = self.base * CONTEXTS
        self.states = self.base * STATES
        self.chance2 = np.full(rows * STATES, 1 << 14, np.int32)
        self.chance1 = np.full(rows * STATES, 1 << 14, np.int32)
        self.hash1 = np.zeros(rows, np.int64)
        self.hash2 = np.zeros(rows, np.int64)
        # bounds of the classes, by their frequencies
        self.classes = np.tile(2 * np.arange(CLASSES + 1, dtype=np.int16), (rows, 1))
        self.ranked = np.zeros(rows * length, np.int32)
        self.met = np.zeros(rows, np.int64)

    def look(self, n: int) -> None:
        """Predictions for the next id of the first ``n`` blocks, and the bounds of the mix."""
        self.at1, self.at2 = self.contexts[:n] + self.hash1[:n], self.contexts[:n] + self.hash2[:n]
        e1, e2 = self.next1.take(self.at1), self.next2.take(self.at2)
        self.e1, self.e2 = e1, e2
        self.guess1, self.guess2 = (e1 >> 2) - 1, (e2 >> 2) - 1
        self.sure1, self.sure2 = e1 & 3, e2 & 3
        self.state = self.states[:n] + ((self.sure2 << 3) | (self.sure1 << 1) | (self.guess1 == self.guess2))
        self.p2, self.p1 = self.chance2.take(self.state), self.chance1.take(self.state)
        self.bound2 = ((self.p2 * ((1 << BITS) - 3)) >> 16) + 1
        self.bound1 = self.bound2 + (((((1 << BITS) - 2) - self.bound2) * self.p1) >> 16) + 1

    def bounds(self, second: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of what came true: order 2, order 1, or else order 0."""
        start = np.where(second, 0, np.where(first, self.bound2, self.bound1))
        stop = np.where(second, self.bound2, np.where(first, self.bound1, 1 << BITS))
        return start, stop - start

    def learn(self, n: int, ids: np.ndarray, second: np.ndarray, first: np.ndarray) -> None:
        self.chance2[self.state] = self.p2 + (((second << 16) - self.p2) >> RATE)
        self.chance1[self.state] = np.where(second, self.p1, self.p1 + (((first << 16) - self.p1) >> RATE))
        fresh = (ids << 2) + 5
        self.next2[self.at2] = np.where(second, self.e2 + (self.sure2 < 3), np.where(self.sure2 > 1, self.e2 - 1, fresh))
        self.next1[self.at1] = np.where(self.guess1 == ids, self.e1 + (self.sure1 < 3), np.where(self.sure1 > 1, self.e1 - 1, fresh))
        h = ids * np.int64(0x9E3779B1)
        self.hash2[:n] = ((self.hash1[:n] * 0x85EBCA6B + h) >> 11) & (CONTEXTS - 1)
        self.hash1[:n] = (h >> 15) & (CONTEXTS - 1)

    def class_bounds(self, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, width and total of a class, for the rows ``at``."""
        flat = at * (CLASSES + 1)
        bounds = self.classes.ravel()
        start = bounds.take(flat + kind).astype(np.int64)
        return start, bounds.take(flat + kind + 1) - start, bounds.take(flat + CLASSES)

    def find_class(self, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The class at a place among the frequencies."""
        return (self.classes.take(at, axis=0) <= place.astype(np.int16)[:, None]).sum(axis=1) - 1

    def learn_class(self, at: np.ndarray, kind: np.ndarray) -> None:
        self.classes[at] = self.classes.take(at, axis=0) + _ABOVE.take(kind, axis=0)

    def forget(self, t: int) -> None:
        """At every 64th id, older uses of the classes count half where there are many."""
        if t % 64 == 63:
            full = np.flatnonzero(self.classes[:, CLASSES] > 2000)
            sizes = np.diff(self.classes[full], axis=1)
            self.classes[full, 1:] = np.cumsum((sizes + 1) >> 1, axis=1)

    def forward(self, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Swap the ids at these ranks with those halfway to the front: the two places, and the id moved back."""
        here, there = at * self.length + rank, at * self.length + (rank >> 1)
        moved, back = self.ranked.take(here), self.ranked.take(there)
        self.ranked[here] = back
        self.ranked[there] = moved
        return here, there, back

    def add(self, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Ids met for the first time stand at the end of the list; their ranks."""
        rank = self.met[at]
        self.ranked[at * self.length + rank] = ids
        self.met[at] = rank + 1
        return rank


def _ordered(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks from the longest on, and how many still have an id at each step."""
    order = np.argsort(-lengths, kind="stable")
    return order, np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")


def encode_blocks(blocks: list[np.ndarray], ids: int) -> list[bytes]:
    """Frames of blocks of ids below ``ids``; a block holds at most LONGEST ids."""
    if not blocks:
        return []
    lengths = np.array([len(b) for b in blocks])
    if lengths.max() > LONGEST:
        raise ValueError("block too long")
    if any(len(b) and int(b.max()) >= ids for b in blocks):
        raise ValueError("id out of range")
    order, active = _ordered(lengths)
    rows, length = len(blocks), int(lengths.max())
    # a block's different ids are numbered, so that the rank of each fits a small table
    table, local = np.zeros((length, rows), np.int32), np.zeros((length, rows), np.int32)
    for column, k in enumerate(order):
        table[:lengths[k], column] = blocks[k]
        local[:lengths[k], column] = np.unique(blocks[k], return_inverse=True)[1]
    ranks = np.full(rows * length, -1, np.int16)
    # the number of the id at each rank
    numbers = np.zeros(rows * length, np.int16)
    mixer, coder = Mixer(rows, length), RangeEncoder(rows, length * 3 + 8)
    for t in range(length):
        n = int(active[t])
        now = table[t, :n]
        mixer.look(n)
        second = now == mixer.guess2
        first = (now == mixer.guess1) & ~second
        coder.mixed(n, *mixer.bounds(second, first))
        at = np.flatnonzero(~(second | first))
        if len(at):
            number = local[t].take(at)
            places = at * length + number
            rank = ranks.take(places).astype(np.int64)
            kind = _CLASS.take(rank)
            kind[rank < 0] = NEW
            start, width, total = mixer.class_bounds(at, kind)
            coder.code(at, start, width, total)
            mixer.learn_class(at, kind)
            fresh = np.flatnonzero(kind == NEW)
            if len(fresh):
                novel = at[fresh]
                coder.code(novel, now[novel].astype(np.int64), _ONE, ids)
                end = mixer.add(novel, now[novel])
                ranks[places[fresh]] = end
                numbers[novel * length + end] = number[fresh]
            deep = np.flatnonzero((kind > 0) & (kind < NEW))
            if len(deep):
                known, rank, kind = at[deep], rank[deep], kind[deep]
                coder.bits(known, rank + 1 - (_ONE << kind), kind)
                here, there, _ = mixer.forward(known, rank)
                back = numbers.take(there)
                numbers[here], numbers[there] = back, number[deep]
                ranks[known * length + back] = rank
                ranks[places[deep]] = rank >> 1
        mixer.learn(n, now, second, first)
        mixer.forget(t)
    frames: list[bytes] = [b""] * rows
    for k, code in zip(order, coder.finish()):
        raw = blocks[k].astype("<u4").tobytes()
        frames[k] = _HEADER.pack(lengths[k], len(code), zlib.crc32(raw), zlib.crc32(code)) + code
    return frames


def decode_blocks(frames: list[tuple[int, int, int, bytes]], ids: int) -> list[np.ndarray]:
    """The ids of frames as ``split_frames`` gives them. A checksum that does not fit is an error."""
    if not frames:
        return []
    for _, _, code_crc, code in frames:
        if zlib.crc32(code) != code_crc:
            raise ValueError("a block's code is damaged")
    lengths = np.array([f[0] for f in frames])
    order, active = _ordered(lengths)
    rows, length = len(frames), int(lengths.max())
    table = np.zeros((length, rows), np.int32)
    mixer, coder = Mixer(rows, length), RangeDecoder([frames[k][3] for k in order])
    for t in range(length):
        n = int(active[t])
        mixer.look(n)
        place = coder.mixed(n)
        second = place < mixer.bound2
        first = (place < mixer.bound1) & ~second
        coder.take_mixed(n, *mixer.bounds(second, first))
        now = np.where(second, mixer.guess2, mixer.guess1)
        at = np.flatnonzero(~(second | first))
        if len(at):
            kind = mixer.find_class(at, coder.place(at, mixer.classes.ravel().take(at * (CLASSES + 1) + CLASSES)))
            start, width, total = mixer.class_bounds(at, kind)
            coder.take(at, start, width)
            mixer.learn_class(at, kind)
            now[at] = mixer.ranked.take(at * length)
            fresh = np.flatnonzero(kind == NEW)
            if len(fresh):
                novel = at[fresh]
                found = coder.place(novel, ids)
                coder.take(novel, found, _ONE)
                now[novel] = found
                mixer.add(novel, found)
            deep = np.flatnonzero((kind > 0) & (kind < NEW))
            if len(deep):
                known, kind = at[deep], kind[deep]
                rank = coder.take_bits(known, kind) + (_ONE << kind) - 1
                _, there, _ = mixer.forward(known, rank)
                now[known] = mixer.ranked.take(there)
        mixer.learn(n, now, second, first)
        mixer.forget(t)
        table[t, :n] = now
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * rows
    for column, k in enumerate(order):
        found = table[:lengths[k], column].astype("<u4")
        if zlib.crc32(found.tobytes()) != frames[k][1]:
            raise ValueError("a block's ids do not fit its checksum")
        out[k] = found
    return out


def split_frames(payload: bytes) -> list[tuple[int, int, int, bytes]]:
    """Number of ids, crc32 of the ids, crc32 of the code, and code of each frame."""
    frames, at = [], 0
    while at < len(payload):
        n, size, ids_crc, code_crc = _HEADER.unpack_from(payload, at)
        at += _HEADER.size
        frames.append((n, ids_crc, code_crc, payload[at:at + size]))
        at += size
    return frames
