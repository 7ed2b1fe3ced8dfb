"""Deterministic machines run over many stretches of text at once, composed by a prefix scan.

A machine has a state, reads a letter, goes to the next state and emits a number. Texts are cut into
chunks of LANE letters, and all chunks are read in step by array look-ups. What state a chunk begins in is
not known before what stands in front of it is read, so a chunk is first read from the start state, and
then again from the state its forerunner ended in, only as far as the two readings differ: once their states
agree, the rest is the same. That gives each chunk a map of (state before it) to (state behind it, emitted
sum). Maps of neighbours compose, associatively, and are composed pair by pair as a tree.

A map knows two states only. Where a text's tree asks for a third (two readings that never came to agree,
as in an endless run of one letter), that text's maps are composed from left to right instead, and each
missing entry is read once for equal chunks. So the sums never depend on how a text was cut.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Letters of a chunk.
LANE = 512
#: Letters that are held in chunks at once; a longer text is read in parts, each from where the last one ended.
BLOCK = 4_000_000

Step = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

_EMPTY = np.int64(-1)


class Table:
    """A hash table from non-negative 64-bit keys to 64-bit values, looked up by arrays."""

    def __init__(self, room: int = 1 << 10) -> None:
        self.size = 0
        self._clear(room)

    def _clear(self, room: int) -> None:
        self.bits = max(10, int(room - 1).bit_length())
        self.keys = np.full(1 << self.bits, _EMPTY)
        self.values = np.full(1 << self.bits, -1, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for keys that are not held."""
        slots = self._slots(keys)
        found = self.keys[slots]
        out = self.values[slots]
        other = np.flatnonzero(found != keys)
        if other.size:
            out[other] = -1
            left = other[found[other] != _EMPTY]
            while left.size:
                slots[left] = (slots[left] + 1) & (len(self.keys) - 1)
                found = self.keys[slots[left]]
                hit = found == keys[left]
                out[left[hit]] = self.values[slots[left[hit]]]
                left = left[~hit & (found != _EMPTY)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that are not held yet."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            held = self.keys != _EMPTY
            old = self.keys[held], self.values[held]
            self._clear(4 * (self.size + len(keys)))
            self.size = 0
            self.put(*old)
        self.size += len(keys)
        slots = self._slots(keys)
        left = np.arange(len(keys))
        while left.size:
            free = left[self.keys[slots[left]] == _EMPTY]
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots[left]] == keys[left]
            self.values[slots[left[placed]]] = values[left[placed]]
            left = left[~placed]
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)

    @property
    def nbytes(self) -> int:
        return self.keys.nbytes + self.values.nbytes


class Dense:
    """The same by plain indexing, for keys from 0 up to ``room``."""

    def __init__(self, room: int, keys: np.ndarray, values: np.ndarray) -> None:
        self.values = np.full(room, -1, np.int32)
        self.values[keys] = values

    def get(self, keys: np.ndarray) -> np.ndarray:
        return self.values[keys].astype(np.int64)

    @property
    def nbytes(self) -> int:
        return self.values.nbytes


def run(step: Step, letters: np.ndarray, sizes: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """What the machine emits for each text in all, and the state it ends in.

    ``letters`` holds the texts end to end, ``sizes`` their lengths. ``step`` takes arrays of states and
    letters to arrays of the next states and what they emit.
    """
    totals, finals = np.zeros(len(sizes), np.int64), np.full(len(sizes), start, np.int64)
    ends = np.cumsum(sizes)
    k = 0
    while k < len(sizes):
        begin = int(ends[k] - sizes[k])
        last = max(k + 1, int(np.searchsorted(ends, begin + BLOCK, "right")))
        for at in range(begin, int(ends[last - 1]), BLOCK) if last == k + 1 else [begin]:
            part = np.minimum(ends[k:last], at + BLOCK) - np.maximum(ends[k:last] - sizes[k:last], at)
            sums, finals[k:last] = _block(step, letters[at : at + int(part.sum())], part, finals[k:last], start)
            totals[k:last] += sums
        k = last
    return totals, finals


def _block(step: Step, letters: np.ndarray, sizes: np.ndarray, firsts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """``run`` of texts whose chunks fit; ``firsts`` are the states they begin in."""
    chunks = -(-sizes // LANE)
    text = np.repeat(np.arange(len(sizes)), chunks)
    number = np.arange(len(text)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begins = np.repeat(np.cumsum(sizes) - sizes, chunks) + number * LANE
    lengths = np.minimum(LANE, np.repeat(sizes, chunks) - number * LANE)
    totals, finals = np.zeros(len(sizes), np.int64), firsts.copy()
    if not len(text):
        return totals, finals
    first = np.where(number == 0, firsts[text], start)
    # Chunks by falling length, so that those still being read are always the first ones.
    order = np.argsort(-lengths, kind="stable")
    begins_o, lengths_o, state = begins[order], lengths[order], first[order]
    live = np.searchsorted(-lengths_o, -np.arange(1, LANE + 1), "right")
    passed = np.zeros((LANE, len(order)), np.int32)
    emitted = np.zeros((LANE, len(order)), np.int16)
    for t in range(int(lengths_o[0])):
        n = live[t]
        follow, said = step(state[:n], letters[begins_o[:n] + t])
        state[:n] = passed[t, :n] = follow
        emitted[t, :n] = said
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    sums = emitted.sum(axis=0, dtype=np.int64)
    maps = _Maps(first, state[place], sums[place])
    _read_again(step, maps, letters, begins, lengths, number, passed, emitted, place)
    finals_of, sums_of, odd = _scan(maps, text, len(sizes))
    has = chunks > 0
    finals[has], totals[has] = finals_of[has], sums_of[has]
    for k in np.flatnonzero(odd).tolist():
        lanes = np.flatnonzero(text == k)
        finals[k], totals[k] = _in_order(step, maps, lanes, letters, begins, lengths, passed, emitted, place)
    return totals, finals


class _Maps:
    """Of each chunk two states before it, the states behind it and the sums: columns 0 and 1."""

    def __init__(self, before: np.ndarray, behind: np.ndarray, sums: np.ndarray) -> None:
        self.before, self.behind, self.sums = (np.stack([x, x], axis=1) for x in (before, behind, sums))


def _read_again(step, maps: _Maps, letters, begins, lengths, number, passed, emitted, place) -> None:
    """Fills column 1: each chunk read from where its forerunner ends, as far as that differs."""
    lanes = np.flatnonzero(number > 0)
    state = maps.behind[lanes - 1, 0]
    differs = state != maps.before[lanes, 0]
    lanes, state = lanes[differs], state[differs]
    maps.before[lanes, 1] = state
    change = np.zeros(len(lanes), np.int64)
    t = 0
    while lanes.size:
        over = lengths[lanes] <= t
        if over.any():
            done = lanes[over]
            maps.behind[done, 1], maps.sums[done, 1] = state[over], maps.sums[done, 0] + change[over]
            lanes, state, change = lanes[~over], state[~over], change[~over]
            continue
        state, said = step(state, letters[begins[lanes] + t])
        change = change + said - emitted[t, place[lanes]]
        same = state == passed[t, place[lanes]]
        if same.any():
            done = lanes[same]
            maps.sums[done, 1] = maps.sums[done, 0] + change[same]
            lanes, state, change = lanes[~same], state[~same], change[~same]
        t += 1


def _scan(maps: _Maps, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State behind and sum of each text by composing neighbours as a tree; texts it cannot do are odd."""
    before, behind, sums, owner = maps.before, maps.behind, maps.sums, text
    odd = np.zeros(n_texts, bool)
    while len(owner) > 1 and (owner[1:] == owner[:-1]).any():
        head = np.r_[True, owner[1:] != owner[:-1]]
        at = np.arange(len(owner))
        place = at - np.maximum.accumulate(np.where(head, at, 0))
        left = np.flatnonzero((place % 2 == 0) & np.r_[owner[1:] == owner[:-1], False])
        right = left + 1
        met = behind[left][:, :, None] == before[right][:, None, :]
        column = np.where(met[:, :, 0], 0, 1)
        # The first column alone is asked of a text's first chunk, both of the others.
        known = met.any(axis=2)
        asked = known[:, 0] & (known[:, 1] | (place[left] == 0))
        odd[owner[left[~asked]]] = True
        rows = right[:, None]
        behind, sums = behind.copy(), sums.copy()
        sums[left] += sums[rows, column]
        behind[left] = behind[rows, column]
        stay = place % 2 == 0
        before, behind, sums, owner = before[stay], behind[stay], sums[stay], owner[stay]
    finals, totals = np.zeros(n_texts, np.int64), np.zeros(n_texts, np.int64)
    finals[owner], totals[owner] = behind[:, 0], sums[:, 0]
    return finals, totals, odd


def _in_order(step, maps: _Maps, lanes, letters, begins, lengths, passed, emitted, place) -> tuple[int, int]:
    """State behind and sum of one text, chunk after chunk; equal chunks from equal states are read once."""
    state, total = int(maps.before[lanes[0], 0]), 0
    known: dict[tuple[bytes, int], tuple[int, int]] = {}
    for lane in lanes.tolist():
        for j in (0, 1):
            if maps.before[lane, j] == state:
                state, said = int(maps.behind[lane, j]), int(maps.sums[lane, j])
                break
        else:
            own = letters[begins[lane] : begins[lane] + lengths[lane]]
            key = (own.tobytes(), state)
            if key not in known:
                known[key] = _read_from(step, state, own, passed[:, place[lane]], emitted[:, place[lane]], int(maps.behind[lane, 0]), int(maps.sums[lane, 0]))
            state, said = known[key]
        total += said
    return state, total


def _read_from(step, state: int, own, passed, emitted, behind: int, total: int) -> tuple[int, int]:
    for t in range(len(own)):
        follow, said = step(np.array([state]), own[t : t + 1])
        state, total = int(follow[0]), total + int(said[0]) - int(emitted[t])
        if state == passed[t]:
            return behind, total
    return state, total
