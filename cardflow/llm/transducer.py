"""A table-driven byte transducer over UTF-8 texts, and a verified hash table of word spans.

The machine reads classes of bytes (``CLASS``) and has two states, between words and within one. Its
next state (``NEXT``) depends on the class just read alone, so the states before all bytes of a slab
are ``NEXT`` of their classes, shifted by one, and a whole slab takes one vectorised step:
``EMIT[state, class]`` holds the bits that a byte emits (a word starts, a code point starts, a
capital, a symbol). No pattern is matched and no text is decoded.

Words are told apart by a hash table with open addressing over spans of the slab: a span is inserted
by its hash, and a slot's owner is compared with it by document, length and bytes. Equal hashes
of different words only cost another probe.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

SLAB = 1 << 19
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SYMBOLS = b"#$%&*|"
# classes of bytes
_SPACE, _PLAIN, _CAPITAL, _SYMBOL, _LATER = range(5)
# states: between words, within a word
_OUT, _IN = 0, 1
# bits that a byte emits
WORD, POINT, CAPITAL, SYMBOL = 1, 2, 4, 8

CLASS = np.full(256, _PLAIN, dtype=np.uint8)
CLASS[list(_SPACES)] = _SPACE
CLASS[ord("A"):ord("Z") + 1] = _CAPITAL
CLASS[list(SYMBOLS)] = _SYMBOL
CLASS[0x80:0xC0] = _LATER  # continuation bytes of a code point
#: The state after a byte of each class.
NEXT = np.array([_OUT, _IN, _IN, _IN, _IN], dtype=np.uint8)
#: What a byte of each class emits, read between words and within one.
EMIT = np.array([[POINT, WORD | POINT, WORD | POINT | CAPITAL, WORD | POINT | SYMBOL, WORD],
                 [POINT, POINT, POINT | CAPITAL, POINT | SYMBOL, 0]], dtype=np.uint8)

_rng = np.random.default_rng(77001)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd: it has an inverse modulo 2^64


def _powers(step: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, step, np.uint64)]), dtype=np.uint64)


_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))
_UP, _DOWN = _powers(_STEP, SLAB + 1), _powers(_INVERSE, SLAB + 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def transduce(buf: np.ndarray, before: int = _OUT) -> np.ndarray:
    """The bits emitted by every byte of a slab read in state ``before``."""
    kind = CLASS[buf]
    state = np.empty_like(kind)
    state[:1] = before
    state[1:] = NEXT[kind[:-1]]
    return EMIT[state, kind]


class SpanTable:
    """Distinct (owner, word) spans of a byte buffer, by open addressing with verified slots."""

    def __init__(self, buf: np.ndarray, room: int):
        self.buf = buf
        self.start = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.owner = np.empty(0, np.int64)
        self.hash = np.empty(0, np.uint64)
        self.slots = np.full(1 << max(4, (2 * room - 1).bit_length()), -1, np.int64)

    def _same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the spans ``a`` and ``b`` (places in the lists) hold the same word of the same owner."""
        same = (self.owner[a] == self.owner[b]) & (self.size[a] == self.size[b]) & (self.hash[a] == self.hash[b])
        left = np.flatnonzero(same)
        for k in range(0, len(left), 1 << 14):
            part = left[k:k + (1 << 14)]
            n = self.size[a[part]]
            if not len(part):
                continue
            ends = np.cumsum(n)
            inner = np.arange(int(ends[-1])) - np.repeat(ends - n, n)
            equal = self.buf[np.repeat(self.start[a[part]], n) + inner] == self.buf[np.repeat(self.start[b[part]], n) + inner]
            same[part] = np.logical_and.reduceat(equal, ends - n)
        return same

    def _place(self, new: np.ndarray) -> np.ndarray:
        """Insert the spans ``new``; True for those that are the first of their word."""
        mask = np.uint64(len(self.slots) - 1)
        first = np.zeros(len(new), dtype=bool)
        left, at = np.arange(len(new)), self.hash[new] & mask
        while len(left):
            place = at.astype(np.int64)
            held = self.slots[place]
            empty = np.flatnonzero(held < 0)
            self.slots[place[empty][::-1]] = new[left[empty]][::-1]  # the earliest of a slot's claims stands
            held = self.slots[place]
            own = held == new[left]
            first[left[own]] = True
            rest = np.flatnonzero(~own)
            rest = rest[~self._same(new[left[rest]], held[rest])]
            left, at = left[rest], (at[rest] + np.uint64(1)) & mask
        return first

    def add(self, start: np.ndarray, size: np.ndarray, owner: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Insert spans; True for each that is the first of its word and owner. Spans of words that
        are in the table already are not kept."""
        known = len(self.start)
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        self.owner, self.hash = np.concatenate([self.owner, owner]), np.concatenate([self.hash, value])
        if 2 * len(self.start) > len(self.slots):
            self.slots = np.full(1 << (4 * len(self.start)).bit_length(), -1, np.int64)
            self._place(np.arange(known))
        first = self._place(np.arange(known, len(self.start)))
        keep = np.concatenate([np.arange(known), known + np.flatnonzero(first)])
        moved = np.full(len(self.start) + 1, -1, np.int64)
        moved[keep] = np.arange(len(keep))
        self.slots = moved[self.slots]  # -1 reads the last, which is -1
        self.start, self.size, self.owner, self.hash = (x[keep] for x in (self.start, self.size, self.owner, self.hash))
        return first


def _spans(buf: np.ndarray, bits: np.ndarray, owner_of: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, sizes, owners, hashes) of the words of a slab that holds whole words."""
    start = np.flatnonzero(bits & WORD)
    space = CLASS[buf] == _SPACE
    edge = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    end = edge if len(edge) == len(start) else np.append(edge, len(buf))
    up, down = (_UP, _DOWN) if len(buf) <= SLAB else (_powers(_STEP, len(buf) + 1), _powers(_INVERSE, len(buf) + 1))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[buf] * up[:len(buf)], dtype=np.uint64)])
    value = (sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)
    owner = owner_of[start]
    return start, end - start, owner, _mixed(value + owner.astype(np.uint64) * _STEP)


def _cuts(data: bytes) -> Iterator[tuple[int, int]]:
    """Slabs of a long text, cut after a space; a longer word stays whole."""
    buf = np.frombuffer(data, dtype=np.uint8)
    at = 0
    while at < len(data):
        end = min(len(data), at + SLAB)
        while end < len(data) and CLASS[buf[end - 1]] != _SPACE:
            near = np.flatnonzero(CLASS[buf[end:end + SLAB]] == _SPACE)
            end = min(len(data), end + SLAB) if not len(near) else end + int(near[0]) + 1
        yield at, end
        at = end


def _one(data: bytes, distinct: bool) -> tuple[int, int, int, int, int]:
    """The counts of one text, slab by slab, over one table of its words."""
    whole = np.frombuffer(data, dtype=np.uint8)
    table = SpanTable(whole, 1024)
    total = np.zeros(5, np.int64)
    for a, b in _cuts(data):
        buf = whole[a:b]
        bits = transduce(buf)
        found = [np.count_nonzero(bits & bit) for bit in (WORD, POINT, CAPITAL, SYMBOL)]
        new = 0
        if distinct and found[0]:
            start, size, owner, value = _spans(buf, bits, np.zeros(len(buf), np.int64))
            new = int(table.add(start + a, size, owner, value).sum())
        total += [found[0], new, *found[1:]]
    return tuple(total.tolist())


def _several(texts: list[bytes], distinct: bool) -> np.ndarray:
    """The counts of texts that together make one slab."""
    n = len(texts)
    data = b"\n".join(texts) + b"\n"
    buf = np.frombuffer(data, dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    bits = transduce(buf)
    counts = np.zeros((n, 5), np.int64)
    for column, bit in ((0, WORD), (2, POINT), (3, CAPITAL), (4, SYMBOL)):
        seen = np.concatenate([[0], np.cumsum((bits & bit) > 0)])
        counts[:, column] = seen[ends] - seen[ends - sizes]
    counts[:, 2] -= 1  # the line end after each text
    if distinct and counts[:, 0].any():
        start, size, owner, value = _spans(buf, bits, np.repeat(np.arange(n), sizes))
        first = SpanTable(buf, len(start)).add(start, size, owner, value)
        counts[:, 1] = np.bincount(owner[first], minlength=n)
    return counts


def text_counts(texts: Sequence[bytes], distinct: bool = True) -> np.ndarray:
    """One row a text: words, distinct words, code points, capitals, symbols (0 distinct words if not asked).

    Beside the texts, memory is bounded by a slab (or one word, if that is longer) and the distinct
    words of one text.
    """
    out: list[np.ndarray] = []
    held: list[bytes] = []
    room = 0

    def flush() -> None:
        nonlocal room
        if held:
            out.append(_several(held, distinct))
        held.clear()
        room = 0

    for t in texts:
        if len(t) >= SLAB:
            flush()
            out.append(np.array([_one(t, distinct)], dtype=np.int64))
            continue
        if room + len(t) + 1 > SLAB:
            flush()
        held.append(t)
        room += len(t) + 1
    flush()
    return np.concatenate(out) if out else np.zeros((0, 5), np.int64)


def digests(texts: Sequence[bytes]) -> list[bytes]:
    return [hashlib.sha256(t).digest() for t in texts]
