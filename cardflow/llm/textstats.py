"""Vectorised word hashing of whole texts.

Words are the runs of bytes other than space and 0x09-0x0D. Each word gets a 64-bit multilinear
hash; texts are handled in slabs of half a MB, so memory stays bounded for any text length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SLAB = 1 << 19
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hash_slab(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word start offsets) of one slab that begins and ends at word boundaries."""
    buf = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[buf]
    if space.all():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(before & ~space)
    after = np.empty_like(space)
    after[-1], after[:-1] = True, space[1:]
    ends = np.flatnonzero(after & ~space) + 1
    values = _BYTE[buf]
    values[space] = 0
    place = np.arange(len(buf)) - np.repeat(starts, np.diff(np.append(starts, len(buf)))) if starts[0] == 0 else \
        np.concatenate([np.zeros(starts[0], np.int64),
                        np.arange(starts[0], len(buf)) - np.repeat(starts, np.diff(np.append(starts, len(buf))))])
    values *= _PLACE[place & 0xFFFF]
    if len(buf) > len(_PLACE):  # beyond the table of places its blocks are told apart by a factor of their own
        far = np.flatnonzero(place >= len(_PLACE))
        values[far] *= mix64((place[far] >> 16).astype(np.uint64)) | np.uint64(1)
    sums = np.add.reduceat(values, starts)
    return mix64(sums + (ends - starts).astype(np.uint64) * _MIX[0]), starts


def _parts(data: bytes) -> Iterator[bytes]:
    """Pieces of at most about SLAB bytes, cut after a space; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = min(len(data), at + SLAB)
        while end < len(data) and not _SPACE[data[end - 1]]:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    """One array of word hashes for each text, in order."""
    held: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        hashes, starts = _hash_slab(b"\n".join(held))
        at = np.cumsum([0, *(len(x) + 1 for x in held)])
        cuts = np.searchsorted(starts, at)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield hashes[a:b]

    for text in texts:
        if held and size + len(text) > SLAB:
            yield from flush()
            held, size = [], 0
        if len(text) > SLAB:
            yield np.concatenate([_hash_slab(p)[0] for p in _parts(text)])
            continue
        held.append(text)
        size += len(text) + 1
    if held:
        yield from flush()


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; empty when there are fewer."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n] * _MIX[1]
    for j in range(1, width):
        total += words[j:n + j] * _MIX[1 + j]
        total = (total << np.uint64(7)) | (total >> np.uint64(57))
    return mix64(total)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles; a shorter text's whole word sequence counts as one."""
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < width:
        return windows(words, len(words)) ^ np.uint64(0x9E3779B97F4A7C15)
    return np.unique(windows(words, width))


def utf8(texts: Sequence[str | None]) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
