"""Token ids of whole texts with the tokenizers library, one encoding for each distinct chunk.

A chunk begins with a space or line end, or with a comma or full stop after a letter, and goes on to
the next such place. The byte-level pre-tokenizer never puts a character other than white space and a
white-space character after it into one token, nor a letter and a punctuation mark after it, so the
ids of a text are the ids of its chunks in order. Chunks repeat, so each distinct one of a slice is
looked up once and the ids are gathered with numpy. A text with a chunk of white space alone, or
with other white space than spaces and line ends, is encoded at once instead. The cache of a
worker process has a fixed size: two halves, the older dropped when the newer is full.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space and format characters other than spaces and line ends, and the cut mark itself.
_ODD = (0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028,
        0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)
_ODD_CLASS = "[" + "".join(map(chr, _ODD)) + "]"
_UNSAFE = re.compile(_ODD_CLASS + r"|^[ \n]+\Z")
_CUT = "\x1f"
#: Chunks in each half of a worker's cache.
CACHE_CHUNKS = 400_000
LONG_CHUNK = 48
SLICE_BYTES = 12_000_000
RUN_CHUNKS = 4000


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Parts of a text column of about ``size`` bytes; a longer text is a part of its own."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        begin = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, begin + size, side="right")))
        yield column.slice(at, end - at)
        at = end


def gather(codes: Sequence[bytes], where: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of texts from the ids (bytes) of distinct chunks, the chunk of each place and
    the places at which texts end."""
    pool = np.frombuffer(b"".join(codes), "<u4")
    sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
    starts = np.cumsum(sizes) - sizes
    counts = sizes[where]
    stops = np.cumsum(counts)
    ids = pool[np.repeat(starts[where] - (stops - counts), counts) + np.arange(stops[-1] if len(stops) else 0)]
    return ids, np.concatenate([[0], stops])[ends]


class ChunkEncoder:
    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS, slice_bytes: int = SLICE_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.cache_chunks, self.slice_bytes = cache_chunks, slice_bytes
        self.cache: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        # a byte-level token has one character for each byte
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, k in vocabulary.items():
            self.token_bytes[k] = len(token)

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _ids(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        """(chunk, ids). Chunks that begin with a space are encoded many at a time, as a running
        text, and its ids are cut at their ends, told by the tokens' lengths in bytes."""
        spaced = [c for c in chunks if c[0] == " "]
        other = [c for c in chunks if c[0] != " "]
        groups = [spaced[k:k + RUN_CHUNKS] for k in range(0, len(spaced), RUN_CHUNKS)]
        for group in groups:  # one at a time: the library's objects take a hundred bytes a token
            (found,) = self.tokenizer.encode_batch_fast(["".join(group)], add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4")
            ends = np.cumsum(self.token_bytes[ids])
            wanted = np.cumsum([len(c.encode()) for c in group])
            at = np.searchsorted(ends, wanted)
            if not np.array_equal(ends[at], wanted):
                other.extend(group)
                continue
            data, cuts = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
            yield from zip(group, [data[a:b] for a, b in zip(cuts, cuts[1:])])
        yield from zip(other, self._whole(other))

    def encode(self, texts: Sequence[str] | pa.Array) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null is an empty text."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = pc.fill_null(column.cast(pa.large_string()), "")
        for part in slices(column, self.slice_bytes):
            yield from self._encode_slice(part)
        pa.default_memory_pool().release_unused()

    def _encode_slice(self, texts: pa.Array) -> Iterator[bytes]:
        column = texts
        odd = pc.match_substring_regex(column, _ODD_CLASS).to_numpy(zero_copy_only=False)
        column = pc.replace_substring(column, " ", _CUT + " ")
        column = pc.replace_substring(column, "\n", _CUT + "\n")
        column = pc.replace_substring_regex(column, r"(\pL)([,.])", r"\1" + _CUT + r"\2")
        parts = pc.split_pattern(column, _CUT)
        coded = pc.dictionary_encode(parts.flatten())
        where = coded.indices.to_numpy()
        chunks = coded.dictionary.to_pylist()
        ends = np.asarray(parts.offsets)

        cache, older = self.cache, self.older
        codes = [cache.get(c) for c in chunks]
        unsafe: set[str] = set()
        missing: dict[str, bytes] = {}
        unknown = []
        for c, found in zip(chunks, codes):
            if found is None:
                if c in older:
                    missing[c] = older[c]
                elif _UNSAFE.search(c):
                    unsafe.add(c)
                else:
                    unknown.append(c)
        missing.update(self._ids(unknown))
        codes = [missing.get(c, b"") if x is None else x for c, x in zip(chunks, codes)]
        if len(cache) + len(missing) > self.cache_chunks:  # what is in use moves on from the older half
            self.older, self.cache = cache, {"": b""}
        self.cache.update((c, x) for c, x in missing.items() if len(c) <= LONG_CHUNK)
        if unsafe:
            bad = np.fromiter((c in unsafe for c in chunks), bool, len(chunks))
            odd |= np.add.reduceat(np.append(bad[where], False), ends[:-1]) * (np.diff(ends) > 0) > 0
        ids, bounds = gather(codes, where, ends)
        data = memoryview(ids.tobytes())
        for k in range(len(texts)):
            yield self._whole([texts[k].as_py()])[0] if odd[k] else bytes(data[4 * bounds[k]:4 * bounds[k + 1]])


_encoders: dict[tuple[str, int, int], ChunkEncoder] = {}


def encoder(path: str, cache_chunks: int = CACHE_CHUNKS, slice_bytes: int = SLICE_BYTES) -> ChunkEncoder:
    """The worker process's encoder for a vocabulary file; its cache outlives a task. The text of
    ``slice_bytes`` that is encoded at a time takes some thirty times its size in memory."""
    key = (path, cache_chunks, slice_bytes)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(*key)
    return _encoders[key]
