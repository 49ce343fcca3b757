"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces of a vocabulary file, spelled in UTF-8 bytes with a space for the white-space marker, form
a trie stored in two arrays: the child of state s by byte c is ``base[s] + c`` if ``check`` of that
place is s. The best segmentation maximises the sum of the pieces' log scores. A character that no
piece spells alone may be taken as its UTF-8 bytes (byte pieces) at a penalty below every score.
A marker is put before the text; decoding joins the pieces' bytes, turns markers into spaces and
takes the first one off, so every text comes back as it was (the marker character itself is
encoded by its bytes).

No piece goes on with a marker after another character or holds a line end (checked on loading), so
texts fall apart into chunks that are segmented for themselves. The distinct chunks of a slice are
segmented side by side, with one numpy step for each start and length, very long ones each for itself
byte by byte, in time and memory proportional to their length; a worker process keeps a bounded number of results.

Files whose scores are merge ranks (BPE) get log scores of the ranks by Zipf's law, ``-log(rank +
2.7)`` up to a constant.

A null text is an empty one and gives no ids. Repeated rows get equal results.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import ship_code
from cardflow.llm.tokens import gather

MARKER = "▁"
_CUT = "\x1f"
_CHUNK = re.compile(r"\n| *[^ \n]+| +")
CACHE_CHUNKS = 300_000
LONG_CHUNK = 48
#: Bytes from which a chunk is segmented for itself: side by side there are few to share a numpy step.
ALONE_BYTES = 512
SLICE_CHARS = 8_000_000
GROUP_BYTES = 1 << 21
UNKNOWN_PENALTY = 10.0


class DoubleArray:
    """A trie of byte strings in the arrays ``base``, ``check`` and ``value`` (-1: no key)."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys.items():
            at = 0
            for byte in key:
                if byte not in children[at]:
                    children[at][byte] = len(children)
                    children.append({})
                    values.append(-1)
                at = children[at][byte]
            values[at] = value
        size = 2 * len(children) + 1024
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = bytearray(size)
        taken[0] = 1
        value[0] = values[0]
        place, queue, free = {0: 0}, [0], 1
        begin: dict[int, int] = {}  # where nodes of so many children last found room after a long search
        for node in queue:
            if not children[node]:
                continue
            wanted = sorted(children[node])
            while taken[free]:
                free += 1
            slot = max(free, begin.get(len(wanted), free))
            tried = 0
            while True:
                start = slot - wanted[0]
                if start >= 1 and not taken[slot] and not any(
                        start + c < len(taken) and taken[start + c] for c in wanted):
                    break
                slot += 1
                tried += 1
            if tried > 64:
                begin[len(wanted)] = slot
            if start + 256 >= size:
                grow = max(size, start + 512 - size)
                base, check, value = (np.concatenate([x, np.full(grow, fill, np.int32)])
                                      for x, fill in ((base, 0), (check, -1), (value, -1)))
                taken.extend(bytes(grow))
                size += grow
            base[place[node]] = start
            for c in wanted:
                child = children[node][c]
                taken[start + c] = 1
                check[start + c] = place[node]
                value[start + c] = values[child]
                place[child] = start + c
                queue.append(child)
        end = int(np.flatnonzero(np.frombuffer(bytes(taken), np.uint8))[-1]) + 257
        pad = max(0, end - size)
        self.base = np.concatenate([base, np.zeros(pad, np.int32)])[:end]
        self.check = np.concatenate([check, np.full(pad, -1, np.int32)])[:end]
        self.value = np.concatenate([value, np.full(pad, -1, np.int32)])[:end]
        self.depth = max(map(len, keys), default=0)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child states by a byte each; -1 where there is none."""
        to = self.base[state] + byte
        return np.where((self.check[to] == state) & (to != 0), to, -1)


class Unigram:
    """Pieces with log scores: encoding, decoding."""

    def __init__(self, pieces: Sequence[tuple[int, str, float]], byte_ids: Sequence[int]):
        """``pieces``: (id, piece with markers, log score); ``byte_ids``: the ids of the 256 bytes."""
        keys, self.scores = {}, {}
        for k, piece, score in pieces:
            spelled = piece.replace(MARKER, " ")
            if re.search(r"[^ ] |\n", spelled):
                raise ValueError(f"piece {piece!r} goes on with a marker or holds a line end")
            keys[spelled.encode()] = k
            self.scores[k] = score
        self.trie = DoubleArray(keys)
        self.score = np.zeros(max([*self.scores, *byte_ids]) + 1)
        for k, score in self.scores.items():
            self.score[k] = score
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.byte_ids = np.array(byte_ids, dtype=np.uint32)
        self.is_byte = np.zeros(len(self.score), dtype=bool)
        self.is_byte[self.byte_ids] = True
        self.spelled = [b""] * len(self.score)
        for key, k in keys.items():
            self.spelled[k] = key
        for byte, k in enumerate(byte_ids):
            self.spelled[k] = bytes([byte])
        self.cache: dict[str, tuple[bytes, float]] = {"": (b"", 0.0)}
        self.plain = [x.tolist() for x in (self.trie.base, self.trie.check, self.trie.value, self.score)]

    @classmethod
    def load(cls, path: str) -> Unigram:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        own = [k for k in range(model.get_piece_size()) if not (
            model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
        scores = np.array([model.get_score(k) for k in own])
        if len(own) and np.array_equal(scores, np.round(scores)):  # merge ranks
            total = sum(1 / (r - scores.max() + 2.7) for r in -scores + 2 * scores.max())
            scores = -np.log(-(scores - scores.max()) + 2.7) - math.log(total)
        return cls([(k, model.id_to_piece(k), float(s)) for k, s in zip(own, scores)], byte_ids)

    def segment(self, chunks: Sequence[str]) -> list[tuple[bytes, float]]:
        """(ids, log score) of each chunk, ids as little-endian unsigned 32-bit integers."""
        data = [c.encode("utf-8", "surrogatepass") for c in chunks]
        order = sorted(range(len(data)), key=lambda k: len(data[k]))
        out: list[tuple[bytes, float]] = [(b"", 0.0)] * len(data)
        while order and len(data[order[-1]]) >= ALONE_BYTES:
            k = order.pop()
            out[k] = self._alone(data[k])
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end - at) * len(data[order[end]]) <= GROUP_BYTES and \
                    len(data[order[end]]) <= 1.25 * len(data[order[at]]) + 2:
                end += 1
            rows = order[at:end]
            for k, found in zip(rows, self._viterbi([data[k] for k in rows])):
                out[k] = found
            at = end
        return out

    def _viterbi(self, data: list[bytes]) -> Iterator[tuple[bytes, float]]:
        m, width = len(data), max(map(len, data))
        if not width:
            yield from ((b"", 0.0) for _ in data)
            return
        text = np.zeros((width + 1, m), dtype=np.int32)
        lengths = np.fromiter(map(len, data), np.int64, m)
        text[:width] = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), np.uint8).reshape(m, width).T
        # bytes of the character that starts at a place; 0 inside one
        span = np.select([text < 0x80, text < 0xC0, text < 0xE0, text < 0xF0], [1, 0, 2, 3], 4)
        best = np.full((width + 1, m), -np.inf)
        best[0] = 0.0
        came = np.zeros((width + 1, m), dtype=np.int32)  # bytes of the last piece
        piece = np.full((width + 1, m), -1, dtype=np.int64)  # its id; -1: bytes
        every = np.arange(m)
        for i in range(width):
            rows = every[(best[i] > -np.inf) & (lengths > i) & (span[i] > 0)]
            if not len(rows):
                continue
            start = best[i, rows]
            alone = np.zeros(len(rows), dtype=bool)
            live, state = np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64)
            for j in range(i, min(width, i + self.trie.depth)):
                state = self.trie.step(state, text[j, rows[live]])
                on = (state >= 0) & (lengths[rows[live]] > j)
                live, state = live[on], state[on]
                if not len(live):
                    break
                value = self.trie.value[state]
                hit = value >= 0
                if not hit.any():
                    continue
                who, k = live[hit], value[hit]
                r = rows[who]
                alone[who] |= span[i, r] == j - i + 1
                score = start[who] + self.score[k]
                better = score > best[j + 1, r]
                r = r[better]
                best[j + 1, r], came[j + 1, r], piece[j + 1, r] = score[better], j - i + 1, k[better]
            lone = np.flatnonzero(~alone)
            if len(lone):
                r = rows[lone]
                to = np.minimum(i + span[i, r], lengths[r])
                score = start[lone] + self.unknown
                better = score > best[to, r]
                r, to = r[better], to[better]
                best[to, r], came[to, r], piece[to, r] = score[better], to - i, -1
        at = lengths.copy()
        steps = []
        while True:
            live = np.flatnonzero(at > 0)
            if not len(live):
                break
            steps.append((live, at[live], came[at[live], live], piece[at[live], live]))
            at[live] -= came[at[live], live]
        ids: list[list[int]] = [[] for _ in range(m)]
        for live, ends, sizes, values in steps:
            for r, e, n, k in zip(live.tolist(), ends.tolist(), sizes.tolist(), values.tolist()):
                if k >= 0:
                    ids[r].append(k)
                else:
                    ids[r].extend(self.byte_ids[list(data[r][e - n:e][::-1])].tolist())
        scores = best[lengths, every].tolist()
        for found, score in zip(ids, scores):
            yield np.array(found[::-1], dtype="<u4").tobytes(), score

    def _alone(self, data: bytes) -> tuple[bytes, float]:
        """The best segmentation of one chunk, as ``_viterbi`` finds it."""
        base, check, value, score = self.plain
        n, depth = len(data), self.trie.depth
        best, came, piece = array("d", [-math.inf]) * (n + 1), array("i", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0] = 0.0
        for i, byte in enumerate(data):
            start = best[i]
            # no character starts at a continuation byte
            if start == -math.inf or 0x80 <= byte < 0xC0:
                continue
            span = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
            state, whole = 0, False
            for end in range(i + 1, min(n, i + depth) + 1):
                to = base[state] + data[end - 1]
                if to == 0 or check[to] != state:
                    break
                state, k = to, value[to]
                if k >= 0:
                    whole |= end - i == span
                    if start + score[k] > best[end]:
                        best[end], came[end], piece[end] = start + score[k], end - i, k
            if not whole:
                end = min(n, i + span)
                if start + self.unknown > best[end]:
                    best[end], came[end], piece[end] = start + self.unknown, end - i, -1
        ids, end = array("i"), n
        while end:
            if piece[end] >= 0:
                ids.append(piece[end])
            else:
                ids.extend(self.byte_ids[list(data[end - came[end]:end][::-1])].tolist())
            end -= came[end]
        return np.array(ids, dtype="<u4")[::-1].tobytes(), best[n]

    def encode(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, float]]:
        """(ids, log score) of each text."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_CHARS):
                size += len(texts[end])
                end += 1
            yield from self._encode_slice(texts[at:end])
            at = end

    def _encode_slice(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, float]]:
        marked = [f" {t}" if t else "" for t in texts]
        if any(_CUT in t for t in texts):  # the cut mark is in use: cut in Python
            found = [_CHUNK.findall(t) for t in marked]
            column = pa.array([c for f in found for c in f], pa.large_string())
            ends = np.cumsum([0, *map(len, found)])
        else:
            column = pa.array(marked, pa.large_string())
            column = pc.replace_substring(column, "\n", f"{_CUT}\n{_CUT}")
            column = pc.replace_substring_regex(column, "([^ ])( +)", rf"\1{_CUT}\2")
            parts = pc.split_pattern(column, _CUT)
            column, ends = parts.flatten(), np.asarray(parts.offsets)
        coded = pc.dictionary_encode(column)
        where, chunks = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        cache = self.cache
        missing = [c for c in chunks if c not in cache]
        fresh = dict(zip(missing, self.segment(missing)))
        results = [cache[c] if c in cache else fresh[c] for c in chunks]
        if len(cache) + len(fresh) > CACHE_CHUNKS:
            cache.clear()
            cache[""] = (b"", 0.0)
        cache.update((c, x) for c, x in fresh.items() if len(c) <= LONG_CHUNK)
        ids, bounds = gather([r[0] for r in results], where, ends)
        running = np.concatenate([[0.0], np.cumsum(np.array([r[1] for r in results])[where])])[ends] if len(where) \
            else np.zeros(len(texts) + 1)
        for k in range(len(texts)):
            yield ids[bounds[k]:bounds[k + 1]], float(running[k + 1] - running[k])

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        data = b"".join(map(self.spelled.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
        return data[1:].decode("utf-8", "surrogatepass") if data else ""


_models: dict[str, Unigram] = {}


def model(path: str) -> Unigram:
    """The worker process's model of a vocabulary file."""
    if path not in _models:
        _models[path] = Unigram.load(path)
    return _models[path]


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, n_byte_tokens, log_score, ids_crc32, round_trip) of each row;
    ``round_trip`` tells whether decoding the ids gives the text."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own = model(path)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, scores = [], []
            for found, score in own.encode(texts):
                ids.append(found)
                scores.append(score)
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
            byte_ends = np.concatenate([[0], np.cumsum(own.is_byte[flat])])[ends]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))),
                 pa.array(np.diff(ends).astype(np.int64)), pa.array(np.diff(byte_ends)), pa.array(scores, pa.float64()),
                 pa.array([zlib.crc32(np.ascontiguousarray(x, dtype="<u4")) for x in ids], pa.int64()),
                 pa.array([own.decode(x) == t for x, t in zip(ids, texts)], pa.bool_())],
                names=["doc_id", "ids", "n_tokens", "n_byte_tokens", "log_score", "ids_crc32", "round_trip"])

    ship_code(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        run, "doc_id long, ids array<int>, n_tokens long, n_byte_tokens long, log_score double, ids_crc32 long, "
             "round_trip boolean")
