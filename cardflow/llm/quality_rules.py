"""Quality rules with compression bands.

Every text is compressed whole and in fixed chunks with zstandard. The ratio compressed/raw of a
text must lie inside the band of its length: below it the text is repetitive, above it the text is
incompressible. Ratios of texts differ with their length, so each length class has limits of its
own; texts shorter than the first class have too little to compress and are not judged by ratio.
The ratio of a whole text averages a bad stretch away, so its chunks decide too: a text fails when
more than a small share of them, or several in a row, lie outside their limits. What is left behind
the last full chunk is judged as a chunk with the limits of its own length.

A null text counts as an empty one: no words, ``base_failed`` true, ratios null. Repeated rows are
judged one by one and get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import give_back, unused
from cardflow.llm.textstats import utf8, windows, word_hashes

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in _SYMBOLS)
_SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio compressed/raw by length in bytes.

    ``whole`` holds (bytes at least, lowest ratio, highest ratio) in ascending order. ``chunk``
    holds the same limits for the chunks of ``chunk_bytes``; a text fails when more than
    ``chunk_share`` of its chunks, or ``chunk_run`` of them in a row, lie outside.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (256, 0.28, 0.95), (512, 0.26, 0.85), (1024, 0.25, 0.75), (4096, 0.22, 0.70), (16384, 0.20, 0.65))
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.15, 0.75)
    chunk_share: float = 0.1
    chunk_run: int = 3
    level: int = 3


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "ratio double, chunks long, chunks_outside long, tail_outside boolean, longest_run long")


def repeated_words(words: np.ndarray, width: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of ``width`` words found at least twice in the text."""
    if len(words) <= width:
        return 0
    keys = windows(words, width)
    _, where, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[where] > 1)
    if not len(starts):
        return 0
    return int(np.minimum(np.diff(starts, append=starts[-1] + width), width).sum())


def duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def _statistics(texts: list[bytes], bands: Bands) -> dict[str, list]:
    packer = zstandard.ZstdCompressor(level=bands.level)
    out: dict[str, list] = {k.split()[0]: [] for k in SCHEMA.split(", ")}
    low, high = bands.chunk
    size = bands.chunk_bytes
    packed = lambda part: len(packer.compress(part)) / len(part)
    for text, words in zip(texts, word_hashes(texts)):
        solid = text.translate(None, _SPACES)
        full = range(0, len(text) - size + 1, size)
        bad = [not low <= packed(text[a:a + size]) <= high for a in full]
        tail = text[len(full) * size:]
        limits = [x[1:] for x in bands.whole if len(tail) >= x[0]][-1:] if bad else []  # no full chunk: the tail is the text
        end = [not a <= packed(tail) <= b for a, b in limits]
        for name, value in (
                ("n_words", len(words)), ("word_chars", _points(solid)),
                ("n_symbols", len(text.translate(None, _NOT_SYMBOLS))),
                ("n_dup_lines", duplicate_lines(text)), ("n_repeat_words", repeated_words(words)),
                ("ratio", packed(text) if text else None),
                ("chunks", len(full)), ("chunks_outside", sum(bad)),
                ("tail_outside", end[0] if end else None), ("longest_run", _longest_run(bad + end))):
            out[name].append(value)
    return out


def _longest_run(flags: list[bool]) -> int:
    return max((sum(1 for _ in run) for on, run in groupby(flags) if on), default=0)


def _points(data: bytes) -> int:
    """Code points of UTF-8 bytes: all bytes but continuation bytes."""
    buf = np.frombuffer(data, dtype=np.uint8)
    return int(np.count_nonzero((buf & 0xC0) != 0x80))


def statistics(text_column: str, bands: Bands = Bands()):
    """Column of a struct with the counts and compression ratios of each text."""

    @F.pandas_udf(SCHEMA)
    def measure(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame(_statistics(utf8(texts), bands))
        give_back()

    return measure(F.coalesce(F.col(text_column), F.lit("")))


def with_verdict(df: DataFrame, text: str = "text", bands: Bands = Bands(), name: str = "__rules") -> DataFrame:
    """``df`` with a struct ``name``: the statistics, ``base_failed``, ``band_failed``, ``kept``.

    One pass over the texts; no shuffle.
    """
    stat = unused(df, "__stat")
    measured = df.withColumn(stat, statistics(text, bands))
    s = lambda field: F.col(f"{stat}.{field}")
    base = (s("n_words") < MIN_WORDS) | (s("n_repeat_words") * 100 > s("n_words") * REPEAT_PERCENT)
    length = F.coalesce(F.octet_length(F.col(text)), F.lit(0))
    inside = F.lit(True)
    for least, low, high in bands.whole:
        inside = F.when(length >= least, s("ratio").between(low, high)).otherwise(inside)
    judged = s("chunks") + s("tail_outside").isNotNull().cast("long")
    outside = s("chunks_outside") + F.coalesce(s("tail_outside").cast("long"), F.lit(0))
    band = ~inside | (outside > judged * bands.chunk_share) | (s("longest_run") >= bands.chunk_run)
    return (measured.withColumn(name, F.struct(
        f"{stat}.*", base.alias("base_failed"), band.alias("band_failed"), (~base & ~band).alias("kept")))
        .drop(stat))
