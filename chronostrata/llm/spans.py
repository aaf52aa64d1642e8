"""Hashes of words and byte strings over Arrow text columns, in numpy.

Byte strings are hashed as polynomials over random byte values modulo 2^64, mixed at the end, so the hash
of any span comes from two prefix sums. Work goes in blocks of about a megabyte, whatever the texts are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 20
_RNG = np.random.default_rng(20240115)
BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i < n."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        up, down = np.full(n, BASE), np.full(n, BASE_INVERSE)
        up[:1], down[:1] = 1, 1
        have = _powers[0] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of value * BASE^i before each position; one longer than the data."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of data[start:end]; equal strings have equal hashes wherever they stand."""
    down = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 borders of its texts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    borders = np.frombuffer(texts.buffers()[1], dtype=wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[borders[0] : borders[-1]]
    return data, borders - borders[0]


def word_spans(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word, in order; words never cross texts."""
    word = IS_WORD[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[borders] = True
    before = np.concatenate([[False], word])
    after = np.concatenate([word, [False]])
    return np.flatnonzero(after & (~before | first)), np.flatnonzero(before & (~after | first))


def word_borders(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of all words of a column, in bytes from its first text, and the n + 1 borders of texts among them."""
    data, borders = text_bytes(texts)
    start, end = word_spans(data, borders)
    return start, end, np.searchsorted(start, borders, side="left")


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, end of all words of a column, and the n + 1 borders of texts among the words.

    Starts and ends count bytes from the first text of the column."""
    data, borders = text_bytes(texts)
    start, end = word_spans(data, borders)
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + BLOCK, side="right")))
        part = data[start[at] : end[stop - 1]]
        sums = prefix_sums(LOWER[part] if lower else part)
        out[at:stop] = span_hashes(sums, start[at:stop] - start[at], end[at:stop] - start[at])
        at = stop
    return out, start, end, np.searchsorted(start, borders, side="left")


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` successive words of one text; of all its words if there are fewer."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, np.uint64(size))
    for i in range(size):
        out = out * BASE + words[i : len(words) - size + 1 + i]
    return mix(out)


def numbered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns under names that cannot clash; functions on batches go by their places."""
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


def pieces(batches: Iterator[pa.RecordBatch], text: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts have some megabytes; one longer text makes a piece alone."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(size) // most
        ends = [*(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip([0, *ends[:-1]], ends, strict=True):
            if b > a:
                yield batch.slice(a, b - a)
