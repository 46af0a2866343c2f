"""Documents in blocks with a dictionary each: what a block shares is shuffled once.

Operators that look something up for every word or link of a text (ids of a word,
a corpus-wide count) would move a row per occurrence. Instead a task numbers the
distinct keys of a block of documents; the rows that are moved are the block's keys,
and its texts stay behind as packed numbers until the answers come back by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text in a block. A longer text is a block of its own.
BLOCK_BYTES = 8 << 20


def block_numbers() -> Iterator[int]:
    """Numbers that no other task of the running stage gives away."""
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    return iter(range(first, first + (1 << 32)))


def packed(values: np.ndarray) -> bytes:
    """Numbers below 2**32, compressed: their low bytes first, then the next ones."""
    planes = np.ascontiguousarray(values.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int) -> np.ndarray:
    """The ``count`` numbers of :func:`packed`."""
    planes = pa.decompress(data, decompressed_size=4 * count, codec="zstd", asbytes=True)
    rows = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, count).T)
    return rows.view("<u4").ravel()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift
