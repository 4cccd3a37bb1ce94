"""Words of many texts at once, as byte ranges and 64-bit hashes.

Texts reach a task as Arrow columns. They are cut into pieces of about a quarter of a
megabyte (a longer text is a piece of its own), so that working arrays stay small
whatever the batch holds, and each piece is tokenised and hashed with array operations.
Hashes depend on the bytes alone: any worker, on any machine, finds the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18

# Bytes that separate words. Both rules only name ASCII, so they hold on UTF-8 bytes.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])

_SEED = np.random.Generator(np.random.PCG64(20240229))
_BYTE_MIX = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 1
_LEFT = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1
_LEFT_INVERSE = pow(_LEFT, -1, 1 << 64)
def limit_batches(spark, size: int = 16 << 20):
    """Have Spark hand rows to Python by bytes too, not by number alone: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return spark


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 12), np.uint64(base & _MASK), dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= PIECE_BYTES:
            _powers[base] = have
    return have[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every bit of each value over all others."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def separator_table(separators: bytes) -> np.ndarray:
    """For each byte, whether it belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


BLANK_TABLE = separator_table(BLANKS)

# Words of letters and digits: whatever is not ASCII belongs to them, A-Z is folded.
PLAIN_TABLE = separator_table(
    bytes(b for b in range(128) if not (chr(b).isascii() and chr(b).isalnum()))
)
PLAIN_FOLD = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)


@dataclass
class Words:
    """Words of consecutive texts; ``bounds[t]:bounds[t + 1]`` are those of text ``t``."""

    first: int  # number of the first text in its batch
    data: np.ndarray  # bytes of the piece
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        """One hash per word, of its bytes."""
        lengths = self.end - self.start
        if not len(lengths):
            return np.zeros(0, dtype=np.uint64)
        first = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        values = _BYTE_MIX[self.data[np.repeat(self.start, lengths) + within]]
        values *= powers(_STEP, int(lengths.max()))[within]
        return mixed(np.add.reduceat(values, first))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def words(
    column: pa.Array, table: np.ndarray = BLANK_TABLE, fold: np.ndarray | None = None
) -> Iterator[Words]:
    """Words of every text of a column, piece by piece, in order; ``fold`` replaces bytes
    first."""
    data, offsets = utf8(column)
    if fold is not None:
        data = fold[data]
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, "right")) - 1
        last = min(n, max(last, first + 1))
        yield piece(data, offsets[first : last + 1], first, table)
        first = last


def piece(data: np.ndarray, offsets: np.ndarray, first: int, table: np.ndarray) -> Words:
    data = data[offsets[0] : offsets[-1]]
    at = offsets - offsets[0]
    inside = table[data]
    edge = at[:-1][at[:-1] < len(data)]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[edge] = inside[edge]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edge = edge[edge > 0] - 1
    closes[edge] = inside[edge]
    start = np.flatnonzero(opens)
    return Words(first, data, start, np.flatnonzero(closes) + 1, np.searchsorted(start, at))


def sequences(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` values from each position on (few positions need many
    values: taken from running sums)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(_LEFT, len(hashes)), out=total[1:])
    return mixed((total[length:] - total[:-length]) * powers(_LEFT_INVERSE, n))


def spans_hash(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values in each range, its length included."""
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(_LEFT, len(hashes)), out=total[1:])
    shift = powers(_LEFT_INVERSE, len(hashes) + 1)[start]
    return mixed((total[end] - total[start]) * shift + (end - start).astype(np.uint64))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    have, span = values, 1
    while 2 * span <= width:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = width - span
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def whole(bounds: np.ndarray, length: int) -> np.ndarray:
    """For each start of ``length`` consecutive words, whether they lie in one text."""
    n = max(0, int(bounds[-1]) - length + 1)
    change = np.zeros(n + 1, dtype=np.int64)
    upper = bounds[1:] - length + 1
    some = upper > bounds[:-1]
    np.add.at(change, bounds[:-1][some], 1)
    np.add.at(change, upper[some], -1)
    return np.cumsum(change[:n]) > 0
