"""Whole texts of an Arrow batch as flat numpy arrays: bytes, words and hashes without a Python loop over characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: White space of the word rule [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII capitals to small letters; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, U64)
        have[0] = 1
        have = np.cumprod(have, dtype=U64)
        if n <= 1 << 23:  # a very long text's table is not kept
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums H with span_hash(H, s, e) the same for equal bytes wherever they stand."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), dtype=U64, out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = powers(_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64))


def byte_lists(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of about `most` bytes of text, or one longer text; with each its texts."""
    for batch in batches:
        texts = byte_lists(batch.column(batch.schema.get_field_index(column)))
        first, total = 0, 0
        for i, text in enumerate(texts):
            if i > first and total + len(text) > most:
                yield batch.slice(first, i - first), texts[first:i]
                first, total = i, 0
            total += len(text)
        if texts:
            yield batch.slice(first), texts[first:]


def packed(texts: list[bytes], gap: bytes = b" ") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with a gap after each; first and end byte of each text."""
    data = np.frombuffer(gap.join([*texts, b""]), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    end = np.cumsum(size + len(gap)) - len(gap)
    return data, end - size, end


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of every word; a gap of white space keeps texts apart."""
    edge = np.diff(np.concatenate(([1], SPACE[data].view(np.int8), [1])))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def ragged(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of flat values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
