"""Byte-level helpers in numpy that several operators use inside their tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Primes under 2^31 and a base for each, for polynomial hashes: two for names, two for checks of names (fixed values).
FIELDS = ((2147483647, 1263082241, 2147483629, 1804601963), (2147483587, 1596734029, 2147483579, 1430278571))
#: Bytes of text that a task works on at once (it needs some 100 bytes of memory for each); a longer text is a piece of its own.
PIECE_BYTES = 1_500_000


def powers(base: int, n: int, prime: int) -> np.ndarray:
    """1, base, base squared and so on."""
    out, k, step = np.ones(n, np.uint64), 1, np.uint64(base % prime)
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * step % np.uint64(prime)
        step, k = step * step % np.uint64(prime), 2 * k
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Spans:
    """Hashes of any span of a sequence of unsigned 64-bit integers, from prefix sums of polynomials over two prime fields (62
    bits together). `check` takes two other fields, so that both hashes of two different spans are hardly ever equal."""

    def __init__(self, values: np.ndarray, check: bool = False):
        n, field = len(values), FIELDS[check]
        self.parts = []
        for prime, base in (field[:2], field[2:]):
            p = np.uint64(prime)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((values % p + np.uint64(1)) * powers(base, n, prime) % p, out=sums[1:])
            self.parts.append((p, sums, powers(pow(base, -1, prime), n + 1, prime)))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        (p, a, back), (q, b, rear) = self.parts
        one, two = (a[end] - a[start]) % p * back[start] % p, (b[end] - b[start]) % q * rear[start] % q
        return mixed((one << np.uint64(31) | two) + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def split_words(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches of bytes whose entry in `is_word` is set."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = is_word[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string (or binary) column and where each row begins (one entry more than rows); null counts as empty."""
    column = column.cast(pa.large_binary())
    column = column.fill_null(b"") if column.null_count else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches that hold about `most` bytes of text at most; a longer text is a batch of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = batch.column(batch.schema.get_field_index(column))
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(size), 0).cast(pa.int64()))
        group = np.cumsum(lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def overlapping(batches: Iterator[pa.RecordBatch], column: str, overlap: int, is_word: np.ndarray | None = None, most: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, data, offsets, shift): `pieces`, with the bytes and beginnings of their texts; a longer text comes in several
    parts of about `most` bytes, one at a time, which share `overlap` bytes (words, with `is_word`: cut between words) with
    the part before. `shift` counts the bytes (words) of each text before the part."""
    for batch in pieces(batches, column, most):
        data, offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))
        if len(data) <= 2 * most:
            yield batch, data, offsets, np.zeros(batch.num_rows, np.int64)
            continue
        for row in range(batch.num_rows):
            own = data[offsets[row] : offsets[row + 1]]
            starts, ends = split_words(own, is_word) if is_word is not None else (None, None)
            count, a = len(starts) if is_word is not None else len(own), 0
            while True:
                if is_word is None:
                    b, part = min(count, a + most + overlap), own[a : a + most + overlap]
                else:
                    b = min(count, max(int(np.searchsorted(starts, starts[a] + most)) if count else 0, a + 1) + overlap)
                    part = own[starts[a] : ends[b - 1]] if count else own[:0]
                yield batch.slice(row, 1), part, np.array([0, len(part)]), np.array([a])
                if b >= count:
                    break
                a = b - overlap
