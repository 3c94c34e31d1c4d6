"""Words of many texts at once, as byte spans and 64-bit hashes in numpy.

Texts stay in Arrow's buffers; work is done in slices of a few megabytes, so that memory does not
grow with the batch. A text is never cut: one longer than the slice is a slice of its own.

Hashes are 64-bit: two different words (or shingles) are taken for equal with probability 2**-64 a
pair. Callers that need more compare the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}

#: Bytes that end a word: the ASCII white space of the regex class [\x20\x09-\x0D].
SPACES = bytes([0x20, *range(0x09, 0x0E)])
SLICE_BYTES = 2 << 20


#: Rows of one batch of texts on its way to Python, and back.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let the session send texts in batches of at most ``BATCH_ROWS`` rows.

    A batch is held several times at once, by the JVM on its way out, by Python, and by the JVM on
    its way back; work on it goes by slices anyway. A smaller setting of the user's stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def byte_table(separators: bytes) -> np.ndarray:
    """256 flags: True for bytes that belong to words."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Words between white space.
SPACED = byte_table(SPACES)
#: Words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, lower-case letters and everything beyond ASCII.
ALNUM = byte_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (one more than rows) of a string column; null rows are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of whole rows of about ``limit`` bytes."""
    data, at = buffers(texts)
    first, rows = 0, len(at) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_spans(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of word bytes; runs end with their row."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = 1 << max(18, n.bit_length())
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        have = np.full(size, base, U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE_BYTES:
            _powers[kind] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of MurmurHash3, public domain)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, equal wherever the span stands."""
    sums = np.zeros(len(data) + 1, U)
    np.multiply(data + U(1), _power("up", len(data)), out=sums[1:])
    np.cumsum(sums, out=sums)
    value = (sums[ends] - sums[starts]) * _power("down", len(data) + 1)[starts]
    return mix(value ^ (U(0x632BE59BD9B4E019) * (ends - starts).astype(U)))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values, by position of its first."""
    if len(hashes) < n:
        return np.zeros(0, U)
    out = np.zeros(len(hashes) - n + 1, U)
    for k in range(n):
        out = mix(out * U(3) + hashes[k : len(hashes) - n + 1 + k])
    return out


def shingles(hashes: np.ndarray, row: np.ndarray, rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``n`` words inside one row; a row of fewer words, but not none, is one run."""
    out, of = run_hashes(hashes, n), row[: max(0, len(row) - n + 1)]
    whole = of == row[n - 1 :] if len(of) else np.zeros(0, bool)
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    short = np.flatnonzero((count > 0) & (count < n))
    extra = np.array([run_hashes(hashes[first[r] : first[r] + count[r]], int(count[r]))[0] for r in short], U)
    return np.concatenate([out[whole], mix(extra + U(n))]), np.concatenate([of[whole], short])


SKETCH_WORDS = 8


def parity_sketch(values: np.ndarray) -> np.ndarray:
    """The parity of how many distinct values fall on each of 512 bits, as 64-bit words.

    Two sets differ in at least as many values as their sketches in bits: a value that only one of
    them has turns one bit.
    """
    bits = (values * U(_BASE) >> U(55)).astype(np.int64)
    odd = (np.bincount(bits, minlength=64 * SKETCH_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)
