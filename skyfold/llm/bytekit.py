"""Words and substring hashes of Arrow text columns, vectorised with numpy.

Tasks work on the UTF-8 bytes of an Arrow batch, in slices of about 1 MB, so
that memory per task stays bounded and no Python string is made per word.
Hashes are the same in every process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from skyfold.session import ship_package

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
pa.set_memory_pool(pa.system_memory_pool())      # idle workers give memory back
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Two independent tables of a random number per byte value.
_TABLES = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, (2, 256), dtype=np.uint64, endpoint=False)
_POWERS: dict[int, np.ndarray] = {}

#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing).
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def bounded_batches(spark: SparkSession) -> None:
    """Limits Arrow batches by bytes too, so that very long texts don't pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Returns the freed memory that the C library keeps, where it can (glibc)."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(fn: Callable) -> Callable:
    """``fn``, whose worker holds no freed memory once its task is done: workers stay while later stages run."""
    def run(batches):
        yield from fn(batches)
        give_back()
    return run


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with bounded batches; ``fn`` takes and gives batches."""
    ship_package(df.sparkSession)
    bounded_batches(df.sparkSession)
    return df.mapInArrow(giving_back(fn), schema)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the n + 1 offsets of its rows; null counts as empty."""
    arr = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_string(arr.type) and not pa.types.is_binary(arr.type):
        arr = arr.cast(pa.string())
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) else b"")
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64) if len(arr) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(buf: np.ndarray, off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: (first row, last row + 1, bytes, offsets)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1))
        yield i, j, buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 1 << 23:
            _POWERS[base] = have
    return have[:n]


def prefix_hash(buf: np.ndarray, table: int = 0) -> np.ndarray:
    """Prefix sums from which ``span_hash`` hashes any substring at once."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLES[table][buf] * _powers(_BASE, len(buf)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the substrings [start, end)."""
    h = (prefix[end] - prefix[start]) * _powers(_BASE_INV, len(prefix))[start]
    return mix(h + (end - start).astype(np.uint64) * _LEN)


def row_runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``mask`` inside rows: starts, ends, and the n + 1 offsets of the rows' runs."""
    n = len(mask)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.zeros(n, bool)
    before[1:] = mask[:-1]
    before &= ~edge[:-1]
    after = np.zeros(n, bool)
    after[:-1] = mask[1:]
    after &= ~edge[1:]
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` consecutive words, one per start that has n words left in the whole array."""
    m = max(0, len(words) - n + 1)
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h = mix((h ^ words[k:k + m]) * _LEN + np.uint64(k + 1))
    return h


def gram_starts(word_off: np.ndarray, n: int) -> np.ndarray:
    """Word positions at which an n-gram lies inside its row."""
    total = int(word_off[-1])
    if total < n:
        return np.zeros(0, np.int64)
    left = np.repeat(word_off[1:], np.diff(word_off)) - np.arange(total)
    return np.flatnonzero(left >= n)
