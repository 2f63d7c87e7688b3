"""Helpers that the training-data operators share: stored intermediate tables and bytes of Arrow text columns."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cartspark.session import scratch_path

# Bytes of text that a task holds as numpy arrays at a time; one longer text is a chunk by itself.
CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Digits, lower-case letters and every byte of a character beyond ASCII.
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def stored(df: DataFrame, purpose: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and no executor's disk is needed again."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the hash base modulo 2**64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 1 << 16), _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers[:n]


@dataclass
class Chunk:
    """Texts of some rows of a batch as one run of bytes; text i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column into runs of at most ``limit`` bytes (or one text). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    n, begin = len(column), column.offset
    if n == 0:
        return
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[begin : begin + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield Chunk(first, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Words of a chunk: their 64-bit hashes, byte bounds, and the first word of each text."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def words_of(chunk: Chunk) -> Words:
    """A-Z in lower case, then runs of digits, letters and characters beyond ASCII."""
    data = LOWER[chunk.data]
    inside = IS_WORD[data]
    breaks = chunk.offsets[1:-1]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    # A word ends with its text, even if the next text begins with a word.
    at = breaks[(breaks > 0) & (breaks < len(data))]
    begins[at] = inside[at]
    ends[at - 1] = inside[at - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return Words(data, np.zeros(0, np.uint64), empty, empty, np.zeros(len(chunk.offsets), np.int64))
    lengths = stops - starts
    first = np.cumsum(lengths) - lengths
    letters = data[inside].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    letters *= powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(letters, first))
    return Words(data, hashes, starts, stops, np.searchsorted(starts, chunk.offsets))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k hashes from each place on; places without k followers are left out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i, power in enumerate(powers(k)):
        out += hashes[i : i + n] * power
    return mix(out)


def carried(batch: pa.RecordBatch, names: list[str], results: dict[str, pa.Array]) -> pa.RecordBatch:
    """Columns of the input beside new ones; a new column replaces one of the same name."""
    columns = {name: batch.column(name) for name in names if name not in results}
    return pa.RecordBatch.from_arrays([*columns.values(), *results.values()], names=[*columns, *results])


def give_back() -> None:
    """Return freed memory to the system: a Python worker stays when its task is done, and holds on to it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def split_batches(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = 16 * CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``limit`` bytes of text, so that what a task returns at once stays small."""
    try:
        yield from _split_batches(batches, column, limit)
    finally:
        give_back()


def _split_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, before + limit, "right")), first + 1)
            yield batch.slice(first, last - first)
            first = last
