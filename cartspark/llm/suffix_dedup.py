"""Removal of byte strings that an earlier document already has, with a logarithmic family of sorted suffixes.

Suffixes are indexed sparsely. Of the k-byte strings in a window of ``width`` bytes, the one with the smallest hash is the
window's anchor; equal windows have the same anchor at the same place, whatever surrounds them. Consecutive windows
with one anchor form a run, and a run is known by its anchor's hash and the hash of all its bytes.

1. Every task packs the runs of its documents, in the order of their hashes, settles those that repeat among them, and
   deals the rest to buckets of hash ranges.
2. A bucket takes its documents in order, in batches. A batch is sorted, its runs are looked up in the sorted levels of all
   earlier batches, and it becomes a level; two levels of equal rank merge into one of the next. A run with an earlier
   equal is removed as a whole. Runs that share an anchor but not all bytes may still share some windows: they are
   contested.
3. Contested runs are compared window by window: those of an anchor in one bucket, or, if an anchor has very many, each
   window by its own hash, after what repeats within a shard of documents is settled there.
4. Documents meet what was found of them and are cut.

Text is moved twice, packed by shard and compressed. Hashes have 64 bits and more.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartspark.llm.common import mix, powers, split_batches, stored, text_chunks

WIDTH = 50
ANCHOR = 20
# Text whose runs are packed together, and text for each bucket of runs and each shard of documents.
PACK_BYTES = 12 << 20
BUCKET_BYTES = 12 << 20
SHARD_BYTES = 6 << 20
# Batches of documents that a bucket indexes one after the other.
BATCHES = 8
NO_ID = np.iinfo(np.int64).max

# Runs of one anchor that are compared together; beyond, they are compared by window.
TOGETHER = 64

COVERED, CONTESTED, WIDELY_CONTESTED = 1, 2, 3

_PLACE_BITS = 24
_PIECE = 1 << 22
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_inverse_powers = np.ones(1, dtype=np.uint64)

# What packed rows may hold: runs have all but code, flags docs to code, windows docs, marks, at, start and hash.
_BLOB = ["docs", "marks", "firsts", "at", "code", "gram", "run_high", "run_low", "start", "hash", "data"]
_SCHEMA = "_key int, " + ", ".join(f"{c} binary" for c in _BLOB)


def inverse_powers(n: int) -> np.ndarray:
    global _inverse_powers
    if len(_inverse_powers) < n:
        steps = np.full(max(n, 1 << 16), _INVERSE, dtype=np.uint64)
        steps[0] = 1
        _inverse_powers = np.cumprod(steps)
    return _inverse_powers[:n]


class Hashes:
    """Hashes of any stretch of some bytes."""

    def __init__(self, data: np.ndarray):
        sums = (data.astype(np.uint64) + np.uint64(1)) * powers(len(data))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(sums)))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix((self.sums[last] - self.sums[first]) * inverse_powers(len(self.sums))[first])

    def all_of(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * inverse_powers(n))


@dataclass
class Runs:
    """Runs of windows: their text, first and last window start in it, anchor hash and run hash."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray
    run: np.ndarray


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    n, size = len(values) - width + 1, 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def runs_of(data: np.ndarray, offsets: np.ndarray, width: int, anchor: int) -> Runs:
    """The runs of all windows that lie within one text; texts shorter than a window have none."""
    if len(data) >= _PIECE + width and len(offsets) == 2:
        parts = []
        for at in range(0, len(data) - width + 1, _PIECE):
            piece = data[at : at + _PIECE + width - 1]
            part = runs_of(piece, np.array([0, len(piece)]), width, anchor)
            part.first += at
            part.last += at
            parts.append(part)
        return Runs(*(np.concatenate([getattr(p, f) for p in parts]) for f in Runs.__dataclass_fields__))
    if len(data) < width:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    hashes = Hashes(data)
    grams = hashes.all_of(anchor)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    ranked = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_minimum(ranked, width - anchor + 1) & mask).astype(np.int64)
    n = len(place)
    change = np.zeros(n + 1, np.int64)
    lengths = np.diff(offsets)
    long = lengths >= width
    np.add.at(change, offsets[:-1][long], 1)
    np.add.at(change, offsets[:-1][long] + lengths[long] - width + 1, -1)
    valid = np.cumsum(change[:-1]) > 0
    differs = place[1:] != place[:-1]
    begins, ends = valid.copy(), valid.copy()
    begins[1:] &= ~valid[:-1] | differs
    ends[:-1] &= ~valid[1:] | differs
    # Between the last window of a text and the first of the next there is a gap, so runs end with their text.
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    text = np.searchsorted(offsets, first, "right") - 1
    run = hashes.of(first, last + width)
    base = offsets[text]
    # Anchors have small hashes; hashed anew, they spread over all buckets.
    return Runs(text, first - base, last - base, mix(~grams[place[first]]), run)


def earlier_equal(doc: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys and document; and whether, in this order, a smaller document has the same keys."""
    order = np.lexsort((doc, *keys))
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(order)))
    sorted_doc = doc[order]
    return order, sorted_doc > np.repeat(sorted_doc[heads], sizes)


@dataclass
class Level:
    """Runs in the order of their hashes, each with the document that first had it."""

    rank: int
    key: np.ndarray
    low: np.ndarray
    doc: np.ndarray
    ref: np.ndarray

    def __len__(self) -> int:
        return len(self.key)

    def has(self, key: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Binary search of sorted runs."""
        left = np.searchsorted(self.key, key, "left")
        right = np.searchsorted(self.key, key, "right")
        found = np.zeros(len(key), dtype=bool)
        for step in range(int((right - left).max(initial=0))):
            at = left + step
            inside = at < right
            found[inside] |= self.low[at[inside]] == low[inside]
            if (found | (at + 1 >= right)).all():
                break
        return found

    def merged(self, other: Level) -> Level:
        arrays = [np.concatenate((getattr(self, f), getattr(other, f))) for f in ("key", "low", "doc", "ref")]
        order = np.lexsort((arrays[1], arrays[0]))
        return Level(max(self.rank, other.rank) + 1, *(a[order] for a in arrays))


class IndexFamily:
    """Levels of runs of earlier documents; batches come in the order of their documents."""

    def __init__(self):
        self.levels: list[Level] = []

    def add(self, key: np.ndarray, low: np.ndarray, doc: np.ndarray, ref: np.ndarray) -> np.ndarray:
        """Index a batch; returns the refs of runs that an earlier document has."""
        order, repeated = earlier_equal(doc, low, key)
        key, low, doc, ref = key[order], low[order], doc[order], ref[order]
        known = repeated.copy()
        for level in self.levels:
            known |= level.has(key, low)
        fresh = ~known
        self.levels.append(Level(0, key[fresh], low[fresh], doc[fresh], ref[fresh]))
        while len(self.levels) > 1 and self.levels[-1].rank == self.levels[-2].rank:
            newer = self.levels.pop()
            self.levels.append(self.levels.pop().merged(newer))
        return ref[known]

    def contested(self, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Refs of runs whose anchor also stands in another document, in another run; and whether it has very many.

        ``marked`` are anchors that have very many runs elsewhere.
        """
        whole = self.levels[0]
        for level in self.levels[1:]:
            whole = whole.merged(level)
        gram = whole.key >> np.uint64(32)
        if not len(gram):
            return whole.ref, np.zeros(0, bool)
        heads = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        sizes = np.diff(np.append(heads, len(gram)))
        wide = np.isin(gram[heads], marked) | (sizes > TOGETHER)
        several = wide | (np.minimum.reduceat(whole.doc, heads) < np.maximum.reduceat(whole.doc, heads))
        several, wide = np.repeat(several, sizes), np.repeat(wide, sizes)
        return whole.ref[several], wide[several]


def raw(values: np.ndarray, kind: str, rising: bool = False) -> bytes:
    """Numbers as compressed bytes: differences if they rise, then first bytes, second bytes and so on."""
    values = np.ascontiguousarray(values, dtype=kind)
    if rising and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(planes).to_bytes(4, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data, kind: str, rising: bool = False) -> np.ndarray:
    data = memoryview(data)
    planes = pa.decompress(data[4:], int.from_bytes(data[:4], "little"), "zstd", asbytes=True)
    size = np.dtype(kind).itemsize
    values = np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()
    return np.cumsum(values, dtype=values.dtype) if rising else values


def pack_rows(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpack_rows(data: pa.ChunkedArray) -> pa.Table | None:
    tables = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in data]
    return pa.concat_tables(tables).combine_chunks() if tables else None


def shard_of(doc: np.ndarray, shards: int) -> np.ndarray:
    return np.mod(doc ^ (doc >> 13) ^ (doc >> 29), shards)


def shard_column(doc: Column, shards: int) -> Column:
    """The same as shard_of."""
    mixed = doc.bitwiseXOR(F.shiftright(doc, 13)).bitwiseXOR(F.shiftright(doc, 29))
    return F.pmod(mixed, F.lit(shards)).cast("int")


def split(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of equal neighbours."""
    if len(keys):
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        yield from zip(heads.tolist(), [*heads[1:].tolist(), len(keys)], strict=True)


def flag_rows(first_key: int, shards: int, doc, mark, text, number, code) -> Iterator[dict]:
    """One row a shard: which numbers (of runs, or of bytes) of which of its documents have which code."""
    shard = shard_of(doc, shards)[text]
    order = np.lexsort((number, text, shard))
    text, number, code, shard = text[order], number[order], code[order], shard[order]
    for a, b in split(shard):
        used, index = np.unique(text[a:b], return_inverse=True)
        yield {
            "_key": first_key + int(shard[a]),
            "docs": raw(doc[used], "i8"),
            "marks": raw(mark[used], "u4"),
            "at": raw(index, "u4", True),
            "firsts": raw(number[a:b], "u4"),
            "code": raw(code[a:b], "u1"),
        }


def arrow_schema() -> pa.Schema:
    return pa.schema([pa.field("_key", pa.int32()), *(pa.field(c, pa.binary()) for c in _BLOB)])


def table_of(rows: list[dict]) -> pa.Table:
    schema = arrow_schema()
    return pa.Table.from_pydict({f.name: [row.get(f.name) for row in rows] for f in schema}, schema=schema)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of equal width."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def within_bucket(hashes: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """32 bits that tell the hashes of a bucket apart, in their order."""
    low = np.uint64((-(-(bucket << 32) // buckets)) << 32)
    return (hashes - low) >> np.uint64(32 - (buckets.bit_length() - 1))


class Packer:
    """Collects runs of documents and hands them on by bucket."""

    def __init__(self, buckets: int, shards: int):
        self.buckets, self.shards = buckets, shards
        self.clear()

    def clear(self):
        self.docs, self.marks, self.counts, self.grams, self.runs, self.bytes = [], [], [], [], [], 0

    def add(self, size: int, docs: np.ndarray, marks: np.ndarray, runs: Runs):
        self.docs.append(docs)
        self.marks.append(marks)
        self.counts.append(np.bincount(runs.text, minlength=len(docs)))
        self.grams.append(runs.gram)
        self.runs.append(runs.run)
        self.bytes += size

    def rows(self) -> Iterator[dict]:
        if not self.docs:
            return
        doc, mark, counts = np.concatenate(self.docs), np.concatenate(self.marks), np.concatenate(self.counts)
        gram, run = np.concatenate(self.grams), np.concatenate(self.runs)
        self.clear()
        # Documents in order.
        by_doc = np.argsort(doc, kind="stable")
        old_first = (np.cumsum(counts) - counts)[by_doc]
        doc, mark, counts = doc[by_doc], mark[by_doc], counts[by_doc]
        first = np.cumsum(counts) - counts
        text = np.repeat(np.arange(len(doc), dtype=np.int32), counts)
        number = np.arange(len(text)) - first[text]
        moved = old_first[text] + number
        gram, run = gram[moved], run[moved]
        order, repeated = earlier_equal(doc[text], run, gram)
        here = order[repeated]
        yield from flag_rows(self.buckets, self.shards, doc, mark, text[here], number[here], np.full(len(here), COVERED))
        left = order[~repeated]
        gram, run = gram[left], run[left]
        # Of an anchor with very many runs only one is sent, marked; the others need no bucket to be contested.
        sizes = np.diff([a for a, _ in split(gram)] + [len(gram)])
        wide = np.repeat(sizes > TOGETHER, sizes)
        here = left[wide]
        yield from flag_rows(
            self.buckets, self.shards, doc, mark, text[here], number[here], np.full(len(here), WIDELY_CONTESTED)
        )
        head = np.append(True, gram[1:] != gram[:-1])[: len(gram)]
        sent = ~wide | head
        at = left[sent].astype(np.uint32) | (wide[sent].astype(np.uint32) << np.uint32(31))
        gram, run, of = gram[sent], run[sent], text[left[sent]]
        bucket = bucket_of(gram, self.buckets)
        for a, b in split(bucket):
            # Only the documents that have runs in this bucket.
            own = np.unique(of[a:b])
            yield {
                "_key": int(bucket[a]),
                "docs": raw(doc[own], "i8", True),
                "marks": raw(mark[own], "u4"),
                "firsts": raw(first[own], "u4", True),
                "at": raw(at[a:b], "u4"),
                "gram": raw(within_bucket(gram[a:b], int(bucket[a]), self.buckets), "u4", True),
                "run_high": raw(run[a:b] >> np.uint64(32), "u4"),
                "run_low": raw(run[a:b] & np.uint64(0xFFFF), "u2"),
            }


def settle_bucket(table: pa.Table, first_key: int, shards: int) -> pa.Table:
    """Decide the runs of one bucket; rows that only carry flags pass unchanged."""
    if not table.num_rows or table.column("_key")[0].as_py() >= first_key:
        return table
    docs, marks, texts, numbers, keys, lows, wide, base = [], [], [], [], [], [], [], 0
    for i in range(table.num_rows):
        part = lambda name, kind, rising=False, i=i: unpacked(table.column(name)[i].as_buffer(), kind, rising)
        firsts, at = part("firsts", "u4", True), part("at", "u4")
        wide.append(at >> np.uint32(31) > 0)
        at &= np.uint32((1 << 31) - 1)
        text = (np.searchsorted(firsts, at, "right") - 1).astype(np.int32)
        docs.append(part("docs", "i8", True))
        marks.append(part("marks", "u4"))
        texts.append(text + np.int32(base))
        numbers.append(at - firsts[text])
        keys.append((part("gram", "u4", True).astype(np.uint64) << np.uint64(32)) | part("run_high", "u4"))
        lows.append(part("run_low", "u2"))
        base += len(firsts)
    doc, mark, text, number, key, low, wide = map(np.concatenate, (docs, marks, texts, numbers, keys, lows, wide))
    del docs, marks, texts, numbers, keys, lows
    of = doc[text]
    by_doc = np.argsort(of, kind="stable")
    # A document's runs are in one batch.
    ordered = of[by_doc]
    cuts = np.searchsorted(ordered, ordered[len(of) * np.arange(1, BATCHES) // BATCHES], "left")
    family, covered = IndexFamily(), []
    for batch in np.split(by_doc, np.unique(cuts)):
        covered.append(family.add(key[batch], low[batch], of[batch], batch))
    covered = np.concatenate(covered)
    contested, widely = family.contested(np.unique(key[wide] >> np.uint64(32)))
    here = np.concatenate((covered, contested))
    code = np.concatenate((np.full(len(covered), COVERED), np.where(widely, WIDELY_CONTESTED, CONTESTED)))
    return table_of(list(flag_rows(first_key, shards, doc, mark, text[here], number[here], code)))


def merge_spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches [first, last) joined where they overlap or touch."""
    if not len(first):
        return first, last
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.append(True, first[1:] > last[:-1])
    return first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)]


def cut(data: bytes, first: np.ndarray, last: np.ndarray) -> bytes:
    kept, at = [], 0
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def result_of(data: bytes, first: np.ndarray, last: np.ndarray, texts: bool) -> dict:
    first, last = merge_spans(first, last)
    kept = cut(data, first, last)
    return {
        "n_bytes": len(data),
        "n_removed": len(data) - len(kept),
        "n_spans": len(first),
        "spans": [{"first": a, "last": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)],
        "kept_sha256": hashlib.sha256(kept).hexdigest(),
        "kept": kept if texts else None,
        "kept_text": kept.decode(errors="ignore") if texts else None,
    }


RESULT_FIELDS = [
    pa.field("n_bytes", pa.int64()),
    pa.field("n_removed", pa.int64()),
    pa.field("n_spans", pa.int64()),
    pa.field("spans", SPANS),
    pa.field("kept_sha256", pa.string()),
    pa.field("kept", pa.binary()),
    pa.field("kept_text", pa.string()),
]
RESULT_SQL = (
    "n_bytes long, n_removed long, n_spans long, spans array<struct<first:long,last:long>>, "
    "kept_sha256 string, kept binary, kept_text string"
)


def flags_of(table: pa.Table) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Flagged numbers and their codes, by document and its mark."""
    found: dict = {}
    for i in range(table.num_rows):
        part = lambda name, kind, rising=False, i=i: unpacked(table.column(name)[i].as_buffer(), kind, rising)
        index, number, code = part("at", "u4", True), part("firsts", "u4"), part("code", "u1")
        for (a, b), key in zip(split(index), zip(part("docs", "i8").tolist(), part("marks", "u4").tolist()), strict=True):
            found.setdefault(key, []).append((number[a:b], code[a:b]))
    return {k: tuple(np.concatenate([p[j] for p in parts]) for j in (0, 1)) for k, parts in found.items()}


def steps(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def settle_windows(table: pa.Table, shards: int, width: int) -> pa.Table:
    """Which windows of a bucket also begin in an earlier document, by shard.

    A row has windows by hash, or runs of windows as bytes.
    """
    docs, marks, texts, starts, hashes, base = [], [], [], [], [], 0
    for i in range(table.num_rows):
        part = lambda name, kind, rising=False, i=i: unpacked(table.column(name)[i].as_buffer(), kind, rising)
        text, start = part("at", "u4").astype(np.int32), part("start", "u4")
        if table.column("hash")[i].is_valid:
            value = part("hash", "u8")
        else:
            lengths = part("firsts", "u4").astype(np.int64)
            ends = np.cumsum(lengths)
            counts = lengths - width + 1
            step = steps(counts)
            at = np.repeat(ends - lengths, counts) + step
            value = Hashes(part("data", "u1")).of(at, at + width)
            text, start = np.repeat(text, counts), (np.repeat(start, counts) + step).astype(np.uint32)
        docs.append(part("docs", "i8"))
        marks.append(part("marks", "u4"))
        texts.append(text + np.int32(base))
        starts.append(start)
        hashes.append(value)
        base += len(docs[-1])
    if not docs:
        return table_of([])
    doc, mark, text, start, value = map(np.concatenate, (docs, marks, texts, starts, hashes))
    order, repeated = earlier_equal(doc[text], value)
    here = order[repeated]
    return table_of(list(flag_rows(0, shards, doc, mark, text[here], start[here], np.full(len(here), COVERED))))


class Contested:
    """Contested runs of a shard on their way to be compared."""

    def __init__(self, buckets: int, shards: int, width: int):
        self.buckets, self.shards, self.width = buckets, shards, width
        self.docs, self.marks, self.few, self.many = [], [], [], []

    def add(self, doc: int, mark: int, data: np.ndarray, base: int, hashes: Hashes, runs: Runs, few, many):
        me = len(self.docs)
        self.docs.append(doc)
        self.marks.append(mark)
        for i in few:
            first, last = int(runs.first[i]), int(runs.last[i]) + self.width
            self.few.append((int(runs.gram[i]), me, first, data[base + first : base + last].tobytes()))
        if len(many):
            counts = runs.last[many] - runs.first[many] + 1
            start = np.repeat(runs.first[many], counts) + steps(counts)
            value = hashes.of(start + base, start + base + self.width)
            self.many.append((np.full(len(start), me), start, value))

    def rows(self) -> Iterator[dict]:
        """To buckets of anchors, to buckets of windows behind them, and flags of what is settled here behind those."""
        doc, mark = np.array(self.docs, np.int64), np.array(self.marks, np.uint32)
        self.few.sort()
        bucket = bucket_of(np.array([f[0] for f in self.few], np.uint64), self.buckets)
        for a, b in split(bucket):
            _, index, start, data = zip(*self.few[a:b], strict=True)
            used, at = np.unique(np.array(index), return_inverse=True)
            yield {
                "_key": int(bucket[a]),
                "docs": raw(doc[used], "i8"),
                "marks": raw(mark[used], "u4"),
                "at": raw(at, "u4"),
                "start": raw(np.array(start), "u4"),
                "firsts": raw(np.array([len(x) for x in data]), "u4"),
                "data": raw(np.frombuffer(b"".join(data), np.uint8), "u1"),
            }
        if not self.many:
            return
        index, start, value = map(np.concatenate, zip(*self.many, strict=True))
        order, repeated = earlier_equal(doc[index], value)
        here = order[repeated]
        yield from flag_rows(
            2 * self.buckets, self.shards, doc, mark, index[here], start[here], np.full(len(here), COVERED)
        )
        left = order[~repeated]
        bucket = bucket_of(value[left], self.buckets)
        for a, b in split(bucket):
            used, at = np.unique(index[left[a:b]], return_inverse=True)
            yield {
                "_key": self.buckets + int(bucket[a]),
                "docs": raw(doc[used], "i8"),
                "marks": raw(mark[used], "u4"),
                "at": raw(at, "u4"),
                "start": raw(start[left[a:b]], "u4"),
                "hash": raw(value[left[a:b]], "u8"),
            }


def remove_repeats(
    documents: DataFrame,
    width: int = WIDTH,
    carry: tuple[str, ...] = (),
    texts: bool = False,
    anchor: int = ANCHOR,
) -> DataFrame:
    """One row per row of doc_id and text: what is left without the bytes that an earlier document has.

    Removed is every byte of a string of ``width`` bytes that also begins somewhere in a document with a smaller id.
    Returns doc_id, the ``carry`` columns, n_bytes, n_removed, n_spans, spans ([first, last) in bytes), kept_sha256 and,
    with ``texts``, kept (bytes) and kept_text (without the rest of characters that were cut in two). A null text is
    empty. A null id is the largest of all. Rows with one id do not remove anything from each other. A carried column with
    the name of a result is left out.
    """
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, shards = int(total) // BUCKET_BYTES + 1, int(total) // SHARD_BYTES + 1
    # Only where ids repeat is a document told by a mark of its text as well.
    by_text = not documents.groupBy("doc_id").count().where("count > 1").isEmpty()
    results = [f.name for f in RESULT_FIELDS]
    carry = tuple(c for c in carry if c not in (*results, "doc_id"))
    extra = [f"_c{i}" for i in range(len(carry))]
    rows = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("_doc"),
        F.col("text").alias("_text"),
        "doc_id",
        *(F.col(c).alias(e) for c, e in zip(carry, extra, strict=True)),
    )

    def marks_of(chunk) -> np.ndarray:
        bounds = zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True)
        return np.array([zlib.crc32(chunk.data[a:b]) if by_text else 0 for a, b in bounds], np.uint32)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets, shards)
        for batch in batches:
            docs = batch.column("_doc").to_numpy()
            for chunk in text_chunks(batch.column("_text")):
                runs = runs_of(chunk.data, chunk.offsets, width, anchor)
                packer.add(len(chunk.data), docs[chunk.first : chunk.first + len(chunk)], marks_of(chunk), runs)
                if packer.bytes >= PACK_BYTES:
                    yield from table_of(list(packer.rows())).to_batches()
        yield from table_of(list(packer.rows())).to_batches()

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in split_batches(batches, "_text", PACK_BYTES):
            held.append(batch)
            size += batch.nbytes
            if size >= PACK_BYTES:
                yield from packed_shards(held)
                held, size = [], 0
        if held:
            yield from packed_shards(held)

    def packed_shards(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        shard = shard_of(table.column("_doc").to_numpy(), shards)
        order = np.argsort(shard, kind="stable")
        for a, b in split(shard[order]):
            blob = pack_rows(table.take(pa.array(order[a:b])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shard[order[a]])], pa.int32()), pa.array([blob], pa.binary())], names=["_shard", "rows"]
            )

    def compare(packed: pa.Table, flagged: pa.Table) -> pa.Table:
        """Send the contested runs of a shard's documents on."""
        docs, found = unpack_rows(packed.column("rows")), flags_of(flagged)
        contested = Contested(buckets, shards, width)
        for chunk in text_chunks(docs.column("_text")) if docs and found else ():
            ids = docs.column("_doc").slice(chunk.first, len(chunk)).to_pylist()
            marks = marks_of(chunk).tolist()
            own = [found.get(key) for key in zip(ids, marks, strict=True)]
            if not any(own):
                continue
            runs, hashes = runs_of(chunk.data, chunk.offsets, width, anchor), Hashes(chunk.data)
            begins = np.searchsorted(runs.text, np.arange(len(chunk)))
            for i, flags in enumerate(own):
                if flags is not None:
                    number, code = flags
                    many = np.unique(number[code == WIDELY_CONTESTED]).astype(np.int64)
                    few = np.setdiff1d(number[code == CONTESTED], many).astype(np.int64)
                    if len(few) or len(many):
                        contested.add(
                            ids[i], marks[i], chunk.data, int(chunk.offsets[i]), hashes, runs, begins[i] + few, begins[i] + many
                        )
        return table_of(list(contested.rows()))

    def settle(table: pa.Table) -> pa.Table:
        if table.column("_key")[0].as_py() < 2 * buckets:
            return settle_windows(table, shards, width)
        key = pc.subtract(table.column("_key"), pa.scalar(2 * buckets, pa.int32()))
        return table.set_column(0, "_key", key)

    def finish(packed: pa.Table, flagged: pa.Table) -> pa.Table:
        """Cut the documents of a shard at the runs and windows found."""
        docs = unpack_rows(packed.column("rows"))
        if docs is None:
            raise ValueError("flags of a shard without documents")
        by_run = flags_of(flagged.filter(pc.equal(flagged.column("kind"), 0)))
        by_window = flags_of(flagged.filter(pc.equal(flagged.column("kind"), 1)))
        out, none = [], (np.zeros(0, np.int64), np.zeros(0, np.uint8))
        for chunk in text_chunks(docs.column("_text")):
            ids = docs.column("_doc").slice(chunk.first, len(chunk)).to_pylist()
            keys = list(zip(ids, marks_of(chunk).tolist(), strict=True))
            runs = None
            if any(key in by_run for key in keys):
                runs = runs_of(chunk.data, chunk.offsets, width, anchor)
                begins = np.searchsorted(runs.text, np.arange(len(chunk)))
            for i, key in enumerate(keys):
                number, code = by_run.get(key, none)
                covered = number[code == COVERED].astype(np.int64)
                starts = by_window.get(key, none)[0].astype(np.int64)
                first, last = starts, starts + width
                if len(covered):
                    first = np.concatenate((first, runs.first[begins[i] + covered]))
                    last = np.concatenate((last, runs.last[begins[i] + covered] + width))
                out.append(result_of(chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes(), first, last, texts))
        return pa.table(
            {
                **{c: docs.column(c) for c in ("doc_id", *extra)},
                **{f.name: pa.array([c[f.name] for c in out], f.type) for f in RESULT_FIELDS},
            }
        )

    flag_columns = [F.col(c) for c in ("docs", "marks", "firsts", "at", "code")]
    packed = rows.select("_doc", "_text").mapInArrow(pack, _SCHEMA)
    settled = packed.groupBy("_key").applyInArrow(lambda t: settle_bucket(t, buckets, shards), _SCHEMA)
    by_run = stored(settled.select((F.col("_key") - buckets).alias("_shard"), *flag_columns), "runs")

    texts_only = rows.select("_doc", "_text").mapInArrow(to_shards, "_shard int, rows binary")
    contested = texts_only.groupBy("_shard").cogroup(by_run.groupBy("_shard")).applyInArrow(compare, _SCHEMA)
    windows = contested.groupBy("_key").applyInArrow(settle, _SCHEMA)
    by_window = stored(windows.select(F.col("_key").alias("_shard"), *flag_columns), "windows")

    flags = by_run.withColumn("kind", F.lit(0)).unionByName(by_window.withColumn("kind", F.lit(1)))
    whole = rows.mapInArrow(to_shards, "_shard int, rows binary")
    types = [f"{e} {documents.schema[c].dataType.simpleString()}" for c, e in zip(("doc_id", *carry), ("doc_id", *extra), strict=True)]
    cut_rows = whole.groupBy("_shard").cogroup(flags.groupBy("_shard")).applyInArrow(finish, ", ".join([*types, RESULT_SQL]))
    out = cut_rows.withColumnsRenamed(dict(zip(extra, carry, strict=True)))
    return out if texts else out.drop("kept", "kept_text")
