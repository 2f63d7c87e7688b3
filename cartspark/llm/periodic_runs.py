"""Periodic runs of words, caught while the words are appended.

Every completed block of a power of two words becomes a catcher. It waits for the block's next occurrences, at a distance
of about two to four block lengths; appended words that complete such an occurrence are compared with the words before
and behind the block, which gives the whole stretch that repeats at that distance. Blocks side by side that are caught
at one distance are one stretch. A stretch at the end of the words stays open and is advanced by later words.

A run has 2 * period words or more, so its first part, without the last period, holds an aligned block whose catcher
looks at that distance: none is missed. A distance that is a multiple of a known run's period is left out where that
run covers it, so a long periodic passage costs no more than other text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartspark.llm.common import Chunk, carried, mix, split_batches, text_chunks

LEAST = 12
# Words that are compared at once while stretches are extended.
COMPARED = 1 << 22

# The white space that separates words: 0x09-0x0D and 0x20.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[9:14] = IS_SPACE[32] = True

_ODD = np.uint64(0xD6E8FEB86659FD93)

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] numbers, then the same for the next start."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Catchers:
    """Runs of a sequence that grows by ``append``; the result does not depend on how it was cut into pieces.

    ``longest`` bounds the length of a run where it is known, as for documents that lie one after the other. Blocks are
    found by 64-bit hashes and every stretch is compared element by element. Memory grows with the sequence.
    """

    def __init__(self, least: int = LEAST, longest: int | None = None):
        self.least, self.longest = least, longest
        # With runs of five words or more, blocks of two words see every distance from one word on.
        self.base = 2 if least >= 5 else 1
        self.words = np.zeros(0, np.int64)
        self.levels: list[tuple[int, np.ndarray]] = []
        # Element x equals element x + period for first <= x < last.
        self.period = self.first = self.last = np.zeros(0, np.int64)

    def append(self, words: np.ndarray) -> None:
        begin = len(self.words)
        self.words = np.concatenate((self.words, words.astype(np.int64)))
        self._advance()
        m, level = 1, 0
        while m <= len(self.words) and (self.longest is None or 2 * (2 * m - 1) <= max(self.longest, 4)):
            start, hashes, new = self._hashes(level, m, begin)
            if m >= self.base and new < start + len(hashes):
                self._catch(m, start, hashes, new)
            m, level = 2 * m, level + 1
        # Of each level only what later words can still meet.
        for level, (start, hashes) in enumerate(self.levels):
            cut = max(len(self.words) - 5 * (1 << level) - start, 0)
            self.levels[level] = (start + cut, hashes[cut:])
        keep = self._valid() | (self.last + self.period == len(self.words))
        self.period, self.first, self.last = self.period[keep], self.first[keep], self.last[keep]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and smallest period of every run, by start and period."""
        valid = self._valid()
        start, period = self.first[valid], self.period[valid]
        length = self.last[valid] - start + period
        # A stretch whose distance is a multiple of its period is the same stretch.
        order = np.lexsort((period, length, start))
        start, length, period = start[order], length[order], period[order]
        same = np.zeros(len(start), bool)
        same[1:] = (start[1:] == start[:-1]) & (length[1:] == length[:-1])
        start, length, period = start[~same], length[~same], period[~same]
        order = np.lexsort((period, start))
        return start[order], length[order], period[order]

    def _valid(self) -> np.ndarray:
        length = self.last - self.first + self.period
        return length >= np.maximum(self.least, 2 * self.period)

    def _advance(self) -> None:
        """Compare appended words with what stands one period before them, for stretches that reached the end."""
        n = len(self.words)
        for i in range(len(self.period)):
            at, p, step = int(self.last[i]), int(self.period[i]), 64
            while at < n - p:
                end = min(at + step, n - p)
                unlike = np.flatnonzero(self.words[at:end] != self.words[at + p : end + p])
                if len(unlike):
                    at += int(unlike[0])
                    break
                at, step = end, 2 * step
            self.last[i] = at

    def _hashes(self, level: int, m: int, begin: int) -> tuple[int, np.ndarray, int]:
        """First known place, hash of the m words from each place on, and the first place completed just now."""
        if level == len(self.levels):
            self.levels.append((0, np.zeros(0, np.uint64)))
        start, hashes = self.levels[level]
        new = start + len(hashes)
        if m == 1:
            fresh = mix(self.words[begin:].astype(np.uint64) + np.uint64(1))
        else:
            half, below = self.levels[level - 1]
            parts = below[new - half :]
            fresh = mix(parts[: -m // 2] * _ODD + parts[m // 2 :]) if len(parts) > m // 2 else np.zeros(0, np.uint64)
        hashes = np.concatenate((hashes, fresh))
        self.levels[level] = (start, hashes)
        return start, hashes, new

    def _covered(self, below: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the known runs of a period below a bound: starts, furthest end up to each start, and its run's period."""
        start, length, period = self.runs()
        chosen = period < below
        start, end, period = start[chosen], (start + length)[chosen], period[chosen]
        furthest = np.maximum.accumulate(end) if len(end) else end
        holder = np.maximum.accumulate(np.where(end == furthest, np.arange(len(end)), 0)) if len(end) else end
        return start, furthest, period[holder]

    def _catch(self, m: int, start: int, hashes: np.ndarray, new: int) -> None:
        nearest, beyond = (1 if m == self.base else 2 * m - 1), 4 * m - 1
        starts, ends, periods = self._covered(nearest)
        blocks = np.arange(-(-start // m) * m, start + len(hashes), m)
        if len(starts) and len(blocks):
            # Inside a run all occurrences of a block are those of the run.
            run = np.searchsorted(starts, blocks, "right") - 1
            blocks = blocks[(run < 0) | (ends[run] < blocks + 5 * m) | (periods[run] > m)]
        if not len(blocks):
            return
        key = hashes[blocks - start]
        bits = np.uint64((1 << int(16 * len(key)).bit_length()) - 1)
        seen = np.zeros(int(bits) + 1, bool)
        seen[key & bits] = True
        places = np.flatnonzero(seen[hashes[new - start :] & bits]) + new
        names, name = np.unique(key, return_inverse=True)
        found = np.minimum(np.searchsorted(names, hashes[places - start]), len(names) - 1)
        known = names[found] == hashes[places - start]
        places, found = places[known], found[known]
        order = np.argsort(name, kind="stable")
        span = len(hashes) + 1
        code, blocks = name[order] * span + (blocks[order] - start), blocks[order]
        base = found * span
        left = np.searchsorted(code, base + np.maximum(places - start - beyond + 1, 0))
        right = np.searchsorted(code, base + (places - start - nearest), "right")
        counts = np.maximum(right - left, 0)
        hit = counts > 0
        block = blocks[ragged(left[hit], counts[hit])]
        place = np.repeat(places[hit], counts[hit])
        distance = place - block
        if len(starts) and len(block):
            run = np.searchsorted(starts, block, "right") - 1
            inside = (run >= 0) & (ends[run] >= place + m) & (distance % periods[run] == 0)
            block, distance = block[~inside], distance[~inside]
        if not len(block):
            return
        order = np.lexsort((block, distance))
        block, distance = block[order], distance[order]
        fresh = np.ones(len(block), bool)
        fresh[1:] = (distance[1:] != distance[:-1]) | (block[1:] != block[:-1] + m)
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(block)) - 1
        self._add(distance[head], *self._extended(distance[head], block[head], block[tail] + m, m - 1))

    def _extended(self, period: np.ndarray, first: np.ndarray, last: np.ndarray, reach: int):
        """The stretches with all equal words next to them; what lies further than ``reach`` is known to differ."""
        begin = np.maximum(first - reach, 0)
        end = np.minimum(last + reach, len(self.words) - period)
        sizes = end - begin
        total = np.cumsum(sizes)
        out_first, out_last = first.copy(), last.copy()
        at = 0
        while at < len(period):
            done = total[at - 1] if at else 0
            to = max(int(np.searchsorted(total, done + COMPARED, "right")), at + 1)
            part = slice(at, to)
            index = ragged(begin[part], sizes[part])
            unlike = np.flatnonzero(self.words[index] != self.words[index + np.repeat(period[part], sizes[part])])
            offset = total[part] - sizes[part] - done
            middle = np.searchsorted(unlike, offset + first[part] - begin[part])
            padded = np.concatenate(([-1], unlike, [int(total[to - 1] - done)]))
            out_first[part] = begin[part] + np.maximum(padded[middle] + 1, offset) - offset
            out_last[part] = begin[part] + np.minimum(padded[middle + 1], offset + sizes[part]) - offset
            at = to
        return out_first, out_last

    def _add(self, period: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Stretches of one distance that touch are one."""
        period = np.concatenate((self.period, period))
        first, last = np.concatenate((self.first, first)), np.concatenate((self.last, last))
        order = np.lexsort((first, period))
        period, first, last = period[order], first[order], last[order]
        fresh = np.ones(len(period), bool)
        # Stretches of one distance differ or are the same, so the end before is the furthest end before.
        fresh[1:] = (period[1:] != period[:-1]) | (first[1:] > last[:-1])
        head = np.flatnonzero(fresh)
        self.period, self.first, self.last = period[head], first[head], np.maximum.reduceat(last, head)


def split_words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words without the space between them, length of each word, and the first word of each text."""
    inside = ~IS_SPACE[chunk.data]
    breaks = chunk.offsets[1:-1]
    at = breaks[(breaks > 0) & (breaks < len(inside))]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # A word ends with its text, even if the next text begins with a word.
    begins[at], ends[at - 1] = inside[at], inside[at - 1]
    starts = np.flatnonzero(begins)
    return chunk.data[inside], np.flatnonzero(ends) + 1 - starts, np.searchsorted(starts, chunk.offsets)


def runs_of_chunk(chunk: Chunk, least: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of words, runs and collapsed text of every text of a chunk."""
    data, lengths, firsts = split_words(chunk)
    counts = np.diff(firsts)
    places = np.concatenate(([0], np.cumsum(lengths)))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(places), pa.py_buffer(data)]
    ).dictionary_encode()
    numbers = words.indices.to_numpy().astype(np.int64)
    # Behind every text stands a word that occurs nowhere else, so nothing repeats across texts.
    limits = len(words.dictionary) + np.arange(len(counts))
    catchers = Catchers(least, int(counts.max(initial=0)))
    catchers.append(np.insert(numbers, firsts[1:], limits))
    start, length, period = catchers.runs()
    begins = firsts[:-1] + np.arange(len(counts))
    text = np.searchsorted(begins, start, "right") - 1
    offsets = np.searchsorted(text, np.arange(len(counts) + 1))

    depth = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(depth, start - text + period, 1)
    np.add.at(depth, start - text + length, -1)
    kept = np.cumsum(depth)[:-1] == 0
    left = np.concatenate(([0], np.cumsum(kept)))[firsts]
    sizes = lengths[kept] + 1
    # No space behind the last word of a text.
    sizes[left[1:][np.diff(left) > 0] - 1] -= 1
    joined = np.full(int(sizes.sum()), 32, np.uint8)
    joined[ragged(np.cumsum(sizes) - sizes, lengths[kept])] = data[np.repeat(kept, lengths)]
    bounds = np.concatenate(([0], np.cumsum(sizes)))[left]
    collapsed = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(bounds), pa.py_buffer(joined))
    runs = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.StructArray.from_arrays([pa.array(x) for x in (start - begins[text], length, period)], ["start", "length", "period"]),
    )
    return counts, runs, collapsed.cast(pa.string())


def find_runs(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """Every row with n_words, runs and collapsed.

    Words are whatever stands between ASCII white space, as it is. A run is a stretch of consecutive words with smallest
    period q, at least ``least`` and 2 * q words long, that no neighbouring word extends; ``runs`` lists start, length
    and period by start, then period. ``collapsed`` is the text's words joined by one space, without those that a run
    holds behind its first q words. A null or empty text has no words, no runs and an empty ``collapsed``. Rows are
    independent: repeated rows and null ids stay, and no row is moved. Other columns are carried; one named like a new
    one is replaced. A task holds one batch of about 16 MB of text (or one longer text) and its runs.
    """
    names = [f.name for f in documents.schema if f.name not in ("n_words", "runs", "collapsed")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_batches(batches, "text"):
            parts = [runs_of_chunk(chunk, least) for chunk in text_chunks(batch.column("text"))]
            if parts:
                counts, runs, collapsed = zip(*parts, strict=True)
                yield carried(
                    batch,
                    names,
                    {
                        "n_words": pa.array(np.concatenate(counts), pa.int64()),
                        "runs": pa.concat_arrays(runs),
                        "collapsed": pa.concat_arrays(collapsed),
                    },
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name in names]
    return documents.select(*(f"`{n}`" for n in names)).mapInArrow(
        search, ", ".join([*fields, "n_words bigint", f"runs {RUNS}", "collapsed string"])
    )
