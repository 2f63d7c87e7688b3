"""Benchmark decontamination with suffix arrays over the training words.

Each task is a shard: it sorts the suffixes of its documents' words that can begin a match and binary-searches every
benchmark suffix in them, word by word. The ranges found give the longest verbatim matches and their places. No text is
shuffled. The benchmark is sent in blocks of bounded size, a bounded number of them in one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartspark.llm.common import Chunk, Words, carried, shingles, split_batches, stored, text_chunks, words_of

WINDOW = 10
# A match is looked for from each place whose first words are those of some window.
PREFIX = 3
# Text of the benchmark that is sent at once.
BLOCK_BYTES = 8_000_000
# Blocks that are sent in one pass; a larger benchmark takes more passes.
PASS_BLOCKS = 4
_FILTER_BITS = 20

MATCHES = "array<struct<item_id:string,item_word:int,word:int,n_words:int>>"
RESULT = f"n_words long, n_hit long, n_items long, item_ids array<string>, matches {MATCHES}"


@dataclass
class Block:
    """Benchmark items as words, with the suffixes to search and short lists of what windows begin with."""

    ids: list[str]
    words: Words
    item: np.ndarray
    window: np.ndarray
    prefixes: dict[int, np.ndarray]
    filters: dict[int, np.ndarray]

    @classmethod
    def of(cls, ids: list[str], texts: list[str], width: int) -> Block:
        chunk = next(text_chunks(pa.array(texts, pa.large_string()), 1 << 62))
        words = words_of(chunk)
        counts = np.diff(words.offsets)
        item = np.repeat(np.arange(len(ids)), counts)
        left = words.offsets[item + 1] - np.arange(len(item))
        # Words of the window that begins at each suffix; 0 if none does.
        window = np.where(left >= np.minimum(counts[item], width), np.minimum(counts[item], width), 0)
        prefixes, filters = {}, {}
        for k in (1, PREFIX):
            begins = window >= PREFIX if k == PREFIX else (window > 0) & (window < PREFIX)
            if begins.any():
                grams = shingles(words.hashes, k)
                prefixes[k] = np.unique(grams[np.flatnonzero(begins)])
                filters[k] = np.zeros(1 << _FILTER_BITS, dtype=bool)
                filters[k][prefixes[k] & np.uint64((1 << _FILTER_BITS) - 1)] = True
        return cls(ids, words, item, window, prefixes, filters)


def benchmark_blocks(benchmark: DataFrame, width: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of item_id and text, of at most ``block_bytes`` (or one item) each; the driver holds one at a time."""
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = row["text"] or ""
        if ids and size + len(text) > block_bytes:
            yield Block.of(ids, texts, width)
            ids, texts, size = [], [], 0
        ids.append("null" if row["item_id"] is None else str(row["item_id"]))
        texts.append(text)
        size += len(text)
    if ids:
        yield Block.of(ids, texts, width)


def candidates(words: Words, grams: dict[int, np.ndarray], block: Block) -> np.ndarray:
    """Places whose first words begin some window of the block."""
    found = []
    for k, prefixes in block.prefixes.items():
        hashes = grams[k]
        maybe = np.flatnonzero(block.filters[k][hashes & np.uint64((1 << _FILTER_BITS) - 1)])
        at = np.minimum(np.searchsorted(prefixes, hashes[maybe]), len(prefixes) - 1)
        found.append(maybe[prefixes[at] == hashes[maybe]])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def suffix_array(words: Words, places: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The places in order of their suffixes, and the first ``depth`` words of each; 0 stands behind a text's end."""
    text = np.searchsorted(words.offsets, places, "right") - 1
    end = words.offsets[text + 1]
    columns = []
    for i in range(depth):
        at = places + i
        inside = at < end
        columns.append(np.where(inside, words.hashes[np.minimum(at, len(words.hashes) - 1)], np.uint64(0)))
    order = np.lexsort(columns[::-1])
    return places[order], [c[order] for c in columns]


def bound(column: np.ndarray, low: np.ndarray, high: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each value within its own range of a column that is sorted there."""
    low, high = low.copy(), high.copy()
    open_ = low < high
    while open_.any():
        middle = (low + high) // 2
        at = column[np.minimum(middle, len(column) - 1)]
        go = open_ & ((at <= value) if right else (at < value))
        low = np.where(go, middle + 1, low)
        high = np.where(open_ & ~go, middle, high)
        open_ = low < high
    return low


def search(columns: list[np.ndarray], suffixes: Words, item: np.ndarray, depth: int):
    """For every benchmark suffix: how many words of it match somewhere, and the range where its window matches."""
    n = len(item)
    low, high = np.zeros(n, np.int64), np.full(n, len(columns[0]), np.int64)
    end = suffixes.offsets[item + 1]
    ranges = [(low, high)]
    for i in range(depth):
        at = np.arange(n) + i
        value = np.where(at < end, suffixes.hashes[np.minimum(at, n - 1)], np.uint64(0))
        high_here = np.where(at < end, high, low)
        new_low = bound(columns[i], low, high_here, value, False)
        new_high = bound(columns[i], new_low, high_here, value, True)
        low, high = new_low, new_high
        ranges.append((low, high))
    return ranges


def matches(words: Words, block: Block, grams: dict[int, np.ndarray], width: int) -> list[tuple[int, int, int, int]]:
    """Longest matches that hold a whole window: (item, its first word, the shard's first word, words)."""
    places = candidates(words, grams, block)
    if not len(places):
        return []
    order, columns = suffix_array(words, places, width)
    ranges = search(columns, block.words, block.item, width)
    suffix = np.flatnonzero(block.window)
    low = np.zeros(len(suffix), np.int64)
    high = low.copy()
    for k in np.unique(block.window[suffix]):
        here = block.window[suffix] == k
        low[here], high[here] = ranges[k][0][suffix[here]], ranges[k][1][suffix[here]]
    counts = high - low
    suffix, low, counts = suffix[counts > 0], low[counts > 0], counts[counts > 0]
    if not len(suffix):
        return []
    each = np.repeat(np.arange(len(suffix)), counts)
    place = order[np.repeat(low, counts) + np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts)]
    suffix = suffix[each]
    # Neighbouring matches of an item on one diagonal are one longer match.
    text = np.searchsorted(words.offsets, place, "right") - 1
    item, diagonal = block.item[suffix], place - suffix
    by = np.lexsort((place, diagonal, item, text))
    text, item, diagonal, place, suffix = text[by], item[by], diagonal[by], place[by], suffix[by]
    new = np.ones(len(by), dtype=bool)
    new[1:] = (
        (text[1:] != text[:-1])
        | (item[1:] != item[:-1])
        | (diagonal[1:] != diagonal[:-1])
        | (place[1:] != place[:-1] + 1)
    )
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(by)) - 1
    length = place[last] - place[first] + block.window[suffix[last]]
    found = zip(item[first].tolist(), suffix[first].tolist(), place[first].tolist(), length.tolist(), strict=True)
    # Hashes found them; the words themselves decide.
    return [
        match
        for match in found
        if all(words.word(match[2] + i) == block.words.word(match[1] + i) for i in range(match[3]))
    ]


def scan_chunk(chunk: Chunk, blocks: list, width: int) -> list[tuple[int, int, dict]]:
    """Per text: words, hit words, and item ids with their matches."""
    words = words_of(chunk)
    grams = {k: shingles(words.hashes, k) for k in (1, PREFIX)}
    hit = np.zeros(len(words.hashes) + 1, np.int64)
    spans: dict[int, list[dict]] = {}
    for sent in blocks:
        block = sent.value
        for item, item_at, at, length in matches(words, block, grams, width):
            hit[at] += 1
            hit[at + length] -= 1
            text = int(np.searchsorted(words.offsets, at, "right")) - 1
            spans.setdefault(text, []).append(
                {
                    "item_id": block.ids[item],
                    "item_word": item_at - int(block.words.offsets[item]),
                    "word": at - int(words.offsets[text]),
                    "n_words": length,
                }
            )
    total = np.concatenate(([0], np.cumsum(np.cumsum(hit[:-1]) > 0)))
    n_hit = total[words.offsets[1:]] - total[words.offsets[:-1]]
    n_words = np.diff(words.offsets)
    return [(int(n_words[i]), int(n_hit[i]), spans.get(i, [])) for i in range(len(chunk))]


def find_benchmark(
    documents: DataFrame,
    benchmark: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    width: int = WINDOW,
    text: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: the ``carry`` columns, n_words, n_hit, n_items, item_ids and matches.

    A hit word lies in an occurrence of ``width`` consecutive words of an item, or of the whole of a shorter one.
    ``item_ids`` are sorted as strings. ``matches`` are the longest verbatim matches in words from the beginning of
    item and document. Null or empty texts have no words; items without words match nothing; an item without id is
    called null; items that repeat an id count once. A carried column with the name of a result is replaced by it.
    """
    context = documents.sparkSession.sparkContext
    results = [field.split(" ")[0] for field in RESULT.split(", ")]
    names = [c for c in carry if c not in results]
    needed = list(dict.fromkeys([*names, text]))
    # Matches of earlier passes go with their row.
    earlier = "_matches"
    while earlier in needed:
        earlier += "_"
    types = {c: f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in needed}
    span = pa.struct(
        [("item_id", pa.string()), ("item_word", pa.int32()), ("word", pa.int32()), ("n_words", pa.int32())]
    )

    def scan(blocks: list, last: bool):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in split_batches(batches, text):
                rows = [row for chunk in text_chunks(batch.column(text)) for row in scan_chunk(chunk, blocks, width)]
                if earlier in batch.schema.names:
                    before = batch.column(earlier).to_pylist()
                    rows = [(n, covered(old + new), old + new) for (n, _, new), old in zip(rows, before, strict=True)]
                spans = pa.array([r[2] for r in rows], pa.list_(span))
                if not last:
                    yield carried(batch, needed, {earlier: spans})
                    continue
                items = [sorted({s["item_id"] for s in found}) for _, _, found in rows]
                yield carried(
                    batch,
                    names,
                    {
                        "n_words": pa.array([r[0] for r in rows], pa.int64()),
                        "n_hit": pa.array([r[1] for r in rows], pa.int64()),
                        "n_items": pa.array([len(i) for i in items], pa.int64()),
                        "item_ids": pa.array(items, pa.list_(pa.string())),
                        "matches": spans,
                    },
                )

        return search

    blocks = benchmark_blocks(benchmark, width)
    rows, group = documents.select(*(f"`{c}`" for c in needed)), list(islice(blocks, PASS_BLOCKS))
    while following := list(islice(blocks, PASS_BLOCKS)):
        sent = [context.broadcast(block) for block in group]
        schema = ", ".join([*types.values(), f"{earlier} {MATCHES}"])
        rows = stored(rows.mapInArrow(scan(sent, False), schema), "benchmark-pass")
        for block in sent:
            block.destroy()
        group = following
    sent = [context.broadcast(block) for block in group]
    return rows.mapInArrow(scan(sent, True), ", ".join([*(types[c] for c in names), RESULT]))


def covered(spans: list[dict]) -> int:
    """Words that lie in any of the spans."""
    total, end = 0, 0
    for first, last in sorted((s["word"], s["word"] + s["n_words"]) for s in spans):
        total += max(last - max(first, end), 0)
        end = max(end, last)
    return total


def decontaminate(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The documents without a hit word, with their own columns."""
    names = documents.columns
    plain = [f"_{i}" for i in range(len(names))]
    text = plain[names.index("text")]
    clean = find_benchmark(documents.toDF(*plain), benchmark, tuple(plain), width, text).where("n_hit = 0")
    return clean.select(*plain).toDF(*names)
