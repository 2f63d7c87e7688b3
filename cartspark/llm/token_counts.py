"""Token counts that follow edits.

A document's pre-tokens (the pieces that no merge crosses) are grouped into leaves, and the leaves into a binary tree whose
nodes hold characters and tokens below them. An edit re-splits and re-encodes only the leaves that it touches, until the
pieces fall on an old leaf boundary again, and updates the sums above them. The leaf before is context only where nothing
but white space lies between it and the edit: a piece looks past its end no further than that.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartspark.llm.common import CHUNK_BYTES, split_batches
from cartspark.llm.vocabulary import RANKS, SPLIT, encoding, read_ranks

# A leaf has the pre-tokens that begin in one stretch of so many characters; after an edit, it closes with the pre-token
# that brings it to as many.
LEAF_CHARACTERS = 128
# Pre-tokens whose counts a task remembers, and the longest that it remembers.
KEPT_PIECES = 200_000
KEPT_LENGTH = 48


class Counter(dict):
    """Tokens of a pre-token; frequent ones are looked up, not encoded."""

    def __init__(self, ranks: bytes):
        super().__init__()
        self.encoder = encoding(ranks)

    def __missing__(self, piece: str) -> int:
        n = len(self.encoder.encode_ordinary(piece))
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = n
        return n

    def count(self, pieces: Sequence[str]) -> int:
        return sum(map(self.__getitem__, pieces))


def leaves_of(text: str, counter: Counter, size: int = LEAF_CHARACTERS) -> list[tuple[int, int]]:
    """(characters, tokens) of consecutive leaves."""
    pieces = SPLIT.findall(text)
    if not pieces:
        return []
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    tokens = np.fromiter(map(counter.__getitem__, pieces), np.int64, len(pieces))
    stretch = (np.cumsum(lengths) - lengths) // size
    heads = np.flatnonzero(np.append(True, stretch[1:] != stretch[:-1]))
    return list(zip(np.add.reduceat(lengths, heads).tolist(), np.add.reduceat(tokens, heads).tolist(), strict=True))


@dataclass
class SegmentTree:
    """Sums over leaves: level 0 has the leaves, each further level the sums of pairs, the last the whole text."""

    levels: list[list[tuple[int, int]]] = field(default_factory=list)

    @classmethod
    def build(cls, leaves: Sequence[tuple[int, int]]) -> SegmentTree:
        tree = cls([list(leaves)])
        tree.update(0)
        return tree

    @property
    def leaves(self) -> list[tuple[int, int]]:
        return self.levels[0]

    @property
    def total(self) -> tuple[int, int]:
        return self.levels[-1][0] if self.leaves else (0, 0)

    def update(self, first: int, last: int | None = None) -> None:
        """Renew the sums above the leaves from ``first`` on, or to ``last`` if no leaf was added or taken away."""
        level = 0
        while len(self.levels[level]) > 1:
            below = self.levels[level]
            if level + 1 == len(self.levels):
                self.levels.append([])
            above = self.levels[level + 1]
            first //= 2
            last = None if last is None else last // 2
            stop = (len(below) + 1) // 2 if last is None else last + 1
            pairs = zip(below[2 * first : 2 * stop : 2], below[2 * first + 1 : 2 * stop : 2])
            sums = [(a + c, b + d) for (a, b), (c, d) in pairs]
            if len(sums) < stop - first:
                sums.append(below[2 * stop - 2])
            if last is None:
                above[first:] = sums
            else:
                above[first:stop] = sums
            level += 1
        del self.levels[level + 1 :]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last one, if it is the end) and where the leaf begins."""
        index, begin = 0, 0
        for level in range(len(self.levels) - 1, 0, -1):
            index *= 2
            below = self.levels[level - 1]
            if index + 1 < len(below) and place >= begin + below[index][0]:
                begin += below[index][0]
                index += 1
        return index, begin


def apply_edit(
    text: str,
    tree: SegmentTree,
    start: int,
    end: int,
    replacement: str,
    counter: Counter,
    size: int = LEAF_CHARACTERS,
) -> tuple[str, int]:
    """Replace text[start:end]; returns the new text and the number of characters that were encoded again.

    ``start`` and ``end`` are moved into the text. A piece may look past its end, over white space to the character
    behind it, so splitting begins one leaf earlier if only that lies between; and a boundary of old leaves counts as
    reached again only where the edit is behind it.
    """
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    new = text[:start] + replacement + text[end:]
    if not tree.leaves:
        tree.levels[:] = SegmentTree.build(leaves_of(new, counter, size)).levels
        return new, len(new)
    first, begin = tree.find(start)
    if first and not text[begin:start].strip():
        first -= 1
        begin -= tree.leaves[first][0]
    last, last_begin = tree.find(end)
    shift = len(replacement) - (end - start)
    # Where old leaves behind the edit begin in the new text.
    boundary = last_begin + tree.leaves[last][0]
    after = last + 1
    fresh, pieces, length, at = [], [], 0, begin
    for match in SPLIT.finditer(new, begin):
        pieces.append(match.group())
        length += len(match.group())
        at = match.end()
        while after < len(tree.leaves) and boundary + shift < at:
            boundary += tree.leaves[after][0]
            after += 1
        joined = after < len(tree.leaves) and boundary + shift == at and boundary > end
        if joined or length >= size:
            fresh.append((length, counter.count(pieces)))
            pieces, length = [], 0
        if joined:
            break
    else:
        after = len(tree.leaves)
    if pieces:
        fresh.append((length, counter.count(pieces)))
    same = len(fresh) == after - first
    tree.levels[0][first:after] = fresh
    if tree.leaves:
        tree.update(min(first, len(tree.leaves) - 1), after - 1 if same else None)
    else:
        tree.levels[:] = [[]]
    return new, at - begin


def count_tokens(
    documents: DataFrame,
    edits: Column | None = None,
    path: str = RANKS,
    leaf_characters: int = LEAF_CHARACTERS,
) -> DataFrame:
    """One row per row of doc_id and text: the tokens of the whole text, before and after its edits.

    ``edits`` is a column of array<struct<first int, last int, replacement string>>, applied in order, each to the text
    that the one before it has left. Returns doc_id, n_chars, n_tokens, n_leaves, n_edits, n_chars_after,
    n_tokens_after and n_encoded (characters encoded for the edits). A null text is empty; null edits are none; an edit
    with a null bound begins at 0 or ends at the end, and a null replacement deletes.
    """
    ranks = documents.sparkSession.sparkContext.broadcast(read_ranks(path))
    kind = "array<struct<first:int,last:int,replacement:string>>"
    column = F.lit(None) if edits is None else edits
    names = ("n_chars", "n_tokens", "n_leaves", "n_edits", "n_chars_after", "n_tokens_after", "n_encoded")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks.value)
        for batch in split_batches(batches, "text", 4 * CHUNK_BYTES):
            out = []
            for text, changes in zip(batch.column("text"), batch.column("_edits"), strict=True):
                text, changes = text.as_py() or "", changes.as_py() or []
                tree = SegmentTree.build(leaves_of(text, counter, leaf_characters))
                before, n_leaves, encoded = tree.total, len(tree.leaves), 0
                for change in changes:
                    change = change or {}
                    first, last = change.get("first") or 0, change.get("last")
                    last = len(text) if last is None else last
                    text, work = apply_edit(
                        text, tree, first, last, change.get("replacement") or "", counter, leaf_characters
                    )
                    encoded += work
                out.append((*before, n_leaves, len(changes), *tree.total, encoded))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", *names]
            )

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", column.cast(kind).alias("_edits")).mapInArrow(
        count, ", ".join([f"doc_id {id_type}", *(f"{n} long" for n in names)])
    )
