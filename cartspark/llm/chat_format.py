"""Chat formatting at the level of tokens.

Role and text of a turn are encoded separately and spliced between reserved ids, so no merge crosses a boundary and no
text can produce a control token. Control strings inside a text are escaped as well, so the formatted text can be read
back. The loss mask covers the assistant's text tokens; places come from prefix sums of the segments' lengths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartspark.llm.common import CHUNK_BYTES, split_batches
from cartspark.llm.vocabulary import RANKS, encoding, read_ranks


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and further control strings that are escaped where a text contains them.

    A turn is turn_start, role, text_start, text, turn_end. An escape puts a backslash behind the first character of a
    control string; one that already has backslashes there gets one more, so taking one away restores it. For that, the
    first character of a control string must be in no other place of any of them, and a backslash in none.
    """

    # Control strings of common chat formats.
    turn_start: str = "<|im_start|>"
    text_start: str = "<|im_sep|>"
    turn_end: str = "<|im_end|>"
    others: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
    assistant: str = "assistant"

    def __post_init__(self):
        controls = self.controls
        heads = {c[0] for c in controls}
        if any(len(c) < 2 or "\\" in c or heads & set(c[1:]) for c in controls) or len(set(controls)) < len(controls):
            raise ValueError("control strings must differ, and their first characters stand nowhere else in them")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.turn_start, self.text_start, self.turn_end, *self.others)

    @lru_cache(maxsize=8)  # noqa: B019
    def pattern(self, slashes: str) -> regex.Pattern:
        ends = "|".join(f"(?<={regex.escape(c[0])}){slashes}(?={regex.escape(c[1:])})" for c in self.controls)
        return regex.compile(ends)

    def escape(self, text: str) -> str:
        return self.pattern(r"\\*+").sub(lambda m: m.group() + "\\", text)

    def unescape(self, text: str) -> str:
        return self.pattern(r"\\++").sub(lambda m: m.group()[1:], text)

    def text_of(self, ids: np.ndarray, base: int, decode) -> str:
        """Formatted text of token ids; ids from ``base`` on are the three marks."""
        marks = (self.turn_start, self.text_start, self.turn_end)
        parts, run = [], []
        for token in ids.tolist():
            if token >= base:
                parts.append(decode(run))
                parts.append(marks[token - base])
                run = []
            else:
                run.append(token)
        return "".join([*parts, decode(run)])


def format_conversations(
    conversations: DataFrame,
    template: Template = Template(),
    path: str = RANKS,
) -> DataFrame:
    """One row per turn, in the order of its conversation: conv_id, turn, place, n_before, input_ids, loss_mask.

    The conversation's token sequence is its rows' ``input_ids`` joined by ``place``; ``n_before`` counts the tokens
    ahead (the prefix sum). A conversation is never held as a whole: its rows are sorted on disk if need be and pass one
    by one, however many it has. Null role and text are empty; a null conv_id is a conversation of its own; a null turn
    comes first; equal turns are ordered by role and text, repeated rows all stay. Extra columns are not read.
    """
    ranks = conversations.sparkSession.sparkContext.broadcast(read_ranks(path))
    conv_type = conversations.schema["conv_id"].dataType.simpleString()
    turn_type = conversations.schema["turn"].dataType.simpleString()
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks.value)
        base = coder.max_token_value + 1
        for batch in split_batches(batches, "text", CHUNK_BYTES):
            ids, masks = [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                head = coder.encode_ordinary(template.escape(role))
                body = coder.encode_ordinary(template.escape(text))
                ids.append([base, *head, base + 1, *body, base + 2])
                learned = role == template.assistant
                masks.append([False] * (len(head) + 2) + [learned] * len(body) + [False])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "turn", "role", "text")),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(masks, pa.list_(pa.bool_())),
                ],
                names=["conv_id", "turn", "role", "text", "input_ids", "loss_mask"],
            )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number, before = object(), 0, 0
        for batch in batches:
            keys = batch.column("conv_id").to_pylist()
            lengths = np.diff(batch.column("input_ids").offsets.to_numpy())
            places, sums = [], []
            for key, length in zip(keys, lengths.tolist(), strict=True):
                if key != current:
                    current, number, before = key, 0, 0
                places.append(number)
                sums.append(before)
                number, before = number + 1, before + length
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array(places, pa.int64()),
                    pa.array(sums, pa.int64()),
                    batch.column("input_ids"),
                    batch.column("loss_mask"),
                ],
                names=["conv_id", "turn", "place", "n_before", "input_ids", "loss_mask"],
            )

    arrays = "input_ids array<int>, loss_mask array<boolean>"
    encoded = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        encode, f"conv_id {conv_type}, turn {turn_type}, role string, text string, {arrays}"
    )
    return encoded.drop("role", "text").mapInArrow(
        place, f"conv_id {conv_type}, turn {turn_type}, place long, n_before long, {arrays}"
    )


def read_back(formatted: DataFrame, template: Template = Template(), path: str = RANKS) -> DataFrame:
    """Digests of every conversation, from the token ids and masks alone.

    ``formatted`` must hold each conversation's rows together and in order, as format_conversations leaves them.
    Returns conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars and n_tokens.
    """
    ranks = formatted.sparkSession.sparkContext.broadcast(read_ranks(path))
    conv_type = formatted.schema["conv_id"].dataType.simpleString()
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            columns = (batch.column(c) for c in ("conv_id", "n_before", "input_ids", "loss_mask"))
            for key, before, ids, mask in zip(*columns, strict=True):
                yield key.as_py(), before.as_py(), ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks.value)
        base = coder.max_token_value + 1
        decode = lambda ids: coder.decode(list(ids), errors="strict")
        keys, out = [], []
        for key, parts in groupby(rows(batches), key=lambda row: row[0]):
            turns, loss, n_turns, chars, length, tokens = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0
            for _, before, ids, mask in parts:
                if before != tokens:
                    raise ValueError(f"conversation {key} is out of order")
                length += len(template.text_of(ids, base, decode))
                middle = int(np.flatnonzero(ids == base + 1)[0])
                role = template.unescape(decode(ids[1:middle]))
                text = template.unescape(decode(ids[middle + 1 : -1]))
                turns.update(f"{role}\n{text}\n".encode())
                learned = template.unescape(decode(ids[mask]))
                loss.update(learned.encode())
                chars += len(learned)
                n_turns += 1
                tokens += len(ids)
            keys.append(key)
            out.append((n_turns, turns.hexdigest(), chars, loss.hexdigest(), length, tokens))
            if len(out) == 2000:
                yield batch_of(keys, out)
                keys, out = [], []
        if out:
            yield batch_of(keys, out)

    def batch_of(keys: list, out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        ids = pa.array(keys, pa.int64() if conv_type == "bigint" else None)
        return pa.RecordBatch.from_arrays([ids, *arrays], names=["conv_id", *names])

    return formatted.mapInArrow(
        digest,
        f"conv_id {conv_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_tokens long",
    )
