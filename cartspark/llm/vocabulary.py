"""Public tokenizer vocabularies: read by the driver and sent to the executors as bytes."""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import regex
import tiktoken

# Where the rank file lies; a parameter of every operator that encodes.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# A vocabulary is sent whole, so its file may have so many bytes.
MAX_FILE_BYTES = 64_000_000

# The pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SPLIT = regex.compile(PATTERN)


def read_ranks(path: str = RANKS) -> bytes:
    if Path(path).stat().st_size > MAX_FILE_BYTES:
        raise ValueError(f"{path} is too large to be sent to every executor")
    return Path(path).read_bytes()


@lru_cache(maxsize=2)
def encoding(ranks: bytes) -> tiktoken.Encoding:
    """Byte-level encoder of a rank file's bytes; it has no special tokens, so any text is ordinary text."""
    merges = {
        base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)
    }
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
