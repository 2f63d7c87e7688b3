"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is its letters' vectors, each permuted by its place and bound by
multiplication; a text is the bundle (sum) of its n-grams, and a language the bundle of its sample texts. A document
has the language whose prototype has the highest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartspark.llm.common import CHUNK_BYTES, carried, split_batches

DIMENSIONS = 512
ORDER = 3
SEED = 11
UNDETERMINED = "und"
# Sample texts that a prototype is learned from: about so many of a language, chosen by a hash of the id.
SAMPLE_PER_LANGUAGE = 3000
# Languages that the prototypes sent to the executors may have; more is taken for a wrong column.
MAX_LANGUAGES = 10_000
# N-gram vectors that a task keeps.
KEPT_VECTORS = 40_000
_BITS = 21
_SPACE = 32


@cache
def letter_table() -> np.ndarray:
    """For each code point: its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, dtype=np.int64)
    for code in range(0x110000):
        character = chr(code)
        if character.isalpha():
            small = character.lower()
            table[code] = ord(small) if len(small) == 1 else code
    return table


def letters_of(text: str) -> np.ndarray:
    """Lower-case letters as code points; any run of other characters, and either end, is one space."""
    codes = letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate(([0], codes, [0]))
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    keep[0] = True
    codes = codes[keep]
    codes[codes == 0] = _SPACE
    return codes


@dataclass
class Encoder:
    """Vectors of n-grams, made when first needed."""

    dimensions: int = DIMENSIONS
    order: int = ORDER
    seed: int = SEED
    letters: dict = field(default_factory=dict)
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    vectors: np.ndarray | None = None

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) >= KEPT_VECTORS:
                self.letters.clear()
            draw = np.random.default_rng([self.seed, code])
            self.letters[code] = draw.integers(0, 2, self.dimensions).astype(np.int8) * 2 - 1
        return self.letters[code]

    def make(self, keys: np.ndarray) -> np.ndarray:
        """Bind the letters of each key, the earlier ones permuted more often."""
        out = np.ones((len(keys), self.dimensions), np.int8)
        for place in range(self.order):
            codes = (keys >> (_BITS * place)) & ((1 << _BITS) - 1)
            found, at = np.unique(codes, return_inverse=True)
            out *= np.stack([np.roll(self.letter(int(c)), place) for c in found])[at]
        return out

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct keys."""
        if len(keys) > KEPT_VECTORS // 4:
            return self.make(keys)
        if self.vectors is None or len(self.keys) > KEPT_VECTORS:
            self.keys, self.vectors = keys, self.make(keys)
            return self.vectors
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        new = keys[self.keys[at] != keys]
        if len(new):
            joined = np.concatenate((self.keys, new))
            order = np.argsort(joined)
            self.vectors = np.concatenate((self.vectors, self.make(new)))[order]
            self.keys = joined[order]
            at = np.searchsorted(self.keys, keys)
        return self.vectors[at]

    def bundle(self, text: str) -> np.ndarray | None:
        """The sum of a text's n-gram vectors, in pieces of bounded size; None without a letter."""
        return self.bundle_and_count(text)[0]

    def bundle_and_count(self, text: str) -> tuple[np.ndarray | None, int]:
        """The same, and the number of distinct n-grams."""
        codes = letters_of(text)
        if len(codes) < 2 or not (codes != _SPACE).any():
            return None, 0
        if len(codes) < self.order:
            codes = np.concatenate((codes, np.full(self.order - len(codes), _SPACE)))
        n = len(codes) - self.order + 1
        keys = np.zeros(n, np.int64)
        for place in range(self.order):
            keys = (keys << _BITS) | codes[place : place + n]
        found, counts = np.unique(keys, return_counts=True)
        total = np.zeros(self.dimensions, np.float64)
        for i in range(0, len(found), KEPT_VECTORS // 8):
            part = slice(i, i + KEPT_VECTORS // 8)
            total += counts[part].astype(np.float32) @ self.lookup(found[part]).astype(np.float32)
        return total, len(found)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text has remainder ``fold``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


@dataclass
class Prototypes:
    """Learned languages in order, and their bundled vectors, each of length 1."""

    languages: list[str]
    vectors: np.ndarray
    dimensions: int
    order: int
    seed: int


def learn_prototypes(
    examples: DataFrame,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    dimensions: int = DIMENSIONS,
    order: int = ORDER,
    seed: int = SEED,
) -> Prototypes:
    """Bundle the texts of each language of doc_id, text and lang.

    Rows with a null text or lang teach nothing. Of a language with more than ``sample_per_language`` rows about so many
    are taken, by a hash of the id; of a language with fewer, all. Every text weighs the same however long it is.
    """
    spark = examples.sparkSession
    known = examples.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in lang")
    if not sizes:
        return Prototypes([], np.zeros((0, dimensions)), dimensions, order, seed)
    rates = spark.createDataFrame(
        [(row["lang"], min(1.0, sample_per_language / row["count"])) for row in sizes],
        "lang string, _rate double",
    )
    point = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000)) / 1_000_000
    sample = known.join(F.broadcast(rates), "lang").where(point < F.col("_rate")).select("lang", "text")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = Encoder(dimensions, order, seed), {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                vector = encoder.bundle(text.as_py())
                if vector is not None and (length := np.linalg.norm(vector)):
                    sums[lang.as_py()] = sums.get(lang.as_py(), 0) + vector / length
        if sums:
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame({"lang": list(sums), "vector": [v.tolist() for v in sums.values()]}),
                preserve_index=False,
            )

    parts = sample.mapInArrow(bundle, "lang string, vector array<double>")
    sums = (
        parts.select("lang", F.posexplode("vector").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .groupBy("lang")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("vector"))
    )
    rows = sorted(sums.collect(), key=lambda row: row["lang"])
    vectors = np.array([row["vector"] for row in rows]).reshape(len(rows), dimensions)
    # Rounded, so that the order of the sums above does not show.
    vectors = np.round(vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12), 9)
    return Prototypes([row["lang"] for row in rows], vectors, dimensions, order, seed)


def predict_language(documents: DataFrame, prototypes: Prototypes, count: str | None = None) -> DataFrame:
    """Adds lang_pred and score (the cosine, at least 0) to every row from its whole text alone.

    A null text, a text without a letter, or no prototype at all gives ``und`` and 0. Of two equal cosines the language
    first in order wins. Columns named lang_pred and score are replaced, and that named ``count``, if it is given: the
    number of distinct n-grams that the score rests on.
    """
    sent = documents.sparkSession.sparkContext.broadcast(prototypes)
    names = [c for c in documents.columns if c not in ("lang_pred", "score", count)]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        encoder = Encoder(known.dimensions, known.order, known.seed)
        for batch in split_batches(batches, "text", 4 * CHUNK_BYTES):
            languages, scores, counts = [], [], []
            for text in batch.column("text"):
                vector, n = encoder.bundle_and_count(text.as_py()) if text.is_valid and known.languages else (None, 0)
                counts.append(n)
                length = 0.0 if vector is None else float(np.linalg.norm(vector))
                if not length:
                    languages.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                cosines = known.vectors @ (vector / length)
                best = int(np.argmax(np.round(cosines, 12)))
                languages.append(known.languages[best])
                scores.append(float(min(max(cosines[best], 0.0), 1.0)))
            results = {"lang_pred": pa.array(languages, pa.string()), "score": pa.array(scores, pa.float64())}
            yield carried(batch, names, results | ({count: pa.array(counts, pa.int64())} if count else {}))

    schema = ", ".join(
        [*(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in names), "lang_pred string", "score double"]
        + ([f"`{count}` long"] if count else [])
    )
    return documents.select(*names).mapInArrow(predict, schema)


def identify_languages(documents: DataFrame, count: str | None = None, **parameters) -> DataFrame:
    """Learn from the rows that are not held out, then predict every row."""
    examples = documents.where(~held_out(F.col("doc_id")))
    return predict_language(documents, learn_prototypes(examples, **parameters), count)
