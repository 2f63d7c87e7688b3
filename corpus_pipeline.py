"""A training corpus from raw documents: language, near duplicates, repeated passages, benchmark leaks, mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartspark.llm.common import stored
from cartspark.llm.decontamination import decontaminate
from cartspark.llm.language_id import UNDETERMINED, identify_languages
from cartspark.llm.minhash_dedup import near_duplicates
from cartspark.llm.mixing import mix_sources
from cartspark.llm.suffix_dedup import remove_repeats

# Words of a benchmark item.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# The cosine of clean text with its language grows with about the root of its distinct n-grams, and with few of them it
# can be as low as that of noise. What a document needs is this, less the share FEW_NGRAMS of its n-grams: nothing with
# as few or fewer, near all of it with many.
LEAST_SCORE = 0.1
FEW_NGRAMS = 64
# A benchmark item of fewer words says nothing about a document that has them, and is not looked for.
LEAST_ITEM_WORDS = 3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language, as far as their length can tell; it becomes the lang of those without one."""
    judged = identify_languages(docs.select(*COLUMNS), "n_grams")
    known = F.col("score") >= LEAST_SCORE * (1 - FEW_NGRAMS / F.greatest("n_grams", F.lit(1)))
    kept = judged.where((F.col("lang_pred") != UNDETERMINED) & known)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    dropped = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages that an earlier one has; of a character that is cut in two nothing stays."""
    kept = remove_repeats(docs, carry=("lang", "source"), texts=True)
    return kept.select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars")
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item of ``LEAST_ITEM_WORDS`` words or more."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where(F.regexp_count("text", F.lit(WORD)) >= LEAST_ITEM_WORDS)
    return decontaminate(docs.select(*COLUMNS), items)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus: texts that the mix takes, with their whole passes and the numbered word ranges taken once more.

    A document's words are its ``text`` once for each of ``passes``, and those in the ranges [first, last) of ``blocks``;
    together they are ``taken`` words.
    """
    return mix_sources(docs, carry=("text", "lang")).where("taken > 0")


STAGES = [
    ("language_id", language_id),
    ("minhash_dedup", minhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# Order MinHash and language profiles have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each on the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
