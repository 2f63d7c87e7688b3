"""One query for each training-data operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartspark.llm.chat_format import format_conversations, read_back
from cartspark.llm.decontamination import find_benchmark
from cartspark.llm.embedding_dedup import link_embeddings
from cartspark.llm.html_extraction import extract_text
from cartspark.llm.language_id import held_out, identify_languages
from cartspark.llm.minhash_dedup import near_duplicates
from cartspark.llm.mixing import mix_sources
from cartspark.llm.periodic_runs import find_runs
from cartspark.llm.prefix_trie import prefix_trie, turn_digests
from cartspark.llm.suffix_dedup import remove_repeats
from cartspark.llm.token_counts import count_tokens
from cartspark.llm.top_products import top_products, usable
from cartspark.llm.url_filter import filter_urls


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_benchmark(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return link_embeddings(table(spark, folder, "embeddings"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's tokens; then after two edits: its middle character doubled, and its first tenth cut out."""
    edits = F.array(
        F.struct(
            F.floor(F.length("text") / 2).cast("int").alias("first"),
            F.floor(F.length("text") / 2).cast("int").alias("last"),
            F.expr("substring(text, int(length(text) div 2) + 1, 1)").alias("replacement"),
        ),
        F.struct(
            F.lit(0).alias("first"),
            F.floor(F.length("text") / 10).cast("int").alias("last"),
            F.lit("").alias("replacement"),
        ),
    )
    return count_tokens(table(spark, folder, "documents"), edits)


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    urls = table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(urls).select("page_id", "host", "path", "rule", "verdict")


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    example = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(rows.unionByName(example))).drop("n_tokens")


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return identify_languages(documents).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """Documents of which a tenth, chosen by a checksum of their id, repeat a few words from some place on."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = documents.withColumn("checksum", checksum).withColumn(
        "words", F.when(F.col("checksum") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))
    )
    n, g = F.size("words"), F.floor(F.col("checksum") / 10)
    placed = chosen.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, (g % F.col("n")).cast("int")))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    repeated = F.flatten(
        F.array_repeat(
            F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
        )
    )
    changed = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), F.col("n") - F.col("a")))
    return placed.select(
        "doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text")
    )


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = find_runs(with_planted_periods(table(spark, folder, "documents").select("doc_id", "text")))
    longest = F.array_max(
        F.transform(
            "runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))
        )
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.n").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(F.col("longest.n") * 1000 / -F.col("longest.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector, in steps of 1/256."""
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    whole = F.when(usable(F.col("vector")), F.transform("vector", lambda x: F.floor(x * 256)))
    return top_products(rows.select("vec_id", whole.alias("vector")), F.col("vec_id") % 50 == 0)


def with_shared_beginnings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations that begin like another one, and the ids of all, for some are left without turns.

    A checksum of its id says how many first turns a conversation takes from the one whose id is the multiple of five
    before it, in place of as many of its own.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "digest")
    numbered = turns.where("conv_id IS NOT NULL").withColumn("turn", F.row_number().over(order).cast("long"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    ids = turns.where("conv_id IS NOT NULL").select("conv_id").distinct().withColumn("shared", shared)
    of_base = ids.select("conv_id", "shared", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    taken = of_base.join(
        numbered.where("turn <= 8").withColumnRenamed("conv_id", "base"), "base"
    ).where("turn <= shared").select("conv_id", "turn", "digest", "n_bytes")
    own = numbered.where(F.col("turn") > shared).select("conv_id", "turn", "digest", "n_bytes")
    return taken.unionByName(own), ids.select("conv_id")


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = turn_digests(table(spark, folder, "conversations"))
    return prefix_trie(*with_shared_beginnings(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_mixing": op4_mixing,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_html_extraction": op7_html_extraction,
    "op8_url_filter": op8_url_filter,
    "op9_chat_format": op9_chat_format,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_exact_topk": op12_exact_topk,
    "op13_prefix_trie": op13_prefix_trie,
}
