"""Mix sources to target weights: Sainte-Lague quotas of equal-token blocks, then seeded choice of the blocks.

DataFrame functions only. Words are the tokens. The documents of a source are dealt to shards and laid end to end, in
an order drawn from the seed; every ``block_words`` words of a shard are a block. The blocks of the mix are given to the
sources by highest quotients target / (2 j + 1), and those of a source to its shards likewise. A shard then takes all of
its blocks as often as the quota allows, and of the rest the blocks that a seeded even spread picks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartspark.llm.common import stored

# What separates words: space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
BLOCK_WORDS = 16
SHARD_DOCUMENTS = 20_000
SEED = 7


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Targets of (source, source_size): the total by weight, each at most ``max_repeats`` times its source's size.

    Sources by code point, null last, weigh ``weights``, repeating. What a source may not take goes to the others by
    weight until none is above. That is one level: with sources in order of cap / weight, the first k are at their
    caps and the rest take level * weight. There is one row per source, so its windows run in one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(max_repeats))
    rows = sources.select(
        "source", "source_size", F.col("source_size").cast("double").alias("_size"), weight.alias("_weight"), cap.alias("_cap")
    )
    order = [F.col("_cap") / F.col("_weight"), F.col("source").isNull(), F.col("source")]
    everything = Window.partitionBy()
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    passed = F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    # The level if all sources before this one, and no other, are at their caps.
    level = (F.sum("_size").over(everything) - capped) / (F.sum("_weight").over(everything) - passed)
    rows = rows.withColumn("_level", level)
    fits = F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level"))
    first = F.first(fits, ignorenulls=True).over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return rows.select(
        "source",
        "source_size",
        F.least(F.coalesce(first * F.col("_weight"), F.col("_cap")), F.col("_cap")).alias("target"),
    )


def sainte_lague(votes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Seats by highest quotients vote / (2 j + 1); adds ``quota``.

    ``votes`` has _key, _vote, _seats (the same in a group of ``by``) and _most, a row's highest quota. A divisor d
    gives a row round(vote / d) seats, at most half a seat from vote / d; so total / (seats + n / 2) and total / (seats -
    n / 2) for n rows bound every quota. Only the seats between, about 2 n, are ranked one by one.
    """
    group = Window.partitionBy(*by)
    total, n, seats = F.sum("_vote").over(group), F.count(F.lit(1)).over(group), F.col("_seats")
    share = F.when(total > 0, F.col("_vote") / total).otherwise(0.0)
    low = F.greatest(F.floor(share * (seats - n / 2) + 0.5) - 1, F.lit(0))
    high = F.floor(share * (seats + n / 2) + 0.5) + 1
    bounded = votes.withColumn("_low", F.least(low, F.col("_most")).cast("long")).withColumn(
        "_high", F.when(F.col("_vote") > 0, F.least(high, F.col("_most"))).otherwise(0).cast("long")
    )
    bounded = bounded.withColumn("_left", (seats - F.sum("_low").over(group)).cast("long"))
    seat = F.explode(F.sequence(F.col("_low"), F.col("_high") - 1))
    ranked = bounded.where("_high > _low").select(*by, "_key", "_left", "_vote", seat.alias("_seat"))
    best = Window.partitionBy(*by).orderBy(F.desc(F.col("_vote") / (2 * F.col("_seat") + 1)), "_key", "_seat")
    won = (
        ranked.withColumn("_rank", F.row_number().over(best))
        .where("_rank <= _left")
        .groupBy(*by, "_key")
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    joined = bounded.alias("b").join(
        won.alias("w"),
        [F.col(f"b.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (*by, "_key")],
        "left",
    )
    return joined.select("b.*", (F.col("_low") + F.coalesce("_won", F.lit(0))).alias("quota")).drop(
        "_low", "_high", "_left"
    )


def blocks_before(block: Column) -> Column:
    """How many blocks before this one are chosen."""
    ahead = block * F.col("_rest") + F.col("_start")
    return F.floor(ahead / F.col("_blocks"))


def taken_before(place: Column, block_words: int) -> Column:
    """Words among the first ``place`` of a shard that lie in chosen blocks.

    Block i is chosen where floor((i + 1) r + o) / n) exceeds floor((i r + o) / n): r of n blocks, spread evenly from a
    seeded start o, so the count of chosen blocks before any block needs no list of them.
    """
    block = F.floor(place / block_words).cast("long")
    inside = (blocks_before(block + 1) - blocks_before(block)) * (place - block * block_words)
    return (blocks_before(block) * block_words + inside).cast("long")


def mix_sources(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_documents: int = SHARD_DOCUMENTS,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``documents``: doc_id, source, size, source_size, target, taken, passes, blocks.

    ``carry`` names columns of ``documents`` to return behind these, such as the text that the word ranges number.

    ``taken`` counts the words that the mix takes of the document, repeats counted: ``passes`` times the whole
    document, and what lies in ``blocks``, the numbered word ranges [first, last) taken once more. A null or empty text
    has size 0 and is taken 0 times. Null is a source like any other, last in order. Rows that repeat an id are
    documents of their own. Without documents there are no rows. Only doc_id, text and source are read.
    """
    numbered = [F.monotonically_increasing_id().alias("_row"), *carry] if carry else []
    sized = stored(
        documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), *numbered), "mix-sizes"
    )
    # What is carried goes neither through windows nor sorts; it is joined in the end, by numbers that the table fixes.
    carried, sized = sized.select(*(["_row", *carry] if carry else [])), sized.select(
        "doc_id", "source", "size", *(["_row"] if carry else [])
    )
    rows = sized.count()
    shards = max(1, -(-rows // shard_documents))
    sized = sized.withColumn(
        "_shard", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(shards)).cast("int")
    )
    cells = stored(
        sized.groupBy("source", "_shard").agg(F.sum("size").alias("_size")), "mix-shards"
    )
    sources = cells.groupBy("source").agg(F.sum("_size").alias("source_size"))
    targets = source_targets(sources, weights, max_repeats)
    everything = Window.partitionBy()
    most = F.ceil(F.col("source_size") / block_words) * max_repeats
    source_votes = targets.select(
        "*",
        F.struct(F.col("source").isNull(), F.col("source")).alias("_key"),
        F.col("target").alias("_vote"),
        F.round(F.sum("target").over(everything) / block_words).cast("long").alias("_seats"),
        most.cast("long").alias("_most"),
    )
    quotas = stored(
        sainte_lague(source_votes).select("source", "source_size", "target", "quota"), "mix-quotas"
    )
    shard_votes = cells.alias("c").join(
        quotas.alias("q"), F.col("c.source").eqNullSafe(F.col("q.source"))
    ).select(
        "c.source",
        "source_size",
        "target",
        F.col("_shard").alias("_key"),
        F.col("_size").cast("double").alias("_vote"),
        F.col("quota").alias("_seats"),
        F.ceil(F.col("_size") / block_words).cast("long").alias("_blocks"),
        (F.ceil(F.col("_size") / block_words) * max_repeats).cast("long").alias("_most"),
    )
    by_shard = sainte_lague(shard_votes, ("source",)).select(
        "source",
        "source_size",
        "target",
        F.col("_key").alias("_shard"),
        "_blocks",
        F.floor(F.try_divide("quota", "_blocks")).alias("_passes"),
        F.expr("try_mod(quota, _blocks)").alias("_rest"),
        F.expr(f"try_mod(abs(xxhash64(source, _key, {int(seed)}) >> 1), _blocks)").alias("_start"),
    )
    by_shard = stored(by_shard, "mix-shard-quotas")
    placed = sized.withColumn(
        "_end",
        F.sum("size").over(
            Window.partitionBy("source", "_shard")
            .orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "size")
            .rowsBetween(Window.unboundedPreceding, 0)
        ),
    ).withColumn("_begin", F.col("_end") - F.col("size"))
    joined = placed.alias("d").join(
        by_shard.alias("s"),
        F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d._shard") == F.col("s._shard")),
    )
    once = taken_before(F.col("_end"), block_words) - taken_before(F.col("_begin"), block_words)
    taken = F.when(F.col("size") > 0, F.col("_passes") * F.col("size") + once).otherwise(0)
    numbers = F.sequence(
        F.floor(F.col("_begin") / block_words), F.floor((F.col("_end") - 1) / block_words)
    )
    chosen = F.transform(
        F.filter(numbers, lambda b: blocks_before(b + 1) > blocks_before(b)),
        lambda b: F.struct(
            b.alias("block"),
            (F.greatest(b * block_words, F.col("_begin")) - F.col("_begin")).alias("first"),
            (F.least((b + 1) * block_words, F.col("_end")) - F.col("_begin")).alias("last"),
        ),
    )
    mixed = joined.select(
        "d.doc_id",
        "d.source",
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        F.when(F.col("size") > 0, F.col("_passes")).otherwise(0).cast("int").alias("passes"),
        F.when(F.col("size") > 0, chosen).alias("blocks"),
        *(["d._row"] if carry else []),
    )
    if not carry:
        return mixed
    # The rows without texts are the side that is held, a partition at a time; texts pass by.
    # Row numbers are high and low bits with gaps between, which a hash table of single numbers holds badly: two keys.
    part = F.shiftright("_row", 33).alias("_part")
    whole = carried.select("*", part).join(mixed.select("*", part).hint("shuffle_hash"), ["_row", "_part"])
    return whole.select(*(c for c in mixed.columns if c != "_row"), *carry)
