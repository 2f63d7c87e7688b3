"""Near-duplicate documents by order MinHash, verified by banded alignment.

The items of a document are its shingles of five words, each labelled with how often it has occurred before, so that all
differ. A sketch keeps the few items of smallest hash in the order of the text; two texts agree on a sketch if they share
these items in this order, which follows edit similarity. Documents that agree on a sketch are candidates. Their words are
then aligned within a band, and they are linked if the aligned words are 80 % or more of all words of both, an aligned pair
counted once. The alignment is the longest common sequence of words, and the band holds every alignment of that similarity.

Documents with the same words are one class from the start. In a group that agrees on a sketch every member first meets a few
centres of the group; what these have linked need not be compared again. Then every pair of the group that no link
connects yet is aligned, so that the classes are those of all candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartspark.llm.common import CHUNK_BYTES, Words, mix, powers, shingles, split_batches, stored, text_chunks, words_of
from cartspark.llm.components import connected_components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SKETCHES = 20
ITEMS = 3
# Times that members which met a centre in vain are gathered anew around another one.
ROUNDS = 3
# Groups of at most so many are compared pair by pair, larger ones in blocks: about so many members on either side, with
# the square of that as words, and so many of their common words at a time.
PAIRED = 32
BLOCK = 1024
BLOCK_WORDS = 2048
SEED = 3
# Words of one text that are aligned at a time, and bands that are tried before the widest.
ALIGNED_ROWS = 1024
BANDS = (256, 4096)

# Low bits of a drawn number that hold an item's place; a longer run of items takes as many as it needs.
_PLACE_BITS = 24


def label_repeats(items: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The items; those that an earlier one of the same text equals are hashed with the number of these."""
    keyed = mix(items + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(keyed, kind="stable")
    new = np.append(True, keyed[order][1:] != keyed[order][:-1]) if len(order) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    later = rank > 0
    items = items.copy()
    items[order[later]] = mix(items[order[later]] + rank[later].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return items


def item_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled shingles of every text, and where each text's begin. A shorter text is one shingle."""
    counts = np.diff(words.offsets)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    grams = shingles(words.hashes, k)
    text = np.repeat(np.arange(len(counts)), sizes)
    place = words.offsets[text] + np.arange(len(text)) - offsets[text]
    items = np.zeros(len(text), np.uint64)
    full = counts[text] >= k
    items[full] = grams[place[full]]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        run = words.hashes[words.offsets[i] : words.offsets[i + 1]]
        items[offsets[i]] = mix(np.array([(run * powers(len(run))).sum()], np.uint64) + np.uint64(len(run)))[0]
    return label_repeats(items, text), offsets


def sketches_of(items: np.ndarray, offsets: np.ndarray, sketches: int, size: int, seed: int = SEED) -> np.ndarray:
    """One key a sketch for each text that has items: its ``size`` smallest items, chained in the order of the text."""
    filled = np.flatnonzero(np.diff(offsets))
    starts = offsets[filled]
    mask = np.uint64((1 << max(_PLACE_BITS, len(items).bit_length())) - 1)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    place = np.arange(len(items), dtype=np.uint64)
    salts = mix(np.arange(1, sketches + 1, dtype=np.uint64) + np.uint64(seed * 1000))
    out = np.zeros((len(filled), sketches), np.uint64)
    for s in range(sketches):
        drawn = (mix(items ^ salts[s]) & ~mask) | place
        chosen = np.zeros((len(filled), size), np.int64)
        for i in range(size):
            least = np.minimum.reduceat(drawn, starts)
            at = (least & mask).astype(np.int64)
            # A text with fewer items repeats its last.
            chosen[:, i] = np.where(least == top, chosen[:, i - 1], at) if i else at
            drawn[chosen[:, i]] = top
        chosen.sort(axis=1)
        key = np.full(len(filled), salts[s])
        for i in range(size):
            key = mix(key * np.uint64(0x9FB21C651E98DF25) + items[chosen[:, i]])
        out[:, s] = key
    return out


def word_masks(words: list[int], places: dict[int, np.ndarray], first: int, last: int) -> dict[int, int]:
    """For each word a number whose bits are its places in [first, last)."""
    masks = {}
    for word in set(words):
        at = places[word]
        at = at[slice(*np.searchsorted(at, (first, last)))] - first
        if len(at) < 64:
            mask = 0
            for place in at.tolist():
                mask |= 1 << place
        else:
            bits = np.zeros(last - first, np.uint8)
            bits[at] = 1
            mask = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        masks[word] = mask
    return masks


def banded_common(a: np.ndarray, b: np.ndarray, before: int, behind: int) -> int:
    """Length of a common sequence of a and b, the longest of those that match j only with places j - before to j + behind.

    One row of the alignment is a number with a bit for each place of the band, zero where the length rises; a sum carries
    a match to the next rise. Every word of b must be in a.
    """
    order = np.argsort(a, kind="stable")
    values, heads = np.unique(a[order], return_index=True)
    places = dict(zip(values.tolist(), np.split(order, heads[1:]), strict=True))
    rows, found, first, last, row = b.tolist(), 0, 0, 0, 0
    for at in range(0, len(rows), ALIGNED_ROWS):
        some = rows[at : at + ALIGNED_ROWS]
        start, stop = min(max(at - before, 0), len(a)), min(at + len(some) + behind, len(a))
        # Places that leave the band keep their rises, those that enter have none.
        gone = start - first
        found += gone - (row & ((1 << gone) - 1)).bit_count()
        row = (row >> gone) | (((1 << (stop - last)) - 1) << (last - start))
        first, last = start, stop
        masks, whole = word_masks(some, places, first, last), (1 << (last - first)) - 1
        for word in some:
            if match := row & masks[word]:
                row = ((row + match) | (row - match)) & whole
    return found + (last - first) - row.bit_count()


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Aligned words over all words of two sequences, an aligned pair counted once; 0 if that is below ``least``.

    The first band whose alignment reaches ``least`` is taken, so that beyond it the value may be too small.
    """
    na, nb = len(a), len(b)
    if not na or not nb or min(na, nb) < least * max(na, nb):
        return 0.0
    # Equal beginnings and ends are aligned as they are.
    n = min(na, nb)
    differs = np.flatnonzero(a[:n] != b[:n])
    head = int(differs[0]) if len(differs) else n
    differs = np.flatnonzero(a[na - n + head :][::-1] != b[nb - n + head :][::-1])
    tail = int(differs[0]) if len(differs) else n - head
    a, b = a[head : na - tail], b[head : nb - tail]
    found = head + tail
    need = int(np.ceil(least * (na + nb) / (1 + least) - 1e-9)) - found
    if len(a) and len(b):
        # Words of one side alone are never aligned.
        values, place = np.unique(np.concatenate((a, b)), return_inverse=True)
        in_a, in_b = place[: len(a)], place[len(a) :]
        count_a, count_b = (np.bincount(p, minlength=len(values)) for p in (in_a, in_b))
        if np.minimum(count_a, count_b).sum() < need:
            return 0.0
        a, b = in_a[count_b[in_a] > 0], in_b[count_a[in_b] > 0]
        # No more than the rest of either side can be skipped, so the widest band holds all that is sought.
        before, behind = len(b) - max(need, 0), len(a) - max(need, 0)
        common = 0
        for band in (*BANDS, max(before, behind)):
            common = banded_common(a, b, min(band, before), min(band, behind)) if len(a) and len(b) else 0
            if band >= max(before, behind) or (need > 0 and common >= need):
                break
        found += common
    similarity = found / (na + nb - found)
    return similarity if similarity >= least else 0.0


def sketch_documents(documents: DataFrame, k: int, sketches: int, size: int) -> DataFrame:
    """doc_id, print_a, print_b (of all words in order), n_words and keys of every document that has words and an id."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_batches(batches, "text"):
            for chunk in text_chunks(batch.column("text")):
                words = words_of(chunk)
                items, offsets = item_hashes(words, k)
                filled = np.flatnonzero(np.diff(words.offsets))
                if not len(filled):
                    continue
                keys = sketches_of(items, offsets, sketches, size)
                place = np.arange(len(words.hashes)) - np.repeat(words.offsets[:-1], np.diff(words.offsets))
                starts = words.offsets[filled]
                chained = words.hashes * powers(int(place.max()) + 1)[place]
                first = mix(np.add.reduceat(chained, starts))
                second = mix(np.add.reduceat(mix(chained + np.uint64(1)), starts))
                ids = batch.column("doc_id").slice(chunk.first, len(chunk)).take(pa.array(filled))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(first.view(np.int64)),
                        pa.array(second.view(np.int64)),
                        pa.array(np.diff(words.offsets)[filled], pa.int32()),
                        pa.ListArray.from_arrays(
                            np.arange(0, keys.size + 1, sketches, dtype=np.int32), pa.array(keys.ravel().view(np.int64))
                        ),
                    ],
                    names=["doc_id", "print_a", "print_b", "n_words", "keys"],
                )

    return documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sketch, "doc_id long, print_a long, print_b long, n_words int, keys array<long>"
    )


def fetch_words(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and words (32 bits each) of the documents whose ids are in ``wanted``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_batches(batches, "text", 4 * CHUNK_BYTES):
            out = []
            for chunk in text_chunks(batch.column("text")):
                words = words_of(chunk)
                short = (words.hashes >> np.uint64(32)).astype(np.uint32)
                out += [short[a:b].tobytes() for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "words"]
            )

    rows = documents.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id", "left_semi")
    # One row an id: a table that repeats an id has one of its texts compared.
    return rows.mapInArrow(hashed, "doc_id long, words binary").groupBy("doc_id").agg(F.min("words").alias("words"))


def aligned(pairs: DataFrame, sequences: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) whose sequences reach the similarity."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                aligned_similarity(*(np.frombuffer(x.as_py(), np.uint32) for x in pair), similarity) >= similarity
                for pair in zip(batch.column("x"), batch.column("y"), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sequences.select(F.col("doc_id").alias("a"), F.col("words").alias("x"))
    right = sequences.select(F.col("doc_id").alias("b"), F.col("words").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def open_groups(classes: DataFrame, components: DataFrame) -> DataFrame:
    """Members of the groups that have more than one component, with their group's size, weight and largest component."""
    group = ["sketch", "key"]
    named = classes.join(components, F.col("doc_id") == F.col("node"), "left")
    members = named.select("doc_id", "n_words", F.coalesce("component", "doc_id").alias("part"), F.posexplode("keys").alias(*group))
    parts = members.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("weight"))
    groups = parts.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.max(F.struct("n", "part")).alias("home"), F.count(F.lit(1)).alias("parts")
    )
    return members.join(groups.where("parts > 1").select(*group, "n", "weight", F.col("home.part").alias("home")), group)


def open_pairs(held: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different components of a small group whose sizes allow the similarity."""
    group = ["sketch", "key"]
    x = held.select(*group, F.col("doc_id").alias("a"), F.col("n_words").alias("a_words"), F.col("part").alias("a_part"))
    y = held.select(*group, F.col("doc_id").alias("b"), F.col("n_words").alias("b_words"), F.col("part").alias("b_part"))
    met = x.join(y, group).where("a < b and a_part <> b_part")
    return met.where(F.least("a_words", "b_words") >= similarity * F.greatest("a_words", "b_words")).select("a", "b").distinct()


def block_links(left: list[tuple], right: list[tuple], least: float) -> Iterator[tuple[int, int]]:
    """Links between two blocks of (doc_id, part, home, words) that join components; those joined are not compared again."""
    ids, ids_b = (np.array([row[0] for row in side], np.int64) for side in (left, right))
    parts, parts_b = (np.array([row[1] for row in side], np.int64) for side in (left, right))
    n, n_b = (np.array([len(row[3]) for row in side]) for side in (left, right))
    sides = [[np.sort(label_repeats(row[3].astype(np.uint64), np.zeros(1))) for row in side] for side in (left, right)]
    shared = np.intersect1d(*(np.concatenate(side) for side in sides))
    found = []
    for side in sides:
        words, at = np.concatenate(side), np.repeat(np.arange(len(side)), [len(own) for own in side])
        place = np.searchsorted(shared, words)
        known = np.flatnonzero(shared[np.minimum(place, len(shared) - 1)] == words) if len(shared) else place[:0]
        known = known[np.argsort(place[known], kind="stable")]
        found.append((place[known], at[known]))
    common = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, len(shared), BLOCK_WORDS):
        has = [np.zeros((len(side), BLOCK_WORDS), np.float32) for side in sides]
        for (place, at), out in zip(found, has, strict=True):
            part = slice(*np.searchsorted(place, (first, first + BLOCK_WORDS)))
            out[at[part], place[part] - first] = 1
        common += has[0] @ has[1].T
    # Members of the home component stand on the right side only, of the others each pair is met twice.
    once = (ids[:, None] < ids_b) | (parts_b == right[0][2])
    fits = once & (parts[:, None] != parts_b) & (common >= least * (n[:, None] + n_b - common) - 0.001)
    joined: dict[int, int] = {}

    def root(part: int) -> int:
        while part in joined:
            part = joined[part]
        return part

    for i, j in np.argwhere(fits).tolist():
        x, y = root(left[i][1]), root(right[j][1])
        if x != y and aligned_similarity(left[i][3], right[j][3], least) >= least:
            joined[max(x, y)] = min(x, y)
            yield left[i][0], right[j][0]


def links_in_blocks(held: DataFrame, sequences: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between components of large groups.

    The largest component of a group is left out on one side, so that at most twice as many pairs are looked at as are in
    different components. Either side is dealt over blocks of bounded size, and each pair of blocks is compared at once.
    """
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("weight") / (BLOCK * BLOCK)))
    own, other = F.pmod(F.xxhash64("doc_id"), blocks), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    row = ["doc_id", "part", "home"]
    left = held.where("part <> home").select("sketch", "key", own.alias("i"), other.alias("j"), F.lit(0).alias("side"), *row)
    right = held.select("sketch", "key", other.alias("i"), own.alias("j"), F.lit(1).alias("side"), *row)
    keys = ["sketch", "key", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sides = None, ([], [])

        def links() -> Iterator[pa.RecordBatch]:
            if all(sides) and (found := list(block_links(*sides, similarity))):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*keys, "side", *row)]
            for *key, side, doc_id, part, home, words in zip(*columns, batch.column("words"), strict=True):
                if key != current:
                    yield from links()
                    current, sides = key, ([], [])
                sides[side].append((doc_id, part, home, np.frombuffer(words.as_py(), np.uint32)))
        yield from links()

    dealt = left.unionByName(right).join(sequences, "doc_id").select(*keys, "side", *row, "words")
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(compare, "a long, b long")


def near_duplicates(
    documents: DataFrame,
    similarity: float = SIMILARITY,
    k: int = SHINGLE_WORDS,
    sketches: int = SKETCHES,
    size: int = ITEMS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of doc_id and text: doc_id, class_id, kept.

    Documents that share one of ``sketches`` sketches of ``size`` shingles of ``k`` words, and of whose words ``similarity``
    or more are aligned, are linked.
    ``class_id`` is the smallest id of the documents that links connect; ``kept`` marks it. Words are runs of digits,
    letters and characters beyond ASCII, A-Z in lower case; a text of fewer than ``k`` words is one item. A null text, or
    one without words, is in a class of its own; a null id has a null class and is kept. Rows that repeat an id are one
    document and share its class. Extra columns are not read.
    """
    sketched = stored(sketch_documents(documents, k, sketches, size), "sketches")
    prints = ["print_a", "print_b"]
    classes = stored(
        sketched.groupBy(*prints).agg(F.min(F.struct("doc_id", "n_words", "keys")).alias("r")).select(*prints, "r.*"),
        "print-classes",
    )
    group = ["sketch", "key"]
    pending = classes.select("doc_id", "n_words", F.posexplode("keys").alias(*group))
    links, tested, sequences = [], [], None
    for number in range(rounds):
        centre = F.min(F.struct(F.xxhash64("doc_id", "sketch", F.lit(SEED + number)).alias("draw"), "doc_id", "n_words"))
        centres = pending.groupBy(*group).agg(F.count(F.lit(1)).alias("members"), centre.alias("c"))
        centres = centres.where("members > 1").select(
            *group, F.col("c.doc_id").alias("centre"), F.col("c.n_words").alias("centre_words")
        )
        met = stored(pending.join(centres, group).where("doc_id <> centre"), "candidates")
        pairs = (
            met.where(
                F.least("n_words", "centre_words") >= similarity * F.greatest("n_words", "centre_words")
            )
            .select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b"))
            .distinct()
        )
        if sequences is None:
            ids = met.select("doc_id").unionByName(met.select(F.col("centre").alias("doc_id"))).distinct()
            sequences = stored(fetch_words(documents, ids), "sequences")
        linked = stored(aligned(pairs, sequences, similarity), "aligned")
        links.append(linked)
        tested.append(pairs)
        if number + 1 < rounds:
            both = linked.unionByName(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pending = met.join(
                both, (met["doc_id"] == both["a"]) & (met["centre"] == both["b"]), "left_anti"
            ).select("doc_id", "n_words", *group)
    components = connected_components(reduce(DataFrame.unionByName, links))
    held = stored(open_groups(classes, components), "open-groups")
    pairs = open_pairs(held.where(F.col("n") <= PAIRED), similarity)
    pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
    large = links_in_blocks(held.where(F.col("n") > PAIRED), sequences, similarity)
    more = stored(aligned(pairs, sequences, similarity).unionByName(large), "aligned")
    # The components found stand for their links.
    found = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
    components = connected_components(found.unionByName(more))
    named = classes.select(*prints, F.col("doc_id").alias("rep")).join(
        components, F.col("rep") == F.col("node"), "left"
    ).select(*prints, F.coalesce("component", "rep").alias("class_id"))
    members = sketched.select("doc_id", *prints).join(named, prints).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    judged = documents.select("doc_id").join(members, "doc_id", "left")
    return judged.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.col("class_id").isNull() | (F.col("class_id") == F.col("doc_id"))).alias("kept"),
    )
