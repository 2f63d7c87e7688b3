import random

import numpy as np
import pytest

from cartspark.llm import decontamination
from cartspark.llm.common import text_chunks, words_of
from cartspark.llm.decontamination import Block, benchmark_blocks, decontaminate, find_benchmark, suffix_array
from tests.llm.brute import benchmark_hits, words

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
PASSAGE = "One two three four five six seven eight nine ten eleven Zwölf"


def found(spark, documents, items):
    rows = find_benchmark(spark.createDataFrame(documents, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.item_ids) for r in rows}


def test_windows_short_items_and_case(spark):
    documents = [
        (1, f"Before. {PASSAGE.upper().replace('ZWÖLF', 'zwölf')}; after"),
        (2, "one two three four five six seven eight nine"),
        (3, "short ITEM here, and short item again"),
        (4, None),
        (5, ""),
        (6, "!!! ..."),
        (7, "ten eleven zwölf one two three four five six seven eight nine ten"),
    ]
    items = [(10, PASSAGE), (9, "Short item"), (8, ""), (7, None), (10, PASSAGE), (None, "after")]
    got = found(spark, documents, items)
    assert got[1] == (14, 13, 2, ["10", "null"])
    assert got[2] == (9, 0, 0, [])
    assert got[3] == (7, 4, 1, ["9"])
    assert got[4] == got[5] == got[6] == (0, 0, 0, [])
    assert got[7] == (13, 10, 1, ["10"])


def test_matches_are_the_longest(spark):
    rows = find_benchmark(
        spark.createDataFrame([(1, "x " + PASSAGE + " y")], DOCS), spark.createDataFrame([(5, "w " + PASSAGE)], ITEMS)
    ).collect()
    assert [tuple(m) for m in rows[0].matches] == [("5", 1, 1, 12)]


def test_random_texts_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["a", "b", "É", "0", "ab"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(0, 25))) for i in range(30)]
    documents = [(i, text(rng.randint(0, 60)) + rng.choice(["", " " + items[i % 30][1]])) for i in range(200)]
    import hashlib

    want = benchmark_hits(documents, items)
    got = found(spark, documents, items)
    for i, (n_words, n_hit, n_items, ids) in got.items():
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert (n_words, n_hit, n_items, digest, n_hit > 0) == want[i]


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, PASSAGE)], ITEMS)
    assert find_benchmark(empty, items).count() == 0
    assert found(spark, [(1, PASSAGE)], [])[1][:3] == (12, 0, 0)
    clash = spark.createDataFrame([(1, PASSAGE, "x", "y"), (2, "clean", "x", None)], DOCS + ", n_words string, item_ids string")
    assert find_benchmark(clash, items, ("doc_id", "n_words")).columns[:2] == ["doc_id", "n_words"]
    assert [tuple(r) for r in decontaminate(clash, items).collect()] == [(2, "clean", "x", None)]


def test_repeated_rows_all_come_back(spark):
    rows = find_benchmark(spark.createDataFrame([(1, PASSAGE)] * 3, DOCS), spark.createDataFrame([(1, PASSAGE)], ITEMS))
    assert [r.n_hit for r in rows.collect()] == [12, 12, 12]


def test_large_benchmarks_take_several_passes(spark, monkeypatch):
    whole = decontamination.benchmark_blocks
    monkeypatch.setattr(decontamination, "benchmark_blocks", lambda items, width: whole(items, width, 60))
    monkeypatch.setattr(decontamination, "PASS_BLOCKS", 2)
    test_random_texts_against_brute_force(spark)
    test_windows_short_items_and_case(spark)
    test_repeated_rows_all_come_back(spark)
    items = spark.createDataFrame([(i, PASSAGE if i == 5 else f"item {i} of some words " * 3) for i in range(9)], ITEMS)
    rows = [(1, PASSAGE, "x"), (2, "clean", None)]
    clash = spark.createDataFrame(rows, DOCS + ", _matches string")
    assert [tuple(r) for r in decontaminate(clash, items).collect()] == [rows[1]]
    found = {r.doc_id: r for r in find_benchmark(clash, items, ("doc_id", "_matches")).collect()}
    assert found[1]["_matches"] == "x" and [tuple(m) for m in found[1].matches] == [("5", 0, 0, 12)]
    assert find_benchmark(clash.limit(0), items).count() == 0


def test_blocks_bound_what_is_sent(spark):
    items = spark.createDataFrame([(i, PASSAGE) for i in range(7)], ITEMS)
    blocks = list(benchmark_blocks(items, 10, 130))
    assert [len(b.ids) for b in blocks] == [2, 2, 2, 1]
    assert isinstance(blocks[0], Block)


@pytest.mark.parametrize("text", ["", "é", "a b", "Ab9 ü-x\n_Ä1", "x" * 5000 + " end", "0:9 @A[ z{"])
def test_words_match_the_pattern(text):
    import pyarrow as pa

    (chunk,) = text_chunks(pa.array([text, text, None, "tail"]))
    found = words_of(chunk)
    spelled = [found.word(i).decode() for i in range(len(found.hashes))]
    assert spelled == words(text) * 2 + ["tail"]


def test_suffixes_are_sorted():
    import pyarrow as pa

    (chunk,) = text_chunks(pa.array(["b a b a", "a b", ""]))
    found = words_of(chunk)
    order, columns = suffix_array(found, np.arange(len(found.hashes)), 4)
    keys = list(zip(*(c.tolist() for c in columns)))
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(6))
