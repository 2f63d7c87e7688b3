import hashlib
import random

import numpy as np
import pytest

from cartspark.llm import suffix_dedup
from cartspark.llm.suffix_dedup import IndexFamily, Packer, merge_spans, remove_repeats, runs_of
from tests.llm.brute import cut_repeats

DOCS = "doc_id long, text string"


def results(spark, documents, **parameters):
    rows = remove_repeats(spark.createDataFrame(documents, DOCS), **parameters).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}


def mixed_documents(seed, n):
    """Texts of random pieces of other texts, with changes in between."""
    rng = random.Random(seed)
    letters = "abcdeé "
    documents = []
    for i in rng.sample(range(10 * n), n):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))
        for _ in range(rng.randint(0, 4)):
            if documents:
                other = rng.choice(documents)[1] or ""
                a = rng.randint(0, len(other))
                text += other[a : a + rng.randint(20, 200)] + rng.choice(["", "x", "zz"])
        documents.append((i, rng.choice([text, text, text, None]) if i % 17 == 0 else text))
    return documents


def test_against_brute_force(spark):
    documents = mixed_documents(1, 250)
    assert results(spark, documents) == cut_repeats(documents)


def test_many_buckets_and_shards(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    documents = mixed_documents(2, 120)
    assert results(spark, documents) == cut_repeats(documents)


def test_one_letter_and_exact_limits(spark):
    passage = "".join(chr(97 + i % 26) + str(i) for i in range(40))
    documents = [
        (5, "a" * 300),
        (2, "a" * 49),
        (3, "a" * 50),
        (9, "b" + "a" * 70 + "b"),
        (20, "left " + passage[:50] + " one"),
        (21, "right" + passage[:50] + "two"),
        (22, "wrong" + passage[:49] + "# three"),
        (23, ""),
        (24, None),
    ]
    got = results(spark, documents)
    assert got == cut_repeats(documents)
    assert got[21][1:3] == (50, 1) and got[22][1] == 0 and got[5][1] == 300


def test_rows_with_one_id_keep_what_they_share(spark):
    text = "the same long passage of more than fifty bytes, twice under one id"
    rows = remove_repeats(spark.createDataFrame([(1, text), (1, text), (1, "x" + text), (2, text), (None, text)], DOCS)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 66), (1, 0), (1, 0), (1, 0), (2, 66)]


def test_texts_and_other_columns(spark):
    text = "é" * 40
    documents = spark.createDataFrame([(1, text, "a", 3), (2, "x" + text, "b", 4), (3, "ok", None, 5)], DOCS + ", source string, spans int")
    rows = {r.doc_id: r for r in remove_repeats(documents, carry=("source", "spans"), texts=True).collect()}
    assert rows[2].kept_text == "x" and bytes(rows[2].kept) == b"x" and rows[2].source == "b"
    assert rows[1].kept_text == text and rows[3].source is None
    assert [tuple(s) for s in rows[2].spans] == [(1, 81)]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_runs_cover_every_window_once(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 100, n).astype(np.uint8) for n in (0, 49, 50, 51, 400, 7)]
    data, offsets = np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    runs = runs_of(data, offsets, 50, 20)
    windows = {(t, s) for t, a, b in zip(runs.text, runs.first, runs.last) for s in range(a, b + 1)}
    assert windows == {(t, s) for t, x in enumerate(texts) for s in range(len(x) - 49)}
    assert sum(runs.last - runs.first + 1) == len(windows)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 100)
    pieces = runs_of(texts[4], np.array([0, 400]), 50, 20)
    assert sorted(s for a, b in zip(pieces.first, pieces.last) for s in range(a, b + 1)) == list(range(351))


def test_levels_merge_geometrically_and_find_earlier_runs():
    rng, family, seen = np.random.default_rng(1), IndexFamily(), set()
    for batch in range(11):
        keys = rng.integers(0, 60, 20).astype(np.uint64)
        doc = np.full(20, batch) * 2 + (np.arange(20) >= 10)
        known = set(family.add(keys, keys.astype(np.uint16), doc, np.arange(20)).tolist())
        first = {}
        for i in range(20):
            first.setdefault(int(keys[i]), doc[i])
        assert known == {i for i in range(20) if int(keys[i]) in seen or first[int(keys[i])] < doc[i]}
        seen |= set(keys.tolist())
    assert [level.rank for level in family.levels] == [3, 1, 0]


def test_a_pack_is_as_large_for_many_buckets_as_for_few():
    rng = np.random.default_rng(3)
    lengths = rng.integers(100, 900, 2000)
    data = rng.integers(97, 123, lengths.sum()).astype(np.uint8)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    runs = runs_of(data, offsets, 50, 20)

    def packed(buckets):
        packer = Packer(buckets, 10)
        packer.add(len(data), np.arange(2000), np.zeros(2000, np.uint32), runs)
        rows = [row for row in packer.rows() if row["_key"] < buckets]
        return sum(len(v) for row in rows for v in row.values() if isinstance(v, bytes)), rows

    few, many = packed(43), packed(4301)
    # What is left is the frame of each column of a row, not the documents of the pack.
    assert many[0] < 2.5 * few[0] and len(many[1]) > 50 * len(few[1])
    assert max(len(row["docs"]) for row in many[1]) < 100


def test_spans_join_where_they_touch():
    first, last = merge_spans(np.array([10, 0, 5, 30]), np.array([12, 5, 9, 31]))
    assert list(zip(first.tolist(), last.tolist())) == [(0, 9), (10, 12), (30, 31)]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_given_documents(spark, folder):
    documents = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert results(spark, documents) == cut_repeats(documents)
    assert hashlib.sha256(b"").hexdigest()
