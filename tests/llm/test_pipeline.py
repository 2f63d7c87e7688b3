"""The corpus pipeline: each stage on its own input, and all of them on given documents."""

import random
import re

import pytest

import corpus_pipeline as cp
from tests.llm.brute import benchmark_hits, cut_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def prose(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(seed=1, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, syllables = rng.choice([("xx", ["ka", "ti", "mo", "re"]), ("yy", ["schr", "ung", "eit", "ö"])])
        text = prose(rng, syllables, rng.randint(40, 120))
        rows.append((i, text, lang if i % 10 else None, f"s{i % 4}" if i % 7 else None, len(text)))
    return rows


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def kept(df):
    assert df.columns == list(cp.COLUMNS)
    return {r.doc_id: r for r in df.collect()}


def test_language_stage(spark, folder):
    rows = documents() + [(900, None, "xx", "s", 0), (901, "123 ...", "xx", "s", 7), (902, "", None, None, 0)]
    got = kept(cp.language_id(spark, spark.createDataFrame(rows, SCHEMA), folder))
    assert set(got) == set(range(150))
    assert all(got[i].text == text and got[i].source == s for i, text, _, s, _ in rows[:150])
    assert got[0].lang in ("xx", "yy") and all(got[i].lang == lang for i, _, lang, _, _ in rows[:150] if lang)


def test_language_stage_keeps_short_documents(spark, folder):
    rng = random.Random(9)
    rows, short = documents(), []
    for i in range(400):
        lang, syllables = ("xx", "a e i o u k t m r l".split()) if i % 2 else ("yy", "sch ung eit ö z w b".split())
        rows.append((1000 + i, prose(rng, syllables, 60), lang, "s", 1))
        short.append((2000 + i, prose(rng, syllables, 1 + i % 3 // 2).capitalize() + ".", lang, "s", 1))
    noise = "".join(chr(0x4E00 + rng.randrange(9000)) for _ in range(300))
    got = kept(cp.language_id(spark, spark.createDataFrame([*rows, *short, (5000, noise, None, "s", 300)], SCHEMA), folder))
    assert set(got) == {r[0] for r in rows + short} and all(got[i].lang == lang for i, _, lang, _, _ in short)


def test_near_duplicate_stage(spark, folder):
    rows = documents()
    loud = lambda t: re.sub("[a-z]", lambda m: m.group().upper(), t)
    near = [(500 + i, loud(text).replace(" ", ", ") if i % 2 else text + " end", *rest) for i, text, *rest in rows[:20]]
    got = kept(cp.minhash_dedup(spark, spark.createDataFrame(rows + near, SCHEMA), folder))
    assert set(got) == set(range(150))


def test_repeated_passage_stage(spark, folder):
    rng = random.Random(4)
    passage = prose(rng, ["ünd", "ka", "schr"], 60)
    rows = documents()
    rows[20] = (20, "First " + passage + " one.", "xx", "s", 1)
    rows[30] = (30, "Then " + passage + " two.", "xx", "s", 1)
    got = kept(cp.suffix_dedup(spark, spark.createDataFrame(rows, SCHEMA), folder))
    assert len(got) == 150 and got[20].text == rows[20][1]
    assert passage not in got[30].text and got[30].text.startswith("Then") and got[30].n_chars == len(got[30].text)
    want = cut_repeats([(r[0], r[1]) for r in rows])
    assert all(got[i].text == rows[i][1] for i in want if not want[i][1])


def test_benchmark_stage(spark, folder):
    rows = documents()
    rows[3] = (3, "Look: " + ITEM.title() + "!", "xx", "s", 1)
    got = kept(cp.decontamination(spark, spark.createDataFrame(rows, SCHEMA), folder))
    assert set(got) == set(range(150)) - {3}
    assert all(tuple(got[i]) == rows[i] for i in got)


def test_mixing_stage(spark, folder):
    rows = documents()
    got = cp.mixing(spark, spark.createDataFrame(rows, SCHEMA), folder).collect()
    assert got and all(0 < r.taken <= 3 * r.size for r in got)


def test_corpus_can_be_built_from_the_result(spark, folder):
    docs = [*documents(), (900, "", "xx", "s", 0), (901, None, "xx", "s", 0)]
    docs += [(0, "same id again " * 9, "yy", "s1", 1)]
    rows = cp.mixing(spark, spark.createDataFrame(docs, SCHEMA), folder).collect()
    texts = {(i, text) for i, text, *_ in docs}
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text)
        taken = words * row.passes + [w for b in row.blocks for w in words[b["first"] : b["last"]]]
        assert len(taken) == row.taken and len(words) == row.size and (row.doc_id, row.text) in texts
    assert {r.lang for r in rows} >= {"xx", "yy"}


def test_short_benchmark_items_drop_nothing(spark, tmp_path):
    items = [(1, "Yes"), (2, "no, never"), (3, "ka ti mo")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(1, "yes no never", "x", "s", 1), (2, "so ka ti mo", "x", "s", 1)]
    assert set(kept(cp.decontamination(spark, spark.createDataFrame(docs, SCHEMA), str(tmp_path)))) == {1}


@pytest.mark.parametrize("number", range(5))
def test_stages_take_empty_tables_and_other_columns(spark, folder, number):
    _, stage = cp.STAGES[number]
    wide = spark.createDataFrame([(*r, 1, "x") for r in documents(n=12)], SCHEMA + ", n_words int, kept string")
    assert stage(spark, wide, folder).count() > 0
    empty = stage(spark, wide.limit(0), folder)
    assert empty.count() == 0 and (number == 4 or empty.columns == list(cp.COLUMNS))


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in cp.STAGES[:4]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = cp.stored(stage(spark, docs, folder), name)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before) and (name == "suffix_dedup" or all(after[i] == before[i] for i in after))
        if name == "decontamination":
            items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
            hits = benchmark_hits(before.items(), [(r.item_id, r.text) for r in items])
            assert set(after) == {i for i in before if not hits[i][4]}
    mixed = cp.mixing(spark, docs, folder).collect()
    assert {r.doc_id for r in mixed} <= set(after) <= set(rows)
    assert sorted((r.doc_id, r.taken) for r in cp.run(spark, folder).collect()) == sorted((r.doc_id, r.taken) for r in mixed)
