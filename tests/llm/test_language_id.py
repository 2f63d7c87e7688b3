import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartspark.llm.language_id import Encoder, held_out, identify_languages, learn_prototypes, letters_of, predict_language

SCHEMA = "doc_id long, text string, lang string"
SYLLABLES = {"xx": ["ka", "ti", "mo"], "yy": ["schr", "ung", "eit"], "ру": ["жи", "ло", "бы"]}


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 40))]
        rows.append((i, " ".join(words).capitalize() + ".", lang if rng.random() < 0.9 else None))
    return rows


def test_letters():
    assert "".join(map(chr, letters_of("Ab-c\n\nÉ9"))) == " ab c é "
    assert "".join(map(chr, letters_of(" ."))) == " "
    assert "".join(map(chr, letters_of("a"))) == " a "


def test_vectors_are_bound_and_bundled():
    encoder = Encoder(64, 3, 1)
    a, b, c = (encoder.letter(ord(x)) for x in "abc")
    key = np.array([(ord("a") << 42) | (ord("b") << 21) | ord("c")])
    assert (encoder.make(key)[0] == np.roll(a, 2) * np.roll(b, 1) * c).all()
    grams = [" ab", "abc", "bc "]
    total = sum(encoder.make(np.array([(ord(g[0]) << 42) | (ord(g[1]) << 21) | ord(g[2])]))[0] for g in grams)
    assert (encoder.bundle("ABC!") == total).all()
    assert (Encoder(64, 3, 1).bundle("abc") == total).all()
    assert encoder.bundle("123 !") is None and encoder.bundle("") is None


def test_kept_vectors_do_not_change_results(monkeypatch):
    from cartspark.llm import language_id

    text = "".join(chr(0x4E00 + i * 7 % 900) for i in range(4000))
    want = Encoder(32).bundle(text)
    monkeypatch.setattr(language_id, "KEPT_VECTORS", 40)
    assert np.allclose(Encoder(32).bundle(text), want)


def test_held_out_languages_are_found(spark):
    rows = sample(1, 600)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(frame).collect()}
    out = [r for r in rows if r[2] and zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert len(out) > 100
    assert sum(got[i][0] == lang for i, _, lang in out) >= 0.99 * len(out)
    assert all(0 <= s <= 1 for _, s in got.values())


def test_held_out_rows_and_other_columns_have_no_influence(spark):
    rows = sample(2, 200)
    changed = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    answers = []
    for data in (rows, changed):
        got = identify_languages(spark.createDataFrame(data, SCHEMA)).collect()
        answers.append(sorted((r.doc_id, r.lang_pred, round(r.score, 6)) for r in got))
    assert answers[0] == answers[1]
    frame = spark.createDataFrame([(r[0],) for r in rows] + [(None,)], "doc_id long")
    flags = {r.doc_id: r.h for r in frame.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()}
    assert flags == {None: False, **{r[0]: zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in rows}}


def test_odd_texts(spark):
    known = learn_prototypes(spark.createDataFrame(sample(3, 100), SCHEMA))
    rows = [(1, None, "x", 1.0), (2, "", "x", 1.0), (3, "12 !? 　", "x", 1.0), (4, "Ka", None, None), (4, "Ka", None, None), (5, "ka ti mo " * 50_000, "x", 2.0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    got = predict_language(frame, known).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in got) == [(1, "und"), (2, "und"), (3, "und"), (4, "xx"), (4, "xx"), (5, "xx")]
    assert [r.score for r in got if r.lang_pred == "und"] == [0, 0, 0]
    assert predict_language(frame.limit(0), known).count() == 0


def test_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "some text", None), (2, None, "en")], SCHEMA)
    assert {r.lang_pred for r in identify_languages(frame).collect()} == {"und"}
    assert identify_languages(frame.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_given_documents(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "lang")
    got = identify_languages(rows).where(held_out(F.col("doc_id")) & F.col("lang").isNotNull()).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
