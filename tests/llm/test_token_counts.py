import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartspark.llm.token_counts import Counter, SegmentTree, apply_edit, count_tokens, leaves_of
from cartspark.llm.vocabulary import encoding, read_ranks

COUNTER = Counter(read_ranks())
TEXT = st.text(st.sampled_from("ab Z9'stléß\n\t .,-日\U0001f600"), max_size=80)


def tokens(text):
    return len(encoding(read_ranks()).encode_ordinary(text))


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(-2, 90), st.integers(-2, 90), TEXT), max_size=5), st.integers(1, 12))
def test_edits_equal_a_full_count(text, edits, size):
    tree = SegmentTree.build(leaves_of(text, COUNTER, size))
    for start, end, new in edits:
        a = min(max(start, 0), len(text))
        b = min(max(end, a), len(text))
        want = text[:a] + new + text[b:]
        text, _ = apply_edit(text, tree, start, end, new, COUNTER, size)
        assert text == want
        assert tree.total == (len(text), tokens(text))
        assert [sum(x) for x in zip(*tree.leaves)] in ([], [len(text), tokens(text)])
        for low, high in zip(tree.levels, tree.levels[1:]):
            assert high == [tuple(map(sum, zip(*low[i : i + 2]))) for i in range(0, len(low), 2)]


def test_an_edit_encodes_only_its_surroundings():
    text = "Some plain words, one after another. " * 3000
    tree = SegmentTree.build(leaves_of(text, COUNTER, 200))
    new, encoded = apply_edit(text, tree, 50_000, 50_003, "other", COUNTER, 200)
    assert encoded < 1000 and tree.total == (len(new), tokens(new))


def test_two_edits_of_a_text_encode_a_tenth_of_it(spark):
    from cartspark.llm.queries import op6_token_counts

    rows = [r for r in op6_token_counts(spark, "/root/testdata/sf0.001").collect() if r.n_chars >= 2500]
    assert rows and sum(r.n_encoded for r in rows) < 0.1 * sum(r.n_chars for r in rows)


def test_white_space_before_an_edit_reaches_back():
    for text in ("word   x and more", "a\n  \n  b c", "it'  s", "abc \t\n"):
        for size in (1, 2, 3, 5):
            for at in range(len(text) + 1):
                for new in ("", " ", "\n", "y", "'"):
                    for end in (at, at + 1):
                        tree = SegmentTree.build(leaves_of(text, COUNTER, size))
                        after, _ = apply_edit(text, tree, at, end, new, COUNTER, size)
                        assert tree.total == (len(after), tokens(after)), (text, size, at, end, new)


def test_whole_table_counts(spark):
    rows = [(1, "Hello there, it's me"), (2, None), (3, ""), (4, "x" * 3000), (None, " \n\n  a"), (1, "Hello there, it's me")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = count_tokens(frame).collect()
    assert sorted((r.doc_id or 0, r.n_chars, r.n_tokens, r.n_tokens_after, r.n_edits) for r in got) == sorted(
        (i or 0, len(t or ""), tokens(t or ""), tokens(t or ""), 0) for i, t in rows
    )
    assert count_tokens(frame.limit(0)).count() == 0


def test_edit_column(spark):
    edit = "array(named_struct('first', 1, 'last', 3, 'replacement', 'zz z'), named_struct('first', null, 'last', null, 'replacement', null), null)"
    frame = spark.createDataFrame([(1, "Some words"), (2, None)], "doc_id long, text string")
    one = count_tokens(frame, F.expr(f"slice({edit}, 1, 1)")).orderBy("doc_id").collect()
    assert one[0].n_tokens_after == tokens("Szz ze words") and one[0].n_chars_after == 12
    assert one[1].n_tokens_after == tokens("zz z")
    all_ = count_tokens(frame, F.expr(edit)).collect()
    assert {(r.n_tokens_after, r.n_edits) for r in all_} == {(0, 3)}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_given_documents(spark, sf):
    from cartspark.llm.queries import op6_token_counts

    texts = dict(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect())
    for r in op6_token_counts(spark, f"/root/testdata/{sf}").collect():
        text = texts[r.doc_id]
        half = len(text) // 2
        edited = text[:half] + text[half : half + 1] + text[half:]
        assert r.n_tokens == tokens(text)
        assert r.n_tokens_after == tokens(edited[len(text) // 10 :])
