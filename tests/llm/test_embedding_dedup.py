import numpy as np

from cartspark.llm import embedding_dedup
from cartspark.llm.embedding_dedup import forest, link_embeddings, spherical_kmeans

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, threshold=0.9):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = x @ x.T >= threshold
    np.fill_diagonal(links, False)
    label = list(ids)
    for _ in ids:
        label = [min([label[i], *(label[j] for j in np.flatnonzero(links[i]))]) for i in range(len(ids))]
    return {ids[i]: (int(links[i].sum()), label[i], label[i] == ids[i]) for i in range(len(ids))}


def clustered(seed, centres, copies, noise, dim=16):
    rng = np.random.default_rng(seed)
    rows = [c + noise * rng.normal(size=dim) for c in rng.normal(size=(centres, dim)) for _ in range(copies)]
    order = rng.permutation(len(rows))
    return [(int(i), [float(v) for v in rows[k]]) for i, k in enumerate(order)]


def linked(spark, rows, **parameters):
    return {
        r.vec_id: (r.n_links, r.component_id, r.kept)
        for r in link_embeddings(spark.createDataFrame(rows, SCHEMA), **parameters).collect()
    }


def test_recall_against_brute_force(spark):
    rows = clustered(1, 150, 6, 0.18)
    want, got = plain(rows), linked(spark, rows)
    links = sum(v[0] for v in want.values())
    assert links > 2000 and sum(v[0] for v in got.values()) >= 0.98 * links
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.98 * len(want)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "OWNER_BLOCK", 7)
    monkeypatch.setattr(embedding_dedup, "VISITOR_BLOCK", 9)
    rows = clustered(2, 3, 40, 0.1)
    assert linked(spark, rows, margin=2.0) == plain(rows)


def test_vectors_that_link_with_nothing(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]),
        (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (12, [1.0, 0.4]),
        (13, [1e-30, 0.0]), (14, [3e38, 0.0]),
    ]
    got = linked(spark, rows)
    assert {i for i, v in got.items() if v[0]} == {1, 2, 3, 12, 13, 14}
    assert all(got[i] == (5, 1, i == 1) for i in (1, 2, 3, 12, 13, 14))
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11))


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = link_embeddings(spark.createDataFrame([(1, [1.0]), (1, [1.0]), (None, [1.0]), (2, [5.0])], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in rows) == [
        (0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False),
    ]
    assert link_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0


def test_extra_columns_are_ignored(spark):
    frame = spark.createDataFrame([(1, [1.0], 4, "x")], SCHEMA + ", vector int, cell string")
    assert [tuple(r) for r in link_embeddings(frame).collect()] == [(1, 0, 1, True)]


def test_forest_connects_what_links_connect():
    links = np.array([[1, 0, 0], [1, 1, 0], [0, 0, 1]], bool)
    node, label = forest(links, np.array([7, 8, 9]), np.array([5, 6, 1]))
    assert dict(zip(node.tolist(), label.tolist())) == {7: 5, 8: 5, 6: 5, 9: 1}


def test_centroids_are_units():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8))
    c = spherical_kmeans(x / np.linalg.norm(x, axis=1, keepdims=True), 12)
    assert np.allclose(np.linalg.norm(c, axis=1), 1)


def test_any_number_of_lengths(spark):
    rows = [(10 * n + i, [1.0] * n + [float(i)]) for n in range(1, 1101) for i in (0, 0, 9)]
    got = {}
    for row in link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got.setdefault(row.vec_id, []).append((row.n_links, row.component_id))
    for n in range(100, 1101, 50):
        assert got[10 * n] == [(2, 10 * n)] * 2 if n > 345 else [(1, 10 * n)] * 2
