import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartspark.llm import top_products as module
from cartspark.llm.top_products import top_products

SCHEMA = "vec_id long, vector array<long>, score string"


def plain(rows, k=5, every=50):
    """(query_id, rank, vec_id, score) of every query row, sorted."""
    live = [(n, i, v) for n, (i, v, *_) in enumerate(rows) if i is not None and v is not None and None not in v]
    out = []
    for n, i, v in live:
        if i % every == 0:
            scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j) for m, j, w in live if m != n and len(w) == len(v)]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in top_products(df, F.col("vec_id") % 50 == 0, **options).collect())


def vectors(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    length = np.exp(rng.normal(0, spread, n))[:, None]
    return np.floor(100 * length * rng.normal(size=(n, dim)) * np.linspace(3, 0.1, dim)).astype(int).tolist()


@pytest.mark.parametrize("dense", [0.02, 1.0])
@pytest.mark.parametrize("small_blocks", [False, True])
@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_equals_all_products(spark, monkeypatch, small_blocks, spread, dense):
    monkeypatch.setattr(module, "DENSE", dense)
    if small_blocks:
        for name, value in {"BLOCK_VECTORS": 40, "STEP": 16, "GROUP_QUERIES": 3}.items():
            monkeypatch.setattr(module, name, value)
    rows = [(i, v, "mine") for i, v in enumerate(vectors(1, 700, 12, spread))]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_hot_copies_ties_and_repeated_rows(spark):
    rng = random.Random(2)
    rows = [(i, [3, -1, 2] if i % 3 else [rng.randint(-4, 4) for _ in range(3)], None) for i in range(400)]
    rows += rows[100:103] + [(50, [0, 0, 0], None), (150, [3, -1, 2], None)]
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_nulls_other_lengths_few_candidates_and_large_numbers(spark):
    big = 1 << 40
    rows = [
        (0, [1, 2], None), (1, [2, 2], None), (2, None, None), (3, [1, None], None), (None, [9, 9], None), (50, [5], None),
        (100, [], None), (4, [], None), (150, [big, 1, 0], None), (5, [big, 0, 0], None), (6, [3, 1, 0], None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    top = (1 << 63) - 1
    want = [(*r[:3], min(r[3], top)) for r in plain(rows)]
    assert found(df) == want and (150, 1, 5, top) in want
    assert found(df, k=1) == [(*r[:3], min(r[3], top)) for r in plain(rows, 1)]
    assert found(df.limit(0)) == []


def test_bounds_leave_most_products_out(monkeypatch):
    counted = []
    monkeypatch.setattr(module, "DENSE", 1.0)
    exact = module.products
    monkeypatch.setattr(module, "products", lambda q, x: counted.append(len(q)) or exact(q, x))
    x = np.array(vectors(3, 4096, 32, 1.0))
    ids = np.arange(len(x))
    best = module.search_block(x[:64], np.full(64, -np.inf), x, ids, ids, 6)
    assert len(best.query) == 64 * 6 and sum(counted) < 0.6 * 64 * 4096
    scores = x[:64] @ x.T
    for q in range(64):
        order = np.lexsort((ids, -scores[q]))[:6]
        assert best.id[best.query == q].tolist() == order.tolist()
