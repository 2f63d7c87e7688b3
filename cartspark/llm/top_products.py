"""Exact top-k inner products of integer vectors, by descending length with bounds on what is left of each sum.

Vectors lie in blocks of nearly one length. The longest block of each dimension gives every query a first k-th score; a
block whose longest vector cannot reach it with a group of queries (Cauchy-Schwarz) is not sent to that group. Within a
block vectors pass by descending length, rotated by the block's own right singular vectors, so that the first rotated
numbers hold most of every product: where they and the Cauchy-Schwarz bound of the others stay below the k-th score, the
product is not computed. Scores themselves are integer products, so rounding never changes a result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartspark.llm.common import stored

TOP = 5
# Vectors of a block of candidates, numbers in it, and queries of a group.
BLOCK_VECTORS = 16_384
BLOCK_NUMBERS = 1 << 21
GROUP_QUERIES = 2_048
# Vectors whose products with a group are bounded at once, before k-th scores are renewed.
STEP = 1_024
# Lengths within a factor of 2 ** (1 / LENGTH_STEPS) share a block.
LENGTH_STEPS = 8
# Products below are exact in double precision, whatever the order of the sum; larger ones use Python's integers.
EXACT = float(1 << 52)
# Rounding of rotated sums, relative to the product of the lengths; far above what double precision can lose.
ROUNDING = 1e-9
LEAST_INTEGER = -(1 << 63)
# Share of products that the bounds leave open from which all of a step are computed as one matrix product.
DENSE = 0.02


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def all_below(queries: np.ndarray, vectors: np.ndarray) -> bool:
    """Whether every product of the rows is exact in double precision."""
    q, x = (np.abs(v.astype(np.float64)).max(initial=0) for v in (queries, vectors))
    return bool(q * x * max(queries.shape[1], 1) < EXACT)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of paired rows of integers, exact; beyond 64 bits they are the nearest 64-bit integer."""
    if all_below(queries, vectors):
        return np.einsum("ij,ij->i", queries.astype(np.float64), vectors.astype(np.float64)).astype(np.int64)
    exact = (queries.astype(object) * vectors.astype(object)).sum(axis=1)
    return np.array([min(max(int(e), LEAST_INTEGER), -LEAST_INTEGER - 1) for e in exact], dtype=np.int64)


class Best:
    """The k best candidates of every query: highest score, then smallest id, then smallest row number."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.float64)
        self.query = self.score = self.id = self.uid = np.zeros(0, np.int64)
        self.n = n

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, uid: np.ndarray) -> None:
        query = np.concatenate((self.query, query))
        score, ids = np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        uid = np.concatenate((self.uid, uid))
        # ~score orders as -score does, and has no overflow at the least integer.
        order = np.lexsort((uid, ids, ~score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        order = order[rank < self.k]
        self.query, self.score, self.id, self.uid = query[rank < self.k], score[order], ids[order], uid[order]
        last = np.flatnonzero(rank[rank < self.k] == self.k - 1)
        at = self.query[last]
        # The least integer can stand for lower products.
        reached = np.where(self.score[last] > LEAST_INTEGER, self.score[last].astype(np.float64), -np.inf)
        self.floor[at] = np.maximum(self.floor[at], reached)


def search_block(
    queries: np.ndarray, floor: np.ndarray, vectors: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int
) -> Best:
    """The best candidates of one block for a group of queries; ``floor`` is a score that k candidates reach already."""
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((uids, ids, -lengths))
    vectors, ids, uids, lengths = vectors[order], ids[order], uids[order], lengths[order]
    x, q = vectors.astype(np.float64), queries.astype(np.float64)
    dim = x.shape[1]
    if dim:
        # Right singular vectors of the block, by descending singular value.
        rotation = np.linalg.eigh((x / max(np.abs(x).max(), 1.0)).T @ (x / max(np.abs(x).max(), 1.0)))[1][:, ::-1]
        x, q = x @ rotation, q @ rotation
    head = min(dim, max(8, dim // 4))
    rest_x = np.sqrt((x[:, head:] ** 2).sum(axis=1))
    rest_q = np.sqrt((q[:, head:] ** 2).sum(axis=1))
    length_q = np.sqrt((q**2).sum(axis=1))
    best = Best(len(q), k, floor)
    small = all_below(queries, vectors)
    for at in range(0, len(x), STEP):
        part = slice(at, at + STEP)
        slack = ROUNDING * length_q * lengths[at]
        alive = np.flatnonzero(length_q * lengths[at] + slack >= best.floor)
        if not len(alive):
            break
        bound = q[alive, :head] @ x[part, :head].T
        bound += rest_q[alive, None] * rest_x[None, part]
        near = bound >= (best.floor - slack)[alive, None]
        if small and near.mean() > DENSE:
            # One matrix product is cheaper than many single ones, and as exact with numbers of this size.
            scores = queries[alive].astype(np.float64) @ vectors[part].astype(np.float64).T
            needed = best.floor[alive]
            if scores.shape[1] > k:
                needed = np.maximum(needed, np.partition(scores, -k, axis=1)[:, -k])
            row, column = np.nonzero(scores >= needed[:, None])
            found = scores[row, column].astype(np.int64)
            best.add(alive[row], found, ids[column + at], uids[column + at])
            continue
        row, column = np.nonzero(near)
        for i in range(0, len(row), 1 << 18):
            mine, other = alive[row[i : i + (1 << 18)]], column[i : i + (1 << 18)] + at
            found = products(queries[mine], vectors[other])
            reached = found >= best.floor[mine]
            best.add(mine[reached], found[reached], ids[other[reached]], uids[other[reached]])
    return best


def top_products(vectors: DataFrame, is_query: Column, k: int = TOP) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k highest inner products of each query row with other rows.

    ``vectors`` has vec_id and vector, a list of integers; ``is_query`` is a condition on vec_id. Candidates are all rows
    but the query's own, queries included; ties go to the smaller vec_id, repeated rows are candidates of each other and
    are queries of their own. Rows with a null id, vector or component take no part; vectors of different lengths have no
    product, and a query with fewer than k candidates gets all. Other columns are not read. Scores and components beyond 64
    bits are the nearest 64-bit integer.
    """
    rows = vectors.select("vec_id", "vector").where(
        F.col("vec_id").isNotNull() & F.coalesce(F.forall("vector", lambda x: x.isNotNull()), F.lit(False))
    )
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    # Row numbers are fixed by the table that is written here.
    base = stored(
        rows.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("vector").cast("array<bigint>").alias("vector"),
            F.size("vector").alias("dim"),
            length.alias("norm"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        ),
        "top-vectors",
    )
    # Of equal vectors the first k + 1 are enough for any query, which leaves out one row at most.
    copies = Window.partitionBy("vector").orderBy("vec_id", "uid")
    distinct = base.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).withColumn(
        "step", F.when(F.col("norm") > 0, F.floor(F.log2("norm") * LENGTH_STEPS)).otherwise(-(1 << 30)).cast("int")
    )
    candidates = stored(distinct.select("uid", "vec_id", "vector", "dim", "norm", "step"), "top-candidates")
    wanted = F.least(F.lit(BLOCK_VECTORS), F.greatest(F.lit(STEP), F.lit(BLOCK_NUMBERS) / F.greatest("dim", F.lit(1))))
    # One row for each length of vector and step of norms; a crowded step is dealt over blocks by a hash.
    steps = candidates.groupBy("dim", "step").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).withColumn(
        "blocks", F.ceil(F.col("n") / wanted).cast("int")
    )
    dealt = F.pmod(F.xxhash64("uid"), F.lit(1 << 30))
    placed = candidates.join(steps.select("dim", "step", "blocks"), ["dim", "step"]).withColumn(
        "block", (dealt % F.col("blocks")).cast("int")
    )
    blocks = steps.select("dim", "step", "longest", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    top_step = steps.groupBy("dim").agg(F.max("step").alias("step")).withColumn("block", F.lit(0))

    queries = base.where("is_query")
    # Equal queries are asked once, under the smallest row number.
    asked = stored(queries.groupBy("vector", "dim", "norm").agg(F.min("uid").alias("uid")), "top-queries")
    answers_to = queries.select("vector", "vec_id", F.col("uid").alias("own")).join(asked.select("vector", "uid"), "vector")
    groups = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).cast("int").alias("groups"))
    asked = asked.join(groups, "dim").withColumn("grp", (dealt % F.col("groups")).cast("int")).drop("groups")

    # First round: a few of the longest vectors against every group, for a score that k candidates reach.
    number = groups.select("dim", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("grp"))
    first = stored(
        _compare(
            asked.join(top_step, "dim").withColumn("floor", F.lit(float("-inf"))),
            placed.join(top_step, ["dim", "step", "block"]).join(number, "dim"),
            k + 1,
        ),
        "top-first",
    )
    floors = first.groupBy("uid").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("floor")).select(
        "uid", F.when(F.col("found") > k, F.col("floor").cast("double")).alias("floor")
    )
    asked = asked.join(floors, "uid", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    # The group's easiest query: what length a vector needs for it. One row for each group and block.
    needs = asked.groupBy("dim", "grp").agg(
        F.min(F.when((F.col("floor") <= 0) | (F.col("norm") == 0), 0.0).otherwise(F.col("floor") / F.col("norm"))).alias("need")
    )
    pairs = stored(
        needs.join(blocks, "dim")
        .where(F.col("longest") * (1 + 2 * ROUNDING) >= F.col("need"))
        .join(top_step, ["dim", "step", "block"], "left_anti")
        .select("dim", "grp", "step", "block"),
        "top-pairs",
    )
    rest = _compare(
        asked.join(pairs, ["dim", "grp"]), placed.join(pairs, ["dim", "step", "block"]), k + 1
    )
    def ranked(found: DataFrame, query: str, n: int) -> DataFrame:
        order = Window.partitionBy(query).orderBy(F.col("score").desc(), "vec_id", "other")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    best = ranked(first.unionByName(rest), "uid", k + 1).drop("rank")
    asking = answers_to.select(F.col("vec_id").alias("query_id"), "own", "uid")
    answers = asking.join(best, "uid").where("own <> other")
    return ranked(answers, "own", k).select("query_id", "rank", "vec_id", "score")


def _compare(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """At most k rows for each query and block: uid, other, vec_id, score."""
    keys = ["dim", "grp", "step", "block"]
    sent = queries.select(
        *keys, "uid", F.lit(None).cast("long").alias("vec_id"), "vector", "floor", F.lit(True).alias("asks")
    ).unionByName(
        candidates.select(
            *keys, "uid", "vec_id", "vector", F.lit(None).cast("double").alias("floor"), F.lit(False).alias("asks")
        )
    )
    schema = pa.schema([(c, pa.int64()) for c in ("uid", "other", "vec_id", "score")])

    def compare(table: pa.Table) -> pa.Table:
        asks = table.column("asks")
        mine, others = table.filter(asks), table.filter(pc.invert(asks))
        if not mine.num_rows or not others.num_rows:
            return schema.empty_table()
        dim = table.column("dim")[0].as_py()
        q, x = (
            t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, dim)
            for t in (mine, others)
        )
        uids, ids = others.column("uid").to_numpy(), others.column("vec_id").to_numpy()
        best = search_block(q, mine.column("floor").to_numpy(), x, ids, uids, k)
        columns = (mine.column("uid").to_numpy()[best.query], best.uid, best.id, best.score)
        return pa.table(dict(zip(schema.names, columns, strict=True)), schema=schema)

    return sent.groupBy(*keys).applyInArrow(compare, "uid long, other long, vec_id long, score long")
