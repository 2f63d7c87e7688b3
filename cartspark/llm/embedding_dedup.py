"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products within cells, components of the links.

A vector belongs to the cell of its nearest centroid and visits every cell that is nearly as near. The owners of a cell
are compared with its owners and visitors, so each vector's links are counted in one cell. Cells are cut into blocks of
bounded size: a cell of any size is many small products, and none of them returns more than a forest of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartspark.llm.common import stored
from cartspark.llm.components import connected_components

THRESHOLD = 0.9
# Vectors that the centroids are fitted on at most, and numbers in them.
SAMPLE_VECTORS = 20_000
SAMPLE_NUMBERS = 4_000_000
ITERATIONS = 8
MAX_CELLS = 2048
# A vector visits the cells whose cosine is at most so much below that of its own; see recall in the README.
MARGIN = 0.2
OWNER_BLOCK = 2048
VISITOR_BLOCK = 4096
SEED = 5


def spherical_kmeans(vectors: np.ndarray, k: int, seed: int = SEED, iterations: int = ITERATIONS) -> np.ndarray:
    """Centroids of length 1; a cell that loses all vectors takes the one that fits its cell worst."""
    rng = np.random.default_rng(seed)
    centroids = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(iterations):
        cosines = vectors @ centroids.T
        cell = cosines.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, cell, vectors)
        lengths = np.linalg.norm(sums, axis=1)
        empty = np.flatnonzero(lengths < 1e-9)
        worst = np.argsort(cosines.max(axis=1), kind="stable")[: len(empty)]
        sums[empty[: len(worst)]] = vectors[worst]
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def unit_rows(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of length 1, in double precision."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_centroids(vectors: DataFrame, counts: dict[int, int]) -> dict[int, np.ndarray]:
    """Centroids for each length of vector, from a bounded sample chosen by a hash of the id."""
    centroids = {}
    for dim, n in counts.items():
        bound = max(1, min(SAMPLE_VECTORS, SAMPLE_NUMBERS // dim))
        point = F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(1_000_000)) / 1_000_000
        chosen = vectors.where((F.col("dim") == dim) & (point < min(1.0, bound / n))).select("rep", "vector")
        sample = chosen.limit(2 * bound).toArrow().sort_by("rep")
        if not sample.num_rows:
            sample = vectors.where(F.col("dim") == dim).orderBy("rep").limit(1).select("rep", "vector").toArrow()
        rows = unit_rows(sample.column("vector").combine_chunks())
        k = max(1, min(MAX_CELLS, math.isqrt(n), len(rows) // 8))
        centroids[dim] = spherical_kmeans(rows, k)
    return centroids


def forest(links: np.ndarray, owners: np.ndarray, visitors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what a matrix of links between owners and visitors connects: (node, least node)."""
    rows, columns = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
    links = links[np.ix_(rows, columns)]
    owner, visitor = owners[rows], visitors[columns]
    top = np.iinfo(np.int64).max
    row_label, column_label = owner.copy(), visitor.copy()
    while True:
        new_column = np.minimum(column_label, np.where(links, row_label[:, None], top).min(axis=0, initial=top))
        new_row = np.minimum(row_label, np.where(links, new_column[None, :], top).min(axis=1, initial=top))
        if (new_row == row_label).all() and (new_column == column_label).all():
            break
        row_label, column_label = new_row, new_column
    node = np.concatenate((owner, visitor))
    label = np.concatenate((row_label, column_label))
    moved = node != label
    return node[moved], label[moved]


def link_embeddings(embeddings: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """One row per row of vec_id and embedding: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows found with a cosine of at least ``threshold``; ``component_id`` is the smallest
    vec_id reachable by links; ``kept`` marks the one representative of each component. A vector that is null, empty,
    all zero, or holds a null or a number that is not finite links with nothing, nor does one without an id, nor do
    vectors of different lengths with each other. Equal vectors are one vector with a count. Extra columns are not read.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select("vec_id", F.col("embedding").alias("vector"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(finite & F.col("vec_id").isNotNull(), F.lit(False))
    vectors = stored(
        rows.where(usable)
        .groupBy("vector")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dim", F.size("vector")),
        "vectors",
    )
    # Lengths of vectors that fill no block have one cell; so a row here stands for 2,048 vectors and more.
    frequent = vectors.groupBy("dim").count().where(F.col("count") > OWNER_BLOCK).collect()
    counts = {row["dim"]: row["count"] for row in frequent}
    centroids = spark.sparkContext.broadcast(fit_centroids(vectors, counts))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims):
                    part = batch.filter(pa.array(dims == dim))
                    if int(dim) in centroids.value:
                        cosines = unit_rows(part.column("vector")) @ centroids.value[int(dim)].T
                    else:
                        cosines = np.ones((part.num_rows, 1))
                    best = cosines.argmax(axis=1)
                    index, cell = np.nonzero(cosines >= cosines.max(axis=1, keepdims=True) - margin)
                    chosen = part.take(pa.array(index))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(chosen.column(c) for c in ("dim", "rep", "copies", "vector")),
                            pa.array(cell.astype(np.int32)),
                            pa.array(cell == best[index]),
                        ],
                        names=["dim", "rep", "copies", "vector", "cell", "owned"],
                    )

    number = vectors.schema["vector"].dataType.simpleString()
    base = f"dim int, rep long, copies long, vector {number}, cell int"
    visits = stored(vectors.select("dim", F.col("rep").cast("long"), "copies", "vector").mapInArrow(
        assign, f"{base}, owned boolean"
    ), "cells")
    sizes = visits.groupBy("dim", "cell").agg(
        F.ceil(F.count_if("owned") / OWNER_BLOCK).cast("int").alias("owner_blocks"),
        F.ceil(F.count(F.lit(1)) / VISITOR_BLOCK).cast("int").alias("visitor_blocks"),
    ).where("owner_blocks > 0")
    sized = visits.join(sizes, ["dim", "cell"])
    spread = F.pmod(F.xxhash64("rep"), F.lit(1 << 30))
    owners = sized.where("owned").select(
        "dim", "cell", "rep", "copies", "vector", F.lit(True).alias("owner"),
        (spread % F.col("owner_blocks")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("visitor_blocks") - 1)).alias("j"),
    )
    visitors = sized.select(
        "dim", "cell", "rep", "copies", "vector", F.lit(False).alias("owner"),
        F.explode(F.sequence(F.lit(0), F.col("owner_blocks") - 1)).alias("i"),
        (spread % F.col("visitor_blocks")).cast("int").alias("j"),
    )

    def compare(table: pa.Table) -> pa.Table:
        mine = table.filter(table.column("owner"))
        others = table.filter(pc.invert(table.column("owner")))
        out = pa.schema([("kind", pa.string()), ("node", pa.int64()), ("value", pa.int64())])
        if not mine.num_rows or not others.num_rows:
            return out.empty_table()
        a, b = (unit_rows(t.column("vector").combine_chunks()) for t in (mine, others))
        a_id, b_id = (t.column("rep").to_numpy() for t in (mine, others))
        links = np.concatenate([a[i : i + 256] @ b.T >= threshold for i in range(0, len(a), 256)])
        links &= a_id[:, None] != b_id[None, :]
        counts = links.astype(np.float64) @ others.column("copies").to_numpy().astype(np.float64)
        found = np.flatnonzero(counts)
        node, least = forest(links, a_id, b_id)
        kind = np.repeat(["count", "edge"], [len(found), len(node)])
        return pa.table(
            {
                "kind": pa.array(kind, pa.string()),
                "node": np.concatenate((a_id[found], node)),
                "value": np.concatenate((counts[found].astype(np.int64), least)),
            },
            schema=out,
        )

    compared = stored(
        owners.unionByName(visitors)
        .groupBy("dim", "cell", "i", "j")
        .applyInArrow(compare, "kind string, node long, value long"),
        "links",
        ("kind",),
    )
    counted = compared.where("kind = 'count'").groupBy("node").agg(F.sum("value").alias("found"))
    components = connected_components(compared.where("kind = 'edge'").select("node", "value"))
    judged = (
        vectors.join(counted, F.col("rep") == counted["node"], "left")
        .drop("node")
        .join(components, F.col("rep") == components["node"], "left")
        .select(
            "vector",
            (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    good = rows.where(usable).join(judged, "vector").select("vec_id", "n_links", "component_id")
    bad = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
