"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are dealt into blocks near a pivot, queries into bundles. A block and a bundle meet in one task, which builds a
cover tree of each and walks them together: a pair of nodes whose best possible score, from the centres and covering
radii, is below the worst k-th score of the node's queries is dropped with all that is below it. Bundles first meet the
block that promises most; the k-th scores found there let whole blocks be dropped before anything is sent to them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cambio.llm.common import written

#: Rows of a block and queries of a bundle, about; more near one pivot are cut up by a hash.
BLOCK_ROWS = 2048
BUNDLE_QUERIES = 4096
#: Pivots: a bounded sample of vectors, those whose id has the smallest hash.
MOST_PIVOTS = 256
#: A node with at most so many points is a leaf; each level of a tree covers with half the radius of the one above.
LEAF_POINTS = 64
SHRINK = 0.5

CELL_SCHEMA = "query_key bigint, query_id bigint, vec_id bigint, score bigint"


@dataclass
class Node:
    """A centre, the largest distance from it to a point below, and either points or children."""

    centre: np.ndarray
    radius: float
    points: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(x: np.ndarray) -> Node:
    """The tree over the rows of ``x``.

    The children of a node are centred at points of it that are further apart than the children's covering radius, half
    the node's own; the first child keeps the node's centre. Points that no other point joins share one leaf.
    """

    squares = (x * x).sum(axis=1)

    def build(points: np.ndarray, centre: np.ndarray) -> Node:
        own = x[points]
        node = Node(centre, float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())), points)
        if len(points) <= LEAF_POINTS or node.radius == 0:
            return node
        reach, alone = (node.radius * SHRINK) ** 2, []
        left, here, first = np.ones(len(points), bool), centre, None
        while left.any():
            # by one matrix product; which child takes a point on the border doesn't matter, its radius is measured
            near = left & (squares[points] - 2 * (own @ here) + here @ here <= reach)
            if first is not None:
                near[first] = True  # the point itself, whatever the rounding
            if near.all():
                return node  # its only child would be the node itself
            if near.sum() == 1:
                alone.append(points[near])
            elif near.any():
                node.children.append(build(points[near], here))
            left &= ~near
            if left.any():
                first = int(left.argmax())
                here = own[first]
        if alone:
            loose = np.concatenate(alone)
            for part in np.array_split(loose, -(-len(loose) // LEAF_POINTS)):
                middle = x[part].mean(axis=0)
                node.children.append(Node(middle, float(np.sqrt(((x[part] - middle) ** 2).sum(axis=1)).max()), part))
        return node

    return build(np.arange(len(x)), x.mean(axis=0))


def promise(a: Node, b: Node) -> float:
    """No inner product of points below the two nodes is larger."""
    return _promise(a.centre, a.radius, b.centre, b.radius)


def _promise(p: np.ndarray, r: float, q: np.ndarray, s: float) -> float:
    norms = np.sqrt(p @ p), np.sqrt(q @ q)
    best = p @ q + r * norms[1] + s * norms[0] + r * s
    return float(best + 1e-9 * (abs(best) + (norms[0] + r) * (norms[1] + s)) + 1e-9)  # rounding never drops a pair


class Search:
    """Top k of each query over the rows of ``x``; ``floor`` are scores that a result must reach to matter."""

    def __init__(self, q: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
        self.q, self.query_ids, self.x, self.ids, self.k = q, query_ids, x, ids, k
        self.qf, self.xf = q.astype(np.float64), x.astype(np.float64)
        self.worst = floor.astype(np.float64)
        self.scores = np.full((len(q), k), np.iinfo(np.int64).min)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max)
        # sums of products are exact in doubles below 2 ** 53; beyond, in 64-bit integers
        self.small = np.abs(self.qf).max(initial=0) * np.abs(self.xf).max(initial=0) * max(x.shape[1], 1) < 2**53

    def run(self) -> None:
        if len(self.q) and len(self.x):
            self.visit(cover_tree(self.qf), cover_tree(self.xf))

    def visit(self, first: Node, second: Node) -> None:
        stack = [(promise(first, second), first, second)]
        while stack:
            best, a, b = stack.pop()
            if best < self.worst[a.points].min():
                continue
            if not a.children and not b.children:
                self.compare(a.points, b.points)
                continue
            # open the larger node; the most promising child is popped first
            if b.children and (not a.children or b.radius >= a.radius):
                pairs = [(a, child) for child in b.children]
            else:
                pairs = [(child, b) for child in a.children]
            stack += sorted(((promise(c, d), c, d) for c, d in pairs), key=lambda e: e[0])

    def compare(self, rows: np.ndarray, others: np.ndarray) -> None:
        if self.small:
            scores = (self.qf[rows] @ self.xf[others].T).astype(np.int64)
        else:
            scores = self.q[rows] @ self.x[others].T
        # most blocks hold nothing better than what is known: only queries with a candidate go on, with those candidates
        better = scores >= self.worst[rows][:, None]
        some = better.any(axis=1)
        if not some.any():
            return
        rows, others, scores = rows[some], others[better.any(axis=0)], scores[some][:, better.any(axis=0)]
        ids = np.broadcast_to(self.ids[others], scores.shape)
        own = ids == self.query_ids[rows][:, None]
        scores = np.concatenate([self.scores[rows], np.where(own, np.iinfo(np.int64).min, scores)], axis=1)
        ids = np.concatenate([self.found[rows], np.where(own, np.iinfo(np.int64).max, ids)], axis=1)
        # descending score, then ascending id; ~s reverses the order without overflow
        order = np.lexsort((ids, ~scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, order, axis=1)
        self.found[rows] = np.take_along_axis(ids, order, axis=1)
        last = self.scores[rows][:, -1]
        full = self.found[rows][:, -1] != np.iinfo(np.int64).max
        self.worst[rows] = np.maximum(self.worst[rows], np.where(full, last, -np.inf))


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, factor: int) -> DataFrame:
    """(vec_id, values): floor(factor * x) of every usable vector; rows that repeat an id and a vector count once.

    Values beyond 64 bits take the nearest 64-bit value.
    """
    edge = float(1 << 62)
    finite = lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False))
    values = F.transform(
        "vector", lambda v: F.floor(F.greatest(F.least(v * factor, F.lit(edge)), F.lit(-edge))).cast("bigint")
    )
    return (
        rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite))
        .select("vec_id", values.alias("values"))
        .distinct()
    )


def _matrix(column, dims: int) -> np.ndarray:
    """Rows of equal length; a shorter vector is filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), dims), np.int64)
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        out[i, : b - a] = values[a:b]
    return out


def dealt(vectors: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """Adds ``pivot``, the number of the nearest pivot, and the distance to it."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        squares = (centres * centres).sum(axis=1)
        for batch in batches:
            x = _matrix(batch.column("values"), dims).astype(np.float64)
            near = (squares[None, :] - 2 * x @ centres.T).argmin(axis=1)
            away = np.sqrt(((x - centres[near]) ** 2).sum(axis=1))
            columns = [*batch.columns, pa.array(near.astype(np.int32)), pa.array(away)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "pivot", "away"])

    return vectors.mapInArrow(run, "vec_id bigint, values array<bigint>, pivot int, away double")


def grouped(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with a group number column, and per group its pivot and covering radius.

    Rows near one pivot make one group, or as many by a hash of the id as their number asks for.
    """
    counts = rows.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vec_id", F.lit(name)), F.col("parts"))
    # at most MOST_PIVOTS rows, so broadcasting them is safe
    out = rows.join(F.broadcast(counts), "pivot").withColumn(name, (part * MOST_PIVOTS + F.col("pivot")).cast("bigint"))
    return out, out.groupBy(name).agg(F.first("pivot").alias("pivot"), F.max("away").alias("radius"))


def _bound(pivots: np.ndarray, spark, prefix: str, other: str) -> Column:
    """The largest inner product that a pair of groups allows, from their pivots and radii."""
    shared = spark.sparkContext.broadcast(pivots)

    @F.pandas_udf("double")
    def best(p: pd.Series, r: pd.Series, q: pd.Series, s: pd.Series) -> pd.Series:
        one, two = shared.value[p.to_numpy()], shared.value[q.to_numpy()]
        r, s = r.to_numpy(), s.to_numpy()
        norm = lambda v: np.sqrt((v * v).sum(axis=1))
        value = (one * two).sum(axis=1) + r * norm(two) + s * norm(one) + r * s
        slack = 1e-9 * (np.abs(value) + (norm(one) + r) * (norm(two) + s)) + 1e-9
        return pd.Series(value + slack)

    return best(f"{prefix}_pivot", f"{prefix}_radius", f"{other}_pivot", f"{other}_radius")


def search_cells(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, dims: int, k: int) -> DataFrame:
    """CELL_SCHEMA: the top k of each query within each block of the pairs (bundle, block).

    ``queries`` have ``floor``, a score that a result must reach to matter.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        query_ids, keys = left["vec_id"].to_numpy(), left["query_key"].to_numpy()
        ids = right["x_vec_id"].to_numpy()
        x = _matrix(right["x_values"], dims)
        search = Search(_matrix(left["values"], dims), query_ids, left["floor"].to_numpy(), x, ids, k)
        search.run()
        row, place = np.nonzero(search.found != np.iinfo(np.int64).max)
        return pa.table(
            {
                "query_key": pa.array(keys[row]),
                "query_id": pa.array(query_ids[row]),
                "vec_id": pa.array(search.found[row, place]),
                "score": pa.array(search.scores[row, place]),
            }
        )

    left = queries.join(pairs, "bundle").select("bundle", "block", "query_key", "vec_id", "values", "floor")
    # both sides come from the same table: new names keep their columns apart
    names = ("bundle", "block", "vec_id", "values")
    right = blocks.join(pairs, "block").select(*[F.col(c).alias(f"x_{c}") for c in names])
    cells = left.groupBy("bundle", "block").cogroup(right.groupBy("x_bundle", "x_block"))
    return cells.applyInArrow(run, CELL_SCHEMA)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, with their rank."""
    order = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_inner_products(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 5,
    factor: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every query, the k other vectors with the largest integer inner products.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller id. Vectors that are null or hold a null or
    non-finite component take no part, nor do rows without an id; empty vectors score 0. Rows that repeat id and vector
    count once; rows with the query's id are no candidates of it, whatever their vector, and a query id with two vectors
    has two answers. A query without candidates has no row.
    """
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings, vec_id, vector, factor)
    vectors = written(vectors, "whole-vectors")
    facts = vectors.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_query).alias("queries"), F.max(F.size("values")).alias("dims")
    ).first()
    dims = max(facts["dims"] or 0, 1)
    count = int(min(max(facts["rows"] // BLOCK_ROWS, 1), MOST_PIVOTS))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "values").limit(count).toArrow()
    pivots = _matrix(sample["values"], dims).astype(np.float64) if facts["rows"] else np.zeros((1, dims))
    near = written(dealt(vectors, pivots, dims), "dealt-vectors")
    blocks, block_facts = grouped(near.select("vec_id", "values", "pivot", "away"), BLOCK_ROWS, "block")
    # fewer pivots for the queries: a block is sent, and its tree built, once for every bundle that it stays open to
    few = pivots[: min(max(-(-facts["queries"] // BUNDLE_QUERIES), 1), len(pivots))]
    asked = dealt(vectors.where(is_query), few, dims).withColumn("query_key", F.xxhash64("vec_id", "values"))
    queries, bundle_facts = grouped(asked, BUNDLE_QUERIES, "bundle")
    block_facts = block_facts.select(
        "block", F.col("pivot").alias("block_pivot"), F.col("radius").alias("block_radius")
    )
    bundle_facts = bundle_facts.select(
        "bundle", F.col("pivot").alias("bundle_pivot"), F.col("radius").alias("bundle_radius")
    )
    # the query set meets all rows in blocks: a row per bundle and block, not per query and vector
    every_pivot = F.explode(F.sequence(F.lit(0), F.lit(len(few) - 1)))
    meet = block_facts.withColumn("bundle_pivot", every_pivot).join(bundle_facts, "bundle_pivot")
    meet = written(meet.withColumn("best", _bound(pivots, spark, "bundle", "block")), "bundle-blocks")
    home = meet.groupBy("bundle").agg(F.max_by("block", F.struct("best", "block")).alias("block"))
    start = queries.withColumn("floor", F.lit(float("-inf")))
    first = written(best_of(search_cells(home, start, blocks, dims, k), k), "first-results")
    floors = first.where(F.col("rank") == k).select("query_key", F.col("score").cast("double").alias("floor"))
    known = queries.join(floors, "query_key", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    known = written(known, "queries")
    least = known.groupBy("bundle").agg(F.min("floor").alias("least"))
    open_pairs = (
        meet.join(home.select("bundle", F.col("block").alias("home")), "bundle")
        .join(least, "bundle")
        .where((F.col("block") != F.col("home")) & (F.col("best") >= F.col("least")))
        .select("bundle", "block")
    )
    more = search_cells(written(open_pairs, "open-pairs"), known, blocks, dims, k)
    every = first.select("query_key", "query_id", "vec_id", "score").unionByName(more)
    return best_of(every, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
