"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, reranking with the original vectors.

Rotations are learned on a bounded sample so that the signs of the rotated vectors lose least. A vector's codes are cut
into substrings, each the key of a table; vectors that share a key are candidates. Substrings grow with the logarithm of
the number of vectors, so that unrelated vectors seldom share one, and their number is chosen so that a pair at the
threshold shares one with probability RECALL. Identical vectors form a class, and the work is done on classes. Candidates
are compared by Hamming distance, then by cosine in double precision; links make components, and within a component
every pair is compared, block by block, so the counts of links there are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cambio.llm.buckets import cells, cells_within
from cambio.llm.common import written
from cambio.llm.components import components

COSINE = 0.9
RECALL = 0.95
#: Vectors the rotations are learned on, those whose id has the smallest hash, and rounds of learning.
SAMPLE_ROWS = 4096
ROUNDS = 12
#: Bits of the code that candidates are compared by, and how many may differ: at COSINE, four deviations above the mean.
CODE_BITS = 64
MOST_DIFFERENT = 20


@dataclass(frozen=True)
class Tables:
    """Rotations (each dims x dims) and bits per substring."""

    rotations: list[np.ndarray]
    bits: int
    dims: int


def learn_rotation(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """An orthogonal matrix such that the signs of ``x @ it`` are near ``x @ it``, from a random start.

    Alternates between the codes of the rotated vectors and the rotation that fits the codes best. Vectors are not
    centred: a cosine is of the vectors as they are, and signs of centred ones would part vectors that it links.
    """
    dims = x.shape[1]
    rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    for _ in range(ROUNDS if len(x) else 0):
        left, _, right = np.linalg.svd(x.T @ np.where(x @ rotation >= 0, 1.0, -1.0))
        rotation = left @ right
    return rotation


def plan_tables(sample: np.ndarray, count: int, dims: int) -> Tables:
    """Substring length and number of rotations for ``count`` vectors, and the rotations."""
    bits = int(min(max(math.ceil(math.log2(max(count, 2))) + 4, 8), 48, dims))
    shared = (1 - math.acos(COSINE) / math.pi) ** bits
    wanted = math.ceil(math.log(1 - RECALL) / math.log(1 - shared)) if shared < 1 else 1
    per_rotation = max(dims // bits, 1)
    rng = np.random.default_rng(11)
    rotations = [learn_rotation(sample, rng) for _ in range(math.ceil(wanted / per_rotation))]
    return Tables(rotations, bits, dims)


def table_keys(unit: np.ndarray, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """rows x tables keys (table number and substring in one number), and the code of the first rotations."""
    keys, code = [], np.zeros((len(unit), 0), bool)
    weights = np.uint64(1) << np.arange(tables.bits, dtype=np.uint64)
    for rotation in tables.rotations:
        signs = unit @ rotation >= 0
        if code.shape[1] < CODE_BITS:
            code = np.concatenate([code, signs], axis=1)
        for begin in range(0, max(tables.dims // tables.bits, 1) * tables.bits, tables.bits):
            part = signs[:, begin : begin + tables.bits].astype(np.uint64) @ weights[: tables.bits]
            keys.append(part | np.uint64(len(keys) << 48))
    code = code[:, :CODE_BITS]
    packed = np.zeros((len(unit), 8), np.uint8)
    bits = np.packbits(code, axis=1)
    packed[:, : bits.shape[1]] = bits
    return np.stack(keys, axis=1).view(np.int64), packed.view(np.int64)[:, 0]


def _vectors(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dims)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    whole = F.col(vector).isNotNull() & F.forall(vector, lambda v: F.coalesce(finite(v), F.lit(False)))
    return F.coalesce(whole & F.exists(vector, lambda v: v != 0), F.lit(False))


def classes_of(rows: DataFrame, dims: int) -> DataFrame:
    """(vec_id, h1, h2, raw): each vector as bytes of doubles, a shorter one filled up with zeros, and a hash of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, digests = [], []
            for values in batch.column("vector").to_pylist():
                one = np.zeros(dims)
                one[: len(values)] = values
                one += 0.0  # minus zero is zero
                raw.append(one.tobytes())
                digests.append(np.frombuffer(hashlib.blake2b(raw[-1], digest_size=16).digest(), np.int64))
            hashes = np.array(digests, np.int64).reshape(-1, 2)
            columns = [batch.column("vec_id"), *(pa.array(hashes[:, k]) for k in (0, 1)), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "h1", "h2", "raw"])

    return rows.mapInArrow(run, "vec_id bigint, h1 bigint, h2 bigint, raw binary")


def index(classes: DataFrame, tables: Tables) -> DataFrame:
    """(id, code, keys) of every class."""
    shared = classes.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, code = table_keys(_unit(_vectors(batch.column("raw"), shared.value.dims)), shared.value)
                columns = [batch.column("id"), pa.array(code), pa.array(list(keys), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "code", "keys"])

    return classes.select("id", "raw").mapInArrow(run, "id bigint, code bigint, keys array<bigint>")


def rerank(pairs: DataFrame, vectors: DataFrame, dims: int) -> DataFrame:
    """The pairs (a, b) whose cosine reaches the threshold."""
    both = pairs.join(vectors.select(F.col("id").alias("a"), F.col("raw").alias("raw_a")), "a")
    both = both.join(vectors.select(F.col("id").alias("b"), F.col("raw").alias("raw_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = (_unit(_vectors(batch.column(f"raw_{x}"), dims)) for x in "ab")
                near = pa.array((one * other).sum(axis=1) >= COSINE)
                yield batch.select(["a", "b"]).filter(near)

    return both.select("a", "b", "raw_a", "raw_b").mapInArrow(run, "a bigint, b bigint")


def rerank_cells(dealt: DataFrame, vectors: DataFrame, dims: int) -> DataFrame:
    """A link (a, b) of every two components that are linked within a cell."""

    def compare(cell: pa.Table) -> pa.Table:
        ids, component = cell["id"].to_numpy(), cell["component"].to_numpy()
        unit = _unit(_vectors(cell["raw"], dims))
        one, other = np.nonzero((unit @ unit.T >= COSINE) & (component[:, None] < component[None, :]))
        pairs = np.stack([component[one], component[other]], axis=1)
        at = np.unique(pairs, axis=0, return_index=True)[1]
        return pa.table({"a": pa.array(ids[one[at]], pa.int64()), "b": pa.array(ids[other[at]], pa.int64())})

    return dealt.join(vectors, "id").groupBy("key", "p", "q").applyInArrow(compare, "a bigint, b bigint")


def count_links(groups: DataFrame, vectors: DataFrame, dims: int) -> DataFrame:
    """(id, links): for every member of a component, the vectors of other classes that it is linked with."""

    def count(cell: pa.Table) -> pa.Table:
        ids, copies = cell["id"].to_numpy(), cell["copies"].to_numpy()
        unit = _unit(_vectors(cell["raw"], dims))
        near = unit @ unit.T >= COSINE
        np.fill_diagonal(near, False)
        if cell["p"][0].as_py() != cell["q"][0].as_py():
            first = cell["first"].to_numpy()
            near &= first[:, None] != first[None, :]
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(near @ copies, pa.int64())})

    dealt = cells_within(groups.select("component", "id")).join(vectors, "id")
    counted = dealt.groupBy("component", "p", "q").applyInArrow(count, "id bigint, links bigint")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicate_vectors(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    A vector that is null, empty or zero, or holds a null or non-finite component, is linked with nothing, nor is a row
    without an id, whose component is null. Copies are linked with each other; rows that repeat an id count as rows. A
    shorter vector counts as filled up with zeros. An empty table gives no rows. Other columns are not read.
    """
    rows = embeddings.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    able = rows.where(F.col("vec_id").isNotNull() & usable("vector"))
    facts = able.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vector")).alias("dims")).first()
    alone = [F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")]
    if not facts["rows"]:
        return rows.select("vec_id", *alone, F.lit(True).alias("kept"))
    dims = facts["dims"]
    hashed = written(classes_of(able, dims), "vectors")
    classes = hashed.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw")
    )
    classes = written(classes, "vector-classes")
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("raw").toArrow()
    tables = plan_tables(_unit(_vectors(sample["raw"], dims)), facts["rows"], dims)
    entries = index(classes, tables).select("id", "code", F.explode("keys").alias("key"))
    least = F.min(F.struct("id", "code"))
    buckets = entries.groupBy("key").agg(least.alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(entries.join(buckets, "key"), "bucket-members")
    stars = (
        members.where(F.col("id") != F.col("least.id"))
        .where(F.bit_count(F.col("code").bitwiseXOR(F.col("least.code"))) <= MOST_DIFFERENT)
        .select(F.col("least.id").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    vectors = classes.select("id", "copies", "raw")
    groups = written(components(rerank(stars, vectors, dims)), "vector-groups")
    # a bucket of two is settled by its one comparison
    left = members.where("n > 2").join(groups, "id", "left")
    left = left.select("key", "id", F.coalesce("component", "id").alias("component"))
    more = written(rerank_cells(cells(left), vectors, dims), "more-vector-links")
    if not more.isEmpty():
        found = groups.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(more)
        groups = written(components(found), "vector-groups")
    links = count_links(groups, vectors, dims)
    answer = (
        classes.select("h1", "h2", "id", "copies")
        .join(groups, "id", "left")
        .join(links, "id", "left")
        .select(
            "h1",
            "h2",
            F.coalesce("component", "id").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        )
    )
    linked = hashed.select("vec_id", "h1", "h2").join(answer, ["h1", "h2"]).select(
        "vec_id", F.col("links").cast("bigint").alias("n_links"), F.col("component").alias("component_id")
    )
    unable = rows.where(~(F.col("vec_id").isNotNull() & usable("vector"))).select("vec_id", *alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return linked.unionByName(unable).withColumn("kept", kept)
