"""Near-duplicate documents: hash minima with banding, verification, and connected components.

Documents with equal shingle sets form a class; the rest works on one representative of each. A bucket holds the classes
that share a band of minima. Each bucket's members are first compared with its smallest one. What is then still apart
within a bucket, component against component, is compared in cells of bounded size, so a link between different texts is
only lost if they share no band, or if the signature is off by five standard deviations; at the threshold either has a
chance of about 1 in 200,000. Every link is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cambio.llm.buckets import cells
from cambio.llm.common import hits, id_sketch, map_rows, maybe_in, place_of, text_chunks, written
from cambio.llm.components import components
from cambio.llm.shingles import hash_functions, minima, mixed, shingle_sets

BANDS = 32
ROWS = 4
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Of the 8-bit signature, the share that has to agree before sets are compared; the threshold less five deviations.
LEAST_AGREEMENT = 0.55

#: Classes whose smallest id several rows have take a number from here on in its place.
FIRST_STAND_IN = 1 << 62

FINGERPRINT_SCHEMA = "doc_id bigint, text_key bigint, n_shingles bigint, h1 bigint, h2 bigint, bands array<bigint>"
SET_SCHEMA = "id bigint, signature binary, shingles array<bigint>"


def band_keys(lows: np.ndarray) -> np.ndarray:
    """rows x BANDS keys of 64 bits."""
    parts = lows.reshape(len(lows), BANDS, ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
        for k in range(0, ROWS, 2):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + (parts[:, :, k] << np.uint64(32) | parts[:, :, k + 1]))
    return keys.view(np.int64)


def set_hash(one: np.ndarray) -> list[int]:
    """128 bits that name a set, as two numbers."""
    return np.frombuffer(hashlib.blake2b(one.tobytes(), digest_size=16).digest(), np.int64).tolist()


def fingerprints(documents: DataFrame) -> DataFrame:
    """FINGERPRINT_SCHEMA of every document: hash of the text, set size, 128-bit hash of the set, band keys.

    The last three are null where a set is empty.
    """
    names = [c.split(" ")[0] for c in FINGERPRINT_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = hash_functions(BANDS * ROWS)
        for batch, texts in text_chunks(batches):
            sets = shingle_sets(texts)
            some = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            h1, h2 = list(bands), list(bands)
            keys = band_keys(minima([sets[i] for i in some], functions))
            for i, row in zip(some, keys, strict=True):
                h1[i], h2[i] = set_hash(sets[i])
                bands[i] = row
            columns = [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(h1, pa.int64()),
                pa.array(h2, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", _text_key().alias("text_key"))
    return map_rows(rows, run, FINGERPRINT_SCHEMA)


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def with_class_id(rows: DataFrame, repeats: DataFrame) -> DataFrame:
    """Rows (doc_id, h1, h2) with ``id``, and ``shared`` where it is a stand-in: of ids (doc_id) that ``repeats`` holds.

    Other ids belong to one row, so they name its set. A repeated one may have several sets, and its hash names the set.
    """
    stand_in = F.lit(FIRST_STAND_IN) + F.shiftrightunsigned(F.xxhash64("h1", "h2"), 2)
    marked = rows.join(repeats.select("doc_id", F.lit(True).alias("shared")), "doc_id", "left")
    return marked.withColumn("id", F.when(F.col("shared"), stand_in).otherwise(F.col("doc_id")))


def full_sets(documents: DataFrame, ids: DataFrame, repeats: DataFrame) -> DataFrame:
    """SET_SCHEMA of the documents with the given ids (column ``doc_id``), and of a few others.

    The ids' sketch is applied in the scan, so no text is shuffled, and only sets of repeated ids are.
    """
    shared = documents.sparkSession.sparkContext.broadcast(id_sketch(ids, "doc_id"))
    names = ["doc_id", "h1", "h2", "signature", "shingles"]

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(hits(shared.value, batch.column("place").to_numpy())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = hash_functions(BANDS * ROWS)
        for batch, texts in text_chunks(wanted(batches)):
            sets = shingle_sets(texts)
            some = [i for i, s in enumerate(sets) if len(s)]
            signatures = minima([sets[i] for i in some], functions).astype(np.uint8)
            hashes = np.array([set_hash(sets[i]) for i in some], np.int64).reshape(-1, 2)
            columns = [
                batch.column("doc_id").take(pa.array(some, pa.int64())),
                *(pa.array(hashes[:, k]) for k in (0, 1)),
                pa.array([s.tobytes() for s in signatures], pa.binary()),
                pa.array([sets[i].view(np.int64) for i in some], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    schema = "doc_id bigint, h1 bigint, h2 bigint, signature binary, shingles array<bigint>"
    sets = with_class_id(map_rows(rows.withColumn("place", place_of("doc_id")), run, schema), repeats)
    columns = ["id", "signature", "shingles"]
    again = sets.where("shared").select(*columns).dropDuplicates(["id"])
    return sets.where("shared IS NULL").select(*columns).unionByName(again)


def alike(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sorted sets are linked."""
    together = np.concatenate([one, other])
    together.sort(kind="stable")
    common = int((together[1:] == together[:-1]).sum())
    return 100 * common >= PERCENT * (len(one) + len(other) - common)


def _sets_of(column: pa.Array) -> list[np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _signatures_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked: signatures first, then the full sets."""
    side = lambda name: sets.select(*[F.col(c).alias(f"{c}_{name}") for c in sets.columns])
    both = pairs.join(side("a"), pairs["a"] == F.col("id_a")).join(side("b"), pairs["b"] == F.col("id_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (_signatures_of(batch.column(f"signature_{x}")) for x in "ab")
            first, second = (_sets_of(batch.column(f"shingles_{x}")) for x in "ab")
            near = np.flatnonzero((one == other).mean(axis=1) >= LEAST_AGREEMENT)
            linked = pa.array([i for i in near.tolist() if alike(first[i], second[i])], pa.int64())
            yield batch.select(["a", "b"]).take(linked)

    chosen = both.select("a", "b", "signature_a", "signature_b", "shingles_a", "shingles_b")
    return map_rows(chosen, run, "a bigint, b bigint")


def verify_cells(dealt: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b) between members of different components that meet in a cell. Only links are emitted."""

    def compare(cell: pa.Table) -> pa.Table:
        ids, component = cell["id"].to_numpy(), cell["component"].to_numpy()
        side, again = cell["first"].to_numpy(), bool(cell["again"][0].as_py())
        signatures = _signatures_of(cell["signature"])
        sets = _sets_of(cell["shingles"])
        sizes = np.array([len(s) for s in sets])
        found: list[tuple[int, int]] = []
        for i in range(len(ids) - 1):
            rest = slice(i + 1, None)
            fits = (component[rest] != component[i]) & (
                100 * np.minimum(sizes[rest], sizes[i]) >= PERCENT * np.maximum(sizes[rest], sizes[i])
            )
            if again:
                fits &= side[rest] != side[i]
            near = np.flatnonzero(fits)
            if len(near):
                near = near[(signatures[i + 1 + near] == signatures[i]).mean(axis=1) >= LEAST_AGREEMENT]
            found += [(ids[i], ids[i + 1 + j]) for j in near.tolist() if alike(sets[i], sets[i + 1 + j])]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.join(sets, "id").groupBy("key", "p", "q").applyInArrow(compare, "a bigint, b bigint")


def grouped(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, component, stays) of every document.

    ``component`` is the smallest doc_id of its group, null without words or id. ``stays`` marks the text that the group
    keeps, by doc_id and text_key: the first of the class with that id.
    """
    prints = written(fingerprints(documents), "fingerprints")
    some = prints.where("n_shingles > 0 AND doc_id IS NOT NULL")
    repeats = written(some.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    # copies collapse here, in each task first
    first = F.min(F.struct("doc_id", "text_key")).alias("first")
    classes = some.groupBy("h1", "h2").agg(first, F.first("bands").alias("bands")).withColumn("doc_id", F.col("first.doc_id"))
    classes = written(with_class_id(classes, repeats).drop("shared"), "classes")
    bands = classes.select("id", "doc_id", F.explode("bands").alias("key"))
    buckets = bands.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(bands.join(buckets, "key"), "members")
    sets = written(full_sets(documents, members.select("doc_id").distinct(), repeats), "sets")
    members = members.drop("doc_id")
    pairs = members.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    groups = written(components(verify(pairs, sets)), "components")
    # a bucket of two is settled by its one comparison
    left = members.where("n > 2").join(groups, "id", "left")
    left = left.select("key", "id", F.coalesce("component", "id").alias("component"))
    more = written(verify_cells(cells(left), sets), "more-links")
    if not more.isEmpty():
        groups = components(groups.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(more))
    answer = classes.select("h1", "h2", "first", "id").join(groups, "id", "left")
    answer = answer.withColumn("component", F.coalesce("component", "id"))
    # a stand-in is larger than any id, but the id that it stands for may be the smallest of its group
    place = F.struct(F.col("first.doc_id").alias("doc_id"), "h1", "h2")
    lowest = answer.where(F.col("id") >= FIRST_STAND_IN).groupBy("component").agg(F.min(place).alias("lowest"))
    answer = answer.join(written(lowest, "lowest"), "component", "left")
    named = F.coalesce(F.col("component") < F.col("lowest.doc_id"), F.lit(True))
    answer = answer.select(
        "h1",
        "h2",
        "first",
        F.when(named, F.col("component") == F.col("id")).otherwise(place == F.col("lowest")).alias("root"),
        F.when(named, F.col("component")).otherwise(F.col("lowest.doc_id")).alias("component"),
    )
    return prints.join(answer, ["h1", "h2"], "left").select(
        "doc_id",
        "text_key",
        "n_shingles",
        "component",
        (F.col("root") & (F.struct("doc_id", "text_key") == F.col("first"))).alias("stays"),
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    A null, empty or wordless text has an empty set and is linked with nothing; a text with fewer words than a shingle
    has its whole sequence as one. The component is the smallest doc_id that links lead to, its own included. Repeated
    rows are answered repeatedly; rows that share an id but not the text are documents of their own. A row without an id is
    linked with nothing: its component is null, and it is kept. Other columns are not read; an empty table gives no rows.
    """
    component = F.coalesce("component", "doc_id")
    return grouped(documents).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """The documents, all columns, one row of each group: one with the smallest id, of rows that repeat it the first.

    Rows without an id or without words (null and empty texts) belong to no group and stay. Rows that share an id and differ
    in text are judged each by its text. Columns may be called anything; an empty table stays empty. Only rows whose id may
    have to go are shuffled; the others pass the scan.
    """
    found = grouped(documents).where("n_shingles > 0 AND doc_id IS NOT NULL")
    judged = found.groupBy("doc_id", "text_key").agg(F.min("stays").alias("stays"), F.count(F.lit(1)).alias("n"))
    doomed = written(judged.where("NOT stays OR n > 1").select("doc_id", "text_key", "stays"), "doomed")
    maybe = maybe_in(documents.sparkSession, id_sketch(doomed, "doc_id"), "doc_id")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    rows = documents.select(
        F.struct(*columns).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key")
    )
    marked = rows.withColumn("maybe", maybe)
    untouched = marked.where("NOT maybe").select("row.*")
    left = marked.where("maybe").join(doomed, ["doc_id", "text_key"], "left").where("stays IS NULL OR stays")
    # rows that repeat id and text differ at most in their other columns
    repeats = Window.partitionBy("doc_id", "text_key", "stays").orderBy(*[F.col(f"row.`{c}`") for c in documents.columns])
    alone = left.where("stays IS NULL").select("row.*")
    firsts = left.where("stays").withColumn("place", F.row_number().over(repeats)).where("place = 1").select("row.*")
    return untouched.unionByName(alone).unionByName(firsts)
