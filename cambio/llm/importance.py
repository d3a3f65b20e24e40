"""Resampling towards a target distribution, by importance weights over hashed word n-grams.

One overlapped regex scan over a text, whose separators are collapsed to single blanks, stops at every word and emits the
runs of one, two and three words that begin there; their CRCs are the features. A feature's gain is how much likelier the
target is to hold its bucket than the corpus. A document's weight is the sum of its features' gains, and adding Gumbel noise
that depends on its id turns "the highest scores" into a draw without replacement in proportion to the weights.

Texts are scanned once: their bucket counts are written, and what the corpus holds in each bucket is counted from them.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cambio.llm.common import map_rows, text_chunks, written

BUCKETS = 10_000
#: A gain is the logarithm in thousandths, rounded down.
UNITS = 1000
LEAST_WORDS = 20
SEED = 42
RANGE = 1 << 32

# Separators become blanks; word characters are ASCII digits, lower-case letters and everything beyond ASCII.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: At the start of every word: the word, and with the groups after it the runs of two and of three words.
RUNS = regex.compile(rb"(?<![^ ])([^ ]++)(?:( [^ ]++)( [^ ]++)?)?")


def scan(text: str) -> tuple[int, array]:
    """Number of words, and the CRC of every run of one to three words."""
    line = b" ".join(text.encode().translate(_WORD_BYTES).split())
    found = array("I")
    push, words = found.append, 0
    for match in RUNS.finditer(line, overlapped=True):
        first, second, third = match.group(1, 2, 3)
        words += 1
        crc = crc32(first)
        push(crc)
        if second:
            crc = crc32(second, crc)
            push(crc)
            if third:
                push(crc32(third, crc))
    return words, found


BAG_SCHEMA = "doc_id bigint, n_words bigint, n_features bigint, gaps binary, times binary"


def bags(documents: DataFrame) -> DataFrame:
    """BAG_SCHEMA of every whole text: its different buckets, each as the distance to the one before, and their counts.

    Distances are 16-bit and counts 32-bit numbers, little-endian; most distances are small, so they compress well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            words, sizes, gaps, times = [], [], [], []
            for text in texts:
                n, found = scan(text)
                held, counts = np.unique(np.frombuffer(found, np.uint32) % BUCKETS, return_counts=True)
                words.append(n)
                sizes.append(len(found))
                gaps.append(np.diff(held, prepend=np.uint32(0)).astype("<u2").tobytes())
                times.append(counts.astype("<u4").tobytes())
            columns = [
                batch.column("doc_id"),
                pa.array(words, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(gaps, pa.binary()),
                pa.array(times, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "gaps", "times"])

    return map_rows(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, BAG_SCHEMA)


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, buckets, times) of a batch of bags: those of row i lie between bounds i and i + 1."""
    raw = batch.column("gaps").to_pylist()
    gaps = np.frombuffer(b"".join(raw), "<u2").astype(np.int64)
    times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
    bounds = np.cumsum([0, *(len(r) // 2 for r in raw)])
    sums = np.r_[0, np.cumsum(gaps)]
    return bounds, sums[1:] - np.repeat(sums[bounds[:-1]], np.diff(bounds)), times


def bucket_counts(packed: DataFrame) -> np.ndarray:
    """How many features lie in each bucket, over all rows. Every task adds up first; BUCKETS rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            _, held, times = unpacked(batch)
            np.add.at(total, held, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    parts = map_rows(packed.select("gaps", "times"), run, "bucket bigint, n bigint")
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(UNITS * ln(share of the target / share of the corpus)), each count raised by one."""
    of_corpus, of_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [
            math.floor(UNITS * math.log((t + 1) * of_corpus / ((s + 1) * of_target)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def importance_weights(documents: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document; ``target`` holds the texts (text) to come close to.

    The sum of the gains of a text's features; a null, empty or wordless text has none, and weight 0. Without target texts
    the target counts as even over all buckets. Repeated rows are answered repeatedly and all counted, a null id stays null,
    other columns are not read, an empty table gives no rows. Broadcast: one number per bucket.
    """
    packed = written(bags(documents), "bags", compression="zstd")
    wanted = bags(target.select(F.lit(0).alias("doc_id"), "text"))
    shared = documents.sparkSession.sparkContext.broadcast(gains(bucket_counts(packed), bucket_counts(wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, held, times = unpacked(batch)
            running = np.r_[0, np.cumsum(shared.value[held] * times)]
            weight = pa.array(running[bounds[1:]] - running[bounds[:-1]], pa.int64())
            columns = [*(batch.column(name) for name in ("doc_id", "n_words", "n_features")), weight]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return map_rows(packed, run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in UNITS that depends on the id alone; a row without an id has that of the empty id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(UNITS)) * F.ln(-F.ln((drawn + 0.5) / F.lit(float(RANGE))))).cast("bigint")


def ranked(rows: DataFrame, most: int) -> DataFrame:
    """(doc_id, score, rank) of the ``most`` highest scores, ties to the smaller id; rows have each pair once.

    Rows are dealt by ranges of the order, so no task holds more than a range; what precedes a range is the sum of the sizes
    of those before it, one number a range.
    """
    ranges = rows.repartitionByRange(F.col("score").desc(), F.col("doc_id"))
    dealt = written(ranges.select("doc_id", "score", F.spark_partition_id().alias("range")), "ranges")
    before, starts = 0, []
    for row in dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n")).orderBy("range").collect():
        if before < most:
            starts.append((row["range"], before))
        before += row.n
    offsets = rows.sparkSession.createDataFrame(starts, "range int, before bigint")
    within = Window.partitionBy("range").orderBy(F.col("score").desc(), "doc_id")
    placed = dealt.join(F.broadcast(offsets), "range").withColumn("rank", F.col("before") + F.row_number().over(within))
    return placed.where(F.col("rank") <= most).select("doc_id", "score", "rank")


@dataclass(frozen=True)
class Draw:
    """``percent`` of the documents with at least ``least_words`` words are drawn."""

    percent: int = 5
    least_words: int = LEAST_WORDS
    seed: int = SEED


def resample(documents: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; ``rank`` is null for what is not drawn.

    Weights and odd texts as in :func:`importance_weights`. Rows that repeat an id and a score are one document in the draw:
    they count once and share a rank. A row without an id is scored but never drawn.
    """
    weights = written(importance_weights(documents, target), "weights")
    scored = weights.withColumn("score", F.col("weight") + noise(F.col("doc_id"), draw.seed))
    takes_part = (F.col("n_words") >= draw.least_words) & F.col("doc_id").isNotNull()
    eligible = scored.where(takes_part).select("doc_id", "score").distinct()
    most = draw.percent * eligible.count() // 100
    drawn = ranked(eligible, most)
    # of rows that share an id, another text with the same score may have too few words
    chosen = drawn.withColumn("takes_part", F.lit(True))
    return (
        scored.withColumn("takes_part", takes_part)
        .join(chosen, ["doc_id", "score", "takes_part"], "left")
        .select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    )
