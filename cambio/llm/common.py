"""What the operators of this subpackage share: table access, folds, written intermediate tables, text batches."""

from __future__ import annotations

import os
from collections.abc import Collection, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cambio.session import work_dir

#: Texts are handled in chunks of about so many bytes, so that memory does not follow the batch size.
CHUNK_BYTES = 1_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Workers find this package even where it is not installed beside Spark."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a row without an id counts as the empty text, so remainder 0."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def written(frame: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """The frame written as Parquet to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = work_dir(frame.sparkSession, purpose)
    frame.write.parquet(path, compression=compression)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def unused(name: str, columns: Collection[str]) -> str:
    """The name, with underscores after it until no column is called like that."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows that Spark hands to Python at a time: texts are long, and a batch is held several times over.
BATCH_ROWS = 2000


def map_rows(frame: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` in batches of BATCH_ROWS. The batch size is a setting of the session, and stays set."""
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return frame.mapInArrow(run, schema)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts; a null text counts as empty, a long text is a slice of its own.

    Texts become Python strings a slice at a time.
    """
    for batch in batches:
        first, size = 0, 0
        for i, length in enumerate(pc.binary_length(batch.column(column)).fill_null(0).to_pylist()):
            if i > first and size + length > CHUNK_BYTES:
                yield _slice(batch, column, first, i)
                first, size = i, 0
            size += length
        if batch.num_rows:
            yield _slice(batch, column, first, batch.num_rows)


def _slice(batch: pa.RecordBatch, column: str, first: int, end: int) -> tuple[pa.RecordBatch, list[str]]:
    part = batch.slice(first, end - first)
    return part, [text or "" for text in part.column(column).to_pylist()]


#: Bits of an id sketch: 8 MB, whatever the number of ids.
SKETCH_BITS = 26


def id_sketch(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size in which every id has its bit set; other ids have theirs set now and then.

    It lets a scan drop most rows that a join would drop, before they are shuffled. At most 2 ** (SKETCH_BITS - 6) rows
    reach the driver.
    """
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    words = (
        ids.select(place_of(column).alias("place"))
        .groupBy(F.expr("place div 64").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .toArrow()
    )
    sketch = np.zeros(1 << (SKETCH_BITS - 6), np.uint64)
    sketch[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return sketch


def place_of(column: str) -> Column:
    """The bit of an id in a sketch."""
    return F.pmod(F.xxhash64(column), F.lit(1 << SKETCH_BITS))


def hits(sketch: np.ndarray, places: np.ndarray) -> np.ndarray:
    at = places.astype(np.uint64)
    return ((sketch[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def maybe_in(spark: SparkSession, sketch: np.ndarray, column: str) -> Column:
    """Whether an id may be among those of the sketch; a null id is not."""
    shared = spark.sparkContext.broadcast(sketch)

    @F.pandas_udf("boolean")
    def hit(place: pd.Series) -> pd.Series:
        return pd.Series(hits(shared.value, place.to_numpy()))

    return F.col(column).isNotNull() & hit(place_of(column))
