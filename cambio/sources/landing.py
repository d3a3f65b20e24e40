"""Landed quote documents, read as a batch or as a stream, and written by a poller."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cambio.schemas import DOCUMENT_SCHEMA

#: Body files lie at ``<dir>/poll_ts=<time>/<coin>.json``, or below a folder ``<coin>.json``; only answered polls leave one.
_FILE_SCHEMA = "value string, poll_ts timestamp_ntz"
#: Rows of a landed file. Spark packs files, not rows, into tasks, so a reader needs more files than cores to keep them busy.
FILE_ROWS = 100_000

_COIN_OF_FILE = r"([^/=]+)\.json(?:/|$)"


def read_documents(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Envelope rows ``(poll_ts, cripto_name, status, body)``, partitioned by ``poll_ts``, from any file format."""
    return _envelopes(spark.read.schema(DOCUMENT_SCHEMA).format(fmt).load(path))


def stream_documents(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Everything newly landed, in one micro-batch: a limit on files would cut polls in two and mix up their order."""
    return _envelopes(spark.readStream.schema(DOCUMENT_SCHEMA).format(fmt).load(path))


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """One whole JSON file per document."""
    return _from_files(spark.read.schema(_FILE_SCHEMA).option("wholetext", True).format("text").load(path))


def stream_document_files(spark: SparkSession, path: str) -> DataFrame:
    return _from_files(spark.readStream.schema(_FILE_SCHEMA).option("wholetext", True).format("text").load(path))


def land_documents(documents: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append envelope rows to the landing folder, one sub-folder per poll so that readers can prune by poll.

    ``rebalance`` brings a poll's rows together; adaptive execution splits a poll that is large. Decoding costs far more
    than reading, so files are kept small enough to be shared out evenly.
    """
    rows = documents.select(*DOCUMENT_SCHEMA.fieldNames()).hint("rebalance", F.col("poll_ts"))
    rows.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).partitionBy("poll_ts").format(fmt).save(path)


def documents_of_poll(documents: DataFrame, poll_ts: datetime) -> DataFrame:
    """The documents of one poll; on a partitioned landing folder this prunes to that poll's files."""
    return documents.where(F.col("poll_ts") == F.lit(poll_ts.isoformat(sep=" ")).cast("timestamp_ntz"))


def _envelopes(frame: DataFrame) -> DataFrame:
    return frame.select(*DOCUMENT_SCHEMA.fieldNames())


def _from_files(frame: DataFrame) -> DataFrame:
    return frame.select(
        "poll_ts",
        F.regexp_extract("_metadata.file_path", _COIN_OF_FILE, 1).alias("cripto_name"),
        F.lit(200).alias("status"),
        F.col("value").alias("body"),
    )
