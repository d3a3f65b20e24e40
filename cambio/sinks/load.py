"""Loading DataFrames into staging and other tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from cambio.operators.constraints import enforce
from cambio.schemas import TableSpec

log = logging.getLogger(__name__)

_SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def load(rows: DataFrame, path: str, if_exists: str = "append", fmt: str = "parquet") -> None:
    """Write to a file table; ``if_exists`` is ``fail``, ``replace`` or ``append`` (the default)."""
    _logged(lambda: rows.write.mode(_SAVE_MODES[if_exists]).format(fmt).save(path), path)


def replace_staging(rows: DataFrame, spec: TableSpec, path: str) -> DataFrame:
    """Empty the staging table and load ``rows`` in one step; returns the staged table.

    A row that breaks a constraint fails the write, and nothing downstream runs. The staged files also cut the lineage:
    a task lost later is recomputed from them, not from the raw documents.
    """
    load(enforce(rows, spec), path, if_exists="replace")
    return read_staging(rows.sparkSession, spec, path)


def append_staging(rows: DataFrame, spec: TableSpec, path: str) -> DataFrame:
    load(enforce(rows, spec), path, if_exists="append")
    return read_staging(rows.sparkSession, spec, path)


def truncate_staging(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Leave an empty staging table that keeps its schema."""
    load(spark.createDataFrame([], spec.schema), path, if_exists="replace")
    return read_staging(spark, spec, path)


def read_staging(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    return spark.read.schema(spec.schema).parquet(path)


def _logged(write, where: str) -> None:
    try:
        write()
    except Exception:
        log.exception("load into %s failed", where)
        raise
    log.info("loaded %s", where)
