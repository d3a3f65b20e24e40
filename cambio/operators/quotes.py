"""Projections, dimension lookups, time conversion and row distinct on quote rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cambio.functions.times import epoch_to_timestamp
from cambio.schemas import QUOTE_NAMES, STG_QUOTES


def rename_quotes(quotes: DataFrame) -> DataFrame:
    """Contract names for the wire names. The totals, commissions included, become the prices."""
    return quotes.withColumnsRenamed(QUOTE_NAMES)


def lookup_coin(quotes: DataFrame, coins: DataFrame) -> DataFrame:
    """Resolve coin names; quotes of unknown coins drop out.

    No join hint: Catalyst broadcasts the dimension while its size is under the session's threshold, and otherwise
    shuffles, where adaptive execution splits a hot name.
    """
    return quotes.join(coins.select("cripto_name", "cripto_id"), "cripto_name", "inner")


def lookup_broker(quotes: DataFrame, brokers: DataFrame) -> DataFrame:
    """Resolve broker names; quotes of unknown brokers drop out. Strategy as in :func:`lookup_coin`."""
    return quotes.join(brokers.select("broker_name", "broker_id"), "broker_name", "inner")


def project_quotes(quotes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return quotes.select(*carry, *STG_QUOTES.columns)


def convert_time(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("fecha_cotizacion", epoch_to_timestamp(F.col("fecha_cotizacion")))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Full-row distinct (NULL equals NULL, NaN equals NaN).

    Hash aggregation collapses copies inside each task before the shuffle, so a row repeated a billion times travels
    once per task.
    """
    return rows.dropDuplicates()
