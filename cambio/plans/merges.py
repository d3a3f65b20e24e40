"""The three MERGE statements of the warehouse."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cambio.functions.times import load_date, load_time
from cambio.operators.upsert import upsert
from cambio.schemas import QUOTES_STATE, QUOTES_TABLE

QUOTE_KEYS = ("cripto_id", "broker_id")


def merge_quotes(
    target: DataFrame,
    staged: DataFrame,
    run_ts: datetime | None = None,
    insert_date: str = "load",
    broadcast_source: bool = False,
    inserted_date: Column | None = None,
    cluster: Column | None = None,
) -> DataFrame:
    """Current quotes after a load.

    A matched pair takes the quote's own date, a new pair the load date (``insert_date="quote"`` uses the quote's date
    for both). ``inserted_date`` overrides the latter with an expression over the staged rows.
    """
    quote = {c: F.col(c) for c in ("cripto_id", "broker_id", "p_compra", "p_venta")}
    quote_date = F.col("fecha_cotizacion").cast("date")
    if inserted_date is None:
        inserted_date = load_date(run_ts) if insert_date == "load" else quote_date
    return upsert(
        target,
        staged,
        QUOTE_KEYS,
        matched={**quote, "fecha_cotizacion": quote_date},
        inserted={**quote, "fecha_cotizacion": inserted_date},
        broadcast_source=broadcast_source,
        cluster=cluster,
    )


def merge_polls(
    target: DataFrame, polls: DataFrame, broadcast_source: bool = False, cluster: Column | None = None
) -> DataFrame:
    """Stored quotes (``QUOTES_STATE``) after polls, a row per pair, that may be older than what was merged before.

    Of a pair's polls the newest gives prices and date, whichever comes last; of equal ones the one that is merged last.
    """
    row = {c: F.col(c) for c in QUOTES_STATE.columns} | {"fecha_cotizacion": F.col("fecha_cotizacion").cast("date")}
    return upsert(
        target,
        polls,
        QUOTE_KEYS,
        matched=row,
        inserted=row,
        broadcast_source=broadcast_source,
        cluster=cluster,
        ordered_by="_poll",
        combined={"_again": lambda old, new: F.lit(True)},
    )


def current_quotes(stored: DataFrame) -> DataFrame:
    """What the quotes table shows: a pair that was merged once has its load date, one merged again the quote's own."""
    date = F.when(F.col("_again"), F.col("fecha_cotizacion")).otherwise(F.col("_poll").cast("date"))
    return stored.withColumn("fecha_cotizacion", date).select(*QUOTES_TABLE.columns)


def merge_dimension(
    target: DataFrame,
    staged: DataFrame,
    key: str,
    name: str,
    run_ts: datetime | None = None,
    broadcast_source: bool = False,
) -> DataFrame:
    """A dimension after a load; the load time moves for every row in the source, changed or not."""
    row = {key: F.col(key), name: F.col(name), "fecha_carga": load_time(run_ts)}
    return upsert(target, staged, (key,), matched=row, inserted=row, broadcast_source=broadcast_source)


def merge_coins(target: DataFrame, staged: DataFrame, run_ts: datetime | None = None, **options) -> DataFrame:
    return merge_dimension(target, staged, "cripto_id", "cripto_name", run_ts, **options)


def merge_brokers(target: DataFrame, staged: DataFrame, run_ts: datetime | None = None, **options) -> DataFrame:
    return merge_dimension(target, staged, "broker_id", "broker_name", run_ts, **options)
