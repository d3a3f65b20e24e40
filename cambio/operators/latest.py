"""Latest price per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIR = ("cripto_id", "broker_id")


def _newest_first() -> list[Column]:
    # The warehouse sorts NULL first under DESC; the price breaks ties of the day-precise date.
    return [F.col("fecha_cotizacion").desc_nulls_first(), F.col("p_compra").desc_nulls_last()]


def latest_price(quotes: DataFrame, cripto_id: int, broker_id: int) -> DataFrame:
    """Newest ``p_compra`` of one pair, 0 or 1 rows: pushed-down filter and a top-1, no full sort."""
    one_pair = quotes.where((F.col("cripto_id") == cripto_id) & (F.col("broker_id") == broker_id))
    return one_pair.orderBy(*_newest_first()).limit(1).select("p_compra")


def latest_prices(quotes: DataFrame) -> DataFrame:
    """Newest row of every pair.

    Keeping rank 1 lets Spark cut every task's rows to one per pair before the shuffle (WindowGroupLimit), so a pair
    that holds a third of the table sends one row per task.
    """
    ranked = quotes.withColumn("_rank", F.row_number().over(Window.partitionBy(*PAIR).orderBy(*_newest_first())))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
