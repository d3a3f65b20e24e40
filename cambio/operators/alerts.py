"""Threshold alerts on the latest prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cambio.functions.text import alert_body, alert_subject
from cambio.operators.latest import PAIR, latest_prices


def alerts(quotes: DataFrame, rules: DataFrame, broadcast_rules: bool = False) -> DataFrame:
    """Rules whose pair's latest price is strictly above the threshold, with that price.

    A missing pair, a NULL or a NaN price raises no alert. With ``broadcast_rules`` (for a counted, bounded number of
    them) quotes of pairs under no rule are dropped before they are ranked. Without it every pair is ranked first: a
    shuffled filter would bring all rows of a hot pair into one task, while the ranking sends one row per pair and task.
    """
    candidates = quotes.select(*PAIR, "p_compra", "fecha_cotizacion")
    if broadcast_rules:
        rules = F.broadcast(rules)
        candidates = candidates.join(F.broadcast(rules.select(*PAIR)), list(PAIR), "left_semi")
    priced = latest_prices(candidates).select(*PAIR, "p_compra")
    above = (F.col("p_compra") > F.col("threshold")) & ~F.isnan("p_compra")
    return priced.join(rules, list(PAIR), "inner").where(above).select(*rules.columns, "p_compra")


def alert_messages(raised: DataFrame) -> DataFrame:
    """Alert rows ready for delivery: ``(cripto_id, broker_id, recipient, subject, body)``."""
    return raised.select(
        *PAIR,
        "recipient",
        alert_subject(F.col("label"), F.col("threshold")).alias("subject"),
        alert_body(F.col("label"), F.col("p_compra"), F.col("threshold")).alias("body"),
    )
