"""Text of alert messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: the alert texts ------------------------------------------------------------------------------------
SUBJECT = "Alerta: Precio de %s superó los $%s"
BODY = "El precio de compra actual de %s es %s. ¡Supera los $%s!"
# ----------------------------------------------------------------------------------------------------------------------


def price_text(price: Column) -> Column:
    """Shortest decimal text of a price, never in scientific notation from 1e-6 to 1e16: ``50000.01``, ``0.00012``.

    Plain Spark text switches to ``1.2E7`` at ten million and to ``1.2E-4`` below a thousandth; there the digits go through
    a decimal instead.
    """
    plain = price.cast("string")
    size = F.abs(price)

    def through(kind: str) -> Column:
        return F.regexp_replace(plain.try_cast(kind).cast("string"), r"(\.\d+?)0+$", "$1")

    large = (size >= F.lit(1e7)) & (size < F.lit(1e16))
    small = (size >= F.lit(1e-6)) & (size < F.lit(1e-3))
    return F.when(large, through("decimal(38,12)")).when(small, through("decimal(38,30)")).otherwise(plain)


def threshold_text(threshold: Column) -> Column:
    """Threshold with thousands separators in its whole part, and all its decimals, two at least, where it has some.

    ``50,000``, ``99.50``, ``1,234.00015``.
    """
    digits = price_text(threshold)
    whole = F.regexp_replace(F.substring_index(digits, ".", 1), r"(?<=\d)(?=(?:\d{3})+$)", ",")
    decimals = F.regexp_extract(digits, r"\.(\d+)$", 1)
    shown = F.concat(whole, F.lit("."), F.rpad(decimals, F.greatest(F.length(decimals), F.lit(2)), F.lit("0")))
    return F.when(threshold == F.floor(threshold), whole).otherwise(shown)


def alert_subject(label: Column, threshold: Column) -> Column:
    return F.format_string(SUBJECT, label, threshold_text(threshold))


def alert_body(label: Column, price: Column, threshold: Column) -> Column:
    return F.format_string(BODY, label, price_text(price), threshold_text(threshold))
