"""The lazy chain from quote rows to staging rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cambio.operators.documents import numbers
from cambio.operators.quotes import (
    convert_time,
    distinct_rows,
    lookup_broker,
    lookup_coin,
    project_quotes,
    rename_quotes,
)


def normalize_quotes(
    quotes: DataFrame, coins: DataFrame, brokers: DataFrame, carry: Sequence[str] = ()
) -> DataFrame:
    """Rename, resolve both dimensions, project, convert the time, drop exact duplicates.

    Prices and times may come as numbers or as the text of a document. Text is converted after the lookups, so only
    quotes that are kept can fail the load.
    """
    renamed = rename_quotes(quotes)
    resolved = lookup_broker(lookup_coin(renamed, coins), brokers)
    kept = numbers(project_quotes(resolved, carry), ("p_compra", "p_venta", "fecha_cotizacion"))
    return distinct_rows(convert_time(kept))
