"""Time expressions. All of them are zone-less, so they do not depend on the session time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Epoch seconds beyond this, about the year 2262, are refused: milliseconds sent as seconds, most likely.
MAX_EPOCH_SECONDS = 9223372036


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds, whole or fractional, to a zone-less UTC timestamp, rounded to microseconds.

    Plain long arithmetic, all inside generated code; a decimal in between would cost several times as much.
    """
    micros = F.floor(seconds * 1e6 + 0.5)
    moment = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.expr("INTERVAL '0.000001' SECOND") * micros
    out_of_range = F.raise_error(F.concat(F.lit("epoch seconds out of range: "), seconds.cast("string")))
    return F.when(F.isnan(seconds), None).when(F.abs(seconds) > MAX_EPOCH_SECONDS, out_of_range).otherwise(moment)


def load_time(run_ts: datetime | None) -> Column:
    """The load timestamp: one value for the whole statement, UTC, fixed when the statement is built."""
    moment = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


def load_date(run_ts: datetime | None) -> Column:
    return load_time(run_ts).cast("date")
