"""The same load, incremental: a stream over the landing folder that takes what is new and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cambio.operators.documents import split_by_status
from cambio.operators.upsert import require_unique_keys
from cambio.plans.daily import (
    Warehouse,
    decode_reporting,
    load_brokers,
    load_coins,
    merge_staged_polls,
    observed_polls,
    raise_alerts,
    report_failed_polls,
)
from cambio.plans.merges import QUOTE_KEYS
from cambio.plans.normalize import normalize_quotes
from cambio.schemas import QUOTES_STATE, STG_QUOTES, TableSpec, broker_dimension, coin_dimension
from cambio.session import configure
from cambio.sinks.load import replace_staging

#: Staging of a micro-batch: it may hold several polls, so each row keeps its poll.
STG_POLLS = TableSpec(
    "stg_cotizaciones_polls",
    T.StructType([T.StructField("poll_ts", T.TimestampNTZType()), *STG_QUOTES.schema.fields]),
    not_null=("poll_ts", *STG_QUOTES.not_null),
    sort_by=STG_QUOTES.sort_by,
)

#: The same after its polls are collapsed.
STG_COLLAPSED = TableSpec(
    "stg_cotizaciones_collapsed",
    T.StructType([*STG_QUOTES.schema.fields, *QUOTES_STATE.schema.fields[-2:]]),
    not_null=STG_QUOTES.not_null,
    sort_by=STG_QUOTES.sort_by,
)


def collapse_polls(staged: DataFrame) -> DataFrame:
    """Several polls of staged quotes to one row per pair: what is merged of them, in whatever order they came.

    The newest poll gives the prices. The aggregation buffers are fixed-width numbers, so it runs as a hash aggregation
    with partial results per task, whatever share of the rows one pair holds.
    """
    newest = [F.max_by(c, "poll_ts").alias(c) for c in ("p_compra", "p_venta", "fecha_cotizacion")]
    again = (F.min("poll_ts") < F.max("poll_ts")).alias("_again")
    per_pair = staged.groupBy(*QUOTE_KEYS).agg(*newest, F.max("poll_ts").alias("_poll"), again)
    return per_pair.select(*STG_COLLAPSED.columns)


def load_batch(
    warehouse: Warehouse,
    documents: DataFrame,
    batch: tuple[str, int],
    coins: DataFrame | None = None,
    brokers: DataFrame | None = None,
    rules: DataFrame | None = None,
) -> None:
    """Load one micro-batch, equal to loading its polls one by one in poll order with ``run_ts = poll_ts``.

    Polls may be older than ones merged before: every pair keeps its newest poll, so any order gives the same table. Each
    table remembers the batch, so a batch delivered twice is not merged twice; the name in ``batch`` has to be that of the
    checkpoint, because batch ids start anew with every checkpoint. A poll whose documents all failed loads nothing, as its
    own run would.
    """
    spark = configure(warehouse.spark)
    coins = coin_dimension(spark) if coins is None else coins
    brokers = broker_dimension(spark) if brokers is None else brokers
    run = f"{batch[0]}-{batch[1]:09d}"

    observed, seen = observed_polls(documents)
    answered, _ = split_by_status(observed)
    with warehouse.staging("decoded") as decoded:
        quotes = decode_reporting(warehouse, answered, run, decoded, carry=["poll_ts"])
        facts = seen.get
        if facts["failed"]:
            report_failed_polls(warehouse, documents, run)
        if not facts["answered"]:
            return
        if not warehouse.quotes.has_batch(*batch):
            with warehouse.staging(STG_POLLS.name) as polls, warehouse.staging(STG_COLLAPSED.name) as collapsed:
                rows = normalize_quotes(quotes, coins, brokers, carry=["poll_ts"])
                staged = replace_staging(rows, STG_POLLS, polls)
                require_unique_keys(staged, ["poll_ts", *QUOTE_KEYS])
                one_per_pair = replace_staging(collapse_polls(staged), STG_COLLAPSED, collapsed)
                merge_staged_polls(warehouse, one_per_pair, batch)
    newest = facts["last_poll"]
    if not warehouse.coins.has_batch(*batch):
        load_coins(warehouse, coins, newest, batch)
    if not warehouse.brokers.has_batch(*batch):
        load_brokers(warehouse, brokers, newest, batch)
    if rules is not None:
        raise_alerts(warehouse, rules, run)


def run_available(
    warehouse: Warehouse,
    documents: DataFrame,
    checkpoint: str,
    coins: DataFrame | None = None,
    brokers: DataFrame | None = None,
    rules: DataFrame | None = None,
) -> int:
    """Load everything landed since the last run with this checkpoint, then stop; returns the batches processed.

    Schedule it instead of the batch job. Polls may land late, in any order. Batches are remembered under the query id that
    the checkpoint keeps, so another checkpoint's batches are not taken for them.
    """
    done: list[int] = []

    def load_one(frame: DataFrame, batch_id: int) -> None:
        query_id = frame.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_batch(warehouse, frame, (query_id, batch_id), coins, brokers, rules)
        done.append(batch_id)

    query = (
        documents.writeStream.foreachBatch(load_one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(done)
