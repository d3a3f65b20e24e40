"""The daily load: stage and merge quotes, coins and brokers, then check the alert rules."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cambio.functions.times import load_time
from cambio.operators.alerts import alert_messages, alerts
from cambio.operators.documents import (
    accepted_quotes,
    decode_entries,
    rejected_entries,
    split_by_status,
)
from cambio.operators.latest import latest_price
from cambio.operators.upsert import count_source, fits_broadcast
from cambio.plans.merges import QUOTE_KEYS, current_quotes, merge_brokers, merge_coins, merge_polls
from cambio.plans.normalize import normalize_quotes
from cambio.schemas import (
    BROKERS_TABLE,
    COINS_TABLE,
    LOADED_FIELDS,
    QUOTES_STATE,
    QUOTES_TABLE,
    RULES,
    STG_BROKERS,
    STG_COINS,
    STG_QUOTES,
    TableSpec,
    broker_dimension,
    coin_dimension,
)
from cambio.session import configure
from cambio.sinks.catalog import DEFAULT_BUCKETS, load_table
from cambio.sinks.load import load, replace_staging
from cambio.sinks.snapshots import CommittedTable

log = logging.getLogger(__name__)


class EveryPollFailed(RuntimeError):
    """No document of the run was answered with status 200."""


@dataclass
class Warehouse:
    """Where the tables lie. ``parts`` splits the fact table, see :class:`CommittedTable`."""

    spark: SparkSession
    root: str
    parts: int = 1

    @contextmanager
    def staging(self, name: str) -> Iterator[str]:
        """A folder for one load's intermediate rows, gone after it: runs on one warehouse don't meet there."""
        path = f"{self.root}/{name}/load-{uuid.uuid4().hex}"
        try:
            yield path
        finally:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def report(self, name: str, run: str) -> str:
        return f"{self.root}/{name}/run={run}"

    @property
    def quotes(self) -> CommittedTable:
        path = f"{self.root}/{QUOTES_TABLE.name}"
        return CommittedTable(self.spark, path, QUOTES_TABLE, self.parts, QUOTES_STATE, current_quotes)

    @property
    def coins(self) -> CommittedTable:
        return CommittedTable(self.spark, f"{self.root}/{COINS_TABLE.name}", COINS_TABLE)

    @property
    def brokers(self) -> CommittedTable:
        return CommittedTable(self.spark, f"{self.root}/{BROKERS_TABLE.name}", BROKERS_TABLE)

    def publish(self, database: str, buckets: int = DEFAULT_BUCKETS) -> None:
        """Replace the rows of the three catalog tables by the committed ones, for readers that go by the catalog.

        A table that is not there yet is created with so many buckets.
        """
        for table in (self.quotes, self.coins, self.brokers):
            load_table(table.read(), table.spec, database, if_exists="replace", buckets=buckets)

    def latest_price(self, cripto_id: int, broker_id: int) -> DataFrame:
        """Newest price of one pair in the committed quotes; reads the one part that the coin belongs to."""
        return latest_price(self.quotes.part_of_key(F.lit(cripto_id).cast("int")), cripto_id, broker_id)

    def register_views(self, prefix: str = "") -> None:
        """Temporary views of the three tables as last committed, for SQL under the tables' own names.

        Register them again after a load. Spark sorts NULL last under DESC where the warehouse
        sorts it first: write ``ORDER BY fecha_cotizacion DESC NULLS FIRST``.
        """
        for table in (self.quotes, self.coins, self.brokers):
            table.read().createOrReplaceTempView(prefix + table.spec.name)


def load_quotes(warehouse: Warehouse, rows: DataFrame, run_ts: datetime | None = None) -> int:
    """Stage normalized quotes, merge them, commit; returns the new version."""
    with warehouse.staging(STG_QUOTES.name) as path:
        return merge_staged_quotes(warehouse, replace_staging(rows, STG_QUOTES, path), run_ts)


def merge_staged_quotes(
    warehouse: Warehouse, staged: DataFrame, run_ts: datetime | None = None, broadcast_source: bool | None = None
) -> int:
    """Merge staged quotes, which have one load time, and commit; returns the new version."""
    polls = staged.withColumns({"_poll": load_time(run_ts), "_again": F.lit(False)})
    return merge_staged_polls(warehouse, polls, broadcast_source=broadcast_source)


def merge_staged_polls(
    warehouse: Warehouse,
    polls: DataFrame,
    batch: tuple[str, int] | None = None,
    broadcast_source: bool | None = None,
) -> int:
    """Merge staged rows (``QUOTES_STATE``) and commit. Only the table parts they fall into are read and rewritten.

    The source is broadcast if its counted rows are few, unless ``broadcast_source`` says so or not.
    """
    table = warehouse.quotes
    base, rows = table.version, count_source(polls, QUOTE_KEYS)
    small = fits_broadcast(rows, QUOTES_STATE.row_bytes) if broadcast_source is None else broadcast_source
    merged = merge_polls(table.touched_by(polls), polls, broadcast_source=small, cluster=table.part_of())
    return table.commit(merged if rows else None, batch, base)


def load_coins(
    warehouse: Warehouse, coins: DataFrame, run_ts: datetime | None = None, batch: tuple[str, int] | None = None
) -> int:
    return _load_dimension(warehouse.coins, warehouse, STG_COINS, coins, "cripto_id", merge_coins, run_ts, batch)


def load_brokers(
    warehouse: Warehouse, brokers: DataFrame, run_ts: datetime | None = None, batch: tuple[str, int] | None = None
) -> int:
    return _load_dimension(
        warehouse.brokers, warehouse, STG_BROKERS, brokers, "broker_id", merge_brokers, run_ts, batch
    )


def _load_dimension(table, warehouse, spec, rows, key, merge, run_ts, batch) -> int:
    with warehouse.staging(spec.name) as path:
        staged = replace_staging(rows.select(*spec.columns), spec, path)
        base, count = table.version, count_source(staged, [key])
        merged = merge(table.read(), staged, run_ts, broadcast_source=fits_broadcast(count, spec.row_bytes))
        return table.commit(merged if count else None, batch, base)  # an empty source changes nothing


def raise_alerts(warehouse: Warehouse, rules: DataFrame, run: str) -> DataFrame:
    """Check the rules against the committed quotes; the message rows are written, then returned as read back.

    The rules are computed once, into staging. Only the table parts that hold a rule's coin are read. Rules with texts
    beyond their limits fail, so the counted number of rules bounds what is broadcast. The rows of one run replace each
    other, so a repeated run delivers nothing twice.
    """
    path = warehouse.report("alerts", run)
    with warehouse.staging(RULES.name) as folder:
        checked = replace_staging(rules, RULES, folder)
        quotes = current_quotes(warehouse.quotes.touched_by(checked.where(F.col("cripto_id").isNotNull())))
        small = fits_broadcast(checked.count(), RULES.row_bytes)
        messages = alert_messages(alerts(quotes, checked, broadcast_rules=small))
        load(messages, path, if_exists="replace")
    return warehouse.spark.read.schema(messages.schema).parquet(path)


def poll_facts() -> list[Column]:
    """``answered`` and ``failed``: whether there were such polls; ``last_poll``: the newest answered one."""
    answered = F.col("status") == 200
    return [
        F.max(F.coalesce(answered, F.lit(False))).alias("answered"),
        F.max(~F.col("status").eqNullSafe(200)).alias("failed"),
        F.max(F.when(answered, F.col("poll_ts"))).alias("last_poll"),
    ]


def observed_polls(documents: DataFrame) -> tuple[DataFrame, Observation]:
    """The documents, and the :func:`poll_facts` that are seen when :func:`decode_reporting` reads them.

    Only for that: adaptive execution may drop a join's empty side, and what was to be observed there with it.
    """
    seen = Observation()
    return documents.observe(seen, *poll_facts()), seen


def report_failed_polls(warehouse: Warehouse, documents: DataFrame, run: str) -> None:
    _, failed = split_by_status(documents)
    load(failed.select("poll_ts", "cripto_name", "status"), warehouse.report("failed_polls", run), "replace")


def decode_reporting(
    warehouse: Warehouse, answered: DataFrame, run: str, path: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Quote rows of the answered documents; entries that are no quote are written to a report, if there are any.

    The documents are read and parsed once, into a columnar table at ``path`` that the load reads; what has to be
    reported is counted while it is written.
    """
    decoded = decode_entries(answered, ["poll_ts"], LOADED_FIELDS)
    seen = Observation()
    load(decoded.observe(seen, F.count_if(F.col("rejected").isNotNull()).alias("rejected")), path, "replace")
    entries = warehouse.spark.read.schema(decoded.schema).parquet(path)
    if seen.get["rejected"]:
        load(rejected_entries(entries, ["poll_ts"]), warehouse.report("rejected_quotes", run), "replace")
    return accepted_quotes(entries).select(*carry, "cripto", "broker", *LOADED_FIELDS)


def run_daily_load(
    warehouse: Warehouse,
    documents: DataFrame,
    run_ts: datetime | None = None,
    coins: DataFrame | None = None,
    brokers: DataFrame | None = None,
    rules: DataFrame | None = None,
    rejects: bool = True,
) -> DataFrame | None:
    """One poll's documents through the whole chain; returns the alert rows when rules are given.

    Every table commits on its own, facts first. Failed polls and entries that are no quote are reported where there are
    any; whether there are is seen while the documents are decoded, which reads them once. ``rejects=False`` writes no
    reports, and goes from the documents to staging in one lazy plan.
    """
    spark = configure(warehouse.spark)
    run_ts = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    run = run_ts.strftime("%Y%m%dT%H%M%S%f")
    coins = coin_dimension(spark) if coins is None else coins
    brokers = broker_dimension(spark) if brokers is None else brokers

    with warehouse.staging("decoded") as path:
        if rejects:
            observed, seen = observed_polls(documents)
            quotes = decode_reporting(warehouse, split_by_status(observed)[0], run, path)
            facts = seen.get
        else:
            quotes = accepted_quotes(decode_entries(split_by_status(documents)[0], fields=LOADED_FIELDS))
            facts = documents.agg(*poll_facts()).first()
        if rejects and facts["failed"]:
            report_failed_polls(warehouse, documents, run)
        if not facts["answered"]:
            raise EveryPollFailed("every poll of this run failed; nothing was loaded")
        load_quotes(warehouse, normalize_quotes(quotes, coins, brokers), run_ts)
    load_coins(warehouse, coins, run_ts)
    load_brokers(warehouse, brokers, run_ts)
    return raise_alerts(warehouse, rules, run) if rules is not None else None
