"""A Spark data source that polls the quote service, one task per coin.

    spark.dataSource.register(QuotePoll)
    spark.read.format("quote_poll").options(base_url=..., coins="btc,eth,dai").load()
    spark.readStream.format("quote_poll").options(base_url=..., interval=60).load()

Every action on the batch source polls again, so :func:`poll_to_landing` lands the answers once and everything else reads
those. The stream polls once per interval, and :func:`stream_polls` lands each poll exactly once.
"""

from __future__ import annotations

import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from cambio.schemas import API_COINS, API_FIATS, COINS, DOCUMENT_SCHEMA, POLL_FIAT, POLL_VOLUME
from cambio.sources.landing import land_documents


class CoinPoll(InputPartition):
    def __init__(self, coin: str, url: str, poll_ts: datetime):
        self.coin, self.url, self.poll_ts = coin, url, poll_ts


class QuotePoll(DataSource):
    """Options: ``base_url`` (required), ``coins``, ``fiat``, ``volume``, ``timeout`` (seconds).

    A batch also takes ``poll_ts`` (ISO, default: now), a stream ``interval`` (seconds between polls).
    """

    @classmethod
    def name(cls) -> str:
        return "quote_poll"

    def schema(self):
        return DOCUMENT_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return QuotePollReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return QuotePollStreamReader(dict(self.options))


class _Service:
    """The quote service: which coins to ask for, and how."""

    def __init__(self, options: dict[str, str]):
        names = ",".join(name for _, name in COINS)
        self.coins = [c.strip().lower() for c in options.get("coins", names).split(",")]
        self.fiat = options.get("fiat", POLL_FIAT).lower()
        self.volume = float(options.get("volume", POLL_VOLUME))
        unknown = [c for c in self.coins if c.upper() not in API_COINS]
        if unknown or self.fiat.upper() not in API_FIATS:
            raise ValueError(f"the quote service has no {', '.join(unknown) or self.fiat}")
        self.base_url = options["base_url"].rstrip("/")
        self.timeout = float(options.get("timeout", 30))

    def poll(self, poll_ts: datetime) -> list[CoinPoll]:
        """A task per coin."""
        return [CoinPoll(coin, f"{self.base_url}/{coin}/{self.fiat}/{self.volume}", poll_ts) for coin in self.coins]

    def ask(self, partition: CoinPoll) -> Iterator[tuple]:
        status, body = fetch(partition.url, self.timeout)
        yield (partition.poll_ts, partition.coin, status, body)


class QuotePollReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.service = _Service(options)
        now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
        self.poll_ts = datetime.fromisoformat(options["poll_ts"]) if "poll_ts" in options else now

    def partitions(self) -> list[CoinPoll]:
        return self.service.poll(self.poll_ts)

    def read(self, partition: CoinPoll) -> Iterator[tuple]:
        return self.service.ask(partition)


class QuotePollStreamReader(DataSourceStreamReader):
    """An offset is a number of intervals since the epoch; a micro-batch polls once, for the newest interval that has begun.

    The service has no past quotes, so intervals that went by while nothing ran are left out. A batch that is run again,
    after a failure or a restart, asks again under the same poll time.
    """

    def __init__(self, options: dict[str, str]):
        self.service, self.interval = _Service(options), int(options.get("interval", 60))

    def _interval(self) -> int:
        return int(datetime.now(timezone.utc).timestamp()) // self.interval

    def initialOffset(self) -> dict:
        return {"interval": self._interval() - 1}

    def latestOffset(self) -> dict:
        return {"interval": self._interval()}

    def partitions(self, start: dict, end: dict) -> list[CoinPoll]:
        if end["interval"] <= start["interval"]:
            return []
        seconds = end["interval"] * self.interval
        return self.service.poll(datetime.fromtimestamp(seconds, timezone.utc).replace(tzinfo=None))

    def read(self, partition: CoinPoll) -> Iterator[tuple]:
        return self.service.ask(partition)


def fetch(url: str, timeout: float, opener: Callable = urllib.request.urlopen) -> tuple[int, str]:
    """(status, body). An HTTP error is an answer with its status; a broken connection fails the task, which retries."""
    try:
        with opener(url, timeout=timeout) as answer:
            return answer.status or 200, answer.read().decode()
    except urllib.error.HTTPError as error:
        return error.code, error.reason


def stream_polls(
    spark: SparkSession, landing: str, checkpoint: str, base_url: str, interval: int = 60, once: bool = False, **options: str
) -> StreamingQuery:
    """Start polling into a landing folder of its own: every ``interval`` seconds, or ``once`` if a poll is due.

    Spark's file sink records which files each micro-batch has landed, and readers of the folder go by that record: a batch
    that is run again adds nothing.
    """
    spark.dataSource.register(QuotePoll)
    polls = spark.readStream.format("quote_poll").options(base_url=base_url, interval=str(interval), **options).load()
    writer = polls.writeStream.format("parquet").partitionBy("poll_ts").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{interval} seconds")
    return writer.start(landing)


def poll_to_landing(spark: SparkSession, landing: str, base_url: str, **options: str) -> None:
    spark.dataSource.register(QuotePoll)
    land_documents(spark.read.format("quote_poll").options(base_url=base_url, **options).load(), landing)
