"""The polling source, on file URLs (no server), and the command line."""

import io
import time
import urllib.error
from datetime import date, datetime

import pytest

from cambio.__main__ import main
from cambio.plans.daily import Warehouse
from cambio.schemas import API_COINS, API_FIATS
from cambio.sources.landing import read_documents, stream_documents
from cambio.sources.poll_api import QuotePollReader, QuotePollStreamReader, fetch, poll_to_landing, stream_polls
from cambio.streaming.incremental import run_available

BODY = '{"binancep2p":{"totalAsk":50000.5,"totalBid":1,"time":1700000000}}'


def service(folder, **bodies):
    for coin, body in bodies.items():
        (folder / coin / "usd").mkdir(parents=True, exist_ok=True)
        (folder / coin / "usd" / "0.1").write_text(body)
    return f"file://{folder}/"


def test_poll_space():
    assert len(API_COINS) == 37 and len(API_FIATS) == 9


def test_one_partition_per_coin():
    reader = QuotePollReader({"base_url": "https://example.org/api/"})
    assert [p.url for p in reader.partitions()] == [f"https://example.org/api/{c}/usd/0.1" for c in ("btc", "eth", "dai")]
    other = QuotePollReader({"base_url": "x", "coins": "USDT, sol", "fiat": "ARS", "volume": "2.5"})
    assert [p.url for p in other.partitions()] == ["x/usdt/ars/2.5", "x/sol/ars/2.5"]
    for bad in ({"coins": "gold"}, {"fiat": "eur"}):
        with pytest.raises(ValueError, match="has no"):
            QuotePollReader({"base_url": "x", **bad})


def test_http_errors_are_answers_and_broken_connections_are_not():
    def http_error(url, timeout):
        raise urllib.error.HTTPError(url, 503, "busy", {}, io.BytesIO())

    def no_connection(url, timeout):
        raise urllib.error.URLError("unreachable")

    assert fetch("x", 1, http_error) == (503, "busy")
    with pytest.raises(urllib.error.URLError):
        fetch("x", 1, no_connection)


def test_poll_land_and_load(spark, tmp_path, rows):
    url = service(tmp_path / "api", btc=BODY, eth="{}", dai="{}")
    landing, root = str(tmp_path / "landing"), str(tmp_path / "w")
    poll_to_landing(spark, landing, url, poll_ts="2024-01-28T09:00:00")
    at = datetime(2024, 1, 28, 9)
    assert rows(read_documents(spark, landing)) == [(at, "btc", 200, BODY), (at, "dai", 200, "{}"), (at, "eth", 200, "{}")]
    options = ["--landing", landing, "--warehouse", root, "--parts", "2", "--alert-to", "desk"]
    main(["stream", *options, "--checkpoint", str(tmp_path / "cp")])
    table = Warehouse(spark, root).quotes
    assert rows(table.read()) == [(1, 1, 50000.5, 1.0, date(2024, 1, 28))]
    spark.sql("CREATE DATABASE published")
    main(["daily", *options, "--poll-ts", "2024-01-28T09:00:00", "--publish", "published"])
    assert spark.sql(
        "SELECT p_compra FROM published.cotizaciones WHERE cripto_id = 1 AND broker_id = 1 "
        "ORDER BY fecha_cotizacion DESC NULLS FIRST LIMIT 1"
    ).first() == (50000.5,)
    assert (spark.table("published.criptomonedas").count(), spark.table("published.brokers").count()) == (3, 11)
    spark.sql("DROP DATABASE published CASCADE")
    assert rows(table.read()) == [(1, 1, 50000.5, 1.0, date(2023, 11, 14))]
    main(["poll", "--base-url", url, "--landing", landing, "--coins", "btc"])
    assert read_documents(spark, landing).count() == 4


def test_a_micro_batch_polls_once(monkeypatch):
    reader = QuotePollStreamReader({"base_url": "x", "interval": "60"})
    assert reader.latestOffset()["interval"] - reader.initialOffset()["interval"] == 1
    day = 1706400000 // 60
    polls = reader.partitions({"interval": day}, {"interval": day + 60})
    assert [p.poll_ts for p in polls] == [datetime(2024, 1, 28, 1)] * 3 and len({p.coin for p in polls}) == 3
    assert reader.partitions({"interval": day}, {"interval": day}) == []


def test_a_stream_of_polls_lands_each_once(spark, tmp_path, rows):
    """Restarts go on where they stopped; a batch that is run again after a failure adds nothing."""
    url = service(tmp_path / "api", btc=BODY, eth="{}", dai="{}")
    landing, checkpoint = str(tmp_path / "landing"), tmp_path / "cp"

    def run():
        stream_polls(spark, landing, str(checkpoint), url, interval=1, once=True).awaitTermination()
        return rows(read_documents(spark, landing).select("poll_ts", "cripto_name"))

    first = run()
    assert len(first) == 3 and len({r[0] for r in first}) == 1
    time.sleep(1.1)
    second = run()
    assert len(second) == 6 and len({r[0] for r in second}) == 2
    newest = max((checkpoint / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    newest.unlink()  # as if the driver had died before it noted that the batch was done
    (checkpoint / "commits" / f".{newest.name}.crc").unlink(missing_ok=True)
    time.sleep(1.1)
    assert run() == second
    third = run()
    assert set(second) < set(third) and len(third) == len(set(third)) == 9
    w = Warehouse(spark, str(tmp_path / "w"))
    assert run_available(w, stream_documents(spark, landing), str(tmp_path / "load")) == 1
    assert [r.p_compra for r in w.quotes.read().collect()] == [50000.5]
