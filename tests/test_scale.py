"""What keeps the loads fast on large tables gives the same rows as the plain way."""

import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cambio.functions import json_quotes
from cambio.operators import documents as documents_module
from cambio.operators.documents import decode_entries
from cambio.plans.daily import Warehouse, load_quotes, raise_alerts
from cambio.plans.merges import merge_polls
from cambio.schemas import DOCUMENT_SCHEMA, QUOTES_STATE, RULE_SCHEMA, STG_QUOTES
from cambio.sources import landing

POLL = datetime(2024, 1, 28)
QUOTE = '{"totalAsk":2,"totalBid":0.5,"time":1700000000}'
PLAIN = [
    '{"fiwind":{"ask":1.5,"totalAsk":2,"bid":1,"totalBid":0.9,"time":1700000000}}',
    f'{{"a":{QUOTE},"b.c #1-2":{QUOTE},"z":{{"totalAsk":1.25E7}}}}',
    '{"a":{"totalAsk":1,"totalAsk":3,"xtotalBid":7},"b":{"totalAskx":1}}',
    f'{{"a":{QUOTE},"b":{QUOTE},"a":{{"totalAsk":9}}}}',
    '{"a":{"totalAsk":0,"totalBid":0.001,"time":1e9}}',
]
OTHER = [
    "{}",
    "null",
    '{"a":{}}',
    '{"a":null,"b":5}',
    '{"a":{"totalAsk":null,"totalBid":-1}}',
    '{"a":{"totalAsk":-0}}',
    '{"a":{"totalAsk":"2","time":"NaN"}}',
    '{"a}b":{"totalAsk":1}}',
    '{"a\\u0041":{"totalAsk":1}}',
    '{"ä":{"totalAsk":1}}',
    ' {"a":{"totalAsk":1}}',
    '{"a": {"totalAsk": 1}}',
    '{"a":{"totalAsk":1}}\n',
    '{"a":{"totalAsk":1,"fee":{"totalAsk":2}}}',
    '{"a":{"totalAsk":[1]}}',
]
MALFORMED = [
    '{"a":{"totalAsk":1}',
    '{"a":{"totalAsk":1},}',
    '{"a":{"totalAsk":1,}}',
    '{"a":{"totalAsk":1}}x',
    '{"a":{"totalAsk":01}}',
    '{"a":{"totalAsk":1.}}',
    '{"a":{"totalAsk":1}"b":{"totalAsk":1}}',
    '{"a":{"totalAsk":1e}}',
]


def landed(spark, bodies):
    return spark.createDataFrame([(POLL, f"coin {i}", 200, b) for i, b in enumerate(bodies)], DOCUMENT_SCHEMA)


def decoded(frame):
    """Entries in document order, numbers as numbers: their text may differ (1.25E7)."""
    texts = ("totalAsk", "totalBid", "time")
    entries = decode_entries(frame, fields=texts)
    return entries.select("cripto", "broker", *[F.col(c).try_cast("double") for c in texts], "rejected").collect()


def test_only_plain_documents_are_plain(spark):
    found = landed(spark, PLAIN + OTHER + MALFORMED).select(json_quotes.is_plain(F.col("body"))).collect()
    assert [r[0] for r in found] == [True] * len(PLAIN) + [False] * (len(OTHER) + len(MALFORMED))


def test_plain_documents_read_as_the_parser_reads_them(spark, monkeypatch):
    rng, names = random.Random(7), ["ask", "totalAsk", "totalBid", "time", "x"]

    def quote():
        fields = [f'"{rng.choice(names)}":{rng.choice(["0", "12.50", "3e2", "4E-3", "1700000000"])}' for _ in range(4)]
        return "{" + ",".join(fields) + "}"

    many = ["{" + ",".join(f'"{rng.choice("abc")}":{quote()}' for _ in range(rng.randint(1, 5))) + "}" for _ in range(60)]
    large = "{" + ",".join(f'"broker {i}":{quote()}' for i in range(3000)) + "}"
    frame = landed(spark, PLAIN + OTHER + many + [large])
    fast = repr(decoded(frame))  # as text: NaN is not equal to itself
    monkeypatch.setattr(documents_module, "is_plain", lambda body: F.lit(False))
    assert fast == repr(decoded(frame))


@pytest.mark.parametrize("body", MALFORMED)
def test_malformed_documents_still_fail(spark, body):
    with pytest.raises(PySparkException, match="malformed quote document"):
        decoded(landed(spark, [body]))


def test_a_large_poll_lands_in_files_that_can_be_shared_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILE_ROWS", 10)
    landing.land_documents(landed(spark, PLAIN * 20), str(tmp_path))
    assert len(list(tmp_path.glob("poll_ts=*/*.parquet"))) >= 10
    assert landing.read_documents(spark, str(tmp_path)).count() == 100


def staged(spark, pairs):
    return spark.createDataFrame([(c, b, 10.0 * c, 9.0, POLL) for c, b in pairs], STG_QUOTES.schema)


def test_first_merge_joins_nothing(spark, tmp_path):
    table = Warehouse(spark, str(tmp_path)).quotes
    polls = staged(spark, [(1, 1), (2, 1)]).withColumns({"_poll": F.lit(POLL).cast("timestamp_ntz"), "_again": F.lit(False)})
    merged = merge_polls(table.stored(), polls.select(*QUOTES_STATE.columns), cluster=table.part_of())
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString()
    assert merged.count() == 2


def test_one_part_is_written_by_many_tasks(spark):
    stored = spark.range(4000).select(F.lit(1).alias("cripto_id"), F.col("id").cast("int").alias("broker_id"))
    stored = stored.selectExpr("*", "1.0D p_compra", "1.0D p_venta", "DATE '2024-01-01' fecha_cotizacion")
    stored = stored.selectExpr("*", "TIMESTAMP_NTZ '2024-01-01 00:00:00' _poll", "false _again")
    merged = merge_polls(stored, stored, cluster=F.lit(0))
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(adaptive, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        busy = merged.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset(adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert busy > 3


def test_rules_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def count(_):
        seen.add(1)
        return True

    warehouse = Warehouse(spark, str(tmp_path), 2)
    load_quotes(warehouse, staged(spark, [(1, 1), (2, 1)]), POLL)
    rules = spark.createDataFrame([(i, 1, 15.0, "Bitcoin", "desk") for i in (1, 2, 3)], RULE_SCHEMA)
    messages = raise_alerts(warehouse, rules.where(count("cripto_id")), "r")
    assert [r.cripto_id for r in messages.collect()] == [2]
    assert seen.value == 3
