"""Rename, lookups, projection, time, distinct, and the literal dimensions."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cambio.functions.times import epoch_to_timestamp, load_date, load_time
from cambio.operators.quotes import distinct_rows, lookup_broker, lookup_coin, project_quotes, rename_quotes
from cambio.plans.normalize import normalize_quotes
from cambio.schemas import BROKERS, COINS, broker_dimension, coin_dimension

QUOTE = "cripto string, broker string, ask double, totalAsk double, bid double, totalBid double, time double"


def test_literal_dimensions(spark, rows):
    assert rows(coin_dimension(spark)) == sorted(COINS)
    assert rows(broker_dimension(spark)) == sorted(BROKERS, key=repr)
    assert len(BROKERS) == 11


def test_rename_ignores_missing_columns(spark):
    frame = spark.createDataFrame([("btc", 1.0, 2.0)], "cripto string, totalAsk double, ask double")
    assert rename_quotes(frame).columns == ["cripto_name", "p_compra", "ask"]


def test_lookups_drop_unknown_and_null_names_and_fan_out(spark, rows):
    quotes = spark.createDataFrame([("btc", 1), ("xyz", 2), (None, 3), ("BTC", 4)], "cripto_name string, n int")
    coins = spark.createDataFrame([(1, "btc"), (7, "btc"), (9, None)], "cripto_id int, cripto_name string")
    assert rows(lookup_coin(quotes, coins).select("cripto_id", "n")) == [(1, 1), (7, 1)]


def test_lookup_of_a_literal_dimension_is_a_broadcast(spark):
    quotes = spark.createDataFrame([("btc", "fiwind")], "cripto_name string, broker_name string")
    plan = lookup_broker(lookup_coin(quotes, coin_dimension(spark)), broker_dimension(spark))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


@pytest.mark.parametrize(
    "seconds, expected",
    [
        (1700000000.0, datetime(2023, 11, 14, 22, 13, 20)),
        (1700000000.5, datetime(2023, 11, 14, 22, 13, 20, 500000)),
        (1704067207.179575, datetime(2024, 1, 1, 0, 0, 7, 179575)),
        (0.0, datetime(1970, 1, 1)),
        (-1.0, datetime(1969, 12, 31, 23, 59, 59)),
        (None, None),
        (float("nan"), None),
    ],
)
def test_epoch(spark, seconds, expected):
    frame = spark.createDataFrame([(seconds,)], "s double")
    for zone in ("UTC", "America/Argentina/Buenos_Aires"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert frame.select(epoch_to_timestamp(F.col("s"))).first()[0] == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epoch_in_milliseconds_fails(spark):
    frame = spark.createDataFrame([(1.7e12,)], "s double")
    with pytest.raises(PySparkException, match="out of range"):
        frame.select(epoch_to_timestamp(F.col("s"))).collect()


def test_load_time_is_fixed_when_built(spark):
    at = datetime(2024, 2, 1, 23, 59, 59, 5)
    row = spark.range(1).select(load_time(at).alias("t"), load_date(at).alias("d"), load_time(None).alias("now")).first()
    assert (row.t, row.d) == (at, at.date())
    assert abs((row.now - datetime.now()).total_seconds()) < 3 * 86400


def test_distinct_treats_null_and_nan_as_equal(spark):
    row = (1, 2, 5.0, None, datetime(2024, 1, 1))
    nan = (1, 2, float("nan"), None, None)
    frame = spark.createDataFrame(
        [row, row, nan, nan, (1, 2, 5.0, 4.0, None)], "a int, b int, c double, d double, e timestamp_ntz"
    )
    assert distinct_rows(frame).count() == 3


def test_distinct_collapses_before_the_shuffle(spark):
    plan = distinct_rows(spark.range(10).selectExpr("1 as a", "2 as b"))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2


def test_normalize(spark, rows):
    quotes = spark.createDataFrame(
        [
            ("btc", "fiwind", 1.5, 2.0, 1.0, 0.9, 1700000000.0),
            ("btc", "fiwind", 1.6, 2.0, 1.1, 0.9, 1700000000.0),  # differs in dropped columns only
            ("btc", "nobody", 1.5, 2.0, 1.0, 0.9, 1700000000.0),
            ("usdt", "fiwind", 1.5, 2.0, 1.0, 0.9, 1700000000.0),
            ("dai", "vitawallet", None, 3.0, None, None, 1700000001.0),
        ],
        QUOTE,
    )
    got = normalize_quotes(quotes, coin_dimension(spark), broker_dimension(spark))
    assert got.dtypes == [
        ("cripto_id", "int"),
        ("broker_id", "int"),
        ("p_compra", "double"),
        ("p_venta", "double"),
        ("fecha_cotizacion", "timestamp_ntz"),
    ]
    assert rows(got) == [
        (1, 2, 2.0, 0.9, datetime(2023, 11, 14, 22, 13, 20)),
        (3, 11, 3.0, None, datetime(2023, 11, 14, 22, 13, 21)),
    ]
    assert project_quotes(got).columns == got.columns


def test_hot_coin_is_split_when_the_dimension_is_large(spark, tmp_path):
    """Above the broadcast threshold the lookup shuffles, and adaptive execution splits the hot name's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    name = F.when(F.rand(1) < 0.34, "coin_0").otherwise(F.concat(F.lit("coin_"), F.col("id").cast("string")))
    spark.range(60000).repartition(8).select(name.alias("cripto_name"), "id").write.parquet(str(tmp_path / "q"))
    spark.range(60000).selectExpr("cast(id as int) cripto_id", "concat('coin_', id) cripto_name").write.parquet(
        str(tmp_path / "c")
    )
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = lookup_coin(spark.read.parquet(str(tmp_path / "q")), spark.read.parquet(str(tmp_path / "c")))
        assert len(found.collect()) == 60000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
