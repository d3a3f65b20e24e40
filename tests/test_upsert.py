"""MERGE semantics, against the edge cases and against a plain Python merge, in both physical strategies."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cambio.operators import upsert as upsert_module
from cambio.operators.upsert import AmbiguousMerge, fits_broadcast, require_unique_keys
from cambio.plans.merges import current_quotes, merge_brokers, merge_coins, merge_polls, merge_quotes
from cambio.schemas import COINS_TABLE, QUOTES_STATE, QUOTES_TABLE, STG_COINS, STG_QUOTES

RUN = datetime(2024, 2, 1, 10, 30)
T1, T2 = datetime(2024, 1, 28, 5), datetime(2024, 1, 29, 23, 59)
both_plans = pytest.mark.parametrize("broadcast", [True, False])


def quotes(spark, *data):
    return spark.createDataFrame(list(data), QUOTES_TABLE.schema)


def staged(spark, *data):
    return spark.createDataFrame(list(data), STG_QUOTES.schema)


@both_plans
def test_match_new_and_only_in_target(spark, rows, broadcast):
    target = quotes(spark, (1, 1, 10.0, 9.0, date(2024, 1, 1)), (1, 2, 20.0, 19.0, date(2024, 1, 2)))
    source = staged(spark, (1, 1, 11.0, 9.5, T1), (2, 1, 30.0, None, T2))
    merged = merge_quotes(target, source, RUN, broadcast_source=broadcast)
    assert merged.dtypes == target.dtypes
    assert rows(merged) == [
        (1, 1, 11.0, 9.5, date(2024, 1, 28)),
        (1, 2, 20.0, 19.0, date(2024, 1, 2)),
        (2, 1, 30.0, None, date(2024, 2, 1)),
    ]


@both_plans
def test_insert_date_of_the_quote(spark, rows, broadcast):
    merged = merge_quotes(
        quotes(spark), staged(spark, (2, 1, 30.0, None, T2)), RUN, insert_date="quote", broadcast_source=broadcast
    )
    assert rows(merged) == [(2, 1, 30.0, None, date(2024, 1, 29))]


@both_plans
def test_null_overwrites(spark, rows, broadcast):
    target = quotes(spark, (1, 1, 10.0, 9.0, date(2024, 1, 1)))
    source = staged(spark, (1, 1, 11.0, None, None))
    assert rows(merge_quotes(target, source, RUN, broadcast_source=broadcast)) == [(1, 1, 11.0, None, None)]


@both_plans
def test_duplicate_and_null_keys_in_the_target(spark, rows, broadcast):
    day = date(2024, 1, 1)
    target = quotes(spark, (1, 1, 1.0, 1.0, day), (1, 1, 2.0, 2.0, day), (None, 1, 3.0, 3.0, day), (1, None, 4.0, 4.0, day))
    source = staged(spark, (1, 1, 5.0, 5.0, T1))
    new = date(2024, 1, 28)
    assert rows(merge_quotes(target, source, RUN, broadcast_source=broadcast)) == sorted(
        [(1, 1, 5.0, 5.0, new), (1, 1, 5.0, 5.0, new), (None, 1, 3.0, 3.0, day), (1, None, 4.0, 4.0, day)], key=repr
    )


def test_duplicate_source_key_is_refused(spark):
    with pytest.raises(AmbiguousMerge, match="cripto_id"):
        require_unique_keys(staged(spark, (1, 1, 1.0, None, T1), (1, 1, 2.0, None, T1)), ["cripto_id", "broker_id"])
    require_unique_keys(staged(spark, (1, 1, 1.0, None, T1), (1, 2, 1.0, None, T1)), ["cripto_id", "broker_id"])


@both_plans
def test_dimension_load_time_moves(spark, rows, broadcast):
    old = datetime(2024, 1, 1)
    target = spark.createDataFrame([(1, "btc", old), (9, "old", old)], COINS_TABLE.schema)
    source = spark.createDataFrame([(1, "btc"), (2, "eth")], STG_COINS.schema)
    assert rows(merge_coins(target, source, RUN, broadcast_source=broadcast)) == [
        (1, "btc", RUN),
        (2, "eth", RUN),
        (9, "old", old),
    ]


def test_broker_merge_renames(spark, rows):
    target = spark.createDataFrame([(1, "a", None)], "broker_id int, broker_name string, fecha_carga timestamp_ntz")
    source = spark.createDataFrame([(1, "b")], "broker_id int, broker_name string")
    assert rows(merge_brokers(target, source, RUN)) == [(1, "b", RUN)]


@both_plans
@pytest.mark.parametrize("seed", range(4))
def test_random_merges_equal_a_python_merge(spark, rows, broadcast, seed):
    r = random.Random(seed)
    hot = (1, 1)
    keys = [(r.randint(1, 6), r.randint(1, 6)) for _ in range(30)] + [hot] * 15 + [(None, 1)] * 3
    target = [(*k, r.random(), r.choice([None, r.random()]), date(2024, 1, r.randint(1, 28))) for k in keys]
    chosen = sorted({(r.randint(1, 8), r.randint(1, 8)) for _ in range(20)} | {hot})
    source = [(*k, r.random(), r.choice([None, r.random()]), datetime(2024, 1, r.randint(1, 28), 7)) for k in chosen]
    by_key = {s[:2]: s for s in source}
    expected = [(*by_key[t[:2]][:4], by_key[t[:2]][4].date()) if t[:2] in by_key else t for t in target]
    expected += [(*s[:4], RUN.date()) for s in source if s[:2] not in {t[:2] for t in target}]
    merged = merge_quotes(quotes(spark, *target), staged(spark, *source), RUN, broadcast_source=broadcast)
    assert rows(merged) == sorted(expected, key=repr)


def test_broadcast_needs_a_counted_bound():
    assert fits_broadcast(1000, 80)
    assert not fits_broadcast(None, 80)
    assert not fits_broadcast(upsert_module.BROADCAST_BYTES // 80 + 1, 80)


def test_small_source_leaves_the_target_in_place(spark, tmp_path):
    spark.range(1000).selectExpr(
        "cast(id as int) cripto_id", "1 broker_id", "1d p_compra", "1d p_venta", "date'2024-01-01' fecha_cotizacion"
    ).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = staged(spark, (1, 1, 1.0, None, T1))
    plan = merge_quotes(target, source, RUN, broadcast_source=True)._jdf.queryExecution().executedPlan().toString()
    update_branch = plan.split("LeftAnti")[0]
    assert "BroadcastHashJoin" in update_branch and "LeftOuter" in update_branch
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in update_branch


def test_hot_target_key_is_split(spark, tmp_path):
    """A third of the target under one key: adaptive execution splits that partition of the shuffled plan."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    hot = F.when(F.rand(1) < 0.34, 0).otherwise(F.col("id")).cast("int")
    spark.range(60000).repartition(8).select(
        hot.alias("cripto_id"), F.lit(1).alias("broker_id"), F.rand(2).alias("p_compra"), F.rand(3).alias("p_venta"),
        F.lit(date(2024, 1, 1)).alias("fecha_cotizacion"),
    ).write.parquet(str(tmp_path / "t"))
    spark.range(0, 60000, 7).selectExpr(
        "cast(id as int) cripto_id", "1 broker_id", "-1d p_compra", "cast(null as double) p_venta",
        "timestamp_ntz'2024-01-28 00:00:00' fecha_cotizacion",
    ).write.parquet(str(tmp_path / "s"))
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        target, source = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
        merged = merge_quotes(target, source, RUN)
        got = merged.where("p_compra = -1 and fecha_cotizacion = date'2024-01-28'").count()
        assert got == target.where("cripto_id % 7 = 0").count()
        frame = merge_quotes(target, source, RUN)
        frame.write.format("noop").mode("overwrite").save()
        frame.collect()
        assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def polled(spark, *data):
    return spark.createDataFrame(list(data), QUOTES_STATE.schema)


@both_plans
def test_merge_of_late_polls(spark, rows, broadcast):
    """By pair: newer, older, equal, only in the target, new; NULL keys never match."""
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    target = polled(
        spark, (1, 1, 1.0, 1.0, d1, T1, False), (1, 2, 2.0, 2.0, d1, T2, False), (1, 3, 3.0, 3.0, d1, T1, True),
        (1, 4, 4.0, 4.0, d1, T1, False), (None, 1, 5.0, 5.0, d1, T1, False),
    )
    source = polled(
        spark, (1, 1, 9.0, None, None, T2, False), (1, 2, 9.0, 9.0, d2, T1, False), (1, 3, 9.0, 9.0, d2, T1, False),
        (2, 1, 9.0, 9.0, d2, T2, True),
    )
    merged = merge_polls(target, source, broadcast_source=broadcast)
    assert merged.dtypes == target.dtypes
    assert rows(merged) == sorted(
        [
            (1, 1, 9.0, None, None, T2, True), (1, 2, 2.0, 2.0, d1, T2, True), (1, 3, 9.0, 9.0, d2, T1, True),
            (1, 4, 4.0, 4.0, d1, T1, False), (None, 1, 5.0, 5.0, d1, T1, False), (2, 1, 9.0, 9.0, d2, T2, True),
        ],
        key=repr,
    )
    shown = {r.broker_id: r.fecha_cotizacion for r in current_quotes(merged).where("cripto_id = 1").collect()}
    assert shown == {1: None, 2: d1, 3: d2, 4: T1.date()}
