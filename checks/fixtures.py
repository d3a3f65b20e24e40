"""Quote feeds made from the driver tables, whole tables each.

Three feeds with different shapes:

* ``ev``   events as quotes of (event type, user): some hundred pairs, about a dozen quotes each.
* ``li``   line items as quotes of (part, supplier): very many pairs, few quotes each.
* ``desk`` events as quotes of the literal 3 coins at the literal 11 brokers: 33 pairs that hold everything, plus names
  that are in neither dimension.

A feed row is what a decoded document gives (``cripto, broker, ask, totalAsk, bid, totalBid, time``) plus its sort key
and the ``side`` it belongs to: the ``baseline`` a table starts with, or the ``poll`` merged into it. For the event feeds
the border between the sides depends on the nation of the user, so all three merge classes occur.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cambio.plans.normalize import normalize_quotes
from cambio.schemas import (
    BROKERS,
    DOCUMENT_SCHEMA,
    QUOTE_FIELDS,
    QUOTES_TABLE,
    STG_COINS,
    broker_dimension,
    coin_dimension,
    local_relation,
)

RUN_TS = datetime(2024, 2, 1, 10, 30)
BASELINE_TS = datetime(2024, 1, 1)
WIRE = ["cripto", "broker", *QUOTE_FIELDS]


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ev

    def ev(self) -> DataFrame:
        return self._events(
            cripto=F.col("event_type"),
            broker=F.concat(F.lit("user_"), F.col("user_id").cast("string")),
            price=F.col("value"),
            hours_per_nation=30,
        )

    def ev_coins(self) -> DataFrame:
        return local_relation(self.spark, [(1, "view"), (2, "click"), (3, "purchase")], STG_COINS.schema)

    def ev_brokers(self) -> DataFrame:
        return self.table("customer").where("c_acctbal >= 0").select(
            F.col("c_custkey").cast("int").alias("broker_id"),
            F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("broker_name"),
        )

    # desk

    def desk(self) -> DataFrame:
        coins = {"view": "btc", "click": "eth", "purchase": "dai", "signup": "usdt", "error": "usdc"}
        coin_of = F.create_map(*[F.lit(x) for pair in coins.items() for x in pair])
        brokers = F.array(*[F.lit(name) for _, name in BROKERS])
        nation = F.col("c_nationkey")
        return self._events(
            cripto=coin_of[F.col("event_type")],
            broker=F.coalesce(F.get(brokers, nation), F.concat(F.lit("desk_"), nation.cast("string"))),
            price=F.col("value") + 49950,
            hours_per_nation=72,
        )

    def _events(self, cripto: Column, broker: Column, price: Column, hours_per_nation: int) -> DataFrame:
        opened = F.expr(f"TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, c_nationkey * {hours_per_nation})")
        joined = self.table("events").join(self.table("customer"), F.col("user_id") == F.col("c_custkey"))
        return joined.select(
            "event_id",
            "ts",
            "event_type",
            F.when(F.col("ts") < opened, "baseline").otherwise("poll").alias("side"),
            cripto.alias("cripto"),
            broker.alias("broker"),
            price.alias("ask"),
            price.alias("totalAsk"),
            price.alias("bid"),
            F.when(F.col("value") >= 5, price * 0.99).alias("totalBid"),
            epoch_seconds("ts").alias("time"),
        )

    # li

    def li_lines(self, side: str | None = None) -> DataFrame:
        """Line items, all of them or those of one side."""
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate"
        )
        border = F.lit("2000-01-01").cast("timestamp_ntz")
        if side is None:
            return lines
        return lines.where(F.col("l_shipdate") < border if side == "baseline" else F.col("l_shipdate") >= border)

    def li(self, lines: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
        price, discounted = F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount"))
        return (self.li_lines() if lines is None else lines).select(
            *keep,
            F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("cripto"),
            F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("broker"),
            price.alias("ask"),
            price.alias("totalAsk"),
            price.alias("bid"),
            discounted.alias("totalBid"),
            epoch_seconds("l_shipdate").alias("time"),
        )

    def li_coins(self) -> DataFrame:
        return self.table("part").where("p_size <= 40").select(
            F.col("p_partkey").cast("int").alias("cripto_id"),
            F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("cripto_name"),
        )

    def li_brokers(self) -> DataFrame:
        return self.table("supplier").where("s_nationkey < 20").select(
            F.col("s_suppkey").cast("int").alias("broker_id"), F.col("s_name").alias("broker_name")
        )

    # one quote per pair, as a poll has it

    def ev_side(self, side: str) -> DataFrame:
        return normalize_quotes(picked_events(self.ev(), side), self.ev_coins(), self.ev_brokers())

    def desk_side(self, side: str) -> DataFrame:
        rows = picked_events(self.desk(), side)
        return normalize_quotes(rows, coin_dimension(self.spark), broker_dimension(self.spark))

    def li_side(self, side: str) -> DataFrame:
        lines = newest(self.li_lines(side), ["l_partkey", "l_suppkey"], LI_ORDER)
        return normalize_quotes(self.li(lines), self.li_coins(), self.li_brokers())


LI_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
EV_ORDER = ("ts", "event_id")


def picked_events(feed: DataFrame, side: str) -> DataFrame:
    return newest(feed.where(F.col("side") == side), ["cripto", "broker"], EV_ORDER).select(*WIRE)


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def epoch_seconds(name: str) -> Column:
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {name})").cast("double")


def as_quotes_table(staged: DataFrame) -> DataFrame:
    """Staging rows in the final table's columns and types."""
    date = F.col("fecha_cotizacion").cast("date").alias("fecha_cotizacion")
    return staged.select(*[c for c in QUOTES_TABLE.columns if c != "fecha_cotizacion"], date)


def quote_json(*fields: str) -> Column:
    """One broker's JSON object; whole seconds, as the quote service sends them. NULL fields are left out."""
    columns = [F.col("time").cast("bigint").alias("time") if f == "time" else F.col(f) for f in fields or QUOTE_FIELDS]
    return F.to_json(F.struct(*columns))


def documents(feed: DataFrame, poll_ts: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One answered document per feed row: a row-wise step, whatever share of the rows one coin holds."""
    return feed.select(
        *keep,
        poll_ts.alias("poll_ts"),
        F.col("cripto").alias("cripto_name"),
        F.lit(200).alias("status"),
        F.concat(F.lit('{"'), F.col("broker"), F.lit('":'), quote_json(), F.lit("}")).alias("body"),
    )


def event_documents(feed: DataFrame) -> DataFrame:
    """One document per event with two brokers, in signups also a broker that is no object. Errors are failed polls."""
    entry = F.concat(F.lit('"'), F.col("broker"), F.lit('":'), quote_json())
    mirror = F.concat(F.lit('"mirror_'), F.col("broker"), F.lit('":'), quote_json("totalAsk", "totalBid", "time"))
    note = F.when(F.col("event_type") == "signup", ',"note":5').otherwise("")
    failed = F.col("event_type") == "error"
    return feed.select(
        "event_id",
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("poll_ts"),
        F.col("cripto").alias("cripto_name"),
        F.when(failed, 500).otherwise(200).alias("status"),
        F.when(failed, "service unavailable")
        .otherwise(F.concat(F.lit("{"), entry, F.lit(","), mirror, note, F.lit("}")))
        .alias("body"),
    )


assert DOCUMENT_SCHEMA.fieldNames() == ["poll_ts", "cripto_name", "status", "body"]
