"""The registered queries: (spark, sf_dir) → DataFrame, every one over whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cambio.functions.times import epoch_to_timestamp, load_time
from cambio.operators.alerts import alert_messages, alerts
from cambio.operators.constraints import violations
from cambio.operators.documents import (
    accepted_quotes,
    concat_by_name,
    decode_entries,
    rejected_quotes,
    split_by_status,
    unpivot_quotes,
)
from cambio.operators.latest import latest_price, latest_prices
from cambio.operators.quotes import (
    convert_time,
    distinct_rows,
    lookup_broker,
    lookup_coin,
    project_quotes,
    rename_quotes,
)
from cambio.operators.upsert import count_source, fits_broadcast
from cambio.plans.daily import (
    Warehouse,
    load_brokers,
    load_coins,
    load_quotes,
    merge_staged_quotes,
    run_daily_load,
)
from cambio.plans.merges import QUOTE_KEYS, merge_brokers, merge_coins, merge_quotes
from cambio.plans.normalize import normalize_quotes
from cambio.schemas import (
    LOADED_FIELDS,
    QUOTES_TABLE,
    RULE_SCHEMA,
    STG_BROKERS,
    STG_QUOTES,
    TABLES,
    broker_dimension,
    coin_dimension,
    local_relation,
)
from cambio.session import configure, work_dir
from cambio.sinks.catalog import define_tables, describe_layout, load_table
from cambio.sinks.load import append_staging, load, replace_staging, truncate_staging
from cambio.sources.landing import (
    documents_of_poll,
    land_documents,
    read_document_files,
    read_documents,
    stream_documents,
)
from cambio.streaming.incremental import run_available
from checks.fixtures import (
    BASELINE_TS,
    EV_ORDER,
    LI_ORDER,
    RUN_TS,
    WIRE,
    Fixtures,
    as_quotes_table,
    documents,
    event_documents,
    newest,
    quote_json,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

PARTS = 4
BROKERS_PER_FILE = 1000
RECIPIENT = "desk@example.org"


def query(function: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    """Register ``function(fixtures)`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(Fixtures(configure(spark), sf_dir))

    REGISTRY[function.__name__] = run
    return function


# --- documents ---


@query
def answered_polls(t: Fixtures) -> DataFrame:
    answered, _ = split_by_status(event_documents(t.ev()))
    return answered.select("event_id", "poll_ts", "cripto_name", "status")


@query
def failed_polls(t: Fixtures) -> DataFrame:
    _, failed = split_by_status(event_documents(t.ev()))
    return failed.select("event_id", "poll_ts", "cripto_name", "status")


@query
def decode_documents(t: Fixtures) -> DataFrame:
    answered, _ = split_by_status(event_documents(t.ev()))
    return unpivot_quotes(answered, ["event_id"])


@query
def rejected_brokers(t: Fixtures) -> DataFrame:
    answered, _ = split_by_status(event_documents(t.ev()))
    return rejected_quotes(answered, ["event_id"])


@query
def landed_documents(t: Fixtures) -> DataFrame:
    landing = work_dir(t.spark, "landing")
    land_documents(event_documents(t.ev()), landing)
    answered, _ = split_by_status(read_documents(t.spark, landing))
    return unpivot_quotes(answered, ["poll_ts"]).select("poll_ts", "cripto", "broker", "totalAsk", "totalBid", "time")


@query
def document_files(t: Fixtures) -> DataFrame:
    """A JSON file per poll, coin and thousand brokers, written out and read as whole files."""
    landing = work_dir(t.spark, "landing")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    polls = newest(t.ev().withColumn("poll_ts", day), ["poll_ts", "cripto", "broker"], EV_ORDER)
    entry = F.concat(F.lit('"'), F.col("broker"), F.lit('":'), quote_json("totalAsk", "totalBid", "time"))
    # a file holds a bounded number of brokers, so files grow in number and not in size
    share = F.floor(F.substring_index("broker", "_", -1).cast("bigint") / BROKERS_PER_FILE).alias("share")
    bodies = polls.groupBy("poll_ts", "cripto", share).agg(F.array_join(F.collect_list(entry), ",").alias("entries"))
    files = bodies.select(
        "poll_ts",
        F.concat("cripto", F.lit(".json")).alias("file"),
        "share",
        F.concat(F.lit("{"), "entries", F.lit("}")).alias("value"),
    )
    files.write.partitionBy("poll_ts", "file", "share").text(landing)
    quotes = unpivot_quotes(read_document_files(t.spark, landing), ["poll_ts"])
    return quotes.select("poll_ts", "cripto", "broker", "totalAsk", "totalBid", "time")


@query
def concat_quotes(t: Fixtures) -> DataFrame:
    return concat_by_name(
        [
            t.ev().select("cripto", "broker", "totalAsk", "time"),
            t.li(keep=["l_linenumber"]).select("broker", "cripto", "totalBid", F.col("l_linenumber").alias("line")),
        ]
    )


# --- quote rows ---


@query
def literal_dimensions(t: Fixtures) -> DataFrame:
    """Every event resolved against the literal coin and broker relations."""
    named = t.desk().withColumnsRenamed({"cripto": "cripto_name", "broker": "broker_name"})
    resolved = lookup_broker(lookup_coin(named, coin_dimension(t.spark)), broker_dimension(t.spark))
    return resolved.select("event_id", "cripto_id", "cripto_name", "broker_id", "broker_name")


@query
def rename_project(t: Fixtures) -> DataFrame:
    renamed = rename_quotes(t.li())
    return renamed.select("cripto_name", "broker_name", "p_compra", "p_venta", "fecha_cotizacion")


@query
def lookup_coin_ev(t: Fixtures) -> DataFrame:
    return lookup_coin(rename_quotes(t.ev()), t.ev_coins()).select("event_id", "cripto_id", "broker_name", "p_compra")


@query
def lookup_broker_ev(t: Fixtures) -> DataFrame:
    return lookup_broker(rename_quotes(t.ev()), t.ev_brokers()).select("event_id", "cripto_name", "broker_id")


@query
def lookup_coin_li(t: Fixtures) -> DataFrame:
    return lookup_coin(rename_quotes(t.li()), t.li_coins()).select("cripto_id", "broker_name", "p_compra")


@query
def lookup_broker_li(t: Fixtures) -> DataFrame:
    renamed = rename_quotes(t.li())
    return lookup_broker(renamed, t.li_brokers()).select("cripto_name", "broker_id", "p_venta")


@query
def epoch_times(t: Fixtures) -> DataFrame:
    exact = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)") / 1e6
    return t.ev().select(
        "event_id",
        epoch_to_timestamp(F.col("time")).alias("whole_seconds"),
        epoch_to_timestamp(exact).alias("exact"),
        epoch_to_timestamp(F.when(F.col("totalBid").isNotNull(), F.col("time"))).alias("maybe"),
    )


@query
def distinct_quotes(t: Fixtures) -> DataFrame:
    """Every quote twice, NULL prices included, down to distinct rows."""
    rows = project_quotes(lookup_broker(lookup_coin(rename_quotes(t.ev()), t.ev_coins()), t.ev_brokers()))
    return distinct_rows(convert_time(rows.unionAll(rows)))


@query
def normalize_ev(t: Fixtures) -> DataFrame:
    return normalize_quotes(t.ev().select(*WIRE), t.ev_coins(), t.ev_brokers())


@query
def normalize_li(t: Fixtures) -> DataFrame:
    return normalize_quotes(t.li(), t.li_coins(), t.li_brokers())


# --- staging and constraints ---


@query
def staging_replace(t: Fixtures) -> DataFrame:
    path = work_dir(t.spark, "staging")
    replace_staging(t.ev_side("baseline"), STG_QUOTES, path)
    return replace_staging(t.ev_side("poll"), STG_QUOTES, path)


@query
def staging_append(t: Fixtures) -> DataFrame:
    path = work_dir(t.spark, "staging")
    replace_staging(t.ev_side("baseline"), STG_QUOTES, path)
    return append_staging(t.ev_side("poll"), STG_QUOTES, path)


@query
def staging_truncate(t: Fixtures) -> DataFrame:
    """A load, emptied, then loaded anew by appending."""
    path = work_dir(t.spark, "staging")
    replace_staging(t.ev_side("baseline"), STG_QUOTES, path)
    truncate_staging(t.spark, STG_QUOTES, path)
    return append_staging(t.ev_side("poll"), STG_QUOTES, path)


@query
def load_fail(t: Fixtures) -> DataFrame:
    """A load into a new table, and one that the mode ``fail`` refuses because the table exists."""
    path = work_dir(t.spark, "table")
    load(t.ev_side("baseline"), path, if_exists="fail")
    try:
        load(t.ev_side("poll"), path, if_exists="fail")
    except AnalysisException:
        return t.spark.read.schema(STG_QUOTES.schema).parquet(path)
    raise AssertionError("a table that exists was loaded again")


@query
def constraint_violations(t: Fixtures) -> DataFrame:
    """Quotes with missing prices, NULL or NaN, and document texts used as names: most break the length limit."""
    quotes = t.ev().select(
        F.lit(1).alias("cripto_id"),
        F.when(F.col("event_type") != "error", F.col("event_id")).cast("int").alias("broker_id"),
        F.when(F.col("event_type") == "view", F.lit(float("nan"))).otherwise(F.col("totalBid")).alias("p_compra"),
    )
    names = t.table("documents").select(F.col("doc_id").cast("int").alias("broker_id"), F.col("text").alias("broker_name"))
    return violations(quotes, STG_QUOTES).unionAll(violations(names, STG_BROKERS))


# --- merges ---


def _staged(t: Fixtures, rows: DataFrame) -> tuple[DataFrame, bool]:
    staged = replace_staging(rows, STG_QUOTES, work_dir(t.spark, "staging"))
    return staged, fits_broadcast(count_source(staged, QUOTE_KEYS), STG_QUOTES.row_bytes)


@query
def merge_quotes_ev(t: Fixtures) -> DataFrame:
    staged, small = _staged(t, t.ev_side("poll"))
    return merge_quotes(as_quotes_table(t.ev_side("baseline")), staged, RUN_TS, broadcast_source=small)


@query
def merge_quotes_li(t: Fixtures) -> DataFrame:
    staged, small = _staged(t, t.li_side("poll"))
    return merge_quotes(as_quotes_table(t.li_side("baseline")), staged, RUN_TS, broadcast_source=small)


@query
def merge_quotes_li_shuffled(t: Fixtures) -> DataFrame:
    """The plan for a source above the broadcast bound."""
    return merge_quotes(as_quotes_table(t.li_side("baseline")), t.li_side("poll"), RUN_TS)


@query
def committed_quotes_li(t: Fixtures) -> DataFrame:
    """Two loads through staging, merge and snapshot commit; the committed table read back."""
    warehouse = Warehouse(t.spark, work_dir(t.spark, "warehouse"), PARTS)
    load_quotes(warehouse, t.li_side("baseline"), BASELINE_TS)
    load_quotes(warehouse, t.li_side("poll"), RUN_TS)
    return warehouse.quotes.read()


@query
def committed_quotes_li_shuffled(t: Fixtures) -> DataFrame:
    """The same through the plan for a source above the broadcast bound."""
    warehouse = Warehouse(t.spark, work_dir(t.spark, "warehouse"), PARTS)
    for side, run_ts in (("baseline", BASELINE_TS), ("poll", RUN_TS)):
        staged = replace_staging(t.li_side(side), STG_QUOTES, work_dir(t.spark, "staging"))
        merge_staged_quotes(warehouse, staged, run_ts, broadcast_source=False)
    return warehouse.quotes.read()


@query
def merge_coins_part(t: Fixtures) -> DataFrame:
    part = t.table("part").withColumn("cripto_id", F.col("p_partkey").cast("int"))
    target = part.where("p_size <= 40").select(
        "cripto_id", F.col("p_name").alias("cripto_name"), load_time(BASELINE_TS).alias("fecha_carga")
    )
    source = part.where("p_size > 10").select("cripto_id", F.col("p_type").alias("cripto_name"))
    return merge_coins(target, source, RUN_TS)


@query
def merge_brokers_supplier(t: Fixtures) -> DataFrame:
    supplier = t.table("supplier").withColumn("broker_id", F.col("s_suppkey").cast("int"))
    target = supplier.where("s_nationkey < 18").select(
        "broker_id", F.col("s_name").alias("broker_name"), load_time(BASELINE_TS).alias("fecha_carga")
    )
    source = supplier.where("s_nationkey >= 6").select(
        "broker_id", F.concat(F.lit("venue "), F.col("s_name")).alias("broker_name")
    )
    return merge_brokers(target, source, RUN_TS)


@query
def table_layout(t: Fixtures) -> DataFrame:
    """The six tables defined in the catalog, loaded from the driver tables, and described with their row counts."""
    spark, database = t.spark, f"cambio_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_dir(spark, 'catalog')}'")
    define_tables(spark, database, buckets=PARTS)
    poll, loaded = t.ev_side("poll"), load_time(RUN_TS).alias("fecha_carga")
    rows = {
        "stg_brokers": t.ev_brokers(),
        "stg_criptomonedas": t.li_coins(),
        "stg_cotizaciones": poll,
        "brokers": t.ev_brokers().select("*", loaded),
        "criptomonedas": t.li_coins().select("*", loaded),
        "cotizaciones": as_quotes_table(poll),
    }
    for spec in TABLES:
        load_table(rows[spec.name], spec, database)
    described = []
    for spec in TABLES:
        layout = describe_layout(spark, spec, database)
        columns = spark.sql(f"SELECT * FROM {database}.{spec.name} LIMIT 0").columns
        kinds = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {database}.{spec.name}").collect()}
        required = layout["not_null"].split(",")
        for position, column in enumerate(columns, 1):
            described.append(
                (
                    spec.name,
                    position,
                    column,
                    kinds[column],
                    "yes" if column in required else "no",
                    layout["distribution"],
                    layout["bucket_columns"],
                    layout["sort_columns"],
                )
            )
    names = "column_name data_type not_null distribution bucket_columns sort_columns".split()
    schema = T.StructType(
        [
            T.StructField("table_name", T.StringType()),
            T.StructField("position", T.IntegerType()),
            *[T.StructField(name, T.StringType()) for name in names],
        ]
    )
    counts = [
        spark.table(f"{database}.{spec.name}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(spec.name).alias("table_name"), "n_rows"
        )
        for spec in TABLES
    ]
    return local_relation(spark, described, schema).join(concat_by_name(counts), "table_name")


# --- latest price and alerts ---


def _desk_history(t: Fixtures) -> DataFrame:
    """All quotes of the desk feed; the dearest have no date."""
    rows = normalize_quotes(t.desk().select(*WIRE), coin_dimension(t.spark), broker_dimension(t.spark))
    date = F.when(F.col("p_compra") < 50150, F.col("fecha_cotizacion").cast("date")).alias("fecha_cotizacion")
    return rows.select("cripto_id", "broker_id", "p_compra", "p_venta", date)


def _li_history(t: Fixtures) -> DataFrame:
    return as_quotes_table(normalize_li(t))


def _desk_rules(t: Fixtures) -> DataFrame:
    rules = [(c, b, th, label, RECIPIENT) for c, label in [(1, "Bitcoin"), (2, "Ether"), (3, "Dai")]
             for b in range(1, 12) for th in (50000.0, 50100.5)]
    return local_relation(t.spark, rules, RULE_SCHEMA)


def _li_rules(t: Fixtures) -> DataFrame:
    """A rule for every pair that ever had a return."""
    returned = t.table("lineitem").where("l_returnflag = 'R'").select("l_partkey", "l_suppkey").distinct()
    return returned.select(
        F.col("l_partkey").cast("int").alias("cripto_id"),
        F.col("l_suppkey").cast("int").alias("broker_id"),
        F.lit(50000.0).alias("threshold"),
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("label"),
        F.concat(F.lit("desk_"), F.col("l_suppkey").cast("string")).alias("recipient"),
    )


@query
def latest_price_one(t: Fixtures) -> DataFrame:
    return latest_price(_desk_history(t), 1, 1)


@query
def latest_price_per_pair(t: Fixtures) -> DataFrame:
    return latest_prices(_li_history(t)).select("cripto_id", "broker_id", "p_compra", "fecha_cotizacion")


def _bucketed_history(t: Fixtures) -> DataFrame:
    """All quotes of the line-item feed in a catalog table with buckets by coin."""
    spark, database = t.spark, f"cambio_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_dir(spark, 'catalog')}'")
    define_tables(spark, database, buckets=PARTS, by=QUOTES_TABLE.distribute_by)
    load_table(_li_history(t), QUOTES_TABLE, database)
    return spark.table(f"{database}.{QUOTES_TABLE.name}")


@query
def latest_price_bucketed(t: Fixtures) -> DataFrame:
    """The newest row of every pair of a bucketed table: ranked where it lies, without a shuffle."""
    return latest_prices(_bucketed_history(t)).select("cripto_id", "broker_id", "p_compra", "fecha_cotizacion")


@query
def latest_price_one_bucket(t: Fixtures) -> DataFrame:
    """The newest price of one pair of a bucketed table: one bucket is read."""
    history = _bucketed_history(t)
    pair = history.orderBy("cripto_id", "broker_id").select("cripto_id", "broker_id").first()
    return latest_price(history, pair.cripto_id, pair.broker_id)


@query
def latest_price_hot_pairs(t: Fixtures) -> DataFrame:
    return latest_prices(_desk_history(t)).select("cripto_id", "broker_id", "p_compra", "fecha_cotizacion")


@query
def alerts_li(t: Fixtures) -> DataFrame:
    return alerts(_li_history(t), _li_rules(t)).select("cripto_id", "broker_id", "threshold", "recipient", "p_compra")


@query
def alert_messages_li(t: Fixtures) -> DataFrame:
    return alert_messages(alerts(_li_history(t), _li_rules(t)))


@query
def alert_messages_desk(t: Fixtures) -> DataFrame:
    return alert_messages(alerts(_desk_history(t), _desk_rules(t), broadcast_rules=True))


@query
def alert_messages_small(t: Fixtures) -> DataFrame:
    """Prices and thresholds far below one, as of coins that trade in millionths."""
    rows = _li_history(t).withColumn("p_compra", F.floor("p_compra") / F.lit(1e8))
    rules = _li_rules(t).withColumn("threshold", F.lit(0.00025))
    return alert_messages(alerts(rows, rules))


# --- the whole job ---


def _daily(t: Fixtures) -> tuple[Warehouse, DataFrame]:
    """Two daily runs over the line-item feed: one document per pair and side, a rule for every pair with a return."""
    warehouse, landing = Warehouse(t.spark, work_dir(t.spark, "warehouse"), PARTS), work_dir(t.spark, "landing")
    for side, run_ts in (("baseline", BASELINE_TS), ("poll", RUN_TS)):
        lines = newest(t.li_lines(side), ["l_partkey", "l_suppkey"], LI_ORDER)
        land_documents(documents(t.li(lines), load_time(run_ts)), landing)
        poll = documents_of_poll(read_documents(t.spark, landing), run_ts)
        messages = run_daily_load(warehouse, poll, run_ts, t.li_coins(), t.li_brokers(), _li_rules(t))
    return warehouse, messages


@query
def daily_load(t: Fixtures) -> DataFrame:
    """Two daily runs over documents; the three committed tables, joined."""
    warehouse, _ = _daily(t)
    coins = warehouse.coins.read().withColumnRenamed("fecha_carga", "coin_loaded")
    brokers = warehouse.brokers.read().withColumnRenamed("fecha_carga", "broker_loaded")
    return warehouse.quotes.read().join(coins, "cripto_id").join(brokers, "broker_id")


@query
def daily_load_messages(t: Fixtures) -> DataFrame:
    _, messages = _daily(t)
    return messages


@query
def quiet_poll(t: Fixtures) -> DataFrame:
    """A load, then a poll whose quotes are all of unknown brokers; the committed quotes read back."""
    warehouse = Warehouse(t.spark, work_dir(t.spark, "warehouse"))
    load_quotes(warehouse, t.li_side("baseline"), BASELINE_TS)
    strangers = t.li(t.li_lines("poll")).withColumn("broker", F.concat(F.lit("no "), F.col("broker")))
    load_quotes(warehouse, normalize_quotes(strangers, t.li_coins(), t.li_brokers()), RUN_TS)
    return warehouse.quotes.read()


@query
def latest_price_committed(t: Fixtures) -> DataFrame:
    """The latest price of one pair, of the committed table; one part of it is read."""
    warehouse = Warehouse(t.spark, work_dir(t.spark, "warehouse"), PARTS)
    load_quotes(warehouse, t.li_side("baseline"), BASELINE_TS)
    load_quotes(warehouse, t.li_side("poll"), RUN_TS)
    pair = t.li_side("poll").orderBy("cripto_id", "broker_id").select("cripto_id", "broker_id").first()
    return warehouse.latest_price(pair.cripto_id, pair.broker_id)


@query
def warehouse_sql(t: Fixtures) -> DataFrame:
    """SQL text over views of the three committed tables."""
    warehouse, prefix = Warehouse(t.spark, work_dir(t.spark, "warehouse"), PARTS), f"v{uuid.uuid4().hex}_"
    load_quotes(warehouse, t.li_side("baseline"), BASELINE_TS)
    load_quotes(warehouse, t.li_side("poll"), RUN_TS)
    load_coins(warehouse, t.li_coins(), RUN_TS)
    load_brokers(warehouse, t.li_brokers(), RUN_TS)
    warehouse.register_views(prefix)
    return t.spark.sql(
        f"""
        SELECT cripto_name, broker_name, p_compra, fecha_cotizacion
        FROM {prefix}cotizaciones
        JOIN {prefix}criptomonedas USING (cripto_id)
        JOIN {prefix}brokers USING (broker_id)
        WHERE p_compra > 50000 AND fecha_cotizacion >= DATE '2000-06-15'
        """
    )


def _streamed(t: Fixtures, newest_first: bool) -> DataFrame:
    """Quarterly polls of the line-item feed, landed in two parts, loaded by two runs of the same stream."""
    landing, warehouse = work_dir(t.spark, "landing"), Warehouse(t.spark, work_dir(t.spark, "warehouse"), PARTS)
    checkpoint = work_dir(t.spark, "stream")
    quarter = F.date_trunc("quarter", "l_shipdate").cast("timestamp_ntz")
    picked = newest(t.li_lines().withColumn("quarter", quarter), ["l_partkey", "l_suppkey", "quarter"], LI_ORDER)
    polls = documents(t.li(picked, keep=["quarter"]), F.expr("quarter + INTERVAL '3' MONTH"))
    border = F.lit(datetime(1999, 1, 1).isoformat()).cast("timestamp_ntz")
    parts = [F.col("poll_ts") < border, F.col("poll_ts") >= border]
    for part in parts[::-1] if newest_first else parts:
        land_documents(polls.where(part), landing)
        run_available(
            warehouse, stream_documents(t.spark, landing), checkpoint, coins=t.li_coins(), brokers=t.li_brokers()
        )
    return warehouse.quotes.read()


@query
def stream_load(t: Fixtures) -> DataFrame:
    """Polls that land in poll order."""
    return _streamed(t, newest_first=False)


@query
def stream_load_late(t: Fixtures) -> DataFrame:
    """The older half of the polls lands after the newer one was merged; the table is the one that poll order gives."""
    return _streamed(t, newest_first=True)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to alert messages in one lazy plan: decode, normalize, newest price per pair, rules."""
    t = Fixtures(configure(spark), sf_dir)
    quotes = accepted_quotes(decode_entries(documents(t.desk(), F.col("ts")), fields=LOADED_FIELDS))
    staged = normalize_quotes(quotes, coin_dimension(spark), broker_dimension(spark))
    return alert_messages(alerts(as_quotes_table(staged), _desk_rules(t), broadcast_rules=True))


REGISTRY["documents_to_alerts"] = flagship
assert QUOTES_TABLE.columns == ["cripto_id", "broker_id", "p_compra", "p_venta", "fecha_cotizacion"]
