"""Table contracts: schemas, constraints, physical layout and the literal dimensions."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------------------------------------------------
# Names, ids and limits of the data contract. They have to be exactly these for results to agree.

COINS = [(1, "btc"), (2, "eth"), (3, "dai")]

BROKERS = [
    (1, "binancep2p"),
    (2, "fiwind"),
    (3, "letsbit"),
    (4, "tiendacrypto"),
    (5, "bitsoalpha"),
    (6, "calypso"),
    (7, "decrypto"),
    (8, "banexcoin"),
    (9, "buenbit"),
    (10, "fluyez"),
    (11, "vitawallet"),
]

QUOTE_FIELDS = ("ask", "totalAsk", "bid", "totalBid", "time")

QUOTE_NAMES = {
    "cripto": "cripto_name",
    "broker": "broker_name",
    "totalAsk": "p_compra",
    "totalBid": "p_venta",
    "time": "fecha_cotizacion",
}

#: The fields of a quote that end up in a table.
LOADED_FIELDS = ("totalAsk", "totalBid", "time")

NAME_BYTES = 100

POLL_FIAT = "usd"
POLL_VOLUME = 0.1

# fmt: off
API_COINS = [
    "BTC", "DAI", "ETH", "USDT", "USDC", "BNB", "AAVE", "ADA", "AXS", "BAT", "CAKE", "DOGE", "DOT", "EOS", "LINK", "LTC",
    "MANA", "PAXG", "SAND", "SHIB", "SLP", "SOL", "TRX", "UNI", "XLM", "XRP", "AVAX", "BCH", "BUSD", "CHZ", "FTM", "MATIC",
    "ALGO", "NUARS", "DOC", "USDP", "UXD",
]
# fmt: on
API_FIATS = ["ARS", "BRL", "PEN", "CLP", "COP", "MXN", "USD", "UYU", "VES"]

ALERT_COIN_ID = 1
ALERT_BROKER_ID = 1
ALERT_THRESHOLD = 50000.0
ALERT_LABEL = "Bitcoin"
# ----------------------------------------------------------------------------------------------------------------------

#: One landed answer of the quote service: which coin was asked for, when, with which HTTP status and body.
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("poll_ts", T.TimestampNTZType()),
        T.StructField("cripto_name", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """A warehouse table: columns, load constraints and layout.

    ``replicated`` marks small tables that every node should hold (a broadcast candidate), ``distribute_by`` the columns
    whose equal values belong together, ``sort_by`` the order inside a file.
    """

    name: str
    schema: T.StructType
    not_null: tuple[str, ...] = ()
    max_bytes: tuple[tuple[str, int], ...] = ()
    replicated: bool = False
    distribute_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def row_bytes(self) -> int:
        """Upper bound of one row's width: 8 bytes per fixed-width column, the length limit for bounded strings."""
        limits = dict(self.max_bytes)
        return sum(limits.get(f.name, 8) + 8 for f in self.schema.fields)

    def ddl_columns(self) -> str:
        limits = dict(self.max_bytes)
        return ", ".join(
            f"{f.name} {'varchar(%d)' % limits[f.name] if f.name in limits else f.dataType.simpleString()}"
            + (" NOT NULL" if f.name in self.not_null else "")
            for f in self.schema.fields
        )


def _columns(ddl: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES[kind]) for name, kind in (item.split() for item in ddl.split(","))]
    )


_TYPES = {
    "int": T.IntegerType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
}

STG_BROKERS = TableSpec(
    "stg_brokers",
    _columns("broker_id int, broker_name string"),
    not_null=("broker_id",),
    max_bytes=(("broker_name", NAME_BYTES),),
    replicated=True,
    sort_by=("broker_id",),
)

STG_COINS = TableSpec(
    "stg_criptomonedas",
    _columns("cripto_id int, cripto_name string"),
    not_null=("cripto_id",),
    max_bytes=(("cripto_name", NAME_BYTES),),
    replicated=True,
    sort_by=("cripto_id",),
)

STG_QUOTES = TableSpec(
    "stg_cotizaciones",
    _columns("cripto_id int, broker_id int, p_compra double, p_venta double, fecha_cotizacion timestamp"),
    not_null=("cripto_id", "broker_id", "p_compra"),
    sort_by=("fecha_cotizacion",),
)

BROKERS_TABLE = TableSpec(
    "brokers",
    _columns("broker_id int, broker_name string, fecha_carga timestamp"),
    max_bytes=(("broker_name", NAME_BYTES),),
    replicated=True,
    sort_by=("broker_id",),
)

COINS_TABLE = TableSpec(
    "criptomonedas",
    _columns("cripto_id int, cripto_name string, fecha_carga timestamp"),
    max_bytes=(("cripto_name", NAME_BYTES),),
    replicated=True,
    sort_by=("cripto_id",),
)

QUOTES_TABLE = TableSpec(
    "cotizaciones",
    _columns("cripto_id int, broker_id int, p_compra double, p_venta double, fecha_cotizacion date"),
    distribute_by=("cripto_id",),
    sort_by=("fecha_cotizacion",),
)

#: The quotes as they are stored: ``fecha_cotizacion`` is the quote's own date, ``_poll`` the newest poll merged into the
#: pair, and ``_again`` whether it was merged more than once. What the table shows follows from these, in any order of polls.
QUOTES_STATE = TableSpec(
    QUOTES_TABLE.name,
    T.StructType([*QUOTES_TABLE.schema.fields, T.StructField("_poll", T.TimestampNTZType()), T.StructField("_again", T.BooleanType())]),
    distribute_by=QUOTES_TABLE.distribute_by,
    sort_by=QUOTES_TABLE.sort_by,
)

TABLES = (STG_BROKERS, STG_COINS, STG_QUOTES, BROKERS_TABLE, COINS_TABLE, QUOTES_TABLE)

RULE_SCHEMA = T.StructType(
    [
        T.StructField("cripto_id", T.IntegerType()),
        T.StructField("broker_id", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("label", T.StringType()),
        T.StructField("recipient", T.StringType()),
    ]
)

#: Rules are checked against this before any of them is broadcast, so that their counted number bounds their size.
RULES = TableSpec("alert_rules", RULE_SCHEMA, max_bytes=(("label", NAME_BYTES), ("recipient", 320)))

_ARROW = {
    T.IntegerType(): pa.int32(),
    T.StringType(): pa.string(),
    T.DoubleType(): pa.float64(),
    T.TimestampNTZType(): pa.timestamp("us"),
    T.DateType(): pa.date32(),
}


def local_relation(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small literal relation. Going through Arrow gives Catalyst the exact size, so it can pick a broadcast itself."""
    table = pa.table(
        [pa.array([row[i] for row in rows], _ARROW[f.dataType]) for i, f in enumerate(schema.fields)],
        schema=pa.schema([(f.name, _ARROW[f.dataType]) for f in schema.fields]),
    )
    return spark.createDataFrame(table, schema=schema)


def coin_dimension(spark: SparkSession) -> DataFrame:
    return local_relation(spark, COINS, STG_COINS.schema)


def broker_dimension(spark: SparkSession) -> DataFrame:
    return local_relation(spark, BROKERS, STG_BROKERS.schema)


def default_rules(spark: SparkSession, recipient: str) -> DataFrame:
    return local_relation(
        spark, [(ALERT_COIN_ID, ALERT_BROKER_ID, ALERT_THRESHOLD, ALERT_LABEL, recipient)], RULE_SCHEMA
    )
