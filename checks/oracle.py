"""DuckDB SQL for the registered queries, written in another shape than the Spark side where there is one.

Merges are spelled out as UNION ALL of the kept, the updated and the inserted rows.
"""

from __future__ import annotations

RUN = "TIMESTAMP '2024-02-01 10:30:00'"
BASELINE = "TIMESTAMP '2024-01-01 00:00:00'"

EV = """
ev AS (
  SELECT event_id, ts, event_type, event_type AS cripto, 'user_' || user_id AS broker, value AS price,
         CASE WHEN value >= 5 THEN value * 0.99 END AS bid, date_trunc('second', ts) AS quoted,
         CASE WHEN ts < TIMESTAMP '2024-01-01' + to_hours(CAST(c_nationkey * 30 AS BIGINT))
              THEN 'baseline' ELSE 'poll' END AS side
  FROM events JOIN customer ON user_id = c_custkey),
ev_coins AS (SELECT * FROM (VALUES (1, 'view'), (2, 'click'), (3, 'purchase')) v(cripto_id, cripto_name)),
ev_brokers AS (
  SELECT CAST(c_custkey AS INTEGER) AS broker_id, 'user_' || c_custkey AS broker_name
  FROM customer WHERE c_acctbal >= 0),
ev_quotes AS (
  SELECT CAST(cripto_id AS INTEGER) AS cripto_id, broker_id, price AS p_compra, bid AS p_venta,
         quoted AS fecha_cotizacion, side, ts, event_id
  FROM ev, ev_coins, ev_brokers WHERE cripto = cripto_name AND broker = broker_name),
ev_picked AS (
  SELECT * FROM ev_quotes q WHERE NOT EXISTS (
    SELECT 1 FROM ev_quotes n WHERE n.cripto_id = q.cripto_id AND n.broker_id = q.broker_id AND n.side = q.side
      AND (n.ts > q.ts OR (n.ts = q.ts AND n.event_id > q.event_id))))
"""

DESK = """
coins AS (SELECT * FROM (VALUES (1, 'btc'), (2, 'eth'), (3, 'dai')) v(cripto_id, cripto_name)),
brokers AS (SELECT * FROM (VALUES (1, 'binancep2p'), (2, 'fiwind'), (3, 'letsbit'), (4, 'tiendacrypto'),
  (5, 'bitsoalpha'), (6, 'calypso'), (7, 'decrypto'), (8, 'banexcoin'), (9, 'buenbit'), (10, 'fluyez'),
  (11, 'vitawallet')) v(broker_id, broker_name)),
desk AS (
  SELECT event_id, ts, coins.cripto_id, cripto_name, brokers.broker_id, broker_name,
         value + 49950 AS p_compra, CASE WHEN value >= 5 THEN (value + 49950) * 0.99 END AS p_venta,
         date_trunc('second', ts) AS quoted,
         CASE WHEN ts < TIMESTAMP '2024-01-01' + to_hours(CAST(c_nationkey * 72 AS BIGINT))
              THEN 'baseline' ELSE 'poll' END AS side
  FROM events JOIN customer ON user_id = c_custkey
  JOIN coins ON cripto_id = CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 END
  JOIN brokers ON broker_id = c_nationkey + 1),
desk_latest AS (
  SELECT cripto_id, broker_id, p_compra, CASE WHEN p_compra < 50150 THEN CAST(quoted AS DATE) END AS fecha_cotizacion
  FROM desk
  QUALIFY row_number() OVER (PARTITION BY cripto_id, broker_id
    ORDER BY CASE WHEN p_compra < 50150 THEN CAST(quoted AS DATE) END DESC NULLS FIRST,
             p_compra DESC NULLS LAST) = 1),
desk_rules AS (
  SELECT cripto_id, broker_id, threshold, label, 'desk@example.org' AS recipient
  FROM (VALUES (1, 'Bitcoin'), (2, 'Ether'), (3, 'Dai')) c(cripto_id, label), brokers,
       (VALUES (CAST(50000.0 AS DOUBLE)), (CAST(50100.5 AS DOUBLE))) h(threshold))
"""

DESK_MESSAGES = """
  SELECT CAST(r.cripto_id AS INTEGER) AS cripto_id, CAST(r.broker_id AS INTEGER) AS broker_id, recipient,
         'Alerta: Precio de ' || label || ' superó los $' || limit_text AS subject,
         'El precio de compra actual de ' || label || ' es ' || CAST(p_compra AS VARCHAR)
           || '. ¡Supera los $' || limit_text || '!' AS body
  FROM (SELECT *, CASE WHEN threshold = 50000 THEN '50,000' ELSE '50,100.50' END AS limit_text FROM rules) r
  JOIN latest l ON l.cripto_id = r.cripto_id AND l.broker_id = r.broker_id
  WHERE p_compra > threshold
"""

LI = """
li AS (
  SELECT CAST(l_partkey AS INTEGER) AS cripto_id, CAST(l_suppkey AS INTEGER) AS broker_id, l_extendedprice AS p_compra,
         l_extendedprice * (1 - l_discount) AS p_venta, l_shipdate AS fecha_cotizacion,
         CASE WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 'baseline' ELSE 'poll' END AS side,
         l_orderkey, l_linenumber
  FROM lineitem
  WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40)
    AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20)),
li_picked AS (
  SELECT * FROM li QUALIFY row_number() OVER (PARTITION BY cripto_id, broker_id, side
    ORDER BY fecha_cotizacion DESC, l_orderkey DESC, l_linenumber DESC, p_compra DESC) = 1),
li_latest AS (
  SELECT DISTINCT ON (cripto_id, broker_id) cripto_id, broker_id, p_compra,
         CAST(fecha_cotizacion AS DATE) AS fecha_cotizacion
  FROM li ORDER BY cripto_id, broker_id, fecha_cotizacion DESC, p_compra DESC),
li_rules AS (
  SELECT CAST(l_partkey AS INTEGER) AS cripto_id, CAST(l_suppkey AS INTEGER) AS broker_id,
         CAST(50000.0 AS DOUBLE) AS threshold, 'part_' || l_partkey AS label, 'desk_' || l_suppkey AS recipient
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey, l_suppkey)
"""

LI_WIRE = """
  SELECT 'part_' || l_partkey AS cripto_name, 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS broker_name,
         l_extendedprice AS p_compra, l_extendedprice * (1 - l_discount) AS p_venta,
         epoch(l_shipdate) AS fecha_cotizacion, l_partkey, l_suppkey
  FROM lineitem
"""


def _merged(picked: str, insert_date: str) -> str:
    """The merge of the poll side of ``picked`` into its baseline side, class by class."""
    return f"""
  SELECT b.cripto_id, b.broker_id, b.p_compra, b.p_venta, CAST(b.fecha_cotizacion AS DATE) AS fecha_cotizacion
  FROM {picked} b WHERE side = 'baseline' AND NOT EXISTS (SELECT 1 FROM {picked} p
    WHERE p.side = 'poll' AND p.cripto_id = b.cripto_id AND p.broker_id = b.broker_id)
  UNION ALL
  SELECT p.cripto_id, p.broker_id, p.p_compra, p.p_venta, CAST(p.fecha_cotizacion AS DATE)
  FROM {picked} p, {picked} b
  WHERE p.side = 'poll' AND b.side = 'baseline' AND p.cripto_id = b.cripto_id AND p.broker_id = b.broker_id
  UNION ALL
  SELECT p.cripto_id, p.broker_id, p.p_compra, p.p_venta, CAST({insert_date} AS DATE)
  FROM {picked} p WHERE side = 'poll' AND NOT EXISTS (SELECT 1 FROM {picked} b
    WHERE b.side = 'baseline' AND p.cripto_id = b.cripto_id AND p.broker_id = b.broker_id)
"""


def _two_loads(picked: str) -> str:
    """The same when the baseline itself was loaded into an empty table: its rows carry the first load date."""
    date = f"CASE WHEN side = 'baseline' THEN {BASELINE} ELSE fecha_cotizacion END"
    first = f"(SELECT * REPLACE ({date} AS fecha_cotizacion) FROM {picked})"
    return _merged(first, RUN)


ORACLE: dict[str, str] = {
    "answered_polls": """
SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS poll_ts, event_type AS cripto_name, 200 AS status
FROM events JOIN customer ON user_id = c_custkey WHERE event_type <> 'error'""",
    "failed_polls": """
SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS poll_ts, event_type AS cripto_name, 500 AS status
FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'error'""",
    "decode_documents": f"""
WITH {EV}
SELECT event_id, cripto, broker, price AS ask, price AS "totalAsk", price AS bid, bid AS "totalBid",
       epoch(quoted) AS time
FROM ev WHERE event_type <> 'error'
UNION ALL
SELECT event_id, cripto, 'mirror_' || broker, NULL, price, NULL, bid, epoch(quoted) FROM ev WHERE event_type <> 'error'""",
    "rejected_brokers": """
SELECT event_id, event_type AS cripto, 'note' AS broker, '5' AS quote
FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'signup'""",
    "landed_documents": f"""
WITH {EV}
SELECT date_trunc('day', ts)::TIMESTAMP AS poll_ts, cripto, prefix || broker AS broker, price AS "totalAsk",
       bid AS "totalBid", epoch(quoted) AS time
FROM ev, (VALUES (''), ('mirror_')) p(prefix) WHERE event_type <> 'error'""",
    "document_files": f"""
WITH {EV}
SELECT date_trunc('day', ts)::TIMESTAMP AS poll_ts, cripto, broker, price AS "totalAsk", bid AS "totalBid",
       epoch(quoted) AS time
FROM ev QUALIFY row_number() OVER (PARTITION BY date_trunc('day', ts), cripto, broker ORDER BY ts DESC, event_id DESC) = 1""",
    "concat_quotes": f"""
WITH {EV}
SELECT cripto, broker, price AS "totalAsk", epoch(quoted) AS time, NULL::DOUBLE AS "totalBid", NULL::INTEGER AS line
FROM ev
UNION ALL
SELECT 'part_' || l_partkey, 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0'), NULL, NULL,
       l_extendedprice * (1 - l_discount), l_linenumber
FROM lineitem""",
    "literal_dimensions": f"""
WITH {DESK}
SELECT event_id, CAST(cripto_id AS INTEGER) AS cripto_id, cripto_name, CAST(broker_id AS INTEGER) AS broker_id,
       broker_name
FROM desk""",
    "rename_project": f"SELECT * EXCLUDE (l_partkey, l_suppkey) FROM ({LI_WIRE})",
    "lookup_coin_ev": """
SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS cripto_id,
       'user_' || user_id AS broker_name, value AS p_compra
FROM events WHERE event_type IN ('view', 'click', 'purchase') AND user_id IN (SELECT c_custkey FROM customer)""",
    "lookup_broker_ev": """
SELECT event_id, event_type AS cripto_name, CAST(user_id AS INTEGER) AS broker_id
FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    "lookup_coin_li": f"""
SELECT CAST(l_partkey AS INTEGER) AS cripto_id, broker_name, p_compra
FROM ({LI_WIRE}) WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40)""",
    "lookup_broker_li": f"""
SELECT cripto_name, CAST(l_suppkey AS INTEGER) AS broker_id, p_venta
FROM ({LI_WIRE}) WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20)""",
    "epoch_times": """
SELECT event_id, date_trunc('second', ts) AS whole_seconds, ts AS exact,
       CASE WHEN value >= 5 THEN date_trunc('second', ts) END AS maybe
FROM events JOIN customer ON user_id = c_custkey""",
    "distinct_quotes": f"""
WITH {EV}
SELECT cripto_id, broker_id, p_compra, p_venta, fecha_cotizacion FROM ev_quotes GROUP BY ALL""",
    "normalize_ev": f"""
WITH {EV}
SELECT DISTINCT cripto_id, broker_id, p_compra, p_venta, fecha_cotizacion FROM ev_quotes""",
    "normalize_li": f"""
WITH {LI}
SELECT DISTINCT cripto_id, broker_id, p_compra, p_venta, fecha_cotizacion FROM li""",
    "staging_replace": f"""
WITH {EV}
SELECT cripto_id, broker_id, p_compra, p_venta, fecha_cotizacion FROM ev_picked WHERE side = 'poll'""",
    "staging_append": f"""
WITH {EV}
SELECT cripto_id, broker_id, p_compra, p_venta, fecha_cotizacion FROM ev_picked""",
    "staging_truncate": f"""
WITH {EV}
SELECT cripto_id, broker_id, p_compra, p_venta, fecha_cotizacion FROM ev_picked WHERE side = 'poll'""",
    "load_fail": f"""
WITH {EV}
SELECT cripto_id, broker_id, p_compra, p_venta, fecha_cotizacion FROM ev_picked WHERE side = 'baseline'""",
    "constraint_violations": """
WITH ev AS (SELECT event_type, value FROM events JOIN customer ON user_id = c_custkey)
SELECT 'stg_cotizaciones' AS table_name, 'cripto_id is NULL' AS violation, 0 AS n
UNION ALL SELECT 'stg_cotizaciones', 'broker_id is NULL', count(*) FROM ev WHERE event_type = 'error'
UNION ALL SELECT 'stg_cotizaciones', 'p_compra is NULL', count(*) FROM ev WHERE value < 5 OR event_type = 'view'
UNION ALL SELECT 'stg_brokers', 'broker_id is NULL', count(*) FROM documents WHERE doc_id IS NULL
UNION ALL SELECT 'stg_brokers', 'broker_name longer than 100 bytes', count(*) FROM documents WHERE strlen(text) > 100""",
    "merge_quotes_ev": f"WITH {EV} {_merged('ev_picked', RUN)}",
    "merge_quotes_li": f"WITH {LI} {_merged('li_picked', RUN)}",
    "merge_quotes_li_shuffled": f"WITH {LI} {_merged('li_picked', RUN)}",
    "committed_quotes_li": f"WITH {LI} {_two_loads('li_picked')}",
    "committed_quotes_li_shuffled": f"WITH {LI} {_two_loads('li_picked')}",
    "merge_coins_part": f"""
SELECT CAST(p_partkey AS INTEGER) AS cripto_id, p_name AS cripto_name, {BASELINE} AS fecha_carga
FROM part WHERE p_size <= 10
UNION ALL SELECT CAST(p_partkey AS INTEGER), p_type, {RUN} FROM part WHERE p_size > 10 AND p_size <= 40
UNION ALL SELECT CAST(p_partkey AS INTEGER), p_type, {RUN} FROM part WHERE p_size > 40""",
    "merge_brokers_supplier": f"""
SELECT CAST(s_suppkey AS INTEGER) AS broker_id, s_name AS broker_name, {BASELINE} AS fecha_carga
FROM supplier WHERE s_nationkey < 6
UNION ALL SELECT CAST(s_suppkey AS INTEGER), 'venue ' || s_name, {RUN} FROM supplier
  WHERE s_nationkey >= 6 AND s_nationkey < 18
UNION ALL SELECT CAST(s_suppkey AS INTEGER), 'venue ' || s_name, {RUN} FROM supplier WHERE s_nationkey >= 18""",
    "table_layout": f"""
WITH {EV},
contract AS (SELECT * FROM (VALUES
  ('stg_brokers', 1, 'broker_id', 'int', 'yes'), ('stg_brokers', 2, 'broker_name', 'varchar(100)', 'no'),
  ('stg_criptomonedas', 1, 'cripto_id', 'int', 'yes'), ('stg_criptomonedas', 2, 'cripto_name', 'varchar(100)', 'no'),
  ('stg_cotizaciones', 1, 'cripto_id', 'int', 'yes'), ('stg_cotizaciones', 2, 'broker_id', 'int', 'yes'),
  ('stg_cotizaciones', 3, 'p_compra', 'double', 'yes'), ('stg_cotizaciones', 4, 'p_venta', 'double', 'no'),
  ('stg_cotizaciones', 5, 'fecha_cotizacion', 'timestamp_ntz', 'no'),
  ('brokers', 1, 'broker_id', 'int', 'no'), ('brokers', 2, 'broker_name', 'varchar(100)', 'no'),
  ('brokers', 3, 'fecha_carga', 'timestamp_ntz', 'no'),
  ('criptomonedas', 1, 'cripto_id', 'int', 'no'), ('criptomonedas', 2, 'cripto_name', 'varchar(100)', 'no'),
  ('criptomonedas', 3, 'fecha_carga', 'timestamp_ntz', 'no'),
  ('cotizaciones', 1, 'cripto_id', 'int', 'no'), ('cotizaciones', 2, 'broker_id', 'int', 'no'),
  ('cotizaciones', 3, 'p_compra', 'double', 'no'), ('cotizaciones', 4, 'p_venta', 'double', 'no'),
  ('cotizaciones', 5, 'fecha_cotizacion', 'date', 'no')) v(table_name, position, column_name, data_type, not_null)),
layout AS (SELECT * FROM (VALUES
  ('stg_brokers', 'all', '', 'broker_id'), ('stg_criptomonedas', 'all', '', 'cripto_id'),
  ('stg_cotizaciones', 'even', '', 'fecha_cotizacion'), ('brokers', 'all', '', 'broker_id'),
  ('criptomonedas', 'all', '', 'cripto_id'),
  ('cotizaciones', 'key', 'cripto_id,broker_id', 'fecha_cotizacion')) v(table_name, distribution, bucket_columns, sort_columns))
SELECT CAST(position AS INTEGER) AS position, contract.* EXCLUDE (position), CASE
    WHEN table_name LIKE '%brokers' THEN (SELECT count(*) FROM customer WHERE c_acctbal >= 0)
    WHEN table_name LIKE '%criptomonedas' THEN (SELECT count(*) FROM part WHERE p_size <= 40)
    ELSE (SELECT count(*) FROM ev_picked WHERE side = 'poll') END AS n_rows, distribution, bucket_columns, sort_columns
FROM contract JOIN layout USING (table_name)""",
    "latest_price_one": f"""
WITH {DESK}
SELECT p_compra FROM desk WHERE cripto_id = 1 AND broker_id = 1
ORDER BY CASE WHEN p_compra < 50150 THEN CAST(quoted AS DATE) END DESC NULLS FIRST, p_compra DESC NULLS LAST
LIMIT 1""",
    "latest_price_per_pair": f"WITH {LI} SELECT * FROM li_latest",
    "latest_price_hot_pairs": f"""
WITH {DESK}
SELECT CAST(cripto_id AS INTEGER) AS cripto_id, CAST(broker_id AS INTEGER) AS broker_id, p_compra, fecha_cotizacion
FROM desk_latest""",
    "alerts_li": f"""
WITH {LI}
SELECT r.cripto_id, r.broker_id, threshold, recipient, p_compra
FROM li_rules r JOIN li_latest l ON l.cripto_id = r.cripto_id AND l.broker_id = r.broker_id
WHERE p_compra > threshold""",
    "alert_messages_li": f"""
WITH {LI}, rules AS (SELECT * FROM li_rules), latest AS (SELECT * FROM li_latest) {DESK_MESSAGES}""",
    "alert_messages_desk": f"""
WITH {DESK}, rules AS (SELECT * FROM desk_rules), latest AS (SELECT * FROM desk_latest) {DESK_MESSAGES}""",
}

ORACLE["alert_messages_small"] = f"""
WITH {LI}, latest AS (
  SELECT DISTINCT ON (cripto_id, broker_id) cripto_id, broker_id, floor(p_compra) / 1e8 AS p_compra
  FROM li ORDER BY cripto_id, broker_id, CAST(fecha_cotizacion AS DATE) DESC, p_compra DESC)
SELECT r.cripto_id, r.broker_id, recipient, 'Alerta: Precio de ' || label || ' superó los $0.00025' AS subject,
       'El precio de compra actual de ' || label || ' es '
         || regexp_replace(printf('%.8f', p_compra), '0+$', '') || '. ¡Supera los $0.00025!' AS body
FROM li_rules r JOIN latest l ON l.cripto_id = r.cripto_id AND l.broker_id = r.broker_id
WHERE p_compra > 0.00025"""

LI_LOADED = f"""{LI},
loaded AS ({_two_loads("li_picked")}),
coins AS (SELECT CAST(p_partkey AS INTEGER) AS cripto_id, 'part_' || p_partkey AS cripto_name FROM part WHERE p_size <= 40),
brokers AS (SELECT CAST(s_suppkey AS INTEGER) AS broker_id, s_name AS broker_name FROM supplier WHERE s_nationkey < 20)
"""

ORACLE["daily_load"] = f"""
WITH {LI_LOADED}
SELECT loaded.*, cripto_name, broker_name, {RUN} AS coin_loaded, {RUN} AS broker_loaded
FROM loaded JOIN coins ON coins.cripto_id = loaded.cripto_id JOIN brokers ON brokers.broker_id = loaded.broker_id"""

ORACLE["daily_load_messages"] = f"""
WITH {LI_LOADED}, latest AS (SELECT * FROM loaded), rules AS (SELECT * FROM li_rules) {DESK_MESSAGES}"""

ORACLE["quiet_poll"] = f"""
WITH {LI}
SELECT cripto_id, broker_id, p_compra, p_venta, CAST({BASELINE} AS DATE) AS fecha_cotizacion
FROM li_picked WHERE side = 'baseline'"""

ORACLE["latest_price_committed"] = f"""
WITH {LI_LOADED}
SELECT p_compra FROM loaded WHERE (cripto_id, broker_id) = (
  SELECT (cripto_id, broker_id) FROM li_picked WHERE side = 'poll' ORDER BY cripto_id, broker_id LIMIT 1)"""

ORACLE["warehouse_sql"] = f"""
WITH {LI_LOADED}
SELECT cripto_name, broker_name, p_compra, fecha_cotizacion
FROM loaded JOIN coins ON coins.cripto_id = loaded.cripto_id JOIN brokers ON brokers.broker_id = loaded.broker_id
WHERE p_compra > 50000 AND fecha_cotizacion >= DATE '2000-06-15'"""

ORACLE["stream_load"] = f"""
WITH {LI},
polls AS (
  SELECT *, date_trunc('quarter', fecha_cotizacion) AS quarter FROM li
  QUALIFY row_number() OVER (PARTITION BY cripto_id, broker_id, date_trunc('quarter', fecha_cotizacion)
    ORDER BY fecha_cotizacion DESC, l_orderkey DESC, l_linenumber DESC, p_compra DESC) = 1)
SELECT cripto_id, broker_id, last(p_compra ORDER BY quarter) AS p_compra, last(p_venta ORDER BY quarter) AS p_venta,
       CASE WHEN count(*) > 1 THEN CAST(max(fecha_cotizacion) AS DATE)
            ELSE CAST(max(quarter) + INTERVAL 3 MONTH AS DATE) END AS fecha_cotizacion
FROM polls GROUP BY cripto_id, broker_id"""

# The same quotes, without the detour over documents; here the dearest keep their date.
ORACLE["documents_to_alerts"] = f"""
WITH {DESK}, rules AS (SELECT * FROM desk_rules),
latest AS (
  SELECT cripto_id, broker_id, p_compra FROM desk
  QUALIFY row_number() OVER (PARTITION BY cripto_id, broker_id
    ORDER BY CAST(quoted AS DATE) DESC, p_compra DESC) = 1) {DESK_MESSAGES}"""

ORACLE["latest_price_bucketed"] = ORACLE["latest_price_per_pair"]
ORACLE["latest_price_one_bucket"] = f"""
WITH {LI}
SELECT p_compra FROM li_latest ORDER BY cripto_id, broker_id LIMIT 1"""

# late polls change the order of the work, not the table
ORACLE["stream_load_late"] = ORACLE["stream_load"]
