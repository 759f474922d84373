"""Chain tables derived from the star-schema test tables, as one SQL text for Spark and for oracle engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainframe.sources.blocks import BUCKET

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: name -> SQL; ``{x}`` names another view or a base table.
VIEWS: dict[str, str] = {
    "tx": """
SELECT o_custkey % 5 + 1 AS chain_id, CAST(floor(o_orderkey / 40.0) AS BIGINT) AS block_number,
       CAST(row_number() OVER (PARTITION BY o_custkey % 5 + 1, CAST(floor(o_orderkey / 40.0) AS BIGINT) ORDER BY o_orderkey) - 1 AS BIGINT) AS transaction_index,
       '0x' || md5('tx' || CAST(o_orderkey AS STRING)) AS tx_hash, o_orderkey AS order_key,
       '0x' || lpad(lower(hex(o_custkey)), 40, '0') AS from_address,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '0x' || lpad(lower(hex(o_orderkey % 97)), 40, '0') END AS to_address,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 1 ELSE 0 END AS status, CAST(o_orderkey % 5 AS INT) AS tx_type,
       CAST(round(o_totalprice * 100) AS BIGINT) AS value_units,
       '0x' || lower(hex(CAST(round(o_totalprice * 100) AS BIGINT))) AS value_hex
FROM {orders}""",
    "blocks": """
SELECT chain_id, block_number,
       '0x' || md5(concat('b', CAST(chain_id AS STRING), '-', CAST(block_number AS STRING))) AS block_hash,
       '0x' || md5(concat('b', CAST(chain_id AS STRING), '-', CAST(block_number - 1 AS STRING))) AS parent_hash,
       1700000000 + block_number * 12 AS block_ts, count(*) AS tx_count
FROM {tx} GROUP BY chain_id, block_number""",
    "logs": """
SELECT t.chain_id, t.block_number, t.transaction_index, t.tx_hash,
       CAST(row_number() OVER (PARTITION BY t.chain_id, t.block_number
            ORDER BY t.transaction_index, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS BIGINT) AS log_index,
       '0x' || lpad(lower(hex(l_suppkey)), 40, '0') AS address,
       '0x' || md5(concat(l_returnflag, l_linestatus)) || md5(concat(l_linestatus, l_returnflag)) AS topic0,
       '0x' || lpad(lower(hex(l_partkey)), 64, '0') AS topic1, '0x' || lpad(lower(hex(l_suppkey)), 64, '0') AS topic2,
       CASE WHEN l_linenumber < 5 THEN '0x' || lpad(lower(hex(l_linenumber)), 64, '0') END AS topic3,
       '0x' || lpad(lower(hex(CAST(l_quantity AS BIGINT))), 64, '0')
            || lpad(lower(hex(CAST(round(l_extendedprice * 100) AS BIGINT))), 64, '0') AS data,
       concat(l_returnflag, l_linestatus) AS event_code, l_suppkey AS supp_key, l_linenumber AS line_no
FROM {lineitem} JOIN {tx} t ON l_orderkey = t.order_key""",
    "frames": """
SELECT chain_id, block_number, transaction_index, log_index,
       CAST(dense_rank() OVER (PARTITION BY chain_id, block_number, transaction_index ORDER BY line_no) - 1 AS INT) AS p0,
       CAST(row_number() OVER (PARTITION BY chain_id, block_number, transaction_index, line_no ORDER BY log_index) - 2 AS INT) AS p1,
       CASE WHEN event_code IN ('RF', 'RO') AND log_index % 3 = 0 THEN 'reverted' END AS own_error, address
FROM {logs}""",
    "creations": """
SELECT chain_id, address AS child, min(block_number) AS created_block
FROM {logs} WHERE event_code = 'RF' AND line_no = 1 GROUP BY chain_id, address""",
    "deliveries": """
SELECT * FROM (
  SELECT (event_id+1)*10+5 AS seq, event_id+1 AS number, md5(concat('c', CAST(event_id+1 AS STRING))) AS hash,
         md5(concat('c', CAST(event_id AS STRING))) AS parent_hash FROM {events}
  UNION ALL SELECT (event_id+1)*10+6, event_id+1, md5(concat('c', CAST(event_id+1 AS STRING))),
         md5(concat('c', CAST(event_id AS STRING))) FROM {events} WHERE (event_id+1) % 40 = 0
  UNION ALL SELECT (event_id+1)*10+1, event_id+1, md5(concat('o', CAST(event_id+1 AS STRING))),
         md5(concat('c', CAST(event_id AS STRING))) FROM {events} WHERE (event_id+1) % 50 = 0
  UNION ALL SELECT (event_id+1)*10+2, event_id+2, md5(concat('o', CAST(event_id+2 AS STRING))),
         md5(concat('o', CAST(event_id+1 AS STRING))) FROM {events} WHERE (event_id+1) % 250 = 0) d""",
    "intervals": "SELECT user_id AS fragment_id, event_id AS lo, event_id + 1 + event_id % 200 AS hi FROM {events}",
    "receipts": """
SELECT chain_id, block_number, transaction_index, tx_hash, status, value_units % 500000 AS gas_used,
       CASE WHEN to_address IS NULL THEN '0x' || upper(substring(md5(tx_hash), 1, 40)) END AS contract_address FROM {tx}""",
    "headers": """
SELECT chain_id, block_number, block_hash, parent_hash, block_ts, tx_count,
       block_number % 1000 + tx_count AS size, CASE WHEN block_number % 3 = 0 THEN NULL ELSE block_number % 77 END AS base_fee FROM {blocks}""",
    # a call tree's frames with their roots; the path of a root is empty (depth 0)
    "calls": """
SELECT chain_id, block_number, transaction_index, 0 AS depth, -1 AS p0, -1 AS p1, CAST(NULL AS STRING) AS own_error, from_address AS sender,
       to_address AS address, 1000000 - order_key % 1000 AS gas, value_hex, order_key AS frame_key FROM {tx}
UNION ALL
SELECT f.chain_id, f.block_number, f.transaction_index, CASE WHEN p1 = -1 THEN 1 ELSE 2 END, p0, p1, own_error, t.from_address,
       f.address, 5000 + log_index, CASE WHEN log_index % 4 = 0 THEN '0x0' ELSE '0x' || lower(hex(log_index)) END, 1000000000 + log_index
FROM {frames} f JOIN {tx} t ON f.chain_id = t.chain_id AND f.block_number = t.block_number AND f.transaction_index = t.transaction_index""",
    "log_filters": """
SELECT * FROM (
  SELECT 1 AS filter_id, 1 AS chain_id, CAST(NULL AS STRING) AS address, '0x' || md5('RF') || md5('FR') AS topic0, CAST(NULL AS STRING) AS topic1, CAST(NULL AS BIGINT) AS from_block, CAST(NULL AS BIGINT) AS to_block
  UNION ALL SELECT 2, 2, '0x' || lpad(lower(hex(7)), 40, '0'), NULL, NULL, 10, 200
  UNION ALL SELECT 3, 3, '0x' || lpad(lower(hex(11)), 40, '0'), '0x' || md5('NO') || md5('ON'), NULL, NULL, 300
  UNION ALL SELECT 4, 4, NULL, '0x' || md5('AF') || md5('FA'), '0x' || lpad(lower(hex(5)), 64, '0'), NULL, NULL
  UNION ALL SELECT 5, 5, NULL, NULL, NULL, 50, 60
  UNION ALL SELECT 6, 1, '0x' || lpad(lower(hex(3)), 40, '0'), NULL, NULL, 5, NULL) x""",
    "tx_filters": """
SELECT * FROM (
  SELECT 1 AS filter_id, 1 AS chain_id, CAST(NULL AS STRING) AS from_address, '0x' || lpad(lower(hex(13)), 40, '0') AS to_address, CAST(NULL AS BIGINT) AS from_block, CAST(NULL AS BIGINT) AS to_block, FALSE AS include_reverted
  UNION ALL SELECT 2, 2, '0x' || lpad(lower(hex(11)), 40, '0'), NULL, NULL, 500, TRUE
  UNION ALL SELECT 3, 3, NULL, '0x' || lpad(lower(hex(20)), 40, '0'), 100, NULL, TRUE
  UNION ALL SELECT 4, 4, NULL, NULL, NULL, NULL, TRUE) x""",
    "heads": """
SELECT chain_id, max(block_number) - 10 * chain_id AS finalized,
       CASE WHEN chain_id = 5 THEN NULL ELSE max(block_number) - 5 * (chain_id - 1) END AS end_block FROM {tx} GROUP BY chain_id""",
    "signatures": """
SELECT '0x' || md5(code) || md5(concat(substring(code, 2, 1), substring(code, 1, 1))) AS topic0, code, name FROM (
  SELECT 'RF' AS code, 'Created' AS name UNION ALL SELECT 'RO', 'Deposit' UNION ALL SELECT 'NO', 'Withdraw'
  UNION ALL SELECT 'NF', 'Borrow' UNION ALL SELECT 'AF', 'Repay' UNION ALL SELECT 'AO', 'Liquidate') s""",
    "store_a": """
SELECT chain_id, block_number, transaction_index, tx_hash, from_address, to_address, value_units, order_key,
       CASE WHEN tx_type IN (1, 2, 3, 4) AND order_key % 7 <> 0 THEN 'l' || CAST(order_key % 11 AS STRING) END AS access_list FROM {tx}
WHERE order_key % 83 <> 0""",
    "store_b": """
SELECT chain_id, block_number, transaction_index, tx_hash, from_address, to_address,
       CASE WHEN order_key % 89 = 0 THEN value_units + 1 ELSE value_units END AS value_units, order_key,
       CASE WHEN order_key % 71 = 0 THEN NULL WHEN tx_type IN (1, 2, 3, 4) AND order_key % 7 <> 0 THEN 'l' || CAST(order_key % 11 AS STRING) END AS access_list FROM {tx}
WHERE order_key % 97 <> 0""",
    "blocks_b": """
SELECT chain_id, block_number, block_hash, parent_hash, block_ts, tx_count, CASE WHEN block_number % 13 = 0 THEN size + 7 ELSE size END AS size,
       CASE WHEN block_number % 6 = 0 THEN 0 WHEN block_number % 61 = 0 AND base_fee IS NOT NULL THEN base_fee + 1 ELSE base_fee END AS base_fee
FROM {headers} WHERE block_number % 43 <> 0""",
    "requests": """
SELECT user_id % 5 + 1 AS chain_id, event_id AS at_s, value AS latency, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS ok,
       CAST(round(value * 100) AS BIGINT) AS bytes, CASE WHEN user_id % 2 = 0 THEN 'range' ELSE 'rpc' END AS endpoint FROM {events}""",
    "progress": """
SELECT CAST(floor(event_id / 100.0) AS BIGINT) AS run, user_id % 2 AS leg, max(event_id) AS max_block
FROM {events} GROUP BY CAST(floor(event_id / 100.0) AS BIGINT), user_id % 2""",
    # filters with lists and factories: of logs, and of transactions and frames by their sides
    "topic_filters": """
SELECT filter_id, chain_id, split(address, ',') AS address, address_factory, split(topic0, ',') AS topic0, split(topic1, ',') AS topic1, split(topic2, ',') AS topic2, split(topic3, ',') AS topic3, from_block, to_block
FROM (
  SELECT 1 AS filter_id, 1 AS chain_id, CAST(NULL AS STRING) AS address, CAST(NULL AS STRING) AS address_factory, '0x' || md5('RF') || md5('FR') || ',' || '0x' || md5('NO') || md5('ON') AS topic0, CAST(NULL AS STRING) AS topic1, CAST(NULL AS STRING) AS topic2, CAST(NULL AS STRING) AS topic3, CAST(NULL AS BIGINT) AS from_block, CAST(NULL AS BIGINT) AS to_block
  UNION ALL SELECT 2, 2, '0x' || lpad(lower(hex(7)), 40, '0') || ',' || '0x' || lpad(lower(hex(9)), 40, '0') || ',' || '0x' || lpad(lower(hex(12)), 40, '0'), NULL, NULL, NULL, NULL, '0x' || lpad(lower(hex(1)), 64, '0') || ',' || '0x' || lpad(lower(hex(3)), 64, '0'), 10, 200
  UNION ALL SELECT 3, 3, '0x' || lpad(lower(hex(11)), 40, '0'), NULL, '0x' || md5('NO') || md5('ON'), NULL, NULL, NULL, NULL, 300
  UNION ALL SELECT 4, 4, NULL, NULL, '0x' || md5('AF') || md5('FA'), '0x' || lpad(lower(hex(5)), 64, '0') || ',' || '0x' || lpad(lower(hex(6)), 64, '0') || ',' || '0x' || lpad(lower(hex(7)), 64, '0') || ',' || '0x' || lpad(lower(hex(8)), 64, '0') || ',' || '0x' || lpad(lower(hex(9)), 64, '0'), NULL, NULL, NULL, NULL
  UNION ALL SELECT 5, 5, NULL, NULL, NULL, NULL, NULL, NULL, 50, 60
  UNION ALL SELECT 6, 1, NULL, 'main-1', '0x' || md5('NF') || md5('FN') || ',' || '0x' || md5('AO') || md5('OA'), NULL, NULL, NULL, 20, NULL
  UNION ALL SELECT 7, 2, NULL, 'side-2', NULL, NULL, NULL, '0x' || lpad(lower(hex(1)), 64, '0') || ',' || '0x' || lpad(lower(hex(2)), 64, '0') || ',' || '0x' || lpad(lower(hex(3)), 64, '0'), NULL, NULL
  UNION ALL SELECT 8, 3, NULL, 'main-3', NULL, NULL, '0x' || lpad(lower(hex(3)), 64, '0') || ',' || '0x' || lpad(lower(hex(4)), 64, '0') || ',' || '0x' || lpad(lower(hex(5)), 64, '0') || ',' || '0x' || lpad(lower(hex(6)), 64, '0') || ',' || '0x' || lpad(lower(hex(7)), 64, '0') || ',' || '0x' || lpad(lower(hex(8)), 64, '0'), NULL, NULL, 900
  UNION ALL SELECT 9, 4, NULL, 'side-4', NULL, NULL, NULL, NULL, NULL, NULL
  UNION ALL SELECT 10, 2, NULL, NULL, NULL, '0x' || lpad(lower(hex(1)), 64, '0') || ',' || '0x' || lpad(lower(hex(2)), 64, '0') || ',' || '0x' || lpad(lower(hex(3)), 64, '0') || ',' || '0x' || lpad(lower(hex(4)), 64, '0'), NULL, NULL, 5, NULL) x""",
    "side_filters": """
SELECT filter_id, chain_id, split(from_address, ',') AS from_address, from_address_factory, split(to_address, ',') AS to_address, to_address_factory, split(selector, ',') AS selector, split(call_type, ',') AS call_type,
       from_block, to_block, include_reverted
FROM (
  SELECT 1 AS filter_id, 1 AS chain_id, CAST(NULL AS STRING) AS from_address, CAST(NULL AS STRING) AS from_address_factory, '0x' || lpad(lower(hex(13)), 40, '0') || ',' || '0x' || lpad(lower(hex(14)), 40, '0') AS to_address, CAST(NULL AS STRING) AS to_address_factory, CAST(NULL AS STRING) AS selector, CAST(NULL AS STRING) AS call_type, CAST(NULL AS BIGINT) AS from_block, CAST(NULL AS BIGINT) AS to_block, FALSE AS include_reverted
  UNION ALL SELECT 2, 2, '0x' || lpad(lower(hex(11)), 40, '0') || ',' || '0x' || lpad(lower(hex(12)), 40, '0'), NULL, NULL, NULL, '0x00000001,0x00000002', NULL, NULL, 500, TRUE
  UNION ALL SELECT 3, 3, NULL, NULL, '0x' || lpad(lower(hex(20)), 40, '0'), NULL, NULL, 'call', 100, NULL, TRUE
  UNION ALL SELECT 4, 4, NULL, NULL, NULL, NULL, NULL, 'CALL,staticcall', NULL, NULL, FALSE
  UNION ALL SELECT 5, 5, NULL, NULL, NULL, 'main-5', NULL, NULL, NULL, NULL, TRUE
  UNION ALL SELECT 6, 1, NULL, 'main-1', '0x' || lpad(lower(hex(20)), 40, '0') || ',' || '0x' || lpad(lower(hex(21)), 40, '0') || ',' || '0x' || lpad(lower(hex(22)), 40, '0') || ',' || '0x' || lpad(lower(hex(23)), 40, '0') || ',' || '0x' || lpad(lower(hex(24)), 40, '0') || ',' || '0x' || lpad(lower(hex(25)), 40, '0') || ',' || '0x' || lpad(lower(hex(26)), 40, '0') || ',' || '0x' || lpad(lower(hex(27)), 40, '0') || ',' || '0x' || lpad(lower(hex(28)), 40, '0') || ',' || '0x' || lpad(lower(hex(29)), 40, '0'), NULL, NULL, NULL, NULL, NULL, TRUE
  UNION ALL SELECT 7, 2, '0x' || lpad(lower(hex(1)), 40, '0') || ',' || '0x' || lpad(lower(hex(2)), 40, '0') || ',' || '0x' || lpad(lower(hex(3)), 40, '0') || ',' || '0x' || lpad(lower(hex(4)), 40, '0') || ',' || '0x' || lpad(lower(hex(5)), 40, '0') || ',' || '0x' || lpad(lower(hex(6)), 40, '0') || ',' || '0x' || lpad(lower(hex(7)), 40, '0') || ',' || '0x' || lpad(lower(hex(8)), 40, '0'), NULL, NULL, 'main-2', NULL, NULL, 3, NULL, TRUE
  UNION ALL SELECT 8, 3, '0x' || lpad(lower(hex(30)), 40, '0') || ',' || '0x' || lpad(lower(hex(31)), 40, '0') || ',' || '0x' || lpad(lower(hex(32)), 40, '0') || ',' || '0x' || lpad(lower(hex(33)), 40, '0') || ',' || '0x' || lpad(lower(hex(34)), 40, '0') || ',' || '0x' || lpad(lower(hex(35)), 40, '0') || ',' || '0x' || lpad(lower(hex(36)), 40, '0') || ',' || '0x' || lpad(lower(hex(37)), 40, '0') || ',' || '0x' || lpad(lower(hex(38)), 40, '0') || ',' || '0x' || lpad(lower(hex(39)), 40, '0'), NULL, '0x' || lpad(lower(hex(1)), 40, '0') || ',' || '0x' || lpad(lower(hex(2)), 40, '0') || ',' || '0x' || lpad(lower(hex(3)), 40, '0') || ',' || '0x' || lpad(lower(hex(4)), 40, '0') || ',' || '0x' || lpad(lower(hex(5)), 40, '0') || ',' || '0x' || lpad(lower(hex(6)), 40, '0') || ',' || '0x' || lpad(lower(hex(7)), 40, '0') || ',' || '0x' || lpad(lower(hex(8)), 40, '0') || ',' || '0x' || lpad(lower(hex(9)), 40, '0') || ',' || '0x' || lpad(lower(hex(10)), 40, '0') || ',' || '0x' || lpad(lower(hex(11)), 40, '0') || ',' || '0x' || lpad(lower(hex(12)), 40, '0') || ',' || '0x' || lpad(lower(hex(13)), 40, '0') || ',' || '0x' || lpad(lower(hex(14)), 40, '0') || ',' || '0x' || lpad(lower(hex(15)), 40, '0') || ',' || '0x' || lpad(lower(hex(16)), 40, '0') || ',' || '0x' || lpad(lower(hex(17)), 40, '0') || ',' || '0x' || lpad(lower(hex(18)), 40, '0') || ',' || '0x' || lpad(lower(hex(19)), 40, '0') || ',' || '0x' || lpad(lower(hex(20)), 40, '0') || ',' || '0x' || lpad(lower(hex(21)), 40, '0') || ',' || '0x' || lpad(lower(hex(22)), 40, '0') || ',' || '0x' || lpad(lower(hex(23)), 40, '0') || ',' || '0x' || lpad(lower(hex(24)), 40, '0') || ',' || '0x' || lpad(lower(hex(25)), 40, '0') || ',' || '0x' || lpad(lower(hex(26)), 40, '0') || ',' || '0x' || lpad(lower(hex(27)), 40, '0') || ',' || '0x' || lpad(lower(hex(28)), 40, '0') || ',' || '0x' || lpad(lower(hex(29)), 40, '0'), NULL, NULL, NULL, NULL, NULL, TRUE
  UNION ALL SELECT 9, 3, NULL, 'main-3', NULL, 'main-3', NULL, NULL, NULL, NULL, FALSE) x""",
    # two factories on a chain, whose children stand at different places of their logs
    "factory_rows": """
SELECT concat('main-', CAST(chain_id AS STRING)) AS factory_id, chain_id, CAST(NULL AS STRING) AS address, '0x' || md5('RF') || md5('FR') AS topic0, 5 AS from_block, finalized AS to_block, 'topic2' AS location FROM {heads}
UNION ALL SELECT concat('side-', CAST(chain_id AS STRING)), chain_id, NULL, '0x' || md5('AF') || md5('FA'), NULL, NULL, 'offset0' FROM {heads} WHERE chain_id <= 3""",
    "factory_children": """
SELECT factory_id, chain_id, child, min(block_number) AS created_block FROM (
  SELECT f.factory_id, l.chain_id, l.block_number, CASE f.location WHEN 'topic2' THEN '0x' || substring(l.topic2, 27, 40) ELSE '0x' || substring(l.data, 27, 40) END AS child
  FROM {logs} l JOIN {factory_rows} f ON f.chain_id = l.chain_id AND f.topic0 = l.topic0 AND l.block_number >= coalesce(f.from_block, 0) AND (f.to_block IS NULL OR l.block_number <= f.to_block)) c
GROUP BY factory_id, chain_id, child""",
    # two legs' newest times by run, in four series that begin at different places of a cycle of 48 runs: near, one frozen,
    # drawing apart, catching up, both frozen, one empty, both empty
    "legs": """
SELECT series, run, at_s, CASE WHEN k IN (0, 33, 34) OR k BETWEEN 36 AND 41 THEN NULL WHEN k BETWEEN 14 AND 17 THEN base + 1400 WHEN k BETWEEN 44 AND 46 THEN base + 4300 ELSE at_s + run % 7 END AS a,
       CASE WHEN k BETWEEN 25 AND 28 OR k IN (0, 33, 34) THEN NULL WHEN k BETWEEN 6 AND 9 THEN base + 500 WHEN k BETWEEN 10 AND 11 THEN at_s - 300 WHEN k BETWEEN 14 AND 17 THEN base + 1000
            WHEN k BETWEEN 18 AND 20 THEN at_s - 400 WHEN k BETWEEN 21 AND 23 THEN at_s - 400 - (k - 20) * 30 WHEN k = 24 THEN at_s - 330 WHEN k BETWEEN 43 AND 46 THEN at_s - 350 - (k - 43) * 100 ELSE at_s + run % 5 END AS b
FROM (SELECT 's' || CAST(shift AS STRING) AS series, run, run * 100 AS at_s, (run + shift) % 48 AS k, (run - (run + shift) % 48) * 100 AS base
      FROM (SELECT DISTINCT CAST(floor(event_id / 100.0) AS BIGINT) AS run FROM {events}) r CROSS JOIN (SELECT 0 AS shift UNION ALL SELECT 13 UNION ALL SELECT 24 UNION ALL SELECT 37) q) z""",
}

#: Views that Spark makes by plans of its own, with the rows of VIEWS: rows are dealt once by their block, so that both
#: windows and the join keep that partitioning, and texts are made of numbers when nothing is shuffled or sorted any more.
PLANS: dict[str, str] = {
    "tx_keyed": """
SELECT o_custkey % 5 + 1 AS chain_id, CAST(floor(o_orderkey / 40.0) AS BIGINT) AS block_number, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {orders}""",
    "tx_placed": "SELECT *, CAST(row_number() OVER (PARTITION BY chain_id, block_number ORDER BY o_orderkey) - 1 AS BIGINT) AS transaction_index FROM {tx_keyed}",
    "tx": """
SELECT chain_id, block_number, transaction_index, '0x' || md5('tx' || CAST(o_orderkey AS STRING)) AS tx_hash, o_orderkey AS order_key,
       '0x' || lpad(lower(hex(o_custkey)), 40, '0') AS from_address,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '0x' || lpad(lower(hex(o_orderkey % 97)), 40, '0') END AS to_address,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 1 ELSE 0 END AS status, CAST(o_orderkey % 5 AS INT) AS tx_type,
       CAST(round(o_totalprice * 100) AS BIGINT) AS value_units,
       '0x' || lower(hex(CAST(round(o_totalprice * 100) AS BIGINT))) AS value_hex
FROM {tx_placed}""",
    # the join's one key is the block, by which both sides are dealt; a block has 40 orders at most
    "logs_placed": """
SELECT *, CAST(row_number() OVER (PARTITION BY chain_id, block_number ORDER BY transaction_index, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS BIGINT) AS log_index FROM (
  SELECT t.chain_id, t.block_number, t.transaction_index, t.o_orderkey, t.o_custkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus
  FROM {lineitem_by_block} JOIN {tx_by_block} t ON l_block = t.block_number AND l_orderkey - t.o_orderkey = 0) j""",
    "logs": """
SELECT chain_id, block_number, transaction_index, '0x' || md5('tx' || CAST(o_orderkey AS STRING)) AS tx_hash, log_index,
       '0x' || lpad(lower(hex(l_suppkey)), 40, '0') AS address,
       '0x' || md5(concat(l_returnflag, l_linestatus)) || md5(concat(l_linestatus, l_returnflag)) AS topic0,
       '0x' || lpad(lower(hex(l_partkey)), 64, '0') AS topic1, '0x' || lpad(lower(hex(l_suppkey)), 64, '0') AS topic2,
       CASE WHEN l_linenumber < 5 THEN '0x' || lpad(lower(hex(l_linenumber)), 64, '0') END AS topic3,
       '0x' || lpad(lower(hex(CAST(l_quantity AS BIGINT))), 64, '0')
            || lpad(lower(hex(CAST(round(l_extendedprice * 100) AS BIGINT))), 64, '0') AS data,
       concat(l_returnflag, l_linestatus) AS event_code, l_suppkey AS supp_key, l_linenumber AS line_no
FROM {logs_placed}""",
    "frames_placed": """
SELECT *, CAST(dense_rank() OVER (PARTITION BY chain_id, block_number, transaction_index ORDER BY l_linenumber) - 1 AS INT) AS p0,
       CAST(row_number() OVER (PARTITION BY chain_id, block_number, transaction_index, l_linenumber ORDER BY log_index) - 2 AS INT) AS p1,
       CASE WHEN concat(l_returnflag, l_linestatus) IN ('RF', 'RO') AND log_index % 3 = 0 THEN 'reverted' END AS own_error
FROM {logs_placed}""",
    "frames": """
SELECT chain_id, block_number, transaction_index, log_index, p0, p1, own_error, '0x' || lpad(lower(hex(l_suppkey)), 40, '0') AS address FROM {frames_placed}""",
    # a frame's sender is its transaction's, which the join of its log has met already; both parts stay dealt by block
    "calls": """
SELECT chain_id, block_number, transaction_index, 0 AS depth, -1 AS p0, -1 AS p1, CAST(NULL AS STRING) AS own_error, '0x' || lpad(lower(hex(o_custkey)), 40, '0') AS sender,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '0x' || lpad(lower(hex(o_orderkey % 97)), 40, '0') END AS address, 1000000 - o_orderkey % 1000 AS gas,
       '0x' || lower(hex(CAST(round(o_totalprice * 100) AS BIGINT))) AS value_hex, o_orderkey AS frame_key FROM {tx_by_block}
UNION ALL
SELECT chain_id, block_number, transaction_index, CASE WHEN p1 = -1 THEN 1 ELSE 2 END, p0, p1, own_error, '0x' || lpad(lower(hex(o_custkey)), 40, '0'),
       '0x' || lpad(lower(hex(l_suppkey)), 40, '0'), 5000 + log_index, CASE WHEN log_index % 4 = 0 THEN '0x0' ELSE '0x' || lower(hex(log_index)) END, 1000000000 + log_index
FROM {frames_placed}""",
}


class Fixtures:
    """The views as DataFrames: ``Fixtures(spark, sf_dir).logs``; base tables too."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def written(self, path: str, names: tuple[str, ...]) -> Fixtures:
        """The same views, of which ``names`` are read from tables at ``path``: partitioned by chain and block bucket where they
        have blocks, sorted by block."""
        out = Fixtures(self.spark, self.sf_dir)
        for name in names:
            df = getattr(self, name)
            own = df.withColumn("block_bucket", F.floor(F.col("block_number") / BUCKET).cast("long")) if "block_number" in df.columns else df
            keys = [c for c in ("chain_id", "block_bucket") if c in own.columns]
            order = [c for c in ("block_number", "seq") if c in df.columns]
            dealt = own.repartition(*keys) if keys else own
            (dealt.sortWithinPartitions(*keys, *order) if order else dealt).write.partitionBy(*keys).parquet(f"{path}/{name}")
            out._made[name] = self.spark.read.schema(own.schema).parquet(f"{path}/{name}").select(*df.columns)
        return out

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in VIEWS and name not in PLANS and name not in BASE):
            raise AttributeError(name)
        if name not in self._made:
            if name in BASE:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text = PLANS.get(name) or VIEWS[name]
                needs = set(re.findall(r"{(\w+)}", text))
                self._made[name] = self.spark.sql(text, **{n: self._by_block(n.removesuffix("_by_block")) if n.endswith("_by_block") else getattr(self, n) for n in needs})
        return self._made[name]

    def _by_block(self, name: str) -> DataFrame:
        """Line items, or transactions with their places, dealt by block."""
        if name == "lineitem":
            return self.lineitem.withColumn("l_block", F.expr("CAST(floor(l_orderkey / 40.0) AS BIGINT)")).repartition("l_block")
        return self.spark.sql(PLANS["tx_placed"], tx_keyed=self.tx_keyed.repartition("block_number"))


def with_views(sql: str) -> str:
    """``sql`` for the oracle engine: its ``{view}`` names become common table expressions."""
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"{(\w+)}", text)):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed[name] = re.sub(r"{(\w+)}", r"\1", VIEWS[name])

    visit(sql)
    body = re.sub(r"{(\w+)}", r"\1", sql.strip())
    ctes = ",\n".join(f"{n} AS ({q})" for n, q in needed.items())
    if not ctes:
        return body
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    return f"WITH {ctes}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {ctes}\n{body}"
