"""Queries of sources, sinks and encodings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.fixtures import Fixtures
from chainframe.functions import encodings as enc
from chainframe.functions import scalars
from chainframe.operators.windows import reorg_resolve
from chainframe.plans.registry import register
from chainframe.scratch import scratch
from chainframe.sources import blocks as src
from chainframe.sources import store
from chainframe.sources.backfill import Backfill
from chainframe.sources.manifest import Store

TX = ["chain_id", "block_number", "transaction_index"]


def raw_blocks(f: Fixtures) -> DataFrame:
    """Raw blocks with their logs, nested, as the wire has them."""
    log = F.struct(
        "address", F.array("topic0", "topic1").alias("topics"), "data", F.col("tx_hash").alias("transactionHash"),
        F.col("transaction_index").alias("transactionIndex"), F.col("log_index").alias("logIndex"),
    )
    logs = f.logs.groupBy("chain_id", "block_number").agg(F.sort_array(F.collect_list(F.struct("log_index", log.alias("log")))).alias("l"))
    header = F.struct(F.col("block_number").alias("number"), F.col("block_hash").alias("hash"), F.col("parent_hash").alias("parentHash"), F.col("block_ts").alias("timestamp"))
    return f.blocks.join(logs, ["chain_id", "block_number"], "left").select("chain_id", header.alias("header"), F.transform("l", lambda x: x["log"]).alias("logs"))


def read_block_ndjson(f: Fixtures) -> DataFrame:
    path = f"{scratch(f.spark)}/{uuid.uuid4().hex}"
    raw_blocks(f).drop("chain_id").write.option("compression", "gzip").json(path)
    b = src.read_block_ndjson(f.spark, path)
    return b.select(F.col("header.number").alias("number"), F.col("header.hash").alias("hash"), F.coalesce(F.size("logs"), F.lit(0)).cast("long").alias("n_logs"))


register("read_block_ndjson", read_block_ndjson, """
SELECT b.block_number AS number, b.block_hash AS hash, count(l.log_index) AS n_logs
FROM {blocks} b LEFT JOIN {logs} l ON b.chain_id = l.chain_id AND b.block_number = l.block_number GROUP BY b.block_number, b.block_hash""")

register(
    "explode_block",
    lambda f: src.explode_block(raw_blocks(f).withColumn("transactions", F.lit(None).cast("array<struct<hash:string>>")).withColumn("traces", F.lit(None).cast("array<struct<type:string>>")))["logs"].select(
        "chain_id", "block_number", "block_hash", "block_ts", F.col("logIndex").alias("log_index"), "address", F.get("topics", F.lit(0)).alias("topic0"), "data"
    ),
    """
SELECT l.chain_id, l.block_number, b.block_hash, b.block_ts, l.log_index, l.address, l.topic0, l.data
FROM {logs} l JOIN {blocks} b ON b.chain_id = l.chain_id AND b.block_number = l.block_number""",
)

register(
    "scan_range",
    lambda f: src.scan_range(f.logs, 100, 200).select("chain_id", "block_number", "log_index", "address"),
    "SELECT chain_id, block_number, log_index, address FROM {logs} WHERE block_number >= 100 AND block_number <= 200",
)

register("bounded_window", lambda f: src.bounded_window(f.log_filters, f.heads), """
SELECT s.chain_id, CAST(s.start_block AS BIGINT) AS start_block,
       CAST(CASE WHEN s.open_end THEN h.finalized ELSE least(s.e, h.finalized) END AS BIGINT) AS end_block
FROM (SELECT chain_id, CASE WHEN bool_or(from_block IS NULL) THEN 0 ELSE min(from_block) END AS start_block,
             bool_or(to_block IS NULL) AS open_end, max(to_block) AS e FROM {log_filters} GROUP BY chain_id) s
JOIN {heads} h ON h.chain_id = s.chain_id""")



def _projected(f: Fixtures) -> DataFrame:
    """The columns that each kind of source reads, one row a column, with how many rows it has."""
    tables = {"blocks": f.headers, "logs": f.logs.withColumn("topics", F.array("topic0")), "transactions": f.receipts.withColumn("from_address", F.lit("0x")), "traces": f.calls.withColumn("error", F.col("own_error"))}
    out = None
    for kind, sources, receipts in (("log", {"log"}, False), ("log and receipts", {"log"}, True), ("transaction", {"transaction"}, False), ("trace", {"trace"}, False), ("block", {"block"}, False)):
        for family, df in src.project_families(tables, sources, receipts).items():
            own = df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("source"), F.lit(family).alias("family"), F.lit(",".join(sorted(df.columns))).alias("columns"), "n")
            out = own if out is None else out.unionByName(own)
    return out


_HEADER, _TX = "base_fee,block_hash,block_number,block_ts,chain_id,parent_hash,size", "block_number,chain_id,from_address,transaction_index,tx_hash"
_LOG, _RECEIPT = "address,block_number,chain_id,data,log_index,topics,transaction_index,tx_hash", "block_number,chain_id,contract_address,from_address,gas_used,status,transaction_index,tx_hash"
_READS = [
    *((k, "blocks", _HEADER, "headers") for k in ("log", "log and receipts", "transaction", "trace", "block")),
    ("log", "logs", _LOG, "logs"), ("log and receipts", "logs", _LOG, "logs"), ("log", "transactions", _TX, "receipts"), ("log and receipts", "transactions", _RECEIPT, "receipts"),
    ("transaction", "transactions", _RECEIPT, "receipts"), ("trace", "transactions", _TX, "receipts"), ("trace", "traces", "block_number,chain_id,error,gas,transaction_index", "calls"),
]
register("project_families", _projected, " UNION ALL ".join(f"SELECT '{k}' AS source, '{n}' AS family, '{c}' AS columns, count(*) AS n FROM {{{t}}}" for k, n, c, t in _READS))

register(
    "degrade_columns",
    lambda f: src.degrade_columns(
        [f.headers.where("block_number < 100"), f.headers.where("block_number >= 100").drop("base_fee")],
        {"chain_id": "long", "block_number": "long", "block_hash": "string", "base_fee": "long", "total_difficulty": "string"},
    ),
    """
SELECT chain_id, block_number, block_hash, CASE WHEN block_number < 100 THEN base_fee END AS base_fee, CAST(NULL AS STRING) AS total_difficulty FROM {headers}""",
)

register(
    "assert_needed_columns",
    lambda f: src.assert_needed_columns(f.tx, "status = 1 AND chain_id = 2", ["from_address", "to_address"]).groupBy("chain_id").agg(F.count("*").alias("n")),
    "SELECT chain_id, count(*) AS n FROM {tx} WHERE status = 1 AND chain_id = 2 GROUP BY chain_id",
)


def availability_input(f: Fixtures) -> DataFrame:
    return f.tx.select(
        "chain_id", "block_number", "tx_hash", "to_address",
        F.when(F.col("block_number") >= 50, F.col("value_hex")).alias("late"), F.lit(None).cast("string").alias("never"),
    )


register("column_availability", lambda f: src.column_availability(availability_input(f), ["tx_hash", "to_address", "late", "never"], 100), """
WITH t AS (SELECT chain_id, block_number, tx_hash, to_address, CASE WHEN block_number >= 50 THEN value_hex END AS late, CAST(NULL AS STRING) AS never FROM {tx}),
long AS (
  SELECT chain_id, block_number, 'tx_hash' AS column_name, tx_hash IS NOT NULL AS there FROM t
  UNION ALL SELECT chain_id, block_number, 'to_address', to_address IS NOT NULL FROM t
  UNION ALL SELECT chain_id, block_number, 'late', late IS NOT NULL FROM t
  UNION ALL SELECT chain_id, block_number, 'never', never IS NOT NULL FROM t),
total AS (SELECT chain_id, column_name, min(CASE WHEN there THEN block_number END) AS first_served, min(block_number) AS first_block FROM long GROUP BY chain_id, column_name)
SELECT l.chain_id, l.column_name, CAST(floor(l.block_number / 100.0) AS BIGINT) AS bucket,
       round(CAST(sum(CASE WHEN there THEN 0 ELSE 1 END) AS DOUBLE) / count(*), 6) AS null_share, t.first_served,
       CASE WHEN t.first_served IS NULL THEN 'absent' WHEN t.first_served > t.first_block THEN 'from-block' ELSE 'full' END AS availability
FROM long l JOIN total t ON t.chain_id = l.chain_id AND t.column_name = l.column_name
GROUP BY l.chain_id, l.column_name, CAST(floor(l.block_number / 100.0) AS BIGINT), t.first_served, t.first_block""")


def _wanted(f: Fixtures) -> DataFrame:
    return f.heads.select("chain_id", F.lit(0).cast("long").alias("from_block"), F.col("finalized").cast("long").alias("to_block"))


register(
    "unserved_prefix",
    lambda f: src.unserved_prefix(_wanted(f), f.blocks.where("block_number % 7 = 3").groupBy("chain_id").agg((F.min("block_number") + F.col("chain_id") * 5).cast("long").alias("dataset_start"))),
    """
WITH s AS (SELECT chain_id, min(block_number) + chain_id * 5 AS d FROM {blocks} WHERE block_number % 7 = 3 GROUP BY chain_id)
SELECT h.chain_id, CAST(CASE WHEN d > 0 THEN 0 END AS BIGINT) AS unserved_from,
       CAST(CASE WHEN d > 0 THEN least(d - 1, h.finalized) END AS BIGINT) AS unserved_to,
       CAST(CASE WHEN d <= h.finalized THEN d END AS BIGINT) AS continue_from
FROM {heads} h JOIN s ON s.chain_id = h.chain_id""",
)


def _ranges(f: Fixtures) -> DataFrame:
    return f.blocks.select("chain_id", (F.floor(F.col("block_number") / 50) * 50).cast("long").alias("lo")).distinct().withColumn("hi", F.col("lo") + 49)


register(
    "finality_split",
    lambda f: src.finality_split(_ranges(f), f.heads.select("chain_id", F.col("finalized").cast("long").alias("finalized"), F.col("end_block").cast("long").alias("head"), F.lit(30).cast("long").alias("floor_block"))),
    """
WITH r AS (SELECT DISTINCT chain_id, CAST(floor(block_number / 50.0) * 50 AS BIGINT) AS lo FROM {blocks}),
e AS (SELECT r.chain_id, r.lo, r.lo + 49 AS hi,
             CASE WHEN h.end_block IS NOT NULL THEN least(greatest(least(h.finalized, h.end_block), 30), h.finalized) END AS edge
      FROM r JOIN {heads} h ON h.chain_id = r.chain_id)
SELECT chain_id, lo, hi,
       CASE WHEN edge >= lo THEN lo END AS served_lo, CAST(CASE WHEN edge >= lo THEN least(edge, hi) END AS BIGINT) AS served_hi,
       CAST(CASE WHEN edge IS NULL OR edge < lo THEN lo WHEN edge < hi THEN edge + 1 END AS BIGINT) AS deferred_lo,
       CASE WHEN edge IS NULL OR edge < hi THEN hi END AS deferred_hi,
       CASE WHEN edge IS NULL OR edge < lo THEN 'deferred' WHEN edge >= hi THEN 'served' ELSE 'split' END AS state
FROM e""",
)

register(
    "write_store",
    lambda f: store.write_store(
        f.tx.where("order_key % 2 = 0").select(*TX, "tx_hash").unionByName(f.tx.where("order_key % 4 = 0").select(*TX, "tx_hash")), f.tx.where("order_key % 3 = 0"), TX
    ),
    "SELECT chain_id, block_number, transaction_index, tx_hash FROM {tx} WHERE order_key % 2 = 0 AND order_key % 3 <> 0",
)

register(
    "merge_sources",
    lambda f: store.merge_sources(
        [
            f.logs.where("event_code = 'RF'").select("chain_id", "block_number").distinct().withColumn("source", F.lit("logs")),
            f.tx.where("status = 0").select("chain_id", "block_number").distinct().withColumn("source", F.lit("txs")),
            f.frames.where("own_error IS NOT NULL").select("chain_id", "block_number").distinct().withColumn("source", F.lit("traces")),
        ],
        ["chain_id", "block_number"],
    ),
    """
WITH u AS (SELECT chain_id, block_number, 1 AS k FROM {logs} WHERE event_code = 'RF'
  UNION ALL SELECT chain_id, block_number, 2 FROM {tx} WHERE status = 0
  UNION ALL SELECT chain_id, block_number, 3 FROM {frames} WHERE own_error IS NOT NULL)
SELECT chain_id, block_number, CASE min(k) WHEN 1 THEN 'logs' WHEN 2 THEN 'txs' ELSE 'traces' END AS source FROM u GROUP BY chain_id, block_number""",
)

register(
    "upsert_do_nothing",
    lambda f: store.upsert_do_nothing(
        f.logs.select("chain_id", "address", "block_number", "log_index"), f.creations.select("chain_id", F.col("child").alias("address")).where("chain_id = 1"), ["chain_id", "address"], ["block_number", "log_index"]
    ),
    """
WITH r AS (SELECT chain_id, address, block_number, log_index, row_number() OVER (PARTITION BY chain_id, address ORDER BY block_number, log_index) AS n FROM {logs})
SELECT chain_id, address, block_number, log_index FROM r
WHERE n = 1 AND NOT (chain_id = 1 AND address IN (SELECT child FROM {creations} WHERE chain_id = 1))""",
)

register(
    "upsert_accumulate",
    lambda f: store.upsert_accumulate(
        f.logs.where("block_number >= 100").select("chain_id", "event_code"), f.logs.where("block_number < 100 AND event_code <> 'AF'").groupBy("chain_id", "event_code").agg(F.count("*").alias("n")), ["chain_id", "event_code"]
    ),
    "SELECT chain_id, event_code, count(*) AS n FROM {logs} WHERE block_number >= 100 OR event_code <> 'AF' GROUP BY chain_id, event_code",
)


def _metrics(f: Fixtures) -> DataFrame:
    b = f.blocks
    total = b.groupBy("chain_id").agg(F.count("*").alias("total"), F.count_if((F.col("chain_id") != 3) | (F.col("tx_count") > 1)).alias("completed"), F.min("block_ts").alias("start"), F.max("block_ts").alias("end"), F.count_if(F.col("tx_count") > 12).alias("errors"))
    return total.select(F.col("chain_id").alias("chain"), F.inline(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("value")) for c in ("total", "completed", "start", "end", "errors")))))


register("completion_summary", lambda f: store.completion_summary(_metrics(f)), """
WITH p AS (SELECT chain_id AS chain, CAST(sum(CASE WHEN chain_id <> 3 OR tx_count > 1 THEN 1 ELSE 0 END) AS BIGINT) AS completed, count(*) AS total,
                  min(block_ts) AS start_s, max(block_ts) AS end_s, CAST(sum(CASE WHEN tx_count > 12 THEN 1 ELSE 0 END) AS BIGINT) AS errors FROM {blocks} GROUP BY chain_id)
SELECT chain, completed = total AS complete, completed, total, start_s, end_s, errors, end_s - start_s AS wall_s FROM p
UNION ALL SELECT NULL, bool_and(completed = total), CAST(sum(completed) AS BIGINT), CAST(sum(total) AS BIGINT), min(start_s), max(end_s), CAST(sum(errors) AS BIGINT), max(end_s) - min(start_s) FROM p""")

register(
    "run_metrics",
    lambda f: store.run_metrics(
        {"logs": f.logs, "transactions": f.tx, "blocks": f.blocks},
        f.blocks.select("chain_id", F.when(F.col("block_number") % 9 == 0, "deferred").otherwise("served").alias("state"), (F.col("tx_count") * 100).alias("bytes")),
    ),
    """
SELECT b.chain_id, l.n AS logs_rows, t.n AS transactions_rows, b.n AS blocks_rows, b.s AS served_ranges, b.d AS deferred_ranges, b.bytes
FROM (SELECT chain_id, count(*) AS n, CAST(sum(CASE WHEN block_number % 9 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS s,
             CAST(sum(CASE WHEN block_number % 9 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS d, CAST(sum(tx_count * 100) AS BIGINT) AS bytes FROM {blocks} GROUP BY chain_id) b
JOIN (SELECT chain_id, count(*) AS n FROM {logs} GROUP BY chain_id) l ON l.chain_id = b.chain_id
JOIN (SELECT chain_id, count(*) AS n FROM {tx} GROUP BY chain_id) t ON t.chain_id = b.chain_id""",
)

# --- encodings ----------------------------------------------------------------------------------------------------

#: Numbers beyond 64 bits, as decimal and as hex text.
BIG = [(str(v), hex(v)) for v in (2**63, 2**64, 10**38, 2**128 - 1, 2**200 + 12345, 2**255 + 7, 2**256 - 1, 10**77)]


def big(f: Fixtures) -> DataFrame:
    decimals = F.array(*(F.lit(d) for d, _ in BIG))
    return f.tx.select(
        "order_key",
        enc.hex_quantity(F.col("value_units")).alias("of_number"),
        enc.hex_quantity(F.when(F.col("order_key") % 3 == 0, "").when(F.col("order_key") % 3 == 1, F.upper("value_hex")).otherwise(F.concat(F.lit("00"), F.col("value_units").cast("string")))).alias("of_text"),
        enc.hex_quantity(F.when(F.col("status") == 1, F.col("value_units")), optional=True).alias("of_optional"),
        enc.hex_quantity(F.get(decimals, (F.col("order_key") % len(BIG)).cast("int"))).alias("of_long"),
    )


register("hex_quantity", big, f"""
SELECT order_key, value_hex AS of_number, CASE WHEN order_key % 3 = 0 THEN '0x0' ELSE value_hex END AS of_text,
       CASE WHEN status = 1 THEN value_hex END AS of_optional, [{", ".join(f"'{h}'" for _, h in BIG)}][order_key % {len(BIG)} + 1] AS of_long FROM {{tx}}""")

register(
    "uint256_compare",
    lambda f: f.tx.select("order_key", enc.uint256_compare(F.col("value_hex"), F.concat(F.lit("0x"), F.lower(F.hex(F.col("order_key") * 1000)))).alias("compared")),
    "SELECT order_key, CASE WHEN value_units < order_key * 1000 THEN -1 WHEN value_units > order_key * 1000 THEN 1 ELSE 0 END AS compared FROM {tx}",
)

register(
    "uint256_sum",
    lambda f: enc.uint256_sum(f.tx, ["chain_id"], "value_hex"),
    "SELECT chain_id, '0x' || lower(hex(CAST(sum(value_units) AS BIGINT))) AS total FROM {tx} GROUP BY chain_id",
)



def raw_headers(f: Fixtures) -> DataFrame:
    """Headers as the wire has them; mixHash is lacking altogether, other nullable fields in some rows."""
    h = f.headers
    text = lambda name: F.concat(F.lit(f"0x{name}"), F.col("block_hash"))
    return h.select(
        "chain_id", F.col("block_number").alias("number"), F.col("block_hash").alias("hash"), F.col("parent_hash").alias("parentHash"), F.col("block_ts").alias("timestamp"), text("b").alias("logsBloom"),
        text("m").alias("miner"), (F.col("block_number") * 1000).cast("string").alias("gasUsed"), F.lit("30000000").alias("gasLimit"), F.col("base_fee").cast("string").alias("baseFeePerGas"),
        F.when(F.col("block_number") % 2 == 0, text("n")).alias("nonce"), text("s").alias("stateRoot"), text("r").alias("receiptsRoot"), text("t").alias("transactionsRoot"), text("u").alias("sha3Uncles"),
        "size", F.lit("0x").alias("difficulty"), F.when(F.col("block_number") % 5 == 0, F.concat((F.col("block_number") + 1).cast("string"), F.lit("0" * 20))).alias("totalDifficulty"), F.lit("0xEE").alias("extraData"),
    )


HEX = "'0x' || lower(hex({}))".format
register("canon_block", lambda f: enc.canon_block(raw_headers(f)), f"""
SELECT chain_id, block_number, block_hash, parent_hash, block_ts, '0xb' || block_hash AS logs_bloom, '0xm' || block_hash AS miner, {HEX("block_number * 1000")} AS gas_used, '0x1c9c380' AS gas_limit,
       CASE WHEN base_fee IS NOT NULL THEN {HEX("base_fee")} END AS base_fee, CASE WHEN block_number % 2 = 0 THEN '0xn' || block_hash END AS nonce, CAST(NULL AS STRING) AS mix_hash, '0xs' || block_hash AS state_root,
       '0xr' || block_hash AS receipts_root, '0xt' || block_hash AS transactions_root, '0xu' || block_hash AS sha3_uncles, {HEX("size")} AS size, '0x0' AS difficulty,
       CASE WHEN block_number % 5 = 0 THEN {HEX("CAST(block_number + 1 AS HUGEINT) * 100000000000000000000")} END AS total_difficulty, '0xEE' AS extra_data FROM {{headers}}""")

register(
    "canon_log",
    lambda f: enc.canon_log(f.logs.select("chain_id", "block_number", "log_index", F.upper("address").alias("address"), F.when(F.col("log_index") % 2 == 0, F.array("topic0")).alias("topics"), F.when(F.col("log_index") % 3 == 0, F.col("data")).alias("data")))
    .withColumn("topics", F.concat_ws(",", "topics")),
    """
SELECT chain_id, block_number, log_index, lower(address) AS address, CASE WHEN log_index % 2 = 0 THEN topic0 ELSE '' END AS topics,
       CASE WHEN log_index % 3 = 0 THEN data ELSE '0x' END AS data, FALSE AS removed FROM {logs}""",
)



def raw_transactions(f: Fixtures) -> DataFrame:
    """Transactions with their receipts' columns as the wire has them."""
    k, n = F.col("order_key"), F.col("value_units").cast("string")
    return f.tx.select(
        "chain_id", "block_number", F.concat(F.lit("0xh"), F.col("block_number").cast("string")).alias("block_hash"), F.col("transaction_index").alias("transactionIndex"), F.col("tx_hash").alias("hash"),
        F.upper("from_address").alias("from"), F.when(k % 10 == 3, "").otherwise(F.upper("to_address")).alias("to"), F.when(k % 3 != 0, F.lit("0xAB")).alias("input"), F.when(F.col("status") == 1, n).alias("value"),
        F.when(k % 2 == 0, k).alias("nonce"), (k * 21).cast("string").alias("gas"), F.when(F.col("tx_type") < 2, n).alias("gasPrice"), F.when(F.col("tx_type") >= 2, F.concat(n, F.lit("0" * 20))).alias("maxFeePerGas"),
        F.when(F.col("tx_type") > 0, F.col("tx_type")).alias("type"), F.concat(F.lit("0xR"), n).alias("r"), F.concat(F.lit("0xS"), n).alias("s"), (k % 2).cast("string").alias("v"), F.when(k % 4 == 0, F.lit("0x1")).alias("yParity"),
        F.when(k % 7 != 0, F.array(F.struct(F.col("from_address").alias("address"), F.array(F.lit("0x1"), F.lit("0x2")).alias("storageKeys")))).alias("accessList"),
        F.when(k % 3 == 0, F.col("status").cast("string")).when(k % 3 == 1, F.concat(F.lit("0x"), F.col("status").cast("string"))).otherwise((F.col("status") == 1).cast("string")).alias("status"),
        (k * 100).cast("string").alias("cumulativeGasUsed"), n.alias("effectiveGasPrice"), (k + 7).cast("string").alias("gasUsed"), F.when(F.col("to_address").isNull(), F.upper(F.substring("tx_hash", 1, 42))).alias("contractAddress"),
        F.concat(F.lit("0xB"), n).alias("logsBloom"),
    )


def _canon_tx(f: Fixtures) -> DataFrame:
    lists = F.array_join(F.transform("access_list", lambda x: F.concat(x["address"], F.lit(":"), F.array_join(x["storageKeys"], "+"))), ",")
    return enc.canon_tx(raw_transactions(f)).withColumn("access_list", lists)


SIDES = "lower(from_address) AS from_address, CASE WHEN order_key % 10 <> 3 THEN to_address END AS to_address"
register("canon_tx", _canon_tx, f"""
SELECT chain_id, block_number, '0xh' || CAST(block_number AS STRING) AS block_hash, transaction_index, tx_hash, {SIDES}, CASE WHEN order_key % 3 <> 0 THEN '0xAB' ELSE '0x' END AS input, {HEX("order_key * 21")} AS gas,
       CASE WHEN order_key % 2 = 0 THEN {HEX("order_key")} ELSE '0x0' END AS nonce, CASE WHEN status = 1 THEN value_hex ELSE '0x0' END AS value, {HEX("CAST(tx_type AS BIGINT)")} AS tx_type,
       CASE WHEN tx_type < 2 THEN value_hex END AS gas_price, CASE WHEN tx_type >= 2 THEN {HEX("CAST(value_units AS HUGEINT) * 100000000000000000000")} END AS max_fee_per_gas, CAST(NULL AS STRING) AS max_priority_fee_per_gas,
       {HEX("CAST(order_key % 2 AS BIGINT)")} AS v, CASE WHEN order_key % 4 = 0 THEN '0x1' END AS y_parity, '0xR' || CAST(value_units AS STRING) AS r, '0xS' || CAST(value_units AS STRING) AS s,
       CASE WHEN tx_type IN (1, 2, 3, 4) AND order_key % 7 <> 0 THEN from_address || ':0x1+0x2' END AS access_list FROM {{tx}}""")

register(
    "gate_access_list",
    lambda f: f.tx.select("order_key", enc.gate_access_list(F.col("tx_type"), F.when(F.col("order_key") % 7 != 0, F.col("tx_hash"))).alias("access_list")),
    "SELECT order_key, CASE WHEN tx_type IN (1, 2, 3, 4) AND order_key % 7 <> 0 THEN tx_hash END AS access_list FROM {tx}",
)

register(
    "require_access_list",
    lambda f: enc.require_access_list(f.tx.withColumn("access_list", F.when(F.col("order_key") % 7 != 0, F.col("tx_hash"))), opted_out=(2,)).select(*TX),
    "SELECT chain_id, block_number, transaction_index FROM {tx} WHERE tx_type IN (1, 2, 3, 4) AND order_key % 7 = 0 AND chain_id <> 2",
)

register("canon_receipt", lambda f: enc.canon_receipt(raw_transactions(f)), f"""
SELECT chain_id, block_number, '0xh' || CAST(block_number AS STRING) AS block_hash, transaction_index, tx_hash, {SIDES}, CASE WHEN to_address IS NULL THEN lower(substring(tx_hash, 1, 42)) END AS contract_address,
       '0xB' || CAST(value_units AS STRING) AS logs_bloom, {HEX("order_key + 7")} AS gas_used, {HEX("order_key * 100")} AS cumulative_gas_used, value_hex AS effective_gas_price, {HEX("CAST(tx_type AS BIGINT)")} AS tx_type,
       CASE WHEN status = 1 THEN '0x1' ELSE '0x0' END AS status FROM {{tx}}""")


def raw_traces(f: Fixtures) -> DataFrame:
    """Traces as the wire has them: odd frames nested, even ones flattened; every field has a value of its own."""
    k, odd = F.col("frame_key"), F.col("frame_key") % 2 == 1
    text = lambda name: F.concat(F.lit(f"0x{name}"), k.cast("string"))
    call = F.get(F.array(*map(F.lit, ("call", "delegatecall", "staticcall", "callcode", "weird"))), (k % 7 - 1).cast("int"))
    action = F.struct(
        F.upper("sender").alias("from"), F.upper("address").alias("to"), F.col("value_hex").alias("value"), F.col("gas").cast("string").alias("gas"), text("IN").alias("input"), call.alias("callType"), text("INIT").alias("init"),
        text("SELF").alias("address"), text("REFUND").alias("refundAddress"), (k + 5).cast("string").alias("balance"),
    )
    result = F.struct((k % 1000).cast("string").alias("gasUsed"), text("OUT").alias("output"), text("MADE").alias("address"), text("CODE").alias("code"))
    flat = {
        "callFrom": F.upper("sender"), "callTo": F.col("address"), "callValue": F.col("value_hex"), "callGas": F.col("gas").cast("string"), "callInput": text("in"), "callCallType": call, "callResultGasUsed": (k % 900).cast("string"),
        "callResultOutput": text("out"), "createFrom": text("CF"), "createValue": F.lit("0x9"), "createGas": F.lit("77"), "createInit": text("init"), "createResultGasUsed": F.lit("78"), "createResultCode": text("code"),
        "createResultAddress": text("MADE"), "suicideAddress": text("SF"), "suicideRefundAddress": text("SR"), "suicideBalance": F.lit("0"),
    }
    kind = F.get(F.array(*map(F.lit, ("call", "create", "suicide", "reward", "other"))), (F.floor(k / 2) % 5).cast("int"))
    return f.calls.select(
        *TX, "frame_key", kind.alias("type"), F.col("own_error").alias("error"), F.when(odd, action).alias("action"), F.when(odd & (k % 11 != 0), result).alias("result"),
        *(F.when(~odd, c).alias(n) for n, c in flat.items()),
    )


register("canon_trace", lambda f: enc.canon_trace(raw_traces(f)), f"""
WITH c AS (SELECT *, CAST(floor(frame_key / 2.0) AS BIGINT) % 5 AS t, frame_key % 2 = 1 AS odd, frame_key % 2 = 1 AND frame_key % 11 <> 0 AS done, CAST(frame_key AS STRING) AS k FROM {{calls}})
SELECT chain_id, block_number, transaction_index, frame_key, own_error AS error,
       CASE t WHEN 1 THEN 'CREATE' WHEN 2 THEN 'SELFDESTRUCT' ELSE CASE frame_key % 7 WHEN 2 THEN 'DELEGATECALL' WHEN 3 THEN 'STATICCALL' WHEN 4 THEN 'CALLCODE' ELSE 'CALL' END END AS frame_type,
       CASE t WHEN 0 THEN sender WHEN 1 THEN CASE WHEN odd THEN sender ELSE '0xcf' || k END ELSE CASE WHEN odd THEN '0xself' || k ELSE '0xsf' || k END END AS from_address,
       CASE t WHEN 0 THEN address WHEN 1 THEN CASE WHEN NOT odd OR done THEN '0xmade' || k END ELSE CASE WHEN odd THEN '0xrefund' || k ELSE '0xsr' || k END END AS to_address,
       CASE t WHEN 0 THEN value_hex WHEN 1 THEN CASE WHEN odd THEN value_hex ELSE '0x9' END ELSE CASE WHEN odd THEN {HEX("frame_key + 5")} ELSE '0x0' END END AS value,
       CASE t WHEN 2 THEN '0x0' ELSE CASE WHEN t = 0 OR odd THEN {HEX("CAST(gas AS BIGINT)")} ELSE '0x4d' END END AS gas,
       CASE t WHEN 2 THEN '0x0' WHEN 0 THEN CASE WHEN done THEN {HEX("frame_key % 1000")} WHEN odd THEN '0x0' ELSE {HEX("frame_key % 900")} END ELSE CASE WHEN done THEN {HEX("frame_key % 1000")} WHEN odd THEN '0x0' ELSE '0x4e' END END AS gas_used,
       CASE t WHEN 2 THEN '0x' WHEN 0 THEN CASE WHEN odd THEN '0xIN' || k ELSE '0xin' || k END ELSE CASE WHEN odd THEN '0xINIT' || k ELSE '0xinit' || k END END AS input,
       CASE t WHEN 0 THEN CASE WHEN done THEN '0xOUT' || k WHEN NOT odd THEN '0xout' || k END WHEN 1 THEN CASE WHEN done THEN '0xCODE' || k WHEN NOT odd THEN '0xcode' || k END END AS output
FROM c WHERE t < 3""")


def event_logs(f: Fixtures) -> DataFrame:
    """Logs with a head of five words: an amount, an account, a flag, and the places of a text and of a list."""
    word = lambda c: F.lpad(F.lower(F.hex(c.cast("bigint"))), 64, "0")
    note = F.concat(F.lit("é "), F.col("event_code"), F.col("line_no").cast("string"))
    size = F.octet_length(note)
    tags = F.when(F.col("line_no") == 1, word(F.lit(0))).otherwise(F.concat(word(F.lit(2)), word(F.col("line_no")), word(F.col("supp_key"))))
    data = F.concat(F.lit("0x"), F.substring("data", 3, 64), F.substring("topic2", 3, 64), word(F.col("line_no") % 2), word(F.lit(160)), word(F.lit(224)), word(size), F.rpad(F.lower(F.hex(note)), 64, "0"), tags)
    # of Borrow: a tuple, a list of fixed length, three words, and texts whose places are counted from the list's own head
    text = lambda t: F.concat(word(F.octet_length(t)), F.rpad(F.lower(F.hex(t)), 64, "0"))
    few = [word(F.lit(n)) for n in (99, 5, 6, 288, 2, 64, 128)]
    wide = F.concat(F.lit("0x"), word(F.col("line_no")), F.substring("topic2", 3, 64), word(F.lit(1)), word(F.col("line_no")), word(F.lit(2)), *few, text(F.concat(F.lit("n"), F.col("line_no").cast("string"))), text(F.col("event_code")))
    return f.logs.withColumn("data", F.when(F.col("event_code") == "NF", wide).when(F.col("line_no") == 6, F.substring(data, 1, 2 + 64)).otherwise(data))


def _signatures(f: Fixtures) -> DataFrame:
    args = [("part", "uint256", True), ("vault", "address", True), ("line", "uint8", True), ("amount", "uint256", False), ("account", "address", False), ("", "bool", False), ("note", "string", False), ("tags", "uint256[]", False)]
    other = [("key", "bytes4", True), ("amount", "bytes32", False)]
    wide = [("pair", "tuple(uint256,address)", False), ("three", "uint8[3]", False), ("last", "uint256", False), ("x", "uint64", False), ("x", "int8", False), ("names", "string[]", False)]
    spec = lambda own: F.array(*(F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(i).alias("indexed")) for n, t, i in own))
    return f.signatures.withColumn("args", F.when(F.col("code") == "AO", spec(other)).when(F.col("code") == "NF", spec(wide)).otherwise(spec(args)))


def _decoded_events(f: Fixtures) -> DataFrame:
    names = ("part", "vault", "line", "amount", "account", "word2", "note", "tags", "key", "pair", "three", "last", "x", "x_2", "names")
    logs = event_logs(f).select("chain_id", "block_number", "log_index", "topic0", "topic1", "topic2", "topic3", "data")
    return enc.decode_events(logs, _signatures(f)).select("chain_id", "block_number", "log_index", "event_name", *(F.col("args")[n].alias(n) for n in names))


_TRIMMED = "'0x' || regexp_replace(substring({}, 3), '^0+(.)', '\\1')".format
register("decode_events", _decoded_events, f"""
WITH d AS (SELECT l.*, s.name AS event_name, code = 'AO' AS ao, code = 'NF' AS nf, code NOT IN ('AO', 'NF') AS long, line_no = 6 AS short FROM {{logs}} l JOIN {{signatures}} s ON s.topic0 = l.topic0)
SELECT chain_id, block_number, log_index, event_name, CASE WHEN long THEN {_TRIMMED("topic1")} END AS part, CASE WHEN long THEN address END AS vault,
       CASE WHEN long THEN {_TRIMMED("topic3")} END AS line, CASE WHEN ao THEN '0x' || substring(data, 3, 64) WHEN long THEN {_TRIMMED("substring(data, 1, 66)")} END AS amount,
       CASE WHEN long AND NOT short THEN address END AS account, CASE WHEN long AND NOT short THEN CASE line_no % 2 WHEN 0 THEN 'false' ELSE 'true' END END AS word2,
       CASE WHEN long AND NOT short THEN 'é ' || event_code || CAST(line_no AS STRING) END AS note,
       CASE WHEN long AND NOT short THEN CASE WHEN line_no = 1 THEN '' ELSE {HEX("CAST(line_no AS BIGINT)")} || ',' || {HEX("CAST(supp_key AS BIGINT)")} END END AS tags,
       CASE WHEN nf THEN '["' || {HEX("CAST(line_no AS BIGINT)")} || '","' || address || '"]' END AS pair, CASE WHEN nf THEN '0x1,' || {HEX("CAST(line_no AS BIGINT)")} || ',0x2' END AS three,
       CASE WHEN nf THEN '0x63' END AS last, CASE WHEN nf THEN '0x5' END AS x, CASE WHEN nf THEN '0x6' END AS x_2, CASE WHEN nf THEN '["n' || CAST(line_no AS STRING) || '","NF"]' END AS names,
       CASE WHEN ao THEN '0x' || substring(topic1, 3, 8) END AS key FROM d""")

register(
    "child_address",
    lambda f: enc.child_address(enc.child_address(f.logs, "topic1", "of_topic"), "offset32", "of_data").select("chain_id", "block_number", "log_index", "of_topic", "of_data"),
    """
SELECT chain_id, block_number, log_index, '0x' || substring(topic1, 27, 40) AS of_topic, '0x' || substring(data, 91, 40) AS of_data FROM {logs}""",
)


def _apy(f: Fixtures) -> DataFrame:
    rate, borrowed, supplied = (F.col("order_key") % 50).cast("double") * F.lit(1e16), F.col("value_units") % 1000, F.col("order_key") % 4 * 1000
    a, b = enc.compute_apy(rate, borrowed, supplied, F.lit(0.1))
    return f.tx.select("order_key", F.round(a, 6).alias("borrow_apy"), F.round(b, 6).alias("supply_apy"))


register("compute_apy", _apy, """
WITH r AS (SELECT order_key, pow(1.0 + CAST(order_key % 50 AS DOUBLE) * 1e16 / 1e27, 365.2425 * 86400) - 1.0 AS a,
                  CASE WHEN order_key % 4 = 0 THEN 0.0 ELSE CAST(value_units % 1000 AS DOUBLE) / (order_key % 4 * 1000) END AS u FROM {tx})
SELECT order_key, round(a, 6) AS borrow_apy, round(a * u * 0.9, 6) AS supply_apy FROM r""")

register(
    "event_id",
    lambda f: f.logs.select(enc.event_id(F.col("tx_hash"), F.col("log_index")).alias("id"), enc.chain_address(F.col("chain_id"), F.col("address")).alias("vault")),
    "SELECT tx_hash || '-' || CAST(log_index AS STRING) AS id, CAST(chain_id AS STRING) || ':' || address AS vault FROM {logs}",
)


def _positions(f: Fixtures) -> DataFrame:
    return f.logs.join(f.blocks.select("chain_id", "block_number", "block_ts"), ["chain_id", "block_number"]).select(
        "block_ts", "chain_id", "block_number", "transaction_index", F.lit(5).alias("event_type"), F.col("log_index").alias("event_index")
    )


def _encoded(f: Fixtures) -> DataFrame:
    p = _positions(f)
    return p.select(*p.columns, enc.checkpoint_encode(**{c: F.col(c) for c in p.columns}).alias("checkpoint"))


POSITIONS = """
SELECT b.block_ts, l.chain_id, l.block_number, l.transaction_index, 5 AS event_type, l.log_index AS event_index,
       lpad(CAST(b.block_ts AS STRING), 10, '0') || lpad(CAST(l.chain_id AS STRING), 16, '0') || lpad(CAST(l.block_number AS STRING), 16, '0')
       || lpad(CAST(l.transaction_index AS STRING), 16, '0') || '5' || lpad(CAST(l.log_index AS STRING), 16, '0') AS checkpoint
FROM {logs} l JOIN {blocks} b ON b.chain_id = l.chain_id AND b.block_number = l.block_number"""

register("checkpoint_encode", lambda f: _encoded(f).select("checkpoint"), f"SELECT checkpoint FROM ({POSITIONS}) p")


def _decoded(f: Fixtures) -> DataFrame:
    text = F.when(F.col("event_index") % 5 == 0, F.substring("checkpoint", 2, 74)).otherwise(F.col("checkpoint"))
    return _encoded(f).select(F.col("checkpoint").alias("source"), *enc.checkpoint_decode(text).values())


register("checkpoint_decode", _decoded, "SELECT checkpoint AS source, " + ", ".join(
    f"CASE WHEN event_index % 5 <> 0 THEN CAST({c} AS BIGINT) END AS {c}" for c in ("block_ts", "chain_id", "block_number", "transaction_index", "event_type", "event_index")
) + f" FROM ({POSITIONS}) p")

register(
    "normalize_row",
    lambda f: (lambda d: d.select("order_key", enc.normalize_row(d, drop=("status",)).alias("row_json")))(f.tx.select("order_key", "tx_hash", "to_address", "tx_type", "status", "value_units")),
    """
SELECT order_key, '{"order_key":"' || CAST(order_key AS STRING) || '","to_address":' || CASE WHEN to_address IS NULL THEN 'null' ELSE '"' || to_address || '"' END
       || ',"tx_hash":"' || tx_hash || '","tx_type":' || CAST(tx_type AS STRING) || ',"value_units":"' || CAST(value_units AS STRING) || '"}' AS row_json FROM {tx}""",
)

register(
    "block_bucket",
    lambda f: f.blocks.select("chain_id", "block_number", scalars.block_bucket(F.col("block_number"), 100).alias("bucket"), scalars.block_bucket(F.col("block_number"), 100, 150, 320).alias("clamped")),
    """
SELECT chain_id, block_number, CAST(floor(block_number / 100.0) AS BIGINT) AS bucket, CAST(floor(least(greatest(block_number, 150), 320) / 100.0) AS BIGINT) AS clamped FROM {blocks}""",
)

#: Eras of the test chain, one of them beyond its end.
_ERAS = {"one": 20, "two": 33, "far": 10**9}
register(
    "sample_windows",
    lambda f: scalars.sample_windows(f.blocks.groupBy("chain_id").agg(F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block"), F.min(F.when(F.col("block_number") >= 20, F.col("block_number"))).alias("deploy_block")), seed=11, count=6, length=20, grid=16, pad=5, span=7, frontier=9, eras=_ERAS),
    f"""
WITH c AS (SELECT chain_id, min(block_number) AS a, max(block_number) AS z, min(CASE WHEN block_number >= 20 THEN block_number END) AS d FROM {{blocks}} GROUP BY chain_id),
w AS (SELECT chain_id, a, z, 'random-' || CAST(i AS STRING) AS strategy, a + CAST('0x' || substring(md5('11:' || CAST(chain_id AS STRING) || ':' || CAST(i AS STRING)), 1, 12) AS BIGINT) % greatest(z - a - 18, 1) AS lo, 19 AS more FROM c, range(6) r(i)
  UNION ALL SELECT chain_id, a, z, 'grid@' || CAST(k * 16 AS STRING), k * 16 - 2, 4 FROM c, range(100000) r(k) WHERE k * 16 BETWEEN a + 2 AND z - 2
  UNION ALL SELECT chain_id, a, z, 'deploy', greatest(d - 5, 0), d + 5 - greatest(d - 5, 0) FROM c UNION ALL SELECT chain_id, a, z, 'frontier', z - 8, 8 FROM c UNION ALL SELECT chain_id, a, z, 'full', d, z - d FROM c
  UNION ALL SELECT chain_id, a, z, 'era:' || n, b, 7 FROM c, (VALUES {", ".join(f"('{n}', {b})" for n, b in _ERAS.items())}) e(n, b) WHERE chain_id = 1)
SELECT chain_id, strategy, CAST(greatest(lo, a) AS BIGINT) AS lo, CAST(least(lo + more, z) AS BIGINT) AS hi FROM w WHERE greatest(lo, a) <= least(lo + more, z)""",
)


# --- a store of batches -------------------------------------------------------------------------------------------


def batched(f: Fixtures) -> DataFrame:
    """Transactions in three batches that overlap, the first of them twice."""
    own = f.tx.select("chain_id", "block_number", "transaction_index", "tx_hash", "value_units")
    at = Store(f.spark, f"{scratch(f.spark)}/{uuid.uuid4().hex}", own.schema, ["chain_id", "block_number", "transaction_index"], width=100)
    for name, part in (("a", "block_number % 3 < 2"), ("b", "block_number % 3 > 0"), ("a", "block_number % 3 < 2"), ("c", "transaction_index < 2 OR block_number % 3 = 0")):
        at.append(own.where(part), name)
    return at.read()


register("store_batches", batched, "SELECT chain_id, block_number, transaction_index, tx_hash, value_units, CAST(floor(block_number / 100.0) AS BIGINT) AS block_bucket FROM {tx}")


def ranged(f: Fixtures) -> DataFrame:
    """Logs of a store within ranges, some of them open: only their partitions are read."""
    own = f.logs.select("chain_id", "block_number", "log_index", "address")
    at = Store(f.spark, f"{scratch(f.spark)}/{uuid.uuid4().hex}", own.schema, ["chain_id", "block_number", "log_index"], width=50)
    at.append(own, "all")
    ranges = f.heads.select("chain_id", F.when(F.col("chain_id") > 1, F.col("chain_id") * 10).alias("lo"), F.when(F.col("chain_id") < 4, F.col("finalized")).alias("hi")).where("chain_id <> 3")
    found = src.scan_windows(at.read(), ranges, at.partitions(), width=50)
    r = ranges.select(F.col("chain_id").alias("c"), "lo", "hi")
    inside = (F.col("chain_id") == F.col("c")) & (F.col("lo").isNull() | (F.col("block_number") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("block_number") <= F.col("hi")))
    return found.join(F.broadcast(r), inside, "left_semi").drop("block_bucket")


register("scan_windows", ranged, """
SELECT l.chain_id, l.block_number, l.log_index, l.address FROM {logs} l JOIN {heads} h ON h.chain_id = l.chain_id
WHERE l.chain_id <> 3 AND (l.chain_id = 1 OR l.block_number >= l.chain_id * 10) AND (l.chain_id >= 4 OR l.block_number <= h.finalized)""")


def counted(f: Fixtures) -> DataFrame:
    """Headers by number, counted in batches: both forks' at first, one batch twice, redelivered blocks, then what was orphaned is taken back."""
    base, keys = f"{scratch(f.spark)}/{uuid.uuid4().hex}", ["chain_id", "kind"]
    d = f.deliveries.selectExpr("CAST(1 AS BIGINT) AS chain_id", "CAST(number % 7 AS BIGINT) AS kind", "hash AS block_hash", "seq", "number").dropDuplicates(["block_hash"])
    none = d.select("chain_id", "block_hash").limit(0)
    for k, part, gone in ((0, "number % 3 < 2", none), (1, "number % 3 > 0", none), (0, "number % 3 < 2", none), (2, "number % 3 = 0", reorged(f))):
        store.post_batch(d.where(part).select(*keys, "block_hash"), gone, base, k, keys)
    schema = d.select(*keys, "block_hash").schema.add("delta", "long")
    return store.ledger_totals(store.read_ledger(f.spark, base, schema), keys)


def reorged(f: Fixtures) -> DataFrame:
    return reorg_resolve(f.deliveries).where("orphaned").select(F.lit(1).cast("long").alias("chain_id"), F.col("hash").alias("block_hash"))


# what stays is the canonical headers
register("ledger_totals", counted, """
WITH d AS (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY seq) AS n FROM {deliveries}),
o AS (SELECT number, hash, coalesce(min(number) OVER (ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) <= number, FALSE) AS orphaned FROM d WHERE n = 1)
SELECT CAST(1 AS BIGINT) AS chain_id, CAST(number % 7 AS BIGINT) AS kind, count(*) AS n FROM o WHERE NOT orphaned GROUP BY number % 7""")


def observed(f: Fixtures) -> DataFrame:
    """Rows by chain and family, as they were counted while they were written."""
    return store.write_observed({"logs": f.logs, "transactions": f.tx, "blocks": f.blocks}, f"{scratch(f.spark)}/{uuid.uuid4().hex}", [1, 2, 3, 4, 5, 6])


register("write_observed", observed, """
SELECT CAST(c.chain_id AS BIGINT) AS chain_id, (SELECT count(*) FROM {logs} l WHERE l.chain_id = c.chain_id) AS logs_rows, (SELECT count(*) FROM {tx} t WHERE t.chain_id = c.chain_id) AS transactions_rows,
       (SELECT count(*) FROM {blocks} b WHERE b.chain_id = c.chain_id) AS blocks_rows FROM (SELECT unnest(range(1, 7)) AS chain_id) c""")


def backfilled(f: Fixtures) -> DataFrame:
    """Logs of one event from a store of all logs, in three batches of which each wants more than what is missing."""
    base = f"{scratch(f.spark)}/{uuid.uuid4().hex}"
    schema = "chain_id long, block_number long, log_index long, topic0 string, event_code string"
    key = ["chain_id", "block_number", "log_index"]
    source, into = Store(f.spark, f"{base}/all", schema, key, width=50), Store(f.spark, f"{base}/own", schema, key, width=50)
    source.append(f.logs, "all")
    job = Backfill(into, source, "RF", lambda rows: rows.where("event_code = 'RF'"))
    out = []
    for batch, (lo, hi) in enumerate(((30, 60), (10, 40), (0, 120))):
        wanted = f.heads.select(F.col("chain_id").cast("long").alias("chain_id"), F.lit(lo).cast("long").alias("want_lo"), (F.lit(hi) + F.col("chain_id")).cast("long").alias("want_hi"))
        out.append(job.fill(wanted, str(batch)).select(*key, F.lit(batch).alias("batch")))
    return out[0].unionByName(out[1]).unionByName(out[2])


register("backfill", backfilled, """
SELECT chain_id, block_number, log_index, CASE WHEN block_number >= 30 AND block_number < 60 + chain_id THEN 0 WHEN block_number >= 10 AND block_number < 40 + chain_id THEN 1 ELSE 2 END AS batch
FROM {logs} WHERE event_code = 'RF' AND block_number < 120 + chain_id""")
