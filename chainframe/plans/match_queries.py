"""Queries of filters, joins and handlers."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.fixtures import Fixtures
from chainframe.functions.encodings import decode_events
from chainframe.operators import aggregates, filters, handlers, joins, routing
from chainframe.operators.windows import rank_traces
from chainframe.plans.registry import register

BLOCK, TX, LOG = ["chain_id", "block_number"], ["chain_id", "block_number", "transaction_index"], ["chain_id", "block_number", "log_index"]

RANGE = "(f.from_block IS NULL OR r.block_number >= f.from_block) AND (f.to_block IS NULL OR r.block_number <= f.to_block)"
MATCHED_LOGS = f"""SELECT r.* FROM {{logs}} r WHERE EXISTS (SELECT 1 FROM {{log_filters}} f WHERE f.chain_id = r.chain_id
  AND (f.address IS NULL OR f.address = r.address) AND (f.topic0 IS NULL OR f.topic0 = r.topic0) AND (f.topic1 IS NULL OR f.topic1 = r.topic1) AND {RANGE})"""



def listed(row: str, name: str) -> str:
    return f"(f.{name} IS NULL OR list_contains(f.{name}, {row}))"


TOPICS = " AND ".join(listed(f"r.topic{k}", f"topic{k}") for k in range(4))
#: Log filters, those by factory once for each child.
BY_FACTORY = """SELECT f.*, c.child, c.created_block FROM {topic_filters} f JOIN {factory_children} c ON c.factory_id = f.address_factory AND c.chain_id = f.chain_id"""
FOUND_BY_FACTORY = f"SELECT r.chain_id, r.block_number, r.log_index, r.address, r.topic0 FROM {{logs}} r JOIN ({BY_FACTORY}) f ON f.chain_id = r.chain_id AND f.child = r.address AND r.block_number >= f.created_block WHERE {TOPICS} AND {RANGE}"
FOUND = f"SELECT r.chain_id, r.block_number, r.log_index, r.address, r.topic0 FROM {{logs}} r JOIN {{topic_filters}} f ON f.chain_id = r.chain_id WHERE f.address_factory IS NULL AND {listed('r.address', 'address')} AND {TOPICS} AND {RANGE}"
register("match_logs", lambda f: filters.match_logs(f.logs, f.topic_filters, f.factory_children).select(*LOG, "address", "topic0"), f"{FOUND} UNION {FOUND_BY_FACTORY}")
register("match_logs_factory", lambda f: filters.match_logs_factory(f.logs, f.topic_filters, f.factory_children).select(*LOG, "address"), f"SELECT DISTINCT chain_id, block_number, log_index, address FROM ({FOUND_BY_FACTORY}) m")


def sides(sender: str, receiver: str, rest: str) -> str:
    """Rows joined to filters of which both sides hold; ``j`` says what the filter's factories allow."""
    return f"""JOIN {{side_filters}} f ON f.chain_id = r.chain_id
  LEFT JOIN {{factory_children}} a ON a.chain_id = r.chain_id AND a.factory_id = f.from_address_factory AND a.child = {sender} AND a.created_block <= r.block_number
  LEFT JOIN {{factory_children}} b ON b.chain_id = r.chain_id AND b.factory_id = f.to_address_factory AND b.child = {receiver} AND b.created_block <= r.block_number
  WHERE (f.from_address_factory IS NULL OR a.child IS NOT NULL) AND (f.to_address_factory IS NULL OR b.child IS NOT NULL)
  AND {listed(sender, 'from_address')} AND {listed(receiver, 'to_address')} AND {rest} AND {RANGE}"""


NOT_ALL = "coalesce(f.from_address_factory, f.to_address_factory, f.from_address[1], f.to_address[1]) IS NOT NULL"
register(
    "match_transactions",
    lambda f: filters.match_transactions(f.tx, f.side_filters, f.factory_children).select(*TX, "tx_hash"),
    f"SELECT DISTINCT r.chain_id, r.block_number, r.transaction_index, r.tx_hash FROM {{tx}} r {sides('r.from_address', 'r.to_address', NOT_ALL)}",
)

register("drop_reverted", lambda f: filters.drop_reverted(f.tx, f.receipts).select(*TX), "SELECT chain_id, block_number, transaction_index FROM {tx} WHERE status = 1")


def call_frames(f: Fixtures) -> DataFrame:
    """Call frames with paths as arrays, ranked."""
    path = F.when(F.col("depth") == 0, F.array().cast("array<int>")).when(F.col("depth") == 1, F.array("p0")).otherwise(F.array("p0", "p1"))
    calls = f.calls.withColumn("path", path.cast("array<int>"))
    return rank_traces(calls.select(*TX, "path", "own_error", F.col("sender").alias("from_address"), F.col("address").alias("to_address"), "gas", "value_hex", "frame_key"))


RANKED = """
SELECT *, CAST(row_number() OVER (PARTITION BY chain_id, block_number, transaction_index ORDER BY depth > 0, p0, p1) - 1 AS BIGINT) AS trace_index FROM {calls}"""


def matchable(f: Fixtures) -> DataFrame:
    key = F.col("frame_key")
    kinds = F.array(*map(F.lit, ("CALL", "STATICCALL", "DELEGATECALL")))
    return call_frames(f).withColumns({"selector": F.concat(F.lit("0x0000000"), (key % 4).cast("string")), "call_type": F.get(kinds, (key % 3).cast("int")), "error": F.col("own_error")})


TRACES = f"""SELECT DISTINCT r.chain_id, r.block_number, r.transaction_index, r.trace_index, r.value_hex FROM ({RANKED}) r
{sides('r.sender', 'r.address', "(f.include_reverted OR r.own_error IS NULL) AND " + listed("concat('0x0000000', CAST(r.frame_key % 4 AS STRING))", "selector")
       + " AND (f.call_type IS NULL OR list_contains(list_transform(f.call_type, lambda x: upper(x)), CASE r.frame_key % 3 WHEN 0 THEN 'CALL' WHEN 1 THEN 'STATICCALL' ELSE 'DELEGATECALL' END))")}"""
register("match_traces", lambda f: filters.match_traces(matchable(f), f.side_filters, f.factory_children).select(*TX, "trace_index"), f"SELECT chain_id, block_number, transaction_index, trace_index FROM ({TRACES}) m")
register("match_transfers", lambda f: filters.match_transfers(matchable(f), f.side_filters, f.factory_children).select(*TX, "trace_index", "value_hex"), f"SELECT * FROM ({TRACES}) m WHERE value_hex <> '0x0'")


def interval_filters(f: Fixtures) -> DataFrame:
    return f.heads.select("chain_id", (F.col("chain_id") * 7).alias("interval"), F.col("chain_id").alias("offset"), F.lit(10).alias("from_block"), F.lit(None).cast("long").alias("to_block"))


TICKS = "SELECT * FROM {blocks} WHERE (block_number - chain_id) % (chain_id * 7) = 0 AND block_number >= 10"
register("match_blocks_interval", lambda f: filters.match_blocks_interval(f.blocks, interval_filters(f)).select(*BLOCK, "block_hash"), f"SELECT chain_id, block_number, block_hash FROM ({TICKS}) t")


def _discovery(f: Fixtures) -> DataFrame:
    return f.logs.where("event_code = 'RF' AND line_no = 1").select(*LOG)


TRIMMED = """SELECT r.* FROM {logs} r WHERE (r.event_code = 'RF' AND r.line_no = 1)
  OR EXISTS (SELECT 1 FROM {creations} c WHERE c.chain_id = r.chain_id AND c.child = r.address AND c.created_block <= r.block_number)"""
register(
    "trim_superset",
    lambda f: filters.trim_superset(f.logs, f.tx, f.creations, _discovery(f))[1].select(*TX, "tx_hash"),
    f"SELECT DISTINCT t.chain_id, t.block_number, t.transaction_index, t.tx_hash FROM {{tx}} t JOIN ({TRIMMED}) k ON k.chain_id = t.chain_id AND k.tx_hash = t.tx_hash",
)

register(
    "exclude_no_tx_frames",
    lambda f: filters.exclude_no_tx_frames(
        f.calls.withColumn("type", F.when(F.col("frame_key") % 11 == 0, "reward").otherwise("call")).withColumn("transaction_index", F.when(F.col("frame_key") % 13 != 0, F.col("transaction_index")))
    ).select(*TX, "frame_key"),
    "SELECT chain_id, block_number, transaction_index, frame_key FROM {calls} WHERE frame_key % 11 <> 0 AND frame_key % 13 <> 0",
)

register(
    "event_has_match",
    lambda f: filters.event_has_match(f.blocks, filters.match_logs(f.logs, f.log_filters), filters.match_blocks_interval(f.blocks, interval_filters(f))).select(*BLOCK, "matched"),
    f"""
WITH k AS (SELECT chain_id, block_number FROM ({MATCHED_LOGS}) m UNION SELECT chain_id, block_number FROM ({TICKS}) t)
SELECT b.chain_id, b.block_number, k.chain_id IS NOT NULL AS matched FROM {{blocks}} b LEFT JOIN k ON k.chain_id = b.chain_id AND k.block_number = b.block_number""",
)

# --- joins --------------------------------------------------------------------------------------------------------


def kept(f: Fixtures) -> DataFrame:
    return filters.match_logs(f.logs, f.log_filters)


register(
    "parent_transactions",
    lambda f: joins.parent_transactions(f.tx, kept(f)).select(*TX, "tx_hash"),
    f"SELECT chain_id, block_number, transaction_index, tx_hash FROM {{tx}} WHERE tx_hash IN (SELECT tx_hash FROM ({MATCHED_LOGS}) m)",
)

register(
    "event_blocks",
    lambda f: joins.event_blocks(f.blocks, kept(f), filters.match_blocks_interval(f.blocks, interval_filters(f)), f.tx.where("status = 0")).select(*BLOCK, "block_hash"),
    f"""
WITH k AS (SELECT chain_id, block_number FROM ({MATCHED_LOGS}) m UNION SELECT chain_id, block_number FROM ({TICKS}) t UNION SELECT chain_id, block_number FROM {{tx}} WHERE status = 0)
SELECT b.chain_id, b.block_number, b.block_hash FROM {{blocks}} b JOIN k ON k.chain_id = b.chain_id AND k.block_number = b.block_number""",
)

register(
    "receipts_for",
    lambda f: joins.receipts_for(f.receipts, kept(f), f.tx.where("status = 0"), None).select("chain_id", "tx_hash", "gas_used"),
    f"SELECT chain_id, tx_hash, gas_used FROM {{receipts}} WHERE status = 0 OR tx_hash IN (SELECT tx_hash FROM ({MATCHED_LOGS}) m)",
)

register(
    "trace_transactions",
    lambda f: joins.trace_transactions(f.frames, f.tx.where("order_key % 9 <> 0")).select(*LOG, "transaction_index", "tx_hash"),
    """
SELECT f.chain_id, f.block_number, f.log_index, f.transaction_index, t.tx_hash FROM {frames} f
LEFT JOIN {tx} t ON t.chain_id = f.chain_id AND t.block_number = f.block_number AND t.transaction_index = f.transaction_index AND t.order_key % 9 <> 0""",
)

register(
    "root_gas_override",
    lambda f: joins.root_gas_override(call_frames(f), f.tx.where("order_key % 5 <> 0").withColumn("gas", F.col("order_key") + 21000)).select(*TX, "trace_index", F.col("gas").cast("long").alias("gas")),
    f"""
SELECT r.chain_id, r.block_number, r.transaction_index, r.trace_index,
       CAST(CASE WHEN r.depth = 0 AND r.frame_key % 5 <> 0 THEN r.frame_key + 21000 ELSE r.gas END AS BIGINT) AS gas FROM ({RANKED}) r""",
)


def failing_frames(f: Fixtures) -> DataFrame:
    """Call frames where some lack a parent: depth-1 frames go for every seventh root."""
    return call_frames(f).where("NOT (size(path) = 1 AND frame_key % 7 = 0)").withColumn("error", F.col("own_error")).withColumn("reason", F.when(F.col("own_error").isNotNull(), F.concat(F.lit("r"), F.col("frame_key").cast("string"))))


register(
    "cascade_errors",
    lambda f: joins.cascade_errors(failing_frames(f).select(*TX, "path", "error", "reason")).select(*TX, F.array_join(F.col("path").cast("array<string>"), ".").alias("path"), "error", "reason"),
    """
WITH c AS (SELECT *, CASE WHEN own_error IS NOT NULL THEN 'r' || CAST(frame_key AS STRING) END AS own_reason FROM {calls} WHERE NOT (depth = 1 AND frame_key % 7 = 0)),
p AS (SELECT chain_id, block_number, transaction_index, p0, own_error, own_reason FROM c WHERE depth = 1),
r AS (SELECT chain_id, block_number, transaction_index, own_error, own_reason FROM c WHERE depth = 0)
SELECT c.chain_id, c.block_number, c.transaction_index, '' AS path, c.own_error AS error, c.own_reason AS reason FROM c WHERE depth = 0
UNION ALL SELECT c.chain_id, c.block_number, c.transaction_index, CAST(c.p0 AS STRING), coalesce(c.own_error, r.own_error), coalesce(c.own_reason, r.own_reason)
FROM c LEFT JOIN r USING (chain_id, block_number, transaction_index) WHERE c.depth = 1
UNION ALL SELECT c.chain_id, c.block_number, c.transaction_index, CAST(c.p0 AS STRING) || '.' || CAST(c.p1 AS STRING), coalesce(c.own_error, p.own_error, CASE WHEN p.p0 IS NOT NULL THEN r.own_error END),
       coalesce(c.own_reason, p.own_reason, CASE WHEN p.p0 IS NOT NULL THEN r.own_reason END)
FROM c LEFT JOIN p USING (chain_id, block_number, transaction_index, p0) LEFT JOIN r USING (chain_id, block_number, transaction_index) WHERE c.depth = 2""",
)


def factories(f: Fixtures) -> DataFrame:
    """A factory per chain; its creations are RF logs, from block 5 on."""
    return f.heads.select(F.concat(F.lit("factory-"), F.col("chain_id").cast("string")).alias("factory_id"), "chain_id", F.lit(None).cast("string").alias("address"),
                          F.concat(F.lit("0x"), F.md5(F.lit("RF").cast("binary")), F.md5(F.lit("FR").cast("binary"))).alias("topic0"), F.lit(5).alias("from_block"), F.col("finalized").alias("to_block"))


def as_contract(df: DataFrame) -> DataFrame:
    """Logs whose topic1 names a contract: suppliers."""
    return df.withColumn("topic1", F.concat(F.lit("0x"), F.repeat(F.lit("0"), F.lit(24)), F.substring("address", 3, 40)))


CHILDREN = """SELECT 'factory-' || CAST(l.chain_id AS STRING) AS factory_id, l.chain_id, l.address AS child, min(l.block_number) AS created_block
  FROM {logs} l JOIN {heads} h ON h.chain_id = l.chain_id WHERE l.event_code = 'RF' AND l.block_number BETWEEN 5 AND h.finalized GROUP BY l.chain_id, l.address"""
register("discover_children", lambda f: joins.discover_children(f.logs, f.factory_rows), "SELECT factory_id, chain_id, child, created_block FROM {factory_children}")

register(
    "factory_events",
    lambda f: joins.factory_events(f.logs, f.factory_rows).select(*LOG, "address"),
    """
SELECT DISTINCT l.chain_id, l.block_number, l.log_index, l.address FROM {logs} l JOIN {factory_children} c ON c.chain_id = l.chain_id AND c.child = l.address AND l.block_number >= c.created_block""",
)
# each filter takes children of its own factory
register("factory_events_filtered", lambda f: joins.factory_events(f.logs, f.factory_rows, f.topic_filters).select(*LOG, "address"), f"SELECT DISTINCT chain_id, block_number, log_index, address FROM ({FOUND_BY_FACTORY}) m")

register(
    "dedupe_children_least",
    lambda f: joins.dedupe_children_least(
        f.creations.select(F.when(F.col("chain_id") % 2 == 0, "Vault").otherwise("VAULT").alias("factory"), "chain_id", F.upper("child").alias("address"), "created_block"),
        f.creations.where("created_block % 3 <> 0").select(F.lit("vault").alias("factory"), "chain_id", F.col("child").alias("address"), (F.col("created_block") + F.col("created_block") % 2).alias("created_block")),
    ),
    "SELECT 'vault' AS factory, chain_id, child AS address, created_block FROM {creations} WHERE created_block % 3 = 0 OR created_block % 2 = 1",
)

register("children_in_range", lambda f: joins.children_in_range(f.creations, 10, 60), "SELECT chain_id, child, created_block FROM {creations} WHERE created_block BETWEEN 10 AND 60")

register(
    "asof_block",
    lambda f: joins.asof_block(f.blocks.select(F.pmod(F.col("chain_id"), F.lit(5)).cast("long").alias("chain_id"), F.col("block_number").alias("foreign_block"), (F.col("block_ts") + F.col("block_number") % 5 * 3).alias("checkpoint_ts")), f.blocks),
    """
SELECT c.chain_id % 5 AS chain_id, c.block_number AS foreign_block, c.block_ts + c.block_number % 5 * 3 AS checkpoint_ts, max(b.block_number) AS asof_block
FROM {blocks} c LEFT JOIN {blocks} b ON b.chain_id = c.chain_id % 5 AND b.block_ts < c.block_ts + c.block_number % 5 * 3
GROUP BY c.chain_id, c.block_number, c.block_ts""",
)

register(
    "relation_join",
    lambda f: joins.relation_pages(f.creations, f.logs.where("event_code = 'RO'").select("chain_id", F.col("address").alias("child"), "block_number", "log_index"), ["chain_id", "child"], ["block_number", "log_index"], F.floor(F.col("block_number") / 500).cast("long"))
    .select("chain_id", "child", "page", F.coalesce(F.array_join(F.transform("items", lambda x: F.concat_ws("-", x["block_number"].cast("string"), x["log_index"].cast("string"))), ","), F.lit("")).alias("items"), "n_items"),
    """
SELECT c.chain_id, c.child, CAST(floor(l.block_number / 500.0) AS BIGINT) AS page, coalesce(string_agg(CAST(l.block_number AS STRING) || '-' || CAST(l.log_index AS STRING), ',' ORDER BY l.block_number, l.log_index), '') AS items, count(l.log_index) AS n_items
FROM {creations} c LEFT JOIN {logs} l ON l.chain_id = c.chain_id AND l.address = c.child AND l.event_code = 'RO' GROUP BY c.chain_id, c.child, CAST(floor(l.block_number / 500.0) AS BIGINT)""",
)

register(
    "ensure_parent",
    lambda f: joins.ensure_parent(f.creations.select("chain_id", F.col("child").alias("vault"), F.col("created_block").alias("block_number"), F.upper("child").alias("name")), f.logs.where("event_code = 'RO'").select("chain_id", F.col("address").alias("vault"), "block_number"), ["chain_id", "vault"], ["name"]),
    """
WITH a AS (SELECT chain_id, address AS vault, min(block_number) AS b FROM {logs} WHERE event_code = 'RO' GROUP BY chain_id, address),
j AS (SELECT coalesce(c.chain_id, a.chain_id) AS chain_id, coalesce(c.child, a.vault) AS vault, c.created_block, a.b,
             c.created_block IS NOT NULL AND (a.b IS NULL OR c.created_block <= a.b) AS created
      FROM {creations} c FULL OUTER JOIN a ON a.chain_id = c.chain_id AND a.vault = c.child)
SELECT chain_id, vault, CASE WHEN created THEN created_block ELSE b END AS block_number, CASE WHEN created THEN upper(vault) END AS name, NOT created AS stub FROM j""",
)

register(
    "enrich_metadata",
    lambda f: joins.enrich_metadata(f.creations, f.spark.sql("SELECT '0x' || lpad(lower(hex(s_suppkey)), 40, '0') AS child, s_name AS name FROM {s} WHERE s_suppkey % 3 <> 0", s=f.supplier), ["child"]).select("chain_id", "child", "name"),
    """
SELECT c.chain_id, c.child, s.name FROM {creations} c
LEFT JOIN (SELECT '0x' || lpad(lower(hex(s_suppkey)), 40, '0') AS child, s_name AS name FROM {supplier} WHERE s_suppkey % 3 <> 0) s ON s.child = c.child""",
)


def labels(f: Fixtures) -> DataFrame:
    return f.signatures.where("code <> 'AO'").select("topic0", F.concat(F.lit("Vault."), F.col("name")).alias("label"))


LABELLED = "SELECT l.*, coalesce(CASE WHEN s.code <> 'AO' THEN 'Vault.' || s.name END, 'other') AS label FROM {logs} l LEFT JOIN {signatures} s ON s.topic0 = l.topic0"
register("label_events", lambda f: joins.label_events(f.logs, labels(f)).select(*LOG, "label"), f"SELECT chain_id, block_number, log_index, label FROM ({LABELLED}) m")

register(
    "logs_equal_truth",
    lambda f: joins.logs_equal_truth(
        f.logs.where("log_index % 19 <> 0").select(*LOG, "address", "data"), f.logs.where("log_index % 17 <> 0").select(*LOG, F.when(F.col("log_index") % 23 == 0, "0x").otherwise(F.col("address")).alias("address"), F.when(F.col("log_index") % 29 == 0, None).otherwise(F.col("data")).alias("data")), LOG, ["address", "data"]
    ),
    """
SELECT chain_id, block_number, log_index, CASE WHEN log_index % 19 = 0 THEN 'MISSING' WHEN log_index % 17 = 0 THEN 'EXTRA' ELSE 'MISMATCH' END AS kind,
       CASE WHEN log_index % 19 = 0 OR log_index % 17 = 0 THEN '' WHEN log_index % 23 = 0 AND log_index % 29 = 0 THEN 'address,data' WHEN log_index % 23 = 0 THEN 'address' ELSE 'data' END AS fields
FROM {logs} WHERE (log_index % 19 = 0 OR log_index % 17 = 0 OR log_index % 23 = 0 OR log_index % 29 = 0) AND NOT (log_index % 19 = 0 AND log_index % 17 = 0)""",
)

# --- handlers ---------------------------------------------------------------------------------------------------


#: An indexed word and two words of the data.
WORDS = "array(named_struct('name', 'arg1', 'type', 'bytes32', 'indexed', true), named_struct('name', 'arg2', 'type', 'bytes32', 'indexed', false), named_struct('name', 'arg3', 'type', 'bytes32', 'indexed', false))"


def decoded(f: Fixtures) -> DataFrame:
    return decode_events(f.logs, f.signatures.withColumn("args", F.expr(WORDS)))


def handled(f: Fixtures) -> DataFrame:
    h = handlers.Handlers()
    handlers.on_event(h, "Vault:Deposit", lambda e: {"action": e.select("chain_id", F.lit("deposit").alias("kind"), F.col("args")["arg1"].alias("arg1"))})
    handlers.on_event(h, "Vault:Withdraw", lambda e: {"action": e.select("chain_id", F.lit("withdraw").alias("kind"), F.col("args")["arg1"].alias("arg1"))})
    d = decoded(f)
    out = h.run({"Vault:Deposit": d.where("event_name = 'Deposit'"), "Vault:Withdraw": d.where("event_name = 'Withdraw'")})
    return out["action"].groupBy("chain_id", "kind").agg(F.count("*").alias("n"), F.countDistinct("arg1").alias("accounts"))


register("on_event", handled, """
SELECT chain_id, CASE event_code WHEN 'RO' THEN 'deposit' ELSE 'withdraw' END AS kind, count(*) AS n, count(DISTINCT topic1) AS accounts
FROM {logs} WHERE event_code IN ('RO', 'NO') GROUP BY chain_id, event_code""")

def topic(code: str) -> str:
    """An event's topic in the test tables."""
    return "0x" + hashlib.md5(code.encode()).hexdigest() + hashlib.md5(code[::-1].encode()).hexdigest()


ARGS = [("arg1", "uint256", True), ("", "address", True), ("", "uint256", True), ("amount", "uint256", False), ("price", "uint256", False)]
POOLS, WHALES = [f"0x{k:040x}" for k in (7, 9, 12)], [f"0x{k:040x}" for k in range(10, 40)]
MADE = {"topic0": topic("RF"), "location": "topic2", "from_block": 5}
CONFIG = {
    "contracts": {
        "Vault": {"chains": {k: {"factory": MADE, "from_block": 20} for k in (1, 2)}, "events": [(topic("RO"), "Deposit", ARGS), (topic("NO"), "Withdraw", ARGS)]},
        "Pool": {"chains": {3: {"address": [x.upper().replace("0X", "0x") for x in POOLS]}}, "events": [(topic("NO"), "Withdraw", ARGS)], "functions": {"0x00000001": "swap"}},
    },
    "accounts": {"Whale": {"chains": {1: {"address": WHALES}, 4: {"address": WHALES, "from_block": 30}}}},
    "blocks": {"Ticks": {"chains": {4: {"interval": 25, "offset": 3, "from_block": 50}}}},
}


def configured(f: Fixtures) -> DataFrame:
    """Events by name and chain, from a configuration to handlers."""
    h = handlers.Handlers()
    for name in ("Vault:Deposit", "Vault:Withdraw", "Pool:Withdraw", "Pool.swap()", "Whale:transaction:from", "Whale:transaction:to", "Whale:transfer:from", "Ticks:block"):
        amount = F.length(F.col("args")["amount"]) if name.split(":")[0] in ("Vault", "Pool") else F.lit(0)
        h.on_event(name, lambda e, name=name, amount=amount: {"seen": e.select(F.lit(name).alias("name"), "chain_id", amount.cast("long").alias("digits"))})
    tables = {"logs": f.logs, "transactions": f.tx, "traces": matchable(f), "blocks": f.blocks}
    seen = routing.run_config(f.spark, CONFIG, tables, h)["seen"]
    return seen.groupBy("name", "chain_id").agg(F.count("*").alias("n"), F.sum("digits").alias("digits"))


def in_list(column: str, own: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(x) for x in own)})"


WHALE = "(chain_id = 1 OR chain_id = 4 AND block_number >= 30)"
AMOUNT = "2 + length(regexp_replace(substring(data, 3, 64), '^0+(.)', '\\1'))"
register("on_event_config", configured, f"""
WITH c AS (SELECT l.chain_id, '0x' || substring(topic2, 27, 40) AS child, min(block_number) AS created FROM {{logs}} l WHERE event_code = 'RF' AND block_number >= 5 AND chain_id IN (1, 2) GROUP BY 1, 2),
e AS (
  SELECT CASE event_code WHEN 'RO' THEN 'Vault:Deposit' ELSE 'Vault:Withdraw' END AS name, l.chain_id, {AMOUNT} AS digits FROM {{logs}} l JOIN c ON c.chain_id = l.chain_id AND c.child = l.address AND l.block_number >= c.created WHERE event_code IN ('RO', 'NO') AND block_number >= 20
  UNION ALL SELECT 'Pool:Withdraw', chain_id, {AMOUNT} FROM {{logs}} WHERE chain_id = 3 AND event_code = 'NO' AND {in_list("address", POOLS)}
  UNION ALL SELECT 'Pool.swap()', chain_id, 0 FROM {{calls}} WHERE chain_id = 3 AND frame_key % 4 = 1 AND {in_list("address", POOLS)}
  UNION ALL SELECT 'Whale:transaction:from', chain_id, 0 FROM {{tx}} WHERE {WHALE} AND {in_list("from_address", WHALES)}
  UNION ALL SELECT 'Whale:transaction:to', chain_id, 0 FROM {{tx}} WHERE {WHALE} AND {in_list("to_address", WHALES)}
  UNION ALL SELECT 'Whale:transfer:from', chain_id, 0 FROM {{calls}} WHERE {WHALE} AND {in_list("sender", WHALES)} AND value_hex <> '0x0'
  UNION ALL SELECT 'Ticks:block', chain_id, 0 FROM {{blocks}} WHERE chain_id = 4 AND (block_number - 3) % 25 = 0 AND block_number >= 50)
SELECT name, chain_id, count(*) AS n, CAST(sum(digits) AS BIGINT) AS digits FROM e GROUP BY name, chain_id""")

register("swap_receipts", lambda f: handlers.swap_receipts(f.logs.where("event_code = 'NF'"), f.receipts), """
SELECT l.tx_hash || '-' || CAST(l.log_index AS STRING) AS id, l.chain_id, l.block_number, l.address, r.gas_used, r.status = 1 AS success
FROM {logs} l JOIN {receipts} r ON r.chain_id = l.chain_id AND r.tx_hash = l.tx_hash WHERE l.event_code = 'NF'""")

register(
    "router_calls",
    lambda f: handlers.router_calls(
        f.tx.select(*TX, F.concat(F.lit("0x"), F.upper(F.substring(F.md5(F.concat(F.lit("s"), (F.col("order_key") % 9).cast("string")).cast("binary")), 1, 8)), F.lit("00ff")).alias("input")),
        f.spark.range(4).select(F.concat(F.lit("0x"), F.substring(F.md5(F.concat(F.lit("s"), F.col("id").cast("string")).cast("binary")), 1, 8)).alias("selector"), F.concat(F.lit("call"), F.col("id").cast("string")).alias("function_name")),
    ).select(*TX, "selector", "function_name"),
    """
SELECT chain_id, block_number, transaction_index, '0x' || substring(md5('s' || CAST(order_key % 9 AS STRING)), 1, 8) AS selector, 'call' || CAST(order_key % 9 AS STRING) AS function_name
FROM {tx} WHERE order_key % 9 < 4""",
)

register("block_ticks", lambda f: handlers.block_ticks(f.blocks, interval_filters(f)), f"SELECT chain_id, block_number, block_ts FROM ({TICKS}) t")

register(
    "account_txs",
    lambda f: handlers.account_txs(f.tx, f.tx.where("order_key % 50 = 0").select("chain_id", F.col("from_address").alias("account")).union(f.tx.where("order_key % 60 = 0").select("chain_id", "to_address")).distinct(), f.tx.where("order_key % 8 = 0").select("chain_id", "tx_hash")),
    """
WITH a AS (SELECT chain_id, from_address AS account FROM {tx} WHERE order_key % 50 = 0 UNION SELECT chain_id, to_address FROM {tx} WHERE order_key % 60 = 0)
SELECT t.chain_id, t.tx_hash, CASE WHEN EXISTS (SELECT 1 FROM a WHERE a.chain_id = t.chain_id AND a.account = t.from_address) THEN t.from_address ELSE t.to_address END AS account,
       CASE WHEN EXISTS (SELECT 1 FROM a WHERE a.chain_id = t.chain_id AND a.account = t.from_address) THEN 'from' ELSE 'to' END AS direction
FROM {tx} t WHERE t.order_key % 8 <> 0 AND EXISTS (SELECT 1 FROM a WHERE a.chain_id = t.chain_id AND (a.account = t.from_address OR a.account = t.to_address))""",
)


def lending(f: Fixtures) -> DataFrame:
    """All six tables, one below the other."""
    return handlers.lending_rows(decoded(f)).drop("block_number")


WORD = {"arg1": "topic1", "arg2": "'0x' || substring(data, 3, 64)", "arg3": "'0x' || substring(data, 67, 64)"}
OTHERS = sorted({c for _, columns in handlers.LENDING.values() for c in columns})


def lending_sql() -> str:
    columns = [", ".join([f"'{table}' AS t"] + [f"{WORD[own[c]] if c in own else 'NULL'} AS {c}" for c in OTHERS]) for table, own in handlers.LENDING.values()]
    return " UNION ALL ".join(f"SELECT {c}, tx_hash || '-' || CAST(log_index AS STRING) AS id, l.chain_id, l.address AS vault FROM {{logs}} l JOIN {{signatures}} s ON s.topic0 = l.topic0 WHERE s.name = '{event}'" for c, event in zip(columns, handlers.LENDING))


register("lending_tables", lending, lending_sql())


def flagship(f: Fixtures) -> DataFrame:
    """Discovery, the children's events, their transactions, and counts per vault."""
    logs = as_contract(f.logs)
    children = joins.discover_children(logs, factories(f))
    events = joins.child_events(logs, children)
    vaults = children.select("chain_id", F.col("child").alias("vault"))
    parents = joins.parent_transactions(f.tx, events).select("chain_id", "tx_hash", "value_units")
    own = events.select("chain_id", F.col("address").alias("vault"), "tx_hash")
    counts = aggregates.vault_event_counts(vaults, own)
    values = own.distinct().join(parents, ["chain_id", "tx_hash"]).groupBy("chain_id", "vault").agg(F.count("*").alias("transactions"), F.sum("value_units").alias("value_units"))
    ids = values.select(F.concat_ws(":", F.col("chain_id").cast("string"), "vault").alias("id"), "transactions", "value_units")
    return counts.join(ids, "id", "left")


register("vault_activity", flagship, f"""
WITH c AS ({CHILDREN}),
e AS (SELECT l.chain_id, l.address, l.tx_hash FROM {{logs}} l JOIN c ON c.chain_id = l.chain_id AND c.child = l.address AND l.block_number >= c.created_block),
v AS (SELECT d.chain_id, d.address, count(*) AS transactions, CAST(sum(t.value_units) AS BIGINT) AS value_units
      FROM (SELECT DISTINCT * FROM e) d JOIN {{tx}} t ON t.tx_hash = d.tx_hash GROUP BY d.chain_id, d.address),
n AS (SELECT chain_id, address, count(*) AS n FROM e GROUP BY chain_id, address)
SELECT CAST(c.chain_id AS STRING) || ':' || c.child AS id, coalesce(n.n, 0) AS event_count, v.transactions, v.value_units
FROM c LEFT JOIN n ON n.chain_id = c.chain_id AND n.address = c.child LEFT JOIN v ON v.chain_id = c.chain_id AND v.address = c.child""")
