"""Queries of store comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.fixtures import Fixtures
from chainframe.operators import aggregates as agg
from chainframe.operators import compare as cmp
from chainframe.plans.match_queries import BLOCK, LOG, TX
from chainframe.plans.registry import register
from chainframe.plans.summary_queries import SNAPSHOT, digest_sql

COLUMNS = ["tx_hash", "from_address", "to_address", "value_units", "access_list"]
ON = "a.chain_id = b.chain_id AND a.block_number = b.block_number AND a.transaction_index = b.transaction_index"
ONB = "a.chain_id = b.chain_id AND a.block_number = b.block_number"
DIFFERS = "concat_ws(',', " + ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in COLUMNS) + ")"
#: Both stores' transactions side by side.
PAIRED = f"""SELECT coalesce(a.chain_id, b.chain_id) AS chain_id, coalesce(a.block_number, b.block_number) AS block_number, coalesce(a.transaction_index, b.transaction_index) AS transaction_index,
  coalesce(a.tx_hash, b.tx_hash) AS tx_hash, a.access_list AS la, b.access_list AS lb,
  CASE WHEN a.chain_id IS NULL THEN 'only_b' WHEN b.chain_id IS NULL THEN 'only_a' WHEN {DIFFERS} = '' THEN 'shared' ELSE 'mismatch' END AS status,
  CASE WHEN a.chain_id IS NOT NULL AND b.chain_id IS NOT NULL THEN {DIFFERS} END AS columns
  FROM {{store_a}} a FULL OUTER JOIN {{store_b}} b ON {ON}"""
BLOCK_COLUMNS = ["block_hash", "parent_hash", "block_ts", "tx_count", "size", "base_fee"]
BDIFFERS = "concat_ws(',', " + ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in BLOCK_COLUMNS) + ")"
BPAIRED = f"""SELECT coalesce(a.chain_id, b.chain_id) AS chain_id, coalesce(a.block_number, b.block_number) AS block_number, a.base_fee AS fa, b.base_fee AS fb,
  CASE WHEN a.chain_id IS NULL THEN 'only_b' WHEN b.chain_id IS NULL THEN 'only_a' WHEN {BDIFFERS} = '' THEN 'shared' ELSE 'mismatch' END AS status,
  CASE WHEN a.chain_id IS NOT NULL AND b.chain_id IS NOT NULL THEN {BDIFFERS} END AS columns
  FROM (SELECT * FROM {{headers}} WHERE block_number % 59 <> 1) a FULL OUTER JOIN {{blocks_b}} b ON {ONB}"""


def a_(f: Fixtures) -> DataFrame:
    return f.store_a.drop("order_key")


def b_(f: Fixtures) -> DataFrame:
    return f.store_b.drop("order_key")


def headers_a(f: Fixtures) -> DataFrame:
    return f.headers.where("block_number % 59 <> 1")


def floors(f: Fixtures) -> DataFrame:
    return f.heads.where("chain_id <> 4").select("chain_id", (F.col("chain_id") * 20).alias("floor"), F.col("finalized").alias("window_end"))


def pins(f: Fixtures) -> DataFrame:
    return f.tx.where("order_key % 142 = 0").select("tx_hash")


register("diff_by_key", lambda f: cmp.diff_by_key(a_(f), b_(f), TX), f"""
WITH p AS ({PAIRED}),
k AS (SELECT status, lpad(CAST(chain_id AS STRING), 12, '0') || '-' || lpad(CAST(block_number AS STRING), 12, '0') || '-' || lpad(CAST(transaction_index AS STRING), 12, '0') AS k FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY k) AS n FROM k WHERE status <> 'shared')
SELECT p.status, count(*) AS n, coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM r WHERE r.status = p.status AND r.n <= 6), '') AS sample, p.status = 'shared' AS tolerated FROM p GROUP BY p.status""")

register("diff_columns", lambda f: cmp.diff_columns(a_(f), b_(f), TX).select(*TX, "columns"), f"SELECT chain_id, block_number, transaction_index, columns FROM ({PAIRED}) p WHERE columns <> ''")


def block_diff(f: Fixtures) -> DataFrame:
    return cmp.diff_columns(headers_a(f), f.blocks_b, BLOCK)


register("tolerate_size_only", lambda f: block_diff(f).where(cmp.tolerate_size_only(block_diff(f))).select(*BLOCK), f"SELECT chain_id, block_number FROM ({BPAIRED}) p WHERE columns = 'size'")
register(
    "tolerate_base_fee_null",
    lambda f: block_diff(f).where(cmp.tolerate_base_fee_null(block_diff(f), [1, 2, 3])).select(*BLOCK),
    f"SELECT chain_id, block_number FROM ({BPAIRED}) p WHERE columns = 'base_fee' AND fa IS NULL AND fb = 0 AND chain_id IN (1, 2, 3)",
)
register(
    "tolerate_access_list_gap",
    lambda f: (lambda d: d.where(cmp.tolerate_access_list_gap(d, [1, 2])).select(*TX))(cmp.diff_columns(b_(f), a_(f), TX)),
    f"SELECT chain_id, block_number, transaction_index FROM ({PAIRED}) p WHERE columns = 'access_list' AND lb IS NULL AND chain_id IN (1, 2)",
)

register("blocks_verdict", lambda f: cmp.blocks_verdict(headers_a(f), f.blocks_b, [1, 2, 3]), f"""
WITH p AS ({BPAIRED}),
k AS (SELECT CASE WHEN status <> 'mismatch' THEN status WHEN columns = 'size' THEN 'size_only' WHEN columns = 'base_fee' AND fa IS NULL AND fb = 0 AND chain_id IN (1, 2, 3) THEN 'base_fee_null' ELSE 'mismatch' END AS k FROM p)
SELECT count(CASE WHEN k = 'shared' THEN 1 END) AS shared, count(CASE WHEN k = 'size_only' THEN 1 END) AS size_only, count(CASE WHEN k = 'base_fee_null' THEN 1 END) AS base_fee_null,
       count(CASE WHEN k = 'mismatch' THEN 1 END) AS mismatch, count(CASE WHEN k = 'only_a' THEN 1 END) AS only_a, count(CASE WHEN k = 'only_b' THEN 1 END) AS only_b,
       CASE WHEN count(CASE WHEN k IN ('mismatch', 'only_a') THEN 1 END) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM k""")

register("transactions_verdict", lambda f: cmp.transactions_verdict(b_(f), a_(f), [1, 2, 3, 4, 5]), f"""
WITH p AS ({PAIRED}),
k AS (SELECT CASE WHEN status = 'only_a' THEN 'only_b' WHEN status = 'only_b' THEN 'only_a' WHEN status = 'shared' THEN status WHEN columns = 'access_list' AND lb IS NULL THEN 'access_list_gap' ELSE 'mismatch' END AS k FROM p)
SELECT count(CASE WHEN k = 'shared' THEN 1 END) AS shared, count(CASE WHEN k = 'access_list_gap' THEN 1 END) AS access_list_gap, count(CASE WHEN k = 'mismatch' THEN 1 END) AS mismatch,
       count(CASE WHEN k = 'only_a' THEN 1 END) AS only_a, count(CASE WHEN k = 'only_b' THEN 1 END) AS only_b,
       CASE WHEN count(CASE WHEN k IN ('mismatch', 'only_a', 'only_b') THEN 1 END) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM k""")

FLOORS = "(SELECT chain_id, chain_id * 20 AS floor, finalized AS window_end FROM {heads} WHERE chain_id <> 4)"
register("classify_only_b", lambda f: cmp.classify_only_b(headers_a(f), f.headers, floors(f)), f"""
SELECT b.chain_id, b.block_number, CASE WHEN coalesce(b.block_number BETWEEN f.floor AND f.window_end, FALSE) THEN 'tolerated' ELSE 'hard' END AS class
FROM {{headers}} b LEFT JOIN {FLOORS} f ON f.chain_id = b.chain_id WHERE b.block_number % 59 = 1""")


def _a_holes(f: Fixtures) -> DataFrame:
    """Store a without some blocks as a whole."""
    return a_(f).where("block_number % 37 <> 5")


ONLY_B_TX = f"""SELECT b.chain_id, b.block_number, b.transaction_index,
  CASE WHEN coalesce(b.block_number BETWEEN f.floor AND f.window_end, FALSE) AND NOT EXISTS (SELECT 1 FROM {{store_a}} x WHERE x.block_number % 37 <> 5 AND x.chain_id = b.chain_id AND x.block_number = b.block_number) THEN 'tolerated' ELSE 'hard' END AS class
  FROM {{store_b}} b LEFT JOIN {FLOORS} f ON f.chain_id = b.chain_id
  WHERE NOT EXISTS (SELECT 1 FROM {{store_a}} a WHERE a.block_number % 37 <> 5 AND {ON})"""
register("classify_only_b_tx", lambda f: cmp.classify_only_b_tx(_a_holes(f), b_(f), _a_holes(f), floors(f)), ONLY_B_TX)


def _b_lists(f: Fixtures) -> DataFrame:
    """Store b with other lists for some transactions, so that both lists are concrete."""
    return b_(f).withColumn("access_list", F.when(F.col("transaction_index") % 6 == 1, F.concat("access_list", F.lit("x"))).otherwise(F.col("access_list")))


SHARED_TX = f"""SELECT a.chain_id, a.block_number, a.transaction_index, a.tx_hash, a.value_units <> b.value_units AS v, a.access_list AS la,
  CASE WHEN a.transaction_index % 6 = 1 THEN b.access_list || 'x' ELSE b.access_list END AS lb FROM {{store_b}} b JOIN {{store_a}} a ON {ON}"""
register("classify_shared_tx", lambda f: cmp.classify_shared_tx(_b_lists(f), a_(f), pins(f)), f"""
SELECT chain_id, block_number, transaction_index,
       CASE WHEN v THEN 'mismatch' WHEN la IS NOT NULL AND lb IS NOT NULL AND tx_hash IN (SELECT tx_hash FROM {{tx}} WHERE order_key % 142 = 0) THEN 'pinned' WHEN lb IS NULL THEN 'a-null' ELSE 'mismatch' END AS class
FROM ({SHARED_TX}) s WHERE v OR la IS DISTINCT FROM lb""")

register("classify_tx_diff", lambda f: cmp.classify_tx_diff(a_(f), b_(f), f.logs.where("event_code <> 'NO'")), f"""
SELECT p.chain_id, p.block_number, p.transaction_index, CASE WHEN status = 'only_a' AND u.h IS NOT NULL THEN 'referenced' WHEN status = 'only_a' THEN 'unreferenced' ELSE status END AS class,
       NOT (status = 'only_a' AND u.h IS NOT NULL) AS fails
FROM ({PAIRED}) p LEFT JOIN (SELECT DISTINCT tx_hash AS h FROM {{logs}} WHERE event_code <> 'NO') u ON u.h = p.tx_hash WHERE status <> 'shared'""")

DIGESTED = ["chain_id", "block_number", "transaction_index", "tx_hash", "from_address", "to_address", "value_units", "access_list"]
A_BUCKETS = digest_sql("{store_a}", DIGESTED, ["block_number", "transaction_index"], 10)
B_BUCKETS = digest_sql("(SELECT * FROM {store_b} WHERE block_number > 20) q", DIGESTED, ["block_number", "transaction_index"], 10)
register("compare_buckets", lambda f: cmp.compare_buckets(agg.bucket_digest(a_(f), TX, width=10), agg.bucket_digest(b_(f).where("block_number > 20"), TX, width=10)), f"""
SELECT coalesce(a.chain_id, b.chain_id) AS chain_id, coalesce(a.bucket, b.bucket) AS bucket, CASE WHEN a.digest IS NULL OR b.digest IS NULL THEN 'edge' WHEN a.digest = b.digest THEN 'match' ELSE 'mismatch' END AS status
FROM ({A_BUCKETS}) a FULL OUTER JOIN ({B_BUCKETS}) b ON a.chain_id = b.chain_id AND a.bucket = b.bucket""")

register(
    "explain_buckets",
    lambda f: cmp.explain_buckets(a_(f).where("transaction_index <> 3 AND NOT (transaction_index = 4 AND block_number % 20 = 7)"), a_(f), f.tx.where("transaction_index = 3"), TX, width=10),
    f"""
WITH a AS ({digest_sql("(SELECT * FROM {store_a} WHERE transaction_index <> 3 AND NOT (transaction_index = 4 AND block_number % 20 = 7)) q", DIGESTED, ["block_number", "transaction_index"], 10)}),
b AS ({A_BUCKETS}), e AS ({digest_sql("(SELECT * FROM {store_a} WHERE transaction_index <> 3) q", DIGESTED, ["block_number", "transaction_index"], 10)})
SELECT a.chain_id, a.bucket, coalesce(a.digest = e.digest, FALSE) AS explained FROM a JOIN b ON a.chain_id = b.chain_id AND a.bucket = b.bucket
LEFT JOIN e ON e.chain_id = a.chain_id AND e.bucket = a.bucket WHERE a.digest <> b.digest""",
)


def cutovers(f: Fixtures) -> DataFrame:
    return f.heads.select("chain_id", (F.col("finalized") - 100 + F.col("chain_id") * 40).alias("cutover"))


OVERLAP = """SELECT h.chain_id, h.finalized - 100 + h.chain_id * 40 AS lo, least(a.m, b.m) - 5 AS hi, greatest(a.m, b.m) - a.m AS lag_a, greatest(a.m, b.m) - b.m AS lag_b,
  CASE WHEN coalesce(least(a.m, b.m) - 5 >= h.finalized - 100 + h.chain_id * 40, FALSE) THEN 'READY' ELSE 'PENDING' END AS state
  FROM {heads} h LEFT JOIN (SELECT chain_id, max(block_number) AS m FROM {store_a} GROUP BY chain_id) a ON a.chain_id = h.chain_id
  LEFT JOIN (SELECT chain_id, max(block_number) AS m FROM {store_b} GROUP BY chain_id) b ON b.chain_id = h.chain_id"""
register("overlap_window", lambda f: cmp.overlap_window(a_(f), b_(f), cutovers(f), 5), OVERLAP)



def lost(f: Fixtures, df: DataFrame) -> DataFrame:
    """``df`` without the blocks that side a lost: some of chain 1 up to its finalized head, some of chain 3."""
    ends = f.heads.select("chain_id", F.col("finalized").alias("__end"))
    gone = "block_number % 9 = 4 AND (chain_id = 3 OR chain_id = 1 AND block_number <= __end)"
    return df.join(ends, "chain_id", "left").where(f"NOT coalesce({gone}, false)").select(*df.columns)


def whole_chain(f: Fixtures) -> DataFrame:
    """Chain 1 lost blocks with all that is in them, which is tolerated; chain 2 has other transactions and logs; chain 3
    lost blocks beyond what is tolerated; chains 4 and 5 have no overlap, and progress fails on the latter."""
    logs = f.logs.select("chain_id", "block_number", "log_index", "address", "data")
    other = logs.withColumn("data", F.when((F.col("chain_id") == 2) & (F.col("log_index") == 5), "0x").otherwise(F.col("data")))
    headers = f.headers.select(*BLOCK, "block_hash", "parent_hash")
    failing = f.heads.select("chain_id", F.col("end_block").isNull().alias("failing"))
    a = a_(f).where("chain_id <> 2").unionByName(b_(f).where("chain_id = 2"))
    others = {"logs": (lost(f, other), logs, LOG), "blocks": (lost(f, headers), headers, BLOCK)}
    return cmp.compare_chain(lost(f, a), a_(f), cutovers(f), floors(f), pins(f), 5, failing, others, width=10)


GONE = "(x.block_number % 9 = 4 AND (x.chain_id = 3 OR x.chain_id = 1 AND x.block_number <= h.finalized))"
LOST = "(SELECT x.* FROM ({}) x JOIN {{heads}} h ON h.chain_id = x.chain_id WHERE NOT " + GONE + ")"
SIDE_A = LOST.format("SELECT * FROM {store_a} WHERE chain_id <> 2 UNION ALL SELECT * FROM {store_b} WHERE chain_id = 2")


def family_sql(name: str, rows: str, changed: str) -> str:
    """Differences of a family by row over the overlap, and by bucket."""
    return f"""{name}_rows AS (
  SELECT x.chain_id, floor(x.block_number / 10.0) AS bucket, CASE WHEN NOT {GONE} THEN 'mismatch' WHEN coalesce(x.block_number BETWEEN f.floor AND f.window_end, FALSE) THEN 'tolerated' ELSE 'hard' END AS k
  FROM {rows} x JOIN o ON o.chain_id = x.chain_id AND o.state = 'READY' AND x.block_number BETWEEN o.lo AND o.hi JOIN {{heads}} h ON h.chain_id = x.chain_id LEFT JOIN {FLOORS} f ON f.chain_id = x.chain_id
  WHERE {GONE} OR {changed}),
{name}_n AS (
  SELECT chain_id, count(*) FILTER (WHERE k = 'tolerated') AS tolerated_{name}, count(*) FILTER (WHERE k = 'hard') AS hard_{name}, count(*) FILTER (WHERE k = 'mismatch') AS mismatch_{name},
         count(DISTINCT bucket) AS buckets_{name}, count(DISTINCT bucket) - count(DISTINCT CASE WHEN k <> 'tolerated' THEN bucket END) AS explained_{name} FROM {name}_rows GROUP BY chain_id)"""


# the window is cut by the newest rows of both sides; a wedged side fails a chain that has no overlap; only rows that b has,
# at the floor or above it, are tolerated, and of transactions those of blocks that a lacks
register("compare_chain", whole_chain, f"""
WITH sa AS (SELECT * FROM {SIDE_A}),
o AS (SELECT h.chain_id, h.finalized - 100 + h.chain_id * 40 AS lo, least(a.m, b.m) - 5 AS hi, CASE WHEN coalesce(least(a.m, b.m) - 5 >= h.finalized - 100 + h.chain_id * 40, FALSE) THEN 'READY' ELSE 'PENDING' END AS state
  FROM {{heads}} h LEFT JOIN (SELECT chain_id, max(block_number) AS m FROM sa GROUP BY chain_id) a ON a.chain_id = h.chain_id
  LEFT JOIN (SELECT chain_id, max(block_number) AS m FROM {{store_a}} GROUP BY chain_id) b ON b.chain_id = h.chain_id),
{family_sql("logs", "{logs}", "x.chain_id = 2 AND x.log_index = 5")},
{family_sql("blocks", "{headers}", "FALSE")},
p AS (SELECT coalesce(a.chain_id, b.chain_id) AS chain_id, coalesce(a.block_number, b.block_number) AS block_number, coalesce(a.tx_hash, b.tx_hash) AS tx_hash, a.access_list AS la, b.access_list AS lb,
  CASE WHEN a.chain_id IS NULL THEN 'only_b' WHEN b.chain_id IS NULL THEN 'only_a' WHEN {DIFFERS} = '' THEN 'shared' ELSE 'mismatch' END AS status,
  CASE WHEN a.chain_id IS NOT NULL AND b.chain_id IS NOT NULL THEN {DIFFERS} END AS columns FROM sa a FULL OUTER JOIN {{store_a}} b ON {ON}),
k AS (SELECT x.chain_id, x.status, CASE
    WHEN status = 'only_b' THEN CASE WHEN {GONE} AND coalesce(x.block_number BETWEEN f.floor AND f.window_end, FALSE) THEN 'fine' ELSE 'hard' END
    WHEN status = 'mismatch' THEN CASE WHEN columns = 'access_list' AND la IS NOT NULL AND lb IS NOT NULL AND tx_hash IN (SELECT tx_hash FROM {{tx}} WHERE order_key % 142 = 0) THEN 'pinned' WHEN columns = 'access_list' AND la IS NULL THEN 'null' ELSE 'mismatch' END
    ELSE status END AS k
  FROM p x JOIN o ON o.chain_id = x.chain_id AND o.state = 'READY' AND x.block_number BETWEEN o.lo AND o.hi JOIN {{heads}} h ON h.chain_id = x.chain_id LEFT JOIN {FLOORS} f ON f.chain_id = x.chain_id),
n AS (SELECT o.chain_id, o.lo, o.hi, o.state, count(*) FILTER (WHERE k = 'fine') AS only_b_tolerated, count(*) FILTER (WHERE k = 'hard') AS only_b_hard, count(*) FILTER (WHERE k = 'pinned') AS pinned,
        count(*) FILTER (WHERE k = 'null') AS a_null, count(*) FILTER (WHERE k = 'mismatch') AS mismatch, count(*) FILTER (WHERE k = 'only_a') AS only_a, count(*) FILTER (WHERE status <> 'only_b') AS compared
      FROM o LEFT JOIN k ON k.chain_id = o.chain_id GROUP BY o.chain_id, o.lo, o.hi, o.state),
m AS (SELECT n.*, coalesce(tolerated_logs, 0) AS tolerated_logs, coalesce(hard_logs, 0) AS hard_logs, coalesce(mismatch_logs, 0) AS mismatch_logs, 0 AS only_a_logs, coalesce(buckets_logs, 0) AS buckets_logs, coalesce(explained_logs, 0) AS explained_logs,
        coalesce(tolerated_blocks, 0) AS tolerated_blocks, coalesce(hard_blocks, 0) AS hard_blocks, coalesce(mismatch_blocks, 0) AS mismatch_blocks, 0 AS only_a_blocks, coalesce(buckets_blocks, 0) AS buckets_blocks, coalesce(explained_blocks, 0) AS explained_blocks
      FROM n LEFT JOIN logs_n ON logs_n.chain_id = n.chain_id LEFT JOIN blocks_n ON blocks_n.chain_id = n.chain_id)
SELECT chain_id, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi, only_b_tolerated, only_b_hard, pinned, a_null, mismatch, only_a, compared, tolerated_logs, hard_logs, mismatch_logs, only_a_logs, buckets_logs, explained_logs,
       tolerated_blocks, hard_blocks, mismatch_blocks, only_a_blocks, buckets_blocks, explained_blocks,
       CASE WHEN state = 'PENDING' THEN CASE WHEN chain_id = 5 THEN 'FAIL' ELSE 'PENDING' END
            WHEN chain_id = 5 OR only_b_hard + mismatch + only_a + hard_logs + mismatch_logs + hard_blocks + mismatch_blocks > 0 THEN 'FAIL'
            WHEN compared = 0 THEN 'PENDING' ELSE 'PASS' END AS verdict FROM m""")


def kept_trees(f: Fixtures) -> DataFrame:
    """Where two stores' kept digest trees differ: four buckets of blocks a node."""
    a, b = (agg.bucket_digest(s, TX, width=10) for s in (a_(f), b_(f)))
    return cmp.differing_buckets(cmp.digest_tree(a, 4), cmp.digest_tree(b, 4), 4)


register("differing_buckets", kept_trees, f"""
WITH a AS ({A_BUCKETS}), b AS ({digest_sql("{store_b}", DIGESTED, ["block_number", "transaction_index"], 10)})
SELECT coalesce(a.chain_id, b.chain_id) AS chain_id, coalesce(a.bucket, b.bucket) AS bucket FROM a FULL OUTER JOIN b ON a.chain_id = b.chain_id AND a.bucket = b.bucket WHERE a.digest IS DISTINCT FROM b.digest""")

register("parity_report", lambda f: cmp.parity_report(agg.store_snapshot(f.blocks, f.tx, f.logs), agg.store_snapshot(f.blocks, f.tx.where("chain_id <> 5"), f.logs.where("chain_id <> 5"))), f"""
WITH s AS ({SNAPSHOT}),
c AS (SELECT scope, field, value AS bench, CASE WHEN scope = 'chain-5' THEN NULL WHEN field = 'transactions' THEN (SELECT count(*) FROM {{tx}} WHERE chain_id <> 5) ELSE value END AS reference FROM s)
SELECT scope, field, bench, reference, coalesce(bench = reference, FALSE) AS match FROM c
UNION ALL SELECT 'overall', 'all', NULL, NULL, bool_and(coalesce(bench = reference, FALSE)) FROM c""")
