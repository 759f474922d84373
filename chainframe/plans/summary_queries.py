"""Queries of aggregates, windows, order and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.fixtures import Fixtures
from chainframe.operators import aggregates as agg
from chainframe.operators import joins
from chainframe.operators import windows as win
from chainframe.plans.match_queries import LABELLED, LOG, RANKED, TX, call_frames, labels
from chainframe.plans.registry import register
from chainframe.plans.sources_queries import POSITIONS, _positions

register("closest_block", lambda f: agg.closest_block(f.logs.where("event_code = 'RF'"), f.tx.where("status = 0"), f.frames.where("own_error IS NOT NULL")), """
SELECT chain_id, max(block_number) AS closest_block FROM (
  SELECT chain_id, block_number FROM {logs} WHERE event_code = 'RF' UNION ALL SELECT chain_id, block_number FROM {tx} WHERE status = 0
  UNION ALL SELECT chain_id, block_number FROM {frames} WHERE own_error IS NOT NULL) u GROUP BY chain_id""")

# whole tables; families differ by columns
register("closest_block_all", lambda f: agg.closest_block(f.logs.where("event_code <> 'NO'"), f.tx.where("status = 1"), f.frames.where("own_error IS NOT NULL")), """
SELECT chain_id, max(block_number) AS closest_block FROM (
  SELECT chain_id, block_number FROM {logs} WHERE event_code <> 'NO' UNION ALL SELECT chain_id, block_number FROM {tx} WHERE status = 1
  UNION ALL SELECT chain_id, block_number FROM {frames} WHERE own_error IS NOT NULL) u GROUP BY chain_id""")

SNAPSHOT = """
WITH p AS (SELECT chain_id, count(*) AS logs, min(block_number) AS min_block, max(block_number) AS max_block, count(DISTINCT tx_hash) AS distinct_tx FROM {logs} GROUP BY chain_id)
SELECT 'chain-' || CAST(chain_id AS STRING) AS scope, 'logs' AS field, logs AS value FROM p
UNION ALL SELECT 'chain-' || CAST(chain_id AS STRING), 'min_block', min_block FROM p UNION ALL SELECT 'chain-' || CAST(chain_id AS STRING), 'max_block', max_block FROM p
UNION ALL SELECT 'chain-' || CAST(chain_id AS STRING), 'distinct_tx', distinct_tx FROM p
UNION ALL SELECT 'store', 'blocks', count(*) FROM {blocks} UNION ALL SELECT 'store', 'transactions', count(*) FROM {tx}"""
register("store_snapshot", lambda f: agg.store_snapshot(f.blocks, f.tx, f.logs), SNAPSHOT)

register("events_per_label", lambda f: agg.events_per_label(joins.label_events(f.logs, labels(f))), f"SELECT label, count(*) AS n FROM ({LABELLED}) m GROUP BY label")
register("action_counters", lambda f: agg.action_counters(f.logs, "event_code"), "SELECT event_code AS action, count(*) AS n FROM {logs} GROUP BY event_code UNION ALL SELECT 'global', count(*) FROM {logs}")

register(
    "vault_event_counts",
    lambda f: agg.vault_event_counts(f.creations.select("chain_id", F.col("child").alias("vault")), f.logs.where("event_code = 'NF'").select("chain_id", F.col("address").alias("vault"))),
    """
SELECT CAST(c.chain_id AS STRING) || ':' || c.child AS id, count(l.log_index) AS event_count
FROM {creations} c LEFT JOIN {logs} l ON l.chain_id = c.chain_id AND l.address = c.child AND l.event_code = 'NF' GROUP BY c.chain_id, c.child""",
)

register(
    "total_counts",
    lambda f: agg.total_counts({"tx": (f.tx, {"chain 2": F.col("chain_id") == 2, "type 1": F.col("tx_type") == 1}), "logs": (f.logs, {"chain 2": F.col("chain_id") == 2})}),
    """
SELECT 'tx' AS name, 'all' AS filter, count(*) AS total FROM {tx} UNION ALL SELECT 'tx', 'chain 2', count(*) FROM {tx} WHERE chain_id = 2
UNION ALL SELECT 'tx', 'type 1', count(*) FROM {tx} WHERE tx_type = 1 UNION ALL SELECT 'logs', 'all', count(*) FROM {logs} UNION ALL SELECT 'logs', 'chain 2', count(*) FROM {logs} WHERE chain_id = 2""",
)


def digest_sql(table: str, columns: list[str], order: list[str], width: int = 100) -> str:
    h = "md5(" + " || '|' || ".join(f"coalesce(CAST({c} AS STRING), '<null>')" for c in columns) + ")"
    return f"""SELECT chain_id, CAST(floor(block_number / {width}.0) AS BIGINT) AS bucket, count(*) AS n_rows, md5(string_agg(h, '' ORDER BY {', '.join(order)}, h)) AS digest
  FROM (SELECT *, {h} AS h FROM {table}) x GROUP BY chain_id, CAST(floor(block_number / {width}.0) AS BIGINT)"""


TX_COLUMNS = ["chain_id", "block_number", "transaction_index", "tx_hash", "to_address", "value_units"]
LOG_COLUMNS = ["chain_id", "block_number", "log_index", "address", "data"]
TX_DIGEST = digest_sql("{tx}", TX_COLUMNS, ["block_number", "transaction_index"])
LOG_DIGEST = digest_sql("{logs}", LOG_COLUMNS, ["block_number", "log_index"])

register("bucket_digest", lambda f: agg.bucket_digest(f.tx.select(*TX_COLUMNS, "order_key"), TX, exclude=("order_key",), width=100), TX_DIGEST)


def tables_sql(*named: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, CAST(sum(n_rows) AS BIGINT) AS n_rows,
  md5(string_agg(CAST(chain_id AS STRING) || ':' || CAST(part AS STRING) || ':' || digest, chr(10) ORDER BY chain_id, part)) AS digest FROM (
    SELECT chain_id, CAST(floor(bucket / {agg.FAN}.0) AS BIGINT) AS part, sum(n_rows) AS n_rows,
           md5(string_agg(CAST(chain_id AS STRING) || ':' || CAST(bucket AS STRING) || ':' || digest, chr(10) ORDER BY bucket)) AS digest
    FROM ({q}) d{k} GROUP BY chain_id, CAST(floor(bucket / {agg.FAN}.0) AS BIGINT)) g{k}"""
        for k, (n, q) in enumerate(named)
    )


def digests(f: Fixtures) -> list[DataFrame]:
    return [agg.table_digest(f.tx.select(*TX_COLUMNS), "transactions", TX, width=100), agg.table_digest(f.logs.select(*LOG_COLUMNS), "logs", LOG, width=100)]


register("table_digest", lambda f: digests(f)[0], tables_sql(("transactions", TX_DIGEST)))
register("store_digest", lambda f: agg.store_digest(digests(f)), f"""
SELECT count(*) AS tables, md5(string_agg(table_name || '=' || digest || ':' || CAST(n_rows AS STRING), chr(10) ORDER BY table_name)) AS digest
FROM ({tables_sql(("transactions", TX_DIGEST), ("logs", LOG_DIGEST))}) t""")
register(
    "app_digest",
    lambda f: agg.app_digest({"swaps": (f.logs.select(*LOG_COLUMNS), LOG), "_internal": (f.tx.select(*TX_COLUMNS), TX), "none": (f.logs.select(*LOG_COLUMNS).where("chain_id > 9"), LOG)}, width=100),
    f"""
SELECT 'DIGEST' AS verdict, count(*) AS tables, CAST(sum(n_rows) AS BIGINT) AS n_rows, md5(string_agg(table_name || '=' || digest || ':' || CAST(n_rows AS STRING), chr(10))) AS digest
FROM ({tables_sql(("swaps", LOG_DIGEST))}) t""",
)

register("latency_percentiles", lambda f: agg.latency_percentiles(f.requests, ["chain_id", "endpoint"]), """
WITH g AS (SELECT chain_id, endpoint, latency, row_number() OVER (PARTITION BY chain_id, endpoint ORDER BY latency) - 1 AS r, count(*) OVER (PARTITION BY chain_id, endpoint) AS m FROM {requests} WHERE ok = 1),
p AS (SELECT chain_id, endpoint, """ + ", ".join(f"min(CASE WHEN r = least(m - 1, CAST(floor({q} * m) AS BIGINT)) THEN latency END) AS {n}" for n, q in agg.PERCENTILES) + """ FROM g GROUP BY chain_id, endpoint)
SELECT t.chain_id, t.endpoint, count(*) AS n, round(avg(CAST(ok AS DOUBLE)), 6) AS ok_rate, round(avg(CASE WHEN ok = 1 THEN latency END), 6) AS mean_latency, max(CASE WHEN ok = 0 THEN at_s END) AS last_error_at,
       min(p50) AS p50, min(p90) AS p90, min(p95) AS p95, min(p99) AS p99
FROM {requests} t LEFT JOIN p ON p.chain_id = t.chain_id AND p.endpoint = t.endpoint GROUP BY t.chain_id, t.endpoint""")

register("tip_lag", lambda f: agg.tip_lag(f.requests.groupBy("chain_id", "endpoint").agg(F.max("at_s").alias("head"))), """
WITH h AS (SELECT chain_id, endpoint, max(at_s) AS head FROM {requests} GROUP BY chain_id, endpoint)
SELECT h.chain_id, h.endpoint, h.head, m.m - h.head AS lag FROM h JOIN (SELECT chain_id, max(head) AS m FROM h GROUP BY chain_id) m ON m.chain_id = h.chain_id""")


def counters(f: Fixtures) -> DataFrame:
    """Cumulative counters: at request k, k * 3 rows, k * k bytes."""
    return f.requests.select(F.col("at_s"), (F.col("at_s") * 3).alias("rows"), (F.col("at_s") * F.col("at_s")).alias("bytes"), F.floor(F.col("at_s") * F.col("at_s") / 4000).cast("long").alias("errors"))


register("throughput", lambda f: agg.throughput(counters(f), 100, 1.5), """
WITH b AS (SELECT CAST(floor(at_s / 100.0) AS BIGINT) AS bucket, max(at_s * 3) AS r, max(at_s * at_s) AS y, max(CAST(floor(at_s * at_s / 4000.0) AS BIGINT)) AS e FROM {requests} GROUP BY CAST(floor(at_s / 100.0) AS BIGINT)),
d AS (SELECT bucket, round((r - coalesce(lag(r) OVER (ORDER BY bucket), 0)) / 100.0, 6) AS rows_per_s, round((y - coalesce(lag(y) OVER (ORDER BY bucket), 0)) / 100.0 / 1e6, 6) AS mb_per_s,
             round((e - coalesce(lag(e) OVER (ORDER BY bucket), 0)) / 100.0, 6) AS errors_per_s FROM b)
SELECT bucket, CAST(rows_per_s AS DOUBLE) AS rows_per_s, CAST(mb_per_s AS DOUBLE) AS mb_per_s, CAST(errors_per_s AS DOUBLE) AS errors_per_s,
       coalesce(bucket = (SELECT min(bucket) FROM d WHERE errors_per_s > 1.5), FALSE) AS first_over_errors,
       bucket = (SELECT bucket FROM d ORDER BY rows_per_s DESC, bucket LIMIT 1) AS peak FROM d""")

register(
    "dataset_rates",
    lambda f: agg.dataset_rates(f.requests.select(F.concat(F.lit("d"), F.col("chain_id").cast("string")).alias("dataset"), F.lit(1).cast("long").alias("requests"), (F.col("at_s") % 50 + 1).alias("blocks"), (F.col("at_s") % 3 + 1).alias("seconds"), "bytes", (1 - F.col("ok")).cast("long").alias("errors"))),
    """
WITH s AS (SELECT 'd' || CAST(chain_id AS STRING) AS dataset, count(*) AS requests, sum(at_s % 50 + 1) AS blocks, sum(at_s % 3 + 1) AS seconds, sum(bytes) AS bytes, sum(1 - ok) AS errors FROM {requests} GROUP BY chain_id
  UNION ALL SELECT 'total', count(*), sum(at_s % 50 + 1), sum(at_s % 3 + 1), sum(bytes), sum(1 - ok) FROM {requests})
SELECT dataset, requests, CAST(blocks AS BIGINT) AS blocks, CAST(errors AS BIGINT) AS errors, round(CAST(requests AS DOUBLE) * 1000.0 / CAST(blocks AS DOUBLE), 3) AS requests_per_1000_blocks,
       round(CAST(blocks AS DOUBLE) / CAST(seconds AS DOUBLE), 3) AS blocks_per_s, round(CAST(bytes AS DOUBLE) / 1048576.0, 3) AS mib, round(CAST(requests AS DOUBLE) * 10.0 / 1e6, 6) AS cost FROM s""",
)


def gate_inputs(f: Fixtures) -> tuple[DataFrame, DataFrame]:
    m = f.logs.groupBy(F.col("event_code").alias("name")).agg(F.count("*").cast("double").alias("value"))
    b = f.signatures.select(F.col("code").alias("name"), F.when(F.col("code") != "AO", 1.0).alias("at_least"), F.when(F.col("code") == "NO", 10.0).alias("at_most"))
    return m, b.unionByName(f.spark.range(1).select(F.lit("ZZ").alias("name"), F.lit(0.0).alias("at_least"), F.lit(None).cast("double").alias("at_most")))


register("gate_check", lambda f: agg.gate_check(*gate_inputs(f)), """
WITH m AS (SELECT event_code AS name, CAST(count(*) AS DOUBLE) AS value FROM {logs} GROUP BY event_code),
b AS (SELECT code AS name, CASE WHEN code <> 'AO' THEN 1.0 END AS lo, CASE WHEN code = 'NO' THEN 10.0 END AS hi FROM {signatures} UNION ALL SELECT 'ZZ', 0.0, NULL),
e AS (SELECT b.name, m.value, CASE WHEN m.value IS NOT NULL AND (lo IS NULL OR value >= lo) AND (hi IS NULL OR value <= hi) THEN 'PASS' ELSE 'FAIL' END AS verdict FROM b LEFT JOIN m ON m.name = b.name)
SELECT * FROM e UNION ALL SELECT 'overall', NULL, CASE WHEN bool_and(verdict = 'PASS') THEN 'PASS' ELSE 'FAIL' END FROM e""")

register("trailing_rate", lambda f: agg.trailing_rate(f.requests.select(F.col("chain_id").alias("source"), F.col("at_s")), now=9000, span=16, most=3), """
SELECT chain_id AS source, count(*) AS n, max(at_s) AS last_at, CAST(sum(CASE WHEN at_s > 8984 AND at_s <= 9000 THEN 1 ELSE 0 END) AS BIGINT) AS recent,
       sum(CASE WHEN at_s > 8984 AND at_s <= 9000 THEN 1 ELSE 0 END) > 3 AS flagged FROM {requests} GROUP BY chain_id""")


def windows_of(f: Fixtures) -> DataFrame:
    return f.blocks.select("chain_id", (F.floor(F.col("block_number") / 40) * 40).cast("long").alias("lo")).distinct().withColumn("hi", F.col("lo") + 49)


register("window_completeness", lambda f: agg.window_completeness(windows_of(f), f.logs.where("log_index <> 33"), f.logs), """
WITH w AS (SELECT DISTINCT chain_id, CAST(floor(block_number / 40.0) * 40 AS BIGINT) AS lo FROM {blocks})
SELECT w.chain_id, w.lo, w.lo + 49 AS hi, count(CASE WHEN l.log_index <> 33 THEN 1 END) AS indexed, count(l.log_index) AS truth, count(CASE WHEN l.log_index <> 33 THEN 1 END) = count(l.log_index) AS complete
FROM w LEFT JOIN {logs} l ON l.chain_id = w.chain_id AND l.block_number BETWEEN w.lo AND w.lo + 49 GROUP BY w.chain_id, w.lo""")



def children_of(f: Fixtures, code: str) -> DataFrame:
    """Created contracts that have a log of this kind."""
    return f.creations.join(f.logs.where(F.col("event_code") == code).select("chain_id", F.col("address").alias("child")), ["chain_id", "child"], "left_semi")


register(
    "child_coverage_vs_reference",
    lambda f: agg.child_coverage_vs_reference(children_of(f, "RO"), children_of(f, "NO"), f.heads, f.logs.where("event_code = 'NF' AND line_no = 1")),
    """
WITH r AS (SELECT c.chain_id, c.child, c.created_block, h.finalized,
    EXISTS (SELECT 1 FROM {logs} l WHERE l.chain_id = c.chain_id AND l.address = c.child AND l.event_code = 'RO') AS found,
    EXISTS (SELECT 1 FROM {logs} l WHERE l.chain_id = c.chain_id AND l.address = c.child AND l.event_code = 'NO') AS known,
    EXISTS (SELECT 1 FROM {logs} l WHERE l.chain_id = c.chain_id AND l.address = c.child AND l.event_code = 'NF' AND l.line_no = 1) AS active
  FROM {creations} c LEFT JOIN {heads} h ON h.chain_id = c.chain_id)
SELECT chain_id, class, count(*) AS n FROM (
  SELECT chain_id, CASE WHEN found AND NOT known THEN 'extra' WHEN found THEN 'found' WHEN created_block > finalized THEN 'after-head' WHEN NOT active THEN 'event-less' ELSE 'missing' END AS class
  FROM r WHERE found OR known) u GROUP BY chain_id, class""",
)

# discovered children have a seventh-line AF log, the reference's a second RF log; heads are the chains' own
register(
    "child_coverage_vs_reference_all",
    lambda f: agg.child_coverage_vs_reference(
        f.creations.join(f.logs.where("event_code = 'AF' AND line_no = 7").select("chain_id", F.col("address").alias("child")), ["chain_id", "child"], "left_semi"),
        f.creations.join(f.logs.where("event_code = 'RF' AND line_no = 2").select("chain_id", F.col("address").alias("child")), ["chain_id", "child"], "left_semi"),
        f.heads,
        f.logs.where("event_code = 'NF'"),
    ),
    """
WITH r AS (SELECT c.chain_id, c.child, c.created_block, h.finalized,
    EXISTS (SELECT 1 FROM {logs} l WHERE l.chain_id = c.chain_id AND l.address = c.child AND l.event_code = 'AF' AND l.line_no = 7) AS found,
    EXISTS (SELECT 1 FROM {logs} l WHERE l.chain_id = c.chain_id AND l.address = c.child AND l.event_code = 'RF' AND l.line_no = 2) AS known,
    EXISTS (SELECT 1 FROM {logs} l WHERE l.chain_id = c.chain_id AND l.address = c.child AND l.event_code = 'NF') AS active
  FROM {creations} c LEFT JOIN {heads} h ON h.chain_id = c.chain_id)
SELECT chain_id, class, count(*) AS n FROM (
  SELECT chain_id, CASE WHEN found AND NOT known THEN 'extra' WHEN found THEN 'found' WHEN created_block > finalized THEN 'after-head' WHEN NOT active THEN 'event-less' ELSE 'missing' END AS class
  FROM r WHERE found OR known) u GROUP BY chain_id, class""",
)

# --- windows ------------------------------------------------------------------------------------------------------

register("rank_traces", lambda f: call_frames(f).select(*TX, "frame_key", "trace_index"), f"SELECT chain_id, block_number, transaction_index, frame_key, trace_index FROM ({RANKED}) r")
register("dedupe_first", lambda f: win.dedupe_first([f.tx.where("tx_type = 2").select("tx_hash"), f.tx.where("status = 1").select("tx_hash"), f.tx.select("tx_hash")], ["tx_hash"]), """
SELECT tx_hash, CASE WHEN tx_type = 2 THEN 0 WHEN status = 1 THEN 1 ELSE 2 END AS branch FROM {tx}""")

ISLANDS = """
SELECT fragment_id, min(lo) AS lo, max(hi) AS hi FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY fragment_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, max(hi) OVER (PARTITION BY fragment_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {intervals}) a) b
GROUP BY fragment_id, island"""


def wanted(f: Fixtures, hi: int = 900) -> DataFrame:
    """Fragments' wanted ranges, and one fragment that has no intervals."""
    own = f.intervals.select("fragment_id").distinct()
    return own.unionByName(f.spark.range(1).select(F.lit(-1).cast(own.schema["fragment_id"].dataType).alias("fragment_id"))).select("fragment_id", F.lit(100).cast("long").alias("want_lo"), F.lit(hi).cast("long").alias("want_hi"))


WANTED = "(SELECT fragment_id, 100 AS want_lo, 900 AS want_hi FROM (SELECT DISTINCT fragment_id FROM {intervals} UNION ALL SELECT -1) q)"
register("coalesce_intervals", lambda f: win.coalesce_intervals(f.intervals), ISLANDS)
register("missing_ranges", lambda f: win.missing_ranges(f.intervals, wanted(f)), f"""
WITH c AS (SELECT fragment_id, greatest(lo, 100) AS lo, least(hi, 900) AS hi FROM ({ISLANDS}) i WHERE lo < 900 AND hi > 100),
g AS (SELECT fragment_id, hi AS lo, coalesce(lead(lo) OVER (PARTITION BY fragment_id ORDER BY lo), 900) AS hi FROM c
  UNION ALL SELECT w.fragment_id, 100, coalesce((SELECT min(lo) FROM c WHERE c.fragment_id = w.fragment_id), 900) FROM {WANTED} w)
SELECT fragment_id, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi FROM g WHERE lo < hi""")
REACH = f"""SELECT w.fragment_id, CAST(w.want_lo AS BIGINT) AS want_lo, CAST(coalesce(max(CASE WHEN i.lo <= w.want_lo AND i.hi > w.want_lo THEN i.hi END), w.want_lo) AS BIGINT) AS covered_to
  FROM {WANTED} w LEFT JOIN ({ISLANDS}) i ON i.fragment_id = w.fragment_id GROUP BY w.fragment_id, w.want_lo"""
register("contiguous_coverage", lambda f: win.contiguous_coverage(f.intervals, wanted(f).select("fragment_id", "want_lo")), REACH)
register("coverage_class", lambda f: win.coverage_class(f.intervals, wanted(f)), f"""
SELECT count(*) AS fragments, round(min(CAST(least(covered_to, 900) - 100 AS DOUBLE) / 800) * 100, 2) AS pct,
       CASE WHEN max(covered_to) <= 100 THEN 'empty' WHEN min(covered_to) >= 900 THEN 'complete' ELSE 'partial' END AS coverage FROM ({REACH}) r""")
register("tiling_verdict", lambda f: win.tiling_verdict(f.intervals, wanted(f).withColumn("want_lo", F.col("fragment_id").cast("long")).withColumn("want_hi", F.col("fragment_id") + 40)), f"""
SELECT w.fragment_id, count(i.lo) AS ranges, CASE WHEN count(i.lo) = 1 AND min(i.lo) <= w.fragment_id AND max(i.hi) >= w.fragment_id + 40 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM {WANTED} w LEFT JOIN ({ISLANDS}) i ON i.fragment_id = w.fragment_id GROUP BY w.fragment_id""")

register("checkpoint_monotonic", lambda f: win.checkpoint_monotonic(f.intervals.withColumn("progress", F.col("hi") - F.col("lo") + F.col("lo") / 5), "fragment_id", "lo", "progress"), """
WITH s AS (SELECT fragment_id, lo, hi - lo + CAST(lo AS DOUBLE) / 5 AS p, lag(hi - lo + CAST(lo AS DOUBLE) / 5) OVER (PARTITION BY fragment_id ORDER BY lo) AS b FROM {intervals}),
r AS (SELECT *, row_number() OVER (PARTITION BY fragment_id ORDER BY lo) AS n FROM s WHERE p < b)
SELECT fragment_id, lo AS at, b AS before, p AS after FROM r WHERE n = 1""")
register("checkpoint_progress", lambda f: win.checkpoint_progress(f.heads.select("chain_id"), f.blocks.where("chain_id <> 4 AND tx_count > 2").select("chain_id", F.when(F.col("chain_id") == 2, 0).otherwise(F.col("block_number")).alias("block_number")), f.blocks), """
SELECT h.chain_id, count(c.block_number) AS n_rows, CASE WHEN count(c.block_number) > 0 THEN max(CASE WHEN c.chain_id = 2 THEN 0 ELSE c.block_number END) ELSE (SELECT max(block_number) FROM {blocks} b WHERE b.chain_id = h.chain_id) END AS progress
FROM {heads} h LEFT JOIN {blocks} c ON c.chain_id = h.chain_id AND c.chain_id <> 4 AND c.tx_count > 2 GROUP BY h.chain_id""")
# checkpoints up to each chain's finalised head; chain 4 has none, chain 2's are zero
register("checkpoint_progress_all", lambda f: win.checkpoint_progress(f.heads.select("chain_id"), f.blocks.join(f.heads.select("chain_id", "finalized"), "chain_id").where("chain_id <> 4 AND block_number <= finalized").select("chain_id", F.when(F.col("chain_id") == 2, 0).otherwise(F.col("block_number")).alias("block_number")), f.blocks), """
SELECT h.chain_id, count(c.block_number) AS n_rows, CASE WHEN count(c.block_number) > 0 THEN max(CASE WHEN c.chain_id = 2 THEN 0 ELSE c.block_number END) ELSE (SELECT max(block_number) FROM {blocks} b WHERE b.chain_id = h.chain_id) END AS progress
FROM {heads} h LEFT JOIN {blocks} c ON c.chain_id = h.chain_id AND c.chain_id <> 4 AND c.block_number <= h.finalized GROUP BY h.chain_id""")
register("newest_row", lambda f: win.newest_row(f.blocks), "SELECT chain_id, block_number, block_ts FROM {blocks} b WHERE block_number = (SELECT max(block_number) FROM {blocks} x WHERE x.chain_id = b.chain_id)")


# what a run is by itself, then a walk over the runs of a series
STATES = """
WITH RECURSIVE n AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY run) AS k FROM {legs}),
c AS (SELECT *, last_value(a IGNORE NULLS) OVER (PARTITION BY series ORDER BY run ROWS UNBOUNDED PRECEDING) AS a1, last_value(b IGNORE NULLS) OVER (PARTITION BY series ORDER BY run ROWS UNBOUNDED PRECEDING) AS b1,
        count(a) OVER (PARTITION BY series ORDER BY run ROWS UNBOUNDED PRECEDING) AS ca, count(b) OVER (PARTITION BY series ORDER BY run ROWS UNBOUNDED PRECEDING) AS cb FROM n),
d AS (SELECT *, lag(a1) OVER (PARTITION BY series ORDER BY run) AS a0, lag(b1) OVER (PARTITION BY series ORDER BY run) AS b0,
        at_s - min(CASE WHEN a IS NULL AND coalesce(a1, b1) IS NOT NULL THEN at_s END) OVER (PARTITION BY series, ca) AS ea,
        at_s - min(CASE WHEN b IS NULL AND coalesce(a1, b1) IS NOT NULL THEN at_s END) OVER (PARTITION BY series, cb) AS eb FROM c),
e AS (SELECT *, coalesce(a1 > a0, FALSE) AS ma, coalesce(b1 > b0, FALSE) AS mb, abs(a - b) AS skew, coalesce(abs(a1 - b1) > abs(a0 - b0), FALSE) AS grew, coalesce(abs(a1 - b1) < abs(a0 - b0), FALSE) AS shrank FROM d),
f AS (SELECT *, CASE WHEN a IS NULL AND b IS NULL THEN 'both-empty'
    WHEN a IS NULL THEN CASE WHEN ea > 250 AND mb THEN 'one-sided-empty' ELSE 'empty-arming' END
    WHEN b IS NULL THEN CASE WHEN eb > 250 AND ma THEN 'one-sided-empty' ELSE 'empty-arming' END
    WHEN skew <= 250 THEN 'both-populated-in-skew' WHEN a0 IS NULL OR b0 IS NULL THEN 'skew-above-threshold-arming'
    WHEN ma AND NOT mb OR mb AND NOT ma THEN 'frozen' WHEN grew THEN 'skew-growing' WHEN NOT ma THEN 'mutually-quiescent'
    WHEN shrank AND a1 <> b1 THEN 'catching-up' WHEN NOT shrank THEN 'lagging-constant' ELSE 'mutually-quiescent' END AS st FROM e),
g AS (SELECT *, CASE st WHEN 'one-sided-empty' THEN CASE WHEN a IS NULL THEN 'A' ELSE 'B' END WHEN 'frozen' THEN CASE WHEN ma THEN 'B' ELSE 'A' END WHEN 'skew-growing' THEN CASE WHEN a1 < b1 THEN 'A' ELSE 'B' END END AS side FROM f),
walk AS (
  SELECT series, run, k, a, b, skew, st AS state, side IS NOT NULL AS failing, side AS stale_side, CASE WHEN side IS NOT NULL THEN st END AS cause FROM g WHERE k = 1
  UNION ALL
  SELECT g.series, g.run, g.k, g.a, g.b, g.skew, CASE WHEN w.failing AND NOT CASE w.stale_side WHEN 'A' THEN g.ra ELSE g.rb END THEN 'wedge-unrecovered' ELSE g.st END, CASE WHEN w.failing AND NOT CASE w.stale_side WHEN 'A' THEN g.ra ELSE g.rb END THEN TRUE ELSE g.side IS NOT NULL END,
         CASE WHEN w.failing AND NOT CASE w.stale_side WHEN 'A' THEN g.ra ELSE g.rb END THEN w.stale_side ELSE g.side END, CASE WHEN w.failing AND NOT CASE w.stale_side WHEN 'A' THEN g.ra ELSE g.rb END THEN w.cause WHEN g.side IS NOT NULL THEN g.st END
  FROM walk w JOIN (SELECT *, skew IS NOT NULL AND (skew <= 250 OR ma AND NOT grew) AS ra, skew IS NOT NULL AND (skew <= 250 OR mb AND NOT grew) AS rb FROM g) g ON g.series = w.series AND g.k = w.k + 1)
SELECT series, run, a, b, skew, state, failing, stale_side, cause FROM walk"""
register("progress_stagnation", lambda f: win.progress_stagnation(f.legs, ["series"], "run", "a", "b", "at_s", threshold=250), STATES)

CANONICAL = """
SELECT seq, number, hash, parent_hash, coalesce(min(number) OVER (ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) <= number, FALSE) AS orphaned
FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY seq) AS n FROM {deliveries}) d WHERE n = 1"""
register("reorg_resolve", lambda f: win.reorg_resolve(f.deliveries.withColumn("chain_id", F.lit(1)), ("chain_id",)).drop("chain_id"), CANONICAL)
register("chain_linkage", lambda f: win.chain_linkage(f.blocks.where("block_number % 11 <> 0"), ["chain_id"], "block_number", "block_hash", "parent_hash"), """
WITH o AS (SELECT *, lag(block_hash) OVER (PARTITION BY chain_id ORDER BY block_number) AS h FROM {blocks} WHERE block_number % 11 <> 0)
SELECT chain_id, block_number, block_hash, 'parent' AS violation FROM o WHERE h <> parent_hash""")
register("finalized_prefix", lambda f: win.finalized_prefix(f.blocks, f.heads), """
SELECT b.chain_id, b.block_number, b.block_hash, CASE WHEN b.block_number = (SELECT max(block_number) FROM {blocks} x WHERE x.chain_id = b.chain_id AND x.block_number <= h.finalized) THEN 'tip'
  WHEN b.block_number <= h.finalized THEN 'final' ELSE 'remaining' END AS part FROM {blocks} b JOIN {heads} h ON h.chain_id = b.chain_id""")

register("order_events", lambda f: win.order_events(_positions(f)), POSITIONS)


def ends(f: Fixtures) -> DataFrame:
    return f.heads.select("chain_id", (1700000000 + F.col("finalized") * 12).alias("finalized_ts"), (1700000000 + F.coalesce("end_block", F.col("finalized")) * 12).alias("end_ts"))


register("omnichain_ready", lambda f: win.omnichain_ready(f.blocks.select("chain_id", "block_number", F.col("block_ts").alias("ts")), ends(f)), """
WITH e AS (SELECT min(1700000000 + finalized * 12) AS f, max(1700000000 + coalesce(end_block, finalized) * 12) AS e, bool_and(coalesce(end_block, finalized) <= finalized) AS ended FROM {heads}),
j AS (SELECT b.chain_id, b.block_number, b.block_ts AS ts, b.block_ts <= least(e.f, e.e) AS ready, ended FROM {blocks} b, e)
SELECT chain_id, block_number, ts, ready, ended AND (SELECT count(*) FROM j WHERE NOT ready) = 0 AS all_done FROM j""")

register("bounded_sample", lambda f: win.bounded_sample(f.logs, "event_code", "block_number"), """
WITH r AS (SELECT event_code, block_number, row_number() OVER (PARTITION BY event_code ORDER BY block_number) AS n FROM (SELECT DISTINCT event_code, block_number FROM {logs}) d)
SELECT l.event_code, min(l.block_number) AS min_key, max(l.block_number) AS max_key, count(*) AS n, min(s.sample) AS sample
FROM {logs} l JOIN (SELECT event_code, string_agg(CAST(block_number AS STRING), ',' ORDER BY block_number) AS sample FROM r WHERE n <= 5 GROUP BY event_code) s ON s.event_code = l.event_code GROUP BY l.event_code""")
register("top_chains", lambda f: win.top_chains(f.logs, ["chain_id", "address"], 10), "SELECT chain_id, address, count(*) AS n FROM {logs} GROUP BY chain_id, address ORDER BY n DESC, chain_id, address LIMIT 10")

register("union_filters", lambda f: win.union_filters([f.logs.where("event_code = 'RF'").select(*LOG), f.logs.where("supp_key % 5 = 0").select(*LOG)], LOG), "SELECT chain_id, block_number, log_index FROM {logs} WHERE event_code = 'RF' OR supp_key % 5 = 0")
register("set_diff", lambda f: win.set_diff(f.logs.where("log_index % 5 <> 0").select("chain_id", "event_code"), f.logs.where("log_index % 4 <> 0").select("chain_id", "event_code")), """
WITH d AS (SELECT chain_id, event_code, sum(CASE WHEN log_index % 5 <> 0 THEN 1 ELSE 0 END) - sum(CASE WHEN log_index % 4 <> 0 THEN 1 ELSE 0 END) AS d FROM {logs} GROUP BY chain_id, event_code)
SELECT chain_id, event_code, CASE WHEN d > 0 THEN 'only_a' ELSE 'only_b' END AS side, CAST(abs(d) AS BIGINT) AS n FROM d WHERE d <> 0""")
register("referenced_keys", lambda f: win.referenced_keys(f.tx, f.logs.where("event_code = 'NF'"), ["chain_id", "tx_hash"]), """
SELECT chain_id, tx_hash FROM {tx} WHERE tx_hash IN (SELECT tx_hash FROM {logs} WHERE event_code = 'NF')""")
