"""Hand-made rows: the cases that are easy to get wrong."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chainframe.functions import encodings as enc
from chainframe.operators import aggregates, compare, filters, joins
from chainframe.operators import windows as win
from chainframe.sources import blocks as src
from chainframe.sources import store

TX = "chain_id long, block_number long, transaction_index long"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def tree(spark, frames):
    return spark.createDataFrame([(1, 1, 0, p, e, r) for p, e, r in frames], f"{TX}, path array<int>, error string, reason string")


def test_cascade_errors_nearest_own_and_holes(spark):
    frames = [([], None, None), ([0], "out", "r0"), ([0, 0], None, None), ([0, 0, 1], "own", None), ([0, 0, 1, 0], None, None), ([0, 2, 0], None, None), ([1], None, "kept"), ([1, 0], None, None)]
    got = {tuple(r.path): (r.error, r.reason) for r in joins.cascade_errors(tree(spark, frames)).collect()}
    assert got == {
        (): (None, None), (0,): ("out", "r0"), (0, 0): ("out", "r0"), (0, 0, 1): ("own", None), (0, 0, 1, 0): ("own", None),
        (0, 2, 0): (None, None),  # its parent is missing
        (1,): (None, "kept"), (1, 0): (None, None),
    }


def test_cascade_errors_equals_a_walk(spark):
    rnd = random.Random(3)
    paths = {()}
    while len(paths) < 120:
        p = rnd.choice(sorted(paths))
        if len(p) < 5:
            paths.add((*p, rnd.randrange(4)))
    kept = [p for p in sorted(paths) if rnd.random() < 0.9]
    errors = {p: f"e{i}" for i, p in enumerate(kept) if rnd.random() < 0.1}

    def walk(p):
        while True:
            if p not in kept:
                return None
            if p in errors:
                return errors[p]
            if not p:
                return None
            p = p[:-1]

    got = joins.cascade_errors(tree(spark, [(list(p), errors.get(p), None) for p in kept])).collect()
    assert {tuple(r.path): r.error for r in got} == {p: walk(p) for p in kept}


@pytest.mark.parametrize("step", [1, 3, 8])
def test_cascade_errors_in_deep_trees(spark, step):
    rnd = random.Random(step)
    paths = {(): None}
    for root in range(6):  # chains of many depths, with twigs, holes and errors
        p = (root,)
        for _ in range(rnd.choice([5, 9, 17, 64, 200])):
            paths[p] = None
            if rnd.random() < 0.2:
                paths[(*p, 7)] = None
            p = (*p, rnd.randrange(2))
    kept = [p for p in paths if len(p) < 3 or rnd.random() < 0.985]
    errors = {p: f"e{i}" for i, p in enumerate(kept) if len(p) and rnd.random() < 0.02}

    def walk(p):
        while p in kept:
            if p in errors or not p:
                return errors.get(p)
            p = p[:-1]

    rows = [(list(p), errors.get(p), None) for p in kept]
    got = joins.cascade_errors(tree(spark, rows), step).collect()
    assert {tuple(r.path): r.error for r in got} == {p: walk(p) for p in kept} and len(got) == len(kept)


def test_an_error_at_the_top_reaches_a_depth_of_a_thousand(spark):
    rows = [([0] * k, "top" if k == 0 else None, "why" if k == 0 else None) for k in range(1001)]
    got = joins.cascade_errors(tree(spark, rows)).collect()
    assert len(got) == 1001 and {(r.error, r.reason) for r in got} == {("top", "why")}
    broken = joins.cascade_errors(tree(spark, [r for r in rows if len(r[0]) != 500])).collect()
    assert {len(r.path) for r in broken if r.error} == set(range(500))


def test_shallow_trees_are_settled_without_a_join(spark):
    """Frames of up to ``step`` levels are read once and meet their ancestors in one window."""
    frames = [([], "top", None), ([0], None, "own"), ([0, 1], None, None), ([1, 0], None, None), ([2], "out", "r"), ([2, 0], None, None), ([2, 0, 0], None, None)]
    got = joins.cascade_errors(tree(spark, frames))
    assert {tuple(r.path): (r.error, r.reason) for r in got.collect()} == {
        (): ("top", None), (0,): ("top", "own"), (0, 1): ("top", None), (1, 0): (None, None), (2,): ("out", "r"), (2, 0): ("out", "r"), (2, 0, 0): ("out", "r"),
    }
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_rank_is_preorder(spark):
    paths = [[], [0], [0, 0], [0, 1], [1], [1, 0, 0], [10], [2]]
    got = win.rank_traces(tree(spark, [(p, None, None) for p in random.Random(1).sample(paths, len(paths))])).orderBy("trace_index").collect()
    assert [list(r.path) for r in got] == [[], [0], [0, 0], [0, 1], [1], [1, 0, 0], [2], [10]]


def test_discovery_does_not_shuffle_logs_to_their_factories(spark):
    logs = spark.range(50).selectExpr("1 + id DIV 1000 AS chain_id", "id AS block_number", "id AS log_index", "'0xa' AS address", "CASE WHEN id < 1000 THEN '0xt' END AS topic0", "concat('0x', lpad(hex(id % 5), 64, '0')) AS topic1")
    f = spark.sql("SELECT 'f' AS factory_id, 1L AS chain_id, '0xA' AS address, '0xT' AS topic0, min(id) + 3 AS from_block, CAST(NULL AS BIGINT) AS to_block FROM range(10)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.discover_children(logs, f)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert {(int(r.child, 16), r.created_block) for r in got.collect()} == {(0, 5), (1, 6), (2, 7), (3, 3), (4, 4)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_events_are_shuffled_without_their_checkpoints(spark):
    fields = "block_ts, chain_id, block_number, transaction_index, event_type, event_index"
    own = [(1700000000 + k % 7, 1 + k % 3, k * 37 % 101, k % 2, 5, k % 11 if k % 25 else None) for k in range(200)]
    events = spark.createDataFrame(own, ", ".join(f"{c} long" for c in fields.split(", ")))
    got = win.order_events(events)
    plan = got._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange rangepartitioning" in line]
    assert dealt and not any("checkpoint" in line for line in dealt)
    texts = [r.checkpoint for r in got.collect()]
    assert texts == sorted(texts, key=lambda t: t or "") and texts.count(None) == 8
    wide = win.order_events(events.withColumn("event_index", F.col("event_index").cast("string")))
    assert [r.checkpoint for r in wide.collect()] == texts and wide.columns == got.columns


def test_factory_children(spark):
    logs = spark.createDataFrame([(1, 5, 0, "a"), (1, 9, 0, "a"), (2, 9, 0, "a"), (1, 9, 1, "b")], "chain_id long, block_number long, log_index long, address string")
    children = spark.createDataFrame([("f", 1, "a", 6)], "factory_id string, chain_id long, child string, created_block long")
    assert rows(filters.child_logs(logs, children)) == [(1, 9, 0, "a")]
    assert rows(filters.child_logs(logs, children.limit(0))) == []
    f = spark.createDataFrame([(1, "f"), (1, "none"), (1, None)], "chain_id long, address_factory string")
    assert rows(filters.match_logs_factory(logs, f, children)) == [(1, 9, 0, "a")]
    assert rows(filters.match_logs_factory(logs, f.where("address_factory = 'none'"), children)) == []
    assert rows(filters.match_logs_factory(logs, f.where("address_factory = 'f'"), children.limit(0))) == []


def test_filters_by_factory_keep_to_their_own_children(spark):
    logs = spark.createDataFrame([(1, 9, k, a, ["0xT", "0x1", None, "0x3"][: 2 + k % 3]) for k, a in enumerate("ABABAB")], "chain_id long, block_number long, log_index long, address string, topics array<string>")
    children = spark.createDataFrame([("f", 1, "a", 6), ("g", 1, "b", 6), ("g", 1, "a", 10)], "factory_id string, chain_id long, child string, created_block long")
    f = spark.createDataFrame([(1, "g", ["0xt", "0xu"], None, None, 20), (1, "f", None, ["0x3"], 9, None)], "chain_id long, address_factory string, topic0 array<string>, topic3 array<string>, from_block long, to_block long")
    assert [r[2] for r in rows(filters.match_logs_factory(logs, f, children))] == [1, 2, 3, 5]  # b by g; a with a third topic by f
    assert rows(filters.match_logs_factory(logs, f.where("address_factory = 'f'"), children))[0][2] == 2


def test_both_sides_of_one_filter(spark):
    txs = spark.createDataFrame([(1, b, k, x, y) for b in (3, 8) for k, (x, y) in enumerate([("X", "y"), ("x", "z"), ("w", "y"), ("w", None), ("w", "z")])], f"{TX}, from_address string, to_address string")
    children = spark.createDataFrame([("f", 1, "y", 5), ("f", 1, "w", 0), ("g", 1, "z", 0)], "factory_id string, chain_id long, child string, created_block long")
    schema = "chain_id long, from_address array<string>, from_address_factory string, to_address array<string>, to_address_factory string, from_block long, to_block long"

    def found(*own):
        return [r[1:3] for r in rows(filters.match_transactions(txs, spark.createDataFrame([(1, *o, None, None) for o in own], schema), children))]

    assert found((["x"], None, None, "f")) == [(8, 0)]  # y is a child from block 5 on
    assert found((None, "f", None, "g")) == [(3, 4), (8, 4)]
    assert found((None, "f", ["y", "q"], None)) == [(3, 2), (8, 2)]
    assert found((["x", "v"], None, ["z"], None), (None, None, None, None)) == [(3, 1), (8, 1)]
    assert found((["w"], None, ["z"], None), (["x"], None, ["y"], None)) == [(3, 0), (3, 4), (8, 0), (8, 4)]  # not the sender of one and the recipient of the other


def test_the_range_of_all_filters_reaches_the_files(spark, tmp_path):
    logs = spark.range(100).select(F.lit(1).cast("long").alias("chain_id"), F.col("id").alias("block_number"), F.lit("a").alias("address"), F.lit("t").alias("topic0"))
    logs.write.parquet(str(tmp_path / "l"))
    f = spark.createDataFrame([(1, "a", 10, 20), (1, "b", 15, 30)], "chain_id long, address string, from_block long, to_block long")
    got = filters.match_logs(spark.read.parquet(str(tmp_path / "l")), f)
    assert sorted(r.block_number for r in got.collect()) == list(range(10, 21))
    scan = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line and "block_number" in line]
    assert scan and "block_number" in scan[0].split("DataFilters")[1] and "subquery" in scan[0].split("DataFilters")[1]


def test_factories_have_their_own_places(spark):
    word = lambda n: f"{n:064x}"
    logs = spark.createDataFrame([(1, 4, "0xF", "0xT", word(1), "0x" + word(2) + word(3)), (1, 3, "0xf", "0xt", "0x" + word(1), "0x" + word(2) + word(3)), (1, 2, "0xe", "0xt", "0x" + word(9), "0x" + word(9))], "chain_id long, block_number long, address string, topic0 string, topic1 string, data string")
    f = spark.createDataFrame([("a", 1, ["0xf", "0xq"], "0xT", None, None, "topic1"), ("b", 1, ["0xf"], "0xt", None, None, "offset32"), ("c", 1, None, "0xt", None, 2, None)], "factory_id string, chain_id long, address array<string>, topic0 string, from_block long, to_block long, location string")
    got = {(r.factory_id, int(r.child, 16), r.created_block) for r in joins.discover_children(logs, f).collect()}
    assert got == {("a", 1, 3), ("b", 3, 3), ("c", 9, 2)}
    with pytest.raises(Exception, match="unknown location"):
        joins.discover_children(logs, f.withColumn("location", F.lit("data1"))).collect()


def test_match_transactions_null_recipient(spark):
    txs = spark.createDataFrame([(1, 1, 0, "x", None), (1, 1, 1, "x", "y"), (1, 1, 2, "z", "y")], f"{TX}, from_address string, to_address string")
    f = spark.createDataFrame([(1, "x", "y", None, None), (1, None, None, None, None)], "chain_id long, from_address string, to_address string, from_block long, to_block long")
    assert [r[2] for r in rows(filters.match_transactions(txs, f))] == [1]


def test_filters_split_in_any_way_find_the_same(spark):
    rnd = random.Random(5)
    logs = spark.createDataFrame([(1, b, i, rnd.choice("abc"), rnd.choice("xyz"), rnd.choice("pq")) for b in range(20) for i in range(5)], "chain_id long, block_number long, log_index long, address string, topic0 string, topic1 string")
    own = [(1, rnd.choice([None, "a", "b"]), rnd.choice([None, "x"]), rnd.choice([None, "p"]), rnd.choice([None, 3]), rnd.choice([None, 15])) for _ in range(6)] + [(1, "c", "z", "q", None, None)]
    schema = "chain_id long, address string, topic0 string, topic1 string, from_block long, to_block long"
    keys = ["chain_id", "block_number", "log_index"]
    whole = rows(filters.match_logs(logs, spark.createDataFrame(own, schema)))
    parts = [filters.match_logs(logs, spark.createDataFrame(p, schema)) for p in (own[:3], own[3:])]
    assert rows(win.union_filters(parts, keys)) == whole


def test_bounded_window_open_ends(spark):
    f = spark.createDataFrame([(1, 5, 10), (1, None, 20), (2, 5, None), (2, 7, 9)], "chain_id long, from_block long, to_block long")
    heads = spark.createDataFrame([(1, 15), (2, 30)], "chain_id long, finalized long")
    assert rows(src.bounded_window(f, heads)) == [(1, 0, 15), (2, 5, 30)]


def test_unknown_head_defers(spark):
    r = spark.createDataFrame([(1, 0, 9), (2, 0, 9)], "chain_id long, lo long, hi long")
    h = spark.createDataFrame([(1, 5, None, None), (2, 4, 8, 2)], "chain_id long, finalized long, head long, floor_block long")
    assert [x[-1] for x in rows(src.finality_split(r, h))] == ["deferred", "split"]


def test_missing_required_column_is_an_error_only_if_used(spark):
    df = spark.createDataFrame([(1, True)], "a int, m boolean")
    assert src.assert_needed_columns(df, "NOT m", ["gone"]).collect() == []
    with pytest.raises(Exception, match="missing columns"):
        src.assert_needed_columns(df, "m", ["gone"]).collect()
    with pytest.raises(ValueError, match="required"):
        src.degrade_columns([df], {"gone": "string"})


def test_malformed_line_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"header":{"number":1,"hash":"0x1"}}\n{"header":{"number":\n')
    with pytest.raises(Exception):
        src.read_block_ndjson(spark, str(tmp_path)).collect()


def test_raw_traces_nested_and_flat(spark, tmp_path):
    traces = [
        {"transactionIndex": 0, "traceAddress": [], "type": "call", "action": {"from": "0xAB", "to": "0xCD", "value": "0x5", "callType": "delegatecall", "gas": "0x10", "input": "0xff"}, "result": {"gasUsed": "0x7", "output": "0x1"}},
        {"transactionIndex": 0, "traceAddress": [0], "type": "create", "error": "oops", "action": {"from": "0xAB", "value": "0x0", "gas": "0x9", "init": "0x60"}, "result": {"address": "0xNEW", "code": "0x61", "gasUsed": "0x8"}},
        {"transactionIndex": 0, "traceAddress": [1], "type": "suicide", "action": {"address": "0xDEAD", "refundAddress": "0xBEEF", "balance": "18446744073709551616"}},
        {"transactionIndex": 0, "traceAddress": [2], "type": "call", "callFrom": "0xA", "callTo": "0xB", "callValue": "7", "callGas": "12", "callCallType": "staticcall"},
        {"transactionIndex": 0, "traceAddress": [3], "type": "suicide", "suicideAddress": "0xA", "suicideRefundAddress": "0xB", "suicideBalance": "0x"},
        {"transactionIndex": 0, "traceAddress": [4], "type": "call", "action": {"from": "0xa", "callType": "weird"}},
        {"transactionIndex": None, "type": "reward"}, {"transactionIndex": 0, "type": "daofork"},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"header": {"number": 7, "hash": "0xA", "timestamp": 3}, "traces": traces}) + "\n")
    t = src.explode_block(src.read_block_ndjson(spark, str(tmp_path)))["traces"].withColumn("chain_id", F.lit(1))
    got = enc.canon_trace(t).orderBy("traceAddress").select("frame_type", "from_address", "to_address", "value", "gas", "gas_used", "input", "output", "error").collect()
    assert [tuple(r) for r in got] == [
        ("DELEGATECALL", "0xab", "0xcd", "0x5", "0x10", "0x7", "0xff", "0x1", None), ("CREATE", "0xab", "0xnew", "0x0", "0x9", "0x8", "0x60", "0x61", "oops"),
        ("SELFDESTRUCT", "0xdead", "0xbeef", "0x10000000000000000", "0x0", "0x0", "0x", None, None), ("STATICCALL", "0xa", "0xb", "0x7", "0xc", "0x0", "0x", None, None),
        ("SELFDESTRUCT", "0xa", "0xb", "0x0", "0x0", "0x0", "0x", None, None), ("CALL", "0xa", None, None, "0x0", "0x0", "0x", None, None),
    ]


def test_raw_block_has_all_fields(spark, tmp_path):
    header = {"number": 7, "hash": "0xA", "parentHash": "0xP", "timestamp": 3, "logsBloom": "0xb", "miner": "0xM", "gasUsed": "100", "gasLimit": "0x64", "baseFeePerGas": None, "nonce": "0x0", "mixHash": "0x1", "stateRoot": "0x2",
              "receiptsRoot": "0x3", "transactionsRoot": "0x4", "sha3Uncles": "0x5", "size": 600, "difficulty": "0", "totalDifficulty": str(2**70), "extraData": "0x"}
    tx = {"transactionIndex": 0, "hash": "0xT", "from": "0xF", "to": None, "gas": "21000", "gasPrice": "5", "maxFeePerGas": "9", "maxPriorityFeePerGas": "1", "type": 2, "r": "0xr", "s": "0xs", "v": "0x1", "yParity": "0x1", "accessList": [],
          "status": 1, "cumulativeGasUsed": "21000", "effectiveGasPrice": "5", "gasUsed": "21000", "contractAddress": "0xC", "logsBloom": "0xb"}
    (tmp_path / "a.json").write_text(json.dumps({"header": header, "transactions": [tx]}) + "\n")
    parts = src.explode_block(src.read_block_ndjson(spark, str(tmp_path)).withColumn("chain_id", F.lit(1)))
    b = enc.canon_block(parts["headers"]).first()
    assert (b.gas_used, b.gas_limit, b.base_fee, b.size, b.difficulty, b.total_difficulty, b.mix_hash, b.extra_data) == ("0x64", "0x64", None, "0x258", "0x0", hex(2**70), "0x1", "0x")
    t = enc.canon_tx(parts["transactions"]).first()
    assert (t.to_address, t.nonce, t.value, t.tx_type, t.gas, t.gas_price, t.max_fee_per_gas, t.max_priority_fee_per_gas, t.y_parity, t.access_list, t.input) == (None, "0x0", "0x0", "0x2", "0x5208", "0x5", "0x9", "0x1", "0x1", [], "0x")
    r = enc.canon_receipt(parts["transactions"]).first()
    assert (r.status, r.cumulative_gas_used, r.effective_gas_price, r.contract_address, r.from_address, r.tx_type) == ("0x1", "0x5208", "0x5", "0xc", "0xf", "0x2")


def test_quantities_are_exact_and_nothing_else_passes(spark):
    rnd = random.Random(6)
    values = [rnd.getrandbits(rnd.choice([8, 60, 63, 64, 65, 128, 200, 256])) for _ in range(200)] + [0, 10**18 - 1, 10**18, 2**256 - 1]
    df = spark.createDataFrame([(str(v), hex(v)) for v in values], "v string, h string").withColumn("got", enc.hex_quantity(F.col("v")))
    assert df.where("got <> h").collect() == []
    for bad in ("12a", "-1", "1.5", "1" * 90):
        with pytest.raises(Exception, match="not a quantity"):
            spark.createDataFrame([(bad,)], "v string").select(enc.hex_quantity(F.col("v"))).collect()


def test_a_wide_field_is_no_checkpoint(spark):
    fields = {n: F.lit(1) for n, _ in enc.CHECKPOINT}
    assert len(spark.range(1).select(enc.checkpoint_encode(**fields)).first()[0]) == 75
    with pytest.raises(Exception, match="doesn't fit"):
        spark.range(1).select(enc.checkpoint_encode(**fields | {"event_type": F.lit(10)})).collect()


def test_uint256_sum_is_exact(spark):
    rnd = random.Random(2)
    values = [rnd.getrandbits(256) for _ in range(200)] + [2**256 - 1, 0]
    df = spark.createDataFrame([("g", hex(v)) for v in values], "g string, v string")
    assert enc.uint256_sum(df, ["g"], "v").collect()[0].total == hex(sum(values))


def test_null_list_is_not_empty(spark):
    df = spark.createDataFrame([(1, 1, 0, 2, None), (1, 1, 1, 0, "l"), (1, 1, 2, 1, "l")], f"{TX}, tx_type int, access_list string")
    got = df.select("transaction_index", enc.gate_access_list(F.col("tx_type"), F.col("access_list"))).orderBy("transaction_index").collect()
    assert [r[1] for r in got] == [None, None, "l"]


def test_intervals_round_trip(spark):
    rnd = random.Random(7)
    made = [(f, lo, lo + rnd.randrange(0, 9)) for f in range(4) for lo in (rnd.randrange(60) for _ in range(12))]
    iv = spark.createDataFrame(made, "fragment_id long, lo long, hi long")
    wanted = spark.createDataFrame([(f, 5, 50) for f in range(5)], "fragment_id long, want_lo long, want_hi long")
    covered = {f: {b for g, lo, hi in made if g == f for b in range(lo, hi)} for f in range(5)}
    merged = win.coalesce_intervals(iv).collect()
    assert {f: {b for r in merged if r.fragment_id == f for b in range(r.lo, r.hi)} for f in range(5)} == covered
    gaps = win.missing_ranges(iv, wanted).collect()
    assert {f: {b for r in gaps if r.fragment_id == f for b in range(r.lo, r.hi)} for f in range(5)} == {f: set(range(5, 50)) - covered[f] for f in range(5)}
    verdicts = {r.fragment_id: r.verdict for r in win.tiling_verdict(iv, wanted).collect()}
    assert verdicts[4] == "FAIL"  # no rows is not a pass


def test_reorg_resolve_equals_a_model(spark):
    made, seq, chain = [], 0, [(0, "g")]
    rnd = random.Random(9)
    for k in range(300):
        depth = rnd.choice([0] * 8 + [1, 2])
        chain = chain[: max(1, len(chain) - depth)]
        n, h = chain[-1][0] + 1, f"h{k}"
        made.append((1, seq, n, h, chain[-1][1]))
        chain.append((n, h))
        seq += 1
        if rnd.random() < 0.1:
            made.append((1, seq, n, h, "again"))
            seq += 1
    d = spark.createDataFrame(made, "chain_id long, seq long, number long, hash string, parent_hash string")
    for span in (1_000_000, 7):
        got = win.reorg_resolve(d, ("chain_id",), span).where("NOT orphaned").orderBy("number").collect()
        assert [(r.number, r.hash) for r in got] == chain[1:]


def test_percentiles_take_the_nearest_rank(spark):
    df = spark.createDataFrame([("e", float(v), 1, v) for v in range(1, 11)] + [("e", 0.0, 0, 99)], "endpoint string, latency double, ok int, at_s long")
    r = aggregates.latency_percentiles(df, ["endpoint"]).collect()[0]
    assert (r.p50, r.p90, r.p99, r.last_error_at, r.n) == (6.0, 10.0, 10.0, 99, 11)


BLOCKS = "chain_id long, block_number long, block_hash string, size long, base_fee long"


@pytest.mark.parametrize("b, verdict", [((1, 1, "h", 9, None), "PASS"), ((1, 1, "h", 9, 0), "FAIL"), ((1, 1, "x", 9, None), "FAIL"), ((1, 1, "h", 5, 0), "PASS"), ((1, 1, "h", 5, 1), "FAIL"), ((1, 2, "h", 5, None), "FAIL")])
def test_each_tolerance_flips_with_one_more_difference(spark, b, verdict):
    a = spark.createDataFrame([(1, 1, "h", 5, None)], BLOCKS)
    assert compare.blocks_verdict(a, spark.createDataFrame([b], BLOCKS), [1]).collect()[0].verdict == verdict


def test_no_rows_is_not_a_pass(spark):
    none = spark.createDataFrame([], BLOCKS)
    assert compare.blocks_verdict(none, none, [1]).collect()[0].verdict == "EMPTY"
    t = spark.createDataFrame([], "chain_id long, block_number long, x string")
    assert aggregates.app_digest({"t": (t, ["chain_id", "block_number"])}).collect()[0].verdict == "NO-USER-TABLES"


def test_digest_sees_repeats_and_ignores_surrogates(spark):
    schema = "chain_id long, block_number long, k string, id long"

    def digest(made):
        return aggregates.table_digest(spark.createDataFrame(made, schema), "t", ["chain_id", "block_number"], exclude=("id",)).collect()[0].digest

    one = digest([(1, 1, "a", 1), (1, 1, "b", 2)])
    assert one == digest([(1, 1, "b", 9), (1, 1, "a", 7)])
    assert one != digest([(1, 1, "a", 1), (1, 1, "a", 3), (1, 1, "b", 2)])


def test_append_store_twice_writes_once(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (1, 1, 1)], TX)
    keys = ["chain_id", "block_number", "transaction_index"]
    store.append_store(df, str(tmp_path / "t"), keys)
    store.append_store(df, str(tmp_path / "t"), keys)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_asof_is_strictly_before(spark):
    blocks = spark.createDataFrame([(1, 1, 10), (1, 2, 20)], "chain_id long, block_number long, block_ts long")
    points = spark.createDataFrame([(1, 10), (1, 20), (1, 21)], "chain_id long, checkpoint_ts long")
    for seconds in (86400, 10, 3):
        assert rows(joins.asof_block(points, blocks, seconds)) == [(1, 10, None), (1, 20, 1), (1, 21, 2)]


def test_scan_range_reaches_the_files(spark, tmp_path):
    spark.range(100).select(F.lit(1).alias("chain_id"), F.col("id").alias("block_number")).write.parquet(str(tmp_path / "b"))
    df = src.scan_range(spark.read.parquet(str(tmp_path / "b")), 10, 12)
    assert [r.block_number for r in df.orderBy("block_number").collect()] == [10, 11, 12]
    assert "PushedFilters: [IsNotNull(block_number), GreaterThanOrEqual(block_number,10), LessThanOrEqual(block_number,12)]" in df._jdf.queryExecution().toString()


def test_queries_of_whole_tables_grow_with_them(spark):
    from chainframe import plans

    def progress(name, column, sf):
        return {r.chain_id: r[column] for r in plans.queries()[name](spark, f"/root/testdata/{sf}").collect()}

    for name, column in (("closest_block_all", "closest_block"), ("checkpoint_progress_all", "n_rows")):
        small, large = progress(name, column, "sf0.001"), progress(name, column, "sf0.01")
        assert max(large.values()) > 2 * max(small.values())


def legs(spark, *runs):
    made = [("s", k, a, b, k * 3600) for k, (a, b) in enumerate(runs)]
    df = spark.createDataFrame(made, "series string, run long, a long, b long, at_s long")
    return [(r.state, r.failing, r.stale_side) for r in win.progress_stagnation(df, ["series"], "run", "a", "b", "at_s", 600).orderBy("run").collect()]


@pytest.mark.parametrize("runs, want", [
    ([(None, None), (None, None)], [("both-empty", False, None)] * 2),
    ([(1000, 1000), (2000, 1500)], [("both-populated-in-skew", False, None)] * 2),
    # neither moves, however far apart they are
    ([(9000, 1000), (9000, 1000)], [("skew-above-threshold-arming", False, None), ("mutually-quiescent", False, None)]),
    # one stands still: a failure that lasts until it moves on and the gap doesn't grow
    ([(5000, 1000), (6000, 1000), (6000, 1000), (7000, 1500), (7100, 2000)], [("skew-above-threshold-arming", False, None), ("frozen", True, "B"), ("wedge-unrecovered", True, "B"), ("wedge-unrecovered", True, "B"), ("catching-up", False, None)]),
    ([(5000, 1000), (6000, 1500)], [("skew-above-threshold-arming", False, None), ("skew-growing", True, "B")]),
    ([(5000, 1000), (6000, 2000)], [("skew-above-threshold-arming", False, None), ("lagging-constant", False, None)]),
    # an empty leg arms, then fails if the other moves; coming back behind isn't enough
    ([(1000, 1000), (2000, None), (3000, None), (3000, 900), (3100, 3000)], [("both-populated-in-skew", False, None), ("empty-arming", False, None), ("one-sided-empty", True, "B"), ("wedge-unrecovered", True, "B"), ("both-populated-in-skew", False, None)]),
    # an empty leg while the other stands still is no failure
    ([(1000, 1000), (1000, None), (1000, None)], [("both-populated-in-skew", False, None), ("empty-arming", False, None), ("empty-arming", False, None)]),
    # the leader goes back and the other stands still: nobody moved
    ([(5000, 1000), (4000, 1000)], [("skew-above-threshold-arming", False, None), ("mutually-quiescent", False, None)]),
])
def test_stagnation_regimes(spark, runs, want):
    assert legs(spark, *runs) == want


def test_linkage_across_spans(spark):
    made = [(1, k, f"h{k}", f"h{k - 1}" if k % 7 else "x") for k in range(1, 60) if k % 13]
    h = spark.createDataFrame(made, "chain_id long, n long, h string, p string")
    want = [(k, "parent") for j, (_, k, _, p) in enumerate(made) if j and p != made[j - 1][2]]
    for span in (10_000, 4, 1):
        assert [(r.n, r.violation) for r in win.chain_linkage(h, ["chain_id"], "n", "h", "p", span).orderBy("n").collect()] == want
    twice = spark.createDataFrame([(1, 1, "a", "g"), (1, 2, "b", "a"), (1, 2, "c", "a")], "chain_id long, n long, h string, p string")
    assert [tuple(r) for r in win.chain_linkage(twice, ["chain_id"], "n", "h", "p").collect()] == [(1, 2, "c", "number")]


def test_window_completeness_cuts_windows_at_buckets(spark):
    rnd = random.Random(2)
    truth = [(1, rnd.randrange(60)) for _ in range(300)]
    indexed = [t for t in truth if rnd.random() < 0.99]
    w = [(1, lo, lo + rnd.randrange(40)) for lo in range(0, 60, 3)] + [(1, 70, 80), (2, 0, 5)]
    schema = "chain_id long, block_number long"
    for width in (1000, 10, 1):
        got = aggregates.window_completeness(spark.createDataFrame(w, "chain_id long, lo long, hi long"), spark.createDataFrame(indexed, schema), spark.createDataFrame(truth, schema), width)
        count = lambda t, c, lo, hi: sum(x == c and lo <= b <= hi for x, b in t)
        assert rows(got) == sorted((c, lo, hi, count(indexed, c, lo, hi), count(truth, c, lo, hi), count(indexed, c, lo, hi) == count(truth, c, lo, hi)) for c, lo, hi in w)


def test_reorg_windows_grow(spark):
    d = spark.createDataFrame([(1, 1, "a", "g")], "seq long, number long, hash string, parent_hash string")
    assert "unboundedfollowing" not in win.reorg_resolve(d)._jdf.queryExecution().toString().lower()


def test_relation_pages_are_bounded(spark):
    many = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    got = joins.relation_pages(spark.range(3).withColumnRenamed("id", "k"), many, ["k"], ["v"], F.floor(F.col("v") / 20)).collect()
    assert max(r.n_items for r in got) == 10
    assert sorted(x.v for r in got for x in r["items"] or []) == list(range(100))
    assert [(r.page, r.n_items) for r in got if r.k == 2] == [(None, 0)]


@pytest.mark.parametrize("span", [1, 3, 7, 50, 10**6])
def test_intervals_in_spans_equal_the_plain_form(spark, span):
    rnd = random.Random(6)
    own = [(f, lo, lo + rnd.choice([0, 1, 1, 2, 5, 40])) for f in range(6) for lo in (rnd.randint(0, 120) for _ in range(rnd.choice([1, 10, 40])))]
    df = spark.createDataFrame(own, "fragment_id long, lo long, hi long")
    covered = {f: {b for g, lo, hi in own if g == f for b in range(lo, hi)} for f in range(7)}
    want = sorted((f, b, next(e for e in range(b + 1, 300) if e not in c)) for f, c in covered.items() for b in c if b - 1 not in c)
    assert rows(win.coalesce_intervals(df, span), "fragment_id", "lo") == want
    wanted = spark.createDataFrame([(f, 20, 100) for f in range(7)], "fragment_id long, want_lo long, want_hi long")
    gaps = {(f, b) for f, lo, hi in rows(win.missing_ranges(df, wanted, span)) for b in range(lo, hi)}
    assert gaps == {(f, b) for f in range(7) for b in range(20, 100) if b not in covered[f]}


def test_a_long_fragment_is_many_tasks(spark):
    df = spark.range(20_000).selectExpr("1L AS fragment_id", "id * 10 AS lo", "id * 10 + CASE WHEN id % 100 < 50 THEN 10 ELSE 9 END AS hi")
    got = win.coalesce_intervals(df, 10_000)
    tasks = got.select(F.spark_partition_id().alias("t"), "lo").where("lo % 1000 > 500").groupBy("t").count().collect()
    assert got.count() == 10_000 and len(tasks) > 1 and rows(got) == rows(win.coalesce_intervals(df))


@pytest.mark.parametrize("span", [1, 4, 10**6])
def test_progress_goes_back_across_spans(spark, span):
    df = spark.createDataFrame([("a", k, v) for k, v in enumerate([1, 2, 3, 3, 2, 5, 1])] + [("b", k, k) for k in range(9)] + [("c", 3, 9), ("c", 4, 8)], "s string, at long, v long")
    assert rows(win.checkpoint_monotonic(df, "s", "at", "v", span), "s") == [("a", 4, 3, 2), ("c", 4, 9, 8)]


def test_a_factory_of_several_rows_is_not_crossed(spark):
    logs = spark.createDataFrame([(1, 1, a, t, "0x" + f"{k:064x}", "0x") for k, (a, t) in enumerate([("x", "s"), ("x", "t"), ("y", "s"), ("y", "t")])], "chain_id long, block_number long, address string, topic0 string, topic1 string, data string")
    f = spark.createDataFrame([("f", 1, "x", "s", None, None), ("f", 1, "y", "t", None, None), ("f", 1, "x", None, None, None)], "factory_id string, chain_id long, address string, topic0 string, from_block long, to_block long")
    assert sorted(int(r.child, 16) for r in joins.discover_children(logs, f).collect()) == [0, 3]


def test_ledger_repeats_removals_and_returns(spark, tmp_path):
    path, keys = str(tmp_path / "l"), ["chain_id", "who"]
    event, block = "chain_id long, who string, block_hash string", "chain_id long, block_hash string"
    one = [(1, "a", "h1"), (1, "a", "h1"), (1, "b", "h2")]
    batches = [(one, []), (one[:2] + [(1, "a", "h3")], []), ([(1, "a", "h4")], [(1, "h1"), (1, "h4")]), ([(1, "a", "h1"), (1, "a", "h1")], []), ([], [(1, "h2")])]
    want = [{"a": 2, "b": 1}, {"a": 3, "b": 1}, {"a": 1, "b": 1}, {"a": 3, "b": 1}, {"a": 3}]
    schema = spark.createDataFrame([], event).schema.add("delta", "long")

    def post(k):
        store.post_batch(spark.createDataFrame(batches[k][0], event), spark.createDataFrame(batches[k][1], block), path, k, keys)
        return {r.who: r.n for r in store.ledger_totals(store.read_ledger(spark, path, schema), keys).collect()}

    assert [post(k) for k in range(5)] == want
    assert [post(k) for k in (4, 1, 3, 0)] == [want[-1]] * 4  # batches that run again, after later ones too


@pytest.mark.parametrize("buckets", [1, 2, 7, 4096])
def test_percentiles_by_buckets_are_exact(spark, buckets):
    rnd = random.Random(9)
    own = [(g, v, 1, 0) for g, n, draw in (("one", 1, lambda: 3.5), ("tied", 50, lambda: 2.0), ("few", 7, lambda: rnd.choice([1.0, 2.0])), ("wide", 300, lambda: rnd.choice([rnd.random(), 1e9, -5.0])), ("many", 999, lambda: rnd.gauss(10, 3))) for v in (draw() for _ in range(n))]
    own += [("bad", 1.0, 0, 5)]
    df = spark.createDataFrame(own, "g string, latency double, ok int, at_s long")
    got = {r.g: (r.p50, r.p90, r.p95, r.p99) for r in aggregates.latency_percentiles(df, ["g"], buckets=buckets).collect()}
    for g in {x[0] for x in own}:
        v = sorted(x[1] for x in own if x[0] == g and x[2])
        assert got[g] == tuple(v[min(len(v) - 1, int(q * len(v)))] if v else None for q in (0.5, 0.9, 0.95, 0.99))
