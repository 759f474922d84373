"""From a source configuration to events: what the configuration says wrongly, and that tables are scanned once."""

import pytest
from pyspark.sql import functions as F

from chainframe.operators import handlers, routing

LOGS = "chain_id long, block_number long, log_index long, tx_hash string, address string, topics array<string>, data string"
WORD = "{:064x}".format


@pytest.fixture(scope="module")
def logs(spark):
    made = [(1, 5, 0, "t0", "0xF", ["0xC", "0x" + WORD(1)], "0x"), (1, 9, 0, "t1", "0xF", ["0xc", "0x" + WORD(2)], "0x")]
    events = [(1, n, k + 1, f"t{n}", f"0x{k:040x}", ["0xE", "0x" + WORD(k)], "0x" + WORD(n)) for n in range(3, 12) for k in (1, 2, 3)]
    return spark.createDataFrame(made + events, LOGS)


def config(**more):
    event = ("0xe", "Moved", [("who", "uint256", True), ("", "uint256", False)])
    return {"contracts": {"Vault": {"chains": {1: {"factory": {"topic0": "0xC", "address": "0xf"}, "from_block": 6}}, "events": [event]}, "One": {"chains": {1: {"address": "0x" + "0" * 39 + "3", "to_block": 7}}, "events": [event]}}, **more}


def test_events_by_source(spark, logs):
    routes = routing.Routes(spark, config(), {"logs": logs})
    got = {n: sorted((r.block_number, r.args["who"], int(r.args["word0"], 16)) for r in routes.event(n).collect()) for n in ("Vault:Moved", "One:Moved")}
    vault = [(n, f"0x{k:x}", n) for n in range(6, 12) for k in (1, 2) if k == 1 or n >= 9]
    assert got == {"Vault:Moved": sorted(vault), "One:Moved": [(n, "0x3", n) for n in range(3, 8)]}


def test_handlers_run_on_what_they_ask_for(spark, logs):
    h = handlers.Handlers()

    @h.on_event("Vault:Moved")
    def moved(events):
        return {"moves": events.groupBy("address").agg(F.count("*").alias("n"))}

    # no transactions, traces or blocks are given, and none are needed
    out = routing.run_config(spark, config(accounts={"A": {"chains": {1: {"address": "0x1"}}}}, blocks={"T": {"chains": {1: {"interval": 2}}}}), {"logs": logs}, h)
    assert sorted(r.n for r in out["moves"].collect()) == [3, 6]


def test_wrong_configurations_are_errors(spark, logs):
    with pytest.raises(ValueError, match="unknown sources"):
        routing.compiled(spark, {"contract": {}})
    with pytest.raises(ValueError, match="has no chains"):
        routing.compiled(spark, {"accounts": {"A": {}}})
    routes = routing.Routes(spark, config(), {"logs": logs})
    for name in ("Vault:Gone", "Other:Moved", "Vault.swap()", "A:transaction:from", "T:block", "Vault"):
        with pytest.raises(KeyError, match="has no event"):
            routes.event(name)


def test_sources_share_one_scan(spark, logs, tmp_path):
    logs.write.parquet(str(tmp_path / "l"))
    routes = routing.Routes(spark, config(), {"logs": spark.read.parquet(str(tmp_path / "l"))})
    plans = [routes.event(n)._jdf.queryExecution().executedPlan().toString() for n in ("Vault:Moved", "One:Moved")]
    assert not any(str(tmp_path) in p for p in plans) and len(routes._done) == 2  # children and matched logs


def test_functions_and_accounts_share_one_pass_over_traces(spark, logs):
    frame = "chain_id long, block_number long, transaction_index long, trace_index long, from_address string, to_address string, selector string, call_type string, value_hex string"
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    frames = [(1, 7, 0, 0, "0x1", "0x9", "0xaa", "CALL", "0x5"), (1, 7, 0, 1, "0x2", "0x3", "0xbb", "CALL", "0x0"), (1, 7, 0, 2, "0x1", "0x3", "0xbb", "CALL", "0x0"), (1, 7, 0, 3, "0x8", "0x8", "0xcc", "CALL", "0x1")]
    traces = spark.createDataFrame(frames, frame).mapInArrow(counted, frame)
    sources = {"contracts": {"P": {"chains": {1: {"address": "0x3"}}, "functions": {"0xBB": "swap"}}}, "accounts": {"A": {"chains": {1: {"address": "0x1"}}}}}
    routes = routing.Routes(spark, sources, {"logs": logs, "traces": traces})
    got = {n: sorted(r.trace_index for r in routes.event(n).collect()) for n in ("P.swap()", "A:transfer:from", "A:transfer:to")}
    assert got == {"P.swap()": [1, 2], "A:transfer:from": [0], "A:transfer:to": []}
    assert read.value == len(frames)
