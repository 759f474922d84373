"""Events whose arguments are words are read by expressions: the same as by Arrow batches, and pruned by Spark."""

from pyspark.sql import functions as F

from chainframe.functions import encodings
from chainframe.operators import handlers

SCHEMA = "n long, topic0 string, topic1 string, topic2 string, topic3 string, data string"
ARGS = [("a", "uint256", True), ("b", "address", True), ("", "bool", True), ("d", "bytes4", True), ("", "uint8", False), ("a", "address", False), ("g", "bool", False), ("h", "bytes32", False)]
WORD = "00AB".rjust(64, "0")


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def logs(spark):
    data = ["0x" + WORD * 4, "0x" + "0" * 256, "0x" + WORD + "12", "0x", None, "0X" + ("f" * 64) * 5, "0x" + "zz" * 128]
    topics = ["0x" + WORD, None, "0x", "0x" + "0" * 64, "0x" + "Ff" * 32, "0x12"]
    rows = [(k, "0xAA" if k % 3 else "0xbb", topics[k % 6], topics[(k + 1) % 6], topics[(k + 2) % 6], data[k % 7]) for k in range(84)]
    return spark.createDataFrame(rows, SCHEMA)


def signatures(spark):
    return spark.createDataFrame([("0xaa", "One", ARGS), ("0xBB", "None", [])], f"topic0 string, name string, args {encodings.ARGUMENTS}")


def test_words_by_expressions_are_those_of_arrow_batches(spark, monkeypatch):
    fast = encodings.decode_events(logs(spark), signatures(spark))
    assert "MapInArrow" not in plan_of(fast)
    monkeypatch.setattr(encodings, "MOST_LAYOUTS", 0)
    slow = encodings.decode_events(logs(spark), signatures(spark))
    assert "MapInArrow" in plan_of(slow) and fast.schema == slow.schema
    rows = lambda df: {r.n: (r.event_name, r.args) for r in df.collect()}
    assert len(rows(fast)) == 84 and rows(fast) == rows(slow)


def test_lending_rows_read_the_logs_once(spark):
    own = spark.createDataFrame([(event, f"h{k}", k, 1, "v", k, {"arg1": "x", "arg2": "y", "arg3": "z"}) for k, event in enumerate([*handlers.LENDING, "Other"])], "event_name string, tx_hash string, log_index long, chain_id long, address string, block_number long, args map<string,string>")
    got = handlers.lending_rows(own)
    assert plan_of(got).count("LogicalRDD") <= 1 and "Union" not in plan_of(got)
    for table, rows in handlers.lending_tables(own).items():
        assert got.where(F.col("t") == table).select(*rows.columns).collect() == rows.collect()
    assert got.count() == len(handlers.LENDING)
