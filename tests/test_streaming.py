"""The reconciler as a model and as a stream over several batches."""

import random
import time

import pytest

from chainframe.streaming import reconcile, sinks


def run(state, *items):
    out = []
    for kind, *a in items:
        out += list(state.block(*a) if kind == "b" else state.final(*a))
    return out


def fresh(**limits):
    return reconcile.ChainState(None, {}.__getitem__, **{"stall_seconds": 300, **limits})


def test_append_duplicate_reorg_gap():
    s = fresh()
    got = run(s, ("b", 1, "a", "g", 0), ("b", 2, "b", "a", 0), ("b", 2, "b", "a", 0), ("b", 2, "c", "a", 0), ("b", 9, "z", "y", 0), ("b", 1, "d", "g", 0))
    assert got == [("append", 1, "a"), ("append", 2, "b"), ("duplicate", 2, "b"), ("reorg", 1, "a"), ("remove", 2, "b"), ("append", 2, "c"), ("gap", 9, "z"), ("reorg", 0, "g"), ("remove", 1, "a"), ("remove", 2, "c"), ("append", 1, "d")]


def test_finality_is_monotone_defers_and_conflicts():
    s = fresh()
    got = run(s, ("b", 1, "a", "g", 0), ("f", 2, "b", 0), ("b", 2, "b", "a", 0), ("f", 1, None, 0), ("f", 2, "x", 0), ("b", 3, "c", "b", 0), ("f", 3, "zz", 0), ("b", 2, "q", "a", 0))
    assert got == [("append", 1, "a"), ("defer", 2, "b"), ("append", 2, "b"), ("finalize", 2, "b"), ("conflict", 2, "x"), ("append", 3, "c"), ("conflict", 3, "zz"), ("gap", 2, "q")]


def test_a_head_without_a_hash_counts_by_its_number():
    assert run(fresh(), ("b", 1, "a", "g", 0), ("b", 2, "b", "a", 0), ("f", 9, None, 0)) == [("append", 1, "a"), ("append", 2, "b"), ("finalize", 2, "b")]


def test_deferring_ends_in_a_fault():
    s = fresh(defer_seconds=100, stall_blocks=1000)
    got = run(s, ("b", 1, "a", "g", 0), ("f", 5, "e", 10), ("f", 6, "x", 109), ("f", 7, "y", 110), ("b", 2, "b", "a", 111))
    assert got == [("append", 1, "a"), ("defer", 5, "e"), ("defer", 6, "x"), ("expired", 7, "y"), ("append", 2, "b")]
    s = fresh(defer_seconds=100, stall_blocks=1000)  # a head that is within reach ends the streak
    got = run(s, ("b", 1, "a", "g", 0), ("b", 2, "b", "a", 0), ("f", 5, "e", 10), ("f", 1, "a", 60), ("f", 6, "x", 130))
    assert got == [("append", 1, "a"), ("append", 2, "b"), ("defer", 5, "e"), ("finalize", 1, "a"), ("defer", 6, "x")]


def test_more_headers_than_are_kept_are_a_fault():
    got = run(fresh(most=3), *(("b", k, f"h{k}", f"h{k - 1}", 0) for k in range(1, 6)))
    assert [e for e, *_ in got] == ["append"] * 4 + ["overflow", "append", "overflow"]


def test_watchdog_spares_a_quiet_chain():
    s = fresh()
    items = ("b", 1, "a", "g", 0), ("f", 1, None, 1000), ("f", 10, None, 2000), ("f", 17, None, 2001), ("f", 40, None, 2001)
    assert [e for e, *_ in run(s, *items)] == ["append", "finalize", "stalled", "stalled"]  # 17 is 16 above the delivered block
    s = fresh()  # a first head far above, as after a pause, is where counting starts
    assert [e for e, *_ in run(s, ("b", 1, "a", "g", 0), ("f", 500, None, 1000), ("f", 515, None, 2000), ("f", 516, None, 2000))] == ["append", "finalize", "stalled"]
    s = fresh()
    assert [e for e, *_ in run(s, ("b", 1, "a", "g", 0), ("f", 1, None, 10), ("f", 20, None, 299), ("f", 21, None, 300))] == ["append", "finalize", "stalled"]


def test_state_that_is_stored_and_loaded_is_the_same_at_any_cut():
    rnd, chain, items = random.Random(4), [(0, "g")], []
    for k in range(200):
        chain = chain[: max(1, len(chain) - rnd.choice([0] * 6 + [1, 2]))] if len(chain) > 12 else chain
        n = chain[-1][0] + 1
        items.append(("b", n, f"h{k}", chain[-1][1], k))
        chain.append((n, f"h{k}"))
        if rnd.random() < 0.1:
            items.append(items[-1])
        if rnd.random() < 0.1 and len(chain) > 12:
            items.append(("f", chain[-8][0], chain[-8][1], k))
    whole = run(fresh(), *items)
    for size in (1, 7):
        facts, stored, out = None, {}, []
        for k in range(0, len(items), size):
            s = reconcile.ChainState(facts, stored.__getitem__, stall_seconds=300)
            out += run(s, *items[k : k + size])
            for n in s.gone():
                del stored[n]
            stored.update(s.added())
            facts = s.facts()
            assert sorted(stored) == list(range(s.anchor_number + 1, s.tip_number + 1))
        assert out == whole


def test_stream_over_batches(spark, tmp_path):
    reconcile.use_rocksdb(spark)
    batches = [
        [(1, 1, "block", 1, "a", "g", 0), (1, 2, "block", 2, "b", "a", 1)],
        [(1, 3, "block", 2, "c", "a", 2), (1, 4, "block", 3, "d", "c", 3), (1, 5, "final", 2, None, None, 4)],
        [(1, 6, "block", 3, "d", "c", 5), (1, 7, "block", 4, "e", "d", 6)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, reconcile.ITEM).write.mode("append").parquet(str(tmp_path / "in"))
        stream = reconcile.stream_reconcile(sinks.stream_blocks(spark, str(tmp_path / "in"), reconcile.ITEM))
        sinks.run_available(stream, sinks.recorded(sinks.stream_rollback(str(tmp_path / "log")), str(tmp_path / "times")), str(tmp_path / "checkpoint"))
    log = sinks.log_of(spark, str(tmp_path / "log"), "chain_id bigint, seq bigint, place int, event string, number bigint, hash string")
    assert sorted((r.number, r.hash) for r in sinks.live_blocks(log).collect()) == [(1, "a"), (2, "c"), (3, "d"), (4, "e")]
    children = spark.createDataFrame([(1, "x", 2, "b"), (1, "y", 2, "c"), (1, "x", 4, "e"), (1, "z", 1, "a")], "chain_id long, child string, created_block long, block_hash string")
    assert sorted(map(tuple, sinks.live_children(children, log).collect())) == [(1, "x", 4), (1, "y", 2), (1, "z", 1)]
    fresh_ = sinks.freshness_of(spark, str(tmp_path / "times")).collect()
    assert [r.state for r in fresh_] == ["ack"] * 3 and all(r.latency_ms >= 0 for r in fresh_)


def test_a_fault_stops_the_query_and_is_recorded(spark, tmp_path):
    reconcile.use_rocksdb(spark)
    spark.createDataFrame([(1, 1, "block", 1, "a", "g", 0), (1, 2, "block", 5, "e", "d", 1)], reconcile.ITEM).write.parquet(str(tmp_path / "in"))
    stream = reconcile.stream_reconcile(sinks.stream_blocks(spark, str(tmp_path / "in"), reconcile.ITEM))
    with pytest.raises(Exception, match="chain 1 gap at 5"):
        sinks.run_available(stream, sinks.recorded(sinks.stream_rollback(str(tmp_path / "log")), str(tmp_path / "times")), str(tmp_path / "checkpoint"))
    assert [r.state for r in sinks.freshness_of(spark, str(tmp_path / "times")).collect()] == ["reject"]


def test_a_timer_tells_of_a_stall_without_items(spark, tmp_path):
    reconcile.use_rocksdb(spark)
    rows = [(1, 1, "block", 1, "a", "g", 0), (1, 2, "final", 1, "a", None, 1), (1, 3, "final", 40, "z", None, 1), (2, 4, "block", 1, "q", "p", 0), (2, 5, "final", 1, "q", None, 1)]
    spark.createDataFrame(rows, reconcile.ITEM).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = reconcile.stream_reconcile(sinks.stream_blocks(spark, str(tmp_path / "in"), reconcile.ITEM), fail=False, timer=True, stall_seconds=2)
    q = stream.writeStream.foreachBatch(lambda df, i: sinks.write_batch(df, i, str(tmp_path / "log"))).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            found = sinks.log_of(spark, str(tmp_path / "log"), reconcile.EVENT).where("event = 'stalled'").collect()
            if found:
                break
    finally:
        q.stop()
    assert {(r.chain_id, r.number, r.seq) for r in found} == {(1, 40, None)}


def test_children_logs_are_compacted(spark, tmp_path):
    schema = "chain_id long, block_number long, log_index long, address string, topic0 string, topic1 string, data string"
    factories = spark.createDataFrame([("f", 1, None, "0xc", None, None)], "factory_id string, chain_id long, address string, topic0 string, from_block long, to_block long")
    made, base = [], str(tmp_path)
    run_ = sinks.stream_children(factories, f"{base}/children", f"{base}/logs", every=3)
    for k in range(8):
        rows = [(1, k, 0, "0xmaker", "0xc", "0x" + f"{k % 5:064x}", "0x"), *((1, k, 1 + j, "0x" + f"{j:040x}", "0xe", None, "0x") for j in range(6))]
        made += rows
        run_(spark.createDataFrame(rows, schema), k)
        run_(spark.createDataFrame(rows, schema), k)  # a batch that runs again
    got = sorted((r.block_number, r.address) for r in sinks.log_of(spark, f"{base}/logs", schema).collect())
    first = {f"0x{k:040x}": k for k in range(5)}
    assert got == sorted((r[1], r[3]) for r in made if r[3] in first and r[1] >= first[r[3]])
    assert sorted(x.name for x in (tmp_path / "children-whole").iterdir()) == ["2", "5"]


def test_stalls_are_looked_for_all_over_the_table(spark):
    from chainframe import plans

    folder = "/root/testdata/sf0.01"
    last = spark.read.parquet(f"{folder}/events.parquet").count()
    got = sorted(r.number for r in plans.queries()["stream_progress_watchdog_all"](spark, folder).collect())
    assert got == [n for n in range(1, last + 1) if n % 1000 in (531, 541, 551, 561, 571, 581, 591)] and got[-1] > 590


def test_a_long_chain_is_read_in_bounded_ordered_batches(spark, tmp_path):
    from chainframe.streaming import reconcile, sinks

    n = 1000
    rows = [(1, k, "block", k, f"h{k}", f"h{k - 1}", k * 12) for k in range(1, n + 1)]
    reconcile.ordered_items(spark.createDataFrame(rows[::-1], reconcile.ITEM).repartition(4), str(tmp_path / "in"), most=300)
    reconcile.use_rocksdb(spark)
    stream = reconcile.stream_reconcile(sinks.stream_blocks(spark, str(tmp_path / "in"), reconcile.ITEM, files_per_batch=1))
    sinks.run_available(stream, lambda df, i: sinks.write_batch(df, i, str(tmp_path / "log")), str(tmp_path / "checkpoint"))
    got = spark.read.parquet(str(tmp_path / "log")).select("event", "number", "batch_id").collect()
    assert sorted((r.event, r.number) for r in got) == [("append", k) for k in range(1, n + 1)]
    assert {r.number: r.batch_id for r in got} == {k: (k - 1) // 300 for k in range(1, n + 1)}


def test_reconciler_passes_events_on_before_the_end(monkeypatch):
    import pandas as pd

    from chainframe.streaming import reconcile

    class State:
        def __init__(self):
            self.value = None

        def get(self):
            return self.value or []

        def exists(self):
            return self.value is not None

        def put(self, value):
            self.value = value

        update = put

        def clear(self):
            self.value = None

        def updateValue(self, key, value):
            pass

    monkeypatch.setattr(reconcile, "OUT_ROWS", 10)
    r = reconcile.Reconciler({})
    r.headers, r.facts = State(), State()
    items = pd.DataFrame([(k, "block", k, f"h{k}", f"h{k - 1}", k) for k in range(1, 36)], columns=["seq", "kind", "number", "hash", "parent_hash", "at_s"])
    assert [len(x) for x in r.handleInputRows((1,), iter([items]), None)] == [10, 10, 10, 5]


def test_throughput_in_spans_and_bounded_relation_join(spark):
    from pyspark.sql import functions as F

    from chainframe.operators import aggregates, joins

    counters = spark.range(0, 500, 3).select(F.col("id").alias("at_s"), (F.col("id") * 3).alias("rows"), (F.col("id") * F.col("id")).alias("bytes"), F.floor(F.col("id") / 7).alias("errors"))
    assert sorted(aggregates.throughput(counters, 10, 0.5, span=4).collect()) == sorted(aggregates.throughput(counters, 10, 0.5).collect())
    many = spark.range(100).select((F.col("id") % 2).alias("k"), (-F.col("id")).alias("v"))
    got = joins.relation_join(spark.range(3).withColumnRenamed("id", "k"), many, ["k"], ["v"], most=3)
    assert "Window" in got._jdf.queryExecution().optimizedPlan().toString()
    assert {r.k: ([x.v for x in r["items"] or []], r.n_items) for r in got.collect()} == {0: ([-98, -96, -94], 50), 1: ([-99, -97, -95], 50), 2: ([], 0)}


def test_chains_are_groups_in_tasks_of_their_own(spark, tmp_path):
    rows = [(c, k, "block", k, f"h{c}-{k}", f"h{c}-{k - 1}", k) for c in range(1, 9) for k in range(1, 41)]
    items = spark.createDataFrame(rows[::-1], reconcile.ITEM).repartition(3)
    reconcile.ordered_items(items, str(tmp_path / "in"), most=15)
    assert {p.name for p in (tmp_path / "in").iterdir() if p.is_dir()} == {f"chain_id={c}" for c in range(1, 9)}
    reconcile.use_rocksdb(spark)
    stream = reconcile.stream_reconcile(sinks.stream_blocks(spark, str(tmp_path / "in"), reconcile.ITEM, files_per_batch=reconcile.BATCH_FILES))
    sinks.run_available(stream, sinks.stream_rollback(str(tmp_path / "log"), every=2), str(tmp_path / "checkpoint"))
    files = [spark.read.parquet(str(p)).select("chain_id").distinct().collect() for p in (tmp_path / "log" / "batch_id=0").glob("*.parquet")]
    chains = [{r.chain_id for r in f} for f in files if f]
    assert len(chains) >= 2 and sum(map(len, chains)) == len(set().union(*chains)) == 8  # several tasks, each chain in one of them
    live = sinks.live_blocks(sinks.rolled(spark, str(tmp_path / "log"), every=2)).collect()
    assert sorted((r.chain_id, r.number) for r in live) == [(c, k) for c in range(1, 9) for k in range(1, 41)]


def test_rollback_logs_are_compacted(spark, tmp_path):
    sink, path = sinks.stream_rollback(str(tmp_path / "log"), every=3), str(tmp_path / "log")
    seq, want = 0, {}
    rnd = random.Random(2)
    for k in range(8):
        rows = []
        for _ in range(5):
            seq += 1
            number = rnd.randint(1, 6)
            event = "remove" if number in want else "append"
            want.pop(number, None) if event == "remove" else want.update({number: f"h{number}"})
            rows.append((1, seq, 0, event, number, f"h{number}"))
        for _ in range(2):  # a batch that runs again
            sink(spark.createDataFrame([*rows, (1, seq, 1, "finalize", 1, "h1")], sinks.ROLLED), k)
        got = {r.number: r.hash for r in sinks.live_blocks(sinks.rolled(spark, path, every=3)).collect()}
        assert got == want
    assert sorted(p.name for p in (tmp_path / "log-whole").iterdir()) == ["2", "5"]
    whole = spark.read.parquet(f"{path}-whole/5")
    assert whole.count() == whole.select("number").distinct().count() <= 6


def test_short_chains_share_files_and_batches(spark, tmp_path):
    rows = [(c, k, "block", k, f"h{c}-{k}", f"h{c}-{k - 1}", k) for c in range(1, 61) for k in range(1, 11)]
    reconcile.ordered_items(spark.createDataFrame(rows[::-1], reconcile.ITEM).repartition(3), str(tmp_path / "in"), most=45, together=True)
    files = list((tmp_path / "in").glob("*.parquet"))
    assert len(files) <= 600 / 45 + 8  # not one for each of 60 chains
    reconcile.use_rocksdb(spark)
    stream = reconcile.stream_reconcile(sinks.stream_blocks(spark, str(tmp_path / "in"), reconcile.ITEM, files_per_batch=4))
    sinks.run_available(stream, lambda df, i: sinks.write_batch(df, i, str(tmp_path / "log")), str(tmp_path / "checkpoint"))
    got = sinks.log_of(spark, str(tmp_path / "log"), sinks.ROLLED).collect()
    assert sorted((r.chain_id, r.number, r.event) for r in got) == [(c, k, "append") for c in range(1, 61) for k in range(1, 11)]
    assert len({r.batch_id for r in got}) > 1  # chains that are cut by a file go on in their order


def test_a_log_is_rewritten_by_powers_and_not_as_a_whole(spark, tmp_path):
    sink, path = sinks.stream_rollback(str(tmp_path / "log"), every=2), str(tmp_path / "log")
    for k in range(13):
        rows = [(1, 10 * k, 0, "append", k, f"h{k}"), *([(1, 10 * k - 1, 0, "remove", k - 3, f"h{k - 3}")] if k % 4 == 3 else [])]
        sink(spark.createDataFrame(rows, sinks.ROLLED), k)
        gone = {j - 3 for j in range(3, k + 1, 4)}
        assert {r.number for r in sinks.live_blocks(sinks.rolled(spark, path, every=2)).collect()} == set(range(k + 1)) - gone
    numbers = {int(p.name): {r.number for r in spark.read.parquet(str(p)).collect()} for p in (tmp_path / "log-whole").iterdir()}
    assert numbers == {1: {0, 1}, 3: {0, 1, 2, 3}, 5: {4, 5}, 7: set(range(8)), 9: {8, 9}, 11: {8, 9, 10, 11}}


def test_headers_are_stored_in_chunks_at_any_cut(monkeypatch):
    import pandas as pd

    class Kept(dict):
        calls = 0

        def getValue(self, key):
            Kept.calls += 1
            return self[key]

        def updateValue(self, key, value):
            Kept.calls += 1
            self[key] = value

        def removeKey(self, key):
            Kept.calls += 1
            del self[key]

    class Facts:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    rnd, chain, rows = random.Random(4), [(0, "g")], []
    for k in range(300):
        chain = chain[: max(1, len(chain) - rnd.choice([0] * 6 + [1, 2, 9]))] if len(chain) > 22 else chain
        n = chain[-1][0] + 1
        rows.append((len(rows), "block", n, f"h{k}", chain[-1][1], k))
        chain.append((n, f"h{k}"))
        if rnd.random() < 0.05 and len(chain) > 20:
            rows.append((len(rows), "final", chain[-15][0], chain[-15][1], None, k))
    items = pd.DataFrame(rows, columns=["seq", "kind", "number", "hash", "parent_hash", "at_s"])

    def events(chunk, size):
        monkeypatch.setattr(reconcile, "CHUNK", chunk)
        r = reconcile.Reconciler({})
        r.headers, r.facts, out = Kept(), Facts(), []
        for k in range(0, len(items), size):
            out += [e for part in r.handleInputRows((1,), iter([items[k : k + size]]), None) for e in part[["seq", "place", "event", "number"]].itertuples(index=False, name=None)]
            s = r._state()
            live = [s.load(n) for n in s.stored]
            assert len(live) == len(s.stored) and all(live) and all(min(s.stored) // chunk <= k[0] <= max(s.stored) // chunk for k in r.headers)
        return out

    whole = events(4, len(items))
    assert all(events(chunk, size) == whole for chunk, size in ((4, 1), (4, 7), (256, 50)))
    Kept.calls = 0
    events(256, len(items))
    assert Kept.calls < 5  # a write, and what the test reads; not one for each header


def test_a_batch_of_logs_is_read_from_files_and_not_cached(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: pytest.fail("cached"))
    factories = spark.createDataFrame([("f", 1, None, "0xmade", None, None)], "factory_id string, chain_id long, address string, topic0 string, from_block long, to_block long")
    sink = sinks.stream_children(factories, str(tmp_path / "children"), str(tmp_path / "logs"))
    child = "0x" + "0" * 39 + "7"
    for k in range(2):
        rows = [(1, 2 * k, 0, "0xf", "0xmade", "0x" + child[2:].rjust(64, "0"), "0x"), (1, 2 * k + 1, 0, child, "0xother", None, "0x")]
        sink(spark.createDataFrame(rows, "chain_id long, block_number long, log_index long, address string, topic0 string, topic1 string, data string"), k)
    assert sorted(r.block_number for r in spark.read.parquet(str(tmp_path / "logs")).collect()) == [1, 3]
    assert sorted(r.block_number for r in spark.read.parquet(str(tmp_path / "logs-batch")).collect()) == [2, 3]
