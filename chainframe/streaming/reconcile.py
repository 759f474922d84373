"""Live headers: reorganisations, finality and stalls in one stateful processor per chain.

State is headers only: the unfinalised ones, by number in chunks of CHUNK, as each look into the state is a message to the
JVM, and a few facts, such as the anchor below them and the tip. A batch reads the chunks that it meets and writes those that
it adds to; it neither loads nor rewrites the window. Rows of a micro-batch are sorted by delivery; a header that doesn't attach is a gap, which is an error row, never a silent reset.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Items: kind is block (a header) or final (a finalised head; hash may be null).
ITEM = "chain_id bigint, seq bigint, kind string, number bigint, hash string, parent_hash string, at_s bigint"
#: Events: append, remove, duplicate, reorg (number: the common ancestor), finalize, defer; and those in FAULTS.
EVENT = "chain_id bigint, seq bigint, place int, event string, number bigint, hash string"
OUT = ["chain_id", "seq", "place", "event", "number", "hash"]
#: A header that doesn't attach; a finalised head on another fork; a head that was out of reach for too long; more
#: unfinalised headers than are kept; finality ahead while nothing is delivered.
FAULTS = ("gap", "conflict", "expired", "overflow", "stalled")
#: Events that are gathered before they are passed on; items in a file, and files in a micro-batch.
OUT_ROWS, FILE_ROWS, BATCH_FILES = 10_000, 20_000, 32
#: Numbers of headers that are stored together.
CHUNK = 256
FACTS = ("anchor_number", "anchor_hash", "tip_number", "tip_hash", "deferred_number", "deferred_hash", "deferred_at", "first_head", "last_head", "highest", "delivered_at")
_FACTS = ", ".join(f"{n} {'string' if n.endswith('hash') else 'bigint'}" for n in FACTS)

Event = tuple[str, int, str | None]


class ChainState:
    """One chain's unfinalised headers; a plain model, so that it can be tested without a stream.

    ``load`` gives the hash of a stored header by its number. Numbers of a chain follow each other, so a header's parent is
    looked up at the number below. What changed is in ``fresh`` (number -> hash) and in the facts.
    """

    def __init__(self, facts: tuple | None, load: Callable[[int], str], stall_blocks: int = 16, stall_seconds: int = 600, defer_seconds: int = 600, most: int = 50_000):
        for name, value in zip(FACTS, facts or (None,) * len(FACTS)):
            setattr(self, name, value)
        self.load, self.fresh = load, {}
        self.stored = range(self.anchor_number + 1, self.tip_number + 1) if self.tip_number is not None else range(0)
        self.stall_blocks, self.stall_seconds, self.defer_seconds, self.most = stall_blocks, stall_seconds, defer_seconds, most

    def facts(self) -> tuple:
        return tuple(getattr(self, n) for n in FACTS)

    def at(self, number: int) -> str | None:
        """The hash of the anchor or of the unfinalised header with this number."""
        if self.tip_number is None or not self.anchor_number <= number <= self.tip_number:
            return None
        if number == self.anchor_number:
            return self.anchor_hash
        if number not in self.fresh:
            self.fresh[number] = self.load(number)
        return self.fresh[number]

    def gone(self) -> list[int]:
        """Stored numbers that are finalised or rolled back."""
        return [n for n in self.stored if not self.anchor_number < n <= self.tip_number]

    def added(self) -> list[tuple[int, str]]:
        return [(n, h) for n, h in self.fresh.items() if self.anchor_number < n <= self.tip_number]

    def block(self, number: int, own: str, parent: str, at_s: int) -> Iterator[Event]:
        if self.at(number) == own:
            yield "duplicate", number, own
            return
        if self.tip_number is None:
            self.anchor_number, self.anchor_hash = number - 1, parent
            self.tip_number, self.tip_hash = number - 1, parent
        if self.at(number - 1) != parent:
            yield "gap", number, own
            return
        if number <= self.tip_number:
            gone = [(n, self.at(n)) for n in range(number, self.tip_number + 1)]
            self.tip_number, self.tip_hash = number - 1, parent
            yield "reorg", number - 1, parent
            for n, h in gone:
                self.fresh.pop(n, None)
                yield "remove", n, h
        self.fresh[number] = own
        self.tip_number, self.tip_hash = number, own
        self.highest = max(number, self.highest if self.highest is not None else number)
        self.delivered_at = at_s
        yield "append", number, own
        if number - self.anchor_number > self.most:
            yield "overflow", number, own
        if self.deferred_number is not None and self.deferred_number <= number:
            yield from self._finalize(self.deferred_number, self.deferred_hash, at_s)

    def reached(self) -> int:
        return max(self.first_head, self.highest if self.highest is not None else self.first_head)

    def starving(self) -> bool:
        """The last head is far above all that was delivered and above the first head."""
        return self.last_head is not None and self.last_head - self.reached() >= self.stall_blocks

    def final(self, number: int, own: str | None, at_s: int) -> Iterator[Event]:
        if self.first_head is None:
            self.first_head = number
        if self.delivered_at is None:
            self.delivered_at = at_s
        self.last_head = number
        if self.starving() and at_s - self.delivered_at >= self.stall_seconds:
            yield "stalled", number, own
        yield from self._finalize(number, own, at_s)

    def _finalize(self, number: int, own: str | None, at_s: int) -> Iterator[Event]:
        lags = self.tip_number is not None and self.anchor_number < self.tip_number < number
        if lags and own is not None:  # which fork the head is on can't be told yet
            self.deferred_at = at_s if self.deferred_at is None else self.deferred_at
            if at_s - self.deferred_at >= self.defer_seconds:
                yield "expired", number, own
            elif self.deferred_number is None or number > self.deferred_number:
                self.deferred_number, self.deferred_hash = number, own
                yield "defer", number, own
            return
        self.deferred_number = self.deferred_hash = self.deferred_at = None
        if lags:  # a head without a hash counts by its number
            number = self.tip_number
        if self.tip_number is None or number > self.tip_number or number < self.anchor_number:  # finality never goes back
            return
        header = self.at(number)
        if own is not None and own != header:
            yield "conflict", number, own
        elif number > self.anchor_number:
            for n in range(self.anchor_number + 1, number + 1):
                self.fresh.pop(n, None)
            self.anchor_number, self.anchor_hash = number, header
            yield "finalize", number, header


class Reconciler(StatefulProcessor):
    def __init__(self, limits: dict):
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.headers = handle.getMapState("chunks", "chunk bigint", "hashes string")
        self.facts = handle.getValueState("facts", _FACTS)

    def _state(self) -> ChainState:
        self.chunks: dict[int, dict[str, str]] = {}
        return ChainState(self.facts.get() if self.facts.exists() else None, lambda n: self._chunk(n // CHUNK)[str(n)], **self.limits)

    def _chunk(self, k: int) -> dict[str, str]:
        """A stored chunk: hashes by their numbers as text. It may hold numbers that have gone since."""
        if k not in self.chunks:
            self.chunks[k] = json.loads(self.headers.getValue((k,))[0])
        return self.chunks[k]

    def _store(self, state: ChainState) -> None:
        """Write chunks that got headers, and drop those of which none is left."""
        had = range(state.stored.start // CHUNK, (state.stored.stop - 1) // CHUNK + 1) if state.stored else range(0)
        added: dict[int, dict[str, str]] = {}
        for number, own in state.added():
            added.setdefault(number // CHUNK, {})[str(number)] = own
        for k, new in added.items():
            old = self._chunk(k) if k in had else {}
            both = {n: h for n, h in (old | new).items() if state.anchor_number < int(n) <= state.tip_number}
            if k not in had or any(old.get(n) != h for n, h in new.items()):
                self.headers.updateValue((k,), (json.dumps(both),))
        for k in had:
            if state.tip_number <= state.anchor_number or not (state.anchor_number + 1) // CHUNK <= k <= state.tip_number // CHUNK:
                self.headers.removeKey((k,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        items = pd.concat(list(rows)).sort_values("seq", kind="stable")  # a micro-batch is bounded: see ordered_items
        state, out = self._state(), []
        for seq, kind, number, own, parent, at_s in items[["seq", "kind", "number", "hash", "parent_hash", "at_s"]].itertuples(index=False):
            own = own if isinstance(own, str) else None
            events = state.block(number, own, parent, at_s) if kind == "block" else state.final(number, own, at_s)
            out += [(key[0], seq, place, *e) for place, e in enumerate(events)]
            if len(out) >= OUT_ROWS:
                yield pd.DataFrame(out, columns=OUT)
                out = []
        self._store(state)
        self.facts.update(tuple(None if v is None else v if isinstance(v, str) else int(v) for v in state.facts()))
        self._watch(state, timerValues)
        yield pd.DataFrame(out, columns=OUT)

    def _watch(self, state: ChainState, timerValues) -> None:
        pass

    def close(self) -> None:
        pass


class WatchedReconciler(Reconciler):
    """Also tells of a stall while no item comes at all: a timer runs while the last head is far ahead."""

    def _watch(self, state: ChainState, timerValues) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at if isinstance(at, int) else at[0])
        if state.starving():
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + state.stall_seconds * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._state()
        out = [(key[0], None, 0, "stalled", state.last_head, None)] if state.starving() else []
        yield pd.DataFrame(out, columns=OUT)


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def ordered_items(items: DataFrame, path: str, most: int = FILE_ROWS, together: bool = False) -> None:
    """Write ``items``, each chain on its own by seq in files of ``most`` rows. A task writes a chain's files one after another,
    as the source reads files by their time, and chains are written side by side. Read with BATCH_FILES files a batch, chains
    of any length need the memory of that many files, and a batch's chains are groups of their own. Sorting spills.

    ``together`` is for many short chains: a file holds as many of them as fit, one after another, so that files, and
    micro-batches of them, number as the rows ask and not as the chains do. A chain still is one task's, in its order.
    """
    out = items.repartition("chain_id").sortWithinPartitions("chain_id", "seq").write.option("maxRecordsPerFile", most)
    (out if together else out.partitionBy("chain_id")).parquet(path)


def stream_reconcile(items: DataFrame, fail: bool = True, timer: bool = False, stall_blocks: int = 16, stall_seconds: int = 600, defer_seconds: int = 600, most: int = 50_000) -> DataFrame:
    """Events of a stream of ITEM rows. The session needs the RocksDB state store: see use_rocksdb.

    A fault (see FAULTS) stops the query, unless ``fail`` is false: then it is a row. A finalised head with a hash that lies
    above the tip is deferred for ``defer_seconds`` at most; ``most`` unfinalised headers are kept. ``timer`` looks for
    stalls by the clock as well, for queries that run on; a query over what is there ends without it.
    """
    limits = {"stall_blocks": stall_blocks, "stall_seconds": stall_seconds, "defer_seconds": defer_seconds, "most": most}
    events = items.groupBy("chain_id").transformWithStateInPandas(
        statefulProcessor=(WatchedReconciler if timer else Reconciler)(limits), outputStructType=EVENT, outputMode="Append", timeMode="ProcessingTime" if timer else "None"
    )
    return fail_on_fault(events) if fail else events


def stream_finalize(events: DataFrame) -> DataFrame:
    """What finality did: finalize, defer, expired and conflict events. Their items go into the same stream as the headers'."""
    return events.where(F.col("event").isin("finalize", "defer", "expired", "conflict"))


def stream_progress_watchdog(events: DataFrame) -> DataFrame:
    """Stalls: the finalised head ran ahead while nothing was delivered. A quiet chain has none."""
    return events.where("event = 'stalled'")


def fail_on_fault(events: DataFrame) -> DataFrame:
    """The events; a fault stops the query."""
    text = F.concat_ws(" ", F.lit("chain"), F.col("chain_id").cast("string"), "event", F.lit("at"), F.col("number").cast("string"))
    return events.where(F.when(F.col("event").isin(*FAULTS), F.raise_error(text).cast("boolean")).otherwise(True))
