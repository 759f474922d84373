"""From a source configuration to filters, and from matched rows to events by name.

A configuration names what an application listens to:

    {"contracts": {"Vault": {"chains": {1: {"factory": {"address": ["0x.."], "topic0": "0x..", "location": "topic1"}, "from_block": 5}},
                             "events": [("0x..", "Deposit", [("account", "address", True), ("assets", "uint256", False)])],
                             "functions": {"0x38ed1739": "swap"}}},
     "accounts": {"Router": {"chains": {1: {"address": ["0x.."]}}}},
     "blocks": {"Ticks": {"chains": {1: {"interval": 100, "offset": 0}}}}}

Each table is scanned once, by the filters of all sources together; what matched is settled, and sources pick their own rows
from that. Events are called ``Vault:Deposit``, ``Vault.swap()``, ``Router:transaction:from``, ``Router:transaction:to``,
``Router:transfer:from``, ``Router:transfer:to`` and ``Ticks:block``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainframe.functions.encodings import ARGUMENTS, decode_events
from chainframe.operators import filters
from chainframe.operators.handlers import Handlers
from chainframe.operators.joins import discover_children
from chainframe.scratch import settled

RANGE = "from_block long, to_block long"
FACTORIES = f"factory_id string, chain_id long, address array<string>, topic0 string, location string, {RANGE}"
LOGS = f"source string, chain_id long, address array<string>, address_factory string, topic0 array<string>, {RANGE}"
SIDES = f"source string, chain_id long, from_address array<string>, to_address array<string>, to_address_factory string, selector array<string>, {RANGE}"
BLOCKS = f"source string, chain_id long, interval long, offset long, {RANGE}"
SIGNATURES = f"source string, topic0 string, name string, args {ARGUMENTS}"


def listed(value) -> list[str] | None:
    """An address or a list of them as a list; None is any."""
    return None if value is None else [value] if isinstance(value, str) else list(value)


def compiled(spark: SparkSession, config: dict) -> dict[str, DataFrame]:
    """Tables of the configuration: factories, signatures, and the filters of logs, calls, transactions and blocks, each row
    with its source. An unknown part of the configuration is an error, and so is a source without chains."""
    if unknown := set(config) - {"contracts", "accounts", "blocks"}:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    for kind, sources in config.items():
        for name, s in sources.items():
            if not s.get("chains"):
                raise ValueError(f"{kind} {name} has no chains")
    rows: dict[str, list[tuple]] = {n: [] for n in ("factories", "signatures", "logs", "calls", "transactions", "blocks")}
    for name, s in config.get("contracts", {}).items():
        events = s.get("events", [])
        rows["signatures"] += [(name, topic0, event, [tuple(a) for a in args]) for topic0, event, args in events]
        for chain, at in s["chains"].items():
            bounds, address, factory = (at.get("from_block"), at.get("to_block")), listed(at.get("address")), None
            if made := at.get("factory"):
                factory = f"{name}-{chain}"
                rows["factories"].append((factory, chain, listed(made.get("address")), made["topic0"], made.get("location", "topic1"), made.get("from_block"), made.get("to_block")))
            if events:
                rows["logs"].append((name, chain, address, factory, [t for t, *_ in events], *bounds))
            if s.get("functions"):
                rows["calls"].append((name, chain, None, address, factory, list(s["functions"]), *bounds))
    for name, s in config.get("accounts", {}).items():
        for chain, at in s["chains"].items():
            bounds, own = (at.get("from_block"), at.get("to_block")), listed(at["address"])
            rows["transactions"] += [(f"{name}:{side}", chain, *((own, None) if side == "from" else (None, own)), None, None, *bounds) for side in ("from", "to")]
    for name, s in config.get("blocks", {}).items():
        rows["blocks"] += [(name, chain, at["interval"], at.get("offset", 0), at.get("from_block"), at.get("to_block")) for chain, at in s["chains"].items()]
    schemas = {"factories": FACTORIES, "signatures": SIGNATURES, "logs": LOGS, "calls": SIDES, "transactions": SIDES, "blocks": BLOCKS}
    return {n: spark.createDataFrame(r, schemas[n]) for n, r in rows.items()}


class Routes:
    """Events of a configuration over ``tables``: logs, and if sources need them transactions, traces (ranked frames with
    selector) and blocks. Only what handlers ask for is matched: ``names`` are the events that will be asked for, or any."""

    def __init__(self, spark: SparkSession, config: dict, tables: dict[str, DataFrame], names: list[str] | None = None):
        self.spark, self.config, self.tables, self.of, self._done = spark, config, tables, compiled(spark, config), {}
        self.of["transactions"] = self.of["transactions"].where("from_address IS NOT NULL OR to_address IS NOT NULL")
        # the filters that traces are asked by: functions' calls and accounts' transfers
        self.kinds = [k for k, asks in (("calls", lambda n: n.endswith("()")), ("transactions", lambda n: ":transfer:" in n)) if names is None or any(map(asks, names))]

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._done:
            self._done[name] = settled(make())
        return self._done[name]

    def children(self) -> DataFrame | None:
        """Contracts that the configuration's factories made, over all logs, before any data is matched."""
        if self.of["factories"].isEmpty():
            return None
        return self._once("children", lambda: discover_children(self.tables["logs"], self.of["factories"]))

    def _logs(self) -> DataFrame:
        return self._once("logs", lambda: filters.match_logs(self.tables["logs"], self.of["logs"].drop("source"), self.children()))

    def _transactions(self) -> DataFrame:
        return self._once("transactions", lambda: filters.match_transactions(self.tables["transactions"], self.of["transactions"].drop("source", "selector"), self.children()))

    def _traces(self) -> DataFrame:
        """Frames that any function or account wants, in one pass over the traces: ranked frames are dear to make."""
        own = reduce(DataFrame.unionByName, (self.of[k].drop("source") for k in self.kinds))
        return self._once("traces", lambda: filters.match_traces(self.tables["traces"], own, self.children()))

    def event(self, name: str) -> DataFrame:
        """Rows of the event ``name``; one that the configuration doesn't have is an error."""
        contracts, accounts = self.config.get("contracts", {}), self.config.get("accounts", {})
        if name.endswith("()") and "." in name:
            source, function = name[:-2].split(".", 1)
            selectors = [k.lower() for k, v in contracts.get(source, {}).get("functions", {}).items() if v == function]
            if selectors:
                own = self.of["calls"].where(F.col("source") == source).drop("source").withColumn("selector", F.array(*map(F.lit, selectors)))
                return filters.match_traces(self._traces(), own, self.children())
        parts = name.split(":")
        if len(parts) == 2 and parts[1] == "block" and parts[0] in self.config.get("blocks", {}):
            return filters.match_blocks_interval(self.tables["blocks"], self.of["blocks"].where(F.col("source") == parts[0]))
        if len(parts) == 2 and any(e == parts[1] for _, e, _ in contracts.get(parts[0], {}).get("events", [])):
            signature = self.of["signatures"].where((F.col("source") == parts[0]) & (F.col("name") == parts[1]))
            own = self.of["logs"].where(F.col("source") == parts[0]).drop("source")
            return decode_events(filters.match_logs(self._logs(), own, self.children()), signature.drop("source"))
        if len(parts) == 3 and parts[0] in accounts and parts[1] in ("transaction", "transfer") and parts[2] in ("from", "to"):
            own = self.of["transactions"].where(F.col("source") == f"{parts[0]}:{parts[2]}").drop("source", "selector")
            if parts[1] == "transaction":
                return filters.match_transactions(self._transactions(), own)
            return filters.match_transfers(self._traces(), own)
        raise KeyError(f"the configuration has no event {name}")


def run_config(spark: SparkSession, config: dict, tables: dict[str, DataFrame], handlers: Handlers) -> dict[str, DataFrame]:
    """The tables that ``handlers`` make of the configuration's events."""
    routes = Routes(spark, config, tables, handlers.names())
    return handlers.run({name: routes.event(name) for name in handlers.names()})
