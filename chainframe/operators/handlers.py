"""Handlers: functions of matched and decoded event rows that give rows of user tables; all of them work on sets."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.functions.encodings import event_id
from chainframe.operators.filters import match_blocks_interval
from chainframe.sources.store import upsert_do_nothing

Handler = Callable[[DataFrame], dict[str, DataFrame]]


class Handlers:
    """Registry of handlers by event name, such as ``Vault:Deposit``, ``Account:transaction:from`` or ``Ticks:block``."""

    def __init__(self) -> None:
        self._by_name: dict[str, list[Handler]] = {}

    def on_event(self, name: str, fn: Handler | None = None):
        """Register ``fn``, or decorate with it."""
        if fn is None:
            return lambda f: self.on_event(name, f)
        self._by_name.setdefault(name, []).append(fn)
        return fn

    def names(self) -> list[str]:
        """Events that have a handler."""
        return list(self._by_name)

    def run(self, events: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The tables that the handlers make of their events; rows of one table from several handlers are united. Events
        without a handler are left alone; a handler without events is an error."""
        lacking = set(self._by_name) - set(events)
        if lacking:
            raise KeyError(f"no events for handlers {sorted(lacking)}")
        parts: dict[str, list[DataFrame]] = {}
        for name, fns in self._by_name.items():
            for fn in fns:
                for table, rows in fn(events[name]).items():
                    parts.setdefault(table, []).append(rows)
        return {t: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), p) for t, p in parts.items()}


def on_event(handlers: Handlers, name: str, fn: Handler) -> Handlers:
    handlers.on_event(name, fn)
    return handlers


def swap_receipts(events: DataFrame, receipts: DataFrame) -> DataFrame:
    """Events with their receipt's gas and success."""
    keys = ["chain_id", "tx_hash"]
    r = receipts.select(*keys, "gas_used", (F.col("status") == 1).alias("success"))
    return events.join(r, keys).select(event_id(F.col("tx_hash"), F.col("log_index")).alias("id"), "chain_id", "block_number", "address", "gas_used", "success")


def router_calls(frames: DataFrame, selectors: DataFrame) -> DataFrame:
    """Frames with input whose selector (its first four bytes) is known: selectors has selector and function_name."""
    return frames.withColumn("selector", F.lower(F.substring("input", 1, 10))).join(selectors, "selector").select(*frames.columns, "selector", "function_name")


def block_ticks(blocks: DataFrame, filters: DataFrame) -> DataFrame:
    """A row for each block that an interval filter picks."""
    return match_blocks_interval(blocks, filters).select("chain_id", "block_number", "block_ts")


def account_txs(txs: DataFrame, accounts: DataFrame, existing: DataFrame) -> DataFrame:
    """Transactions from and to accounts (chain_id, account) as direction rows; the first direction (from) of a hash wins,
    and hashes that exist stay as they are."""
    parts = []
    for k, side in enumerate(("from", "to")):
        own = txs.withColumn("account", F.col(f"{side}_address")).join(accounts.select("chain_id", "account"), ["chain_id", "account"], "left_semi")
        parts.append(own.select("chain_id", "tx_hash", "account", F.lit(side).alias("direction"), F.lit(k).alias("place")))
    both = parts[0].unionByName(parts[1])
    return upsert_do_nothing(both, existing, ["chain_id", "tx_hash"], ["place"]).drop("place")


#: Event name -> (table, columns made of arguments).
LENDING = {
    "Deposit": ("deposit", {"account": "arg1", "assets": "arg2", "shares": "arg3"}),
    "Withdraw": ("withdraw", {"account": "arg1", "assets": "arg2", "shares": "arg3"}),
    "Borrow": ("borrow", {"account": "arg1", "assets": "arg3"}),
    "Repay": ("repay", {"account": "arg1", "assets": "arg3"}),
    "Liquidate": ("liquidate", {"account": "arg1", "repaid": "arg2", "seized": "arg3"}),
    "Created": ("vault_status", {"account": "arg1", "total_shares": "arg2", "total_borrows": "arg3"}),
}


def lending_tables(decoded: DataFrame) -> dict[str, DataFrame]:
    """Tables of a lending protocol from decoded events."""
    out = {}
    for event, (table, columns) in LENDING.items():
        out[table] = decoded.where(F.col("event_name") == event).select(
            event_id(F.col("tx_hash"), F.col("log_index")).alias("id"), "chain_id", F.col("address").alias("vault"), "block_number",
            *(F.col("args")[arg].alias(c) for c, arg in columns.items()),
        )
    return out


def lending_rows(decoded: DataFrame) -> DataFrame:
    """The rows of lending_tables in one pass: ``t`` names the table, and columns that it doesn't have are null."""
    columns = list(dict.fromkeys(c for _, own in LENDING.values() for c in own))
    of = {c: F.coalesce(*(F.when(F.col("event_name") == event, F.col("args")[own[c]]) for event, (_, own) in LENDING.items() if c in own)) for c in columns}
    table = F.coalesce(*(F.when(F.col("event_name") == event, table) for event, (table, _) in LENDING.items()))
    rows = decoded.where(F.col("event_name").isin(list(LENDING)))
    return rows.select(table.alias("t"), event_id(F.col("tx_hash"), F.col("log_index")).alias("id"), "chain_id", F.col("address").alias("vault"), "block_number", *(v.alias(c) for c, v in of.items()))
