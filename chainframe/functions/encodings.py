"""Canonical encodings: scalar functions are Column -> Column, canon_* are DataFrame -> DataFrame."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.functions import abi

#: Transaction types that may carry an access list.
ACCESS_LIST_TYPES = (1, 2, 3, 4)
#: How call types are shown.
CALL_TYPES = {"call": "CALL", "delegatecall": "DELEGATECALL", "staticcall": "STATICCALL", "callcode": "CALLCODE"}


#: Digits of a step in the conversion of long decimals, and how many a number may have (2^256 has 78).
STEP_DIGITS, MOST_DIGITS = 9, 81


def _long_decimal(s: Column) -> Column:
    """A decimal string of up to 81 digits as hex digits: nine digits a step, into little-endian limbs of 32 bits."""
    digits = F.lpad(s, MOST_DIGITS, "0")
    zero = F.array_repeat(F.lit(0).cast("bigint"), 9)

    def add(limbs: Column, k: Column) -> Column:
        start = F.struct(F.substring(digits, k * STEP_DIGITS + 1, F.lit(STEP_DIGITS)).cast("bigint").alias("carry"), F.slice(limbs, 1, 0).alias("out"))

        def carry(done: Column, limb: Column) -> Column:
            t = limb * F.lit(10**STEP_DIGITS).cast("bigint") + done["carry"]
            return F.struct(F.shiftright(t, 32).alias("carry"), F.concat(done["out"], F.array(t.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")))).alias("out"))

        return F.aggregate(limbs, start, carry, lambda done: done["out"])

    limbs = F.aggregate(F.sequence(F.lit(0), F.lit(MOST_DIGITS // STEP_DIGITS - 1)), zero, add)
    return F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def hex_quantity(value: Column, optional: bool = False) -> Column:
    """Number, decimal string or hex string -> 0x-hex; hex stays as it is, in lower case; empty, '0x' and null are 0x0, or
    null stays with ``optional``. Decimals are exact up to 81 digits; text that is no number is an error."""
    s = F.lower(value.cast("string"))
    digits = F.regexp_replace(s, "^0+(?=.)", "")
    long = F.concat(F.lit("0x"), F.regexp_replace(_long_decimal(digits), "^0+(?=.)", ""))
    return (
        F.when(s.isNull(), F.lit(None).cast("string") if optional else F.lit("0x0"))
        .when((s == "") | (s == "0x"), F.lit("0x0"))
        .when(s.startswith("0x"), s)
        .when(~s.rlike("^[0-9]+$") | (F.length(digits) > MOST_DIGITS), F.raise_error(F.concat(F.lit("not a quantity: "), s)).cast("string"))
        .when(F.length(digits) <= 18, F.concat(F.lit("0x"), F.lower(F.hex(digits.try_cast("bigint")))))
        .otherwise(long)
    )


def padded(hex_value: Column) -> Column:
    """A 0x-hex quantity as 64 digits, which sort as numbers do."""
    return F.lpad(F.regexp_replace(F.lower(hex_value), "^0x", ""), 64, "0")


def uint256_compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1."""
    x, y = padded(a), padded(b)
    return F.when(x < y, -1).when(x > y, 1).when(x == y, 0)


LIMBS, LIMB_DIGITS = 8, 8


def uint256_sum(df: DataFrame, by: list[str], value: str, to: str = "total") -> DataFrame:
    """Exact sums of 0x-hex quantities per group, as 0x-hex: eight 32-bit limbs are summed apart, then carried.

    Exact for up to 2^31 rows a group; the sum may pass 256 bits.
    """
    p = padded(F.coalesce(F.col(value), F.lit("0x0")))
    limbs = [F.conv(F.substring(p, 1 + LIMB_DIGITS * (LIMBS - 1 - k), LIMB_DIGITS), 16, 10).cast("bigint") for k in range(LIMBS)]
    sums = df.groupBy(*by).agg(*(F.sum(x).alias(f"__l{k}") for k, x in enumerate(limbs)))
    out, carry, base = [], F.lit(0).cast("bigint"), F.lit(1 << 32)
    for k in range(LIMBS):
        sums = sums.withColumn(f"__s{k}", F.col(f"__l{k}") + carry)
        out.append(F.lpad(F.lower(F.hex(F.pmod(F.col(f"__s{k}"), base))), LIMB_DIGITS, "0"))
        carry = F.expr(f"__s{k} div {1 << 32}")
    digits = F.regexp_replace(F.concat(F.lower(F.hex(carry)), *reversed(out)), "^0+(?=.)", "")
    return sums.select(*by, F.concat(F.lit("0x"), digits).alias(to))


def _raw(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A raw column, or null where the data set lacks it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)


#: Raw header field -> column of a block row; those in QUANTITIES become hex, and stay null where they are.
HEADER = {
    "number": "block_number", "hash": "block_hash", "parentHash": "parent_hash", "timestamp": "block_ts", "logsBloom": "logs_bloom", "miner": "miner",
    "gasUsed": "gas_used", "gasLimit": "gas_limit", "baseFeePerGas": "base_fee", "nonce": "nonce", "mixHash": "mix_hash", "stateRoot": "state_root",
    "receiptsRoot": "receipts_root", "transactionsRoot": "transactions_root", "sha3Uncles": "sha3_uncles", "size": "size", "difficulty": "difficulty",
    "totalDifficulty": "total_difficulty", "extraData": "extra_data",
}
QUANTITIES = ("gasUsed", "gasLimit", "baseFeePerGas", "size", "difficulty", "totalDifficulty")


def canon_block(headers: DataFrame) -> DataFrame:
    """Raw headers (the fields of HEADER, beside chain_id) as block rows: quantities as hex, what is null stays null."""
    columns = [(hex_quantity(_raw(headers, raw), optional=True) if raw in QUANTITIES else _raw(headers, raw)).alias(own) for raw, own in HEADER.items()]
    return headers.select("chain_id", *columns)


def canon_log(logs: DataFrame) -> DataFrame:
    """Address in lower case, no topics as an empty list, no data as 0x, removed false."""
    return (
        logs.withColumn("address", F.lower("address"))
        .withColumn("topics", F.coalesce("topics", F.array().cast("array<string>")))
        .withColumn("data", F.coalesce("data", F.lit("0x")))
        .withColumn("removed", F.lit(False))
    )


def _lower(c: Column) -> Column:
    """An address in lower case; the empty one is null."""
    return F.when(F.coalesce(c, F.lit("")) != "", F.lower(c))


def canon_tx(txs: DataFrame) -> DataFrame:
    """Raw transactions (with chain_id, block_number and block_hash) as rows: addresses in lower case, null recipient on
    creation, quantities as hex, 0 for no nonce, value or type, 0x for no input; prices, v and yParity stay null where they
    are, and so does a list that the type doesn't carry."""
    zero = {c: hex_quantity(_raw(txs, raw)).alias(c) for c, raw in (("gas", "gas"), ("nonce", "nonce"), ("value", "value"), ("tx_type", "type"))}
    kept = (("gas_price", "gasPrice"), ("max_fee_per_gas", "maxFeePerGas"), ("max_priority_fee_per_gas", "maxPriorityFeePerGas"), ("v", "v"), ("y_parity", "yParity"))
    return txs.select(
        "chain_id", "block_number", "block_hash", F.col("transactionIndex").alias("transaction_index"), F.col("hash").alias("tx_hash"),
        _lower(_raw(txs, "from")).alias("from_address"), _lower(_raw(txs, "to")).alias("to_address"), F.coalesce(_raw(txs, "input"), F.lit("0x")).alias("input"),
        *zero.values(), *(hex_quantity(_raw(txs, raw), optional=True).alias(c) for c, raw in kept), _raw(txs, "r").alias("r"), _raw(txs, "s").alias("s"),
        gate_access_list(_raw(txs, "type", "int"), _raw(txs, "accessList", "array<struct<address:string,storageKeys:array<string>>>")).alias("access_list"),
    )


def gate_access_list(tx_type: Column, access_list: Column) -> Column:
    """The list for types that may carry one; null otherwise, never an empty list made up."""
    return F.when(tx_type.isin(*ACCESS_LIST_TYPES), access_list)


def require_access_list(txs: DataFrame, opted_out: tuple[int, ...] = ()) -> DataFrame:
    """Violations: typed transactions without a list, but for chains that opted out."""
    return txs.where(F.col("tx_type").isin(*ACCESS_LIST_TYPES) & F.col("access_list").isNull() & ~F.col("chain_id").isin(*opted_out))


def canon_receipt(txs: DataFrame) -> DataFrame:
    """Receipts of raw transactions: status as 0x1 or 0x0 (from 1, '0x1' or true), addresses in lower case or null, gas and
    type as hex, the bloom as it is."""
    ok = F.coalesce(F.lower(_raw(txs, "status").cast("string")).isin("1", "0x1", "true"), F.lit(False))
    zero = (("gas_used", "gasUsed"), ("cumulative_gas_used", "cumulativeGasUsed"), ("effective_gas_price", "effectiveGasPrice"), ("tx_type", "type"))
    return txs.select(
        "chain_id", "block_number", "block_hash", F.col("transactionIndex").alias("transaction_index"), F.col("hash").alias("tx_hash"),
        _lower(_raw(txs, "from")).alias("from_address"), _lower(_raw(txs, "to")).alias("to_address"), _lower(_raw(txs, "contractAddress")).alias("contract_address"),
        _raw(txs, "logsBloom").alias("logs_bloom"), *(hex_quantity(_raw(txs, raw)).alias(c) for c, raw in zero), F.when(ok, "0x1").otherwise("0x0").alias("status"),
    )


#: Frame column -> where each type of trace has it: nested, then flattened.
TRACE = {
    "from_address": {"call": ("action.from", "callFrom"), "create": ("action.from", "createFrom"), "suicide": ("action.address", "suicideAddress")},
    "to_address": {"call": ("action.to", "callTo"), "create": ("result.address", "createResultAddress"), "suicide": ("action.refundAddress", "suicideRefundAddress")},
    "value": {"call": ("action.value", "callValue"), "create": ("action.value", "createValue"), "suicide": ("action.balance", "suicideBalance")},
    "gas": {"call": ("action.gas", "callGas"), "create": ("action.gas", "createGas")},
    "gas_used": {"call": ("result.gasUsed", "callResultGasUsed"), "create": ("result.gasUsed", "createResultGasUsed")},
    "input": {"call": ("action.input", "callInput"), "create": ("action.init", "createInit")},
    "output": {"call": ("result.output", "callResultOutput"), "create": ("result.code", "createResultCode")},
}


def canon_trace(traces: DataFrame) -> DataFrame:
    """Raw traces (type, action and result, or the flattened fields of TRACE) as call frames.

    Calls of an unknown kind count as CALL. Traces of other types than call, create and suicide, such as rewards, have no
    frame and go; rank before, as they count there. Gas is 0x0 and input 0x where there is none, value and output null.
    ``traces``' other columns stay.
    """
    nested = {c: set(traces.schema[c].dataType.fieldNames()) for c in ("action", "result") if c in traces.columns}

    def pick(*places: str) -> Column:
        there = [F.col(p) for p in places if (p.split(".")[1] in nested.get(p.split(".")[0], ()) if "." in p else p in traces.columns)]
        return F.coalesce(*there) if there else F.lit(None).cast("string")

    def of(name: str) -> Column:
        out = F.lit(None).cast("string")
        for kind, places in TRACE[name].items():
            out = F.when(F.col("type") == kind, pick(*places)).otherwise(out)
        return out

    call = pick("action.callType", "action.type", "callCallType", "callType")
    kind = F.when(F.col("type") == "create", "CREATE").when(F.col("type") == "suicide", "SELFDESTRUCT")
    for k, v in CALL_TYPES.items():
        kind = kind.when(call == k, v)
    used = {"action", "result", "type", "callType", "callCallType", *(p for places in TRACE.values() for own in places.values() for p in own)}
    keep = [F.col(f"`{c}`") for c in traces.columns if c not in used]
    return traces.where(F.col("type").isin("call", "create", "suicide")).select(
        *keep, kind.otherwise("CALL").alias("frame_type"), F.lower(of("from_address")).alias("from_address"), _lower(of("to_address")).alias("to_address"),
        hex_quantity(of("value"), optional=True).alias("value"), hex_quantity(of("gas")).alias("gas"), hex_quantity(of("gas_used")).alias("gas_used"),
        F.coalesce(of("input"), F.lit("0x")).alias("input"), of("output").alias("output"),
    )


def data_word(data: Column, word: int) -> Column:
    """The 32-byte word of 0x-data, as 0x-hex; null beyond the end."""
    w = F.substring(data, 3 + 64 * word, 64)
    return F.when(F.length(w) == 64, F.concat(F.lit("0x"), w))


#: The types of an event's arguments: name, Solidity type and whether it is indexed.
ARGUMENTS = "array<struct<name:string,type:string,indexed:boolean>>"
#: Layouts of events that are read by expressions, a branch each.
MOST_LAYOUTS = 32


def decode_events(logs: DataFrame, signatures: DataFrame) -> DataFrame:
    """Logs with ``event_name`` and ``args`` (map of name to value) by their signature (topic0, name, args: ARGUMENTS).

    Indexed arguments come from topics 1 to 3 in order, the others from the data by the layout of their types: see abi. A
    word is 0x-hex, true or false; bytes are 0x-hex, string is text; lists of words are joined by commas, other lists and
    tuples are JSON. Indexed ones that are longer than a word are hashes and stay so. Arguments without a name are called
    topicN or wordN by their place in words; a name that is there twice gets a number. What the data doesn't hold is null; a
    type that isn't one is an error. Logs without a signature go; columns named event_name or args are replaced. Where all
    arguments are words, as of most events, Spark's own expressions read them, so that no row goes to Python and what isn't
    asked for is left out; else rows are decoded in Arrow batches.
    """
    kept = [c for c in logs.columns if c not in ("event_name", "args")]
    own = signatures.select(F.lower("topic0").alias("__topic0"), F.col("name").alias("event_name"), F.to_json(F.col("args").cast(ARGUMENTS)).alias("__layout"))
    # what is a column already is sent once
    extra = {f"__topic{k}": log_topic(logs, k) for k in (1, 2, 3) if f"topic{k}" not in kept} | ({} if "data" in kept else {"__data": F.lit(None).cast("string")})
    j = logs.select(*(F.col(f"`{c}`") for c in kept), F.lower(log_topic(logs, 0)).alias("__topic0"), *(c.alias(n) for n, c in extra.items()))
    j = j.join(own, "__topic0").select(*(F.col(f"`{c}`") for c in kept), "event_name", "__layout", *extra)
    layouts = own.select(F.coalesce("__layout", F.lit("")).alias("text")).distinct().limit(MOST_LAYOUTS + 1).collect()  # a look at the configuration
    if len(layouts) <= MOST_LAYOUTS and all(abi.of_words(r.text) for r in layouts):
        args = F.coalesce(*(F.when(F.coalesce("__layout", F.lit("")) == r.text, _word_arguments(r.text, kept)) for r in layouts)) if layouts else F.lit(None)
        return j.select(*(F.col(f"`{c}`") for c in kept), "event_name", args.cast("map<string,string>").alias("args"))
    schema = j.select(*(F.col(f"`{c}`") for c in kept), "event_name").schema.add("args", T.MapType(T.StringType(), T.StringType()))
    topics = [f"topic{k}" if f"topic{k}" in kept else f"__topic{k}" for k in (1, 2, 3)]
    return j.mapInArrow(abi.decoder([*kept, "event_name"], "__layout", topics, "data" if "data" in kept else "__data", "args"), schema)


def _word_arguments(layout: str, kept: list[str]) -> Column:
    """The map of an event's arguments, all of them words, as abi.arguments has it."""
    event, values = abi.event_of(layout), []
    digits = F.lower(F.coalesce(F.col("data" if "data" in kept else "__data"), F.lit("0x")))
    for t, k in event.indexed:
        topic = F.lower(F.col(f"topic{k}" if f"topic{k}" in kept else f"__topic{k}")) if k <= 3 else F.lit(None).cast("string")
        values.append(_word_text(t, F.substring(topic, 3, 64)))
    values += [_word_text(t, F.substring(digits, 3 + 2 * at, 64)) for t, at in event.plain]
    return F.create_map(*(c for n, v in zip(event.names, values) for c in (F.lit(n), v))) if values else F.create_map().cast("map<string,string>")


def _word_text(t: abi.Type, word: Column) -> Column:
    """A word's text by its type; null if it lacks digits. See abi.word_text."""
    number = F.ltrim(word, F.lit("0"))
    if t.kind == abi.ADDRESS:
        text = F.concat(F.lit("0x"), F.right(word, F.lit(40)))
    elif t.kind == abi.FIXED:
        text = F.concat(F.lit("0x"), F.substring(word, 1, t.digits))
    elif t.kind == abi.FLAG:
        text = F.when(number == "", "false").otherwise("true")
    else:
        text = F.concat(F.lit("0x"), F.when(number == "", "0").otherwise(number))
    return F.when(F.length(word) == 64, text)


def log_topic(logs: DataFrame, k: int) -> Column:
    """A log's topic: from ``topicK`` or from the list ``topics``; null beyond its end."""
    return F.col(f"topic{k}") if f"topic{k}" in logs.columns else F.get("topics", F.lit(k)) if "topics" in logs.columns else F.lit(None).cast("string")


def child_at(df: DataFrame, location: Column) -> Column:
    """The created contract's address at ``location``: ``topicN`` (its last 40 digits) or ``offsetN`` (byte offset of a
    word in data). Other locations are an error; what is too short has none."""
    n = F.regexp_extract(location, "([0-9]+)$", 1).try_cast("int")
    topic = F.get(F.array(*(log_topic(df, k) for k in range(4))), n)
    data = F.col("data") if "data" in df.columns else F.lit(None).cast("string")
    digits = (
        F.when(location.rlike("^topic[1-3]$"), F.right(topic, F.lit(40)))
        .when(location.rlike("^offset[0-9]+$"), F.substring(data, F.lit(27) + n * 2, F.lit(40)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown location "), location)).cast("string"))
    )
    return F.when(F.length(digits) == 40, F.concat(F.lit("0x"), F.lower(digits)))


def child_address(df: DataFrame, location: str, to: str = "child") -> DataFrame:
    """``df`` with the created contract's address; see child_at."""
    if not re.fullmatch("topic[1-3]|offset[0-9]+", location):
        raise ValueError(f"unknown location {location}")
    return df.withColumn(to, child_at(df, F.lit(location)))


#: Fixed value: seconds of a mean year.
SECONDS_PER_YEAR = 365.2425 * 86400


def compute_apy(rate: Column, borrowed: Column, supplied: Column, fee: Column) -> tuple[Column, Column]:
    """(borrow APY, supply APY) from a per-second rate scaled by 1e27; what isn't finite is 0."""
    raw = F.pow(F.lit(1.0) + rate / F.lit(1e27), F.lit(SECONDS_PER_YEAR)) - F.lit(1.0)
    finite = F.when(raw.isNull() | F.isnan(raw) | (F.abs(raw) == F.lit(float("inf"))), F.lit(0.0)).otherwise(raw)
    util = F.when(F.coalesce(supplied, F.lit(0)) == 0, F.lit(0.0)).otherwise(borrowed.cast("double") / supplied)
    return finite, finite * util * (F.lit(1.0) - fee)


def event_id(tx_hash: Column, log_index: Column) -> Column:
    return F.concat_ws("-", tx_hash, log_index.cast("string"))


def chain_address(chain_id: Column, address: Column) -> Column:
    return F.concat_ws(":", chain_id.cast("string"), address)


#: (name, width) of a checkpoint's fields.
CHECKPOINT = (("block_ts", 10), ("chain_id", 16), ("block_number", 16), ("transaction_index", 16), ("event_type", 1), ("event_index", 16))


def checkpoint_encode(**fields: Column) -> Column:
    """A string of fixed width that sorts as the events' positions do; a field that is wider than its place is an error."""

    def field(name: str, width: int) -> Column:
        text = fields[name].cast("string")
        wide = F.raise_error(F.concat(F.lit(f"{name} doesn't fit a checkpoint: "), text)).cast("string")
        return F.when((F.length(text) > width) | text.startswith("-"), wide).otherwise(F.lpad(text, width, "0"))

    return F.concat(*(field(n, w) for n, w in CHECKPOINT))


def checkpoint_decode(text: Column) -> dict[str, Column]:
    """Its fields; null for what is malformed."""
    width = sum(w for _, w in CHECKPOINT)
    out, at = {}, 1
    for name, w in CHECKPOINT:
        out[name] = F.when(text.rlike(f"^[0-9]{{{width}}}$"), F.substring(text, at, w).try_cast("bigint")).alias(name)
        at += w
    return out


def normalize_row(df: DataFrame, drop: tuple[str, ...] = ()) -> Column:
    """A stable JSON text of a row: keys sorted, numbers as strings, bytes as hex, nulls kept."""
    columns = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        if f.name in drop:
            continue
        kind = f.dataType.simpleString()
        c = F.concat(F.lit("0x"), F.lower(F.hex(f.name))) if kind == "binary" else F.col(f.name).cast("string") if kind == "bigint" else F.col(f.name)
        columns.append(c.alias(f.name))
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
