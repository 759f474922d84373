"""Event arguments by type: against an encoder of its own, golden words and broken data."""

import json
import random

import pyarrow as pa
import pytest

from chainframe.functions import abi
from chainframe.functions import encodings as enc

ARGS = "topic0 string, name string, args array<struct<name:string,type:string,indexed:boolean>>"


def word(n):
    return f"{n % 2**256:064x}"


def random_type(rnd, depth=3):
    kinds = ["uint256", "uint8", "int128", "address", "bool", "bytes4", "bytes32", "string", "bytes"]
    if depth == 0 or rnd.random() < 0.4:
        return rnd.choice(kinds)
    if rnd.random() < 0.5:
        return random_type(rnd, depth - 1) + rnd.choice(["[]", "[1]", "[2]", "[3]"])
    return "(" + ",".join(random_type(rnd, depth - 1) for _ in range(rnd.randint(1, 3))) + ")"


def random_value(t, rnd):
    """(what an encoder takes, what the decoder should give)."""
    if t.kind == abi.LIST:
        both = [random_value(t.parts[0], rnd) for _ in range(t.length if t.length is not None else rnd.randint(0, 3))]
        return [b[0] for b in both], [b[1] for b in both]
    if t.kind == abi.TUPLE:
        both = [random_value(p, rnd) for p in t.parts]
        return [b[0] for b in both], [b[1] for b in both]
    if t.kind == abi.TEXT:
        s = "".join(rnd.choice('aé,"中') for _ in range(rnd.choice([0, 3, 40])))
        return s.encode().hex(), s
    if t.kind == abi.BYTES:
        h = rnd.randbytes(rnd.choice([0, 5, 32, 70])).hex()
        return h, "0x" + h
    if t.kind == abi.FIXED:
        h = rnd.randbytes(t.digits // 2).hex()
        return h.ljust(64, "0"), "0x" + h
    if t.kind == abi.ADDRESS:
        h = rnd.randbytes(20).hex()
        return h.rjust(64, "0"), "0x" + h
    n = rnd.choice([0, 1]) if t.kind == abi.FLAG else rnd.choice([0, 7, 2**255 + 3])
    return word(n), ["false", "true"][n] if t.kind == abi.FLAG else hex(n)


def encoded(t, v):
    if t.kind in (abi.TEXT, abi.BYTES):
        size = len(v) // 2
        return word(size) + v.ljust(-(-size // 32) * 64, "0")
    if t.kind == abi.LIST:
        return ("" if t.length is not None else word(len(v))) + row([t.parts[0]] * len(v), v)
    return row(t.parts, v) if t.kind == abi.TUPLE else v


def row(types, values):
    heads, tails, at = [], [], 32 * sum(t.width for t in types)
    for t, v in zip(types, values):
        body = encoded(t, v)
        if t.dynamic:
            heads.append(word(at))
            tails.append(body)
            at += len(body) // 2
        else:
            heads.append(body)
    return "".join(heads + tails)


def shown(t, v):
    if isinstance(v, str):
        return v
    flat = t.kind == abi.LIST and t.parts[0].kind in (abi.NUMBER, abi.ADDRESS, abi.FLAG, abi.FIXED)
    return ",".join(v) if flat else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def test_round_trip_of_random_types():
    rnd = random.Random(11)
    for _ in range(1500):
        types = [abi.parse(random_type(rnd)) for _ in range(rnd.randint(1, 4))]
        both = [random_value(t, rnd) for t in types]
        data, at = row(types, [b[0] for b in both]), 0
        for t, (_, want) in zip(types, both):
            assert abi.value_text(t, data, 32 * at) == shown(t, want)
            if not t.dynamic:
                assert abi._statics(t, pa.array([data, data[: 64 * (at + t.width) - 1]]), 32 * at).to_pylist() == [shown(t, want), None]
            at += t.width


def test_widths():
    widths = {"uint256": 1, "uint8[3]": 3, "(uint256,bytes32[2])": 3, "(uint256,string)": 1, "(bool,address)[2]": 4, "uint256[]": 1, "string[2]": 1, "uint[2][3]": 6}
    assert {k: abi.parse(k).width for k in widths} == widths


@pytest.mark.parametrize("name", ["", "uint7", "uint264", "bytes33", "bytes0", "byte", "uint256[", "(uint256", "tuple", "mapping", "uint256]", "(uint256,)", "int08", "string string"])
def test_unknown_types_are_errors(name):
    with pytest.raises(ValueError, match="unknown type"):
        abi.parse(name)


def test_broken_data_is_null():
    t = abi.parse("string[]")
    good = row([t], [["61", "62"]])
    assert abi.value_text(t, good, 0) == '["a","b"]'
    for k in range(0, len(good) - 64, 64):  # cut anywhere before the last text
        assert abi.value_text(t, good[:k], 0) is None
    assert abi.value_text(t, word(2**255) + good[64:], 0) is None  # a place far away
    assert abi.value_text(t, good[:64] + word(10**6) + good[128:], 0) is None  # more items than there are words
    twice = word(2) + word(64) * 2  # two items that are both what follows, so that each level doubles what is read
    assert abi.value_text(abi.parse("uint256[][][]"), word(32) + twice + word(0), 0) == "[[],[]]"
    assert abi.value_text(abi.parse("uint256" + "[]" * 40), word(32) + twice * 39 + word(1) * 2, 0) is None
    assert abi.value_text(abi.parse("bytes"), word(32) + word(1) + "zz", 0) == "0xzz"
    assert abi.value_text(abi.parse("string"), word(32) + word(1) + "zz", 0) is None
    assert abi.value_text(abi.parse("uint256[0]"), "", 0) == ""


def decoded(spark, types, data, topics=()):
    signature = [("0xT", "E", [(n, t, i) for n, t, i in types])]
    log = spark.createDataFrame([(1, ["0xt", *topics], data, "own")], "k int, topics array<string>, data string, args string")
    got = enc.decode_events(log, spark.createDataFrame(signature, ARGS)).collect()
    return [(r.k, r.event_name, dict(r.args)) for r in got]


def test_decode_events_places_count_words(spark):
    words = "0x" + "".join(map(word, (1, 2, 3, 99)))
    assert decoded(spark, [("l", "uint256[3]", False), ("x", "uint256", False)], words) == [(1, "E", {"l": "0x1,0x2,0x3", "x": "0x63"})]
    assert decoded(spark, [("t", "(uint256,uint256)", False), ("", "uint256", False), ("b", "bool", False)], words) == [(1, "E", {"t": '["0x1","0x2"]', "word2": "0x3", "b": "true"})]
    assert decoded(spark, [("t", "(uint256 lo,uint256 hi)", False)], words) == [(1, "E", {"t": '{"lo":"0x1","hi":"0x2"}'})]


def test_decode_events_names_topics_and_gaps(spark):
    a = "0x" + "00" * 12 + "Ab" * 20
    got = decoded(spark, [("x", "address", True), ("x", "string", True), ("", "uint8", True), ("x", "uint256", False), ("y", "uint256", False)], "0x" + word(5), (a, "0xFF", "0x" + word(3)))
    assert got == [(1, "E", {"x": "0x" + "ab" * 20, "x_2": "0xff", "topic3": "0x3", "x_3": "0x5", "y": None})]
    assert decoded(spark, [("x", "uint256", False)], None) == [(1, "E", {"x": None})]
    assert decoded(spark, [], "0x") == [(1, "E", {})]


def test_decode_events_unknown_type(spark):
    with pytest.raises(Exception, match="unknown type uint7"):
        decoded(spark, [("x", "uint7", False)], "0x" + word(1))


def test_decode_events_of_nothing(spark):
    log = spark.createDataFrame([], "k int, topics array<string>, data string")
    assert enc.decode_events(log, spark.createDataFrame([], ARGS)).collect() == []
