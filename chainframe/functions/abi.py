"""Event arguments by their Solidity types.

A type is a tree: words, byte strings, texts, lists of fixed or free length, tuples. A static type lies in the head, as many
words wide as its parts together; a dynamic one leaves a word there, the place of its tail in bytes from the start of what
encloses it. So an argument's place follows from the widths of those before it.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NUMBER, ADDRESS, FLAG, FIXED, TEXT, BYTES, LIST, TUPLE = "number", "address", "flag", "fixed", "text", "bytes", "list", "tuple"
WORDS = (NUMBER, ADDRESS, FLAG, FIXED)


@dataclass(frozen=True)
class Type:
    """digits: of fixed bytes; parts: a list's item or a tuple's components; length: of a list, None if free; names: of a
    tuple's components, where all have one; width: words in the head."""

    kind: str
    digits: int = 0
    parts: tuple[Type, ...] = ()
    length: int | None = None
    names: tuple[str, ...] = ()

    @functools.cached_property
    def dynamic(self) -> bool:
        return self.kind in (TEXT, BYTES) or self.kind == LIST and self.length is None or any(p.dynamic for p in self.parts)

    @functools.cached_property
    def width(self) -> int:
        if self.dynamic or self.kind not in (LIST, TUPLE):
            return 1
        return sum(p.width for p in self.parts) * (self.length if self.kind == LIST else 1)


@functools.lru_cache(4096)
def parse(text: str) -> Type:
    """The type that ``text`` names, such as ``uint256``, ``bytes32[4][]`` or ``(address to,uint256[2])[]``; ``tuple(...)`` is
    a tuple too, and components may have names. What isn't a type is an error."""
    found, at = _type(text.strip(), 0, text)
    if at != len(text.strip()):
        raise ValueError(f"unknown type {text}")
    return found


def _type(text: str, at: int, whole: str) -> tuple[Type, int]:
    if m := re.compile(r"(tuple)?\s*\(\s*").match(text, at):
        parts, names, at = [], [], m.end()
        while not (end := re.compile(r"\s*\)").match(text, at)):
            if parts:
                if not (m := re.compile(r"\s*,\s*").match(text, at)):
                    raise ValueError(f"unknown type {whole}")
                at = m.end()
            part, at = _type(text, at, whole)
            named = re.compile(r"\s+([A-Za-z_$][\w$]*)").match(text, at)
            at = named.end() if named else at
            parts.append(part)
            names.append(named[1] if named else "")
        own = tuple(names) if all(names) and len(set(names)) == len(names) else ()
        base, at = Type(TUPLE, parts=tuple(parts), names=own), end.end()
    elif m := re.compile(r"[a-z]+[0-9]*").match(text, at):
        base, at = _elementary(m[0], whole), m.end()
    else:
        raise ValueError(f"unknown type {whole}")
    while m := re.compile(r"\[([0-9]*)\]").match(text, at):
        base, at = Type(LIST, parts=(base,), length=int(m[1]) if m[1] else None), m.end()
    return base, at


def _elementary(name: str, whole: str) -> Type:
    if name in (ADDRESS, "bool", "string", BYTES):
        return Type({"bool": FLAG, "string": TEXT}.get(name, name))
    if name == "function":
        return Type(FIXED, digits=48)
    m = re.fullmatch(r"(u?int|bytes)([0-9]*)", name)
    size = int(m[2]) if m and m[2] else 256
    if m and m[1] == BYTES and 1 <= size <= 32:
        return Type(FIXED, digits=2 * size)
    if m and m[1] != BYTES and size % 8 == 0 and 8 <= size <= 256 and not m[2].startswith("0"):
        return Type(NUMBER)
    raise ValueError(f"unknown type {whole}")


# --- one value ----------------------------------------------------------------------------------------------------


class Short(Exception):
    """The data doesn't hold what the type says."""


def word_text(t: Type, word: str) -> str:
    """A word by its type: addresses and fixed bytes as 0x-hex, flags as true or false, numbers as 0x-hex without leading
    zeros (signed ones in two's complement)."""
    if t.kind == ADDRESS:
        return "0x" + word[24:]
    if t.kind == FIXED:
        return "0x" + word[: t.digits]
    number = word.lstrip("0")
    return ("true" if number else "false") if t.kind == FLAG else "0x" + (number or "0")


class Reader:
    """Reads values out of hex digits. ``left`` bounds the items of free lists that are still read: honest data has a word
    for each, but places may point to one tail again and again."""

    def __init__(self, digits: str):
        self.digits, self.left = digits, len(digits) // 64 + 1

    def word(self, at: int) -> str:
        w = self.digits[2 * at : 2 * at + 64]
        if len(w) < 64:
            raise Short
        return w

    def number(self, at: int) -> int:
        """A word as a place or a length."""
        n = int(self.word(at), 16)
        if 2 * n > len(self.digits):
            raise Short
        return n

    def value(self, t: Type, at: int, base: int):
        """The value whose head is at byte ``at``; ``base``: where places are counted from."""
        if t.dynamic:
            at = base + self.number(at)
        if t.kind in (TEXT, BYTES):
            n = self.number(at)
            raw = self.digits[2 * at + 64 : 2 * (at + 32 + n)]
            if len(raw) < 2 * n:
                raise Short
            return bytes.fromhex(raw).decode(errors="replace") if t.kind == TEXT else "0x" + raw
        if t.kind == LIST:
            n = t.length
            if n is None:
                n, at = self.checked(self.number(at)), at + 32
            return self.row(t.parts * n, at)
        if t.kind == TUPLE:
            own = self.row(t.parts, at)
            return dict(zip(t.names, own)) if t.names else own
        return word_text(t, self.word(at))

    def checked(self, n: int) -> int:
        self.left -= n
        if self.left < 0:
            raise Short
        return n

    def row(self, types: Iterable[Type], start: int) -> list:
        out, at = [], start
        for t in types:
            out.append(self.value(t, at, start))
            at += 32 * t.width
        return out


def _plain_tail(t: Type, digits: str, at: int) -> str:
    """What most dynamic arguments are, read straight off: a text, bytes, or a free list of words."""
    start = 2 * int(digits[at : at + 64], 16)
    head = digits[start : start + 64]
    if len(head) < 64:
        raise Short
    n, start = int(head, 16), start + 64
    end = start + (2 if t.kind != LIST else 64) * n
    if end > len(digits):
        raise Short
    if t.kind == TEXT:
        return bytes.fromhex(digits[start:end]).decode(errors="replace")
    if t.kind == BYTES:
        return "0x" + digits[start:end]
    item = t.parts[0]
    return ",".join([word_text(item, digits[k : k + 64]) for k in range(start, end, 64)])


def value_text(t: Type, digits: str, at: int) -> str | None:
    """An argument whose head is at byte ``at``: lists of words joined by commas, other lists and tuples as JSON; null where
    the data doesn't hold it."""
    try:
        if t.kind in (TEXT, BYTES) or t.kind == LIST and t.length is None and t.parts[0].kind in WORDS:
            return _plain_tail(t, digits, 2 * at)
        v = Reader(digits).value(t, at, 0)
    except (Short, ValueError):  # digits that are no hex
        return None
    if t.kind == LIST and t.parts[0].kind in WORDS:
        return ",".join(v)
    return v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


# --- whole events ---------------------------------------------------------------------------------------------------


#: Words of a static argument that are read as a column each.
MOST_COLUMNS = 64


@dataclass(frozen=True)
class Event:
    """indexed: (type, number of the topic); plain: (type, byte of its head); names: of both, in this order."""

    indexed: tuple[tuple[Type, int], ...]
    plain: tuple[tuple[Type, int], ...]
    names: tuple[str, ...]


@functools.lru_cache(4096)
def event_of(arguments: str) -> Event:
    """The layout of an event from its arguments (name, type, indexed) as JSON. One without a name is called topicN or wordN
    by its place; a name that is there again gets a number."""
    indexed, plain, first, rest, at = [], [], [], [], 0
    for a in json.loads(arguments or "[]"):
        t = parse(a.get("type") or "")
        if a.get("indexed"):
            indexed.append((t, len(indexed) + 1))
            first.append(a.get("name") or f"topic{len(indexed)}")
        else:
            plain.append((t, 32 * at))
            rest.append(a.get("name") or f"word{at}")
            at += t.width
    names: list[str] = []
    for name in first + rest:
        own, k = name, 1
        while own in names:
            k += 1
            own = f"{name}_{k}"
        names.append(own)
    return Event(tuple(indexed), tuple(plain), tuple(names))


def of_words(arguments: str) -> bool:
    """Whether all arguments are single words; hashes of longer ones, and types that aren't one, are not."""
    try:
        event = event_of(arguments)
    except ValueError:
        return False
    return all(t.kind in WORDS for t, _ in (*event.indexed, *event.plain))


def _words(t: Type, words: pa.Array) -> pa.Array:
    """Words by their type, all at once; those that lack digits are null."""
    words = pc.if_else(pc.equal(pc.binary_length(words), 64), words, None)
    prefix = pa.scalar("0x")
    if t.kind == ADDRESS:
        return pc.binary_join_element_wise(prefix, pc.utf8_slice_codeunits(words, 24, 64), "")
    if t.kind == FIXED:
        return pc.binary_join_element_wise(prefix, pc.utf8_slice_codeunits(words, 0, t.digits), "")
    number = pc.ascii_ltrim(words, characters="0")
    none = pc.equal(number, "")
    if t.kind == FLAG:
        return pc.if_else(none, "false", "true")
    return pc.binary_join_element_wise(prefix, pc.if_else(none, "0", number), "")


def _statics(t: Type, digits: pa.Array, at: int, inner: bool = False) -> pa.Array:
    """Static values at byte ``at`` of all logs at once, as value_text has them; inner ones are JSON."""
    if t.kind in WORDS:
        v = _words(t, pc.utf8_slice_codeunits(digits, 2 * at, 2 * at + 64))
        return pc.binary_join_element_wise('"', v, '"', "") if inner else v
    types = t.parts * (t.length if t.kind == LIST else 1)
    flat = t.kind == LIST and t.parts[0].kind in WORDS and not inner
    parts = []
    for k, own in enumerate(types):
        v = _statics(own, digits, at, not flat)
        parts.append(pc.binary_join_element_wise(json.dumps(t.names[k]) + ":", v, "") if t.names else v)
        at += 32 * own.width
    joined = pc.binary_join_element_wise(*parts, ",") if parts else pa.array([""] * len(digits), pa.string())
    return joined if flat else pc.binary_join_element_wise("{" if t.names else "[", joined, "}" if t.names else "]", "")


def arguments(event: Event, topics: list[pa.Array], data: pa.Array) -> pa.MapArray:
    """A map of the arguments of each log of one event. topics: 1 to 3; data: both with 0x."""
    values, digits = [], pc.ascii_lower(pc.utf8_slice_codeunits(pc.fill_null(data, "0x"), 2, 1 << 30))
    for t, k in event.indexed:
        topic = pc.ascii_lower(topics[k - 1]) if k <= len(topics) else pa.nulls(len(data), pa.string())
        word = t.kind in WORDS  # what is longer than a word is a hash there
        values.append(_words(t, pc.utf8_slice_codeunits(topic, 2, 66)) if word else topic)
    texts: list[str] | None = None
    for t, at in event.plain:
        if not t.dynamic and t.width <= MOST_COLUMNS:
            values.append(_statics(t, digits, at))
        else:
            texts = texts or digits.to_pylist()
            values.append(pa.array([value_text(t, d, at) for d in texts], pa.string()))
    n, m = len(data), len(event.names)
    keys = pa.array(event.names, pa.string()).take(pa.array(np.tile(np.arange(m), n)))
    items = pa.concat_arrays([v.cast(pa.string()) for v in values]).take(pa.array(np.arange(n * m).reshape(m, n).T.ravel())) if m else pa.array([], pa.string())
    return pa.MapArray.from_arrays(pa.array(np.arange(n + 1) * m, pa.int32()), keys, items)


def decoder(kept: list[str], layout: str, topics: list[str], data: str, to: str):
    """A function for mapInArrow: batches with the columns ``kept`` and ``to``, the arguments; rows of one event together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = batch.column(layout).dictionary_encode()
            which = met.indices.to_numpy(zero_copy_only=False)
            for k, text in enumerate(met.dictionary.to_pylist()):
                part = batch if len(met.dictionary) == 1 else batch.take(pa.array(np.flatnonzero(which == k)))
                args = arguments(event_of(text), [part.column(c) for c in topics], part.column(data))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), args], [*kept, to])

    return run
