"""Secret scans with a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must contain. Texts are
indexed in blocks, as document-partitioned search indexes are: a block's postings say which of its documents have which
of the needed trigrams (ASCII letters in lower case). Queries intersect and unite postings; only candidates are
verified by the expression. A rule without mandatory trigrams scans every document.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.llm.bpe import small
from chainframe.llm.common import chunks, free_name, text_of


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches are leftmost and don't overlap; those whose ``group`` is shorter than ``least`` characters are dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False


#: The base kinds.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: A private key in PEM, from BEGIN through header lines and digits, whose line breaks may be escaped, to END.
#: Where END lacks, words of 16 digits or more are the key's; a mere mention of BEGIN is that line alone.
_EDGE, _HEADERS = r"(?:[A-Z0-9]+\x20)*PRIVATE KEY(?:\x20BLOCK)?-----", r"(?:\s*[A-Za-z-]+:\x20[^\n]*\n)*"
_PEM = rf"-----BEGIN {_EDGE}(?:{_HEADERS}(?:[A-Za-z0-9+/=\s]|\\[nr])*+-----END {_EDGE}|{_HEADERS}(?:(?:\s|\\[nr])*[A-Za-z0-9+/=]{{16,}})*)"
#: Public formats of keys.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", _PEM),
)
RULES = BASE_RULES + MORE_RULES
SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "integer").add("end", "integer"))

# --- trigram queries: a trigram, ("and", parts), ("or", parts), or True where nothing is known --------------------

MOST_STRINGS, MOST_CLASS = 64, 8


def all_of(parts: Iterable) -> object:
    own = {p for p in parts if p is not True}
    return True if not own else next(iter(own)) if len(own) == 1 else ("and", frozenset(own))


def any_of(parts: Iterable) -> object:
    own = set(parts)
    return True if True in own or not own else next(iter(own)) if len(own) == 1 else ("or", frozenset(own))


def of_strings(strings: Iterable[str]) -> object:
    """What a text must have that contains one of the strings."""
    return any_of(all_of(s[i : i + 3] for i in range(len(s) - 2)) for s in {s.lower() for s in strings})


def _analyse(items) -> tuple[set[str] | None, object]:
    """(all strings that a sequence of parsed items can match, or None if they are many; its query)."""
    whole: set[str] | None = {""}
    run, query = {""}, []
    for item in items:
        strings, own = _one(item)
        if strings is not None and len(strings) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        query += [of_strings(run), own if strings is None else of_strings(strings)]
        run, whole = {""}, None
    query.append(of_strings(run))
    return (run if whole is not None else None), all_of(query)


def _one(item) -> tuple[set[str] | None, object]:
    op, value = str(item[0]), item[1]
    if op == "LITERAL":
        return {chr(value)}, True
    if op == "IN":
        if all(str(k) == "LITERAL" for k, _ in value) and len(value) <= MOST_CLASS:
            return {chr(v) for _, v in value}, True
        return None, True
    if op == "SUBPATTERN":
        return _analyse(value[3])
    if op == "BRANCH":
        parts = [_analyse(p) for p in value[1]]
        if all(s is not None for s, _ in parts):
            return set().union(*(s for s, _ in parts)), True
        return None, any_of(q if s is None else of_strings(s) for s, q in parts)
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        low, high, body = value
        strings, query = _analyse(body)
        if strings is not None and (low, high) == (0, 1):
            return strings | {""}, True
        if low == 0:
            return None, True
        return None, query if strings is None else of_strings(strings)
    if op == "AT":
        return {""}, True
    return None, True


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of a regular expression; True if it has no mandatory trigram.

    The expression's tree comes from the standard library's own parser, which has no public name. Where it is gone, rules
    scan fully: slower, but nothing is missed."""
    try:
        from re import _parser
    except ImportError:
        return True
    strings, query = _analyse(_parser.parse(pattern))
    return of_strings(strings) if strings is not None else query


def trigrams_in(query: object) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams_in, query[1]))


# --- index ------------------------------------------------------------------------------------------------------

_LOWER = bytes(range(256)).lower()


class BlockIndex:
    """Postings of the needed trigrams over one block of texts."""

    def __init__(self, texts: list[str], table: np.ndarray, needed: list[str]):
        raw = [t.encode().translate(_LOWER) for t in texts]
        self.size = len(texts)
        # 255 is in no UTF-8 text, so no trigram spans two texts
        joined = np.frombuffer(b"\xff\xff".join(raw) + b"\xff\xff", np.uint8)
        codes = joined[:-2].astype(np.uint32)
        codes <<= 8
        codes |= joined[1:-1]
        codes <<= 8
        codes |= joined[2:]
        which = table[codes]
        at = np.flatnonzero(which)
        ends = np.cumsum([len(r) + 2 for r in raw])
        doc = np.searchsorted(ends, at, side="right")
        pairs = np.unique(which[at].astype(np.int64) * self.size + doc)
        self.postings = {}
        bounds = np.searchsorted(pairs, np.arange(1, len(needed) + 2) * self.size)
        for k, trigram in enumerate(needed):
            self.postings[trigram] = pairs[bounds[k] : bounds[k + 1]] % self.size

    def find(self, query: object) -> np.ndarray:
        if query is True:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings[query]
        found = [self.find(q) for q in sorted(query[1], key=str)]
        merge = np.intersect1d if query[0] == "and" else np.union1d
        return functools.reduce(lambda a, b: merge(a, b), found)


@functools.lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> tuple[list[tuple[Rule, re.Pattern, object]], list[str], np.ndarray]:
    own = [(r, re.compile(r.pattern, re.ASCII | re.IGNORECASE * r.any_case), trigram_query(r.pattern)) for r in rules]
    needed = sorted(set().union(*(trigrams_in(q) for _, _, q in own)))
    if not all(t.isascii() for t in needed) or len(needed) > 65_000:
        raise ValueError("rules need ASCII trigrams, 65,000 at most")
    table = np.zeros(1 << 24, np.uint8 if len(needed) < 255 else np.uint16)
    for k, t in enumerate(needed):
        table[int.from_bytes(t.encode(), "big")] = k + 1
    return own, needed, table


def scan_block(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """For each text (start, number of the rule, end), sorted."""
    own, needed, table = compiled(rules)
    index = BlockIndex(texts, table, needed)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, pattern, query) in enumerate(own):
        for i in index.find(query).tolist():
            for m in pattern.finditer(texts[i]):
                a, b = m.span(rule.group)
                if b - a >= rule.least:
                    out[i].append((m.start(), k, m.end()))
    return [sorted(x) for x in out]


def redacted(text: str, spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    """The text with each span as ``[secret:kind]``; overlapping spans become one, of the first's kind."""
    out, at = [], 0
    for start, k, end in spans:
        if start >= at:
            out += [text[at:start], f"[secret:{rules[k].kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", to: str = "spans", redact: bool = False) -> DataFrame:
    """Add ``to``: the secrets of each whole text as (kind, start, end), in code points, by start and rule.

    Null and empty texts have none. With ``redact`` the text itself is replaced where it has secrets. Spans that begin at one
    place go in the order of the rules. Other columns stay; one named ``to`` is replaced. No shuffle; rows are independent:
    repeated rows give repeated results, an empty table none. Texts of any length are scanned whole, a very long one by
    itself.
    """
    kept = [c for c in df.columns if c != to]
    own = free_name(df, "__text")
    plain = df.select(*(F.col(f"`{c}`") for c in kept), text_of(text).alias(own))
    schema = plain.drop(own).schema.add(to, SPANS)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in small(batch, own):
                texts = one.column(own).to_pylist()
                found = [x for a, b in chunks(texts) for x in scan_block(texts[a:b], rules)]
                spans = pa.array([[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in x] for x in found], kind)
                columns = {c: one.column(c) for c in kept}
                if redact:
                    old = columns[text].to_pylist()
                    columns[text] = pa.array([redacted(t, x, rules) if x else t for t, x in zip(old, found)], pa.string())
                yield pa.RecordBatch.from_arrays([*columns.values(), spans], [*kept, to])

    return plain.mapInArrow(run, schema)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(documents: DataFrame) -> DataFrame:
    found = scan(documents.select("doc_id", "text")).drop("text")
    base = [r.kind for r in BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *map(count, base), F.sha2(spans_text(of_base).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans")
    )
