"""Byte-level BPE encoding and decoding.

Pre-tokenisation runs without a regular expression. Code points are mapped to a few symbols by a class array; a small
automaton over these symbols tells the kind of the token that each character belongs to. The automaton's transition
functions are closed under composition (a finite monoid), and composing is associative, so the states of all characters
of a chunk come from a blocked scan: compose the functions inside blocks, scan the blocks, replay each block from its
entry state; every step is one table look-up over many blocks. Token starts follow from neighbouring states.

The slices feed a cache of merged slices; a slice that is not cached goes through the pair merging of the vocabulary's
ranks once. Slices' starts are retained so that ids can be traced back to the text.
"""

from __future__ import annotations

import base64
import functools
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.llm.common import chunks, free_name

# --- automaton -------------------------------------------------------------------------------------------------

#: Symbols: letters apart from those of contractions, the latter one by one, numbers, other, apostrophe, blank,
#: other white space, and the end of a text.
LETTER, S_, T_, M_, D_, R_, E_, V_, L_, NUMBER, OTHER, QUOTE, BLANK, SPACE, END = range(15)
#: States: the kind of the current token; A is an apostrophe that may begin a contraction, A_R, A_V and A_L are it
#: with its first letter, CUT is a complete contraction, after which a token begins in any case.
START, IN_L, IN_N, IN_O, IN_BLANK, IN_SPACE, A, A_R, A_V, A_L, CUT = range(11)
N_STATES = 11
#: Code points with the Unicode property White_Space.
WHITE_SPACE = (
    [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


@functools.cache
def symbol_table() -> np.ndarray:
    """The symbol of each code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    table[WHITE_SPACE] = SPACE
    table[ord(" ")] = BLANK
    table[ord("'")] = QUOTE
    for letter, symbol in zip("stmdrevl", (S_, T_, M_, D_, R_, E_, V_, L_), strict=True):
        table[ord(letter)] = symbol
    return table


def _next_state(state: int, symbol: int) -> int:
    if symbol == END:
        return START
    if symbol == BLANK:
        return IN_BLANK
    if symbol == SPACE:
        return IN_SPACE
    if symbol == NUMBER:
        return IN_N
    if symbol == OTHER:
        return IN_O
    if symbol == QUOTE:  # inside a run of other characters, or with a blank before it, it begins no contraction
        return IN_O if state in (IN_O, IN_BLANK, A) else A
    if state == A:
        if symbol in (S_, T_, M_, D_):
            return CUT
        return {R_: A_R, V_: A_V, L_: A_L}.get(symbol, IN_L)
    if (state, symbol) in ((A_R, E_), (A_V, E_), (A_L, L_)):
        return CUT
    return IN_L


@functools.cache
def transitions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(state x symbol -> state; monoid element x element -> element, first applied first; element -> state of each state).

    Elements 0..14 are the symbols' functions, element 15 is the identity.
    """
    step = np.array([[_next_state(s, x) for x in range(15)] for s in range(N_STATES)], np.uint8)
    elements = [tuple(int(v) for v in step[:, x]) for x in range(15)] + [tuple(range(N_STATES))]
    index: dict[tuple[int, ...], int] = {}
    for k, f in enumerate(elements):
        index.setdefault(f, k)
    k = 0
    while k < len(elements):  # close under composition with the symbols
        for x in range(15):
            f = tuple(elements[x][s] for s in elements[k])
            if f not in index:
                index[f] = len(elements)
                elements.append(f)
        k += 1
    product = np.array([[index[tuple(g[s] for s in f)] for g in elements] for f in elements], np.uint16)
    return step, product, np.array(elements, np.uint8)


BLOCK = 256


def _scan(codes: np.ndarray, product: np.ndarray) -> np.ndarray:
    """For each position the composition of all functions before it, by blocks and recursively over blocks."""
    n = len(codes)
    if n <= BLOCK:
        out, acc = np.empty(n, np.uint16), 15
        for i, c in enumerate(codes.tolist()):
            out[i] = acc
            acc = int(product[acc, c])
        return out
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, 15, np.uint16)
    padded[:n] = codes
    by_column = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    total = np.full(blocks, 15, np.uint16)
    for column in by_column:
        total = product[total, column]
    acc = _scan(total, product)
    out = np.empty_like(by_column)
    for j, column in enumerate(by_column):
        out[j] = acc
        acc = product[acc, column]
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


def states_of(symbols: np.ndarray) -> np.ndarray:
    """The automaton's state after each symbol."""
    step, product, elements = transitions()
    n = len(symbols)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, END, np.uint8)
    padded[:n] = symbols
    by_column = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    total = np.full(blocks, 15, np.uint16)
    for column in by_column:
        total = product[total, column]
    state = elements[_scan(total, product), START]
    out = np.empty_like(by_column)
    for j, column in enumerate(by_column):
        state = step[state, column]
        out[j] = state
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


def token_starts(symbols: np.ndarray) -> np.ndarray:
    """True where a token begins. ``symbols`` holds texts that each end with END; END itself is marked as well."""
    state = states_of(symbols)
    before = np.empty_like(state)
    before[0], before[1:] = START, state[:-1]
    after = np.empty_like(symbols)
    after[-1], after[:-1] = END, symbols[1:]
    then = np.empty_like(state)
    then[-1], then[:-1] = START, state[1:]
    white = (symbols == BLANK) | (symbols == SPACE)
    white_before = (before == IN_BLANK) | (before == IN_SPACE)
    white_after = (after == BLANK) | (after == SPACE) | (after == END)
    letter_before = (before == IN_L) | ((before >= A_R) & (before <= A_L))
    goes_on = before == IN_BLANK
    goes_on |= letter_before & (state == IN_L)
    goes_on |= (before == IN_N) & (state == IN_N)
    goes_on |= ((before == IN_O) | (before == A)) & (state == IN_O)
    goes_on |= (state == CUT) | ((state >= A_R) & (state <= A_L) & (then == CUT))
    starts = ~goes_on
    starts[white] = (~white_before | ~white_after)[white]
    starts[symbols == END] = True
    return starts


def pretokenize(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """For each text its slices and their starts in code points."""
    table = symbol_table()
    joined = "\0".join(texts) + "\0"
    symbols = table[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    symbols[ends] = END
    starts = np.flatnonzero(token_starts(symbols))
    begin = 0
    firsts = np.searchsorted(starts, ends)
    low = 0
    for text, end, first in zip(texts, ends.tolist(), firsts.tolist(), strict=True):
        own = starts[low:first] - begin
        cuts = [*own.tolist(), len(text)]
        yield [text[a:b] for a, b in zip(cuts, cuts[1:])], own
        begin, low = end + 1, first + 1


# --- vocabularies ----------------------------------------------------------------------------------------------


def byte_characters() -> dict[str, int]:
    """The printable stand-ins that vocabulary files in JSON use for bytes: printable Latin-1 stands for itself, the
    other bytes follow from U+0100 on in their order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def parse_vocabulary(content: bytes) -> tuple[dict[bytes, int], dict[str, int]]:
    """(bytes -> id; special strings -> id) of a rank file or of a byte-level BPE file in JSON.

    In the JSON file ids of merged tokens follow the order of the merges, so ids serve as ranks for both kinds.
    """
    if content.lstrip()[:1] != b"{":
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}, {}
    read = json.loads(content)
    special = {x["content"]: x["id"] for x in read["added_tokens"]}
    to_byte = byte_characters()
    return {bytes(to_byte[c] for c in k): v for k, v in read["model"]["vocab"].items() if k not in special}, special


#: Stands between slices that are merged in one call.
BETWEEN = "\0"


class MergedSlices:
    """Slice -> its ids as unsigned 32-bit bytes. Keeps slices of ``longest`` characters in two generations of about ``most``:
    when the younger one is full it becomes the older, and slices that are met again move back, so that frequent ones stay.

    Pair merging, in the order of the ranks, is the public library's; it gets whole slices, many in one call.
    """

    def __init__(self, ranks: dict[bytes, int], most: int = 75_000, longest: int = 64):
        import tiktoken

        self.older: dict[str, bytes] = {}
        pattern = f"[^{BETWEEN}]+|{BETWEEN}"
        self.merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.ranks, self.merge_one = ranks, None
        self.known: dict[str, bytes] = {}
        self.most, self.longest, self.between = most, longest, ranks[BETWEEN.encode()]

    def _merge_one(self, piece: str) -> list[int]:
        if self.merge_one is None:  # few texts need it
            import tiktoken

            self.merge_one = tiktoken.Encoding("whole", pat_str="(?s:.+)", mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary
        return self.merge_one(piece)

    def sizes(self, pieces: list[str]) -> np.ndarray:
        """How many ids each piece has; nothing is kept."""
        fresh = [p for p in pieces if BETWEEN not in p]
        ids = np.array(self.merge(BETWEEN.join(fresh)), "<u4")
        cuts = np.r_[-1, np.flatnonzero(ids == self.between), len(ids)]
        sizes = iter((np.diff(cuts) - 1).tolist())
        return np.array([next(sizes) if BETWEEN not in p else len(self._merge_one(p)) for p in pieces], np.int32)

    def of(self, by_text: list[list[str]], counts: bool = False) -> list[bytes] | list[tuple[bytes, np.ndarray]]:
        """The ids of texts that are given as slices; with ``counts`` also where each slice's ids begin."""
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*by_text).difference(known)
        again = [p for p in new if p in older]
        known.update((p, older[p]) for p in again)
        new.difference_update(again)
        fresh = [p for p in new if BETWEEN not in p]
        ids = np.array(self.merge(BETWEEN.join(fresh)), "<u4")
        cuts = np.flatnonzero(ids == self.between).tolist()
        raw = ids.tobytes()
        for piece, a, b in zip(fresh, [-1, *cuts], [*cuts, len(ids)]):
            known[piece] = raw[4 * a + 4 : 4 * b]
        for piece in new:
            if BETWEEN in piece:  # the pattern would take such a slice apart
                known[piece] = np.array(self._merge_one(piece), "<u4").tobytes()
        if counts:
            out = []
            for pieces in by_text:
                own = list(map(known.__getitem__, pieces))
                sizes = np.fromiter(map(len, own), np.int64, len(own)) >> 2
                out.append((b"".join(own), np.cumsum(sizes) - sizes))
        else:
            out = [b"".join(map(known.__getitem__, pieces)) for pieces in by_text]
        for piece in new:
            if len(piece) > self.longest:
                del known[piece]
        return out


@functools.lru_cache(maxsize=4)
def merged_slices(content: bytes) -> tuple[MergedSlices, dict[str, int]]:
    """One cache per vocabulary and Python worker."""
    ranks, special = parse_vocabulary(content)
    return MergedSlices(ranks), special


def encode_chunk(texts: list[str], cache: MergedSlices) -> Iterator[tuple[bytes, np.ndarray]]:
    """For each text its ids as bytes and its slices' starts."""
    sliced = list(pretokenize(texts))
    yield from zip(cache.of([pieces for pieces, _ in sliced]), [starts for _, starts in sliced])


def encode_with_offsets(texts: list[str], content: bytes) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """For each text its ids as bytes, its slices' starts in code points, and where their ids begin."""
    cache, _ = merged_slices(content)
    for a, b in chunks(texts):
        sliced = list(pretokenize(texts[a:b]))
        for (ids, first), (_, starts) in zip(cache.of([pieces for pieces, _ in sliced], counts=True), sliced):
            yield ids, starts, first


def encode_texts(texts: list[str], content: bytes, special: bool = False) -> Iterator[tuple[bytes, np.ndarray]]:
    """As encode_chunk, for many texts in bounded memory. special: the vocabulary's special strings inside a text become
    their ids, as the public tokenizer library does by default; the text around them is encoded on its own."""
    cache, strings = merged_slices(content)
    strings = strings if special else {}
    for a, b in chunks(texts):
        part = texts[a:b]
        if any(s in t for s in strings for t in part):
            for text in part:
                yield _around(text, strings, cache)
        else:
            yield from encode_chunk(part, cache)


def _around(text: str, strings: dict[str, int], cache: MergedSlices) -> tuple[bytes, np.ndarray]:
    ids, starts, at = [], [], 0
    while at <= len(text):
        found = [(k, -len(s), s) for s in strings if (k := text.find(s, at)) >= 0]
        end, _, s = min(found, default=(len(text), 0, ""))
        if end > at:
            own, own_starts = next(encode_chunk([text[at:end]], cache))
            ids.append(own)
            starts.append(own_starts + at)
        if not s:
            break
        ids.append(np.array([strings[s]], "<u4").tobytes())
        starts.append(np.array([end]))
        at = end + len(s)
    return b"".join(ids), np.concatenate(starts) if starts else np.empty(0, np.int64)


class Decoder:
    """ids -> bytes through one array of all tokens' bytes and its offsets."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int]):
        by_id = {v: k for k, v in ranks.items()} | {v: k.encode() for k, v in special.items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        #: Code points that begin in each token: bytes that don't continue one.
        self.code_points = np.array([sum(b & 0xC0 != 0x80 for b in t) for t in tokens], np.int64)

    def __call__(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        return self.blob[np.repeat(self.offsets[ids], lengths) + within].tobytes()


    def slices_match(self, ids: np.ndarray, starts: np.ndarray, first: np.ndarray) -> bool:
        """Whether each slice's ids decode to as many code points as lie between its start and the next."""
        points = np.concatenate([[0], np.cumsum(self.code_points[ids])])
        return bool((points[first] == starts).all()) and len(starts) == len(first)

    def span(self, ids: np.ndarray, starts: np.ndarray, first: np.ndarray, a: int, b: int) -> str:
        """The code points a..b of the text, decoded from the ids of the slices that hold them alone."""
        low = max(0, int(np.searchsorted(starts, a, "right")) - 1)
        high = int(np.searchsorted(starts, b, "left"))
        if b <= a or low >= high:
            return ""
        text = self(ids[first[low] : first[high] if high < len(first) else len(ids)]).decode()
        return text[a - int(starts[low]) : b - int(starts[low])]


@functools.lru_cache(maxsize=4)
def decoder(content: bytes) -> Decoder:
    return Decoder(*parse_vocabulary(content))


# --- Spark -----------------------------------------------------------------------------------------------------

#: Largest vocabulary file that is sent to the executors.
MOST_VOCABULARY_BYTES = 64_000_000


def vocabulary(df: DataFrame, path: str):
    """The file's content, broadcast: executors need no copy of it. Its size is checked."""
    with open(path, "rb") as f:
        content = f.read()
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {len(content)} bytes; at most {MOST_VOCABULARY_BYTES} are broadcast")
    return df.sparkSession.sparkContext.broadcast(content)


def _lists(parts: list[bytes] | list[np.ndarray], kind: str) -> pa.Array:
    """A list column of 32-bit integers without a Python object for each."""
    raw = [p if isinstance(p, bytes) else p.astype(kind).tobytes() for p in parts]
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in raw])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), "<i4")))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", starts: str | None = None, special: bool = False, first: str | None = None) -> DataFrame:
    """Add the column ``ids`` (array<int>), and if named ``starts`` (array<int>: where the slices begin, in code points) and,
    with it, ``first`` (array<int>: the place of each slice's first id).

    Whole texts of any length, a very long one by itself; null and empty texts have no ids. ``df``'s other columns stay;
    columns named like the new ones are replaced. Rows are independent, so there is no shuffle; repeated rows give repeated
    results, and an empty table none.
    """
    if first and (special or not starts):
        raise ValueError("first goes with starts, and not with special strings")
    content = vocabulary(df, path)
    kept = [c for c in df.columns if c not in (ids, starts, first)]
    of = df.schema[text].name
    own = free_name(df, "__text")
    plain = df.select(*(F.col(f"`{c}`") for c in kept), F.coalesce(F.col(f"`{of}`"), F.lit("")).alias(own))
    new = [c for c in (ids, starts, first) if c]
    schema = plain.drop(own).schema
    for c in new:
        schema = schema.add(c, T.ArrayType(T.IntegerType()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in small(batch, own, 1_000_000):
                texts = one.column(own).to_pylist()
                found = list(encode_with_offsets(texts, content.value) if first else encode_texts(texts, content.value, special))
                columns = [one.column(c) for c in kept] + [_lists([x[k] for x in found], "<i4") for k in range(len(new))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *new])

    return plain.mapInArrow(run, schema)


def small(batch: pa.RecordBatch, text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``most`` bytes of text each, or a single row."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield batch.slice(start)


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded", offsets: tuple[str, str] | None = None) -> DataFrame:
    """Add the column ``to`` (binary): the bytes of the ids. Null ids give null; an empty table gives no rows.

    ``offsets`` names encode's columns ``starts`` and ``first``: then ``to``_offsets (boolean) says whether each slice's ids
    decode to the code points between its start and the next, that is whether the slices can be decoded one by one.
    """
    content = vocabulary(df, path)
    match = f"{to}_offsets"
    kept = [c for c in df.columns if c not in (to, match if offsets else to)]
    plain = df.select(*(F.col(f"`{c}`") for c in kept))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded = decoder(content.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                one = batch.slice(k, 128)
                column = one.column(ids)
                values = column.values.to_numpy(zero_copy_only=False)
                at = column.offsets.to_numpy()
                out = [decoded(values[a:b]) if v else None for a, b, v in zip(at, at[1:], column.is_valid().to_pylist())]
                columns = [*(one.column(c) for c in kept), pa.array(out, pa.binary())]
                if offsets:
                    lists = [[x.values.to_numpy(zero_copy_only=False)[a:b] for a, b in zip(o, o[1:])] for x in map(one.column, (ids, *offsets)) for o in [x.offsets.to_numpy()]]
                    columns.append(pa.array([decoded.slices_match(*x) if v is not None else None for v, x in zip(out, zip(*lists))], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, [*kept, to, *([match] if offsets else [])])

    new = [T.StructField(to, T.BinaryType()), *([T.StructField(match, T.BooleanType())] if offsets else [])]
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, *new]))


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """Digests of each document's ids and of what they decode to; its slices, and whether each of them decodes by itself."""
    both = decode(encode(documents.select("doc_id", "text"), path, starts="starts", first="first").drop("text"), path, offsets=("starts", "first"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.size("starts").cast("long").alias("n_slices"),
        F.col("decoded_offsets").alias("offsets_match"),
    )
